"""Side-by-side run of a Spark query and its oracle statement."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)  # -0.0 equals 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return "∅" if value is None else str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    return sorted(names), _rows(names, result.fetchall())
