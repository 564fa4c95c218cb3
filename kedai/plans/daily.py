"""The daily run: ingest, build the star, test it."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kedai.operators.dimensions import (
    SPINE_START,
    date_spine,
    dim_date,
    dim_msic_group,
    spine_bounds,
)
from kedai.operators.intermediate import int_fuelprice_monthly
from kedai.operators.quality import accepted_values, headline_checks, star_checks, summary
from kedai.operators.staging import stage, stg_msic_lookup
from kedai.plans.ingest_job import ingest
from kedai.plans.marts import fct_retail_sales_monthly
from kedai.session import prepare
from kedai.sources import sinks
from kedai.sources.datasets import DATASETS
from kedai.sources.readers import load_seed, register_sources
from kedai.sources.reconcile import schema_id, united
from kedai.sources.sinks import create_namespace, write_version
from kedai.sources.stored import register_all, register_staging_views


class ChecksFailed(Exception):
    """The gate stopped a build whose tests fail at severity error."""


@dataclass(frozen=True)
class Star:
    """The published tables, and the results of their tests (one row per test)."""

    fuel_monthly: DataFrame
    dim_date: DataFrame
    dim_group: DataFrame
    fact: DataFrame
    checks: DataFrame


SEED = "msic_lookup"
FACT = "fct_retail_sales_monthly"
TABLES = ("int_fuelprice_monthly", "dim_date", "dim_msic_group", FACT)

# The view that names the version which all published views show.
POINTER = "star_version"

# Versions of the star that stay readable, the current one included.
KEPT_VERSIONS = 2


def _table(namespace: str | None, name: str) -> str:
    return f"{namespace}.{name}" if namespace else name


def _path(root: str | None, name: str) -> str | None:
    return f"{root.rstrip('/')}/{name}" if root else None


def _versions_of(name: str, schema: T.StructType) -> str:
    """The table behind a published view: a partition for each version with these columns.

    Versions with other columns have a table of their own, as other sessions may hold on to the columns
    that they know a table by.
    """
    return f"{name}__{schema_id(schema)}"


def _tables_of(spark: SparkSession, name: str, namespace: str | None) -> list[str]:
    """The tables that hold versions of a relation."""
    found = spark.catalog.listTables(namespace or spark.catalog.currentDatabase())
    form = re.compile(rf"{name}__s[0-9a-f]{{8}}")
    return sorted(_table(namespace, table.name) for table in found if form.fullmatch(table.name))


def build_star(
    staging: Mapping[str, DataFrame],
    bounds: DataFrame,
    namespace: str | None = None,
    root: str | None = None,
    gate: bool = False,
    raw: Mapping[str, DataFrame] | None = None,
    seed: DataFrame | None = None,
) -> Star:
    """Write a new version of all tables, test what was written, then show it in one step.

    Each relation has a table with a partition for each version, and a view under its plain name that
    shows the version which one other view, ``star_version``, names. When all tables are complete and,
    with ``gate``, no test fails at severity error, that view is replaced: one catalog operation turns
    all relations to the new version. Until then, and after any failure, readers find the old version of
    all of them. ``seed`` is written as part of the version and staged from there. The fact reads the
    written tables, so the sizes that decide its joins are sizes on disk, and the trade source is
    scanned once.
    """
    spark = bounds.sparkSession
    version = f"v{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S%f}"
    schemas: dict[str, T.StructType] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        table = _versions_of(name, df.schema)
        schemas[name] = df.schema
        place = (_table(namespace, table), version, _path(root, table))
        return write_version(df, *place, is_fact=name == FACT)

    try:
        lookup = stg_msic_lookup(write(SEED, seed)) if seed is not None else staging["stg_msic_lookup"]
        fuel = write(TABLES[0], int_fuelprice_monthly(staging["stg_fuelprice"]))
        days = write(TABLES[1], dim_date(date_spine(bounds)))
        groups = write(TABLES[2], dim_msic_group(lookup))
        plan = fct_retail_sales_monthly(staging["stg_iowrt_3d"], fuel, days, groups)
        fact = write(FACT, plan)
        tests = star_checks(fact, days, groups)
        if "stg_iowrt" in staging:
            tests += headline_checks(staging["stg_iowrt"])
        for name, df in (raw or {}).items():
            accepted = DATASETS[name].accepted.items()
            tests += [accepted_values(df, name, column, values) for column, values in accepted]
        results = summary(tests)
        checks = spark.createDataFrame(results.collect(), results.schema)  # one row per test
        if gate:
            require_passing(checks)
        commit(spark, version, schemas, namespace)
    except Exception:
        if current_version(spark, namespace) != version:
            drop_version(spark, version, namespace)
        raise
    for old in versions(spark, namespace)[:-KEPT_VERSIONS]:
        drop_version(spark, old, namespace)
    _drop_empty(spark, schemas, namespace)
    return Star(fuel, days, groups, fact, checks)


def commit(
    spark: SparkSession, version: str, schemas: Mapping[str, T.StructType], namespace: str | None = None
) -> None:
    """Turn all relations to a version by replacing the one view that names it.

    The views over the tables are made anew before, with the columns of this version; which rows they show
    doesn't change by that. Only in a namespace without a version the name comes first, so that views
    are never seen empty.
    """
    first = current_version(spark, namespace) is None
    if first:
        _point(spark, version, namespace)
    for name, schema in schemas.items():
        _show(spark, name, schema, namespace)
    if not first:
        _point(spark, version, namespace)


def _point(spark: SparkSession, version: str, namespace: str | None) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {_table(namespace, POINTER)} AS SELECT '{version}' AS version")


def current_version(spark: SparkSession, namespace: str | None = None) -> str | None:
    """The version that the published views show."""
    pointer = _table(namespace, POINTER)
    return spark.table(pointer).first().version if spark.catalog.tableExists(pointer) else None


def _show(spark: SparkSession, name: str, schema: T.StructType, namespace: str | None) -> None:
    """A view of the current version with these columns, and others that kept versions have.

    It unites the tables of the relation; the version that is named leaves one of them. A table that
    holds the plain name is kept under another one.
    """
    view = _table(namespace, name)
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {view} RENAME TO {view}__before")
    held = {
        table: T.StructType([f for f in spark.table(table).schema.fields if f.name != sinks.VERSION])
        for table in _tables_of(spark, name, namespace)
    }
    columns = united(schema, *held.values())
    pointer = _table(namespace, POINTER)

    def column(field: T.StructField, names: set[str]) -> str:
        value = f"`{field.name}`" if field.name.lower() in names else "NULL"
        return f"CAST({value} AS {field.dataType.simpleString()}) AS `{field.name}`"

    parts = []
    for table, own in held.items():
        names = {f.name.lower() for f in own.fields}
        listed = ", ".join(column(field, names) for field in columns.fields)
        parts.append(f"SELECT {listed} FROM {table} WHERE {sinks.VERSION} = (SELECT version FROM {pointer})")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + " UNION ALL ".join(parts))


def _drop_empty(spark: SparkSession, schemas: Mapping[str, T.StructType], namespace: str | None) -> None:
    """Remove tables whose versions are all gone, and make the views over them anew. The newest table
    stays, as a version without a row has no partition."""
    for name, schema in schemas.items():
        tables = set(_tables_of(spark, name, namespace)) - {_table(namespace, _versions_of(name, schema))}
        empty = [table for table in tables if not sinks.held_versions(spark, table)]
        for table in empty:
            sinks.drop_table(spark, table)
        if empty:
            _show(spark, name, schema, namespace)


def versions(spark: SparkSession, namespace: str | None = None) -> list[str]:
    """Complete and incomplete versions of the star, oldest first."""
    tables = [table for name in (SEED, *TABLES) for table in _tables_of(spark, name, namespace)]
    return sorted(set().union(*(sinks.held_versions(spark, table) for table in tables)))


def drop_version(spark: SparkSession, version: str, namespace: str | None = None) -> None:
    """Remove one version of all relations with their files."""
    for name in (SEED, *TABLES):
        for table in _tables_of(spark, name, namespace):
            sinks.drop_version(spark, table, version)


def require_passing(checks: DataFrame) -> None:
    """Raise if any test fails at severity error (the relation has one row per test)."""
    failed = checks.where(F.col("status") == "fail").collect()
    if failed:
        raise ChecksFailed(", ".join(f"{r.test} {r.table_name}.{r.column_name}" for r in failed))


def run_daily(
    spark: SparkSession,
    landing: Mapping[str, str],
    seed_path: str,
    raw_root: str,
    namespace: str | None = None,
    root: str | None = None,
    start: dt.date = SPINE_START,
    as_of: dt.date | None = None,
    gate: bool = False,
    only_changed: bool = False,
    raw_database: str | None = None,
    staging_database: str | None = None,
) -> tuple[DataFrame, Star, DataFrame]:
    """Audit of the ingest, the published star and the test results.

    With ``only_changed`` periods that came again as they are in place are not written. With
    ``raw_database`` and ``staging_database`` the raw zone and the staging relations are in the catalog
    as tables and stored views.

    The steps run in order on one driver, so the build never reads a raw zone that is still being
    written. A dataset that never arrived is an empty relation; what needs it is empty too.
    """
    prepare(spark)
    if namespace:
        create_namespace(spark, namespace, root)
    audit = ingest(spark, landing, raw_root, only_changed, raw_database)
    raw = register_sources(spark, raw_root)
    seed = load_seed(spark, seed_path)
    staging = stage(raw, seed)
    bounds = spine_bounds(spark, start=start, as_of=as_of)
    star = build_star(staging, bounds, namespace, root, gate, raw, seed)
    for name, df in (staging | {"stg_msic_lookup": stg_msic_lookup(spark.table(_table(namespace, SEED)))}).items():
        df.createOrReplaceTempView(name)
    if raw_database and staging_database:
        register_all(spark, raw_root, raw_database)
        register_staging_views(spark, _table(namespace, SEED), raw_database, staging_database)
    return audit, star, star.checks
