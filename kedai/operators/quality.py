"""Declarative table tests.

Counts of one table are taken in one pass. Key tests aggregate before the shuffle, so a
hot key costs one row per task, and foreign keys are compared as distinct keys with their
row counts instead of row by row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"


@dataclass(frozen=True)
class RowCheck:
    """A test that looks at one row at a time; ``failed`` is true for a failing row."""

    test: str
    column: str
    failed: Column
    severity: str = ERROR


def not_null(column: str, severity: str = ERROR) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull(), severity)


def expression_is_true(column: str, condition: Column, severity: str = ERROR) -> RowCheck:
    """NULL results pass; ``not_null`` is the test for those. A column that is not a number fails:
    Spark takes NaN for larger than every number."""
    return RowCheck("expression_is_true", column, ~condition | F.isnan(column), severity)


def row_checks(df: DataFrame, table: str, checks: list[RowCheck]) -> DataFrame:
    """One result row per check, from a single aggregate over the table."""
    counts = df.agg(*[F.count_if(c.failed).alias(f"c{i}") for i, c in enumerate(checks)])
    results = F.array(
        *[
            F.struct(
                F.lit(c.test).alias("test"),
                F.lit(table).alias("table_name"),
                F.lit(c.column).alias("column_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(results))


def failing_rows(df: DataFrame, check: RowCheck) -> DataFrame:
    """The rows behind a failure count."""
    return df.where(check.failed)


def _key_counts(df: DataFrame, column: str) -> DataFrame:
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(column).agg(F.count("*").alias("n_rows"))


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    return _key_counts(df, column).where(F.col("n_rows") > 1)


def unique(
    df: DataFrame, table: str, column: str, severity: str = ERROR, count_rows: bool = False
) -> DataFrame:
    """Failures count duplicated values; ``count_rows`` adds the number of rows tested."""
    counts = [F.count_if(F.col("n_rows") > 1).alias("failures")]
    if count_rows:
        counts.append(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows_checked"))
    return _result(_key_counts(df, column).agg(*counts), "unique", table, column, severity)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent row, with their number of child rows."""
    keys = _key_counts(child, column)
    parents = parent.select(F.col(field).alias("_parent_key"))
    return keys.join(parents, F.col(column) == F.col("_parent_key"), "left_anti")


def relationships(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    field: str,
    severity: str = ERROR,
) -> DataFrame:
    """Failures count child rows, not distinct keys."""
    orphans = orphan_keys(child, column, parent, field)
    failures = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failures"))
    return _result(failures, "relationships", table, column, severity)


def unaccepted_values(df: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """Values outside the list, with their number of rows; NULL is not a value."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
    )


def accepted_values(
    df: DataFrame, table: str, column: str, accepted: tuple[str, ...], severity: str = ERROR
) -> DataFrame:
    """Failures count distinct values outside the list."""
    failing = unaccepted_values(df, column, accepted).agg(F.count("*").alias("failures"))
    return _result(failing, "accepted_values", table, column, severity)


def _result(
    counts: DataFrame, test: str, table: str, column: str, severity: str
) -> DataFrame:
    """Label a one-row relation of counts with the test it belongs to."""
    return counts.select(
        F.lit(test).alias("test"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
        *counts.columns,
    )


def with_status(results: DataFrame) -> DataFrame:
    """``pass``, or ``warn`` / ``fail`` by severity."""
    failed = F.when(F.col("severity") == WARN, "warn").otherwise("fail")
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(failed))


def summary(results: list[DataFrame]) -> DataFrame:
    return with_status(reduce(DataFrame.unionByName, results))


def fact_row_checks() -> list[RowCheck]:
    measures = ("sales_value_rm_mil", "volume_index")
    return [
        not_null("date_key"),
        not_null("msic_group_key"),
        *[not_null(m, WARN) for m in measures],
        *[expression_is_true(m, F.col(m) >= 0) for m in measures],
    ]


def star_checks(fact: DataFrame, dim_date: DataFrame, dim_group: DataFrame) -> list[DataFrame]:
    """Every test declared for the star schema."""
    fact_name = "fct_retail_sales_monthly"
    dimensions = {
        "dim_date": (dim_date, ("date_key", "full_date")),
        "dim_msic_group": (dim_group, ("msic_group_key", "msic_group_code")),
    }
    results = []
    for name, (df, keys) in dimensions.items():
        results.append(row_checks(df, name, [not_null(k) for k in keys]))
        results.extend(unique(df, name, k) for k in keys)
    results.append(row_checks(fact, fact_name, fact_row_checks()))
    results.append(relationships(fact, fact_name, "date_key", dim_date, "date_key"))
    results.append(
        relationships(fact, fact_name, "msic_group_key", dim_group, "msic_group_key")
    )
    return results


def headline_checks(headline: DataFrame) -> list[DataFrame]:
    """The record date of the headline series is present and unique."""
    return [
        row_checks(headline, "stg_iowrt", [not_null("record_date")]),
        unique(headline, "stg_iowrt", "record_date"),
    ]
