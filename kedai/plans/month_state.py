"""Month averages from a stored state that a delivery changes only where it touched a month."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kedai.functions.dates import month_start
from kedai.functions.numeric import exact_parts, exact_total, round_cents
from kedai.operators.intermediate import PRICES
from kedai.operators.staging import stg_fuelprice
from kedai.sources.datasets import FUELPRICE
from kedai.sources.readers import scan_raw_mixed

MONTH = ("year", "month")


def fuel_state(fuel: DataFrame) -> DataFrame:
    """Exact sum and count of every price per month: the state that averages come from.

    States of disjoint rows add up, so it doesn't matter how the rows of a month arrived.
    """
    month = month_start(F.col("record_date"))
    parts = [F.struct(*(c.alias(k) for k, c in exact_parts(p).items())).alias(p) for p in PRICES]
    return fuel.groupBy(month.alias("year_month_date")).agg(*parts)


def add_states(states: DataFrame) -> DataFrame:
    """One state for each month out of several."""

    def total(price: str) -> Column:
        kinds = {f.name: f.dataType for f in states.schema[price].dataType.fields}
        return F.struct(*(F.sum(f"{price}.{k}").cast(kind).alias(k) for k, kind in kinds.items())).alias(price)

    return states.groupBy("year_month_date").agg(*map(total, PRICES))


def averages(state: DataFrame) -> DataFrame:
    """The monthly averages behind a state, as ``int_fuelprice_monthly`` has them."""

    def average(price: str) -> Column:
        kinds = state.schema[price].dataType.fieldNames()
        parts = {k: F.col(f"{price}.{k}") for k in kinds}
        return round_cents(exact_total(parts) / parts["n"]).alias(f"avg_{price}")

    return state.select("year_month_date", *map(average, PRICES))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    schema = fuel_state(stg_fuelprice(spark.createDataFrame([], FUELPRICE.raw_schema))).schema
    return spark.read.schema(schema.add("year", "string").add("month", "string")).parquet(path)


def refresh_state(
    spark: SparkSession, raw_root: str, path: str, periods: Iterable[str] | None = None
) -> DataFrame:
    """Bring the stored state up to date and return it.

    ``periods`` are those that a delivery wrote, as text (``ingest_with_outcomes`` lists them); the raw
    rows of their months are read and their states replaced, all others stay. Without ``periods``, or
    without a state, every month is computed. Months are partitions, replaced one by one.
    """
    raw = scan_raw_mixed(spark, raw_root, FUELPRICE)
    try:
        read_state(spark, path).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        periods = None
    touched = None if periods is None else sorted({tuple(p.split("-")[:2]) for p in periods})
    if touched == []:
        return read_state(spark, path)
    state = fuel_state(stg_fuelprice(raw if touched is None else raw.where(in_months(touched))))
    day = F.col("year_month_date")
    rows = state.withColumns({"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM")})
    # One row a month: one task writes them all.
    writer = rows.coalesce(1).write.mode("overwrite").partitionBy(*MONTH)
    writer.option("partitionOverwriteMode", "dynamic" if touched else "static").parquet(path)
    return read_state(spark, path)


def in_months(months: Iterable[tuple[str, str]]) -> Column:
    """A filter on the period columns alone, so that other months' folders are not read."""
    return F.concat_ws("-", *MONTH).isin([f"{year}-{month}" for year, month in months])
