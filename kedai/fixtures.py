"""The raw relations, derived from the generated sales tables for tests and benchmarks."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@functools.lru_cache(maxsize=None)
def _schema(spark: SparkSession, path: str) -> T.StructType:
    """Read a footer once per session instead of once per scan."""
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def epoch_nanos(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp")) * 1000


def group_code() -> Column:
    """Brand as the group code; two part sizes stand for the empty and the missing code."""
    return (
        F.when(F.col("p_size") == 1, "")
        .when(F.col("p_size") == 2, F.lit(None))
        .otherwise(F.col("p_brand"))
    )


def series() -> Column:
    return (
        F.when(F.col("l_returnflag") == "A", "abs")
        .when(F.col("l_returnflag") == "N", "growth_yoy")
        .otherwise("growth_mom")
    )


def ship_month() -> Column:
    return F.trunc("l_shipdate", "month")


def money_sum(col: Column | str, scale: int = 2) -> Column:
    """Exact sum, independent of the order of the rows."""
    exact = (F.col(col) if isinstance(col, str) else col).cast(f"decimal(18,{scale})")
    return F.sum(exact).cast("double")


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``iowrt_3d`` with one row per line item, the volume variant."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", group_code().alias("group_code"))
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        series().alias("series"),
        ship_month().alias("ymd_date"),
        "group_code",
        F.col("l_extendedprice").alias("sales"),
        F.col("l_quantity").alias("volume"),
    )


def raw_iowrt_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        trade_lines(spark, sf_dir)
        .groupBy("series", "ymd_date", "group_code")
        .agg(money_sum("sales").alias("sales"), F.sum("volume").alias("volume"))
    )


def raw_iowrt(spark: SparkSession, sf_dir: str) -> DataFrame:
    adjusted = F.col("l_quantity") * (1 - F.col("l_discount"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(series().alias("series"), ship_month().alias("ymd_date"))
        .agg(
            money_sum("l_extendedprice").alias("sales"),
            F.sum("l_quantity").alias("volume"),
            money_sum(adjusted, 4).alias("volume_sa"),
        )
    )


def raw_fuelprice(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "change_weekly")
        .otherwise("level")
        .alias("series_type"),
        epoch_nanos(F.col("o_orderdate")).alias("ymd_date"),
        price.alias("ron95"),
        F.when(priority != "5-LOW", price).alias("ron97"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), price).alias("diesel"),
        F.when(priority == "1-URGENT", price).alias("diesel_eastmsia"),
    )


def fine_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as prices with six places, from whole numbers, so that every engine has the same doubles."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return table(spark, sf_dir, "orders").select(
        F.trunc("o_orderdate", "month").alias("month"),
        (cents * 7919 % 5000011 / F.lit(1e6)).alias("price"),
    )


def fuel_with_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered fuel prices whose dates are text: days, instants and unreadable ones."""
    day = F.col("o_orderdate")
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "5-LOW", "not a date")
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "change_weekly")
        .otherwise("level")
        .alias("series_type"),
        text.alias("date"),
        price.alias("ron95"),
        F.when(priority != "4-NOT SPECIFIED", price).alias("ron97"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), price).alias("diesel"),
        F.when(priority == "1-URGENT", price).alias("diesel_eastmsia"),
    )


def fuel_date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in several forms; one is a time of day without a date."""
    day = F.col("o_orderdate")
    forms = {
        "1-URGENT": "yyyy/MM/dd",
        "2-HIGH": "yyyyMMdd",
        "3-MEDIUM": "dd MMM yyyy",
        "4-NOT SPECIFIED": "MM/dd/yyyy",
    }
    text = F.lit("12:30")
    for priority, form in forms.items():
        text = F.when(F.col("o_orderpriority") == priority, F.date_format(day, form)).otherwise(text)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_type"),
        text.alias("date"),
        F.col("o_totalprice").alias("ron95"),
    )


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuel prices delivered with a time of day down to microseconds."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_type"),
        F.col("ts").cast("timestamp").alias("date"),
        F.col("value").alias("ron95"),
        F.col("event_id").cast("double").alias("ron97"),
    )


def msic_lookup(spark: SparkSession, sf_dir: str, complete: bool = True) -> DataFrame:
    """The lookup; an incomplete one lacks a brand, whose codes are then unknown."""
    parts = table(spark, sf_dir, "part")
    if not complete:
        parts = parts.where(F.col("p_brand") != "Brand#13")
    return parts.select(
        group_code().alias("group_code"),
        F.col("p_name").alias("desc_en"),
        F.col("p_type").alias("desc_bm"),
    )


def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup rows as published: quotes, commas, line breaks, empty and missing texts, more columns."""
    quoted = F.concat("p_name", F.lit(', "'), "p_type", F.lit('", other'))
    broken = F.when(F.col("p_size") % 5 == 0, F.concat("p_type", F.lit("\n"), "p_name")).when(
        F.col("p_size") % 7 == 0, F.lit("")
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("digits"),
        group_code().alias("group_code"),
        quoted.alias("desc_en"),
        broken.alias("desc_bm"),
    )


def awkward_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade rows whose codes hold quotes, commas and line breaks, or are empty or missing."""
    code = F.col("group_code")
    return trade_lines(spark, sf_dir).withColumn(
        "group_code", F.when(code == "", code).otherwise(F.concat(code, F.lit(', "a"\nb')))
    )


def calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the first year with orders to the end of the last month with orders."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").agg(
        F.trunc(F.min(day), "year").alias("start_date"),
        F.add_months(F.trunc(F.max(day), "month"), 1).alias("end_date"),
    )


def as_landing(raw: DataFrame) -> DataFrame:
    """Back to the names a dataset is delivered under."""
    return raw.withColumnsRenamed({"ymd_date": "date", "group_code": "group"})
