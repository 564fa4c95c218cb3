"""Typed, filtered and renamed views over the raw datasets and the seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kedai.functions.dates import as_date, as_timestamp
from kedai.sources.datasets import DATE_COLUMN

# Series values that hold absolute figures (fixed values).
ABSOLUTE_SERIES = "abs"
LEVEL_SERIES = "level"


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def _day(df: DataFrame) -> Column:
    return as_date(F.col(DATE_COLUMN), df.schema[DATE_COLUMN].dataType)


def stg_iowrt(raw: DataFrame) -> DataFrame:
    """Headline trade, absolute figures."""
    return raw.where(F.col("series") == ABSOLUTE_SERIES).select(
        _day(raw).alias("record_date"),
        F.col("sales").cast("double").alias("sales_value_rm_mil"),
        F.col("volume").cast("double").alias("volume_index"),
        F.col("volume_sa").cast("double").alias("volume_index_sa"),
    )


def stg_iowrt_3d(raw: DataFrame) -> DataFrame:
    """Trade by group, absolute figures with a group code."""
    return raw.where((F.col("series") == ABSOLUTE_SERIES) & _filled("group_code")).select(
        _day(raw).alias("record_date"),
        F.col("group_code").cast("string").alias("msic_group_code"),
        F.col("sales").cast("double").alias("sales_value_rm_mil"),
        F.col("volume").cast("double").alias("volume_index"),
    )


def stg_fuelprice(raw: DataFrame) -> DataFrame:
    """Fuel price levels; the date comes as epoch nanoseconds or as a timestamp."""
    date_type = raw.schema[DATE_COLUMN].dataType
    return raw.where(F.col("series_type") == LEVEL_SERIES).select(
        as_timestamp(F.col(DATE_COLUMN), date_type).alias("record_date"),
        F.col("ron95").cast("double").alias("ron95_price_rm"),
        F.col("ron97").cast("double").alias("ron97_price_rm"),
        F.col("diesel").cast("double").alias("diesel_peninsular_price_rm"),
        F.col("diesel_eastmsia").cast("double").alias("diesel_eastmsia_price_rm"),
    )


def stg_msic_lookup(seed: DataFrame) -> DataFrame:
    """Group descriptions with a group code."""
    return seed.where(_filled("group_code")).select(
        F.col("group_code").cast("string").alias("msic_group_code"),
        F.col("desc_en").cast("string").alias("group_desc_en"),
        F.col("desc_bm").cast("string").alias("group_desc_bm"),
    )


def codes_of_length(lookup: DataFrame, length: int = 3) -> DataFrame:
    """Optional: keep only codes of one classification level."""
    return lookup.where(F.length(F.trim("msic_group_code")) == length)


def stage(raw: dict[str, DataFrame], seed: DataFrame) -> dict[str, DataFrame]:
    """All staging relations by name."""
    return {
        "stg_iowrt": stg_iowrt(raw["iowrt"]),
        "stg_iowrt_3d": stg_iowrt_3d(raw["iowrt_3d"]),
        "stg_fuelprice": stg_fuelprice(raw["fuelprice"]),
        "stg_msic_lookup": stg_msic_lookup(seed),
    }


def register_staging(raw: dict[str, DataFrame], seed: DataFrame) -> dict[str, DataFrame]:
    """All staging relations, also as temp views under their names."""
    frames = stage(raw, seed)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames
