"""The calendar and the group dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kedai.functions import dates as D
from kedai.functions.keys import surrogate_key

SPINE_START = dt.date(2017, 1, 1)


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day from ``start_date`` up to but excluding ``end_date`` of a one-row relation.

    The number of days is bounded by the calendar, whatever the size of the data.
    """
    nonempty = bounds.where(F.col("start_date") < F.col("end_date"))
    days = F.sequence("start_date", F.date_sub("end_date", 1))
    return nonempty.select(F.explode(days).alias("full_date"))


def spine_bounds(
    spark: SparkSession,
    start: dt.date = SPINE_START,
    end_exclusive: dt.date | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Spine limits; the default end is one month after ``as_of`` (today if not given)."""
    day = F.lit(as_of) if as_of else F.current_date()
    end = F.lit(end_exclusive) if end_exclusive else F.add_months(day, 1)
    return spark.range(1).select(
        F.lit(start).cast("date").alias("start_date"), end.cast("date").alias("end_date")
    )


def dim_date(spine: DataFrame) -> DataFrame:
    """Calendar attributes; weeks and weekdays follow ISO 8601."""
    day = F.col("full_date")
    return spine.select(
        "full_date",
        D.date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        D.iso_year(day).alias("year_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        D.iso_day_of_week(day).alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        D.year_month(day).alias("year_month"),
        D.month_start(day).alias("first_day_of_month"),
        D.day_name(day).alias("day_name"),
    )


def limit_spine(spine: DataFrame, final_range: DataFrame) -> DataFrame:
    """Days inside an observed one-row range, through scalar subqueries."""
    first = final_range.select("start_date").scalar()
    last = final_range.select("end_date").scalar()
    return spine.where((F.col("full_date") >= first) & (F.col("full_date") <= last))


def _as_dimension(df: DataFrame) -> DataFrame:
    return df.select(
        surrogate_key(F.col("msic_group_code")).alias("msic_group_key"),
        "msic_group_code",
        "group_desc_en",
        "group_desc_bm",
    )


def dim_msic_group(lookup: DataFrame) -> DataFrame:
    """One row per code: the longest description wins, then the smallest text.

    Spark limits each group to its first row before the shuffle as well as after it, so
    a code with very many rows still ships one row per task.
    """
    best_first = Window.partitionBy("msic_group_code").orderBy(
        F.length("group_desc_en").desc_nulls_last(),
        F.length("group_desc_bm").desc_nulls_last(),
        F.col("group_desc_en").asc_nulls_last(),
        F.col("group_desc_bm").asc_nulls_last(),
    )
    ranked = lookup.withColumn("rank", F.row_number().over(best_first))
    return _as_dimension(ranked.where(F.col("rank") == 1))


def dim_msic_group_maxstruct(lookup: DataFrame) -> DataFrame:
    """The same rows by one aggregate over an ordered struct, without a window."""
    best = F.min(
        F.struct(
            -F.coalesce(F.length("group_desc_en"), F.lit(-1)),
            -F.coalesce(F.length("group_desc_bm"), F.lit(-1)),
            F.col("group_desc_en"),
            F.col("group_desc_bm"),
        )
    )
    picked = lookup.groupBy("msic_group_code").agg(best.alias("best"))
    return _as_dimension(
        picked.select("msic_group_code", "best.group_desc_en", "best.group_desc_bm")
    )
