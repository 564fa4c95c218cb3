"""Grain alignment and unions between staging and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kedai.functions.dates import month_start
from kedai.functions.numeric import exact_mean, round_cents

PRICES = (
    "ron95_price_rm",
    "ron97_price_rm",
    "diesel_peninsular_price_rm",
    "diesel_eastmsia_price_rm",
)

OVERALL_GROUP = "Overall"


def int_fuelprice_monthly(fuel: DataFrame) -> DataFrame:
    """Average price per month, to cents; a month without a price keeps NULL.

    Prices are summed exactly. Partial sums are merged per month before the shuffle, so a crowded month costs no
    more than another. Unordered: sort for display with ``in_month_order``.
    """
    return fuel.groupBy(month_start(F.col("record_date")).alias("year_month_date")).agg(
        *[round_cents(exact_mean(p)).alias(f"avg_{p}") for p in PRICES]
    )


def in_month_order(df: DataFrame, column: str = "year_month_date") -> DataFrame:
    return df.orderBy(F.col(column).asc_nulls_last())


def int_trade_unioned(headline: DataFrame, by_group: DataFrame) -> DataFrame:
    """Headline and group trade in one relation, headline tagged as its own group."""
    tagged = headline.withColumn("msic_group_code", F.lit(OVERALL_GROUP))
    return by_group.unionByName(tagged, allowMissingColumns=True)


def date_ranges(sources: dict[str, DataFrame]) -> DataFrame:
    """First and last record date of each source."""
    ranges = [
        df.agg(
            F.min("record_date").cast("date").alias("min_dt"),
            F.max("record_date").cast("date").alias("max_dt"),
        ).select(F.lit(name).alias("source"), "min_dt", "max_dt")
        for name, df in sources.items()
    ]
    union = ranges[0]
    for other in ranges[1:]:
        union = union.unionByName(other)
    return union


def final_date_range(ranges: DataFrame) -> DataFrame:
    """One row: first and last date over all sources."""
    return ranges.agg(F.min("min_dt").alias("start_date"), F.max("max_dt").alias("end_date"))
