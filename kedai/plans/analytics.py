"""Analyses over the star schema.

All of them aggregate first, to months or groups, and only then look across rows, so
windows and joins see relations bounded by the calendar or by the group dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kedai.functions.dates import month_index, month_start, week_start
from kedai.functions.numeric import exact_mean, exact_sum, round_cents, round_to
from kedai.operators.intermediate import PRICES

FACT_PRICES = (
    "avg_ron95_price_rm",
    "avg_ron97_price_rm",
    "avg_diesel_peninsular_price_rm",
)

MONTH_ON_MONTH = 1
YEAR_ON_YEAR = 12
CORRELATION_DIGITS = 10


def _growth_percent(current: Column, base: Column) -> Column:
    """NULL without a base or with a base of zero."""
    return F.when(base != 0, round_cents((current - base) / base * 100))


def growth(trade: DataFrame, months: int) -> DataFrame:
    """Growth in percent against the same group ``months`` calendar months earlier.

    The frame addresses a calendar distance, not a row distance, so a missing month gives
    NULL. Trade is summed per group and month first: duplicates cannot multiply, and a
    window partition holds at most one row per month.
    """
    monthly = trade.groupBy(
        "msic_group_code", month_start(F.col("record_date")).alias("record_date")
    ).agg(
        exact_sum("sales_value_rm_mil").alias("sales_value_rm_mil"),
        exact_mean("volume_index").alias("volume_index"),
    )
    earlier = (
        Window.partitionBy("msic_group_code")
        .orderBy(month_index(F.col("record_date")))
        .rangeBetween(-months, -months)
    )
    based = monthly.withColumns(
        {
            "_sales_base": F.max("sales_value_rm_mil").over(earlier),
            "_volume_base": F.max("volume_index").over(earlier),
        }
    )
    return based.select(
        "msic_group_code",
        "record_date",
        _growth_percent(F.col("sales_value_rm_mil"), F.col("_sales_base")).alias("sales_growth"),
        _growth_percent(F.col("volume_index"), F.col("_volume_base")).alias("volume_growth"),
    )


def growth_mom(trade: DataFrame) -> DataFrame:
    return growth(trade, MONTH_ON_MONTH)


def growth_yoy(trade: DataFrame) -> DataFrame:
    return growth(trade, YEAR_ON_YEAR)


def fuel_change_weekly(fuel: DataFrame) -> DataFrame:
    """Price of each product per week and its change against the week recorded before.

    Prices are averaged per week before they are turned into rows, so each product's
    window partition holds one row per calendar week.
    """
    weekly = fuel.groupBy(week_start(F.col("record_date")).alias("week_start")).agg(
        *[round_cents(exact_mean(p)).alias(p) for p in PRICES]
    )
    by_product = weekly.unpivot("week_start", list(PRICES), "product", "price_rm")
    before = Window.partitionBy("product").orderBy("week_start")
    return by_product.where(F.col("price_rm").isNotNull()).withColumn(
        "change_rm", round_cents(F.col("price_rm") - F.lag("price_rm").over(before))
    )


def kpi_recent_sales(fact: DataFrame) -> DataFrame:
    """Sales of the latest month next to those of the month before.

    The latest month is found on the partition columns and filters on them, so a
    partitioned fact reads two months.
    """
    month_no = F.col("year") * 12 + F.col("month")
    latest = fact.agg(F.max(month_no).alias("month_no")).scalar()
    is_latest = month_no == F.col("_latest")
    recent = fact.where(month_no >= latest - 1).withColumn("_latest", latest)
    sales = F.col("sales_value_rm_mil")
    totals = recent.agg(
        F.max(F.when(is_latest, F.make_date("year", "month", F.lit(1)))).alias("latest_month"),
        round_cents(exact_sum(F.when(is_latest, sales))).alias("sales_rm_mil"),
        round_cents(exact_sum(F.when(~is_latest, sales))).alias("previous_sales_rm_mil"),
    )
    return totals.withColumn(
        "change_percent",
        _growth_percent(F.col("sales_rm_mil"), F.col("previous_sales_rm_mil")),
    )


def trend_monthly(fact: DataFrame) -> DataFrame:
    """Total sales and fuel prices per month."""
    return fact.groupBy("year", "month").agg(
        round_cents(exact_sum("sales_value_rm_mil")).alias("total_sales_rm_mil"),
        *[F.max(p).alias(p) for p in FACT_PRICES],
    )


def combo_sales_fuel(fact: DataFrame) -> DataFrame:
    """The trend as one (month, measure, value) row per plotted point."""
    trend = trend_monthly(fact)
    measures = ["total_sales_rm_mil", *FACT_PRICES]
    points = trend.unpivot(["year", "month"], measures, "measure", "value")
    return points.where(F.col("value").isNotNull())


def sales_by_group(fact: DataFrame, dim_group: DataFrame) -> DataFrame:
    """Total sales and number of months per group, with its description.

    Aggregated by key first, so only one row per group meets the dimension.
    """
    totals = fact.groupBy("msic_group_key").agg(
        round_cents(exact_sum("sales_value_rm_mil")).alias("total_sales_rm_mil"),
        F.countDistinct("year", "month").alias("n_months"),
    )
    labels = dim_group.select("msic_group_key", "msic_group_code", "group_desc_en")
    return totals.join(labels, "msic_group_key", "left")


def sales_filtered(
    fact: DataFrame, first: tuple[int, int], last: tuple[int, int], groups: list[str]
) -> DataFrame:
    """Fact rows of a month range, both ends included, and of some group codes.

    The range is stated on the partition columns only, so other months are not listed
    for reading.
    """
    month_no = F.col("year") * 12 + F.col("month")
    in_range = month_no.between(first[0] * 12 + first[1], last[0] * 12 + last[1])
    return fact.where(in_range & F.col("msic_group_code").isin(groups))


def sales_in_calendar(fact: DataFrame, days: DataFrame, wanted: Column) -> DataFrame:
    """Total sales of the months that an attribute of the calendar picks (quarter, month, year of week).

    The picked months are at most one row a calendar month and are broadcast; they limit the partitions
    of the fact while the query runs.
    """
    months = days.where(wanted).select("year", "month").distinct()
    picked = fact.join(F.broadcast(months), ["year", "month"], "left_semi")
    return picked.groupBy("year", "month").agg(
        round_cents(exact_sum("sales_value_rm_mil")).alias("total_sales_rm_mil"), F.count("*").alias("n_rows")
    )


def _correlations() -> list[Column]:
    sales = F.col("sales_value_rm_mil")
    return [
        round_to(F.corr(sales, F.col(p)), CORRELATION_DIGITS).alias(f"corr_{p}")
        for p in FACT_PRICES
    ]


def corr_sales_fuel(fact: DataFrame) -> DataFrame:
    """Correlation of sales with each fuel price over all fact rows."""
    return fact.agg(*_correlations())


def corr_by_group(fact: DataFrame) -> DataFrame:
    return fact.groupBy("msic_group_code").agg(*_correlations())


def seasonality(fact: DataFrame) -> DataFrame:
    """Average monthly total per month of the year."""
    totals = fact.groupBy("year", "month").agg(exact_sum("sales_value_rm_mil").alias("total"))
    return totals.groupBy("month").agg(
        round_cents(exact_mean("total")).alias("avg_sales_rm_mil"),
        F.count("*").alias("n_years"),
    )
