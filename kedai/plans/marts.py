"""The fact and its variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kedai.functions.dates import month_index
from kedai.functions.keys import UNKNOWN_MEMBER
from kedai.operators.joins import join_date, join_fuel_month, join_group

KEYS = ("date_key", "msic_group_key")
DEGENERATE = ("record_date", "msic_group_code")
MEASURES = (
    "sales_value_rm_mil",
    "volume_index",
    "avg_ron95_price_rm",
    "avg_ron97_price_rm",
    "avg_diesel_peninsular_price_rm",
)


def fct_retail_sales_monthly(
    trade: DataFrame, fuel_monthly: DataFrame, dim_date: DataFrame, dim_group: DataFrame
) -> DataFrame:
    """Trade rows with keys, month prices and partition columns; one row in, one row out.

    Three map-side joins when the dimensions are of broadcast size: the trade side is
    never shuffled.
    """
    keyed = join_group(join_date(trade, dim_date), dim_group)
    return _fact_rows(join_fuel_month(keyed, fuel_monthly), KEYS)


def fact_measures(trade: DataFrame, fuel_monthly: DataFrame) -> DataFrame:
    """The fact without dimension keys: the code, the months and the measures."""
    return _fact_rows(join_fuel_month(trade, fuel_monthly), ())


def _fact_rows(priced: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return priced.select(
        *keys,
        *DEGENERATE,
        *MEASURES,
        F.year("record_date").alias("year"),
        F.month("record_date").alias("month"),
    )


def since_fuel_start(fact: DataFrame, fuel_monthly: DataFrame) -> DataFrame:
    """Optional: leave out trade from before the first month with fuel prices.

    The first month also limits the partition columns, so earlier months are not listed for reading.
    """
    first = fuel_monthly.agg(F.min("year_month_date")).scalar()
    month = fuel_monthly.agg(F.min(month_index(F.col("year_month_date")))).scalar()
    return fact.where((F.col("year") * 12 + F.col("month") >= month) & (F.col("record_date") >= first))


def unknown_groups(fact: DataFrame) -> DataFrame:
    """Fact rows whose code the group dimension lacks."""
    return fact.where(F.col("msic_group_key") == UNKNOWN_MEMBER)
