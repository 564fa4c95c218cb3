"""Left joins of trade rows with the monthly prices and the dimensions.

The right sides hold one row per key, so every trade row stays and none is multiplied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kedai.functions.dates import date_key, month_start
from kedai.functions.keys import or_unknown


def join_fuel_month(trade: DataFrame, fuel_monthly: DataFrame) -> DataFrame:
    """Prices of the month a trade row falls in.

    The price side has one row per calendar month (at most 12 x 9999 by the range of the
    DATE type), a bound that does not move with the data, so it is broadcast outright.
    """
    return trade.join(
        F.broadcast(fuel_monthly),
        month_start(trade["record_date"]) == fuel_monthly["year_month_date"],
        "left",
    )


def join_date(trade: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Date key of the calendar, or the key computed from the date beyond its end.

    No hint: Spark sees the size of the calendar, generated from one row or read from its
    published table.
    """
    days = dim_date.select(F.col("date_key").alias("_date_key"), "full_date")
    return (
        trade.join(days, trade["record_date"] == days["full_date"], "left")
        .withColumn("date_key", F.coalesce("_date_key", date_key(F.col("record_date"))))
        .drop("_date_key", "full_date")
    )


def join_group(trade: DataFrame, dim_group: DataFrame) -> DataFrame:
    """Group key, or the unknown member for codes the dimension lacks.

    Nothing bounds the number of codes, so no hint is given: Spark broadcasts the
    dimension when its size on disk is below ``spark.sql.autoBroadcastJoinThreshold`` and
    otherwise sorts and merges, where the adaptive skew join splits a hot code. Pass the
    published table, not a lazy plan, so that this size is the real one.
    """
    groups = dim_group.select(
        F.col("msic_group_key").alias("_group_key"), F.col("msic_group_code").alias("_code")
    )
    return (
        trade.join(groups, trade["msic_group_code"] == groups["_code"], "left")
        .withColumn("msic_group_key", or_unknown(F.col("_group_key")))
        .drop("_group_key", "_code")
    )
