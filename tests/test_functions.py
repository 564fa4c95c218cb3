import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kedai.functions import dates as D
from kedai.functions.keys import NULL_KEY_PART, or_unknown, surrogate_key
from kedai.functions.numeric import exact_mean, exact_sum, round_cents


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def day(text):
    return F.lit(text).cast("date")


def test_month_start_is_a_date(spark):
    assert value(spark, D.month_start(day("2017-03-15"))) == dt.date(2017, 3, 1)


def test_date_key(spark):
    assert value(spark, D.date_key(day("2001-10-01"))) == 20011001
    assert value(spark, D.date_key(F.lit(None).cast("date"))) is None


def test_iso_calendar_around_new_year(spark):
    first = day("2017-01-01")
    assert value(spark, D.iso_year(first)) == 2016
    assert value(spark, F.weekofyear(first)) == 52
    assert value(spark, D.iso_day_of_week(first)) == 7
    assert value(spark, D.day_name(first)) == "Sunday"
    assert value(spark, D.iso_day_of_week(day("2017-01-02"))) == 1


def test_epoch_nanos(spark):
    stamp = D.epoch_nanos_to_timestamp(F.lit(1489536000000000000)).cast("string")
    assert value(spark, stamp) == "2017-03-15 00:00:00"
    cut = D.epoch_nanos_to_timestamp(F.lit(1489536000999999999)).cast("string")
    assert value(spark, cut) == "2017-03-15 00:00:00"


@pytest.mark.parametrize("raw, rounded", [(1.005, 1.0), (0.285, 0.28), (2.0, 2.0), (1.239, 1.24)])
def test_round_cents_rounds_the_binary_value(spark, raw, rounded):
    assert value(spark, round_cents(F.lit(raw))) == rounded


def test_surrogate_key(spark):
    assert value(spark, surrogate_key(F.lit("471"))) == "8e6b42f1644ecb1327dc03ab345e618b"
    missing = F.lit(None).cast("string")
    assert value(spark, surrogate_key(missing)) == value(spark, F.md5(F.lit(NULL_KEY_PART)))
    assert value(spark, surrogate_key(F.lit("a"), F.lit(1))) == value(spark, F.md5(F.lit("a-1")))


def test_unknown_member(spark):
    assert value(spark, or_unknown(F.lit(None).cast("string"))) == "UNKNOWN"


@pytest.mark.parametrize(
    "values,total",
    [
        ([1.00499, 1.00499, 1.005], 3.01498),
        ([0.00004] * 10, 0.0004),
        ([0.1] * 10, 1.0),
        ([1e-20, 1.0, -1.0], 1e-20),
        ([3.141592653589793, 2.718281828459045], 5.859874482048838),
        ([1e25, 1.0], 1e25),
        ([123456789012.125, 0.875], 123456789013.0),
        ([float("inf"), 1.0], float("inf")),
        ([None, None], None),
        ([None, 2.0], 2.0),
    ],
)
@pytest.mark.parametrize("parts", [1, 5])
def test_sums_keep_every_digit(spark, values, total, parts):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    row = df.agg(exact_sum("v").alias("total"), exact_mean("v").alias("mean")).first()
    assert row.total == total
    n = sum(v is not None for v in values)
    assert row.mean == (total / n if n else None)


def test_what_is_no_number_shows_in_sums(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert math.isnan(df.agg(exact_sum("v")).first()[0])


@pytest.mark.parametrize("seed", range(3))
def test_sums_are_exact_in_any_order(spark, seed):
    """Against rational arithmetic on the decimal digits, at sizes from 1e-9 to 1e12."""
    rng = random.Random(seed)
    values = [round(rng.uniform(-1, 1) * 10 ** rng.randrange(-3, 8), rng.randrange(0, 9)) for _ in range(500)]
    expected = float(sum(Fraction(repr(v)) for v in values))
    found = set()
    for parts in (1, 2, 3, 7, 16):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        found.add(df.agg(exact_sum("v")).first()[0])
    assert found == {expected}
