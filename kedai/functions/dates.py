"""Calendar and epoch expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NANOS_PER_SECOND = 1_000_000_000
NANOS_PER_MICRO = 1_000

# Column types accepted as a point in time. Spark shows nanosecond timestamps in parquet as
# longs; a dataset that is delivered with such dates declares it.
DATETIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Longs closer to the epoch than this (116 days) are no nanoseconds, but days, seconds or the like.
LEAST_NANOS = 10**16

# Forms of dates as text, each with the pattern that reads it (None: ISO 8601).
# A time of day alone is no date.
DATE_FORMS = (
    (r"\d{4}-\d{1,2}-\d{1,2}([ T].+)?", None),
    (r"\d{4}-\d{1,2}", "yyyy-M"),
    (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
    (r"\d{4}/\d{1,2}/\d{1,2} \d{2}:\d{2}:\d{2}", "yyyy/M/d HH:mm:ss"),
    (r"\d{8}", "yyyyMMdd"),
    (r"\d{1,2} [A-Z][a-z]{2} \d{4}", "d MMM yyyy"),
    (r"\d{1,2}-[A-Z][a-z]{2}-\d{4}", "d-MMM-yyyy"),
    (r"\d{1,2} [A-Z][a-z]{3,} \d{4}", "d MMMM yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
)


def month_start(col: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(col, "month")


def week_start(col: Column) -> Column:
    """Monday of the ISO week, as a date."""
    return F.trunc(col, "week")


def date_key(col: Column) -> Column:
    """``YYYYMMDD`` as an int, by arithmetic instead of formatting and parsing text."""
    return F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)


def month_index(col: Column) -> Column:
    """Months since year 0, so that calendar distances become plain differences."""
    return F.year(col) * 12 + F.month(col)


def year_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def day_name(col: Column) -> Column:
    return F.date_format(col, "EEEE")


def iso_year(col: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), col).cast("int")


def iso_day_of_week(col: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(col) + 1


def _whole_units(col: Column, unit: int) -> Column:
    return F.call_function("div", col, F.lit(unit))


def epoch_nanos_to_timestamp(col: Column) -> Column:
    """Nanoseconds since the epoch to a timestamp, cut to whole seconds."""
    return F.timestamp_seconds(_whole_units(col, NANOS_PER_SECOND))


def as_timestamp(col: Column, data_type: T.DataType) -> Column:
    """Strict reading of a stored date column, in whole seconds if stored as a long."""
    if isinstance(data_type, T.IntegralType):
        return epoch_nanos_to_timestamp(col)
    return col.cast("timestamp")


def as_date(col: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.IntegralType):
        return epoch_nanos_to_timestamp(col).cast("date")
    return col.cast("date")


def text_timestamp(col: Column) -> Column:
    """A date in one of the forms of ``DATE_FORMS``; any other text becomes NULL.

    The forms exclude one another; they are tested in their order, the commonest one first.
    """
    text = F.trim(col)
    read = F.lit(None).cast("timestamp")
    for form, pattern in reversed(DATE_FORMS):
        parsed = F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
        read = F.when(text.rlike(f"^{form}$"), parsed).otherwise(read)
    return read


def arrival_timestamp(col: Column, data_type: T.DataType) -> Column:
    """Reading of a delivered date column; what is no date becomes NULL."""
    if isinstance(data_type, T.StringType):
        return text_timestamp(col)
    if isinstance(data_type, T.IntegralType):
        nanos = F.when(F.abs(col) >= LEAST_NANOS, col)
        return F.timestamp_micros(_whole_units(nanos, NANOS_PER_MICRO))
    return col.cast("timestamp")
