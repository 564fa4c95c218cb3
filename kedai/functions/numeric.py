"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(col: Column, digits: int) -> Column:
    """Round the binary value. ``F.round(col, digits)`` goes through the decimal text
    instead and differs from SQL engines that round doubles arithmetically."""
    scale = F.lit(float(10**digits))
    return F.round(col * scale) / scale


def round_cents(col: Column) -> Column:
    return round_to(col, 2)


# Values are summed as decimals in three ranges, so that no digit a double shows is lost and no order
# of rows matters: below COMMON with 18 places, and what tiny values have beyond those with 36; from
# there to LARGE with 8, as doubles of that size show no more. Beyond LARGE, and for what is no number,
# the sum is the plain one of doubles, so that such values show in the result instead of vanishing.
COMMON, LARGE, TINY = 1e8, 1e18, 0.1
COMMON_TYPE, TINY_TYPE, LARGE_TYPE = "decimal(38,18)", "decimal(38,36)", "decimal(38,8)"


def exact_parts(col: Column | str) -> dict[str, Column]:
    """The parts of an exact sum as aggregates; parts of disjoint rows add up to those of all rows."""
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    size = F.abs(value)
    common = F.when(size < COMMON, value.cast(COMMON_TYPE))
    beyond = F.when(size < TINY, (value - common.cast("double")).cast(TINY_TYPE))
    return {
        "common": F.sum(common),
        "tiny": F.sum(beyond),
        "large": F.sum(F.when((size >= COMMON) & (size < LARGE), value.cast(LARGE_TYPE))),
        "outside": F.sum(F.when(~(size < LARGE), value)),
        "n": F.count(value),
    }


def exact_total(parts: dict[str, Column]) -> Column:
    """The sum behind its parts; NULL without a value."""
    total = sum((F.coalesce(parts[k].cast("double"), F.lit(0.0)) for k in ("tiny", "common", "large", "outside")), F.lit(0.0))
    return F.when(parts["n"] > 0, total)


def exact_sum(col: Column | str) -> Column:
    """Sum that no order of rows changes, of values with any number of places."""
    return exact_total(exact_parts(col))


def exact_mean(col: Column | str) -> Column:
    """Exact sum over the number of values, so that half cents never depend on the task layout."""
    parts = exact_parts(col)
    return exact_total(parts) / parts["n"]
