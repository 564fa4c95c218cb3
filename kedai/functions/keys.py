"""Dimension keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stand-in for a NULL key part and the separator between parts
# decide the hash, and the unknown member is what facts without a group carry.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
UNKNOWN_MEMBER = "UNKNOWN"


def surrogate_key(*cols: Column) -> Column:
    """Lower-case hex md5 over the natural key columns."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def or_unknown(col: Column) -> Column:
    return F.coalesce(col, F.lit(UNKNOWN_MEMBER))
