"""From a delivered dataset to rows ready for the raw zone."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kedai.functions.dates import DATETIME_TYPES, arrival_timestamp
from kedai.sources.datasets import DATE_COLUMN, DAILY, Dataset

logger = logging.getLogger(__name__)

LANDING_DATE = "date"


class DatasetSkipped(Exception):
    """The delivered dataset lacks what the raw zone needs; it is not written."""


def rename_columns(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Move reserved-word columns to their raw names.

    Without the date column the dataset is skipped; other absent columns only warn.
    """
    if dataset.renames and LANDING_DATE not in df.columns:
        raise DatasetSkipped(f"{dataset.name}: no '{LANDING_DATE}' column")
    for old in dataset.renames:
        if old not in df.columns:
            logger.warning("%s: no '%s' column to rename", dataset.name, old)
    present = {old: new for old, new in dataset.renames.items() if old in df.columns}
    return df.withColumnsRenamed(present)


def parse_dates(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Lenient datasets turn unreadable dates into NULL; the others pass through."""
    data_type = df.schema[DATE_COLUMN].dataType
    if not dataset.lenient_dates or isinstance(data_type, T.LongType):
        return df
    return df.withColumn(DATE_COLUMN, arrival_timestamp(F.col(DATE_COLUMN), data_type))


def require_dates(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Refuse a dataset whose date column is missing or is not a date."""
    if DATE_COLUMN not in df.columns:
        raise DatasetSkipped(f"{dataset.name}: no '{DATE_COLUMN}' column")
    data_type = df.schema[DATE_COLUMN].dataType
    accepted = DATETIME_TYPES + ((T.LongType,) if dataset.nanos_dates else ())
    if not isinstance(data_type, accepted):
        raise DatasetSkipped(
            f"{dataset.name}: '{DATE_COLUMN}' is {data_type.simpleString()}, not a date"
        )
    return df.withColumn(DATE_COLUMN, arrival_timestamp(F.col(DATE_COLUMN), data_type))


def sample_dates(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few date values for the log."""
    return df.select(DATE_COLUMN).limit(rows)


def drop_null_dates(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=[DATE_COLUMN])


def prepare(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Rename, parse, check and clean in one lazy plan, so the write is a single scan."""
    renamed = rename_columns(df, dataset)
    return drop_null_dates(require_dates(parse_dates(renamed, dataset), dataset))


def period_start(dataset: Dataset):
    """First day of the period a row belongs to."""
    unit = "day" if dataset.periods == DAILY else "month"
    return F.date_trunc(unit, DATE_COLUMN).cast("date")


def distinct_periods(df: DataFrame, dataset: Dataset) -> DataFrame:
    return df.select(period_start(dataset).alias("period")).distinct()


def period_subset(df: DataFrame, dataset: Dataset, start) -> DataFrame:
    """Rows of the period that begins on ``start``.

    A half-open range on the plain column, which reaches the parquet statistics; a
    truncated column would not.
    """
    first = F.lit(start).cast("date")
    after = F.date_add(first, 1) if dataset.periods == DAILY else F.add_months(first, 1)
    return df.where((F.col(DATE_COLUMN) >= first) & (F.col(DATE_COLUMN) < after))
