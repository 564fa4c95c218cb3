"""Reading tables, storing intermediate relations, and word helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kedai.session import work_path

# Rows and bytes of one Arrow batch: texts may be long, so a batch holds less than by default.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20

WORD_SPACE = "\\x20\\x09-\\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand Python tasks at most ``BATCH_ROWS`` rows at a time, of about ``BATCH_BYTES`` bytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a relation below the shared work folder and read it back.

    This cuts the lineage and gives Spark the relation's size; a lost executor takes nothing along.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_slots(df: DataFrame) -> int:
    """Partitions for work that follows the input's size rather than its shuffles."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def batch_rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, one batch in memory at a time."""
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def column_batches(
    parts: Iterator[list[np.ndarray]], names: list[str], rows: int = 1 << 17
) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``rows`` rows from many short column sets."""
    held: list[list[np.ndarray]] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(column)) for column in zip(*held, strict=True)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= rows or len(held) >= rows:
            yield batch()
            size = 0
    if held:
        yield batch()


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the constants are SplitMix64's)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
