"""Commit of a delivery period by period, each with its own outcome."""

from __future__ import annotations

import json
import logging
import os
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kedai.session import remove_path
from kedai.sources.datasets import Dataset

logger = logging.getLogger(__name__)

# Folders beside a dataset's periods, and beside datasets; scans skip names like these.
PERIODS = "_periods"
INCOMING = "_incoming"

WRITTEN, UNCHANGED, FAILED = "written", "unchanged", "failed"
ATTEMPTS, PAUSE_SECONDS, THREADS = 3, 0.2, 16

OUTCOMES = (
    "dataset string, period string, status string, n_rows bigint, n_files int, attempts int, message string"
)


@dataclass(frozen=True)
class Outcome:
    """What became of one period of a delivery."""

    dataset: str
    period: str
    status: str
    n_rows: int
    n_files: int
    attempts: int
    message: str | None = None


def period_text(dataset: Dataset) -> Column:
    """The period of a row with period columns, as zero-padded text."""
    return F.concat_ws("-", *dataset.periods)


def period_folder(dataset: Dataset, period: str) -> str:
    parts = zip(dataset.periods, period.split("-"), strict=True)
    return "/".join(f"{name}={value}" for name, value in parts)


# --- change detection ------------------------------------------------------------------------


def digests(rows: DataFrame, dataset: Dataset) -> dict[str, str]:
    """A digest of the rows of each period that their order doesn't change; one row a period is
    collected. Sums of two independent hashes and the number of rows: copies count."""
    columns = sorted(set(rows.columns) - set(dataset.periods))
    first = F.xxhash64(*columns).cast("decimal(38,0)")
    second = F.xxhash64(F.lit("again"), *columns).cast("decimal(38,0)")
    parts = F.concat_ws(":", F.count("*"), F.sum(first), F.sum(second))
    found = rows.groupBy(period_text(dataset).alias("period")).agg(parts.alias("digest"))
    return {row.period: row.digest for row in found.collect()}


def recorded_digests(spark: SparkSession, path: str) -> dict[str, str]:
    """The digest of each period's files as last committed, with their columns' name in front."""
    schema = "period string, digest string, at bigint"
    try:
        rows = spark.read.schema(schema).json(f"{path}/{PERIODS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    last = rows.groupBy("period").agg(F.max_by("digest", "at").alias("digest"))
    return {row.period: row.digest for row in last.collect()}


def record_digests(spark: SparkSession, path: str, found: dict[str, str]) -> None:
    at = time.time_ns()
    lines = [(json.dumps({"period": p, "digest": d, "at": at}),) for p, d in sorted(found.items())]
    if lines:
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(f"{path}/{PERIODS}")


# --- commit ----------------------------------------------------------------------------------


class Store:
    """Folders and files of a delivery, in whatever store they lie."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._store = self._path(root).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return self._store.exists(self._path(path))

    def folder(self, path: str) -> None:
        if not self._store.mkdirs(self._path(path)):
            raise OSError(f"no folder {path}")

    def move(self, old: str, new: str) -> bool:
        return self._store.rename(self._path(old), self._path(new))


def _reason(error: Exception) -> str:
    """The first line of an error, that of the store where it comes from there."""
    cause = getattr(error, "java_exception", None)
    return (str(cause) if cause else f"{type(error).__name__}: {error}").splitlines()[0]


def _replace(store: Store, files: list[str], target: str, aside: str, name: str) -> None:
    """Put files in the place of a period's folder; the old folder comes back if that fails."""
    parent = os.path.dirname(target)
    store.folder(parent)
    replaced = store.exists(target)
    if replaced and not store.move(target, aside):
        raise OSError(f"{target} can't be replaced")
    try:
        store.folder(target)
        for file in files:
            base = os.path.basename(file).removeprefix("part-")
            if not store.move(file, f"{target}/part-{name}-{base}"):
                raise OSError(f"{file} can't be moved")
    except Exception:
        # Files that were moved go back, so that another attempt finds them.
        for file in files:
            base = os.path.basename(file).removeprefix("part-")
            moved = f"{target}/part-{name}-{base}"
            if not store.exists(file) and store.exists(moved):
                store.move(moved, file)
        if replaced:
            store.move(target, f"{aside}-failed")
            store.move(aside, target)
        raise


def commit(
    spark: SparkSession,
    incoming: str,
    path: str,
    dataset: Dataset,
    name: str,
    attempts: int = ATTEMPTS,
) -> list[Outcome]:
    """Move every period below ``incoming`` into the dataset's folder, side by side.

    A period's rows are counted from its written files. A period that can't be moved is tried
    ``attempts`` times, then reported as failed with its old files in place; the others are not
    touched by that. Files get the name of their columns, by which scans tell their types.
    """
    written = spark.read.option("basePath", incoming).schema(dataset.raw_schema).parquet(incoming)
    file = F.col("_metadata.file_path").alias("file")
    found = written.groupBy(period_text(dataset).alias("period"), file).agg(F.count("*").alias("n")).collect()
    periods: dict[str, list] = {}
    for row in found:
        periods.setdefault(row.period, []).append(row)
    store = Store(spark, path)
    aside = f"{incoming}/{INCOMING}-old"
    store.folder(aside)

    def move(period: str) -> Outcome:
        rows = periods[period]
        counted = (dataset.name, period)
        size = sum(row.n for row in rows)
        folder = period_folder(dataset, period)
        target = f"{path}/{folder}"
        files = [f"{incoming}/{folder}/{os.path.basename(row.file)}" for row in rows]
        for attempt in range(1, attempts + 1):
            try:
                _replace(store, files, target, f"{aside}/{period}-{attempt}", name)
                return Outcome(*counted, WRITTEN, size, len(rows), attempt)
            except Exception as error:  # noqa: BLE001 - one period must not stop the others
                message = _reason(error)
                logger.warning("%s %s, attempt %d: %s", *counted, attempt, message)
                if attempt < attempts:
                    time.sleep(PAUSE_SECONDS * attempt)
        return Outcome(*counted, FAILED, size, 0, attempts, message)

    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(move, sorted(periods)))


def incoming_path(root: str, dataset: Dataset) -> str:
    """A fresh folder for a delivery, in the store of the raw zone."""
    return f"{root.rstrip('/')}/{INCOMING}/{dataset.name}-{uuid.uuid4().hex}"


def changed(
    spark: SparkSession, rows: DataFrame, path: str, dataset: Dataset, name: str
) -> tuple[DataFrame, dict[str, str], list[Outcome]]:
    """Rows of periods that differ from what is in place, all fresh digests, and outcomes of the rest."""
    fresh = {period: f"{name}:{digest}" for period, digest in digests(rows, dataset).items()}
    known, store = recorded_digests(spark, path), Store(spark, path)
    same = [
        period
        for period, digest in sorted(fresh.items())
        if known.get(period) == digest and store.exists(f"{path}/{period_folder(dataset, period)}")
    ]
    kept = [
        Outcome(dataset.name, period, UNCHANGED, int(fresh[period].split(":")[1]), 0, 0) for period in same
    ]
    if same:
        # One row for each calendar period.
        gone = F.broadcast(spark.createDataFrame([(period,) for period in same], "__period string"))
        rows = rows.join(gone, period_text(dataset) == F.col("__period"), "left_anti")
    return rows, fresh, kept


def remove_incoming(spark: SparkSession, incoming: str) -> None:
    remove_path(spark, incoming)


def outcomes_frame(spark: SparkSession, found: Iterable[Outcome]) -> DataFrame:
    rows = [(o.dataset, o.period, o.status, o.n_rows, o.n_files, o.attempts, o.message) for o in found]
    return spark.createDataFrame(rows, OUTCOMES)
