"""Raw deliveries that readers see whole or not at all.

A dataset's snapshots lie in ``<root>/<name>__snapshots``: each delivery in a folder of its own below
``data``, and below ``manifests`` a folder for each snapshot that says which delivery each period is read
from. The manifest is written last. A reader takes the newest complete one, or an older one by name.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kedai.session import remove_path
from kedai.sources.datasets import Dataset
from kedai.sources.periods import period_text
from kedai.sources.reconcile import groups, union_all, united
from kedai.sources.sinks import MAX_RECORDS_PER_FILE, with_periods

DELIVERY = "delivery"
MANIFEST = "period string, delivery string, columns string, n_rows bigint"


def _folder(root: str, dataset: Dataset) -> str:
    return f"{root.rstrip('/')}/{dataset.name}__snapshots"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    target, store = _fs(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(target)) if store.exists(target) else []


def snapshots(spark: SparkSession, root: str, dataset: Dataset) -> list[str]:
    """Names of the complete snapshots, oldest first. A manifest is complete when Spark marked it so."""
    base = f"{_folder(root, dataset)}/manifests"

    def complete(name: str) -> bool:
        target, store = _fs(spark, f"{base}/{name}/_SUCCESS")
        return store.exists(target)

    return [name for name in _children(spark, base) if complete(name)]


def manifest(spark: SparkSession, root: str, dataset: Dataset, snapshot: str | None = None) -> dict[str, tuple]:
    """Delivery, columns and rows of each period in a snapshot (default: the newest)."""
    names = snapshots(spark, root, dataset)
    if snapshot is not None and snapshot not in names:
        raise ValueError(f"no snapshot {snapshot} of {dataset.name}")
    if not names:
        return {}
    path = f"{_folder(root, dataset)}/manifests/{snapshot or names[-1]}"
    rows = spark.read.schema(MANIFEST).json(path).collect()  # one row a calendar period
    return {row.period: (row.delivery, row.columns, row.n_rows) for row in rows}


def deliver_snapshot(df: DataFrame, root: str, dataset: Dataset) -> str:
    """Add a delivery: its periods replace those of the snapshot before, others stay; returns the name.

    The rows are written first, where no reader looks, and the manifest last. If anything fails before,
    readers find the snapshot before, and the folder of the delivery is removed by ``expire``.
    """
    spark = df.sparkSession
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    base = _folder(root, dataset)
    path = f"{base}/data/{DELIVERY}={name}"
    (
        with_periods(df, dataset)
        .hint("rebalance", *dataset.periods)
        .sortWithinPartitions(*dataset.periods)
        .write.option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*dataset.periods)
        .parquet(path)
    )
    written = spark.read.schema(dataset.raw_schema).option("basePath", path).parquet(path)
    counts = written.groupBy(period_text(dataset).alias("period")).agg(F.count("*").alias("n")).collect()
    columns = df.schema.json()
    held = manifest(spark, root, dataset) | {row.period: (name, columns, row.n) for row in counts}
    _write_manifest(spark, f"{base}/manifests/{name}", held)
    return name


def _write_manifest(spark: SparkSession, path: str, held: dict[str, tuple]) -> None:
    rows = [(period, *entry) for period, entry in sorted(held.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(path)


def scan_snapshot(
    spark: SparkSession, root: str, dataset: Dataset, snapshot: str | None = None
) -> DataFrame:
    """The rows of a snapshot (default: the newest), columns in the common types of its deliveries.

    Deliveries that agree on types are one scan, limited to the folders that the manifest names.
    """
    held = manifest(spark, root, dataset, snapshot)
    if not held:
        return spark.createDataFrame([], dataset.raw_schema)
    path = f"{_folder(root, dataset)}/data"
    schemas = {text: T.StructType.fromJson(json.loads(text)) for _, text, _ in held.values()}
    periods = dataset.raw_schema.fields[len(dataset.schema.fields) :]
    target = T.StructType([*united(dataset.schema, *schemas.values()).fields, *periods])
    where = F.concat_ws("/", DELIVERY, period_text(dataset))
    frames = []
    for texts, schema in groups(schemas):
        wanted = [f"{delivery}/{period}" for period, (delivery, text, _) in held.items() if text in texts]
        fields = T.StructType([*schema.fields, T.StructField(DELIVERY, T.StringType()), *periods])
        # At most one name for each calendar period; evaluated on folders, not on rows.
        frames.append(spark.read.schema(fields).option("basePath", path).parquet(path).where(where.isin(wanted)))
    return union_all(frames, target)


def expire(spark: SparkSession, root: str, dataset: Dataset, keep: int = 2) -> int:
    """Remove all but the newest snapshots, and deliveries that none of the kept ones reads; returns the
    number of deliveries removed. Run it while nothing is being delivered."""
    base, names = _folder(root, dataset), snapshots(spark, root, dataset)
    used = {entry[0] for name in names[-keep:] for entry in manifest(spark, root, dataset, name).values()}
    for name in set(_children(spark, f"{base}/manifests")) - set(names[-keep:]):
        remove_path(spark, f"{base}/manifests/{name}")
    gone = {name.partition("=")[2] for name in _children(spark, f"{base}/data")} - used
    for name in gone:
        remove_path(spark, f"{base}/data/{DELIVERY}={name}")
    return len(gone)
