"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Query semantics depend on these two: calendar fields and epoch conversions are
# defined in UTC, and parquet files with nanosecond timestamps are read as longs.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

# How this library's plans run in sessions that it builds itself.
# A bucketed scan is one task per bucket, which a hot group or a large fact outgrows;
# partial aggregates and a small shuffle do not. Tables are still written in buckets.
# A writer task with few bytes may still have thousands of period files to create, so
# merging small shuffle partitions stops earlier than at the default of 1 MB.
EXECUTION = {
    "spark.sql.sources.bucketing.enabled": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}

# Physical settings for a cluster. Shuffles start fine-grained and AQE merges them
# to about one advisory size per task; hot join keys are split by the skew join.
PHYSICAL = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
}

_local_dirs: dict[str, str] = {}
_work_paths: dict[str, list[str]] = {}


def build_session(
    app_name: str = "kedai",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the library's settings; ``conf`` overrides the physical ones."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**PHYSICAL, "spark.ui.enabled": "false"}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**EXECUTION, **settings, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on; the session's tuning is left alone."""
    for key, value in SEMANTICS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _work_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = folder.get() if folder.isDefined() else None
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if not re.match(r"local(\[|$)", master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", master)
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="kedai-")
    return _local_dirs[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which every executor can reach.

    The folder is the user's statement of what is shared: a mounted file system may well be named
    by a plain path, so schemes are not judged. Without the setting a cluster is refused.
    """
    path = f"{_work_root(spark).rstrip('/')}/kedai/{name}-{uuid.uuid4().hex}"
    _work_paths.setdefault(spark.conf.get("spark.app.id", ""), []).append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder that the library wrote, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.delete(target, True)


def release(spark: SparkSession) -> int:
    """Delete all work folders of this session; call it when results have been consumed."""
    paths = _work_paths.pop(spark.conf.get("spark.app.id", ""), [])
    return sum(remove_path(spark, path) for path in paths)
