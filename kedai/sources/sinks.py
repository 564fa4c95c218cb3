"""Writers for the raw zone and the published tables.

Every partitioned writer sends its rows through a REBALANCE on the layout columns: small
periods share a task, a period that holds a large part of all rows is split over many
tasks, and files come out near the advisory partition size.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kedai.session import remove_path
from kedai.sources import periods
from kedai.sources.datasets import DATE_COLUMN, Dataset
from kedai.sources.periods import Outcome
from kedai.sources.readers import COLUMNS, recorded_schemas, schemas_by_footers
from kedai.sources.reconcile import schema_id

# Date patterns of the period columns (fixed values).
PERIOD_FORMAT = {"year": "yyyy", "month": "MM", "day": "dd"}

FACT_PARTITIONS = ("year", "month")
FACT_BUCKET_COLUMN = "msic_group_key"
FACT_BUCKETS = 16
MAX_RECORDS_PER_FILE = 20_000_000


def with_periods(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Zero-padded period columns derived from the date."""
    return df.withColumns(
        {p: F.date_format(DATE_COLUMN, PERIOD_FORMAT[p]) for p in dataset.periods}
    )


def record_columns(df: DataFrame, path: str) -> str:
    """Record the columns and types of rows that will be written beside their dataset, under a name
    that their files carry; returns the name.

    They are recorded before the write, so no file has columns without a record. The first record of
    a raw zone takes the columns of the files that are already there.
    """
    spark = df.sparkSession
    known = recorded_schemas(spark, path)
    name = schema_id(df.schema)
    found = schemas_by_footers(spark, path) if known is None else {}
    fresh = found | {name: df.schema}
    rows = [(key or None, schema.json()) for key, schema in fresh.items() if schema and key not in (known or {})]
    if rows:
        lines = spark.createDataFrame(rows, "id string, columns string").coalesce(1)
        lines.write.mode("append").json(f"{path}/{COLUMNS}")
    return name


def deliver(
    df: DataFrame, root: str, dataset: Dataset, only_changed: bool = False
) -> list[Outcome]:
    """Replace the periods present in ``df``, each by itself; other periods stay as they are.

    Everything is written beside the raw zone first; then each period is moved in place with an
    outcome of its own: rows counted from its files, attempts, and the reason if it failed, in which
    case its old files stay. With ``only_changed`` periods whose rows are those in place are not written.

    Rows are sorted by period, as the partitioned writer would do anyway, and then by
    series, so that the filter of staging skips pages and row groups.
    """
    spark = df.sparkSession
    path = os.path.join(root, dataset.name)
    name = record_columns(df, path)
    rows, fresh, kept = with_periods(df, dataset), {}, []
    if only_changed:
        rows, fresh, kept = periods.changed(spark, rows, path, dataset, name)
        if fresh and len(kept) == len(fresh):
            return kept
    incoming = periods.incoming_path(root, dataset)
    order = [*dataset.periods, *({dataset.series} & set(df.columns))]
    try:
        (
            rows.hint("rebalance", *dataset.periods)
            .sortWithinPartitions(*order)
            .write.option("compression", "snappy")
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
            .partitionBy(*dataset.periods)
            .parquet(incoming)
        )
        found = periods.commit(spark, incoming, path, dataset, name)
    finally:
        periods.remove_incoming(spark, incoming)
    done = {o.period for o in found if o.status == periods.WRITTEN}
    if only_changed:
        periods.record_digests(spark, path, {p: d for p, d in fresh.items() if p in done})
    return sorted([*found, *kept], key=lambda outcome: outcome.period)


class PeriodsFailed(Exception):
    """Some periods of a delivery could not be put in place; the others were."""


def write_raw(df: DataFrame, root: str, dataset: Dataset, only_changed: bool = False) -> str:
    """``deliver`` where every period has to succeed; returns the dataset's folder."""
    failed = [o for o in deliver(df, root, dataset, only_changed) if o.status == periods.FAILED]
    if failed:
        raise PeriodsFailed("; ".join(f"{o.period}: {o.message}" for o in failed))
    return os.path.join(root, dataset.name)


def publish(df: DataFrame, path: str) -> DataFrame:
    """Full refresh of a parquet relation; returns it as a scan.

    A scan has a known size on disk, so Spark decides by its own threshold whether later
    joins broadcast it.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Full refresh of a catalog table, external if ``path`` is given."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def _bucket_of(column: str, buckets: int):
    """The bucket the table writer puts a row into."""
    return F.pmod(F.hash(column), F.lit(buckets))


def _fact_writer(fact: DataFrame, partitions: tuple[str, ...], buckets: int):
    """Rebalancing on (year, month, bucket) gives each bucket file one writer task, or a few
    for a hot one."""
    layout = [*FACT_PARTITIONS, "_bucket"]
    rows = fact.withColumn("_bucket", _bucket_of(FACT_BUCKET_COLUMN, buckets))
    return (
        rows.hint("rebalance", *layout)
        .drop("_bucket")
        .write.format("parquet")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partitions)
        .bucketBy(buckets, FACT_BUCKET_COLUMN)
        .sortBy(FACT_BUCKET_COLUMN)
    )


def write_fact(
    fact: DataFrame, table: str, path: str | None = None, buckets: int = FACT_BUCKETS
) -> DataFrame:
    """Fact table partitioned by year and month and bucketed on the group key."""
    writer = _fact_writer(fact, FACT_PARTITIONS, buckets).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return fact.sparkSession.table(table)


def write_bucketed_dimension(
    groups: DataFrame, table: str, path: str | None = None, buckets: int = FACT_BUCKETS
) -> DataFrame:
    """Group dimension in the buckets of the fact, for dimensions beyond broadcast size.

    Where ``spark.sql.sources.bucketing.enabled`` is on, fact and dimension join bucket by bucket without
    a shuffle, and a filter on one key reads one bucket.
    """
    writer = (
        groups.repartition(buckets, FACT_BUCKET_COLUMN)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, FACT_BUCKET_COLUMN)
        .sortBy(FACT_BUCKET_COLUMN)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return groups.sparkSession.table(table)


# --- versions --------------------------------------------------------------------------------

# Partition column of tables that hold several versions of a relation.
VERSION = "version"


def write_version(
    df: DataFrame, table: str, version: str, path: str | None = None, is_fact: bool = False
) -> DataFrame:
    """Add one version of a relation to a table, a partition of its own; returns it as a scan.

    Other versions are not touched, and readers that ask for one don't see this. A fact is laid out as
    by ``write_fact`` within its version.
    """
    spark = df.sparkSession
    rows = df.withColumn(VERSION, F.lit(version))
    if is_fact:
        writer = _fact_writer(rows, (VERSION, *FACT_PARTITIONS), FACT_BUCKETS)
    else:
        writer = rows.write.format("parquet").partitionBy(VERSION)
    if path:
        writer = writer.option("path", path)
    writer.mode("append").saveAsTable(table)
    return read_version(spark, table, version, df.columns)


def read_version(spark: SparkSession, table: str, version: str, columns: list[str]) -> DataFrame:
    return spark.table(table).where(F.col(VERSION) == version).select(*columns)


def held_versions(spark: SparkSession, table: str) -> set[str]:
    """Versions with rows in a table, by its partitions."""
    if not spark.catalog.tableExists(table):
        return set()
    found = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {row.partition.split("/")[0].partition("=")[2] for row in found}


def drop_version(spark: SparkSession, table: str, version: str) -> None:
    """Remove one version of a relation with its files."""
    if not spark.catalog.tableExists(table):
        return
    found = [row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    specs = []
    for partition in found:
        parts = [part.partition("=") for part in partition.split("/")]
        if parts[0][2] == version:
            specs.append("(" + ", ".join(f"`{name}` = '{value}'" for name, _, value in parts) + ")")
    if specs:
        listed = ", ".join(f"PARTITION {spec}" for spec in specs)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    remove_path(spark, f"{described.data_type.rstrip('/')}/{VERSION}={version}")
    spark.catalog.refreshTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Remove a table with its files, wherever they are."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    remove_path(spark, described.data_type)


def create_namespace(spark: SparkSession, name: str, root: str | None = None) -> None:
    """A database for published tables, kept where they are."""
    quoted = root.replace("\\", "\\\\").replace("'", "\\'") if root else None
    location = f" LOCATION '{quoted}'" if quoted else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{location}")
