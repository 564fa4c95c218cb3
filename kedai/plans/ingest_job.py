"""Landing zone to raw zone, each dataset on its own."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kedai.operators.ingest import DatasetSkipped, prepare, sample_dates
from kedai.session import prepare as prepare_session
from kedai.sources.datasets import DATASETS, Dataset
from kedai.sources.periods import FAILED, WRITTEN, Outcome, outcomes_frame
from kedai.sources.readers import scan_landing, scan_raw_mixed
from kedai.sources.reconcile import schema_id
from kedai.sources.sinks import deliver
from kedai.sources.stored import Registration, registration

logger = logging.getLogger(__name__)

AUDIT_SCHEMA = (
    "dataset string, status string, rows_read bigint, rows_written bigint, "
    "rows_failed bigint, rows_dropped bigint, message string"
)

SKIPPED, PARTIAL = "skipped", "partial"


def ingest_dataset(
    spark: SparkSession,
    name: str,
    path: str,
    raw_root: str,
    only_changed: bool = False,
    register: Registration | None = None,
) -> tuple[tuple, list[Outcome]]:
    """One audit row, and the outcome of each of the dataset's periods.

    Rows read are counted while the one write runs, rows written and failed from the files of each
    period. After a write that failed as a whole the rows are counted again, as far as the delivery can
    be read.
    """
    dataset = DATASETS[name]
    seen = Observation()
    landing = None
    try:
        landing = scan_landing(spark, path)
        rows = prepare(landing.observe(seen, F.count(F.lit(1)).alias("n")), dataset)
        if logger.isEnabledFor(logging.DEBUG):
            logger.debug("%s: dates like %s", name, sample_dates(prepare(landing, dataset)).collect())
        found = deliver(rows, raw_root, dataset, only_changed)
        if register:
            register(dataset, found, schema_id(rows.schema))
    except DatasetSkipped as reason:
        logger.warning("%s", reason)
        return (name, SKIPPED, landing.count(), 0, 0, 0, str(reason)), []
    except Exception as error:  # noqa: BLE001 - one dataset must not stop the others
        logger.error("%s: %s", name, error)
        reason = f"{type(error).__name__}: {error}".splitlines()[0]
        return (name, FAILED, *_failed_counts(landing, dataset), reason), []
    failed = [outcome for outcome in found if outcome.status == FAILED]
    lost = sum(outcome.n_rows for outcome in failed)
    written = sum(outcome.n_rows for outcome in found) - lost
    # Change detection reads the delivery apart, so what was seen then is no count of it.
    read = landing.count() if only_changed else _observed(seen, landing)
    status = WRITTEN if not failed else FAILED if len(failed) == len(found) else PARTIAL
    message = f"{len(failed)} of {len(found)} periods failed: {failed[0].message}" if failed else None
    return (name, status, read, written, lost, read - written - lost, message), found


def _observed(counter: Observation, df: DataFrame) -> int:
    """What a counter saw during the write. Spark removes it from a plan that turns out to be empty;
    the rows are counted apart then."""
    try:
        return counter.get["n"]
    except Exception:  # noqa: BLE001 - no metrics arrived
        return df.count()


def _failed_counts(landing: DataFrame | None, dataset: Dataset) -> tuple[int, int, int, int]:
    """Rows read, written, failed and dropped of a delivery whose write failed."""
    try:
        read, dated = landing.count(), prepare(landing, dataset).count()
    except Exception:  # noqa: BLE001 - the delivery itself can't be read
        return 0, 0, 0, 0
    return read, 0, dated, read - dated


def written_periods(spark: SparkSession, raw_root: str) -> DataFrame:
    """Rows of every period of every dataset, counted without reading a data column."""
    counts = []
    for name, dataset in DATASETS.items():
        rows = scan_raw_mixed(spark, raw_root, dataset)
        period = F.concat_ws("-", *dataset.periods).alias("period")
        counted = rows.groupBy(period).agg(F.count("*").alias("n_rows"))
        counts.append(counted.select(F.lit(name).alias("dataset"), "period", "n_rows"))
    return reduce(DataFrame.unionByName, counts)


def ingest(
    spark: SparkSession,
    landing: Mapping[str, str],
    raw_root: str,
    only_changed: bool = False,
    database: str | None = None,
) -> DataFrame:
    """Ingest the given datasets (name -> landing path); returns the audit relation."""
    return ingest_with_outcomes(spark, landing, raw_root, only_changed, database)[0]


def ingest_with_outcomes(
    spark: SparkSession,
    landing: Mapping[str, str],
    raw_root: str,
    only_changed: bool = False,
    database: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The audit relation, and one row for each delivered period: its status, rows, files, attempts.

    A period is replaced as a whole or keeps its old files; one that fails stops no other. A second
    run mends what failed. With ``only_changed`` periods that are delivered again as they are in
    place are told by a digest of their rows and not written. With ``database`` the raw zone is kept
    there as tables, whose partitions are added as periods are written.

    The datasets share no files, so their jobs run side by side: one can use the cluster
    while another moves its finished files in place.
    """

    prepare_session(spark)
    register = registration(spark, raw_root, database) if database else None

    def run(item: tuple[str, str]) -> tuple[tuple, list[Outcome]]:
        return ingest_dataset(spark, *item, raw_root, only_changed, register)

    with ThreadPoolExecutor(max_workers=max(1, len(landing))) as pool:
        rows = list(pool.map(run, landing.items()))
    audit = spark.createDataFrame([row for row, _ in rows], AUDIT_SCHEMA)
    return audit, outcomes_frame(spark, [outcome for _, found in rows for outcome in found])
