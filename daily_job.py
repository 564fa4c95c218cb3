"""spark-submit entry of the daily run.

    spark-submit daily_job.py --raw-root s3a://lake/raw --seed s3a://lake/lookup.csv \
        --landing iowrt=… --landing iowrt_3d=… --landing fuelprice=… \
        --namespace marts --root s3a://lake/processed [--gate]

Exits with 1 if arguments are missing, a dataset failed, or a test failed at severity error.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys

from kedai.plans.daily import ChecksFailed, run_daily
from kedai.plans.ingest_job import FAILED, PARTIAL
from kedai.session import build_session
from kedai.sources.datasets import DATASETS

logger = logging.getLogger("daily_job")


def _landing(text: str) -> tuple[str, str]:
    name, _, path = text.partition("=")
    if name not in DATASETS or not path:
        raise argparse.ArgumentTypeError(f"expected one of {sorted(DATASETS)} as name=path")
    return name, path


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0], exit_on_error=False)
    parser.add_argument("--landing", type=_landing, action="append", required=True)
    parser.add_argument("--seed", required=True)
    parser.add_argument("--raw-root", required=True)
    parser.add_argument("--namespace")
    parser.add_argument("--root")
    parser.add_argument("--as-of", type=dt.date.fromisoformat)
    parser.add_argument("--gate", action="store_true")
    parser.add_argument("--only-changed", action="store_true")
    parser.add_argument("--raw-database")
    parser.add_argument("--staging-database")
    return parser.parse_args(arguments)


def main(arguments: list[str]) -> int:
    try:
        options = parse(arguments)
    except (argparse.ArgumentError, SystemExit) as error:
        logger.error("%s", error)
        return 1
    spark = build_session("kedai-daily")
    try:
        audit, _, checks = run_daily(
            spark,
            dict(options.landing),
            options.seed,
            options.raw_root,
            options.namespace,
            options.root,
            as_of=options.as_of,
            gate=options.gate,
            only_changed=options.only_changed,
            raw_database=options.raw_database,
            staging_database=options.staging_database,
        )
    except ChecksFailed as failed:
        logger.error("tests failed: %s", failed)
        return 1
    audit.show(truncate=False)
    results = checks.collect()  # one row per test
    for row in results:
        logger.info("%s", row)
    failed = any(r.status == "fail" for r in results)
    return 1 if failed or not audit.where(audit["status"].isin(FAILED, PARTIAL)).isEmpty() else 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main(sys.argv[1:]))
