"""The raw zone and staging in the catalog."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_ingest import fuel, trade

from kedai.operators import ingest, staging
from kedai.plans.daily import run_daily
from kedai.plans.ingest_job import ingest as ingest_all
from kedai.session import remove_path
from kedai.sources import readers, reconcile, sinks, stored
from kedai.sources.datasets import DATASETS, FUELPRICE, IOWRT_3D


def months(spark, wanted, **columns):
    rows = ingest.prepare(trade(spark, [("abs", dt.date(2020, m, 1), "471", 1.0, 5.0) for m in wanted]), IOWRT_3D)
    return rows.withColumns(columns)


def deliver(spark, rows, root, database):
    found = sinks.deliver(rows, root, IOWRT_3D)
    return stored.register_raw(spark, root, IOWRT_3D, found, reconcile.schema_id(rows.schema), database)


def test_only_touched_partitions_are_registered(spark, tmp_path, monkeypatch):
    root, added = str(tmp_path), []
    add = stored.add_periods
    monkeypatch.setattr(stored, "add_periods", lambda s, t, d, found: added.append(sorted(found)) or add(s, t, d, found))
    view = deliver(spark, months(spark, [1, 2, 3]), root, "reg_raw")
    deliver(spark, months(spark, [3, 4]), root, "reg_raw")
    assert added == [["2020-01", "2020-02", "2020-03"], ["2020-03", "2020-04"]]
    reader = spark.newSession()
    assert reader.table(view).count() == 4
    assert reader.table(view).columns == IOWRT_3D.raw_schema.names
    march = reader.table(view).where("month = '03'")
    plan = march._jdf.queryExecution().executedPlan().toString()
    # The catalog names the one folder that is read.
    assert "InMemoryFileIndex(1 paths)" in plan and "(month#" in plan.split("PartitionFilters")[1]
    assert march.count() == 1


def test_types_and_late_columns_are_united(spark, tmp_path):
    root = str(tmp_path)
    deliver(spark, months(spark, [1], extra=F.lit(1)), root, "typed_raw")
    deliver(spark, months(spark, [2], extra=F.lit(1.5)), root, "typed_raw")
    view = deliver(spark, months(spark, [3]), root, "typed_raw")
    expected = readers.scan_raw_mixed(spark, root, IOWRT_3D)
    found = spark.newSession().table(view)
    assert found.dtypes == expected.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    # A month that comes again with other types leaves nothing behind in its old table.
    deliver(spark, months(spark, [1], extra=F.lit("x")), root, "typed_raw")
    found = {r.month: r.extra for r in spark.table(view).collect()}
    assert found == {"01": "x", "02": "1.5", "03": None}


def test_files_of_other_writers_are_shown(spark, tmp_path):
    folder = tmp_path / "fuelprice" / "year=2017" / "month=03" / "day=05"
    folder.mkdir(parents=True)
    stamp = 1488672000000000000
    rows = {"series_type": ["level"], "ymd_date": pa.array([stamp], pa.timestamp("ns")), "ron95": [2.0]}
    pq.write_table(pa.table(rows), folder / "fuelprice_2017-03-05.parquet", version="2.6")
    sinks.write_raw(ingest.prepare(fuel(spark, ["2017-03-22"]), FUELPRICE), str(tmp_path), FUELPRICE)
    view = stored.register_raw(spark, str(tmp_path), FUELPRICE, database="foreign_raw")
    expected = readers.scan_raw_mixed(spark, str(tmp_path), FUELPRICE)
    found = spark.table(view)
    assert sorted(map(str, found.select(expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_an_older_zone_and_an_absent_dataset(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_raw(months(spark, [1, 2]), root, IOWRT_3D)
    folder = tmp_path / "iowrt_3d"
    for file in [*folder.rglob("part-s*.parquet"), *folder.rglob(".part-s*.crc")]:
        head, _, tail = file.name.partition("part-s")
        file.rename(file.with_name(f"{head}part-{tail.split('-', 1)[1]}"))
    remove_path(spark, f"{folder}/{readers.COLUMNS}")
    views = stored.register_all(spark, root, "older_raw")
    assert {name: spark.table(view).count() for name, view in views.items()} == {
        "iowrt": 0, "iowrt_3d": 2, "fuelprice": 0,
    }
    for name, dataset in DATASETS.items():
        assert spark.table(views[name]).columns == dataset.raw_schema.names


@pytest.mark.parametrize("name", sorted(stored.STAGING_VIEWS))
def test_stored_staging_equals_the_functions(spark, tmp_path, name):
    landing = {
        "iowrt": spark.createDataFrame(
            [("abs", dt.date(2020, 1, 1), 1.0, 2.0, 3.0), ("growth_yoy", dt.date(2020, 1, 1), 1.0, 2.0, None)],
            "series string, date date, sales double, volume double, volume_sa double",
        ),
        "iowrt_3d": trade(spark, [(s, dt.date(2020, 1, 1), g, 1.0, None) for s in ("abs", "x") for g in ("1", "", None)]),
        "fuelprice": fuel(spark, ["2020-01-07", "2020-01-14 10:00:00"]),
    }
    paths = {key: str(tmp_path / key) for key in landing}
    for key, df in landing.items():
        df.write.parquet(paths[key])
    raw = f"views_{name}_raw"
    ingest_all(spark, paths, str(tmp_path / "raw"), database=raw)
    seed = spark.createDataFrame([("1", "a", "b"), ("", "c", "d"), (None, "e", "f")], "group_code string, desc_en string, desc_bm string")
    sinks.publish_table(seed, f"{raw}.lookup")
    stored.register_staging_views(spark, f"{raw}.lookup", raw, f"views_{name}_staging")
    sources = {key: readers.scan_raw_mixed(spark, str(tmp_path / "raw"), d) for key, d in DATASETS.items()}
    expected = staging.stage(sources, seed)[name]
    found = spark.newSession().table(f"views_{name}_staging.{name}")
    assert found.dtypes == expected.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_daily_run_keeps_the_catalog(spark, tmp_path):
    trade(spark, [("abs", dt.date(2020, 1, 1), "471", 1.0, 1.0)]).write.parquet(str(tmp_path / "trade"))
    seed = tmp_path / "lookup.csv"
    seed.write_text("group_code,desc_en,desc_bm\n471,Retail,Runcit\n")
    run_daily(
        spark, {"iowrt_3d": str(tmp_path / "trade")}, str(seed), str(tmp_path / "raw"), "kept_marts",
        str(tmp_path / "star"), as_of=dt.date(2020, 2, 1), only_changed=True, raw_database="kept_raw",
        staging_database="kept_staging",
    )
    reader = spark.newSession()
    assert reader.table("kept_staging.stg_iowrt_3d").first().sales_value_rm_mil == 1.0
    assert reader.table("kept_staging.stg_msic_lookup").first().group_desc_en == "Retail"
    assert reader.table("kept_staging.stg_iowrt").isEmpty()
