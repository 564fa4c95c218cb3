import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kedai.operators import ingest
from kedai.operators.staging import stg_fuelprice, stg_iowrt_3d
from kedai.plans.ingest_job import ingest as ingest_all
from kedai.plans.ingest_job import ingest_with_outcomes
from kedai.session import remove_path
from kedai.sources import periods, readers, reconcile, sinks
from kedai.sources.datasets import FUELPRICE, IOWRT, IOWRT_3D


def fuel(spark, dates, kind="string"):
    rows = [("level", d, 2.0, 2.5, 2.1, None) for d in dates]
    ddl = (
        f"series_type string, date {kind}, ron95 double, ron97 double, diesel double, "
        "diesel_eastmsia double"
    )
    return spark.createDataFrame(rows, ddl)


def trade(spark, rows, kind="date"):
    return spark.createDataFrame(
        rows, f"series string, date {kind}, group string, sales double, volume double"
    )


def test_unreadable_fuel_dates_are_dropped(spark):
    landing = fuel(spark, ["2017-03-15", "not a date", None, "2017-03-22 00:00:00"])
    rows = ingest.prepare(landing, FUELPRICE).orderBy("ymd_date").collect()
    assert [r.ymd_date for r in rows] == [dt.datetime(2017, 3, 15), dt.datetime(2017, 3, 22)]


def test_fuel_dates_as_epoch_nanos(spark):
    rows = ingest.prepare(fuel(spark, [1489536000000000000], "bigint"), FUELPRICE).collect()
    assert rows[0].ymd_date == dt.datetime(2017, 3, 15)


@pytest.mark.parametrize("dataset", [IOWRT, IOWRT_3D, FUELPRICE])
def test_missing_date_column_skips(spark, dataset):
    with pytest.raises(ingest.DatasetSkipped):
        ingest.prepare(spark.createDataFrame([("abs", 1.0)], "series string, sales double"), dataset)


def test_missing_group_column_only_warns(spark, caplog):
    landing = spark.createDataFrame(
        [("abs", dt.date(2020, 1, 1), 1.0)], "series string, date date, sales double"
    )
    assert ingest.prepare(landing, IOWRT_3D).columns == ["series", "ymd_date", "sales"]
    assert "group" in caplog.text


def test_text_dates_of_trade_are_refused(spark):
    with pytest.raises(ingest.DatasetSkipped, match="string"):
        ingest.prepare(trade(spark, [("abs", "2020-01-01", "471", 1.0, 1.0)], "string"), IOWRT_3D)


def test_datasets_fail_on_their_own(spark, tmp_path):
    undated = str(tmp_path / "undated")
    spark.createDataFrame([("abs", 1.0)], "series string, sales double").write.parquet(undated)
    good = str(tmp_path / "good")
    trade(spark, [("abs", dt.date(2020, 1, 1), "471", 1.0, 1.0)]).write.parquet(good)
    landing = {"iowrt": undated, "fuelprice": str(tmp_path / "absent"), "iowrt_3d": good}
    raw = str(tmp_path / "raw")
    audit = {r.dataset: r for r in ingest_all(spark, landing, raw).collect()}
    assert {n: r.status for n, r in audit.items()} == {
        "iowrt": "skipped",
        "fuelprice": "failed",
        "iowrt_3d": "written",
    }
    assert audit["iowrt_3d"].rows_written == 1
    assert readers.scan_raw(spark, raw, IOWRT_3D).count() == 1


def test_audit_counts_dropped_rows(spark, tmp_path):
    path = str(tmp_path / "fuel")
    fuel(spark, ["2017-03-15", "nope", "2017-03-22"]).write.parquet(path)
    row = ingest_all(spark, {"fuelprice": path}, str(tmp_path / "raw")).first()
    assert (row.rows_read, row.rows_written, row.rows_failed, row.rows_dropped) == (3, 2, 0, 1)


def test_empty_dataset_is_written_as_nothing(spark, tmp_path):
    path = str(tmp_path / "fuel")
    fuel(spark, []).write.parquet(path)
    row = ingest_all(spark, {"fuelprice": path}, str(tmp_path / "raw")).first()
    assert (row.status, row.rows_written) == ("written", 0)


def test_raw_layout_is_padded_and_survives_the_round_trip(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_raw(ingest.prepare(fuel(spark, ["2017-03-05"]), FUELPRICE), root, FUELPRICE)
    assert os.path.isdir(tmp_path / "fuelprice" / "year=2017" / "month=03" / "day=05")
    for df in (
        readers.scan_raw(spark, root, FUELPRICE),
        readers.scan_raw(spark, root, FUELPRICE, schema=FUELPRICE.raw_schema),
        readers.scan_raw(spark, root, FUELPRICE, merge_schema=True),
    ):
        row = df.first()
        assert (row.year, row.month, row.day) == ("2017", "03", "05")


def test_rewriting_a_period_leaves_the_others(spark, tmp_path):
    root = str(tmp_path)
    months = [dt.date(2020, m, 1) for m in (1, 2, 3)]
    first = trade(spark, [("abs", m, "471", 1.0, 1.0) for m in months])
    sinks.write_raw(ingest.prepare(first, IOWRT_3D), root, IOWRT_3D)
    again = trade(spark, [("abs", months[1], "471", 9.0, 1.0)])
    for _ in range(2):
        sinks.write_raw(ingest.prepare(again, IOWRT_3D), root, IOWRT_3D)
    rows = readers.scan_raw(spark, root, IOWRT_3D).orderBy("ymd_date").collect()
    assert [r.sales for r in rows] == [1.0, 9.0, 1.0]


def test_a_hot_period_is_split_and_small_ones_are_not(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    months = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 12 + 1)
    rows = spark.range(0, 300_000, 1, 8).select(
        F.lit("abs").alias("series"),
        F.make_date(F.lit(2020), months.cast("int"), F.lit(1)).cast("timestamp").alias("ymd_date"),
        F.md5(F.col("id").cast("string")).alias("group_code"),
        F.rand(1).alias("sales"),
        F.rand(2).alias("volume"),
    )
    sinks.write_raw(rows, str(tmp_path), IOWRT_3D)
    files = {
        d: len([f for f in os.listdir(tmp_path / "iowrt_3d" / "year=2020" / d) if f.endswith("parquet")])
        for d in os.listdir(tmp_path / "iowrt_3d" / "year=2020")
    }
    assert files["month=05"] >= 4
    assert readers.scan_raw(spark, str(tmp_path), IOWRT_3D).count() == 300_000


def test_files_are_sorted_by_series(spark, tmp_path):
    day = dt.date(2020, 1, 1)
    kinds = ["growth_yoy", "abs", "growth_mom"] * 50
    rows = trade(spark, [(k, day, "471", 1.0, 1.0) for k in kinds]).repartition(3)
    sinks.write_raw(ingest.prepare(rows, IOWRT_3D), str(tmp_path), IOWRT_3D)
    folder = tmp_path / "iowrt_3d" / "year=2020" / "month=01"
    (file,) = folder.glob("*.parquet")
    series = pq.ParquetFile(file).read().column("series").to_pylist()
    assert series == sorted(kinds)


def test_period_filter_prunes_directories(spark, tmp_path):
    months = [dt.date(2020, m, 1) for m in (1, 2, 3)]
    rows = trade(spark, [("abs", m, "471", 1.0, 1.0) for m in months])
    sinks.write_raw(ingest.prepare(rows, IOWRT_3D), str(tmp_path), IOWRT_3D)
    for df in (
        readers.scan_raw(spark, str(tmp_path), IOWRT_3D),
        readers.scan_raw(spark, str(tmp_path), IOWRT_3D, schema=IOWRT_3D.raw_schema),
    ):
        february = df.where(F.col("month") == "02")
        assert len(february.inputFiles()) >= 1
        plan = february._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        assert february.count() == 1


def test_period_subset_is_half_open(spark):
    days = [dt.date(2020, 1, 31), dt.date(2020, 2, 1), dt.date(2020, 2, 29), dt.date(2020, 3, 1)]
    rows = ingest.prepare(trade(spark, [("abs", d, "471", 1.0, 1.0) for d in days]), IOWRT_3D)
    assert ingest.period_subset(rows, IOWRT_3D, "2020-02-01").count() == 2
    stamps = ingest.prepare(fuel(spark, ["2020-02-01 23:59:59", "2020-02-02"]), FUELPRICE)
    assert ingest.period_subset(stamps, FUELPRICE, "2020-02-01").count() == 1


def test_nanosecond_files_of_another_writer(spark, tmp_path):
    """Raw files written elsewhere with nanosecond stamps read as longs and stage the same."""
    stamps = pa.array([1489536000000000000], pa.timestamp("ns"))
    folder = tmp_path / "fuelprice" / "year=2017" / "month=03" / "day=15"
    folder.mkdir(parents=True)
    fuel_rows = {"series_type": ["level"], "ymd_date": stamps}
    fuel_rows |= {c: [2.0] for c in ("ron95", "ron97", "diesel", "diesel_eastmsia")}
    pq.write_table(pa.table(fuel_rows), folder / "fuelprice_2017-03-15.parquet", version="2.6")
    raw = readers.scan_raw(spark, str(tmp_path), FUELPRICE)
    assert dict(raw.dtypes)["ymd_date"] == "bigint"
    assert stg_fuelprice(raw).first().record_date == dt.datetime(2017, 3, 15)

    folder = tmp_path / "iowrt_3d" / "year=2017" / "month=03"
    folder.mkdir(parents=True)
    trade_rows = {"series": ["abs"], "ymd_date": stamps, "group_code": ["471"]}
    trade_rows |= {"sales": [1.0], "volume": [2.0]}
    pq.write_table(pa.table(trade_rows), folder / "iowrt_3d_2017-03.parquet", version="2.6")
    staged = stg_iowrt_3d(readers.scan_raw(spark, str(tmp_path), IOWRT_3D))
    assert staged.first().record_date == dt.date(2017, 3, 15)


def test_seed_keeps_leading_zeros_and_finds_columns_by_name(spark, tmp_path):
    path = tmp_path / "lookup.csv"
    path.write_text(
        "digits,desc_en,group_code,desc_bm\n3,Growing of crops,011,Tanaman\n3,\"Sale, retail\",471,Runcit\n"
    )
    rows = readers.load_seed(spark, str(path)).orderBy("group_code").collect()
    assert [(r.digits, r.group_code, r.desc_en, r.desc_bm) for r in rows] == [
        ("3", "011", "Growing of crops", "Tanaman"),
        ("3", "471", "Sale, retail", "Runcit"),
    ]


def test_a_column_no_file_has_stages_as_missing(spark, tmp_path):
    landing = spark.createDataFrame(
        [("abs", dt.date(2020, 1, 1), 1.0, 2.0)],
        "series string, date date, sales double, volume double",
    )
    sinks.write_raw(ingest.prepare(landing, IOWRT_3D), str(tmp_path), IOWRT_3D)
    raw = readers.scan_raw(spark, str(tmp_path), IOWRT_3D, merge_schema=True)
    assert raw.first().group_code is None
    assert stg_iowrt_3d(raw).isEmpty()


def test_sample_dates(spark):
    rows = ingest.prepare(fuel(spark, ["2017-03-15"] * 9), FUELPRICE)
    assert len(ingest.sample_dates(rows).collect()) == 5


def test_older_files_without_a_column_read_as_null(spark, tmp_path):
    rows = ingest.prepare(
        trade(spark, [("abs", dt.date(2020, m, 1), "471", 1.0, 5.0) for m in (1, 2)]), IOWRT_3D
    )
    january = F.month("ymd_date") == 1
    sinks.write_raw(rows.where(january).drop("volume"), str(tmp_path), IOWRT_3D)
    sinks.write_raw(rows.where(~january), str(tmp_path), IOWRT_3D)
    for df in (
        readers.scan_raw(spark, str(tmp_path), IOWRT_3D, schema=IOWRT_3D.raw_schema),
        readers.scan_raw(spark, str(tmp_path), IOWRT_3D, merge_schema=True),
    ):
        assert [r.volume for r in df.orderBy("ymd_date").collect()] == [None, 5.0]


def test_mixed_writers_in_one_raw_zone(spark, tmp_path):
    folder = tmp_path / "fuelprice" / "year=2017" / "month=03" / "day=15"
    folder.mkdir(parents=True)
    rows = {"series_type": ["level"], "ymd_date": pa.array([1489536000000000000], pa.timestamp("ns"))}
    rows |= {c: [2.0] for c in ("ron95", "ron97", "diesel")}
    pq.write_table(pa.table(rows), folder / "fuelprice_2017-03-15.parquet", version="2.6")
    sinks.write_raw(ingest.prepare(fuel(spark, ["2017-03-22"]), FUELPRICE), str(tmp_path), FUELPRICE)
    staged = stg_fuelprice(readers.scan_raw_mixed(spark, str(tmp_path), FUELPRICE))
    assert sorted(r.record_date.day for r in staged.collect()) == [15, 22]
    assert readers.scan_raw_mixed(spark, str(tmp_path), IOWRT).isEmpty()


@pytest.mark.parametrize("recorded", [True, False])
def test_late_columns_reach_the_sources(spark, tmp_path, recorded):
    days = [("abs", dt.date(2020, m, 1), "471", 1.0, 5.0) for m in (1, 2, 3)]
    rows = ingest.prepare(trade(spark, days), IOWRT_3D).withColumn("outlets", F.month("ymd_date"))
    month, root = F.month("ymd_date"), str(tmp_path)
    sinks.write_raw(rows.where(month == 1).drop("outlets"), root, IOWRT_3D)
    sinks.write_raw(rows.where(month == 2), root, IOWRT_3D)
    if not recorded:  # a raw zone from before columns were recorded
        remove_path(spark, f"{root}/iowrt_3d/{readers.COLUMNS}")
    sinks.write_raw(rows.where(month == 3).drop("outlets"), root, IOWRT_3D)
    if not recorded:
        remove_path(spark, f"{root}/iowrt_3d/{readers.COLUMNS}")
    source = readers.register_sources(spark, root)["iowrt_3d"]
    for df in (source, spark.table("iowrt_3d")):
        assert [r.outlets for r in df.orderBy("ymd_date").collect()] == [None, 2, None]
    assert source.columns == [*IOWRT_3D.schema.names, "outlets", *IOWRT_3D.periods]


def test_longs_are_dates_only_where_declared(spark):
    with pytest.raises(ingest.DatasetSkipped, match="bigint"):
        ingest.prepare(trade(spark, [("abs", 1489536000000000000, "471", 1.0, 1.0)], "bigint"), IOWRT_3D)
    assert ingest.prepare(fuel(spark, [20200101, 1577836800], "bigint"), FUELPRICE).isEmpty()


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2020/01/07", dt.datetime(2020, 1, 7)),
        ("07 Jan 2020", dt.datetime(2020, 1, 7)),
        ("20200107", dt.datetime(2020, 1, 7)),
        ("1/7/2020", dt.datetime(2020, 1, 7)),
        (" 2020-01-07T05:06:07 ", dt.datetime(2020, 1, 7, 5, 6, 7)),
        ("12:30", None),
        ("20201399", None),
        ("2020-13-01", None),
    ],
)
def test_date_forms(spark, text, expected):
    rows = ingest.prepare(fuel(spark, [text]), FUELPRICE).collect()
    assert [r.ymd_date for r in rows] == ([expected] if expected else [])


def test_seed_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "lookup.csv"
    path.write_text(
        'group_code,desc_en,desc_bm,include_en\n011,"Sale of ""retail"", other",Tanaman,"a\nb"\n'
        '471,"",,x\n'
    )
    first, second = readers.load_seed(spark, str(path)).orderBy("group_code").collect()
    assert tuple(first) == ("011", 'Sale of "retail", other', "Tanaman", "a\nb")
    assert tuple(second) == ("471", "", None, "x")
    bad = tmp_path / "bad.csv"
    bad.write_text("group_code,desc_en\n1,x\n")
    with pytest.raises(ValueError, match="desc_bm"):
        readers.load_seed(spark, str(bad))


def test_columns_of_all_delivered_files_are_kept(spark, tmp_path):
    old = trade(spark, [("abs", dt.date(2020, 1, 1), "471", 1.0, 1.0)])
    old.drop("volume").coalesce(1).write.parquet(str(tmp_path / "in"))
    old.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert set(readers.scan_landing(spark, str(tmp_path / "in")).columns) == set(old.columns)


def test_raw_files_are_snappy(spark, tmp_path):
    sinks.write_raw(ingest.prepare(fuel(spark, ["2017-03-22"]), FUELPRICE), str(tmp_path), FUELPRICE)
    (file,) = (tmp_path / "fuelprice").rglob("*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "SNAPPY"


def test_ingest_in_another_time_zone(spark, tmp_path, conf):
    conf("spark.sql.session.timeZone", "Asia/Kuala_Lumpur")
    path = str(tmp_path / "in")
    trade(spark, [("abs", dt.date(2017, 3, 1), "471", 1.0, 1.0)]).write.parquet(path)
    ingest_all(spark, {"iowrt_3d": path}, str(tmp_path / "raw"))
    assert os.listdir(tmp_path / "raw" / "iowrt_3d" / "year=2017") == ["month=03"]


# --- columns that change their types ---------------------------------------------------------


def _types(spark, root, dataset=IOWRT_3D):
    return dict(readers.scan_raw_mixed(spark, root, dataset).dtypes)


def test_common_types():
    long, double, text = T.LongType(), T.DoubleType(), T.StringType()
    for a, b, expected in [
        (T.IntegerType(), long, long),
        (T.ByteType(), T.ShortType(), T.ShortType()),
        (T.IntegerType(), double, double),
        (T.FloatType(), double, double),
        (T.DecimalType(10, 2), T.IntegerType(), T.DecimalType(12, 2)),
        (T.DecimalType(10, 2), T.DecimalType(6, 4), T.DecimalType(12, 4)),
        (T.DecimalType(38, 2), T.DecimalType(38, 30), double),
        (T.DecimalType(10, 2), double, double),
        (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.BooleanType(), T.IntegerType(), text),
        (T.DateType(), long, text),
        (T.NullType(), long, long),
        (long, text, text),
    ]:
        assert reconcile.common_type(a, b) == reconcile.common_type(b, a) == expected


def test_a_column_that_changes_its_type_is_widened(spark, tmp_path):
    """Whole numbers, then decimals, then text: every delivery stays readable after the next."""
    rows = ingest.prepare(trade(spark, [("abs", dt.date(2020, m, 1), "471", 1.0, 5.0) for m in (1, 2, 3, 4)]), IOWRT_3D)
    root, month = str(tmp_path), F.month("ymd_date")
    extra = {1: (month, "int", ["1"]), 2: (month / 4, "double", ["1.0", "0.5"])}
    extra[3] = (F.lit("three"), "string", ["1", "0.5", "three"])
    for number, (value, kind, expected) in extra.items():
        sinks.write_raw(rows.where(month == number).withColumn("extra", value), root, IOWRT_3D)
        found = readers.scan_raw_mixed(spark, root, IOWRT_3D)
        assert dict(found.dtypes)["extra"] == kind
        assert [str(float(r.extra)) if kind != "string" else r.extra for r in found.orderBy("ymd_date").collect()] == [
            str(float(e)) if kind != "string" else e for e in expected
        ]
    # A month that is delivered again with another type takes it along.
    sinks.write_raw(rows.where(month == 3).withColumn("extra", F.lit(7)), root, IOWRT_3D)
    found = readers.register_sources(spark, root)["iowrt_3d"]
    assert found.columns == [*IOWRT_3D.schema.names, "extra", *IOWRT_3D.periods]
    assert [r.extra for r in found.orderBy("ymd_date").collect()] == ["1", "0.5", "7"]
    assert stg_iowrt_3d(found).count() == 3


def test_a_declared_column_with_another_type(spark, tmp_path):
    rows = ingest.prepare(trade(spark, [("abs", dt.date(2020, m, 1), "471", 1.0, 5.0) for m in (1, 2)]), IOWRT_3D)
    root, month = str(tmp_path), F.month("ymd_date")
    sinks.write_raw(rows.where(month == 1).withColumn("sales", F.lit(3)), root, IOWRT_3D)
    assert _types(spark, root)["sales"] == "double"
    sinks.write_raw(rows.where(month == 2).withColumn("sales", F.lit("2.5")), root, IOWRT_3D)
    found = readers.scan_raw_mixed(spark, root, IOWRT_3D)
    assert dict(found.dtypes)["sales"] == "string"
    staged = stg_iowrt_3d(found).orderBy("record_date").collect()
    assert [r.sales_value_rm_mil for r in staged] == [3.0, 2.5]


def test_type_changes_in_a_zone_without_records(spark, tmp_path):
    rows = ingest.prepare(trade(spark, [("abs", dt.date(2020, m, 1), "471", 1.0, 5.0) for m in (1, 2)]), IOWRT_3D)
    root, month = str(tmp_path), F.month("ymd_date")
    for number, kind in ((1, "int"), (2, "double")):
        sinks.write_raw(rows.where(month == number).withColumn("extra", month.cast(kind)), root, IOWRT_3D)
    folder = tmp_path / "iowrt_3d"
    remove_path(spark, f"{folder}/{readers.COLUMNS}")
    assert _types(spark, root)["extra"] == "double"
    for file in list(folder.rglob("part-s*.parquet")):  # names from before columns had names
        file.rename(file.with_name("part-00000-" + file.name.split("-", 2)[2]))
    for crc in folder.rglob(".part-s*.crc"):
        crc.unlink()
    found = readers.scan_raw_mixed(spark, root, IOWRT_3D)
    assert [r.extra for r in found.orderBy("ymd_date").collect()] == [1.0, 2.0]
    assert [r.month for r in found.orderBy("ymd_date").collect()] == ["01", "02"]


def test_foreign_and_landing_files_that_disagree(spark, tmp_path):
    for number, extra in ((15, pa.array([1], pa.int32())), (16, pa.array([1.5]))):
        folder = tmp_path / "fuelprice" / "year=2017" / "month=03" / f"day={number}"
        folder.mkdir(parents=True)
        nanos = pa.array([dt.datetime(2017, 3, number).timestamp() * 10**9], pa.float64()).cast(pa.int64())
        rows = {"series_type": ["level"], "ymd_date": nanos.cast(pa.timestamp("ns")), "ron95": [2.0], "extra": extra}
        pq.write_table(pa.table(rows), folder / f"fuelprice_{number}.parquet", version="2.6")
    found = readers.scan_raw_mixed(spark, str(tmp_path), FUELPRICE)
    assert sorted((r.day, r.extra) for r in found.collect()) == [("15", 1.0), ("16", 1.5)]
    path = str(tmp_path / "in")
    for value in (F.lit(1), F.lit("x")):
        spark.range(1).select(value.alias("v")).write.mode("append").parquet(path)
    assert sorted(r.v for r in readers.scan_landing(spark, path).collect()) == ["1", "x"]


# --- outcomes of periods ---------------------------------------------------------------------


def _months(spark, sales, months=(1, 2, 3)):
    return ingest.prepare(trade(spark, [("abs", dt.date(2020, m, 1), "471", sales, 1.0) for m in months]), IOWRT_3D)


def _sales(spark, root):
    return [r.sales for r in readers.scan_raw_mixed(spark, root, IOWRT_3D).orderBy("ymd_date").collect()]


def test_a_failing_period_stops_no_other(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    sinks.write_raw(_months(spark, 1.0), root, IOWRT_3D)
    move, tried = periods.Store.move, []

    def broken(store, old, new):
        if "month=02" in new and "part-" in new:
            tried.append(new)
            raise OSError("no space")
        return move(store, old, new)

    monkeypatch.setattr(periods, "PAUSE_SECONDS", 0)
    monkeypatch.setattr(periods.Store, "move", broken)
    found = {o.period: o for o in sinks.deliver(_months(spark, 9.0), root, IOWRT_3D)}
    assert {p: (o.status, o.n_rows, o.attempts) for p, o in found.items()} == {
        "2020-01": ("written", 1, 1),
        "2020-02": ("failed", 1, periods.ATTEMPTS),
        "2020-03": ("written", 1, 1),
    }
    assert "no space" in found["2020-02"].message and len(tried) == periods.ATTEMPTS
    monkeypatch.undo()
    assert _sales(spark, root) == [9.0, 1.0, 9.0]
    assert not list((tmp_path / periods.INCOMING).iterdir())
    with pytest.raises(sinks.PeriodsFailed, match="2020-02"):
        monkeypatch.setattr(periods.Store, "move", broken)
        monkeypatch.setattr(periods, "PAUSE_SECONDS", 0)
        sinks.write_raw(_months(spark, 5.0), root, IOWRT_3D)
    monkeypatch.undo()
    assert _sales(spark, root) == [5.0, 1.0, 5.0]


def test_a_period_is_tried_again(spark, tmp_path, monkeypatch):
    root, failures = str(tmp_path), [OSError("busy"), OSError("busy")]
    move = periods.Store.move

    def flaky(store, old, new):
        if failures and "month=03" in new:
            raise failures.pop()
        return move(store, old, new)

    monkeypatch.setattr(periods, "PAUSE_SECONDS", 0)
    monkeypatch.setattr(periods.Store, "move", flaky)
    found = {o.period: (o.status, o.attempts) for o in sinks.deliver(_months(spark, 2.0), root, IOWRT_3D)}
    assert found == {"2020-01": ("written", 1), "2020-02": ("written", 1), "2020-03": ("written", 3)}
    assert _sales(spark, root) == [2.0, 2.0, 2.0]


def test_audit_of_a_delivery_with_a_failing_period(spark, tmp_path):
    path, raw = str(tmp_path / "in"), tmp_path / "raw"
    days = [("abs", dt.date(y, 1, 1), "471", 1.0, 1.0) for y in (2019, 2020, 2020)] + [("abs", None, "471", 1.0, 1.0)]
    trade(spark, days).write.parquet(path)
    (raw / "iowrt_3d").mkdir(parents=True)
    (raw / "iowrt_3d" / "year=2020").write_text("in the way")
    audit, outcomes = ingest_with_outcomes(spark, {"iowrt_3d": path}, str(raw))
    row = audit.first()
    assert (row.status, row.rows_read, row.rows_written, row.rows_failed, row.rows_dropped) == ("partial", 4, 1, 2, 1)
    assert row.message.startswith("1 of 2 periods failed")
    assert {r.period: r.status for r in outcomes.collect()} == {"2019-01": "written", "2020-01": "failed"}


def test_only_changed_periods_are_written(spark, tmp_path):
    root = str(tmp_path)

    def deliver(rows):
        found = sinks.deliver(rows, root, IOWRT_3D, only_changed=True)
        return [(o.period, o.status, o.n_rows) for o in found]

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "iowrt_3d").rglob("*.parquet")}

    first = _months(spark, 1.0).union(_months(spark, 2.0, [2]))
    assert {status for _, status, _ in deliver(first)} == {"written"}
    before = files()
    assert deliver(first.orderBy(F.desc("sales")).repartition(3)) == [
        ("2020-01", "unchanged", 1), ("2020-02", "unchanged", 2), ("2020-03", "unchanged", 1),
    ]
    assert files() == before
    twice = first.union(_months(spark, 1.0, [3]))  # a repeated row is a change
    assert deliver(twice) == [("2020-01", "unchanged", 1), ("2020-02", "unchanged", 2), ("2020-03", "written", 2)]
    assert _sales(spark, root).count(1.0) == 4
    retyped = twice.withColumn("volume", F.col("volume").cast("int"))
    assert {status for _, status, _ in deliver(retyped)} == {"written"}
    remove_path(spark, f"{root}/iowrt_3d/year=2020/month=01")
    assert deliver(retyped)[0] == ("2020-01", "written", 1)
