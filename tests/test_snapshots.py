"""Snapshots of the raw zone, and the stored month state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_ingest import fuel, trade

from kedai.operators import ingest, intermediate
from kedai.operators.staging import stg_fuelprice
from kedai.plans import month_state
from kedai.sources import readers, sinks, snapshots
from kedai.sources.datasets import FUELPRICE, IOWRT_3D


def months(spark, sales, wanted=(1, 2, 3)):
    return ingest.prepare(trade(spark, [("abs", dt.date(2020, m, 1), "471", sales, 1.0) for m in wanted]), IOWRT_3D)


def sales(spark, root, snapshot=None):
    rows = snapshots.scan_snapshot(spark, root, IOWRT_3D, snapshot)
    return {r.month: r.sales for r in rows.collect()}


@pytest.mark.parametrize("step", ["rows", "counts", "manifest", "marker"])
def test_a_delivery_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    first = snapshots.deliver_snapshot(months(spark, 1.0), root, IOWRT_3D)
    before = {"01": 1.0, "02": 1.0, "03": 1.0}
    late = months(spark, 9.0, (2, 3, 4))
    if step == "rows":
        broken = F.when(F.month("ymd_date") == 4, F.raise_error(F.lit("killed"))).cast("double")
        late = late.withColumn("sales", F.coalesce(broken, F.col("sales")))
    if step == "counts":
        monkeypatch.setattr(snapshots, "manifest", lambda *_: 1 / 0)
    if step == "manifest":
        monkeypatch.setattr(snapshots, "_write_manifest", lambda *_: 1 / 0)
    if step == "marker":  # the manifest's file is there, but Spark did not get to say that it is complete
        write = snapshots._write_manifest

        def killed(spark, path, held):
            write(spark, path, held)
            (tmp_path / path.removeprefix(root).lstrip("/") / "_SUCCESS").unlink()
            raise OSError("killed")

        monkeypatch.setattr(snapshots, "_write_manifest", killed)
    with pytest.raises(Exception, match="killed|zero"):
        snapshots.deliver_snapshot(late, root, IOWRT_3D)
    monkeypatch.undo()
    assert snapshots.snapshots(spark, root, IOWRT_3D) == [first]
    assert sales(spark, root) == before
    snapshots.deliver_snapshot(months(spark, 9.0, (2, 3, 4)), root, IOWRT_3D)
    assert sales(spark, root) == {"01": 1.0, "02": 9.0, "03": 9.0, "04": 9.0}
    assert sales(spark, root, first) == before
    # The torn delivery goes, if it left anything; the first one still holds January.
    assert snapshots.expire(spark, root, IOWRT_3D, keep=1) == (0 if step == "rows" else 1)
    assert sales(spark, root) == {"01": 1.0, "02": 9.0, "03": 9.0, "04": 9.0}
    with pytest.raises(ValueError, match="no snapshot"):
        sales(spark, root, first)


def test_snapshots_of_other_types_and_of_nothing(spark, tmp_path):
    root = str(tmp_path)
    assert snapshots.scan_snapshot(spark, root, IOWRT_3D).isEmpty()
    snapshots.deliver_snapshot(months(spark, 1.5), root, IOWRT_3D)
    snapshots.deliver_snapshot(months(spark, 2.0, [2]).withColumn("sales", F.lit("n/a")), root, IOWRT_3D)
    rows = snapshots.scan_snapshot(spark, root, IOWRT_3D)
    assert {r.month: r.sales for r in rows.collect()} == {"01": "1.5", "02": "n/a", "03": "1.5"}
    assert rows.columns == IOWRT_3D.raw_schema.names
    assert {p: n for p, (_, _, n) in snapshots.manifest(spark, root, IOWRT_3D).items()} == {
        "2020-01": 1, "2020-02": 1, "2020-03": 1,
    }


def test_only_named_folders_are_read(spark, tmp_path):
    root = str(tmp_path)
    for value in (1.0, 2.0, 3.0):
        snapshots.deliver_snapshot(months(spark, value), root, IOWRT_3D)
    plan = snapshots.scan_snapshot(spark, root, IOWRT_3D)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws(/, delivery" in plan
    assert set(sales(spark, root).values()) == {3.0}


# --- month state -----------------------------------------------------------------------------


def prices(spark, days):
    return ingest.prepare(fuel(spark, days), FUELPRICE)


def full_build(spark, root):
    staged = stg_fuelprice(readers.scan_raw_mixed(spark, root, FUELPRICE))
    return sorted(map(str, intermediate.int_fuelprice_monthly(staged).collect()))


def test_a_refresh_reads_the_touched_month_and_equals_the_full_build(spark, tmp_path):
    root, state = str(tmp_path / "raw"), str(tmp_path / "state")
    sinks.write_raw(prices(spark, ["2020-01-07", "2020-01-14", "2020-02-04", "2020-03-03"]), root, FUELPRICE)
    month_state.refresh_state(spark, root, state)
    again = prices(spark, ["2020-01-14", "2020-01-14"]).withColumn("ron95", F.col("ron95") + F.lit(0.01))
    found = sinks.deliver(again, root, FUELPRICE)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "state").rglob("*.parquet") if "month=01" not in str(f)}
    refreshed = month_state.refresh_state(spark, root, state, [o.period for o in found])
    assert sorted(map(str, month_state.averages(refreshed).collect())) == full_build(spark, root)
    assert len(before) == 2 and all(f.stat().st_mtime_ns == at for f, at in before.items())
    raw = readers.scan_raw_mixed(spark, root, FUELPRICE).where(month_state.in_months([("2020", "01")]))
    filters = raw._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert filters.lstrip("(").startswith("concat_ws") and raw.count() == 3
    assert month_state.refresh_state(spark, root, state, []).count() == 3


def test_states_of_parts_add_up(spark, sf_dir):
    from kedai import fixtures as fx

    staged = stg_fuelprice(fx.raw_fuelprice(spark, sf_dir))
    part = F.pmod(F.xxhash64("record_date", "ron95_price_rm"), F.lit(3))
    states = [month_state.fuel_state(staged.where(part == k)) for k in range(3)]
    whole = month_state.add_states(states[0].unionByName(states[1]).unionByName(states[2]))
    expected = sorted(map(str, intermediate.int_fuelprice_monthly(staged).collect()))
    assert sorted(map(str, month_state.averages(whole).collect())) == expected
