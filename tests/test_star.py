import datetime as dt

import pytest
from pyspark.sql import functions as F

from kedai.operators import dimensions as dims
from kedai.operators import intermediate, joins, quality, staging
from kedai.plans import analytics, marts
from kedai.plans.daily import ChecksFailed, build_star, require_passing, run_daily
from kedai.session import work_path
from kedai.sources import sinks


def lookup(spark, rows):
    return spark.createDataFrame(
        rows, "msic_group_code string, group_desc_en string, group_desc_bm string"
    )


def trade(spark, rows):
    return spark.createDataFrame(
        rows,
        "record_date date, msic_group_code string, sales_value_rm_mil double, volume_index double",
    )


def fuel(spark, rows):
    ddl = "record_date timestamp, " + ", ".join(f"{p} double" for p in intermediate.PRICES)
    return spark.createDataFrame(rows, ddl)


def calendar(spark, first, after):
    return dims.dim_date(dims.date_spine(dims.spine_bounds(spark, first, after)))


@pytest.fixture(scope="module")
def small(spark):
    groups = dims.dim_msic_group(
        lookup(spark, [("471", "Retail", "Runcit"), ("011", "Crops", "Tanaman")])
    )
    days = calendar(spark, dt.date(2020, 1, 1), dt.date(2020, 3, 1))
    prices = intermediate.int_fuelprice_monthly(
        fuel(
            spark,
            [
                (dt.datetime(2020, 1, 7), 2.0, 2.4, None, None),
                (dt.datetime(2020, 1, 14), 3.0, None, None, None),
            ],
        )
    )
    rows = trade(
        spark,
        [
            (dt.date(2020, 1, 1), "471", 10.0, 100.0),
            (dt.date(2020, 2, 1), "011", -1.0, None),
            (dt.date(2020, 3, 1), "999", None, 50.0),
        ],
    )
    return rows, prices, days, groups


def test_filters_and_casts(spark):
    raw = spark.createDataFrame(
        [
            ("abs", dt.date(2020, 1, 1), "046", 1.0, 2.0),
            ("growth_yoy", dt.date(2020, 1, 1), "046", 1.0, 2.0),
            ("abs", dt.date(2020, 1, 1), "", 1.0, 2.0),
            ("abs", dt.date(2020, 1, 1), None, 1.0, 2.0),
        ],
        "series string, ymd_date date, group_code string, sales double, volume double",
    )
    rows = staging.stg_iowrt_3d(raw).collect()
    assert [tuple(r) for r in rows] == [(dt.date(2020, 1, 1), "046", 1.0, 2.0)]


def test_bad_numbers_fail_loudly(spark):
    raw = spark.createDataFrame(
        [("abs", dt.date(2020, 1, 1), "046", "oops", "2")],
        "series string, ymd_date date, group_code string, sales string, volume string",
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_iowrt_3d(raw).collect()


def test_month_averages_skip_nulls_and_keep_empty_ones(small):
    _, prices, _, _ = small
    row = prices.first()
    assert row.year_month_date == dt.date(2020, 1, 1)
    assert (row.avg_ron95_price_rm, row.avg_ron97_price_rm) == (2.5, 2.4)
    assert row.avg_diesel_eastmsia_price_rm is None


@pytest.mark.parametrize("build", [dims.dim_msic_group, dims.dim_msic_group_maxstruct])
def test_longest_description_wins_then_the_smallest(spark, build):
    rows = lookup(
        spark,
        [
            ("471", "long one", "a"),
            ("471", "short", "aaaaaaaa"),
            ("471", "long two", "bb"),
            ("011", "tie b", "x"),
            ("011", "tie a", "y"),
            ("-", None, None),
            ("-", "dash", None),
        ],
    )
    picked = {r.msic_group_code: (r.group_desc_en, r.group_desc_bm) for r in build(rows).collect()}
    assert picked == {"471": ("long two", "bb"), "011": ("tie a", "y"), "-": ("dash", None)}


def test_both_dimension_builds_agree(spark, sf_dir):
    from kedai import fixtures as fx

    rows = staging.stg_msic_lookup(fx.msic_lookup(spark, sf_dir))
    window, aggregate = dims.dim_msic_group(rows), dims.dim_msic_group_maxstruct(rows)
    assert window.exceptAll(aggregate).isEmpty() and aggregate.exceptAll(window).isEmpty()


def test_spine_is_half_open_and_default_end_follows_the_run_date(spark):
    days = dims.date_spine(dims.spine_bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 4)))
    assert [r.full_date.day for r in days.orderBy("full_date").collect()] == [1, 2, 3]
    daily = dims.date_spine(dims.spine_bounds(spark, as_of=dt.date(2017, 1, 31)))
    assert daily.agg(F.max("full_date")).first()[0] == dt.date(2017, 2, 27)
    assert dims.date_spine(dims.spine_bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 1))).isEmpty()


def test_fact_keeps_every_trade_row(small):
    rows, prices, days, groups = small
    fact = marts.fct_retail_sales_monthly(rows, prices, days, groups).orderBy("record_date")
    january, february, march = fact.collect()
    assert (january.date_key, january.avg_ron95_price_rm) == (20200101, 2.5)
    assert january.msic_group_key == "8e6b42f1644ecb1327dc03ab345e618b"
    assert february.avg_ron95_price_rm is None
    assert (march.date_key, march.msic_group_key) == (20200301, "UNKNOWN")
    assert (march.year, march.month) == (2020, 3)


def test_checks_report_what_is_wrong(small):
    rows, prices, days, groups = small
    fact = marts.fct_retail_sales_monthly(rows, prices, days, groups)
    results = quality.summary(quality.star_checks(fact, days, groups)).collect()
    assert len(results) == 16
    bad = {(r.test, r.column_name): (r.failures, r.status) for r in results if r.status != "pass"}
    assert bad == {
        ("not_null", "sales_value_rm_mil"): (1, "warn"),
        ("not_null", "volume_index"): (1, "warn"),
        ("expression_is_true", "sales_value_rm_mil"): (1, "fail"),
        ("relationships", "date_key"): (1, "fail"),
        ("relationships", "msic_group_key"): (1, "fail"),
    }


def test_unique_and_accepted_values_find_offenders(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [tuple(r) for r in quality.duplicate_keys(df, "k").collect()] == [("a", 2)]
    assert quality.unique(df, "t", "k").first().failures == 1
    assert [tuple(r) for r in quality.unaccepted_values(df, "k", ("a",)).collect()] == [("b", 1)]
    assert quality.unique(df.where("k = 'none'"), "t", "k", count_rows=True).first().rows_checked == 0


def test_failing_rows_are_listed(small):
    rows, _, _, _ = small
    check = quality.expression_is_true("sales_value_rm_mil", F.col("sales_value_rm_mil") >= 0)
    assert [r.sales_value_rm_mil for r in quality.failing_rows(rows, check).collect()] == [-1.0]


def test_growth_follows_the_calendar(spark):
    rows = trade(
        spark,
        [
            (dt.date(2019, 1, 1), "471", 100.0, 50.0),
            (dt.date(2019, 3, 1), "471", 0.0, 50.0),
            (dt.date(2019, 4, 1), "471", 10.0, 75.0),
            (dt.date(2020, 1, 1), "471", 150.0, 40.0),
            (dt.date(2020, 2, 1), "471", 120.0, 40.0),
        ],
    )
    yearly = {r.record_date: r for r in analytics.growth_yoy(rows).collect()}
    assert yearly[dt.date(2020, 1, 1)].sales_growth == 50.0
    assert yearly[dt.date(2020, 1, 1)].volume_growth == -20.0
    assert yearly[dt.date(2020, 2, 1)].sales_growth is None
    monthly = {r.record_date: r for r in analytics.growth_mom(rows).collect()}
    assert monthly[dt.date(2019, 3, 1)].sales_growth is None
    assert monthly[dt.date(2019, 4, 1)].sales_growth is None  # base of zero
    assert monthly[dt.date(2020, 2, 1)].sales_growth == -20.0


def test_weekly_change_is_against_the_week_recorded_before(spark):
    rows = fuel(
        spark,
        [
            (dt.datetime(2020, 1, 7), 2.0, None, 1.0, None),
            (dt.datetime(2020, 1, 14), 2.2, 3.0, 1.0, None),
            (dt.datetime(2020, 2, 4), 2.1, 3.5, 1.0, None),
        ],
    )
    changes = analytics.fuel_change_weekly(rows).orderBy("product", "week_start").collect()
    ron95 = [r.change_rm for r in changes if r.product == "ron95_price_rm"]
    assert ron95 == [None, 0.2, -0.1]
    assert {r.product for r in changes} == {
        "ron95_price_rm", "ron97_price_rm", "diesel_peninsular_price_rm"
    }


def test_recent_sales_without_a_previous_month(spark, small):
    rows = trade(spark, [(dt.date(2020, 1, 1), "471", 5.0, 1.0), (dt.date(2020, 3, 1), "471", 7.0, 1.0)])
    row = analytics.kpi_recent_sales(marts.fact_measures(rows, small[1])).first()
    assert (row.latest_month, row.sales_rm_mil) == (dt.date(2020, 3, 1), 7.0)
    assert row.previous_sales_rm_mil is None and row.change_percent is None


def test_facts_from_before_the_first_fuel_month_can_be_left_out(spark, small):
    _, prices, _, _ = small
    rows = trade(spark, [(dt.date(2019, 12, 1), "471", 1.0, 1.0), (dt.date(2020, 1, 1), "471", 2.0, 1.0)])
    kept = marts.since_fuel_start(marts.fact_measures(rows, prices), prices).collect()
    assert [r.sales_value_rm_mil for r in kept] == [2.0]


def test_gate_stops_before_the_fact_is_replaced(spark, small):
    rows, _, _, _ = small
    relations = {
        "stg_iowrt_3d": rows,
        "stg_fuelprice": fuel(spark, [(dt.datetime(2020, 1, 7), 2.0, 2.4, None, None)]),
        "stg_msic_lookup": lookup(spark, [("471", "Retail", "Runcit")]),
    }
    bounds = dims.spine_bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 3, 1))
    sinks.create_namespace(spark, "gated")
    with pytest.raises(ChecksFailed, match="relationships"):
        build_star(relations, bounds, "gated", work_path(spark, "gated"), gate=True)
    assert not spark.catalog.tableExists("gated.fct_retail_sales_monthly")


@pytest.fixture
def delivered(spark, tmp_path):
    """A small delivery of all datasets and the lookup file."""
    landing = {name: str(tmp_path / name) for name in ("iowrt", "iowrt_3d", "fuelprice")}
    months = [dt.date(2020, m, 1) for m in (1, 2)]
    spark.createDataFrame(
        [("abs", m, 20.0, 100.0, 99.0) for m in months],
        "series string, date date, sales double, volume double, volume_sa double",
    ).write.parquet(landing["iowrt"])
    spark.createDataFrame(
        [("abs", m, g, 10.0, 100.0) for m in months for g in ("011", "471")]
        + [("growth_yoy", months[0], "471", 1.0, 1.0)],
        "series string, date date, group string, sales double, volume double",
    ).write.parquet(landing["iowrt_3d"])
    spark.createDataFrame(
        [
            ("level", "2020-01-07", 2.0, 2.4, 2.1, 2.2),
            ("change_weekly", "2020-01-07", 0.1, 0.0, 0.0, 0.0),
        ],
        "series_type string, date string, ron95 double, ron97 double, diesel double, "
        "diesel_eastmsia double",
    ).write.parquet(landing["fuelprice"])
    seed = tmp_path / "lookup.csv"
    seed.write_text("group_code,desc_en,desc_bm\n011,Crops,Tanaman\n471,Retail,Runcit\n471,x,y\n")
    return landing, str(seed)


def test_daily_run_end_to_end(spark, tmp_path, delivered):
    landing, seed = delivered

    def run():
        return run_daily(
            spark,
            landing,
            seed,
            str(tmp_path / "raw"),
            "daily",
            str(tmp_path / "star"),
            as_of=dt.date(2020, 2, 15),
            gate=True,
        )

    audit, star, checks = run()
    assert {r.dataset: r.rows_written for r in audit.collect()} == {
        "iowrt": 2,
        "iowrt_3d": 5,
        "fuelprice": 2,
    }
    assert star.fact.count() == 4
    assert checks.where("status = 'fail'").isEmpty()
    assert checks.count() == 21
    for view in ("iowrt", "stg_iowrt", "stg_iowrt_3d", "stg_fuelprice", "stg_msic_lookup"):
        assert spark.catalog.tableExists(view)
    monthly = spark.sql(
        """
        SELECT d.year_month, g.group_desc_en, SUM(f.sales_value_rm_mil) AS sales
        FROM daily.fct_retail_sales_monthly f
        JOIN daily.dim_date d ON f.date_key = d.date_key
        JOIN daily.dim_msic_group g ON f.msic_group_key = g.msic_group_key
        WHERE f.year = 2020 AND f.month = 2
        GROUP BY ALL ORDER BY ALL
        """
    ).collect()
    assert [tuple(r) for r in monthly] == [("2020-02", "Crops", 10.0), ("2020-02", "Retail", 10.0)]
    first = sorted(map(tuple, star.fact.collect()))
    _, again, _ = run()
    assert sorted(map(tuple, again.fact.collect())) == first


def test_job_exit_codes(spark, tmp_path, delivered):
    import daily_job

    landing, seed = delivered
    arguments = [a for name, path in landing.items() for a in ("--landing", f"{name}={path}")]
    arguments += ["--seed", seed, "--raw-root", str(tmp_path / "raw"), "--namespace", "job"]
    arguments += ["--root", str(tmp_path / "star"), "--as-of", "2020-02-15"]
    assert daily_job.main(arguments) == 0
    assert spark.table("job.fct_retail_sales_monthly").count() == 4
    assert daily_job.main(["--seed", seed]) == 1
    late = [*arguments[:-1], "2017-06-01"]  # the calendar ends before the trade rows
    assert daily_job.main(late) == 1
    assert daily_job.main([*late, "--gate"]) == 1


def test_require_passing_ignores_warnings(spark):
    rows = [("not_null", "t", "c", "warn", 1, "warn")]
    require_passing(
        spark.createDataFrame(
            rows,
            "test string, table_name string, column_name string, severity string, failures long, "
            "status string",
        )
    )


def test_unioned_trade_tags_the_headline(spark):
    headline = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 20.0, 100.0, 99.0)],
        "record_date date, sales_value_rm_mil double, volume_index double, volume_index_sa double",
    )
    union = intermediate.int_trade_unioned(headline, trade(spark, [(dt.date(2020, 1, 1), "471", 1.0, 2.0)]))
    rows = {r.msic_group_code: r.volume_index_sa for r in union.collect()}
    assert rows == {"471": None, "Overall": 99.0}


def test_joins_do_not_multiply(small):
    rows, prices, days, groups = small
    assert joins.join_fuel_month(rows, prices).count() == 3
    assert joins.join_date(rows, days).count() == 3
    assert joins.join_group(rows, groups).count() == 3


@pytest.mark.parametrize("parts", [1, 2, 3, 5, 7, 11, 16])
def test_averages_do_not_depend_on_the_task_layout(spark, sf_dir, parts):
    from kedai import fixtures as fx
    from kedai.operators import staging

    prices = staging.stg_fuelprice(fx.raw_fuelprice(spark, sf_dir))
    lines = staging.stg_iowrt_3d(fx.trade_lines(spark, sf_dir))

    def results(n):
        spread = prices.repartition(n)
        monthly = intermediate.int_fuelprice_monthly(spread)
        measures = marts.fact_measures(lines.repartition(n), monthly)
        frames = [monthly, analytics.fuel_change_weekly(spread), analytics.seasonality(measures)]
        frames.append(analytics.growth_mom(lines.repartition(n)))
        return [sorted(map(str, frame.collect())) for frame in frames]

    assert results(parts) == results(4)


def test_values_that_are_not_numbers_fail(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (-1.0,)], "v double")
    check = quality.expression_is_true("v", F.col("v") >= 0)
    assert quality.row_checks(df, "t", [check]).first().failures == 2


def _star_inputs(spark, code="471", price=1.0, sales=1.0):
    return {
        "stg_iowrt_3d": trade(spark, [(dt.date(2020, 1, 1), code, sales, 1.0)]),
        "stg_fuelprice": fuel(spark, [(dt.datetime(2020, 1, 7), price, 2.4, None, None)]),
        "stg_msic_lookup": lookup(spark, [("471", f"Retail {price}", "Runcit")]),
    }


@pytest.mark.parametrize("how", ["gate", "write"])
def test_a_failed_build_leaves_the_old_star(spark, tmp_path, how):
    namespace, root = f"kept_{how}", str(tmp_path / "it's a root")
    sinks.create_namespace(spark, namespace, str(tmp_path / "db"))
    bounds = dims.spine_bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 3, 1))
    build_star(_star_inputs(spark), bounds, namespace, root, gate=True)
    tables = ("int_fuelprice_monthly", "dim_msic_group", "dim_date", "fct_retail_sales_monthly")
    before = {t: sorted(map(str, spark.table(f"{namespace}.{t}").collect())) for t in tables}
    bad = _star_inputs(spark, code="999", price=9.0)
    if how == "write":
        bad = _star_inputs(spark, price=9.0)
        broken = F.when(F.col("sales_value_rm_mil") > 0, F.raise_error(F.lit("lost"))).cast("double")
        bad["stg_iowrt_3d"] = bad["stg_iowrt_3d"].withColumn("volume_index", broken)
    with pytest.raises(Exception, match="relationships|lost"):
        build_star(bad, bounds, namespace, root, gate=True)
    assert {t: sorted(map(str, spark.table(f"{namespace}.{t}").collect())) for t in tables} == before
    build_star(_star_inputs(spark, sales=5.0), bounds, namespace, root, gate=True)
    fact = spark.table(f"{namespace}.fct_retail_sales_monthly")
    assert [r.sales_value_rm_mil for r in fact.collect()] == [5.0]
    for _ in range(3):
        build_star(_star_inputs(spark), bounds, namespace, root)
    from kedai.plans import daily

    assert len(daily.versions(spark, namespace)) == daily.KEPT_VERSIONS
    folders = [f for table in (tmp_path / "it's a root").iterdir() for f in table.glob("version=*")]
    assert len(folders) == 4 * daily.KEPT_VERSIONS


STAR = ("msic_lookup", "int_fuelprice_monthly", "dim_date", "dim_msic_group", "fct_retail_sales_monthly")


def _seed(spark, price, **more):
    rows = [("471", f"Retail {price}", "Runcit", *more.values())]
    return spark.createDataFrame(rows, ["group_code", "desc_en", "desc_bm", *more])


def _shown(session, namespace):
    """What another session finds under the plain names: the price that marks a version, by relation."""
    code, fuel, _, groups, fact = (session.table(f"{namespace}.{t}") for t in STAR)
    session.table(f"{namespace}.dim_date").count()
    return {
        float(code.first().desc_en.split()[1]),
        fuel.first().avg_ron95_price_rm,
        float(groups.first().group_desc_en.split()[1]),
        fact.first().avg_ron95_price_rm,
    }


def test_all_relations_turn_in_one_step(spark, tmp_path, monkeypatch):
    """Whatever step of a publish fails, another session finds all relations in one version."""
    from kedai.plans import daily

    namespace, root = "pointed", str(tmp_path / "star")
    sinks.create_namespace(spark, namespace, str(tmp_path / "db"))
    bounds = dims.spine_bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 2, 1))
    for price in (1.0, 2.0):
        build_star(_star_inputs(spark, price=price), bounds, namespace, root, seed=_seed(spark, price))
    reader = spark.newSession()
    assert _shown(reader, namespace) == {2.0}
    inputs, seed = _star_inputs(spark, price=3.0), _seed(spark, 3.0, include_en="food")
    # Five writes, the tests, five views, the pointer.
    for step in (0, 4, 5, 6, 8, 11):
        calls = []

        def failing(function, step=step, calls=calls):
            def run(*args, **options):
                calls.append(function.__name__)
                if len(calls) == step + 1:
                    raise OSError(f"lost at {function.__name__}")
                return function(*args, **options)

            return run

        for name in ("write_version", "summary", "_show", "_point"):
            monkeypatch.setattr(daily, name, failing(getattr(daily, name)))
        with pytest.raises(OSError, match="lost"):
            build_star(inputs, bounds, namespace, root, gate=True, seed=seed)
        monkeypatch.undo()
        assert len(calls) == step + 1
        assert _shown(reader, namespace) == {2.0}
        assert len(daily.versions(spark, namespace)) == 2
    build_star(inputs, bounds, namespace, root, gate=True, seed=seed)
    assert _shown(reader, namespace) == {3.0}
    assert reader.table(f"{namespace}.msic_lookup").first().include_en == "food"
    for price in (4.0, 5.0):
        build_star(_star_inputs(spark, price=price), bounds, namespace, root, seed=_seed(spark, price))
        assert _shown(reader, namespace) == {price}
    assert reader.table(f"{namespace}.msic_lookup").columns == ["group_code", "desc_en", "desc_bm"]


def test_views_read_their_version_alone(spark, tmp_path):
    namespace, root = "pruned_version", str(tmp_path / "star")
    sinks.create_namespace(spark, namespace, str(tmp_path / "db"))
    bounds = dims.spine_bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 3, 1))
    for price in (1.0, 2.0):
        build_star(_star_inputs(spark, price=price), bounds, namespace, root, seed=_seed(spark, price))
    view = spark.table(f"{namespace}.fct_retail_sales_monthly").where("year = 2020")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "Subquery" not in plan


def test_a_star_of_plain_tables_is_taken_over(spark, tmp_path):
    """Tables that hold the plain names are kept aside."""
    namespace = "taken_over"
    sinks.create_namespace(spark, namespace, str(tmp_path / "db"))
    spark.range(3).write.saveAsTable(f"{namespace}.dim_date")
    bounds = dims.spine_bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 3, 1))
    build_star(_star_inputs(spark), bounds, namespace, str(tmp_path / "star"))
    assert spark.table(f"{namespace}.dim_date").count() == 60
    assert spark.table(f"{namespace}.dim_date__before").count() == 3


def test_a_dataset_that_never_arrived_does_not_stop_the_fact(spark, tmp_path, delivered):
    landing, seed = delivered
    del landing["iowrt"]
    _, star, checks = run_daily(
        spark, landing, seed, str(tmp_path / "raw"), "partial", str(tmp_path / "star"),
        as_of=dt.date(2020, 2, 15),
    )
    assert star.fact.count() == 4
    assert checks.where("status = 'fail'").isEmpty()


def test_work_folders_are_removed(spark):
    from kedai import session

    path = work_path(spark, "gone")
    spark.range(3).write.parquet(path)
    kept = dict(session._work_paths)
    session._work_paths.clear()
    session._work_paths[spark.conf.get("spark.app.id")] = [path]
    assert session.release(spark) == 1
    session._work_paths.update(kept)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()


def test_published_fact_prunes_partitions(spark, sf_dir):
    from kedai import catalog

    for name in ("kpi_recent_sales", "sales_filtered", "fct_since_fuel_start"):
        plan = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and "fct-" in line]
        # The latest month itself is found on the partition columns alone.
        reads = [line for line in scans if "sales_value_rm_mil" in line]
        assert reads and all("PartitionFilters: []" not in line for line in reads), name
