"""Distributed operators against plain Python on random rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from kedai.operators import dimensions as dims
from kedai.operators import intermediate, quality
from kedai.plans import analytics, marts

SEEDS = [1, 2, 3]


def month(index):
    return dt.date(2015 + index // 12, index % 12 + 1, 1)


def cents(value):
    return None if value is None else round(value * 100) / 100


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("months", [1, 12])
def test_growth(spark, seed, months):
    rnd = random.Random(seed)
    sales = {
        (code, i): float(rnd.choice([0, 4, 8, 10, 16, 25, 50]))
        for code in "abc"
        for i in range(40)
        if rnd.random() < 0.7
    }
    rows = [(month(i), code, value, value * 2) for (code, i), value in sales.items()]
    df = spark.createDataFrame(
        rows,
        "record_date date, msic_group_code string, sales_value_rm_mil double, volume_index double",
    )
    got = {
        (r.msic_group_code, r.record_date): (r.sales_growth, r.volume_growth)
        for r in analytics.growth(df, months).collect()
    }

    def expected(code, i):
        base = sales.get((code, i - months))
        return cents((sales[code, i] - base) / base * 100) if base else None

    assert len(got) == len(sales)
    for code, i in sales:
        want = expected(code, i)
        for value in got[code, month(i)]:
            assert value == want or value == pytest.approx(want, abs=0.011)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("build", [dims.dim_msic_group, dims.dim_msic_group_maxstruct])
def test_best_description(spark, seed, build):
    rnd = random.Random(seed)
    words = ["", "a", "bb", "ba", "ccc", "é", "éé", None]
    rows = [(rnd.choice("xyz"), rnd.choice(words), rnd.choice(words)) for _ in range(60)]
    df = spark.createDataFrame(
        rows, "msic_group_code string, group_desc_en string, group_desc_bm string"
    )
    got = {r.msic_group_code: (r.group_desc_en, r.group_desc_bm) for r in build(df).collect()}

    def order(pair):
        lengths = [-1 if text is None else len(text) for text in pair]
        texts = [(text is None, text or "") for text in pair]
        return ([-n for n in lengths], texts)

    groups = defaultdict(list)
    for code, *pair in rows:
        groups[code].append(tuple(pair))
    assert got == {code: min(pairs, key=order) for code, pairs in groups.items()}


@pytest.mark.parametrize("seed", SEEDS)
def test_weekly_change(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(120):
        day = dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randrange(150))
        rows.append((day, *[rnd.choice([None, 1.25, 1.5, 2.0, 2.75]) for _ in intermediate.PRICES]))
    ddl = "record_date timestamp, " + ", ".join(f"{p} double" for p in intermediate.PRICES)
    got = {
        (r.product, r.week_start): (r.price_rm, r.change_rm)
        for r in analytics.fuel_change_weekly(spark.createDataFrame(rows, ddl)).collect()
    }
    prices = defaultdict(list)
    for day, *values in rows:
        week = day.date() - dt.timedelta(days=day.weekday())
        for product, value in zip(intermediate.PRICES, values):
            if value is not None:
                prices[product, week].append(value)
    want, before = {}, {}
    for product, week in sorted(prices):
        price = sum(prices[product, week]) / len(prices[product, week])
        want[product, week] = (price, price - before[product] if product in before else None)
        before[product] = price
    assert set(got) == set(want)
    for key, (price, change) in want.items():
        assert got[key][0] == pytest.approx(price, abs=0.006)
        assert (got[key][1] is None) == (change is None)
        assert change is None or got[key][1] == pytest.approx(change, abs=0.016)


@pytest.mark.parametrize("seed", SEEDS)
def test_orphans_duplicates_and_values(spark, seed):
    rnd = random.Random(seed)
    child = [rnd.choice(["a", "b", "c", "d", None]) for _ in range(80)]
    parent = rnd.sample(["a", "b", "c", "d", "e"], 3)
    df = spark.createDataFrame([(c,) for c in child], "k string")
    parents = spark.createDataFrame([(p,) for p in parent], "p string")
    counts = defaultdict(int)
    for c in child:
        counts[c] += 1
    counts.pop(None, None)
    orphans = {c: n for c, n in counts.items() if c not in parent}
    rows = quality.orphan_keys(df, "k", parents, "p").collect()
    assert {r.k: r.n_rows for r in rows} == orphans
    result = quality.relationships(df, "t", "k", parents, "p").first()
    assert result.failures == sum(orphans.values())
    rows = quality.duplicate_keys(df, "k").collect()
    assert {r.k: r.n_rows for r in rows} == {c: n for c, n in counts.items() if n > 1}
    rows = quality.unaccepted_values(df, "k", tuple(parent)).collect()
    assert {r.k: r.n_rows for r in rows} == orphans


@pytest.mark.parametrize("seed", SEEDS)
def test_recent_sales_and_season(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (month(rnd.randrange(30)), rnd.choice("ab"), float(rnd.randrange(100)), 1.0)
        for _ in range(50)
    ]
    trade = spark.createDataFrame(
        rows,
        "record_date date, msic_group_code string, sales_value_rm_mil double, volume_index double",
    )
    ddl = "year_month_date date, " + ", ".join(f"avg_{p} double" for p in intermediate.PRICES)
    fact = marts.fact_measures(trade, spark.createDataFrame([], ddl))
    totals = defaultdict(float)
    for day, _, sales, _ in rows:
        totals[day] += sales
    latest = max(totals)
    year, month_no = divmod(latest.year * 12 + latest.month - 2, 12)
    row = analytics.kpi_recent_sales(fact).first()
    assert (row.latest_month, row.sales_rm_mil) == (latest, totals[latest])
    assert row.previous_sales_rm_mil == totals.get(dt.date(year, month_no + 1, 1))
    season = defaultdict(list)
    for day, total in totals.items():
        season[day.month].append(total)
    for r in analytics.seasonality(fact).collect():
        values = season.pop(r.month)
        assert r.n_years == len(values)
        assert r.avg_sales_rm_mil == pytest.approx(sum(values) / len(values), abs=0.006)
    assert not season
