"""Every operator as a query over the generated tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kedai import fixtures as fx
from kedai.functions import keys, numeric
from kedai.functions.dates import epoch_nanos_to_timestamp
from kedai.operators import dimensions as dims
from kedai.operators import ingest, intermediate, joins, quality, staging
from kedai.plans import analytics, marts, month_state
from kedai.plans.daily import build_star
from kedai.plans.ingest_job import ingest as ingest_all
from kedai.plans.ingest_job import ingest_with_outcomes, written_periods
from kedai.session import prepare, work_path
from kedai.sources import periods, readers, sinks, snapshots, stored
from kedai.sources.datasets import DATASETS, FUELPRICE, IOWRT, IOWRT_3D

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

# Parameters of registered queries; the oracle states the same values.
SUBSET_MONTH = "1998-07-01"
OVERWRITTEN_MONTH = "1997-03-01"
SCHEMA_CHANGE = "1998-01-01"
TYPE_CHANGES = ("1997-01-01", "1998-01-01")
BLOCKED_YEAR = "1997"
FILTER_FIRST, FILTER_LAST = (1997, 11), (1999, 2)
FILTER_GROUPS = ["Brand#11", "Brand#13", "Brand#42"]


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs -----------------------------------------------------------------


def _trade(spark, sf_dir):
    return staging.stg_iowrt_3d(fx.raw_iowrt_3d(spark, sf_dir))


def _trade_lines(spark, sf_dir):
    return staging.stg_iowrt_3d(fx.trade_lines(spark, sf_dir))


def _headline(spark, sf_dir):
    return staging.stg_iowrt(fx.raw_iowrt(spark, sf_dir))


def _fuel(spark, sf_dir):
    return staging.stg_fuelprice(fx.raw_fuelprice(spark, sf_dir))


def _fuel_monthly(spark, sf_dir):
    return intermediate.int_fuelprice_monthly(_fuel(spark, sf_dir))


def _lookup(spark, sf_dir, complete=True):
    return staging.stg_msic_lookup(fx.msic_lookup(spark, sf_dir, complete))


def _days(spark, sf_dir):
    return dims.dim_date(dims.date_spine(fx.calendar_bounds(spark, sf_dir)))


def _groups(spark, sf_dir, complete=True):
    """The group dimension as a published relation, so its size is known to the joins."""
    dimension = dims.dim_msic_group(_lookup(spark, sf_dir, complete))
    return sinks.publish(dimension, work_path(spark, "dim_msic_group"))


def _fact_of(trade, spark, sf_dir, complete=True):
    groups = _groups(spark, sf_dir, complete)
    return marts.fct_retail_sales_monthly(
        trade, _fuel_monthly(spark, sf_dir), _days(spark, sf_dir), groups
    )


def _fact_lines(spark, sf_dir, complete=True):
    return _fact_of(_trade_lines(spark, sf_dir), spark, sf_dir, complete)


def _fact_table(spark, sf_dir):
    """The line-grain fact as published: partitioned by year and month, bucketed by group."""
    path = work_path(spark, "fct")
    table = "kedai_" + path.rsplit("-", 1)[1]
    return sinks.write_fact(_fact_lines(spark, sf_dir), table, path)


def _measures(trade, spark, sf_dir):
    """The fact without its dimension keys, for what only needs months and measures."""
    return marts.fact_measures(trade, _fuel_monthly(spark, sf_dir))


def _land(df: DataFrame, name: str) -> str:
    """Deliver a relation: a parquet folder under its landing names."""
    path = work_path(df.sparkSession, f"landing-{name}")
    fx.as_landing(df).write.parquet(path)
    return path


def _raw_root(spark: SparkSession) -> str:
    return work_path(spark, "raw")


# --- sources -----------------------------------------------------------------------


@query
def scan_landing(spark, sf_dir):
    path = _land(fx.trade_lines(spark, sf_dir), "iowrt_3d")
    return readers.scan_landing(spark, path)


@query
def scan_landing_csv(spark, sf_dir):
    landing = fx.as_landing(fx.awkward_lines(spark, sf_dir))
    path = work_path(spark, "landing-csv")
    landing.write.option("header", True).option("escape", '"').csv(path)
    return readers.scan_landing_csv(spark, path, landing.schema, multi_line=True)


@query
def scan_raw_partitioned(spark, sf_dir):
    root = _raw_root(spark)
    landing = fx.as_landing(fx.raw_iowrt(spark, sf_dir))
    sinks.write_raw(ingest.prepare(landing, IOWRT), root, IOWRT)
    return _zoneless(readers.scan_raw(spark, root, IOWRT))


@query
def scan_merge_schema(spark, sf_dir):
    """Files from before a change lack a column that later files have."""
    root = _raw_root(spark)
    rows = ingest.prepare(fx.as_landing(fx.trade_lines(spark, sf_dir)), IOWRT_3D)
    older = F.col("ymd_date") < SCHEMA_CHANGE
    sinks.write_raw(rows.where(older).drop("volume"), root, IOWRT_3D)
    sinks.write_raw(rows.where(~older), root, IOWRT_3D)
    return _zoneless(readers.scan_raw(spark, root, IOWRT_3D, merge_schema=True))


@query
def scan_raw_mixed_dates(spark, sf_dir):
    """Early periods left by another writer, with nanoseconds for dates, beside later ones."""
    root = _raw_root(spark)
    landing = fx.as_landing(fx.raw_fuelprice(spark, sf_dir))
    rows = sinks.with_periods(ingest.prepare(landing, FUELPRICE), FUELPRICE)
    early = F.col("ymd_date") < SCHEMA_CHANGE
    other = rows.where(early).withColumn("ymd_date", fx.epoch_nanos(F.col("ymd_date")))
    path = f"{root}/{FUELPRICE.name}"
    (
        other.hint("rebalance", *FUELPRICE.periods)
        .write.partitionBy(*FUELPRICE.periods)
        .parquet(path)
    )
    _rename_files(spark, path, FUELPRICE.name)
    sinks.write_raw(rows.where(~early).drop(*FUELPRICE.periods), root, FUELPRICE)
    return _zoneless(readers.scan_raw_mixed(spark, root, FUELPRICE))


def _retyped(rows: DataFrame) -> list[DataFrame]:
    """Deliveries of a column first as whole numbers, then as decimals, then as text."""
    first, second = TYPE_CHANGES
    whole, day = F.col("volume").cast("int"), F.col("ymd_date")
    early = rows.where(day < first).withColumns({"outlets": whole, "volume": whole})
    middle = rows.where((day >= first) & (day < second)).withColumn("outlets", F.col("volume") / 4)
    late = rows.where(day >= second).withColumn("outlets", F.concat(F.lit("n"), whole.cast("string")))
    return [early, middle, late]


@query
def scan_raw_type_change(spark, sf_dir):
    """Deliveries whose columns change their types, read in types that hold all of them."""
    root = _raw_root(spark)
    rows = ingest.prepare(fx.as_landing(fx.trade_lines(spark, sf_dir)), IOWRT_3D)
    for delivery in _retyped(rows):
        sinks.write_raw(delivery, root, IOWRT_3D)
    return _zoneless(readers.scan_raw_mixed(spark, root, IOWRT_3D))


@query
def scan_landing_type_change(spark, sf_dir):
    """One delivery whose files disagree on the types of their columns."""
    path = work_path(spark, "landing-types")
    for rows in _retyped(fx.trade_lines(spark, sf_dir)):
        rows.write.mode("append").parquet(path)
    return readers.scan_landing(spark, path)


def _rename_files(spark, path, name):
    """Give the files below a path names as another writer would."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = store.listFiles(folder, True)
    found = []
    while files.hasNext():
        file = files.next().getPath()
        if file.getName().startswith("part-"):
            found.append(file)
    for number, file in enumerate(found):
        store.rename(file, file.suffix("").getParent().suffix(f"/{name}_{number}.parquet"))


@query
def seed_csv(spark, sf_dir):
    path = work_path(spark, "seed-csv")
    fx.seed_rows(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return sinks.publish(readers.load_seed(spark, path), work_path(spark, "seed"))


def _zoneless(df: DataFrame) -> DataFrame:
    """Show the stored timestamp without a zone, so that values compare plainly, to the microsecond."""
    return df.withColumn("ymd_date", F.col("ymd_date").cast("timestamp").cast("timestamp_ntz"))


# --- ingest ------------------------------------------------------------------------


@query
def ingest_rename(spark, sf_dir):
    return ingest.rename_columns(fx.as_landing(fx.trade_lines(spark, sf_dir)), IOWRT_3D)


@query
def ingest_parse_dates(spark, sf_dir):
    renamed = ingest.rename_columns(fx.fuel_with_text_dates(spark, sf_dir), FUELPRICE)
    return _zoneless(ingest.parse_dates(renamed, FUELPRICE))


@query
def ingest_date_forms(spark, sf_dir):
    """Dates as text in several forms; a time of day alone is none."""
    landing = fx.fuel_date_forms(spark, sf_dir)
    renamed = ingest.rename_columns(landing, FUELPRICE)
    parsed = ingest.parse_dates(renamed.withColumn("text_date", F.col("ymd_date")), FUELPRICE)
    return _zoneless(parsed)


@query
def raw_write_instants(spark, sf_dir):
    """Instants keep their time of day and microseconds in the raw zone."""
    root = _raw_root(spark)
    rows = ingest.prepare(fx.event_prices(spark, sf_dir), FUELPRICE)
    sinks.write_raw(rows, root, FUELPRICE)
    stored = readers.scan_raw(spark, root, FUELPRICE, schema=FUELPRICE.raw_schema)
    return _zoneless(stored.drop("diesel", "diesel_eastmsia"))


@query
def ingest_dropna(spark, sf_dir):
    return _zoneless(ingest.prepare(fx.fuel_with_text_dates(spark, sf_dir), FUELPRICE))


@query
def distinct_periods(spark, sf_dir):
    relations = {
        IOWRT: fx.raw_iowrt(spark, sf_dir),
        IOWRT_3D: fx.trade_lines(spark, sf_dir),
        FUELPRICE: fx.raw_fuelprice(spark, sf_dir),
    }
    periods = [
        ingest.distinct_periods(
            ingest.prepare(fx.as_landing(df), dataset), dataset
        ).select(F.lit(dataset.name).alias("dataset"), "period")
        for dataset, df in relations.items()
    ]
    return functools.reduce(DataFrame.unionByName, periods)


@query
def period_subset(spark, sf_dir):
    rows = ingest.prepare(fx.as_landing(fx.trade_lines(spark, sf_dir)), IOWRT_3D)
    return _zoneless(ingest.period_subset(rows, IOWRT_3D, SUBSET_MONTH))


@query
def raw_write_monthly(spark, sf_dir):
    root = _raw_root(spark)
    rows = ingest.prepare(fx.as_landing(fx.trade_lines(spark, sf_dir)), IOWRT_3D)
    sinks.write_raw(rows, root, IOWRT_3D)
    return _zoneless(readers.scan_raw(spark, root, IOWRT_3D, schema=IOWRT_3D.raw_schema))


@query
def raw_write_daily(spark, sf_dir):
    root = _raw_root(spark)
    rows = ingest.prepare(fx.as_landing(fx.raw_fuelprice(spark, sf_dir)), FUELPRICE)
    sinks.write_raw(rows, root, FUELPRICE)
    return _zoneless(readers.scan_raw(spark, root, FUELPRICE, schema=FUELPRICE.raw_schema))


@query
def raw_overwrite_dynamic(spark, sf_dir):
    """Deliver everything, then one month again with doubled sales."""
    root = _raw_root(spark)
    rows = ingest.prepare(fx.as_landing(fx.trade_lines(spark, sf_dir)), IOWRT_3D)
    sinks.write_raw(rows, root, IOWRT_3D)
    month = ingest.period_subset(rows, IOWRT_3D, OVERWRITTEN_MONTH)
    sinks.write_raw(month.withColumn("sales", F.col("sales") * 2), root, IOWRT_3D)
    return _zoneless(readers.scan_raw(spark, root, IOWRT_3D, schema=IOWRT_3D.raw_schema))


@query
def ingest_audit(spark, sf_dir):
    text_dates = work_path(spark, "landing-fuelprice")
    fx.fuel_with_text_dates(spark, sf_dir).write.parquet(text_dates)
    landing = {
        IOWRT.name: _land(fx.raw_iowrt(spark, sf_dir), IOWRT.name),
        IOWRT_3D.name: _land(fx.trade_lines(spark, sf_dir), IOWRT_3D.name),
        FUELPRICE.name: text_dates,
    }
    audit = ingest_all(spark, landing, _raw_root(spark))
    return audit.drop("message")


@query
def ingest_audit_periods(spark, sf_dir):
    """Rows that arrived in every period of every dataset."""
    root = _raw_root(spark)
    relations = {
        IOWRT.name: fx.raw_iowrt(spark, sf_dir),
        IOWRT_3D.name: fx.trade_lines(spark, sf_dir),
    }
    ingest_all(spark, {name: _land(df, name) for name, df in relations.items()}, root)
    return written_periods(spark, root)


@query
def ingest_period_outcomes(spark, sf_dir):
    """The periods of one year can't be put in place; the others arrive."""
    root = _raw_root(spark)
    landing = {IOWRT_3D.name: _land(fx.trade_lines(spark, sf_dir), IOWRT_3D.name)}
    _block(spark, f"{root}/{IOWRT_3D.name}/year={BLOCKED_YEAR}")
    _, outcomes = ingest_with_outcomes(spark, landing, root)
    return outcomes.select("dataset", "period", "status", "n_rows", "attempts")


def _block(spark, path):
    """Put a file where a folder will be wanted."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.create(target).close()


@query
def raw_write_changed(spark, sf_dir):
    """The same delivery again but for one month, which alone is written."""
    root = _raw_root(spark)
    rows = ingest.prepare(fx.as_landing(fx.trade_lines(spark, sf_dir)), IOWRT_3D)
    sinks.deliver(rows, root, IOWRT_3D, only_changed=True)
    doubled = F.when(F.col("ymd_date") == OVERWRITTEN_MONTH, F.col("sales") * 2).otherwise(F.col("sales"))
    again = sinks.deliver(rows.withColumn("sales", doubled), root, IOWRT_3D, only_changed=True)
    return periods.outcomes_frame(spark, again).select("dataset", "period", "status", "n_rows")


@query
def raw_snapshot_readback(spark, sf_dir):
    """The newest snapshot after everything came, and one month again with whole numbers for sales."""
    root = _raw_root(spark)
    rows = ingest.prepare(fx.as_landing(fx.trade_lines(spark, sf_dir)), IOWRT_3D)
    snapshots.deliver_snapshot(rows, root, IOWRT_3D)
    month = ingest.period_subset(rows, IOWRT_3D, OVERWRITTEN_MONTH)
    whole = F.floor("sales").cast("int")
    snapshots.deliver_snapshot(month.withColumn("sales", whole), root, IOWRT_3D)
    return _zoneless(snapshots.scan_snapshot(spark, root, IOWRT_3D))


@query
def ingest_status(spark, sf_dir):
    """One dataset lacks its date column and one was not delivered; the other arrives."""
    undated = work_path(spark, "landing-iowrt")
    fx.raw_iowrt(spark, sf_dir).write.parquet(undated)
    landing = {
        IOWRT.name: undated,
        FUELPRICE.name: work_path(spark, "landing-missing"),
        IOWRT_3D.name: _land(fx.trade_lines(spark, sf_dir), IOWRT_3D.name),
    }
    audit = ingest_all(spark, landing, _raw_root(spark))
    return audit.select("dataset", "status", "rows_read", "rows_written")


# --- staging -----------------------------------------------------------------------


@query
def stg_iowrt(spark, sf_dir):
    return _headline(spark, sf_dir)


@query
def stg_iowrt_3d(spark, sf_dir):
    return _trade(spark, sf_dir)


@query
def stg_iowrt_3d_lines(spark, sf_dir):
    return _trade_lines(spark, sf_dir)


@query
def stg_stored_views(spark, sf_dir):
    """Trade from a stored view over the raw zone's tables, after two deliveries with other types."""
    root = _raw_root(spark)
    raw, staged = ("kedai_" + root.rsplit("-", 1)[1] + kind for kind in ("_raw", "_staging"))
    rows = fx.as_landing(fx.trade_lines(spark, sf_dir))
    late = F.col("date") >= SCHEMA_CHANGE
    whole = rows.where(~late).withColumn("volume", F.col("volume").cast("int"))
    for name, delivery in (("early", whole), ("late", rows.where(late))):
        path = work_path(spark, f"landing-{name}")
        delivery.write.parquet(path)
        ingest_all(spark, {IOWRT_3D.name: path}, root, database=raw)
    for dataset in (IOWRT, FUELPRICE):
        stored.register_raw(spark, root, dataset, database=raw)
    seed = f"{raw}.lookup"
    sinks.publish_table(fx.seed_rows(spark, sf_dir), seed, work_path(spark, "seed"))
    views = stored.register_staging_views(spark, seed, raw, staged)
    return spark.table(views["stg_iowrt_3d"])


@query
def stg_fuelprice(spark, sf_dir):
    return _fuel(spark, sf_dir).withColumn(
        "record_date", F.col("record_date").cast("timestamp_ntz")
    )


@query
def stg_msic_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir)


@query
def msic_three_digit(spark, sf_dir):
    """Brand number and part size make codes of two to four digits, with a blank to trim."""
    brand = F.substring_index("p_brand", "#", -1)
    codes = fx.table(spark, sf_dir, "part").select(
        F.concat(brand, F.col("p_size"), F.lit(" ")).alias("group_code"),
        F.col("p_name").alias("desc_en"),
        F.col("p_type").alias("desc_bm"),
    )
    return staging.codes_of_length(staging.stg_msic_lookup(codes))


@query
def ns_epoch_to_timestamp(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", fx.epoch_nanos(F.col("ts")).alias("epoch_ns")
    )
    second = epoch_nanos_to_timestamp(F.col("epoch_ns")).cast("timestamp_ntz")
    return events.withColumn("ts_second", second)


@query
def surrogate_key(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part").withColumn("group_code", fx.group_code())
    return parts.select(
        "p_partkey",
        keys.surrogate_key(F.col("group_code")).alias("code_key"),
        keys.surrogate_key(F.col("group_code"), F.col("p_size")).alias("code_size_key"),
    )


# --- intermediate and dimensions ---------------------------------------------------


@query
def int_fuelprice_monthly(spark, sf_dir):
    return intermediate.in_month_order(_fuel_monthly(spark, sf_dir))


@query
def fuel_average_six_places(spark, sf_dir):
    """Averages of prices with six places after the point, before and after rounding to cents."""
    return fx.fine_prices(spark, sf_dir).groupBy("month").agg(
        numeric.exact_sum("price").alias("total"),
        numeric.exact_mean("price").alias("average"),
        numeric.round_cents(numeric.exact_mean("price")).alias("average_cents"),
    )


@query
def fuel_month_state(spark, sf_dir):
    """Monthly averages after the first day came again with doubled prices; one month is read anew."""
    root, state = _raw_root(spark), work_path(spark, "fuel-state")
    rows = ingest.prepare(fx.as_landing(fx.raw_fuelprice(spark, sf_dir)), FUELPRICE)
    sinks.write_raw(rows, root, FUELPRICE)
    month_state.refresh_state(spark, root, state)
    first = rows.agg(F.min("ymd_date").cast("date").alias("day")).first().day
    day = ingest.period_subset(rows, FUELPRICE, first)
    doubled = {c: F.col(c) * 2 for c in ("ron95", "ron97", "diesel", "diesel_eastmsia")}
    found = sinks.deliver(day.withColumns(doubled), root, FUELPRICE)
    return month_state.averages(month_state.refresh_state(spark, root, state, [o.period for o in found]))


@query
def int_trade_unioned(spark, sf_dir):
    return intermediate.int_trade_unioned(_headline(spark, sf_dir), _trade(spark, sf_dir))


def _ranges(spark, sf_dir):
    return intermediate.date_ranges(
        {
            "stg_iowrt": _headline(spark, sf_dir),
            "stg_iowrt_3d": _trade_lines(spark, sf_dir),
            "stg_fuelprice": _fuel(spark, sf_dir),
        }
    )


@query
def date_ranges(spark, sf_dir):
    return _ranges(spark, sf_dir)


@query
def dim_date(spark, sf_dir):
    return _days(spark, sf_dir)


@query
def dim_date_default(spark, sf_dir):
    """The default calendar of a run on the day of the last event."""
    last = fx.table(spark, sf_dir, "events").agg(F.max("ts").cast("date").alias("day")).first().day
    return dims.dim_date(dims.date_spine(dims.spine_bounds(spark, as_of=last)))


@query
def dim_date_limited(spark, sf_dir):
    """A calendar a year too wide on both sides, cut to the observed dates."""
    wide = fx.calendar_bounds(spark, sf_dir).select(
        F.add_months("start_date", -12).alias("start_date"),
        F.add_months("end_date", 12).alias("end_date"),
    )
    observed = intermediate.final_date_range(_ranges(spark, sf_dir))
    return dims.dim_date(dims.limit_spine(dims.date_spine(wide), observed))


@query
def dim_msic_group(spark, sf_dir):
    return dims.dim_msic_group(_lookup(spark, sf_dir))


@query
def dim_msic_group_maxstruct(spark, sf_dir):
    return dims.dim_msic_group_maxstruct(_lookup(spark, sf_dir))


# --- joins and fact ----------------------------------------------------------------


@query
def join_trade_fuel_month(spark, sf_dir):
    return joins.join_fuel_month(_trade_lines(spark, sf_dir), _fuel_monthly(spark, sf_dir))


@query
def join_trade_date(spark, sf_dir):
    return joins.join_date(_trade_lines(spark, sf_dir), _days(spark, sf_dir))


@query
def join_trade_group(spark, sf_dir):
    return joins.join_group(_trade_lines(spark, sf_dir), _groups(spark, sf_dir))


@query
def fct_retail_sales_monthly(spark, sf_dir):
    return _fact_of(_trade(spark, sf_dir), spark, sf_dir)


@query
def fct_line_grain(spark, sf_dir):
    return _fact_lines(spark, sf_dir)


@query
def fct_unknown_member(spark, sf_dir):
    return marts.unknown_groups(_fact_lines(spark, sf_dir, complete=False))


@query
def fct_since_fuel_start(spark, sf_dir):
    """Fuel prices begin where the first price of the urgent-only fuel is known."""
    fuel = _fuel(spark, sf_dir).where(F.col("diesel_eastmsia_price_rm").isNotNull())
    monthly = intermediate.int_fuelprice_monthly(fuel)
    return marts.since_fuel_start(_fact_table(spark, sf_dir), monthly)


@query
def fct_partitioned_readback(spark, sf_dir):
    return _fact_table(spark, sf_dir)


# --- quality -----------------------------------------------------------------------


@query
def dq_unique_date_key(spark, sf_dir):
    return quality.unique(_days(spark, sf_dir), "dim_date", "date_key", count_rows=True)


@query
def dq_unique_full_date(spark, sf_dir):
    return quality.unique(_days(spark, sf_dir), "dim_date", "full_date", count_rows=True)


@query
def dq_unique_group_key(spark, sf_dir):
    groups = dims.dim_msic_group(_lookup(spark, sf_dir))
    return quality.unique(groups, "dim_msic_group", "msic_group_key", count_rows=True)


@query
def dq_unique_group_code(spark, sf_dir):
    groups = dims.dim_msic_group(_lookup(spark, sf_dir))
    return quality.unique(groups, "dim_msic_group", "msic_group_code", count_rows=True)


@query
def dq_unique_lookup_code(spark, sf_dir):
    """The lookup before it becomes a dimension does hold duplicates."""
    return quality.duplicate_keys(_lookup(spark, sf_dir), "msic_group_code")


@query
def dq_not_null(spark, sf_dir):
    days, groups = _days(spark, sf_dir), _groups(spark, sf_dir)
    fact = marts.fct_retail_sales_monthly(
        _trade_lines(spark, sf_dir), _fuel_monthly(spark, sf_dir), days, groups
    )
    checks = [c for c in quality.fact_row_checks() if c.test == "not_null"]
    prices = [quality.not_null(p, quality.WARN) for p in analytics.FACT_PRICES]
    dimensions = [
        quality.row_checks(df, name, [quality.not_null(c) for c in columns])
        for name, df, *columns in (
            ("dim_date", days, "date_key", "full_date"),
            ("dim_msic_group", groups, "msic_group_key", "msic_group_code"),
        )
    ]
    measures = quality.row_checks(fact, "fct_retail_sales_monthly", checks + prices)
    return quality.summary([*dimensions, measures])


@query
def dq_relationships_date(spark, sf_dir):
    days = _days(spark, sf_dir)
    fact = joins.join_date(_trade_lines(spark, sf_dir), days)
    return quality.orphan_keys(fact, "date_key", days, "date_key")


@query
def dq_relationships_group(spark, sf_dir):
    groups = _groups(spark, sf_dir, complete=False)
    fact = joins.join_group(_trade_lines(spark, sf_dir), groups)
    return quality.orphan_keys(fact, "msic_group_key", groups, "msic_group_key")


@query
def dq_expression_true(spark, sf_dir):
    """The declared tests, and a stricter one that the data does not pass."""
    checks = [c for c in quality.fact_row_checks() if c.test == "expression_is_true"]
    strict = quality.expression_is_true(
        "volume_index", F.col("volume_index") >= 10, quality.WARN
    )
    fact = _measures(_trade_lines(spark, sf_dir), spark, sf_dir)
    return quality.with_status(
        quality.row_checks(fact, "fct_retail_sales_monthly", [*checks, strict])
    )


@query
def dq_not_a_number(spark, sf_dir):
    """Values that are not numbers fail a comparison, however large Spark takes them to be."""
    ratio = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    lines = fx.table(spark, sf_dir, "lineitem").select(ratio.alias("ratio"))
    check = quality.expression_is_true("ratio", F.col("ratio") >= 0)
    return quality.with_status(quality.row_checks(lines, "lineitem", [check]))


@query
def dq_stg_iowrt_date(spark, sf_dir):
    return quality.summary(quality.headline_checks(_headline(spark, sf_dir)))


@query
def dq_accepted_values(spark, sf_dir):
    """The documented values of each dataset, and a list that is too short."""
    relations = {
        IOWRT.name: fx.raw_iowrt(spark, sf_dir),
        IOWRT_3D.name: fx.trade_lines(spark, sf_dir),
        FUELPRICE.name: fx.raw_fuelprice(spark, sf_dir),
    }
    results = [
        quality.accepted_values(df, name, column, values)
        for name, df in relations.items()
        for column, values in DATASETS[name].accepted.items()
    ]
    short = quality.accepted_values(
        relations[IOWRT_3D.name], "short_list", "series", ("abs",), quality.WARN
    )
    return quality.summary([*results, short])


@query
def dq_summary(spark, sf_dir):
    """Publish the whole star as tables, then run every test on the tables."""
    root = work_path(spark, "star")
    namespace = "kedai_" + root.rsplit("-", 1)[1]
    sinks.create_namespace(spark, namespace, root)
    raw = {
        IOWRT.name: fx.raw_iowrt(spark, sf_dir),
        IOWRT_3D.name: fx.trade_lines(spark, sf_dir),
        FUELPRICE.name: fx.raw_fuelprice(spark, sf_dir),
    }
    relations = staging.stage(raw, fx.msic_lookup(spark, sf_dir))
    bounds = fx.calendar_bounds(spark, sf_dir)
    return build_star(relations, bounds, namespace, root, raw=raw).checks


# --- analyses ----------------------------------------------------------------------


@query
def growth_mom(spark, sf_dir):
    return analytics.growth_mom(
        intermediate.int_trade_unioned(_headline(spark, sf_dir), _trade(spark, sf_dir))
    )


@query
def growth_yoy(spark, sf_dir):
    return analytics.growth_yoy(
        intermediate.int_trade_unioned(_headline(spark, sf_dir), _trade(spark, sf_dir))
    )


@query
def fuel_change_weekly(spark, sf_dir):
    return analytics.fuel_change_weekly(_fuel(spark, sf_dir))


@query
def kpi_recent_sales(spark, sf_dir):
    return analytics.kpi_recent_sales(_fact_table(spark, sf_dir))


@query
def trend_monthly(spark, sf_dir):
    return analytics.trend_monthly(_measures(_trade_lines(spark, sf_dir), spark, sf_dir))


@query
def combo_sales_fuel(spark, sf_dir):
    return analytics.combo_sales_fuel(_measures(_trade_lines(spark, sf_dir), spark, sf_dir))


@query
def sales_by_group(spark, sf_dir):
    groups = _groups(spark, sf_dir)
    fact = marts.fct_retail_sales_monthly(
        _trade_lines(spark, sf_dir), _fuel_monthly(spark, sf_dir), _days(spark, sf_dir), groups
    )
    return analytics.sales_by_group(fact, groups)


@query
def sales_filtered(spark, sf_dir):
    return analytics.sales_filtered(
        _fact_table(spark, sf_dir), FILTER_FIRST, FILTER_LAST, FILTER_GROUPS
    )


@query
def sales_in_quarter(spark, sf_dir):
    """Sales of the second quarters, from the months that the calendar names."""
    fact, days = _fact_table(spark, sf_dir), sinks.publish(_days(spark, sf_dir), work_path(spark, "dim_date"))
    return analytics.sales_in_calendar(fact, days, F.col("quarter") == 2)


@query
def corr_sales_fuel(spark, sf_dir):
    return analytics.corr_sales_fuel(_measures(_trade(spark, sf_dir), spark, sf_dir))


@query
def corr_by_group(spark, sf_dir):
    return analytics.corr_by_group(_measures(_trade(spark, sf_dir), spark, sf_dir))


@query
def seasonality(spark, sf_dir):
    return analytics.seasonality(_measures(_trade_lines(spark, sf_dir), spark, sf_dir))
