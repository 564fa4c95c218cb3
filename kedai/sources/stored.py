"""The raw zone as catalog tables, and staging as stored views, each in a schema of its own."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from kedai.sources.datasets import DATASETS, DATE_COLUMN, Dataset
from kedai.sources.periods import WRITTEN, Outcome
from kedai.sources.readers import (
    LEGACY,
    NAMED_FILE,
    OTHER_FILES,
    PERIOD_WIDTH,
    recorded_schemas,
    schemas_by_footers,
)
from kedai.sources.reconcile import united
from kedai.sources.sinks import create_namespace

RAW, STAGING = "raw", "staging"

# Partitions named in one statement.
BATCH = 500

# Tables of files that other writers left, and of files from before columns had names.
OTHER, UNNAMED = "other", "unnamed"

# The staging relations as SQL over the stored raw relations and the published seed.
STAGING_VIEWS = {
    "stg_iowrt": """
        SELECT CAST(ymd_date AS DATE) AS record_date, CAST(sales AS DOUBLE) AS sales_value_rm_mil,
               CAST(volume AS DOUBLE) AS volume_index, CAST(volume_sa AS DOUBLE) AS volume_index_sa
        FROM {raw}.iowrt WHERE series = 'abs'
    """,
    "stg_iowrt_3d": """
        SELECT CAST(ymd_date AS DATE) AS record_date, CAST(group_code AS STRING) AS msic_group_code,
               CAST(sales AS DOUBLE) AS sales_value_rm_mil, CAST(volume AS DOUBLE) AS volume_index
        FROM {raw}.iowrt_3d WHERE series = 'abs' AND group_code IS NOT NULL AND group_code <> ''
    """,
    "stg_fuelprice": """
        SELECT CAST(ymd_date AS TIMESTAMP) AS record_date, CAST(ron95 AS DOUBLE) AS ron95_price_rm,
               CAST(ron97 AS DOUBLE) AS ron97_price_rm, CAST(diesel AS DOUBLE) AS diesel_peninsular_price_rm,
               CAST(diesel_eastmsia AS DOUBLE) AS diesel_eastmsia_price_rm
        FROM {raw}.fuelprice WHERE series_type = 'level'
    """,
    "stg_msic_lookup": """
        SELECT CAST(group_code AS STRING) AS msic_group_code, CAST(desc_en AS STRING) AS group_desc_en,
               CAST(desc_bm AS STRING) AS group_desc_bm
        FROM {seed} WHERE group_code IS NOT NULL AND group_code <> ''
    """,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _table(spark: SparkSession, table: str, path: str, schema: T.StructType, dataset: Dataset) -> None:
    """An external table for the periods whose files have these columns."""
    if spark.catalog.tableExists(table):
        return
    fields = [f for f in schema.fields if f.name not in dataset.periods]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    columns += [f"`{period}` STRING" for period in dataset.periods]
    spark.sql(
        f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet "
        f"PARTITIONED BY ({', '.join(dataset.periods)}) LOCATION {_quoted(path)}"
    )


def _specs(dataset: Dataset, found: Iterable[str]) -> Iterator[list[str]]:
    """Partitions of periods as SQL, some at a time."""
    specs = []
    for period in sorted(found):
        values = zip(dataset.periods, period.split("-"), strict=True)
        specs.append("PARTITION (" + ", ".join(f"{name} = '{value}'" for name, value in values) + ")")
    for at in range(0, len(specs), BATCH):
        yield specs[at : at + BATCH]


def add_periods(spark: SparkSession, table: str, dataset: Dataset, found: Iterable[str]) -> None:
    """Register periods of a table, so that reads find them without listing the zone's folders."""
    for specs in _specs(dataset, found):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs)}")
    spark.catalog.refreshTable(table)


def drop_periods(spark: SparkSession, table: str, dataset: Dataset, found: Iterable[str]) -> None:
    """Forget periods of a table; their files are no business of an external table."""
    for specs in _specs(dataset, found):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
    spark.catalog.refreshTable(table)


def held_periods(spark: SparkSession, table: str) -> set[str]:
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {"-".join(part.partition("=")[2] for part in row.partition.split("/")) for row in rows}


def _listed(spark: SparkSession, path: str, dataset: Dataset) -> dict[str, set[str]]:
    """The periods of all files below a dataset's folder by the name of their columns."""
    schema = T.StructType([T.StructField(period, T.StringType()) for period in dataset.periods])
    files = spark.read.schema(schema).option("basePath", path).parquet(path).inputFiles()
    found: dict[str, set[str]] = {}
    for file in files:
        folder, name = file.rsplit("/", 1)
        parts = folder.rsplit("/", len(dataset.periods))[1:]
        period = "-".join(
            part.partition("=")[2].zfill(PERIOD_WIDTH[key]) for part, key in zip(parts, dataset.periods, strict=True)
        )
        named = NAMED_FILE.search(file)
        own = named[1] if named else LEGACY if name.startswith("part-") else OTHER
        found.setdefault(own, set()).add(period)
    return found


def _foreign(spark: SparkSession, path: str) -> T.StructType:
    """The columns of files that other writers left."""
    reader = spark.read.option("basePath", path).option("pathGlobFilter", OTHER_FILES)
    return reader.option("mergeSchema", True).parquet(path).schema


def _tables_of(spark: SparkSession, dataset: Dataset, database: str) -> dict[str, str]:
    """The tables of a dataset by the name of their files' columns."""
    prefix = f"{dataset.name}__"
    names = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefix)]
    return {_file_name(name.removeprefix(prefix)): f"{database}.{name}" for name in names}


def _file_name(suffix: str) -> str:
    return LEGACY if suffix == UNNAMED else suffix


def register_raw(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    outcomes: Iterable[Outcome] | None = None,
    written: str | None = None,
    database: str = RAW,
) -> str:
    """Show a dataset of the raw zone as ``<database>.<name>``; returns that name.

    There is an external table for each set of columns and types that files came with, and a view that
    unites them in the common types; a period belongs to the table of its files. With ``outcomes`` the
    periods that a delivery wrote, under the columns named ``written``, go to their table, and no folder is
    listed. Without them, and for a dataset that is new to the catalog, the zone is listed once. Periods of
    other writers are a table too, whose nanosecond dates become timestamps in the view; a period with
    files of several writers or types can't be shown and raises an error.
    """
    create_namespace(spark, database)
    path, view = os.path.join(root, dataset.name), f"{database}.{dataset.name}"
    known = _tables_of(spark, dataset, database)
    schemas = recorded_schemas(spark, path)
    if outcomes is not None and known and schemas:
        touched = {o.period for o in outcomes if o.status == WRITTEN}
        for name, table in known.items():
            if name != written:
                drop_periods(spark, table, dataset, touched)
        periods = {written: touched} if touched else {}
    else:
        schemas, periods = _whole_zone(spark, path, dataset, schemas)
        for name, table in known.items():
            drop_periods(spark, table, dataset, held_periods(spark, table) - periods.get(name, set()))
    for name, found in periods.items():
        known[name] = f"{database}.{dataset.name}__{name or UNNAMED}"
        _table(spark, known[name], path, schemas[name], dataset)
        add_periods(spark, known[name], dataset, found)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {_united(spark, dataset, known)}")
    return view


def _whole_zone(
    spark: SparkSession, path: str, dataset: Dataset, schemas: dict[str, T.StructType | None] | None
) -> tuple[dict[str, T.StructType], dict[str, set[str]]]:
    """Columns and periods of all files, by the name of their columns."""
    try:
        if schemas is None:
            schemas = schemas_by_footers(spark, path)
        periods = _listed(spark, path, dataset)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}, {}
    if OTHER in periods:
        schemas = schemas | {OTHER: _foreign(spark, path)}
    if any(schemas.get(name) is None for name in periods):
        raise ValueError(f"{path}: files without a name for their columns disagree on types")
    twice = {p for a in periods for b in periods if a < b for p in periods[a] & periods[b]}
    if twice:
        raise ValueError(f"{path}: several kinds of files in {', '.join(sorted(twice))}")
    return schemas, periods


def _united(spark: SparkSession, dataset: Dataset, tables: Mapping[str, str]) -> str:
    """One relation from all tables of a dataset, in the common types of their columns."""
    schemas = {name: spark.table(table).schema for name, table in tables.items()}

    def kept(schema: T.StructType) -> T.StructType:
        dated = T.StructField(DATE_COLUMN, T.TimestampType())
        fields = [f for f in schema.fields if f.name not in dataset.periods]
        return T.StructType([dated if f.name == DATE_COLUMN else f for f in fields])

    target = united(dataset.schema, *map(kept, schemas.values()))
    selects = []
    for name, table in tables.items():
        held = {f.name.lower(): f for f in schemas[name].fields}

        def column(field: T.StructField, held: dict = held) -> str:
            found = held.get(field.name.lower())
            value = f"`{found.name}`" if found else "NULL"
            if found and field.name == DATE_COLUMN and isinstance(found.dataType, T.LongType):
                value = f"timestamp_seconds({value} DIV 1000000000)"
            return f"CAST({value} AS {field.dataType.simpleString()}) AS `{field.name}`"

        selects.append(f"SELECT {', '.join([*map(column, target.fields), *dataset.periods])} FROM {table}")
    if not selects:
        empty = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in dataset.raw_schema.fields]
        return f"SELECT {', '.join(empty)} WHERE FALSE"
    return " UNION ALL ".join(selects)


def register_staging_views(
    spark: SparkSession, seed: str, raw: str = RAW, staging: str = STAGING
) -> dict[str, str]:
    """The staging relations as stored views, for any session of the catalog; their names.

    They read the stored raw relations and the published seed, so they show each delivery and each
    version of the seed without being made anew.
    """
    create_namespace(spark, staging)
    for name, text in STAGING_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {staging}.{name} AS {text.format(raw=raw, seed=seed)}")
    return {name: f"{staging}.{name}" for name in STAGING_VIEWS}


def register_all(spark: SparkSession, root: str, database: str = RAW) -> dict[str, str]:
    """Every dataset of the raw zone in the catalog; one that never arrived is empty."""
    return {name: register_raw(spark, root, dataset, database=database) for name, dataset in DATASETS.items()}


Registration = Callable[[Dataset, Iterable[Outcome], str], object]


def registration(spark: SparkSession, root: str, database: str) -> Registration:
    """What an ingest calls after each delivery to keep the catalog in step."""

    def register(dataset: Dataset, outcomes: Iterable[Outcome], written: str) -> object:
        return register_raw(spark, root, dataset, outcomes, written, database)

    return register
