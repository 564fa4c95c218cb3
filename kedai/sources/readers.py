"""Scans of the landing zone, the raw zone and the seed file."""

from __future__ import annotations

import json
import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kedai.functions.dates import as_timestamp
from kedai.sources.datasets import DATASETS, DATE_COLUMN, SEED_COLUMNS, Dataset
from kedai.sources.reconcile import (
    READ_ERRORS,
    as_types,
    groups,
    mismatch,
    readable_together,
    scan_by_types,
    union_all,
    united,
)

# Width of the zero-padded period directories (fixed values).
PERIOD_WIDTH = {"year": 4, "month": 2, "day": 2}

# Names of the files that this library writes, and all others. After "part-" comes the name of a
# file's columns, or a number in files from before columns had names.
OWN_FILES = "part-*"
OTHER_FILES = "{[!p]*,p[!a]*,pa[!r]*,par[!t]*,part[!-]*}"
LEGACY, LEGACY_FILES = "", "part-[0-9]*"
NAMED_FILE = re.compile(r"/part-(s[0-9a-f]{8})-[^/]*$")

# Folder beside a dataset's periods with the columns of its files; scans skip names like this.
COLUMNS = "_columns"


def scan_landing(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet as delivered. Without ``schema`` the columns are those of all its files, each in the
    common type of its types."""
    if schema:
        return spark.read.schema(schema).parquet(path)
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except READ_ERRORS as error:
        if not mismatch(error):
            raise
        return scan_by_types(spark, path)


def _csv_reader(spark: SparkSession, multi_line: bool):
    """Quotes are doubled inside quoted fields, which may hold line breaks. A quoted empty field is
    an empty text, an unquoted one is missing: no field can equal the marker for missing ones."""
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
    )


def scan_landing_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """The CSV edition of a dataset, read with given types (no inference pass).

    Large files are split over tasks. Where fields hold line breaks, ``multi_line`` has to say so: each
    file is then read by one task.
    """
    return _csv_reader(spark, multi_line).option("enforceSchema", False).schema(schema).csv(path)


def scan_raw(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The raw zone of one dataset; directories become zero-padded string columns.

    ``schema`` (for example ``dataset.raw_schema``) costs no footer reads and yields NULL
    for columns that older files lack; prefer it where the files hold these types.
    ``merge_schema`` finds the union of all file schemas by reading every footer in a
    distributed job; declared columns that no file has become NULL.
    """
    path = os.path.join(root, dataset.name)
    reader = spark.read.option("basePath", path)
    if schema is not None:
        return reader.schema(schema).parquet(path)
    df = reader.option("mergeSchema", merge_schema).parquet(path)
    padded = {
        p: F.lpad(F.col(p).cast("string"), PERIOD_WIDTH[p], "0") for p in dataset.periods
    }
    absent = {
        f.name: F.lit(None).cast(f.dataType)
        for f in dataset.schema.fields
        if merge_schema and f.name not in df.columns
    }
    return df.withColumns(padded | absent)


def recorded_schemas(spark: SparkSession, path: str) -> dict[str, T.StructType | None] | None:
    """The columns that ``sinks.deliver`` recorded beside a dataset, by the name its files carry;
    None in raw zones without a record. Files from before that are under ``LEGACY``, with None if
    their records disagree on a type."""
    try:
        rows = spark.read.schema("id string, columns string").json(f"{path}/{COLUMNS}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    found: dict[str, T.StructType | None] = {}
    for row in rows:
        key, schema = row.id or LEGACY, T.StructType.fromJson(json.loads(row.columns))
        held = found.get(key, schema)
        found[key] = united(held, schema) if held and readable_together(held, schema) else None
    return found


def schemas_by_footers(spark: SparkSession, path: str) -> dict[str, T.StructType | None]:
    """The columns of all files of this library by the name they carry, from their footers; none if
    there are no files, and None for files of one name that disagree on a type."""
    try:
        files = spark.read.option("pathGlobFilter", OWN_FILES).parquet(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return {}
    names = {found[1] if (found := NAMED_FILE.search(file)) else LEGACY for file in files}
    return {name: _merged(spark, path, files_of([name])) for name in sorted(names)}


def _merged(spark: SparkSession, path: str, glob: str) -> T.StructType | None:
    try:
        return spark.read.option("mergeSchema", True).option("pathGlobFilter", glob).parquet(path).schema
    except READ_ERRORS as error:
        if not mismatch(error):
            raise
        return None


def files_of(names: list[str]) -> str:
    globs = [f"part-{name}-*" if name else LEGACY_FILES for name in names]
    return globs[0] if len(globs) == 1 else "{" + ",".join(globs) + "}"


def scan_own(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """The files of this library below ``path``, whatever types their columns had over time.

    Files whose recorded types agree are one scan without footer reads; each further set of types is a
    scan of its own, and all are widened to the common types. Declared columns come first, then those
    that deliveries added, then the period columns.
    """
    schemas = recorded_schemas(spark, path)
    if schemas is None:
        schemas = schemas_by_footers(spark, path)
    known = {name: _without(schema, dataset.periods) for name, schema in schemas.items() if schema}
    together = groups(known)
    target = united(dataset.schema, *known.values())
    period_fields = dataset.raw_schema.fields[len(dataset.schema.fields) :]
    untyped = [name for name, schema in schemas.items() if not schema]
    based = spark.read.option("basePath", path)
    if len(together) <= 1 and not untyped and readable_together(target, united(dataset.schema)):
        if not together or readable_together(together[0][1], dataset.schema):
            whole = T.StructType([*target.fields, *period_fields])
            return based.option("pathGlobFilter", OWN_FILES).schema(whole).parquet(path)
    frames = []
    for names, schema in together:
        fields = T.StructType([*schema.fields, *period_fields])
        frames.append(based.option("pathGlobFilter", files_of(names)).schema(fields).parquet(path))
    frames += [scan_by_types(spark, path, files_of([name])) for name in untyped]
    target = united(target, *(_without(df.schema, dataset.periods) for df in frames))
    return union_all(map(_padded(dataset), frames), T.StructType([*target.fields, *period_fields]))


def _without(schema: T.StructType, names: tuple[str, ...]) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])


def _padded(dataset: Dataset):
    """Period columns as zero-padded text, however they were read."""
    columns = {p: F.lpad(F.col(p).cast("string"), PERIOD_WIDTH[p], "0") for p in dataset.periods}

    def pad(df: DataFrame) -> DataFrame:
        text = {p: c for p, c in columns.items() if not isinstance(df.schema[p].dataType, T.StringType)}
        return df.withColumns(text) if text else df

    return pad


def scan_raw_mixed(spark: SparkSession, root: str, dataset: Dataset) -> DataFrame:
    """The raw zone of one dataset, whoever wrote its files and whatever types their columns had.

    Files of this library are told by their names, see ``scan_own``. Other files, whose dates may be
    nanoseconds, are read apart with the columns of all of them. Dates become timestamps; columns are
    united by name in the common type of their types; columns that no file has are NULL. A dataset that
    never arrived is an empty relation.
    """
    path = os.path.join(root, dataset.name)
    try:
        own = scan_own(spark, path, dataset)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], dataset.raw_schema)
    reader = spark.read.option("basePath", path).option("pathGlobFilter", OTHER_FILES)
    try:
        other = reader.option("mergeSchema", True).parquet(path)
    except READ_ERRORS as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            return own
        if not mismatch(error):
            raise
        other = scan_by_types(spark, path, OTHER_FILES)
    date = as_timestamp(F.col(DATE_COLUMN), other.schema[DATE_COLUMN].dataType)
    other = _padded(dataset)(other.withColumn(DATE_COLUMN, date))
    target = united(own.schema, other.schema)
    late = [f for f in target.fields if f.name not in dataset.raw_schema.names]
    if not late and own.schema == target:
        return own.unionByName(as_types(other, target))
    order = [*_without(target, dataset.periods).fields, *(f for f in target.fields if f.name in dataset.periods)]
    return union_all([own, other], T.StructType(order))


def load_seed(spark: SparkSession, path: str) -> DataFrame:
    """A CSV lookup with all its columns kept as text, so codes keep their leading zeros.

    The columns that staging needs must be among them.
    """
    seed = _csv_reader(spark, multi_line=True).option("inferSchema", False).csv(path)
    missing = set(SEED_COLUMNS) - set(seed.columns)
    if missing:
        raise ValueError(f"no column {', '.join(sorted(missing))} in {path}")
    return seed


def register_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All raw datasets below ``root``, also as temp views under their names.

    Columns that deliveries added later are among theirs. Footers are only read of files that other
    writers left, and of raw zones without recorded columns; a dataset without files is empty.
    """
    frames = {name: scan_raw_mixed(spark, root, dataset) for name, dataset in DATASETS.items()}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames
