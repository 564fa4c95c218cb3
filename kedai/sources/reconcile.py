"""One relation from files whose columns came with different types."""

from __future__ import annotations

import hashlib
from collections.abc import Hashable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers from the narrowest to the widest, each with the digits it needs as a decimal.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_WHOLE_ORDER = list(_WHOLE)
_REAL = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)

FOOTER_THREADS = 16


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text if nothing narrower does.

    Whole numbers widen to longer ones, to decimals or to doubles; dates to timestamps.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = (type(a), type(b))
    if all(kind in _WHOLE for kind in kinds):
        return max((a, b), key=lambda t: _WHOLE_ORDER.index(type(t)))
    if all(kind in _WHOLE or kind in (*_REAL, T.DecimalType) for kind in kinds):
        return T.DoubleType() if any(kind in _REAL for kind in kinds) else _common_decimal(a, b)
    if all(kind in _TIMES for kind in kinds):
        return max((a, b), key=lambda t: _TIMES.index(type(t)))
    return T.StringType()


def _common_decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    def parts(kind: T.DataType) -> tuple[int, int]:
        if isinstance(kind, T.DecimalType):
            return kind.precision - kind.scale, kind.scale
        return _WHOLE[type(kind)], 0

    (whole, places), (other_whole, other_places) = parts(a), parts(b)
    scale = max(places, other_places)
    precision = max(whole, other_whole) + scale
    return T.DecimalType(precision, scale) if precision <= 38 else T.DoubleType()


def united(*schemas: T.StructType) -> T.StructType:
    """All columns by name, in order of appearance, each with the common type of its types."""
    fields: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema.fields):
        key = field.name.lower()
        held = fields.get(key)
        kind = common_type(held.dataType, field.dataType) if held else field.dataType
        fields[key] = T.StructField(held.name if held else field.name, kind)
    return T.StructType(list(fields.values()))


def schema_id(schema: T.StructType) -> str:
    """A short name for the columns and types of a file."""
    text = ",".join(sorted(f"{f.name.lower()} {f.dataType.json()}" for f in schema.fields))
    return "s" + hashlib.md5(text.encode()).hexdigest()[:8]


def readable_together(a: T.StructType, b: T.StructType) -> bool:
    """Whether one scan can read files of both: columns that both have are of one type."""
    kinds = {f.name.lower(): f.dataType for f in a.fields}
    return all(kinds.get(f.name.lower(), f.dataType) == f.dataType for f in b.fields)


def groups(schemas: Mapping[Hashable, T.StructType]) -> list[tuple[list, T.StructType]]:
    """Keys of schemas that one scan can read, with the columns of that scan."""
    out: list[tuple[list, T.StructType]] = []
    for key, schema in schemas.items():
        for at, (keys, held) in enumerate(out):
            if readable_together(held, schema):
                out[at] = ([*keys, key], united(held, schema))
                break
        else:
            out.append(([key], schema))
    return out


def as_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; those that ``df`` lacks are NULL."""
    held = {name.lower(): name for name in df.columns}

    def column(field: T.StructField):
        name = held.get(field.name.lower())
        found = F.col(f"`{name}`") if name else F.lit(None)
        return found.cast(field.dataType).alias(field.name)

    return df.select(*map(column, schema.fields))


def union_all(frames: Iterable[DataFrame], schema: T.StructType) -> DataFrame:
    """All rows of frames with columns of different types, in those of ``schema``."""
    return reduce(DataFrame.unionByName, (as_types(df, schema) for df in frames))


# What Spark raises where files of one relation can't be read with one schema: some conditions reach
# Python as errors of their own, others as plain errors of the JVM.
READ_ERRORS = (AnalysisException, Py4JJavaError)


def mismatch(error: Exception) -> bool:
    """Whether files could not be read as one relation because a column changed its type."""
    return "CANNOT_MERGE_SCHEMAS" in str(error)


def scan_by_types(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Parquet files below ``path`` that disagree on types: files that agree are read together, each
    group with its own types, and widened to the common ones. One footer is read for every file."""
    reader = spark.read.option("basePath", path)
    found = reader.option("mergeSchema", False)
    if glob:
        found = found.option("pathGlobFilter", glob)
    files = sorted(found.parquet(path).inputFiles())

    def columns(file: str) -> T.StructType:
        return spark.read.parquet(file).schema

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        schemas = dict(zip(files, pool.map(columns, files), strict=True))
    frames = []
    for names, schema in groups(schemas):
        based = spark.read.option("basePath", path)
        frames.append(based.schema(united(schema, _folders(based, names[0], schema))).parquet(*names))
    return union_all(frames, united(*[df.schema for df in frames]))


def _folders(reader, file: str, schema: T.StructType) -> T.StructType:
    """The partition columns that a file's folders give."""
    names = {f.name for f in schema.fields}
    return T.StructType([f for f in reader.parquet(file).schema.fields if f.name not in names])
