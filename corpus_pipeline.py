"""A corpus from raw documents to packed training sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kedai.llm import decontaminate, neardup, packing, pii, quality
from kedai.llm.common import read_table, store
from kedai.llm.queries import tokenizer_file


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that shares 8 of 10 five-word shingles."""
    return neardup.keep_one(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids; other stages have used the executors' memory before,
    so little of it is for look-up tables."""
    return packing.pack(docs, tokenizer_file(), table_bytes=1 << 24).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

# Training and tokenising have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again for the next stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
