"""Removal of long word runs that an earlier document has, found by difference-cover anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kedai.llm.common import batch_rows, column_batches, small_batches, store, text_or_empty
from kedai.llm.words import MULTIPLIERS, Runs, hash_words, split_words

WINDOW = 50

# Every residue modulo 31 is a difference of two of these, each in exactly one way.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)

# Document keys are broadcast up to this many (16 bytes each); more are joined by shuffling.
BROADCAST_KEYS = 1 << 20

KEY = ["doc_id", "text_key"]


def cover_positions(count: int) -> np.ndarray:
    """Positions below ``count`` whose residue modulo the period lies in the cover."""
    at = np.arange(count)
    return at[np.isin(at % PERIOD, COVER)]


def _keys(keys: DataFrame) -> DataFrame:
    """A stored relation of document keys, broadcast if its checked size allows it."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))


def profile(rows: DataFrame, window: int) -> DataFrame:
    """One row per document: its number of words, their SHA-256, and its anchors' hashes.

    Two equal windows of ``window`` words share a run of ``window - PERIOD + 1`` words that starts
    at a cover position of both documents, whatever their places: the cover has a pair of residues
    for every difference. Only runs at cover positions are therefore hashed.
    """
    length = window - PERIOD + 1

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, found = [], [], []
            for (text,) in batch_rows(iter([batch]), "text"):
                words = split_words(text)
                starts = cover_positions(max(0, len(words) - length + 1))
                sizes.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                if len(words) < window:
                    starts = starts[:0]
                found.append(Runs(hash_words(words)).at(starts, length).view(np.int64))
            ends = np.cumsum([0, *map(len, found)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()),
                        pa.array(np.concatenate([np.empty(0, np.int64), *found])),
                    ),
                ],
                names=["doc_id", "text_key", "n_words", "sha256", "anchors"],
            )

    return rows.mapInArrow(
        anchors, "doc_id long, text_key long, n_words long, sha256 string, anchors array<bigint>"
    )


def copies_of(profiles: DataFrame) -> DataFrame:
    """Documents whose whole word sequence a document with a smaller id has."""
    named = profiles.where("doc_id IS NOT NULL").select(*KEY, "sha256", "n_words")
    first = (
        named.groupBy("sha256")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
    )
    return named.join(first, "sha256").where("doc_id > first").select(*KEY).distinct()


def candidates(profiles: DataFrame, copies: DataFrame) -> DataFrame:
    """Cover positions, by document, whose run another document has too."""
    position = F.col("index").cast("int")
    lone = profiles.where("doc_id IS NOT NULL").join(_keys(copies), KEY, "left_anti")
    anchors = lone.select(*KEY, F.posexplode("anchors").alias("index", "anchor"))
    shared = (
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("anchor")
    )
    return anchors.join(shared, "anchor").select(*KEY, position.alias("index"))


def windows(rows: DataFrame, anchors: DataFrame, window: int) -> DataFrame:
    """Extend candidate anchors to all windows around them: two hashes, document and start."""
    touched = store(anchors.groupBy(*KEY).agg(F.collect_set("index").alias("indexes")), "anchored")

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for doc, key, text, indexes in batch_rows(batches, *KEY, "text", "indexes"):
            hashes = hash_words(split_words(text))
            count = len(hashes) - window + 1
            at = cover_positions(len(hashes))[np.array(indexes, dtype=np.int64)]
            # A window holds the run at p if it starts in (p - PERIOD, p].
            marks = np.zeros(len(hashes) + PERIOD + 1, dtype=np.int64)
            np.add.at(marks, np.maximum(at - PERIOD + 1, 0), 1)
            np.add.at(marks, at + 1, -1)
            starts = np.flatnonzero(np.cumsum(marks)[:count])
            first, second = (Runs(hashes, m).at(starts, window) for m in MULTIPLIERS)
            yield [
                first.view(np.int64),
                (second >> np.uint64(33)).astype(np.int32),
                np.full(len(starts), doc, dtype=np.int64),
                np.full(len(starts), key, dtype=np.int64),
                starts.astype(np.int32),
            ]

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return column_batches(around(batches), ["run", "check", *KEY, "start"])

    texts = rows.join(_keys(touched.select(*KEY)), KEY, "left_semi")
    return texts.join(touched, KEY).select(*KEY, "text", "indexes").mapInArrow(
        extend, "run long, check int, doc_id long, text_key long, start int"
    )


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut every word covered by a window of ``window`` words that an earlier document has.

    A window counts if its exact word sequence starts anywhere in a document with a smaller id;
    windows are judged on the input. Words are maximal runs of characters other than blank and
    U+0009 to U+000D, unchanged. Returns a row per input row: doc_id, n_words, n_removed,
    kept_sha256 and ``kept``, the kept words joined by one blank (null where nothing is removed and
    the text can stay as it is).

    Null and empty texts have no words. Rows with a null id are left whole and are nobody's earlier
    document. Rows that share an id never cut each other; each gets a row of its own. Extra columns
    are ignored; an empty table gives an empty result. Whole copies of an earlier document are told
    by the digest of all their words and take no part in the search, so a large group of copies
    costs one row each. Counts of hot runs are combined before the shuffle and hot join keys are
    split by the adaptive join.
    """
    small_batches(docs.sparkSession)
    rows = _documents(docs, id_col, text_col)
    profiles = store(profile(rows, window), "anchors")
    copies = store(copies_of(profiles), "copies")
    found = store(windows(rows, candidates(profiles, copies), window), "windows")
    earlier = (
        found.groupBy("run", "check")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("run", "check", "first")
    )
    repeated = found.join(earlier, ["run", "check"]).where("first < doc_id")
    cuts = store(repeated.groupBy(*KEY).agg(F.collect_set("start").alias("starts")), "cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text, starts in batch_rows(iter([batch]), "doc_id", "text", "starts"):
                words = split_words(text)
                marks = np.zeros(len(words) + 1, dtype=np.int64)
                marks[np.array(starts)] += 1
                marks[np.array(starts) + window] -= 1
                covered = np.cumsum(marks)[:-1] > 0
                kept = b" ".join([w for w, gone in zip(words, covered, strict=True) if not gone])
                row = (
                    doc,
                    len(words),
                    int(covered.sum()),
                    hashlib.sha256(kept).hexdigest(),
                    kept.decode("utf-8", "surrogatepass"),
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(out, kinds, strict=True)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    texts = rows.join(_keys(cuts.select(*KEY)), KEY, "left_semi").join(cuts, KEY)
    partly = texts.select("doc_id", "text", "starts").mapInArrow(cut, schema)
    whole = F.col("copied") & (F.col("n_words") >= window)
    rest = (
        profiles.select(*KEY, "n_words", "sha256")
        .join(_keys(cuts.select(*KEY)), KEY, "left_anti")
        .join(_keys(copies).withColumn("copied", F.lit(True)), KEY, "left")
        .withColumn("copied", F.coalesce("copied", F.lit(False)))
        .select(
            "doc_id",
            "n_words",
            F.when(whole, F.col("n_words")).otherwise(0).alias("n_removed"),
            F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha256")).alias("kept_sha256"),
            F.when(whole, F.lit("")).alias("kept"),
        )
    )
    return partly.unionByName(rest)
