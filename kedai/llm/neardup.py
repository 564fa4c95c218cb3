"""Near duplicates: a multi-index Hamming join of b-bit MinHash signatures, confirmed on full sets."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kedai.llm.common import batch_rows, mix64, small_batches, store, text_or_empty
from kedai.llm.components import components
from kedai.llm.words import Runs, hash_words, split_words

# A signature has LANES 16-bit MinHash values in each of CHUNKS long integers.
CHUNKS, LANES, BITS = 16, 4, 16
SYMBOLS = CHUNKS * LANES
# Chance that a pair exactly at the similarity threshold is not found.
MISS = 3e-6

# Document ids are broadcast up to this many; more are joined by shuffling.
BROADCAST_IDS = 1 << 20

_ONES = 0x0001000100010001


def chunks_needed(similarity: float, miss: float = MISS) -> int:
    """Chunks with which a pair at the threshold is missed with at most the given chance.

    One wrong value is allowed in a chunk, so by the pigeonhole principle a pair is found for certain
    while fewer than two values a chunk differ, counted over all indexed chunks.
    """
    for chunks in range(1, CHUNKS + 1):
        n, wrong = chunks * LANES, 1 - similarity
        tail = sum(
            math.comb(n, k) * wrong**k * similarity ** (n - k) for k in range(2 * chunks, n + 1)
        )
        if tail <= miss:
            return chunks
    return CHUNKS


def radius(similarity: float) -> int:
    """Differing values, of all indexed ones, up to which a pair is a candidate: the distance up to which
    every pair shares a key."""
    return 2 * chunks_needed(similarity) - 1


@functools.lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    return mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words; fewer words count as one run."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    size = min(size, len(words))
    return np.unique(Runs(hash_words(words)).all(size))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The packed signature of a set: low bits of the least image under each multiplication."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 1 << 13):
        part = hashes[None, at : at + (1 << 13)] * _multipliers()[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    values = (mix64(least) & np.uint64((1 << BITS) - 1)).reshape(CHUNKS, LANES)
    shifts = np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)
    return (values << shifts).sum(axis=1, dtype=np.uint64).view(np.int64)


def normal_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased."""
    return [word.lower() for word in split_words(text)]


def profile(rows: DataFrame, size: int) -> DataFrame:
    """Of every document: the digest of its words, the size of its set and the set's signature."""

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, packed = [], [], []
            for (text,) in batch_rows(iter([batch]), "text"):
                words = normal_words(text)
                hashes = shingle_hashes(words, size)
                digests.append(hashlib.sha256(b" ".join(words)).digest()[:16])
                sizes.append(len(hashes))
                packed.append(signature(hashes) if len(hashes) else np.empty(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(packed, pa.list_(pa.int64())),
                ],
                names=["doc_id", "digest", "n_shingles", "signature"],
            )

    return rows.mapInArrow(
        signatures, "doc_id long, digest binary, n_shingles long, signature array<bigint>"
    )


def _keys(chunks: int, name: str = "signature") -> Column:
    """Index keys of a signature: every indexed chunk with each of its values left out in turn."""
    keys = []
    for chunk in range(chunks):
        for lane in range(LANES):
            mask = ((1 << 64) - 1) ^ (((1 << BITS) - 1) << (BITS * lane))
            mask -= (mask >> 63) << 64
            value = F.col(name)[chunk].bitwiseAND(F.lit(mask).cast("long"))
            keys.append(F.xxhash64(F.lit(chunk * LANES + lane), value))
    return F.array(*keys)


def _differing(x: Column, y: Column, chunks: int) -> Column:
    """Number of unequal values in the indexed chunks of two packed signatures."""

    def lanes(u: Column, v: Column) -> Column:
        bits = u.bitwiseXOR(v)
        for shift in (8, 4, 2, 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        return F.bit_count(bits.bitwiseAND(F.lit(_ONES)))

    x, y = F.slice(x, 1, chunks), F.slice(y, 1, chunks)
    return F.aggregate(F.zip_with(x, y, lanes), F.lit(0), lambda total, n: total + n)


def _hub_pairs(buckets: DataFrame) -> DataFrame:
    """Every row of a bucket with the bucket's hub."""
    pair = (F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))
    return buckets.where("doc <> hub").select(*pair).distinct()


def _open_sets(docs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The whole shingle set of each given document: doc, hashes."""
    few = F.broadcast(docs) if docs.count() <= BROADCAST_IDS else docs

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in batch_rows(iter([batch]), "doc", "text"):
                hashes = shingle_hashes(normal_words(text), size).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc], pa.int64()), pa.array([hashes], pa.list_(pa.int64()))],
                    names=["doc", "hashes"],
                )

    held = texts.join(few, "doc", "left_semi").select("doc", "text")
    return held.mapInArrow(shingles, "doc long, hashes array<bigint>")


def _lone_shingles(sets: DataFrame) -> DataFrame:
    """How many shingles of each document none of the others holds: doc, alone."""
    each = sets.select("doc", F.explode("hashes").alias("shingle"))
    ends = each.groupBy("shingle").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"))
    return ends.where("doc = last").groupBy("doc").agg(F.count("*").alias("alone"))


def _open_rows(rows: DataFrame) -> DataFrame:
    """Rows of buckets that hold more than one component, with the bucket's largest component."""
    parts = rows.groupBy("key", "root").agg(F.count("*").alias("n"))
    state = (
        parts.groupBy("key")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top"))
        .where("top.n < n")
        .select("key", F.col("top.root").alias("top"))
    )
    return rows.join(store(state, "open-buckets"), "key")


def _rest_links(
    buckets: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links of a bucket that the comparisons with its hub have left open: a, b.

    Rows of one component need no comparison among each other; those outside the bucket's largest
    component are paired with all others, each pair in the first bucket that both are in. Two sets
    have no more in common than either has in common with all documents of open buckets; pairs that
    this bound or the signature distance rules out are dropped inside the join.
    """
    roots = labels.select(F.col("node").alias("doc"), "root")
    rows = buckets.where("n > 2 AND doc <> hub").select("key", "j", "doc").join(roots, "doc", "left")
    rows = store(rows.withColumn("root", F.coalesce("root", "doc")), "bucket-rows")
    open_ = store(_open_rows(rows).drop("top"), "open-rows")
    docs = store(open_.select("doc").distinct(), "open-documents")
    hashes = store(_open_sets(docs, texts, size), "open-hashes")
    # Of an id with several texts nothing is known to be its own.
    several = classes.groupBy("doc").count().where("count > 1")
    alone = _lone_shingles(hashes).join(several, "doc", "left_anti")
    sets = hashes.join(alone, "doc", "left").join(classes.drop("digest"), "doc")
    shared = F.size("hashes") - F.coalesce("alone", F.lit(0))
    keys = _keys(chunks_needed(percent / 100)).alias("keys")
    n = F.size("hashes").alias("n_shingles")
    sets = sets.select("doc", "signature", keys, n, shared.alias("shared"), "hashes")
    sets = store(sets.where(100 * F.col("shared") >= percent * F.col("n_shingles")), "open-sets")
    left = store(_open_rows(open_.join(sets.select("doc"), "doc", "left_semi")), "rest")
    whole = left.join(sets, "doc")
    carried = ("key", "doc", "root", "signature", "keys", "n_shingles", "shared", "hashes")
    others = left.where("root <> top").join(sets, "doc").select(
        *(F.col(name).alias(f"{name}_x") for name in carried)
    )
    col = F.col
    once = (col("root") != col("root_x")) & ((col("root") == col("top")) | (col("doc_x") < col("doc")))
    both = percent * (col("n_shingles") + col("n_shingles_x"))
    possible = F.least("shared", "shared_x") * (100 + percent) >= both
    first = F.expr("NOT arrays_overlap(slice(keys, 1, j), slice(keys_x, 1, j))")
    chunks = chunks_needed(percent / 100)
    near = _differing(col("signature"), col("signature_x"), chunks) <= radius(percent / 100)
    similar = F.size(F.array_intersect("hashes", "hashes_x")) * (100 + percent) >= both
    same = (col("key") == col("key_x")) & once & possible & first & near & similar
    links = whole.join(others, same)
    return links.select(F.least("doc", "doc_x").alias("a"), F.greatest("doc", "doc_x").alias("b"))


def _near(pairs: DataFrame, signatures: DataFrame, similarity: float) -> DataFrame:
    """Pairs within the signature distance."""
    of = lambda name, to: signatures.select(F.col("doc").alias(name), F.col("signature").alias(to))
    both = pairs.join(of("a", "sa"), "a").join(of("b", "sb"), "b")
    apart = _differing(F.col("sa"), F.col("sb"), chunks_needed(similarity))
    return both.where(apart <= radius(similarity)).select("a", "b")


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough; only documents of a pair are shuffled."""
    pairs = store(pairs, "near")
    ids = store(
        pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))).distinct(),
        "near-ids",
    )
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = texts.join(few, "doc", "left_semi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, known = [], {}

            def hashes(doc: int, text: str, known: dict = known) -> np.ndarray:
                if doc not in known:
                    known[doc] = shingle_hashes(normal_words(text), size)
                return known[doc]

            for a, b, text_a, text_b in batch_rows(iter([batch]), "a", "b", "text_a", "text_b"):
                x, y = hashes(a, text_a), hashes(b, text_b)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    kept.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    side = lambda name: texts.select(F.col("doc").alias(name), F.col("text").alias(f"text_{name}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "a long, b long")


def link_groups(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Group documents linked by similar shingle sets: doc_id, n_shingles, component_id, kept.

    Words are runs of characters other than blank and U+0009 to U+000D, A-Z lower-cased; a set holds
    the distinct runs of ``size`` words. Two documents are linked when their sets' Jaccard similarity
    is at least ``percent`` hundredths. ``component_id`` is the smallest id reachable over links.

    Candidates: signatures of 16-bit MinHash values, split into chunks of four; in each indexed chunk
    one wrong value is allowed by indexing the chunk once without each of its values. Every pair
    with fewer than two wrong values a chunk on average shares a key; ``chunks_needed`` chooses the
    number of chunks so that a pair at the threshold is within that distance but for 3 in a million.
    Pairs are then confirmed on their whole sets.

    Documents of one word sequence are one class, compared through its smallest id. Buckets are never
    expanded into all pairs: first every row is compared with its bucket's hub; rows that are in one
    component then are not compared again. Of the others, documents with too many shingles of their
    own can't reach the threshold with anyone and drop out; the rest is compared as far as shingles
    shared with anyone allow. Nothing is capped: every pair of a bucket is compared, known to be
    connected or known to be too far apart.

    Null and empty texts, and texts without words, have empty sets and are linked with nothing. Fewer
    words than ``size`` are one run. Rows with a null id are returned with themselves as (null)
    component and kept. Rows that repeat an id are returned as often as they occur and count as one
    document if their words agree; otherwise all their links count for that id. Extra columns are
    ignored. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    similarity = percent / 100
    profiles = store(profile(rows, size), "signatures")
    usable = profiles.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy("digest").agg(
        F.min("doc_id").alias("doc"),
        F.first("signature").alias("signature"),
        F.first("n_shingles").alias("n_shingles"),
    )
    classes = store(classes, "classes")
    chunks = chunks_needed(similarity)
    keys = classes.select("doc", F.posexplode(_keys(chunks)).alias("j", "key"))
    # The hub is the row of the least hash, so that buckets of one group tend to share theirs.
    shared = (
        keys.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("doc"), "doc")).alias("hub"))
        .where("n > 1")
        .select("key", F.col("hub.doc").alias("hub"), "n")
    )
    buckets = store(keys.join(store(shared, "shared-keys"), "key").select("key", "j", "doc", "hub", "n"), "buckets")

    # A document's id stands for its class; only the class's first document brings its text.
    texts = rows.select(F.col("doc_id").alias("doc"), "text")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return _confirm(pairs, texts, size, percent)

    labels = components(confirmed(_near(_hub_pairs(buckets), classes, similarity)))
    rest = _rest_links(buckets, labels, classes, texts, size, percent)
    known = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
    labels = components(known.unionByName(rest))

    of_class = classes.select("digest", "doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    of_class = of_class.select("digest", F.coalesce("root", "doc").alias("root"))
    return (
        profiles.select("doc_id", "n_shingles", "digest")
        .join(of_class, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id"))
            .otherwise(F.col("doc_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; all columns.

    Rows that repeat both id and text count once; see ``link_groups`` for everything else. Only rows
    that repeat an id are shuffled with their texts.
    """
    groups = store(link_groups(docs, size, percent), "groups")
    gone = store(groups.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct(), "gone")
    few = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text")
    )
    left = rows.join(few, F.col("id") == F.col("gone"), "left_anti")
    again = groups.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL")
    again = store(again.select(F.col("doc_id").alias("again")), "repeated")
    repeated = again.count()
    if repeated:
        again = F.broadcast(again) if repeated <= BROADCAST_IDS else again
        same = F.col("id") == F.col("again")
        once = left.join(again, same, "left_semi").dropDuplicates(["id", "text"])
        left = left.join(again, same, "left_anti").unionByName(once)
    return left.select("row.*")
