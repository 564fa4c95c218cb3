"""Benchmark decontamination: SimHash of item-sized windows, a multi-index Hamming join, exact check.

DataFrame functions only.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kedai.llm.common import store, text_or_empty

SHINGLE = 5
SIMILARITY = 0.8

# Two 64-bit fingerprints in blocks of 8 bits. Up to ERRORS wrong bits of a block are enumerated, so
# by the pigeonhole principle all fingerprints with at most RADIUS wrong bits meet.
#
# A fingerprint votes with the weights that are verified afterwards. A window that holds 0.8 of an item's
# weight, and nothing of other items, is a part of the item's vote: the angle between the two has a cosine
# of sqrt(0.8) where weights are alike, which turns 19 of 128 bits with a deviation of 4; where the missing
# fifth lies in the heaviest half it is sqrt(0.6), 28 bits with a deviation of 4.7. A window that holds an
# item whole beside as much of another one differs by sqrt(0.5), 32 bits with a deviation of 4.9.
BITS, BLOCK, ERRORS = 64, 8, 2
BLOCKS = 2 * BITS // BLOCK
RADIUS = BLOCKS * (ERRORS + 1) - 1

# Shorter items than one shingle are searched as one run, if they have this many characters.
SHORT_CHARACTERS = 20

# Rows and bytes of benchmark relations that are broadcast at most.
BROADCAST_ROWS, BROADCAST_BYTES = 1 << 18, 32 << 20


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def _shingles(words: str) -> str:
    """SQL for the runs of five words of an array, repeated ones included."""
    return (
        f"transform(IF(size({words}) < {SHINGLE}, CAST(array() AS ARRAY<INT>), "
        f"sequence(1, size({words}) - {SHINGLE - 1})), "
        f"i -> concat_ws(' ', slice({words}, i, {SHINGLE})))"
    )


def _fingerprint(held: str, name: str) -> str:
    """SQL for one 64-bit fingerprint: each bit by the weighted majority of the hashes of what is held.

    ``held`` is an array of (h0, h1, weight), sorted, so that equal sets give equal sums.
    """
    votes = (
        f"aggregate({held}, 0D, (n, x) -> n + "
        f"IF((shiftright(x.{name}, b) & 1L) = 1L, x.weight, -x.weight))"
    )
    return f"aggregate(sequence(0, {BITS - 1}), 0L, (f, b) -> f | IF({votes} > 0, shiftleft(1L, b), 0L))"


def _prints(df: DataFrame) -> DataFrame:
    """Fingerprints f0, f1 of what each row holds."""
    return df.withColumn("f0", F.expr(_fingerprint("held", "h0"))).withColumn("f1", F.expr(_fingerprint("held", "h1")))


def _vote(shingle: str, weight: str) -> Column:
    hashes = (F.xxhash64(F.lit(seed), F.col(shingle)).alias(f"h{seed}") for seed in (0, 1))
    return F.struct(*hashes, F.col(weight).alias("weight"))


def masks() -> list[int]:
    """All ways to change at most ``ERRORS`` bits of a block."""
    return [
        sum(1 << bit for bit in bits)
        for errors in range(ERRORS + 1)
        for bits in itertools.combinations(range(BLOCK), errors)
    ]


def blocks(f0: str = "f0", f1: str = "f1") -> Column:
    """A fingerprint's blocks as an array of (block number, value)."""
    per = BITS // BLOCK
    values = []
    for k in range(BLOCKS):
        bits = F.shiftrightunsigned(F.col(f1 if k >= per else f0), BLOCK * (k % per))
        value = bits.bitwiseAND(F.lit((1 << BLOCK) - 1).cast("long")).alias("value")
        values.append(F.struct(F.lit(k).alias("block"), value))
    return F.array(*values)


def index_of(items: DataFrame) -> DataFrame:
    """Items by every value that a block of a fingerprint within the radius may have: length, block, value,
    item, g0, g1. Fingerprints of one length alone are compared."""
    variants = F.explode(F.array(*[F.lit(mask).cast("long") for mask in masks()])).alias("mask")
    each = items.select("item", "length", "f0", "f1", F.explode(blocks()).alias("b")).select("*", variants)
    return each.select(
        "length",
        F.col("b.block").alias("block"),
        F.col("b.value").bitwiseXOR(F.col("mask")).alias("value"),
        "item",
        F.col("f0").alias("g0"),
        F.col("f1").alias("g1"),
    )


def meet(prints: DataFrame, index: DataFrame) -> DataFrame:
    """All pairs of a window (length, f0, f1 and more) and an item of its length whose fingerprints are
    within the radius; a pair comes once for each block that it shares."""
    looked = prints.withColumn("b", F.explode(blocks()))
    looked = looked.withColumns({"block": F.col("b.block"), "value": F.col("b.value")}).drop("b")
    wrong = F.bit_count(F.col("f0").bitwiseXOR(F.col("g0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("g1")))
    return looked.join(index, ["length", "block", "value"]).where(wrong <= RADIUS).drop("block", "value", "g0", "g1")


def _small(df: DataFrame, *texts: str) -> DataFrame:
    """A stored relation, broadcast if its checked numbers of rows and bytes allow it; ``texts`` are its
    columns of any size."""
    sizes = [F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(name)))), F.lit(0)) for name in texts]
    count, *sizes = df.agg(F.count("*"), *sizes).first()
    taken = 64 * count + 2 * sum(sizes)
    return F.broadcast(df) if count <= BROADCAST_ROWS and taken <= BROADCAST_BYTES else df


def items_of(benchmark: DataFrame) -> DataFrame:
    """Items of five words or more: item_id, words, length, shingles, weighted.

    A shingle weighs one over the number of items that hold it; ``weighted`` has the distinct shingles
    by weight.
    """
    words = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), words_of(text_or_empty()).alias("words")
    ).where(f"item_id IS NOT NULL AND size(words) >= {SHINGLE}")
    items = store(words.withColumn("shingles", F.expr(_shingles("words"))), "items")
    each = items.select("item_id", "words", F.explode(F.array_distinct("shingles")).alias("shingle"))
    held = each.groupBy("shingle").agg(F.count("*").alias("n"))
    weighted = (
        each.join(held, "shingle")
        .groupBy("item_id", "words", "n")
        .agg(F.collect_list("shingle").alias("shingles"))
        .groupBy("item_id", "words")
        .agg(F.array_sort(F.collect_list(F.struct((1 / F.col("n")).alias("weight"), "shingles"))).alias("weighted"))
    )
    sized = items.select("item_id", "words", F.size("words").alias("length"), "shingles")
    return store(sized.join(weighted, ["item_id", "words"]), "item-weights")


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Item-sized windows around every shingle that an item holds: doc_id, text_key, start, length, window.

    A window without a shingle of an item has similarity 0. Windows follow from the places that shingles
    have in items, not from the items: what many items share at one place makes one window.
    """
    postings = items.select("length", F.posexplode("shingles").alias("offset", "shingle")).select(
        F.xxhash64("shingle").alias("hash"), "length", "offset"
    )
    postings = store(postings.distinct(), "postings")
    texts = docs.withColumn("words", words_of(F.col("text"))).where(F.size("words") >= SHINGLE)
    at = F.explode(F.sequence(F.lit(0), F.size("words") - SHINGLE)).alias("at")
    run = F.concat_ws(" ", *[F.col("words")[F.col("at") + k] for k in range(SHINGLE)])
    start = (F.col("at") - F.col("offset")).alias("start")
    window = F.expr("slice(words, greatest(start, 0) + 1, start + length - greatest(start, 0))")
    key = ["doc_id", "text_key", "start", "length"]
    few = _small(postings)
    if few is not postings:
        spots = texts.select("doc_id", "text_key", "words", at).withColumn("hash", F.xxhash64(run))
        found = spots.join(few, "hash").select("doc_id", "text_key", start, "length", "words")
        return found.select(*key, window.alias("window")).dropDuplicates(key)
    spots = texts.select("doc_id", "text_key", "words", at).select(
        "doc_id", "text_key", "at", F.xxhash64(run).alias("hash")
    )
    places = spots.join(postings, "hash").select("doc_id", "text_key", start, "length").distinct()
    again = texts.select("doc_id", "text_key", "words").dropDuplicates(["doc_id", "text_key"])
    same = places["doc_id"].eqNullSafe(again["doc_id"]) & (places["text_key"] == again["text_key"])
    found = places.join(again, same).select(places["doc_id"], places["text_key"], "start", "length", "words")
    return found.select(*key, window.alias("window"))


def _window_prints(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Windows with their shingles and fingerprints; shingles that no item holds have no vote."""
    held = items.select(F.explode("weighted").alias("w")).select(
        F.col("w.weight").alias("weight"), F.explode("w.shingles").alias("shingle")
    )
    held = store(held.distinct(), "shingle-weights")
    key = ["doc_id", "text_key", "start", "length"]
    windows = windows.withColumn("shingles", F.expr(f"array_distinct({_shingles('window')})"))
    size = F.size("window").alias("n_words")
    each = windows.select(*key, size, "shingles", F.explode("shingles").alias("shingle"))
    votes = F.array_sort(F.collect_list(_vote("shingle", "weight"))).alias("held")
    found = each.join(_small(held, "shingle"), "shingle").groupBy(*key).agg(
        votes, F.first("n_words").alias("n_words"), F.first("shingles").alias("shingles")
    )
    return _prints(found).drop("held")


def short_items(benchmark: DataFrame) -> DataFrame:
    """Items of fewer words than a shingle, but SHORT_CHARACTERS characters or more: item_id, length, run."""
    words = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), words_of(text_or_empty()).alias("words")
    ).where(f"item_id IS NOT NULL AND size(words) BETWEEN 1 AND {SHINGLE - 1}")
    run = words.select("item_id", F.size("words").alias("length"), F.concat_ws(" ", "words").alias("run"))
    return run.where(F.length("run") >= SHORT_CHARACTERS).distinct()


def _short_found(docs: DataFrame, items: DataFrame) -> list[DataFrame]:
    """Places where a short item stands word by word, one relation for each number of words."""
    texts = docs.withColumn("words", words_of(F.col("text")))
    few = _small(items, "run")
    found = []
    for row in items.select("length").distinct().collect():  # at most SHINGLE - 1
        size = row["length"]
        at = F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start")
        run = F.concat_ws(" ", *[F.col("words")[F.col("start") + k] for k in range(size)])
        spots = texts.where(F.size("words") >= size).select("doc_id", "text_key", "words", at)
        spots = spots.withColumn("run", run).drop("words")
        found.append(
            spots.join(few.where(F.col("length") == size), "run").select(
                "doc_id", "text_key", "item_id", "start", F.col("length").alias("n_words"), F.lit(1.0).alias("similarity")
            )
        )
    return found


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Passages of benchmark items in documents: doc_id, text_key, item_id, start, n_words, similarity.

    The similarity of a window and an item is the weight of the item's five-word shingles that the
    window holds, of the item's whole weight. One row per document and item: the best window's first
    word (counted from 0; the first one among equals, below 0 or beyond the end where an item's edge
    is missing), its length in words, and its similarity, if that is at least ``similarity``.
    ``text_key`` is the xxhash64 of the text and tells rows with one id apart.

    Windows are as long as their item. Their SimHash fingerprints, which vote with the shingles' weights,
    are joined with those of the items of their length through blocks of bits in which up to two wrong
    bits are allowed; all pairs within the radius meet, and are then checked on their shingles. What
    comes from the benchmark is broadcast only below a checked number of rows and bytes; beyond it the
    joins shuffle.

    Items of fewer than five words count as one run, found where it stands word by word, if they have 20
    characters or more; shorter ones are ignored, as chance would find them anywhere. Null and empty texts
    hold nothing. Rows with a null document or item id are returned under a null id or ignored,
    in this order. Repeated rows give one row. Extra columns are ignored; an empty table on either
    side gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    items = items_of(benchmark)
    votes = F.expr("flatten(transform(weighted, w -> transform(w.shingles, s -> named_struct("
                   "'h0', xxhash64(0, s), 'h1', xxhash64(1, s), 'weight', w.weight))))")
    items = _prints(items.withColumn("held", F.array_sort(votes))).drop("held")
    items = store(items.withColumn("item", F.xxhash64("item_id", "words")), "item-prints")
    prints = store(_window_prints(_windows(rows, items), items), "window-prints")
    index = store(index_of(items), "blocks")
    key = ["doc_id", "text_key", "start", "length"]
    pairs = meet(prints, _small(index)).dropDuplicates([*key, "item"])
    of_item = items.select("item", "item_id", "weighted")
    shared = F.expr("aggregate(weighted, 0D, (t, x) -> t + x.weight * size(array_intersect(x.shingles, shingles)))")
    whole = F.expr("aggregate(weighted, 0D, (t, x) -> t + x.weight * size(x.shingles))")
    checked = pairs.join(_small(of_item, "weighted"), "item").select(
        "doc_id", "text_key", "item_id", "start", "n_words", F.round(shared / whole, 6).alias("similarity")
    )
    short = store(short_items(benchmark), "short-items")
    for found in _short_found(rows, short):
        checked = checked.unionByName(found)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("best")
    return (
        checked.where(F.col("similarity") >= similarity)
        .groupBy("doc_id", "text_key", "item_id")
        .agg(best)
        .select("doc_id", "text_key", "item_id", (-F.col("best.back")).alias("start"), "best.n_words", "best.similarity")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that hold no passage of the benchmark; all their columns as they were."""
    found = contaminated(docs, benchmark, similarity).select("doc_id", "text_key").distinct()
    found = store(found, "contaminated")
    found = _small(found.toDF("found_id", "found_key"))
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text_or_empty()).alias("key"),
    )
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    return keyed.join(found, same, "left_anti").select("row.*")
