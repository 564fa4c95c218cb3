"""N-gram Jaccard join by PartEnum signatures, without a false negative."""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kedai.llm.common import batch_rows, mix64, small_batches, store, text_or_empty
from kedai.llm.components import components
from kedai.llm.words import Runs, hash_words, split_words

# A first-level partition of the shingle domain is cut into SECOND parts; ERRORS of them may differ.
SECOND, ERRORS = 3, 1
# Bits of the sketch whose differences never exceed those of two sets, in long integers.
SKETCH_LONGS = 8
# Sets compared with one hub in a task's group; hubs of a key in the first round after the centres, and
# by how much their number grows from round to round.
GROUP, HUBS, GROWTH = 512, 64, 4
# Document ids are broadcast up to this many (16 bytes each); more are joined by shuffling.
BROADCAST_IDS = 1 << 20


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words are one run, none is empty."""
    words = [word.lower() for word in split_words(text)]
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(Runs(hash_words(words)).all(min(size, len(words))))


def class_of(hashes: np.ndarray) -> int:
    """One number for all documents with the same set."""
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


@functools.lru_cache(maxsize=8)
def bands(percent: int, top: int = 1 << 40) -> list[int]:
    """Largest size of each band; similar sets lie in the same band or in neighbouring ones."""
    out, least = [], 1
    while least <= top:
        out.append(100 * least // percent)
        least = out[-1] + 1
    return out


def differences(percent: int, band: int) -> int:
    """The most elements in which two similar sets of this band and the one before can differ."""
    return 2 * bands(percent)[band] * (100 - percent) // (100 + percent)


def first_level(errors: int) -> int:
    """Partitions of which at least one has no more than ERRORS of so many differing elements."""
    return -(-(errors + 1) // (ERRORS + 1))


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set: similar sets that differ share at least one.

    For its own band and the next one: shingles are dealt to first-level partitions, so many that one of
    them holds at most ERRORS of the differing ones (pigeonhole), and each of those to SECOND parts. A
    key is what the set has in one choice of SECOND - ERRORS parts; the parts without a difference are
    among the choices. Bands that allow no difference need no key, as equal sets are one class.
    """
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    mixed, keys = mix64(hashes), []
    own = int(np.searchsorted(bands(percent), len(hashes)))
    for band in (own, own + 1):
        errors = differences(percent, band)
        if not errors:
            continue
        firsts = first_level(errors)
        sums = np.zeros(firsts * SECOND, dtype=np.uint64)
        np.add.at(sums, (mixed % np.uint64(firsts * SECOND)).astype(np.int64), mix64(mixed))
        sums = sums.reshape(firsts, SECOND)
        names = np.arange(firsts, dtype=np.uint64)
        for number, parts in enumerate(itertools.combinations(range(SECOND), SECOND - ERRORS)):
            tag = mix64((names << np.uint64(24)) + np.uint64(band * 64 + number + 1))
            keys.append(mix64(sums[:, parts].sum(axis=1, dtype=np.uint64) + tag))
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, dtype=np.int64)


def sketch(hashes: np.ndarray) -> list[int]:
    """Parities of the elements in each of the sketch's bins: two sketches differ in no more bins than
    their sets in elements."""
    bins = (mix64(hashes ^ np.uint64(0x5DEECE66D)) % np.uint64(64 * SKETCH_LONGS)).astype(np.int64)
    odd = (np.bincount(bins, minlength=64 * SKETCH_LONGS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


# --- passes over the texts -------------------------------------------------------------------


def _profile(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Of every row: doc_id, the class of its set, the set's size, and its keys."""

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, size) for (text,) in batch_rows(iter([batch]), "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(map(class_of, sets), pa.int64()),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array([signatures(hashes, percent) for hashes in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "class", "n_shingles", "keys"],
            )

    return rows.mapInArrow(profiles, "doc_id long, class long, n_shingles long, keys array<bigint>")


def _sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The sets of the wanted documents (doc_id, class): class, n, sketch, hashes."""
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in batch_rows(iter([batch]), "class", "text"):
                hashes = shingles(text, size)
                if class_of(hashes) != name:
                    continue  # another row of the same id
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name], pa.int64()),
                        pa.array([len(hashes)], pa.int64()),
                        pa.array([sketch(hashes)], pa.list_(pa.int64())),
                        pa.array([hashes.view(np.int64)], pa.list_(pa.int64())),
                    ],
                    names=["class", "n", "sketch", "hashes"],
                )

    schema = "class long, n long, sketch array<bigint>, hashes array<bigint>"
    return rows.join(few, "doc_id").select("class", "text").mapInArrow(sets, schema)


# --- comparisons -----------------------------------------------------------------------------


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, class) whose whole sets are similar: a, b.

    The sets of a hub's partners are dealt to groups of about GROUP, each of which gets the hub's set in
    front. A task reads its groups in order and holds one hub's set and one batch.
    """
    pairs = store(pairs, "pairs")
    groups = pairs.groupBy("hub").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    groups = store(groups, "hub-groups")
    members = (
        pairs.join(groups, "hub")
        .withColumn("part", F.pmod(F.xxhash64("class"), F.col("groups")).cast("int"))
        .join(sets.select("class", "hashes"), "class")
        .select("hub", "part", F.lit(1).alias("turn"), "class", "hashes")
    )
    part = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part")
    fronts = groups.select("hub", part).join(
        sets.select(F.col("class").alias("hub"), F.col("class"), "hashes"), "hub"
    )
    fronts = fronts.select("hub", "part", F.lit(0).alias("turn"), "class", "hashes")
    dealt = members.unionByName(fronts).repartition("hub", "part").sortWithinPartitions("hub", "part", "turn")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        front = np.empty(0, dtype=np.int64)
        for batch in batches:
            found: list[tuple[int, int]] = []
            column = batch.column("hashes")
            values, offsets = column.flatten().to_numpy(), np.asarray(column.offsets)
            offsets = offsets - offsets[0]
            for k, (hub, turn, name) in enumerate(batch_rows(iter([batch]), "hub", "turn", "class")):
                hashes = values[offsets[k] : offsets[k + 1]]
                if not turn:
                    front = hashes.copy()
                elif _similar(front, hashes, percent):
                    found.append((hub, name))
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[i] for pair in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    return dealt.mapInArrow(compare, "a long, b long")


def _sketched(sets: DataFrame) -> DataFrame:
    """Size and sketch of every class, a column for each part: class, n, s0, s1, ..."""
    parts = [F.col("sketch")[k].alias(f"s{k}") for k in range(SKETCH_LONGS)]
    return sets.select("class", "n", *parts).dropDuplicates(["class"])


def _close(percent: int, other: str) -> Column:
    """Whether two sets may be similar by their sizes and sketches; columns of the second have a suffix."""
    n, m = F.col("n"), F.col(f"n{other}")
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    parts = [F.bit_count(F.col(f"s{k}").bitwiseXOR(F.col(f"s{k}{other}"))) for k in range(SKETCH_LONGS)]
    apart = functools.reduce(lambda x, y: x + y, parts)
    return sizes & (apart * (100 + percent) <= (n + m) * (100 - percent))


def _rooted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    roots = labels.select(F.col("node").alias("class"), "root")
    return rows.drop("root").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))


def _open(rows: DataFrame) -> DataFrame:
    """Rows of keys that still hold more than one component, with the key's largest one as ``top``."""
    parts = rows.groupBy("key", "root").agg(F.count("*").alias("n_rows"))
    state = parts.groupBy("key").agg(
        F.count("*").alias("n_roots"), F.max(F.struct("n_rows", "root")).alias("top")
    )
    state = state.where("n_roots > 1").select("key", F.col("top.root").alias("top"))
    return rows.drop("top").join(store(state, "open-keys"), "key")


def _classes_linked(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components of the classes that share keys, over all similar pairs among them: node, root.

    First every set is compared with the centre of each of its keys, the set that shares keys with most
    others. What a key then holds of one component needs no comparison among itself. Of the sets outside
    the key's largest component, some are taken as hubs and compared with all sets of other components
    that sizes and sketches allow; they are done then. The next round takes more of them, until each
    key holds one component or no pair is left.
    """
    degree = members.groupBy("class").agg(F.sum("n_rows").alias("degree"))
    rows = store(members.join(store(degree, "degrees"), "class").select("key", "class", "degree"), "members")
    weight = F.struct("degree", F.xxhash64("class"), "class")
    centres = rows.groupBy("key").agg(F.max(weight).alias("centre"))
    centres = store(centres.select("key", F.col("centre.class").alias("hub")), "centres")
    rows = rows.join(centres, "key").where("class <> hub")
    pairs = rows.select("hub", "class").distinct()
    labels = components(_links(pairs, sets, percent))
    rows = _open(store(_rooted(rows.drop("hub"), labels), "rooted"))
    rows = store(rows.join(_sketched(sets), "class"), "open-rows")
    hubs_of_key = HUBS
    while not rows.isEmpty():
        order = Window.partitionBy("key").orderBy(F.desc("degree"), F.xxhash64("class"), "class")
        hubs = rows.where("root <> top").withColumn("place", F.row_number().over(order))
        hubs = store(hubs.where(F.col("place") <= hubs_of_key).drop("place", "degree", "top"), "hubs")
        names = {name: f"{name}_h" for name in hubs.columns if name != "key"}
        met = rows.join(hubs.withColumnsRenamed(names), "key").where(
            (F.col("root") != F.col("root_h")) & _close(percent, "_h")
        )
        pairs = met.select(F.col("class_h").alias("hub"), "class").distinct()
        known = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
        labels = components(known.unionByName(_links(pairs, sets, percent)))
        rows = rows.join(hubs.select("key", "class"), ["key", "class"], "left_anti")
        rows = store(_open(store(_rooted(rows, labels), "rooted")), "open-rows")
        hubs_of_key *= GROWTH
    return labels


def join_groups(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of ``percent`` hundredths or more of their
    sets of word runs: doc_id, n_shingles, component_id.

    Words are runs of characters other than blank and U+0009 to U+000D, A-Z lower-cased; a set holds
    the distinct runs of ``size`` words. ``component_id`` is the smallest id reachable over links.

    Candidates share a PartEnum signature (see ``signatures``), so that no similar pair is missed, whatever
    its place; then sets are compared whole. Documents of one set are one class. Keys are counted by partial
    sums before the shuffle; keys of one class alone go no further. Keys shared by many classes are compared
    through hubs, see ``_classes_linked``; nothing is capped.

    Null and empty texts and texts without words have empty sets and are linked with nothing. Fewer words
    than ``size`` are one run. Rows that repeat an id are documents of their own, named by that id. Rows
    with a null id are linked with nothing and get a null component. Extra columns are ignored; an empty
    table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    named = rows.where("doc_id IS NOT NULL")
    whole = store(_profile(rows, size, percent), "profiles")
    profiles = whole.drop("keys")
    signed = whole.where("doc_id IS NOT NULL").select(F.explode("keys").alias("key"), "class")
    ends = signed.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    shared = store(ends.where("least <> most").select("key"), "shared-keys")
    members = store(signed.join(shared, "key").distinct(), "key-members")
    counts = store(members.groupBy("key").agg(F.count("*").alias("n_rows")), "key-counts")
    members = members.join(counts, "key")
    of_class = profiles.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("doc_id")
    )
    wanted = store(of_class.join(members.select("class").distinct(), "class", "left_semi"), "open-classes")
    sets = store(_sets(named, wanted, size), "open-sets")
    labels = _classes_linked(members, sets, percent)

    linked = store(_rooted(profiles, labels), "rooted-documents")
    usable = linked.where("doc_id IS NOT NULL AND n_shingles > 0")
    least = store(usable.groupBy("root").agg(F.min("doc_id").alias("component")), "components")
    own = F.when(F.col("n_shingles") > 0, F.col("component"))
    return linked.join(least, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce(own, F.col("doc_id"))).alias("component_id"),
    )
