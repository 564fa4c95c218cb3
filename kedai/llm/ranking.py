"""Ranked lexical search: summed accumulators of short lists beside document-at-a-time long lists."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kedai.llm.common import small_batches, store, text_or_empty

TOP = 50

# Items are searched in blocks of about this many bytes of text; a block's terms go to every task.
BLOCK_BYTES = 4 << 20
# Documents that a task indexes and searches at a time.
WINDOW = 4096
# Lists of up to this share of a window's documents are summed before the search.
SHORT = 1 / 16

# Letters and digits of ASCII and all other characters beyond ASCII make terms; A-Z are lower-cased.
_TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(_TERM_BYTES).split()


# --- items -----------------------------------------------------------------------------------


@dataclass
class Block:
    """Items that are searched together: their ids, their terms' numbers, and the numbered terms."""

    ids: list
    items: list[list[int]]
    vocabulary: dict[bytes, int]


def blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Items dealt into blocks of about ``block_bytes`` by a hash of their id; one block is collected
    at a time. Rows of one id are one item with the terms of all of them."""
    rows = items.select(F.col(id_col).alias("item_id"), text_or_empty(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    if not total:
        return
    count = -(-int(total) // block_bytes)
    part = F.pmod(F.xxhash64("item_id"), F.lit(count))
    rows = store(rows.withColumn("part", part), "items") if count > 1 else rows.withColumn("part", F.lit(0))
    for number in range(count):
        held: dict = {}
        for row in rows.where(F.col("part") == number).collect():
            terms = held.setdefault(row["item_id"], set())
            terms.update(terms_of(row["text"].encode("utf-8", "surrogatepass")))
        if held:
            names = sorted(set().union(*held.values()))
            vocabulary = {term: k for k, term in enumerate(names)}
            yield Block(list(held), [sorted(vocabulary[t] for t in terms) for terms in held.values()], vocabulary)


# --- index -----------------------------------------------------------------------------------

INDEX = "doc_id long, n_terms long, terms array<int>, counts array<int>"


def index(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Every document with a term: its number of terms, and which terms of the vocabulary it holds how
    often."""

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            ids, sizes, terms, counts, ends = [], [], [], [], [0]
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                words = terms_of(text)
                if not words:
                    continue
                found = Counter(words)
                held = known & found.keys()
                ids.append(doc)
                sizes.append(len(words))
                terms += [vocabulary[term] for term in held]
                counts += [found[term] for term in held]
                ends.append(len(terms))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts, pa.int32())),
                ],
                names=["doc_id", "n_terms", "terms", "counts"],
            )

    return rows.mapInArrow(postings, INDEX)


@dataclass
class Collection:
    """What scores need of the whole corpus: documents, terms with repeats, each term's weight."""

    documents: int
    terms: int
    weights: np.ndarray

    def norms(self, sizes: np.ndarray) -> np.ndarray:
        """50 + (50 * n * N) div L of documents of ``n`` terms."""
        if int(sizes.max(initial=0)) * self.documents < (1 << 63) // 50:
            return 50 + 50 * sizes * self.documents // self.terms
        return np.array([50 + 50 * int(n) * self.documents // self.terms for n in sizes], dtype=np.int64)


def collection(indexed: DataFrame, size: int) -> Collection:
    """Counts over all documents; one number for each term of the vocabulary reaches the driver."""
    whole = indexed.agg(F.count("*").alias("n"), F.sum("n_terms").alias("l")).first()
    found = indexed.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    held = np.zeros(size, dtype=np.int64)
    for row in found:
        held[row["term"]] = row["count"]
    top = 2 * whole["n"] + 2
    weights = [math.floor(1000 * math.log(top / (2 * int(df) + 1))) if df else 0 for df in held]
    return Collection(whole["n"], whole["l"] or 0, np.array(weights, dtype=np.int64))


# --- search ----------------------------------------------------------------------------------


class Best:
    """The best documents of one item so far: highest score, then smallest id, a null id last."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int64)
        self.nameless = np.empty(0, dtype=bool)

    def least(self) -> int:
        """Documents below this score can't get in; one at it may."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        nameless = np.concatenate([self.nameless, nameless])
        order = np.lexsort((ids, nameless, -scores))[: self.top]
        self.scores, self.ids, self.nameless = scores[order], ids[order], nameless[order]


class Lists:
    """Postings of one window of documents by term: places in document order, and parts of scores."""

    def __init__(self, terms: np.ndarray, places: np.ndarray, parts: np.ndarray, size: int, documents: int):
        order = np.argsort(terms, kind="stable")
        self.places, self.parts = places[order], parts[order]
        self.bounds = np.searchsorted(terms[order], np.arange(size + 1))
        self.documents = documents
        self._sums = np.zeros(documents, dtype=np.int64)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        held = slice(self.bounds[term], self.bounds[term + 1])
        return self.places[held], self.parts[held]

    def summed(self, lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """One list with the sums of several, in document order."""
        if len(lists) == 1:
            return lists[0]
        for places, parts in lists:
            self._sums[places] += parts
        places = np.flatnonzero(self._sums)
        parts = self._sums[places]
        self._sums[places] = 0
        return places, parts

    def search(self, terms: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and whole scores of all documents whose score is at least ``least``, and only those.

        Short lists are summed into accumulators first, which then are one iterator with one bound,
        like a long list. Iterators whose bounds add up to less than ``least`` can't bring a document
        in by themselves: the others name the documents, which are visited in order and looked up in
        those iterators, highest bound first, skipping what lies between; a document is given up as
        soon as the bounds left can't lift it. If no iterator is needed, the window is skipped.
        """
        short, iterators = [], []
        for places, parts in map(self.of, terms):
            if len(places) > self.documents * SHORT:
                iterators.append((int(parts.max()), places, parts))
            elif len(places):
                short.append((places, parts))
        if short:
            places, parts = self.summed(short)
            if len(places):
                iterators.append((int(parts.max()), places, parts))
        iterators.sort(key=lambda one: -one[0])
        left = sum(bound for bound, _, _ in iterators)
        naming = 0
        while naming < len(iterators) and left >= least:
            left -= iterators[naming][0]
            naming += 1
        if not naming:
            return self.places[:0], self.parts[:0]
        places, scores = self.summed([one[1:] for one in iterators[:naming]])
        for bound, others, parts in iterators[naming:]:
            alive = scores + left >= least
            places, scores = places[alive], scores[alive]
            if not len(places):
                break
            at = np.searchsorted(others, places)
            at[at == len(others)] = 0
            scores = scores + np.where(others[at] == places, parts[at], 0)
            left -= bound
        alive = scores >= least
        return places[alive], scores[alive]


def _window_lists(batches: list[pa.RecordBatch], corpus: Collection) -> Lists:
    sizes = np.concatenate([b.column("n_terms").to_numpy() for b in batches])
    lengths = np.concatenate([np.diff(np.asarray(b.column("terms").offsets)) for b in batches])
    terms = np.concatenate([b.column("terms").flatten().to_numpy() for b in batches])
    counts = np.concatenate([b.column("counts").flatten().to_numpy() for b in batches]).astype(np.int64)
    places = np.repeat(np.arange(len(sizes)), lengths)
    norms = corpus.norms(sizes)[places]
    parts = corpus.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * norms))
    return Lists(terms, places, parts, len(corpus.weights), len(sizes))


def _ranked(indexed: DataFrame, block: Block, corpus: Collection, top: int) -> DataFrame:
    """The best documents of every item in each task's share of the index: item, doc_id, score."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in block.items]
        held: list[pa.RecordBatch] = []

        def window() -> None:
            lists = _window_lists(held, corpus)
            ids = pa.concat_arrays([b.column("doc_id") for b in held])
            nameless = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            held.clear()
            for one, terms in zip(best, block.items, strict=True):
                places, scores = lists.search(terms, one.least())
                if len(places):
                    one.add(scores, ids[places], nameless[places])

        for batch in batches:
            held.append(batch)
            if sum(len(b) for b in held) >= WINDOW:
                window()
        if held:
            window()
        for number, one in enumerate(best):
            if len(one.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(one.scores), number, dtype=np.int32)),
                        pa.array(one.ids, mask=one.nameless),
                        pa.array(one.scores),
                    ],
                    names=["item", "doc_id", "score"],
                )

    found = indexed.mapInArrow(search, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def rank(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``top`` highest-scoring documents of every item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased. With N
    documents that have a term, L terms in all, n in a document, and df documents that hold a term, a
    term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))); a document's score sums
    w * (10**9 * tf div (1000 * tf + 20 * (50 + 50 * n * N div L))) over the item's terms, each once.
    Only scores above 0 count; equal scores go by ascending document id, a null id last.

    Documents are indexed over the items' terms and searched where the index lies, some thousand at a
    time in document order, see ``Lists.search``; the least score that still matters is carried on. Each
    task keeps ``top`` documents an item, which Spark ranks. Items are searched in blocks, so that what a
    task is given does not grow with their number.

    Null and empty texts hold no term: such documents don't count, such items find nothing. Rows of one
    item id are one item with the terms of all of them, a null id included. Repeated document rows are
    documents of their own. Extra columns are ignored; an empty table on either side gives an empty
    result. Texts of any length are counted whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = items.schema[item_col].dataType
    results = [_search_block(spark, rows, block, kind, top) for block in blocks(items, item_col, item_text_col)]
    if not results:
        schema = T.StructType([T.StructField("item_id", kind), *_result_fields()])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, results)


def _result_fields() -> list[T.StructField]:
    kinds = {"rank": T.IntegerType(), "doc_id": T.LongType(), "score": T.LongType()}
    return [T.StructField(name, kind) for name, kind in kinds.items()]


def _search_block(spark: SparkSession, rows: DataFrame, block: Block, kind: T.DataType, top: int) -> DataFrame:
    indexed = store(index(rows, block.vocabulary), "term-index")
    corpus = collection(indexed, len(block.vocabulary))
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
    names = spark.createDataFrame(list(enumerate(block.ids)), schema)
    # The block's ids are bounded by its bytes.
    found = _ranked(indexed, block, corpus, top).join(F.broadcast(names), "item")
    return found.select("item_id", "rank", "doc_id", "score")
