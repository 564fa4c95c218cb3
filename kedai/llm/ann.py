"""Nearest neighbours by few stable projections, a kd-tree over them, and a chi-square stopping test."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kedai.llm.common import small_batches, store

PROJECTIONS = 8
# Chance, at most, that a neighbour nearer than the k-th found lies beyond the stopping place.
CERTAINTY = 0.96
# Rows of a block and of a tree leaf; queries handled together; rows that the cells are cut by.
BLOCK_ROWS, LEAF_ROWS, QUERY_ROWS = 4096, 128, 4096
SAMPLE_ROWS = 1 << 14
SEED = 7


def chi_square(value: np.ndarray, degrees: int) -> np.ndarray:
    """Distribution function of the chi-square law with an even number of degrees."""
    half = np.minimum(value / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for k in range(1, degrees // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


@dataclass(frozen=True)
class Projection:
    """Projects vectors so that larger inner products become smaller distances.

    A vector gets one more component that fills its norm up to the largest one; a query gets 0. The
    squared distance is then largest**2 + |query|**2 - 2 * product. Each projection is Gaussian, so a
    squared projected distance is the squared distance times a chi-square variable.
    """

    matrix: np.ndarray
    largest: float

    @classmethod
    def draw(cls, dimension: int, largest: float) -> Projection:
        matrix = np.random.default_rng(SEED).standard_normal((dimension + 1, PROJECTIONS))
        return cls(matrix, largest)

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        missing = np.sqrt(np.maximum(self.largest**2 - (vectors**2).sum(axis=1), 0))
        return vectors @ self.matrix[:-1] + missing[:, None] * self.matrix[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.matrix[:-1]

    def distances(self, queries: np.ndarray, products: np.ndarray) -> np.ndarray:
        norms = (queries**2).sum(axis=1)
        return np.maximum(self.largest**2 + norms[:, None] - 2 * products, 1e-12)


def _cut(points: np.ndarray) -> tuple[int, float]:
    """Axis of the greatest spread and the median on it."""
    axis = int(points.var(axis=0).argmax())
    return axis, float(np.median(points[:, axis]))


class Cells:
    """The upper part of the kd-tree, cut at medians of a sample; cells are numbered from the root."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axes = np.zeros(1 << depth, dtype=np.int64)
        self.values = np.zeros(1 << depth)
        parts = {1: points}
        for node in range(1, 1 << depth):
            part = parts.pop(node)
            axis, value = _cut(part) if len(part) else (0, 0.0)
            self.axes[node], self.values[node] = axis, value
            low = part[:, axis] <= value
            parts[2 * node], parts[2 * node + 1] = part[low], part[~low]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=np.int64)
        each = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + (points[each, self.axes[node]] > self.values[node])
        return node - (1 << self.depth)


def leaves(points: np.ndarray, size: int = LEAF_ROWS) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree over the points; equal points are split by number."""
    out, open_ = [], [np.arange(len(points))]
    while open_:
        rows = open_.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        axis = int(points[rows].var(axis=0).argmax())
        order = rows[np.argpartition(points[rows, axis], len(rows) // 2)]
        open_ += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return out


def _box_distances(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from each query to each box."""
    out = np.zeros((len(queries), len(low)))
    for axis in range(queries.shape[1]):
        at = queries[:, axis, None]
        out += np.maximum(np.maximum(low[:, axis] - at, at - high[:, axis]), 0) ** 2
    return out


def search_block(
    projection: Projection,
    ids: np.ndarray,
    vectors: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    bounds: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The k best ids and products of one block for each query (-1 and -inf where there are fewer).

    A query's leaves are verified in the order of their projected distance. It stops when a neighbour
    better than the k-th found would, with the wanted certainty, have been projected nearer than the
    next leaf. ``bounds`` are k-th products known from other blocks.
    """
    points, seen = projection.rows(vectors), projection.queries(queries)
    tree = leaves(points)
    low = np.array([points[rows].min(axis=0) for rows in tree])
    high = np.array([points[rows].max(axis=0) for rows in tree])
    away = _box_distances(seen, low, high)
    order = np.argsort(away, axis=1, kind="stable")
    best = np.full((len(queries), k), -np.inf)
    found = np.full((len(queries), k), -1, dtype=np.int64)
    active = np.arange(len(queries))
    for step in range(len(tree)):
        leaf = order[active, step]
        kth = np.maximum(best[active, -1], bounds[active])
        next_ = away[active, leaf]
        distance = projection.distances(queries[active], kth[:, None])[:, 0]
        go = np.isneginf(kth) | (
            chi_square(next_ / np.where(np.isfinite(distance), distance, 1), PROJECTIONS) < CERTAINTY
        )
        active, leaf = active[go], leaf[go]
        if not len(active):
            break
        for number in np.unique(leaf):
            who, rows = active[leaf == number], tree[number]
            products = np.einsum("qd,nd->qn", queries[who], vectors[rows], optimize=True)
            products[query_ids[who][:, None] == ids[rows][None, :]] = -np.inf
            scores = np.concatenate([best[who], products], axis=1)
            names = np.concatenate(
                [found[who], np.broadcast_to(ids[rows], (len(who), len(rows)))], axis=1
            )
            top = np.lexsort((names, -scores), axis=1)[:, :k]
            best[who] = np.take_along_axis(scores, top, axis=1)
            found[who] = np.take_along_axis(names, top, axis=1)
    found[np.isneginf(best)] = -1
    return found, best


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not all zero, every component finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pd.Series | pa.Array) -> np.ndarray:
    return np.array(list(column), dtype=np.float64)


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k rows of largest inner product for every row whose id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id, score: the product in double precision, best first, ties
    to the smaller id; all candidates if there are fewer. A query's own id is no candidate.

    Vectors that are null, all zero or hold a null or non-finite component take no part, nor do rows
    with a null id or a length other than the commonest one (the longest among equals). Repeated rows
    count once. Extra columns are ignored; an empty table gives an empty result.

    Every row is indexed: projected, put into a cell of a kd-tree cut at medians of a bounded sample,
    and, where a cell is large, into one of its blocks. Of equal vectors only the k + 1 smallest ids
    are indexed, as the others can't be among the first k. A query first searches its own cell, then
    the cells that the stopping test doesn't rule out given the k-th product found there. The boxes
    of the cells are the only data on the driver (one for each ``BLOCK_ROWS`` rows at most).
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = rows.select(
        F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
    ).limit(0)
    if lengths is None:
        return empty
    dimension = lengths["d"]
    rows = rows.where(F.size("v") == dimension).distinct()
    equal = Window.partitionBy("v").orderBy("vec_id")
    held = store(
        rows.withColumn("n", F.row_number().over(equal)).where(F.col("n") <= k + 1).drop("n"), "vectors"
    )
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    count, largest = held.agg(F.count("*"), F.sqrt(F.max(square))).first()
    projection = Projection.draw(dimension, largest)

    depth = max(0, min(math.ceil(math.log2(max(1, count / BLOCK_ROWS))), int(math.log2(SAMPLE_ROWS)) - 4))
    sample = held.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").collect()
    cells = Cells(projection.rows(_matrix(row["v"] for row in sample)), depth)

    def place(as_query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    matrix = _matrix(batch.column("v").to_pylist())
                    points = projection.queries(matrix) if as_query else projection.rows(matrix)
                    flat = pa.array(points.reshape(-1))
                    at = pa.array(np.arange(0, points.size + 1, PROJECTIONS, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("vec_id"),
                            batch.column("v"),
                            pa.array(cells.of(points)),
                            pa.ListArray.from_arrays(at, flat),
                        ],
                        names=["vec_id", "v", "cell", "p"],
                    )

        return run

    placed = "vec_id long, v array<double>, cell long, p array<double>"
    indexed = store(held.mapInArrow(place(False), placed), "indexed")
    asked = rows.where(F.col("vec_id") % every == 0).mapInArrow(place(True), placed)
    asked = store(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "cell", "p"), "asked")

    sides = [f(F.col("p")[axis]).alias(f"{f.__name__}{axis}") for axis in range(PROJECTIONS) for f in (F.min, F.max)]
    boxes = indexed.groupBy("cell").agg(F.count("*").alias("n"), *sides).orderBy("cell").collect()
    number = {row["cell"]: row["n"] for row in boxes}
    names = np.array(list(number), dtype=np.int64)
    low = np.array([[row[f"min{axis}"] for axis in range(PROJECTIONS)] for row in boxes])
    high = np.array([[row[f"max{axis}"] for axis in range(PROJECTIONS)] for row in boxes])
    blocks = {cell: -(-n // BLOCK_ROWS) for cell, n in number.items()}

    def visits(first: bool):
        """Cells of each query: the nearest one, or all others that the test doesn't rule out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                points = _matrix(batch.column("p").to_pylist())
                away = _box_distances(points, low, high)
                home = away.argmin(axis=1)
                go = np.zeros(away.shape, dtype=bool)
                if first:
                    go[np.arange(len(home)), home] = True
                else:
                    queries = _matrix(batch.column("q").to_pylist())
                    kth = np.array(batch.column("kth").to_pylist(), dtype=np.float64)
                    reach = projection.distances(queries, kth[:, None])
                    go = np.isneginf(kth)[:, None] | (chi_square(away / reach, PROJECTIONS) < CERTAINTY)
                    go[np.arange(len(home)), home] = False
                which, cell = np.nonzero(go)
                times = np.array([blocks[c] for c in names.tolist()])[cell]
                start = np.cumsum(times) - times
                block = np.arange(times.sum()) - np.repeat(start, times)
                rows_ = pa.array(np.repeat(which, times))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("query_id").take(rows_),
                        batch.column("q").take(rows_),
                        batch.column("kth").take(rows_),
                        pa.array(np.repeat(names[cell], times)),
                        pa.array(block.astype(np.int64)),
                    ],
                    names=["query_id", "q", "kth", "cell", "block"],
                )

        return run

    counts = vectors.sparkSession.createDataFrame(
        [(cell, blocks[cell]) for cell in number], "cell long, blocks int"
    )
    data = indexed.join(counts, "cell").select(
        "cell", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"), "vec_id", "v"
    )

    def answer(key: tuple, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or block.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids = queries["query_id"].to_numpy(np.int64)
        found, best = search_block(
            projection,
            block["vec_id"].to_numpy(np.int64),
            _matrix(block["v"]),
            ids,
            _matrix(queries["q"]),
            queries["kth"].to_numpy(np.float64),
            k,
        )
        there = ~np.isneginf(best)
        return pd.DataFrame(
            {
                "query_id": np.broadcast_to(ids[:, None], found.shape)[there],
                "vec_id": found[there],
                "score": best[there],
            }
        )

    def searched(visited: DataFrame) -> DataFrame:
        """Blocks and their queries meet in groups of bounded size; busy blocks are repeated."""
        visited = store(visited, "visits")
        load = visited.groupBy("cell", "block").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
        load = store(load, "load")
        queries = visited.join(load, ["cell", "block"]).selectExpr(
            "cell", "block", "pmod(xxhash64(query_id), parts) AS part", "query_id", "q", "kth"
        )
        copies = data.join(load, ["cell", "block"]).selectExpr(
            "cell", "block", "explode(sequence(0L, parts - 1L)) AS part", "vec_id", "v"
        )
        key = ["cell", "block", "part"]
        return store(
            queries.groupBy(*key)
            .cogroup(copies.groupBy(*key))
            .applyInPandas(answer, "query_id long, vec_id long, score double"),
            "found",
        )

    visit = "query_id long, q array<double>, kth double, cell long, block long"
    unbounded = asked.withColumn("kth", F.lit(float("-inf")))
    near = searched(unbounded.mapInArrow(visits(True), visit))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    known = asked.join(ranked.select("query_id", F.col("score").alias("kth")), "query_id", "left")
    known = known.withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
    far = searched(known.mapInArrow(visits(False), visit))
    return (
        near.unionByName(far)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
