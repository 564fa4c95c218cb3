"""Whitening against numpy, and its exact parts against plain integer arithmetic."""

import itertools
from fractions import Fraction

import numpy as np
import pytest

from kedai.llm import queries, whitening


def brute(vectors, wanted=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)) + 1000000
    centred = x - x.sum(axis=0) / len(x)
    covariance = centred.T @ centred / len(x)
    e, axes = np.linalg.eigh(covariance)
    keep = [k for k in range(len(e))[::-1] if e[k] > 1e-9 * max(e.max(), 1e-300)][:wanted]
    deviation = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    return centred @ axes[:, keep] / np.sqrt(e[keep]), e[keep] / np.trace(covariance), deviation


def check(rows, vectors):
    whitened, explained, deviation = brute(list(vectors.values()))
    n, size = len(vectors), whitened.shape[1]
    assert len(rows) == n * size
    found = rows.pivot(index="vec_id", columns="component", values="whitened").loc[list(vectors)].to_numpy()
    assert list(sorted(rows.component.unique())) == list(range(1, size + 1))
    signs = np.sign((found * whitened).sum(axis=0))
    assert np.allclose(found * signs, whitened, atol=1e-8)
    shares = rows.drop_duplicates("component").sort_values("component").explained.to_numpy()
    assert np.allclose(shares, explained, rtol=1e-9)
    of = rows.drop_duplicates("vec_id").set_index("vec_id").loc[list(vectors)]
    assert of.deviation.tolist() == deviation.astype(int).tolist()
    assert set(rows.n) == {n} and rows.identity_error.nunique() == 1 and rows.identity_error.max() < 1e-10


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    vectors = dict(zip(table.vec_id, table.embedding, strict=True))
    check(queries.queries()["op11_whitening"](spark, sf_dir).toPandas(), vectors)


def test_unusable_short_and_repeated_vectors(spark):
    rng = np.random.default_rng(1)
    good = {i: rng.normal(size=5).tolist() for i in range(40)}
    good[40] = good[0]
    rows = [(i, v, 1, 0.5) for i, v in good.items()]
    rows[7] = (7, good[7][:3], 1, 0.5)
    good[7] = good[7][:3] + [0.0, 0.0]
    bad = [None, [None, 1.0], [float("nan")], [1.0, float("inf")], [1.0, float("-inf")]]
    rows += [(100 + i, v, 1, 0.5) for i, v in enumerate(bad)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, n double")
    check(whitening.whiten(table.repartition(3)).toPandas(), good)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id >= 100")).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0
    nameless = spark.createDataFrame([(None, [1.0]), (None, [2.0]), (1, [4.0])], "vec_id long, embedding array<float>")
    assert sorted(r.whitened for r in whitening.whiten(nameless).collect())[1] < 0


def test_fewer_vectors_than_dimensions(spark):
    rng = np.random.default_rng(2)
    vectors = {i: rng.normal(size=12).tolist() for i in range(5)}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    found = whitening.whiten(table).toPandas()
    assert found.component.max() == 4
    check(found, vectors)


def test_equal_variances_share_their_space(spark):
    """All axes alike: one root of multiplicity three; any orthonormal basis whitens."""
    vectors = {i: list(v) for i, v in enumerate(itertools.product([-1.0, 1.0], repeat=3))}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    found = whitening.whiten(table).toPandas()
    assert len(found) == 24 and found.identity_error.max() < 1e-12
    assert np.allclose(found.explained, 1 / 3)


def test_large_entries_stay_exact(spark):
    vectors = {i: [float(2**40 + i * i), float(-(2**35) * i), 0.25 * i] for i in range(6)}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="range of a long"):
        whitening.whiten(table).collect()
    n, sums, products = whitening.moments(
        whitening._usable(table, "vec_id", "embedding"), 3
    )
    x = [[int(64 * c // 1) for c in v] for v in vectors.values()]
    assert (n, sums) == (6, [sum(c) for c in zip(*x, strict=True)])
    assert products == [[sum(v[i] * v[j] for v in x) for j in range(3)] for i in range(3)]


def determinant(matrix):
    """By permutations."""
    size, total = len(matrix), 0
    for order in itertools.permutations(range(size)):
        sign = (-1) ** sum(order[i] > order[j] for i in range(size) for j in range(i + 1, size))
        value = sign
        for i, j in enumerate(order):
            value *= matrix[i][j]
        total += value
    return total


def test_characteristic_polynomial_is_exact(spark):
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 5):
        rows = rng.integers(-(10**9), 10**9, (size + 2, size)).astype(object)
        matrix = [[int(v) for v in row] for row in rows.T @ rows]
        found = whitening.characteristic(spark, matrix)
        for x in (-3, 0, 1, 10**6):
            at = [[(x if i == j else 0) - matrix[i][j] for j in range(size)] for i in range(size)]
            assert sum(c * x**k for k, c in enumerate(found)) == determinant(at)


def test_roots_are_isolated_however_close():
    def polynomial(roots):
        out = [1]
        for root in roots:
            out = [(out[k - 1] if k else 0) - (root * out[k] if k < len(out) else 0) for k in range(len(out) + 1)]
        return out

    for roots in ([7], [0, 0, 5], [3, 3, 3, 8], [10**18, 10**18 + 1, 1], list(range(1, 20)), [2, 4, 8, 16]):
        found = whitening.positive_roots(polynomial(roots), len(roots))
        expected = sorted((r for r in set(roots) if r), reverse=True)
        assert [root.count for root in found] == [roots.count(r) for r in expected]
        for root, r in zip(found, expected, strict=True):
            assert abs(root.value() / r - 1) <= Fraction(1, 1 << 75)
