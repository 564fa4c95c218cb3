"""Embedding whitening by the exact characteristic polynomial of the integer scatter."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kedai.llm.common import small_batches, store

# Entries become floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32

# Primes stay below 2**31, so that products of two residues fit 64 bits.
PRIME_BITS = 31
# Bits beyond the gap to the next eigenvalue to which a root is known, and roots closer to each other
# than this many bits below the trace count as one of higher multiplicity.
ROOT_BITS, CLUSTER_BITS = 80, 200
# Sums of squares below this are exact in doubles.
EXACT = 1 << 53
LONG = 1 << 63


# --- exact sums ------------------------------------------------------------------------------


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows whose vector is there and whose entries are all finite: vec_id, vector (doubles)."""
    entries = F.col(vector_col).cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), entries.alias("vector")).where(
        F.col("vector").isNotNull() & ~bad
    )


def steps(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """floor(SCALE * entry) of every vector of a batch; entries that a vector lacks are 0."""
    column = batch.column("vector")
    lengths = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), size))
    held = np.arange(size)[None, :] < lengths[:, None]
    out[held] = column.flatten().to_numpy(zero_copy_only=False)
    out = np.floor(SCALE * out)
    if len(out) and np.abs(out).max(initial=0) >= LONG // 4:
        raise OverflowError("an entry is beyond the range of a long")
    return out.astype(np.int64)


def _product(rows: np.ndarray) -> np.ndarray:
    """rows' * rows as exact integers: in doubles while they hold it, else as Python integers."""
    top = int(np.abs(rows).max(initial=0))
    if top * top * len(rows) < EXACT:
        real = rows.astype(np.float64)
        return (real.T @ real).astype(np.int64).astype(object)
    whole = rows.astype(object)
    return whole.T @ whole


def moments(vectors: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, sums by dimension and sums of products by pair of dimensions, all exact.

    Every task adds up its own rows; the sums of tasks are added by Spark as 38-digit decimals, so
    what reaches the driver is one row for each pair of dimensions.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        sums = np.zeros(size, dtype=object)
        products = np.zeros((size, size), dtype=object)
        for batch in batches:
            rows = steps(batch, size)
            n += len(rows)
            sums += rows.astype(object).sum(axis=0) if len(rows) else 0
            products += _product(rows)
        if not n:
            return
        i, j = np.triu_indices(size)
        values = [n, *sums.tolist(), *products[i, j].tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([[-2], np.full(size, -1), i]), pa.int32()),
                pa.array(np.concatenate([[0], np.arange(size), j]), pa.int32()),
                pa.array([Decimal(int(value)) for value in values], pa.decimal128(38, 0)),
            ],
            names=["i", "j", "value"],
        )

    parts = vectors.select("vector").mapInArrow(partial, "i int, j int, value decimal(38,0)")
    found = parts.groupBy("i", "j").agg(F.sum("value").cast("string").alias("value")).collect()
    n, sums = 0, [0] * size
    products = [[0] * size for _ in range(size)]
    for row in found:
        value = int(row["value"])
        if row["i"] == -2:
            n = value
        elif row["i"] == -1:
            sums[row["j"]] = value
        else:
            products[row["i"]][row["j"]] = products[row["j"]][row["i"]] = value
    return n, sums, products


def scatter(n: int, sums: list[int], products: list[list[int]]) -> list[list[int]]:
    """n * products - sums * sums', which is n * n times the covariance, whatever the shift."""
    size = len(sums)
    return [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]


# --- characteristic polynomial ---------------------------------------------------------------


def primes(count: int) -> list[int]:
    """The largest primes below 2**PRIME_BITS, falling."""
    out, candidate = [], (1 << PRIME_BITS) - 1
    while len(out) < count:
        if _is_prime(candidate):
            out.append(candidate)
        candidate -= 2
    return out


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 2**32."""
    d, r = n - 1, 0
    while not d % 2:
        d, r = d // 2, r + 1
    for base in (2, 7, 61):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo p whose entries below the first subdiagonal are 0."""
    a = matrix.copy()
    size = len(a)
    for k in range(size - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[pivot, k + 1]] = a[[k + 1, pivot]]
            a[:, [pivot, k + 1]] = a[:, [k + 1, pivot]]
        factors = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factors[:, None] * a[k + 1][None, :] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factors[None, :] % p).sum(axis=1)) % p
    return a


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo p, from x**0 on."""
    h = hessenberg(matrix, p)
    size = len(h)
    # Row k is the polynomial of the leading k x k block.
    rows = np.zeros((size + 1, size + 1), dtype=np.int64)
    rows[0, 0] = 1
    for k in range(1, size + 1):
        rows[k, 1:] = rows[k - 1, :-1]
        rows[k] = (rows[k] - h[k - 1, k - 1] * rows[k - 1]) % p
        chain = 1
        for i in range(k - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            rows[k] = (rows[k] - chain * int(h[i, k - 1]) % p * rows[i]) % p
    return rows[size]


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x - matrix), from x**0 on, for a matrix without negative eigenvalues.

    One task row for each prime; there are as many primes as the largest coefficient needs: the k-th
    symmetric function of the eigenvalues is at most C(size, k) * (trace / size)**k. Residues are put
    together on the driver, one number for each coefficient and prime.
    """
    size = len(matrix)
    mean = Fraction(max(1, sum(matrix[i][i] for i in range(size))), size)
    bound = max(math.comb(size, k) * math.ceil(mean**k) for k in range(size + 1))
    count = math.ceil((bound.bit_length() + 2) / (PRIME_BITS - 1))
    used = primes(count)
    text = [[str(value) for value in row] for row in matrix]

    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.array([[int(value) for value in row] for row in text], dtype=object)
        for frame in frames:
            found = [polynomial_modulo((whole % p).astype(np.int64), p) for p in frame["p"].tolist()]
            yield pd.DataFrame({"p": frame["p"], "residues": found})

    slots = min(count, max(1, spark.sparkContext.defaultParallelism))
    residues = spark.createDataFrame([(p,) for p in used], "p long").repartition(slots)
    found = {
        row["p"]: row["residues"]
        for row in residues.mapInPandas(reduce, "p long, residues array<bigint>").collect()
    }
    return [remainder([(found[p][k], p) for p in used]) for k in range(size + 1)]


def remainder(residues: list[tuple[int, int]]) -> int:
    """The integer of least size with the given residues (Chinese remainder theorem)."""
    value, product = 0, 1
    for residue, p in residues:
        value += (residue - value) * pow(product, -1, p) % p * product
        product *= p
    return value - product if 2 * value > product else value


# --- roots -----------------------------------------------------------------------------------


def roots_above(coefficients: list[int], numerator: int, bits: int) -> int:
    """Roots greater than numerator / 2**bits, with multiplicity, of a polynomial with real roots.

    All roots being real, Descartes' rule is exact: their number is that of the sign changes among the
    coefficients after the shift by that point.
    """
    size = len(coefficients) - 1
    work = [c << (bits * (size - k)) for k, c in enumerate(coefficients)]
    for low in range(size):
        for k in range(size - 1, low - 1, -1):
            work[k] += numerator * work[k + 1]
    signs = [c > 0 for c in work if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(coefficients: list[int], numerator: int, bits: int) -> int:
    value = 0
    for k, c in enumerate(reversed(coefficients)):
        value = value * numerator + (c << (bits * k))
    return (value > 0) - (value < 0)


class Root:
    """An eigenvalue in (low, high] / 2**bits, ``count`` times."""

    def __init__(self, low: int, high: int, bits: int, count: int):
        self.low, self.high, self.bits, self.count = low, high, bits, count

    def value(self) -> Fraction:
        return Fraction(self.low + self.high, 2 << self.bits)


def positive_roots(coefficients: list[int], wanted: int) -> list[Root]:
    """The largest positive roots, falling, so many that ``wanted`` of them are there (with
    multiplicity), each known to ROOT_BITS bits beyond its distance from the others.

    Intervals are halved until each holds one root, or roots closer together than CLUSTER_BITS bits
    below the largest; single roots are then bisected by sign.
    """
    zeros = next(k for k, c in enumerate(coefficients) if c)
    rest = coefficients[zeros:]
    size = len(rest) - 1
    if not size:
        return []
    top = (-rest[-2]).bit_length()  # the sum of the roots
    found: list[Root] = []
    # Halves that are open, the uppermost last: low, high, bits, roots above low, roots above high.
    open_ = [(0, 1 << top, 0, size, 0)]
    taken = 0
    while open_ and taken < wanted + 1:
        low, high, bits, above_low, above_high = open_.pop()
        count = above_low - above_high
        if not count:
            continue
        if count == 1 or _closer(low, high, bits, top):
            found.append(Root(low, high, bits, count))
            taken += count
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        above = roots_above(rest, middle, bits)
        open_.append((low, middle, bits, above_low, above))
        open_.append((middle, high, bits, above, above_high))
    for k, root in enumerate(found):
        _refine(rest, root, found[k + 1] if k + 1 < len(found) else None)
    return found


def _closer(low: int, high: int, bits: int, top: int) -> bool:
    """Whether an interval is narrower than CLUSTER_BITS bits below the largest root."""
    return Fraction(high - low, 1 << bits) < Fraction(1 << top, 1 << CLUSTER_BITS)


def _refine(coefficients: list[int], root: Root, below: Root | None) -> None:
    """Bisect an interval to ROOT_BITS bits of its own value, and of its distance from the next root."""
    at_high = _sign(coefficients, root.high, root.bits) if root.count == 1 else 0
    while True:
        width = Fraction(root.high - root.low, 1 << root.bits)
        next_ = Fraction(below.high, 1 << below.bits) if below else Fraction(0)
        gap = Fraction(root.low, 1 << root.bits) - next_
        least = min(Fraction(root.low, 1 << root.bits), gap) if gap > 0 else Fraction(root.low, 1 << root.bits)
        if root.low and width <= least / (1 << ROOT_BITS):
            return
        if root.high - root.low == 1:
            root.low, root.high, root.bits = 2 * root.low, 2 * root.high, root.bits + 1
        middle = (root.low + root.high) // 2
        if root.count > 1:
            if root.bits > 4 * CLUSTER_BITS:
                return
            # All of a cluster's roots stay on one side, or the cluster is as narrow as it gets.
            above = roots_above(coefficients, middle, root.bits)
            over = roots_above(coefficients, root.high, root.bits)
            if above - over not in (0, root.count):
                return
            if above - over:
                root.low = middle
            else:
                root.high = middle
            continue
        sign = _sign(coefficients, middle, root.bits)
        if not sign:
            root.low, root.high, root.bits, at_high = 2 * middle - 1, 2 * middle, root.bits + 1, 0
        elif sign == at_high:
            root.high = middle
        else:  # also where the root is the upper end itself, which has no sign
            root.low = middle


# --- components ------------------------------------------------------------------------------


def null_vectors(matrix: list[list[int]], root: Fraction, count: int, bits: int) -> np.ndarray:
    """``count`` orthonormal columns of the null space of matrix - root, by inverse iteration.

    Everything is fixed-point with ``bits`` bits after the point, in Python integers: the shifted
    matrix is factored once with row pivots, and solved for ``count`` starts until they stand still.
    """
    size, one = len(matrix), 1 << bits
    shift = (root.numerator << bits) // root.denominator
    a = np.array([[value << bits for value in row] for row in matrix], dtype=object)
    a[np.arange(size), np.arange(size)] -= shift
    order = np.arange(size)
    least = max(1, int(max(abs(v) for v in a.ravel())) >> (bits // 2 + bits // 4))
    for k in range(size):
        pivot = k + int(np.argmax(np.abs(a[k:, k])))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[[k, pivot]] = order[[pivot, k]]
        if abs(a[k, k]) < least:
            a[k, k] = least
        if k + 1 < size:
            a[k + 1 :, k] = (a[k + 1 :, k] << bits) // a[k, k]
            a[k + 1 :, k + 1 :] -= (a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]) >> bits
    starts = np.random.default_rng(size).integers(1, 1 << 30, (size, count)).astype(object)
    x = _orthonormal(starts << (bits - 30), bits)
    for _ in range(6):
        y = x[order].copy()
        for k in range(1, size):
            y[k] -= (a[k, :k] @ y[:k]) >> bits
        for k in range(size - 1, -1, -1):
            above = (a[k, k + 1 :] @ y[k + 1 :]) >> bits if k + 1 < size else 0
            y[k] = ((y[k] - above) << bits) // a[k, k]
        before, x = x, _orthonormal(y, bits)
        # Old columns lie in the span of the new ones when nothing moves any more.
        inside = (x @ ((x.T @ before) >> bits)) >> bits
        if max(abs(int(v)) for v in (before - inside).ravel()) < one >> 70:
            break
    return np.array([[int(v) / one for v in row] for row in x])


def _orthonormal(columns: np.ndarray, bits: int) -> np.ndarray:
    """Gram-Schmidt, twice, in fixed point; columns are scaled to unit size first."""
    out: list[np.ndarray] = []
    for column in columns.T:
        for _ in range(2):
            top = max(abs(int(v)) for v in column) or 1
            column = np.array([(int(v) << bits) // top for v in column], dtype=object)
            for other in out:
                column = column - ((int(column @ other) * other) >> (2 * bits))
            norm = math.isqrt(int(column @ column)) or 1
            column = np.array([(int(v) << bits) // norm for v in column], dtype=object)
        out.append(column)
    return np.array(out, dtype=object).T


def components(
    spark: SparkSession, matrix: list[list[int]], wanted: int
) -> tuple[list[Fraction], np.ndarray]:
    """The largest eigenvalues above 0 of an integer scatter matrix, falling, and their unit vectors
    (as columns), at most ``wanted``. Vectors are found side by side, one task row for each root.
    """
    roots = positive_roots(characteristic(spark, matrix), wanted)
    if not roots:
        return [], np.zeros((len(matrix), 0))
    jobs = []
    for k, root in enumerate(roots):
        if sum(r.count for r in roots[:k]) >= wanted:
            break
        value = root.value()
        gaps = [abs(other.value() - value) for other in roots if other is not root] + [value]
        ratio = Fraction(sum(matrix[i][i] for i in range(len(matrix)))) / min(g for g in gaps if g)
        bits = 2 * (math.ceil(ratio).bit_length() + ROOT_BITS + 64)
        jobs.append((k, str(value.numerator), str(value.denominator), root.count, bits))
    text = [[str(value) for value in row] for row in matrix]

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [[int(value) for value in row] for row in text]
        for frame in frames:
            rows = [
                (row.k, at, vector.tolist())
                for row in frame.itertuples()
                for at, vector in enumerate(
                    null_vectors(whole, Fraction(int(row.top), int(row.bottom)), row.n, row.bits).T
                )
            ]
            yield pd.DataFrame(rows, columns=["k", "at", "vector"])

    table = spark.createDataFrame(jobs, "k int, top string, bottom string, n int, bits int")
    slots = min(len(jobs), max(1, spark.sparkContext.defaultParallelism))
    found = (
        table.repartition(slots).mapInPandas(solve, "k int, at int, vector array<double>").collect()
    )
    found = sorted(found, key=lambda row: (row["k"], row["at"]))[:wanted]
    return [roots[row["k"]].value() for row in found], np.array([row["vector"] for row in found]).T


# --- operator --------------------------------------------------------------------------------


def _deviations(scaled: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Sum over dimensions of (n * step - sum)**2, exact."""
    top = n * int(np.abs(scaled).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if top * top * max(1, scaled.shape[1]) < LONG:
        centred = n * scaled - sums.astype(np.int64)
        return (centred * centred).sum(axis=1).tolist()
    centred = n * scaled.astype(object) - sums
    out = [int(v) for v in (centred * centred).sum(axis=1)]
    if max(out, default=0) >= LONG:
        raise OverflowError("a deviation is beyond the range of a long")
    return out


def _covariance(whitened: DataFrame, size: int, n: int) -> np.ndarray:
    """Covariance of the stored whitened vectors, centred before multiplying; two passes."""
    means = whitened.agg(*[F.avg(F.col("values")[k]) for k in range(size)]).first()
    centre = np.array([float(mean) for mean in means])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            flat = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            rows = flat.reshape(-1, size) - centre
            total += rows.T @ rows
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "value"]
        )

    parts = whitened.select("values").mapInArrow(partial, "i int, j int, value double")
    out = np.zeros((size, size))
    for row in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["value"] / n
    return out


def whiten(
    vectors: DataFrame, wanted: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Whitened components of every vector: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Entries become x = floor(64 * entry) + 1,000,000, so the scatter matrix of x, n * sum(x x') - S S',
    is one of integers and is added up exactly. Its characteristic polynomial is found modulo primes by
    Hessenberg reduction and put together by the Chinese remainder theorem; its roots are isolated by
    exact sign counts and bisected to 80 bits beyond their distances; its components are null vectors
    of the matrix less a root, by inverse iteration in fixed point. ``whitened`` is x - S / n on the
    component, over the root of its variance e; ``explained`` is e over the whole variance; ``deviation``
    is the exact sum of (n * x - S)**2; ``identity_error`` the largest entry by which the whitened
    vectors' covariance differs from the identity.

    Vectors that are null or hold null or non-finite entries take no part. Entries that a vector lacks
    against the longest one count as 0. There is one row for each vector and component with e > 0, at
    most ``wanted``: fewer than that with few dimensions or vectors, none where all vectors are equal or
    the table is empty. Repeated rows and ids and null ids are vectors of their own. Entries or deviations beyond
    the range of a long raise an error. Extra columns are ignored.

    The driver holds the sums, dimensions squared, and one residue for each coefficient and prime.
    Vectors are read in three passes and never shuffled.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = _usable(vectors, id_col, vector_col)
    size = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    if not size:
        return spark.createDataFrame([], schema)
    n, sums, products = moments(rows, size)
    matrix = scatter(n, sums, products)
    values, axes = components(spark, matrix, wanted)
    if not values:
        return spark.createDataFrame([], schema)
    trace = sum(matrix[i][i] for i in range(size))
    explained = [float(value / trace) for value in values]
    # x - S / n is (n * x - S) / n, and e is the root over n * n: the n falls out.
    scaled_axes = axes / np.array([_root(value) for value in values])
    totals = np.array(sums, dtype=object)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = steps(batch, size)
            deviations = _deviations(scaled, n, totals)
            if n * int(np.abs(scaled).max(initial=0)) < LONG >> 1 and max(map(abs, sums)) < LONG >> 1:
                centred = (n * scaled - totals.astype(np.int64)).astype(np.float64)
            else:
                centred = (n * scaled.astype(object) - totals).astype(np.float64)
            found = centred @ scaled_axes
            offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviations, pa.int64()), values],
                names=["vec_id", "deviation", "values"],
            )

    wide = store(
        rows.mapInArrow(project, "vec_id long, deviation long, values array<double>"), "whitened"
    )
    error = float(np.abs(_covariance(wide, len(values), n) - np.eye(len(values))).max())
    shares = F.array(*[F.lit(share) for share in explained])
    return wide.select(
        "vec_id", "deviation", F.posexplode("values").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _root(value: Fraction) -> float:
    """The square root of a fraction of any size, to double precision."""
    scale = max(0, 256 - value.numerator.bit_length() + value.denominator.bit_length())
    scale += scale % 2
    return float(Fraction(math.isqrt((value.numerator << scale) // value.denominator), 1 << (scale // 2)))
