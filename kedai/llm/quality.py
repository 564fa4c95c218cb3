"""Quality scores by positive-unlabelled learning with the non-negative risk estimator."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kedai.llm.common import batch_rows, small_batches, text_or_empty

# Rows of the training sample at most: trusted positives and unlabelled texts.
POSITIVES, UNLABELLED = 8000, 12000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
STEPS, RATE, DECAY = 400, 0.05, 1e-3
# Standardised features are clipped, and rare ones are not blown up.
CLIP, LEAST_SCALE = 3.0, 0.1

# Kinds of bytes; pairs of neighbouring kinds describe how a text looks in any language.
_KINDS = 16
_SINGLE = {ord("."): 6, ord(","): 7, ord("!"): 8, ord("?"): 9, ord("|"): 11, ord("#"): 12}


def _kind(byte: int) -> int:
    char = chr(byte)
    if byte >= 0x80:
        return 5
    if char.islower():
        return 0
    if char.isupper():
        return 1
    if char.isdigit():
        return 2
    if char == " ":
        return 3
    if char.isspace():
        return 4
    if byte in _SINGLE:
        return _SINGLE[byte]
    if char in "'\"`":
        return 10
    if char in "$%&*@":
        return 13
    return 14 if char.isprintable() else 15


_TABLE = np.array([_kind(byte) for byte in range(256)], dtype=np.int64)
SIZE = _KINDS * _KINDS + 8


def features(text: str) -> np.ndarray:
    """Shape of a whole text: shares of neighbouring byte kinds, and of repeated words and lines."""
    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(SIZE, dtype=np.float64)
    if not raw:
        out[-1] = 1
        return out
    kinds = _TABLE[np.frombuffer(raw, dtype=np.uint8)]
    pairs = np.bincount(kinds[:-1] * _KINDS + kinds[1:], minlength=_KINDS * _KINDS)
    out[: _KINDS * _KINDS] = np.sqrt(pairs / max(1, pairs.sum()))
    words, lines = raw.split(), raw.split(b"\n")
    counts = Counter(words)
    n = max(1, len(words))
    out[-8:-1] = (
        np.log1p(len(words)),
        len(raw) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        1 - len(set(lines)) / len(lines),
        np.log1p(len(words) / len(lines)),
    )
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -CLIP, CLIP)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.standard(rows) @ self.weights + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class _Adam:
    def __init__(self, size: int):
        self.first, self.second, self.step = np.zeros(size), np.zeros(size), 0

    def move(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.first += 0.1 * (gradient - self.first)
        self.second += 0.001 * (gradient**2 - self.second)
        first = self.first / (1 - 0.9**self.step)
        second = self.second / (1 - 0.999**self.step)
        return RATE * first / (np.sqrt(second) + 1e-8)


def _minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> np.ndarray:
    """Weights of a linear model under the logistic loss.

    With a prior: the non-negative positive-unlabelled risk; while its negative part is below zero,
    that part alone is moved back up. Without: positives against unlabelled, both of weight a half.
    """
    theta = np.zeros(positive.shape[1])
    adam = _Adam(len(theta))
    for _ in range(STEPS):
        p, u = _sigmoid(positive @ theta), _sigmoid(unlabelled @ theta)
        as_positive = positive.T @ (p - 1) / len(p)
        as_negative = positive.T @ p / len(p)
        rest = unlabelled.T @ u / len(u)
        if prior is None:
            gradient = as_positive / 2 + rest / 2
        else:
            loss = lambda x: -np.log(np.maximum(1 - x, 1e-12)).mean()
            negative = rest - prior * as_negative
            if loss(u) - prior * loss(p) < 0:
                gradient = -negative
            else:
                gradient = prior * as_positive + negative
        decay = DECAY * theta
        decay[-1] = 0
        theta = theta - adam.move(gradient + decay)
    return theta


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: no set can hold a smaller share of the unlabelled than
    that share of what it holds of the positives. The smallest ratio over the upper sets of the score
    of positives against unlabelled, with a standard error on top, estimates it."""
    levels = np.quantile(positive, np.linspace(0, 0.5, 101))
    inside = np.array([(positive >= level).mean() for level in levels])
    held = np.array([(unlabelled >= level).mean() for level in levels])
    error = np.sqrt(held * (1 - held) / len(unlabelled)) / inside
    return float(np.clip((held / inside + error).min(), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    scale = np.maximum(scale, LEAST_SCALE)
    plain = Model(mean, scale, np.zeros(len(mean)), 0.0, 0.5)
    one = lambda rows: np.column_stack([plain.standard(rows), np.ones(len(rows))])
    positive, unlabelled = one(positive), one(unlabelled)
    against = _minimise(positive, unlabelled, None)
    prior = estimate_prior(positive @ against, unlabelled @ against)
    theta = _minimise(positive, unlabelled, prior)
    return Model(mean, scale, theta[:-1], float(theta[-1]), prior)


def fold(name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % FOLDS


def _featured(rows: DataFrame) -> DataFrame:
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for (text,) in batch_rows(iter([batch]), "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("trusted"),
                    pa.array([x.astype("<f4").tobytes() for x in found], pa.binary()),
                ],
                names=["trusted", "features"],
            )

    return rows.select("trusted", "text").mapInArrow(rows_of, "trusted boolean, features binary")


def train(rows: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on a bounded sample outside the held-out fold; None without any trusted positive.

    Samples are the rows whose ids have the smallest hashes. Only labels 1 are used, as trusted
    positives; an id with both labels is not trusted. The unlabelled sample is drawn from all texts
    without looking at labels.
    """
    hashed = F.xxhash64("doc_id")
    learn = fold() != HELD_OUT
    present = rows.where(learn).select("doc_id").distinct()
    trusted = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"))
        .where(learn & F.col("q").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("q").alias("q"))
        .where("q = 1")
        .join(present, "doc_id")
        .orderBy(hashed, "doc_id")
        .limit(POSITIVES)
        .select("doc_id", F.lit(True).alias("trusted"))
    )
    drawn = present.orderBy(hashed, "doc_id").limit(UNLABELLED).select("doc_id", F.lit(False).alias("trusted"))
    sample = F.broadcast(trusted.unionByName(drawn))  # at most POSITIVES + UNLABELLED ids
    found = _featured(rows.join(sample, "doc_id").select("trusted", "text")).collect()
    known: dict[bool, list] = {True: [], False: []}
    for row in found:
        known[row["trusted"]].append(np.frombuffer(row["features"], dtype="<f4"))
    if not known[True]:
        return None
    return fit(np.array(known[True], dtype=np.float64), np.array(known[False], dtype=np.float64))


def _scores(model: Model | None, texts: pa.Array) -> np.ndarray:
    found = [features(text or "") for text in texts.to_pylist()]
    if model is None or not found:
        return np.full(len(found), 0.5)
    return model.score(np.array(found))


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Score every whole text: doc_id, held_out, score (likelihood of label 1), predicted.

    A linear model on the shape of the text is trained with trusted positives (label 1 outside the
    held-out fold), unlabelled texts and a class prior estimated from both; see ``train`` for its
    bounded sample. Ids, sources, languages and labels are no inputs of a score.

    Null and empty texts get the score of an empty text. Repeated rows get a row each. Without a
    trusted positive every score is 0.5. Extra columns are ignored; an empty table gives an empty
    result. ``predicted`` is 1 from a score of 0.3 on.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    model = train(rows, labels)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _scores(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(values, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    return (
        rows.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "text")
        .mapInArrow(scores, "doc_id long, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that ``score`` predicts as good, with all their columns as they were.

    Rows are judged where they are read, so no text is shuffled.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    model = train(rows, labels)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(text_col)) >= THRESHOLD))

    return docs.mapInArrow(good, docs.schema)
