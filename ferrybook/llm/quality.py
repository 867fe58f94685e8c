"""Quality classifier: regularised quadratic discriminant over document statistics.

A document becomes a short vector of transformed statistics of its text. For either class the count,
mean and covariance of the training rows are sums that Spark adds up over all of them; covariances
are shrunk towards the pooled variances. A score is the difference of the classes' log densities
(Mahalanobis distances through cached Cholesky factors), made a probability by a logistic curve
that is fitted to a histogram of the training rows' differences.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import give_back, pieces, scratch, stored, tidy
from ferrybook.llm.shingles import SPACES, Words

SHRINKAGE = 0.2
ACCEPT = 0.3
CLIP, BINS = 60.0, 240

_UPPER, _DIGIT, _SPACE, _LINE, _POINT, _SYMBOL, _REST, _HIGH = range(8)
_CLASS = np.full(256, _REST, np.uint8)
_CLASS[0x80:0xC0] = 255  # later bytes of a character
_CLASS[0xC0:] = _HIGH
_CLASS[:0x20] = _SPACE
_CLASS[0x21:0x30] = _CLASS[0x3A:0x41] = _CLASS[0x5B:0x61] = _CLASS[0x7B:0x80] = _SYMBOL
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = _POINT
_CLASS[0x41:0x5B] = _UPPER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x20] = _SPACE
_CLASS[0x0A] = _LINE
FEATURES = 12


def features(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text. A null or blank text has defined values."""
    words = Words(texts, SPACES)
    hashes = words.hashes()
    kinds = _CLASS[words.raw]
    rows = len(texts)
    filled = np.flatnonzero(np.diff(words.offsets))
    counts = np.zeros((8, rows))
    for kind in range(8):
        if len(filled):
            counts[kind, filled] = np.add.reduceat(kinds == kind, words.offsets[:-1][filled], dtype=np.int64)
    sizes = np.diff(words.rows)
    again = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes):
        same = np.zeros(len(hashes), bool)
        same[1:] = hashes[1:] == hashes[:-1]
        inner = words.rows[:-1][sizes > 0]
        same[inner] = False
        again[1:] = np.cumsum(same)
    repeats = again[words.rows[1:]] - again[words.rows[:-1]]
    distinct, most = np.ones(rows), np.zeros(rows)
    for i, (a, b) in enumerate(zip(words.rows[:-1], words.rows[1:])):
        if b > a:
            _, n = np.unique(hashes[a:b], return_counts=True)
            distinct[i], most[i] = len(n), n.max()
    chars = np.maximum(counts.sum(0), 1)
    n = np.maximum(sizes, 1)
    letters = np.maximum(counts[_UPPER] + counts[_REST] + counts[_HIGH], 1)
    rare = lambda x, floor=1e-2: np.log(floor + x)
    return np.stack(
        [
            np.log1p(sizes),
            np.log((letters + counts[_DIGIT]) / n),
            rare(counts[_SYMBOL] / chars),
            rare(counts[_UPPER] / letters),
            rare(counts[_DIGIT] / chars),
            rare(counts[_POINT] / chars),
            rare(counts[_SPACE] / chars),
            rare(counts[_LINE] / n),
            rare(counts[_HIGH] / letters, 1e-1),
            rare(repeats / n),
            np.log(distinct + 1) / np.log(n + 1),
            rare(most / n),
        ],
        1,
    )


def featured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, f) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 1):
            values = pa.array(features(part.column(1)).reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * FEATURES, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "f"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, f array<double>")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learnt from: a fifth, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Model(NamedTuple):
    means: np.ndarray  # per class
    factors: np.ndarray  # inverse Cholesky factors of the covariances
    constants: np.ndarray  # log determinants and priors
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, with priors."""
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            z = (x - mean) @ factor.T
            logs.append(constant - 0.5 * (z * z).sum(1))
        return np.clip(logs[1] - logs[0], -CLIP, CLIP)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.difference(x) + self.offset)))


def _discriminant(sums: dict[int, tuple[int, np.ndarray, np.ndarray]], shrinkage: float) -> Model:
    means, covariances, counts = [], [], []
    for label in (0, 1):
        n, total, products = sums[label]
        mean = total / n
        means.append(mean)
        covariances.append(products / n - np.outer(mean, mean))
        counts.append(n)
    pooled = sum(n * np.diag(c) for n, c in zip(counts, covariances)) / sum(counts)
    target = np.diag(np.maximum(pooled, 1e-6))
    factors, constants = [], []
    for n, c in zip(counts, covariances):
        lower = np.linalg.cholesky((1 - shrinkage) * c + shrinkage * target)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(n / sum(counts)) - np.log(np.diag(lower)).sum())
    return Model(np.array(means), np.array(factors), np.array(constants))


def _calibrated(model: Model, bins: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> Model:
    """Slope and offset by Newton steps of a weighted logistic regression on the histogram; a weak prior
    keeps the slope finite and positive for classes that do not overlap."""
    x = np.stack([bins / 10, np.ones_like(bins)], 1)
    w = np.array([1.0, 0.0])
    prior = np.diag([1.0, 1.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (ones - (zeros + ones) * p) - prior @ (w - [1.0, 0.0])
        hessian = (x * ((zeros + ones) * p * (1 - p))[:, None]).T @ x + prior
        step = np.linalg.solve(hessian, gradient)
        w = w + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return model._replace(slope=max(float(w[0]) / 10, 1e-3), offset=float(w[1]))


def fit(feats: DataFrame, labels: DataFrame, label: str = "quality", shrinkage: float = SHRINKAGE) -> Model | None:
    """The model of all labelled rows that are not held out; None where a class has fewer than two.

    A document labelled more than once counts with the smallest label.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    marked = marked.where("y in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("y").alias("y")).where(~held_out())
    train = stored(feats.join(marked, "doc_id").select("y", "f"), "train")
    upper = [(i, j) for i in range(FEATURES) for j in range(i, FEATURES)]
    sums = [F.sum(F.col("f")[i]) for i in range(FEATURES)] + [F.sum(F.col("f")[i] * F.col("f")[j]) for i, j in upper]
    rows = train.groupBy("y").agg(F.count(F.lit(1)), *sums).collect()
    by_class = {}
    for row in rows:
        products = np.zeros((FEATURES, FEATURES))
        for (i, j), v in zip(upper, row[2 + FEATURES :]):
            products[i, j] = products[j, i] = v
        by_class[row[0]] = (row[1], np.array(row[2 : 2 + FEATURES]), products)
    if any(by_class.get(y, (0,))[0] < 2 for y in (0, 1)):
        return None
    model = _discriminant(by_class, shrinkage)
    width = 2 * CLIP / BINS
    binned = train.select("y", F.floor((_applied(model.difference)(F.col("f")) + CLIP) / width).alias("bin"))
    zeros, ones = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for y, at, n in binned.groupBy("y", "bin").agg(F.count(F.lit(1))).collect():
        (ones if y else zeros)[at] = n
    return _calibrated(model, (np.arange(BINS + 1) + 0.5) * width - CLIP, zeros, ones)


def _applied(function):
    def run(lists: pa.Array) -> pa.Array:
        return pa.array(function(lists.flatten().to_numpy().reshape(-1, FEATURES)), pa.float64())

    return F.arrow_udf(run, "double")


def _from_text(function):
    def run(texts: pa.Array) -> pa.Array:
        parts = [function(features(p.column(0))) for p in pieces([pa.RecordBatch.from_arrays([texts], ["text"])], 0)]
        give_back()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return F.arrow_udf(run, "double")


def _unknown(x: np.ndarray) -> np.ndarray:
    return np.full(len(x), 0.5)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Only the text enters a score; a null or blank one has a score like any other. Without training
    rows of both classes every score is 0.5. Repeated rows score alike; a document labelled more than
    once counts with the smallest label. Long texts are read whole. An empty table gives no rows; other columns are not read.
    """
    feats = stored(featured(docs, doc_id, text), "features")
    model = fit(feats, labels)
    score = _applied(model.score if model else _unknown)(F.col("f"))
    out = feats.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns.

    Null, empty and long texts are scored like others, repeated rows alike. Without training rows of both
    classes all rows stay. An empty table gives an empty one; columns of any name pass through.
    """
    with scratch(docs.sparkSession):
        model = fit(stored(featured(docs, doc_id, text), "features"), labels)
    score = _from_text(model.score if model else _unknown)(F.col(text).cast("string"))
    return docs.where(score >= ACCEPT)
