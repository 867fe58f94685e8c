"""Importance resampling towards a target distribution of hashed word n-grams.

A document's weight is the sum of the gains of its features; the gain of a bucket compares how often the
target and all documents hold its features. Weights are sums over flat arrays of a slice of documents;
with Gumbel noise of the document's id added, the highest scores are a draw without replacement.

The cutoff is found without sorting all scores: a quantile sketch proposes a bracket of scores around
it, exact counts above and inside the bracket tell whether the cutoff lies there, and widen it if not. Only
the bracket is sorted. Ranks of the drawn rows come from a range sort and sums per sorted part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrybook.llm.common import pieces, stored
from ferrybook.llm.shingles import MARKS, Words
from ferrybook.session import broadcast_if_small

BUCKETS = 10000
NGRAMS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SKETCH_ERROR = 0.002
SHORT_WORD = 64  # bytes; longer words are summed one by one

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def _word_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of every word: all words of a slice take their next byte at once, longest first."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    at, by_size = starts[order], -sizes[order]
    state = np.full(len(sizes), 0xFFFFFFFF, np.uint32)
    short = int(np.searchsorted(by_size, -SHORT_WORD))  # words before it are longer
    for step in range(int(min(SHORT_WORD, sizes.max(initial=0)))):
        live = slice(short, int(np.searchsorted(by_size, -step)))
        state[live] = _TABLE[(state[live] ^ data[at[live] + step]) & 0xFF] ^ (state[live] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for k in range(short):
        state[k] = zlib.crc32(data[at[k] : at[k] - by_size[k]].tobytes())
    out = np.empty_like(state)
    out[order] = state
    return out


class _Shift:
    """A crc moved along by a number of bytes: crc32(a + b) = moved(crc32(a), len(b)) ^ crc32(b).

    Moving is linear over the bits of a crc, so four tables of 256 entries move it by a given length.
    """

    def __init__(self):
        self.known: dict[int, np.ndarray] = {}
        one = np.array([1 << k for k in range(32)], np.uint32)
        self.doubled = [_TABLE[one & 0xFF] ^ (one >> np.uint32(8))]  # images of the bits, by 1, 2, 4, ... bytes

    @staticmethod
    def _image(basis: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for k in range(32):
            out ^= np.where(x >> np.uint32(k) & np.uint32(1), basis[k], np.uint32(0))
        return out

    def table(self, length: int) -> np.ndarray:
        if length not in self.known:
            basis, k, rest = np.array([1 << i for i in range(32)], np.uint32), 0, length
            while rest:
                if len(self.doubled) <= k:
                    self.doubled.append(self._image(self.doubled[-1], self.doubled[-1]))
                if rest & 1:
                    basis = self._image(self.doubled[k], basis)
                rest, k = rest >> 1, k + 1
            x = np.arange(256, dtype=np.uint32)
            made = np.concatenate([self._image(basis, x << np.uint32(8 * j)) for j in range(4)])
            if length > 4 * SHORT_WORD:
                return made
            self.known[length] = made
        return self.known[length]

    def __call__(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if not len(crcs):
            return crcs
        distinct, at = np.unique(lengths, return_inverse=True)
        flat, row = np.concatenate([self.table(int(n)) for n in distinct]), at * 1024
        out = flat[row + (crcs & 0xFF)]
        for j in range(1, 4):
            out ^= flat[row + 256 * j + (crcs >> np.uint32(8 * j) & np.uint32(0xFF))]
        return out


_SHIFT = _Shift()


def features(texts: pa.Array, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per row, rows, buckets) of all runs of one to ``ngrams`` words joined by one space, row by row per length."""
    words = Words(texts, MARKS)
    own = _word_crcs(words.data, words.starts, words.ends)
    sizes = (words.ends - words.starts).astype(np.int64)
    spaced = _SHIFT(np.full(len(own), zlib.crc32(b" "), np.uint32), sizes) ^ own  # of the word behind a space
    counts = np.diff(words.rows)
    owner = np.repeat(np.arange(len(counts)), counts)
    rows, found, run = [owner], [own % np.uint32(buckets)], own
    for k in range(1, ngrams):
        run = run[: max(0, len(own) - k)]
        run = _SHIFT(run, sizes[k:] + 1) ^ spaced[k:]
        inside = owner[: len(run)] == owner[k:]
        rows.append(owner[: len(run)][inside])
        found.append(run[inside] % np.uint32(buckets))
    return counts, np.concatenate(rows), np.concatenate(found)


def bucket_counts(docs: DataFrame, text: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a row per task and bucket is summed."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(buckets, np.int64)
        for part in pieces(batches, 0):
            out += np.bincount(features(part.column(0), ngrams, buckets)[2], minlength=buckets)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(out[at])], ["bucket", "n"])

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(counted, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # as many rows as buckets
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share of the target over that of the source, per bucket."""
    n = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def scores(docs: DataFrame, gain: np.ndarray, doc_id: str, text: str, ngrams: int, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, digest) of every row; ``digest`` hashes the text."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 1):
            counts, rows, found = features(part.column(1), ngrams, len(gain))
            order = np.bincount(rows, minlength=len(counts))
            # whole numbers below 2**53 in size are summed exactly
            weight = np.bincount(rows, gain[found], minlength=len(counts)).astype(np.int64)
            columns = [part.column(0), part.column(2), *(pa.array(x.astype(np.int64)) for x in (counts, order, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    made = rows.withColumn("digest", F.xxhash64("text")).mapInArrow(
        scored, "doc_id long, digest long, n_words long, n_features long, weight long"
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return made.withColumn("score", F.col("weight") + noise)


def ranked(rows: DataFrame) -> DataFrame:
    """(row, rank): 1, 2, 3, ... by descending score, then ascending id. A range sort; no task holds more than its range."""
    order = F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("digest"), F.asc("row")
    parts = rows.select("row", "score", "doc_id", "digest").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = parts.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    parts = stored(parts, "ranked")
    runs = parts.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))  # a row per part
    past = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select("part", (F.coalesce(past, F.lit(0)) - F.col("first") + 1).alias("shift"))
    return parts.join(F.broadcast(shifts), "part").select("row", (F.col("at") + F.col("shift")).alias("rank"))


def bracket(rows: DataFrame, wanted: int, total: int, error: float = SKETCH_ERROR) -> tuple[int, int, int]:
    """(low, high, above): scores around the ``wanted``-th highest of ``total``, and the exact number above ``high``.

    The sketch's bracket is kept only if the exact counts show that the cutoff is in it; if not, it is
    widened, in the end to all scores.
    """
    while True:
        share = 1 - wanted / total
        low, high = rows.approxQuantile("score", [max(0.0, share - 2 * error), min(1.0, share + 2 * error)], error)
        if error >= 0.25:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        above, inside = rows.agg(
            F.count(F.when(F.col("score") > high, 1)), F.count(F.when(F.col("score").between(low, high), 1))
        ).first()
        if above < wanted <= above + inside:
            return int(low), int(high), above
        error *= 4


def drawn(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, error: float = SKETCH_ERROR) -> DataFrame:
    """(row, rank) of the highest scores among the rows of enough words: ``percent`` of these, rounded down."""
    rows = scored.where(F.col("n_words") >= least_words)
    total = rows.count()
    wanted = percent * total // 100
    if not wanted:
        return scored.select("row", F.lit(0).cast("long").alias("rank")).limit(0)
    low, high, above = bracket(rows, wanted, total, error)
    inner = rows.where(F.col("score").between(low, high))
    last = ranked(inner).where(F.col("rank") == wanted - above).join(inner, "row").first()
    here = F.struct((-F.col("score")).alias("score"), F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "row")
    bound = {"score": -last.score, "none": last.doc_id is None, "doc_id": last.doc_id, "digest": last.digest, "row": last.row}
    cut = F.struct(*[F.lit(v).cast("boolean" if k == "none" else "long").alias(k) for k, v in bound.items()])
    return ranked(rows.where((F.col("score") >= low) & (here <= cut)))


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT,
    least_words: int = LEAST_WORDS, ngrams: int = NGRAMS, buckets: int = BUCKETS, seed: int = SEED, error: float = SKETCH_ERROR,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank (null where not drawn).

    Null and empty texts have no words, weight 0 and are not drawn, like all texts of fewer than
    ``least_words`` words. Equal scores go by the smaller id, a null id last (its noise is that of an
    empty name), repeated ids by a hash of their texts, equal rows in any order. A long text is a slice of
    its own. Without documents there are no rows, without a target every gain still is defined. Other
    columns of ``docs`` are not read; the counts of buckets are all that the driver holds.
    """
    gain = gains(bucket_counts(docs, text, ngrams, buckets), bucket_counts(target, target_text, ngrams, buckets))
    made = scores(docs, gain, doc_id, text, ngrams, seed).withColumn("row", F.monotonically_increasing_id())
    scored = stored(made, "scored")
    ranks = drawn(scored, percent, least_words, error)
    out = scored.join(broadcast_if_small(ranks), "row", "left")
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **settings) -> DataFrame:
    """The drawn documents with all their columns, for ids that are unique and not null; see ``resample``."""
    ids = resample(docs, target, doc_id, **settings).where(F.col("rank").isNotNull() & F.col("doc_id").isNotNull())
    return docs.join(broadcast_if_small(ids.select(F.col("doc_id").alias(doc_id)).distinct()), doc_id, "left_semi").select(*docs.columns)
