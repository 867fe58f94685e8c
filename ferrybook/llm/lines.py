"""Line dedup with two Bloom filters.

One filter holds the hashes of lines seen once, the other those seen twice. Only lines that the second
one holds are suspected repeats; they alone are shuffled, as text, for an exact count of their documents
and the choice of the document that keeps them. A repeated line sets all its bits twice, so none is missed.

The filters are cut into segments of ``SEGMENT_BITS``; a hash has all its bits in one segment, and the
number of segments follows from the number of lines, so the share of false suspects stays the same at
any size. A task gathers the bits of its lines and sends them per segment as sorted, packed positions. A
segment's fragments are merged one after the other into its two bit arrays, some hundred kilobytes; how
many documents hold one line does not matter there, as a task sends each bit once or twice.

Where the second filter is small by a checked size, every task holds it and looks its lines up. Beyond
that the distinct hashes are dealt to the segments instead, and suspects come back as a list of hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import STAND_IN, pieces, stored
from ferrybook.session import broadcast_if_small

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
SEGMENT_BITS = 1 << 20
BITS_PER_LINE = 16
BITS_PER_HASH = 3
FILTER_BYTES = 16 << 20  # the second filter, unpacked, that every task may hold
HELD_HASHES = 1 << 20  # that a task gathers before it sends bits

_SPACE = " \t\n\x0b\x0c\r"


def _split(texts: pa.Array) -> tuple[pa.LargeListArray, pa.Array]:
    """Lines of every text and their keys. A null text is an empty one, which has one empty line."""
    lists = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), "\n")
    return lists, pc.ascii_lower(pc.ascii_trim(lists.flatten(), _SPACE))


def _document_keys(texts: pa.Array, least: int) -> tuple[np.ndarray, pa.Array]:
    """(row, key) once per row and key, of keys that are long enough."""
    lists, keys = _split(texts)
    row = pc.list_parent_indices(lists)
    long = pc.greater_equal(pc.utf8_length(keys), least)
    row, coded = row.filter(long).to_numpy(), keys.filter(long).dictionary_encode()
    both = np.unique(row.astype(np.int64) * max(1, len(coded.dictionary)) + coded.indices.to_numpy())
    width = max(1, len(coded.dictionary))
    return both // width, pa.DictionaryArray.from_arrays(pa.array((both % width).astype(np.int32)), coded.dictionary)


def _hashes(keys: pa.DictionaryArray) -> np.ndarray:
    made = [xxhash.xxh3_64_intdigest(k) for k in keys.dictionary.cast(pa.large_binary()).to_pylist()]
    return np.array(made, np.uint64)[keys.indices.to_numpy()]


def _bits(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of every hash and its places there, a column per bit."""
    segment = ((hashes >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)
    one, two = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(20)) | np.uint64(1)
    places = [(one + np.uint64(k) * two) % np.uint64(SEGMENT_BITS) for k in range(BITS_PER_HASH)]
    return segment, np.stack(places, 1).astype(np.int64)


def _packed(places: np.ndarray) -> bytes:
    return zlib.compress(np.diff(places, prepend=0).astype("<u4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64))


def _fragments(hashes: np.ndarray, segments: int) -> pa.RecordBatch:
    """Per segment the bits that these hashes set, and those they set more than once."""
    segment, places = _bits(hashes, segments)
    at, times = np.unique((segment[:, None] * SEGMENT_BITS + places).ravel(), return_counts=True)
    owner = at // SEGMENT_BITS
    names, first = np.unique(owner, return_index=True)
    bounds = [*first, len(at)]
    once, twice = [], []
    for b, e in zip(bounds[:-1], bounds[1:]):
        inner = at[b:e] % SEGMENT_BITS
        once.append(_packed(inner))
        twice.append(_packed(inner[times[b:e] > 1]))
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["segment", "once", "twice"]
    )


def _merged(fragments: Iterator[pa.RecordBatch], segment: int) -> np.ndarray:
    """The second filter of a segment: bits set twice by one fragment, or once by two."""
    once, twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
    for batch in fragments:
        for a, b in zip(batch.column("once").to_pylist(), batch.column("twice").to_pylist()):
            new = _unpacked(a)
            twice[_unpacked(b)] = True
            twice[new[once[new]]] = True
            once[new] = True
    return twice


def filters(rows: DataFrame, segments: int, least: int = LEAST_CHARS) -> DataFrame:
    """(segment, bits): the second filter over the lines of (node, text), packed."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in pieces(batches, 1):
            held.append(_hashes(_document_keys(part.column(1), least)[1]))
            size += len(held[-1])
            if size >= HELD_HASHES:
                yield _fragments(np.concatenate(held), segments)
                held, size = [], 0
        if size:
            yield _fragments(np.concatenate(held), segments)

    def merge(keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.packbits(_merged(batches, keys[0].as_py()))
        yield pa.RecordBatch.from_arrays([pa.array([keys[0].as_py()]), pa.array([zlib.compress(bits.tobytes(), 1)])], ["segment", "bits"])

    fragments = rows.mapInArrow(scan, "segment long, once binary, twice binary")
    return fragments.groupBy("segment").applyInArrow(merge, "segment long, bits binary")


def _suspects_by_lookup(rows: DataFrame, second: DataFrame, segments: int, least: int) -> DataFrame:
    """Every task holds the whole second filter, whose size was checked."""
    packed = {r.segment: bytes(r.bits) for r in second.collect()}
    shared = rows.sparkSession.sparkContext.broadcast(packed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(segments * SEGMENT_BITS // 8, np.uint8)
        for k, data in shared.value.items():
            bits[k * SEGMENT_BITS // 8 : (k + 1) * SEGMENT_BITS // 8] = np.frombuffer(zlib.decompress(data), np.uint8)
        for part in pieces(batches, 1):
            row, keys = _document_keys(part.column(1), least)
            segment, places = _bits(_hashes(keys), segments)
            at = segment[:, None] * SEGMENT_BITS + places
            hit = np.flatnonzero(((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1))
            node = part.column(0).take(pa.array(row[hit]))
            yield pa.RecordBatch.from_arrays([node, keys.take(pa.array(hit)).dictionary_decode().cast(pa.string())], ["node", "key"])

    return rows.mapInArrow(scan, "node struct<id:long,text:long>, key string")


def _suspects_by_segment(rows: DataFrame, second: DataFrame, segments: int, least: int) -> DataFrame:
    """The distinct hashes go to their segments; what the second filter holds comes back as a list to join with."""

    def hashed(batches: Iterator[pa.RecordBatch], with_key: bool) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 1):
            row, keys = _document_keys(part.column(1), least)
            h = pa.array(_hashes(keys).view(np.int64))
            if with_key:
                columns = [part.column(0).take(pa.array(row)), keys.dictionary_decode().cast(pa.string()), h]
                yield pa.RecordBatch.from_arrays(columns, ["node", "key", "h"])
            else:
                segment = _bits(h.to_numpy().view(np.uint64), segments)[0]
                yield pa.RecordBatch.from_arrays([pa.array(segment), h], ["segment", "h"])

    def probe(hashes: pd.DataFrame, filter_: pd.DataFrame) -> pd.DataFrame:
        if not len(hashes) or not len(filter_):
            return pd.DataFrame({"h": np.empty(0, np.int64)})
        bits = np.unpackbits(np.frombuffer(zlib.decompress(filter_["bits"].iloc[0]), np.uint8)).astype(bool)
        h = hashes["h"].to_numpy()
        return pd.DataFrame({"h": h[bits[_bits(h.view(np.uint64), segments)[1]].all(1)]})

    # a segment holds some ten thousand distinct hashes by construction
    distinct = rows.mapInArrow(lambda b: hashed(b, False), "segment long, h long").distinct()
    found = distinct.groupBy("segment").cogroup(second.groupBy("segment")).applyInPandas(probe, "h long")
    keyed = rows.mapInArrow(lambda b: hashed(b, True), "node struct<id:long,text:long>, key string, h long")
    return keyed.join(broadcast_if_small(found), "h", "left_semi").select("node", "key")


def repeated_lines(
    rows: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """(node, key): the lines that documents of (node, text) lose, once per document."""
    n = rows.select(F.expr("char_length(text) - char_length(replace(text, '\n', '')) + 1").alias("n")).agg(F.sum("n")).first()[0] or 0
    segments = n * BITS_PER_LINE // SEGMENT_BITS + 1
    second = stored(filters(rows, segments, least_chars), "filters")
    lookup = segments * SEGMENT_BITS // 8 <= filter_bytes
    suspects = (_suspects_by_lookup if lookup else _suspects_by_segment)(rows, second, segments, least_chars)
    suspects = stored(suspects, "suspects")
    real = F.when(F.col("node.id") < STAND_IN, F.col("node.id"))
    held = suspects.groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.max(real).alias("keeper"))
    confirmed = held.where((F.col("documents") >= least_documents) & F.col("keeper").isNotNull()).select("key", "keeper")
    return suspects.join(broadcast_if_small(confirmed), "key").where(F.col("node.id") != F.col("keeper")).select("node", "key")


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, node, text): a document is known by its id and a hash of its text, one without id by the hash."""
    h = F.xxhash64("text")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    stand_in = F.lit(STAND_IN) + F.shiftrightunsigned(h, 3)
    return rows.select("doc_id", F.struct(F.coalesce("doc_id", stand_in).alias("id"), h.alias("text")).alias("node"), "text")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, 1):
        texts, drops = part.column(1), part.column(2).to_pylist()
        out, lines, dropped = [], [], []
        changed = [k for k, d in enumerate(drops) if d]
        lists, keys = _split(texts.take(pa.array(changed, pa.int64())))
        ends, keys = lists.offsets.to_numpy(), keys.to_pylist()
        split = iter(zip(lists.to_pylist(), ends[:-1] - ends[0], ends[1:] - ends[0]))
        plain = texts.to_pylist()
        for text, drop in zip(plain, drops):
            if not drop:
                lines.append(text.count("\n") + 1)
                dropped.append(0)
                out.append(text)
                continue
            own, b, e = next(split)
            gone = set(drop)
            kept = [line for line, key in zip(own, keys[b:e]) if key not in gone]
            lines.append(len(own))
            dropped.append(len(own) - len(kept))
            out.append("\n".join(kept))
        columns = [part.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(out, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept"])


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS, filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept (the text without its dropped lines).

    A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least
    ``least_chars`` code points in at least ``least_documents`` documents lose all their lines but for those
    in the documents with the largest id that holds them. Every row is a document, repeated ids
    included; rows that share the largest id all keep the line. Rows without an id lose lines to those
    with one; a line that only they hold stays. Null and empty texts are one empty line. Texts are
    taken whole, a long one as a slice of its own. An empty table gives an empty one; other columns of
    ``docs`` are not read.
    """
    rows = _named(docs, doc_id, text)
    lost = repeated_lines(rows.select("node", "text"), least_chars, least_documents, filter_bytes)
    # distinct lines of one text at most
    lost = lost.groupBy("node").agg(F.collect_set("key").alias("lost"))
    both = rows.join(broadcast_if_small(lost), "node", "left").select("doc_id", "text", "lost")
    return both.mapInArrow(_kept, "doc_id long, n_lines long, n_dropped long, kept string")
