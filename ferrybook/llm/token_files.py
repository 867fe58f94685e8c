"""Token ids in a binary file format: one zstandard frame per document, one shared dictionary.

Format. A folder holds two Parquet tables. ``dictionary`` has one row: ``hash`` (sha256) and
``content`` of the zstandard dictionary, which was trained on id arrays serialized as little-endian
unsigned 32-bit integers. ``blocks`` has rows of some hundred consecutive documents: ``part`` and
``block`` order them, ``dictionary`` repeats the hash, ``payload`` holds the documents' frames one
after the other, ``ends`` where each frame ends in it, ``doc_ids`` and ``sizes`` (ids per document)
the documents, ``before`` the ids of the same part before the block. So a document is read with one
block's index and one short frame.

Documents are sorted by id over parts and blocks (null ids first, repeated ids side by side), or as the
caller says. A part is a range of that order that one task wrote; no task holds more than a block of
compressed documents.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrybook.llm.common import pieces, tidy
from ferrybook.llm.tokens import WordEncoder, encoder

END = 1
SAMPLE_DOCUMENTS = 1000  # the dictionary is trained on about so many, chosen by a hash of the text
SAMPLE_IDS = 1500  # of each of them, so many ids at most, from a place chosen by a hash of its ids
DICTIONARY_BYTES = 32 << 10
BLOCK_DOCUMENTS = 256
BLOCK_BYTES = 1 << 20
SLICE_BYTES = 4 << 20

BLOCKS = (
    "part int, block long, dictionary string, before long, doc_ids array<long>, sizes array<long>, "
    "ends array<long>, payload binary"
)


def _encoded(coder: WordEncoder, texts: pa.Array) -> Iterator[np.ndarray]:
    ids, ends = coder.encode(texts)
    begin = 0
    for end in ends:
        out = np.empty(end - begin + 1, "<u4")
        out[:-1], out[-1] = ids[begin:end], END
        yield out
        begin = end


def _cut(ids: np.ndarray) -> bytes:
    """At most ``SAMPLE_IDS`` consecutive ids from anywhere in a document."""
    raw = ids.tobytes()
    begin = zlib.crc32(raw) % (max(0, len(ids) - SAMPLE_IDS) + 1)
    return ids[begin : begin + SAMPLE_IDS].tobytes()


def train(docs: DataFrame, path: str, text: str = "text") -> bytes:
    """A zstandard dictionary from a bounded sample of documents; empty where the sample is too small.

    Null texts count as empty ones, of equal texts one is taken, of a long one a cut. Other columns are not read.
    """
    import zstandard

    rows = docs.count()
    chosen = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chosen = chosen.withColumn("h", F.xxhash64("text"))
    if rows > SAMPLE_DOCUMENTS:
        chosen = chosen.where(F.expr(f"pmod(h, {rows}) < {SAMPLE_DOCUMENTS}"))
    chosen = chosen.dropDuplicates(["h"]).orderBy("h").limit(2 * SAMPLE_DOCUMENTS).select("text")

    def serialized(batches):
        with encoder(path) as words:
            for part in pieces(batches, 0, SLICE_BYTES):
                arrays = [_cut(x) for x in _encoded(words, part.column(0))]
                yield pa.RecordBatch.from_arrays([pa.array(arrays, pa.binary())], ["ids"])

    samples = [bytes(r.ids) for r in chosen.mapInArrow(serialized, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(
    docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text", order: Sequence[Column] | None = None
) -> None:
    """Encode all documents with the tokenizer at ``path``, end each with id 1, and write them in id order.

    ``order`` names columns to sort by in place of the id. A null text is an empty one: it has the end
    id alone. Long texts are encoded alone. Ties lie in the order of the input, repeated rows are all
    written, an empty table gives files without documents. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    content = train(docs, path, text)
    name = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(name, content)], "hash string, content binary").coalesce(1).write.parquet(f"{folder}/dictionary")

    def packed(batches):
        import zstandard

        coder = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content) if content else None)
        part, block, before, total = TaskContext.get().partitionId(), 0, 0, 0
        held: list[tuple] = []
        size = 0

        def flush():
            row = [part, block, name, before, [d for d, _, _ in held], [n for _, n, _ in held]]
            row += [np.cumsum([len(f) for _, _, f in held]).tolist(), b"".join(f for _, _, f in held)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        with encoder(path) as words:
            for piece in pieces(batches, 1, SLICE_BYTES):
                for doc, ids in zip(piece.column(0).to_pylist(), _encoded(words, piece.column(1))):
                    frame = coder.compress(ids.tobytes())
                    held.append((doc, len(ids), frame))
                    size += len(frame)
                    total += len(ids)
                    if len(held) == BLOCK_DOCUMENTS or size >= BLOCK_BYTES:
                        yield flush()
                        block, before, held, size = block + 1, total, [], 0
        if held:
            yield flush()

    many = pa.list_(pa.int64())
    types = [pa.int32(), pa.int64(), pa.string(), pa.int64(), many, many, many, pa.binary()]
    names = ["part", "block", "dictionary", "before", "doc_ids", "sizes", "ends", "payload"]
    keys = [F.col(doc_id).cast("long")] if order is None else order
    names_of_keys = [f"key{i}" for i in range(len(keys))]
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *[k.alias(n) for k, n in zip(keys, names_of_keys)],
        # a much repeated id is spread over parts by the place of its rows in the input
        F.monotonically_increasing_id().alias("place"),
    )
    rows = rows.repartitionByRange(*names_of_keys, "place").sortWithinPartitions(*names_of_keys, "place").select("doc_id", "text")
    rows.mapInArrow(tidy(packed), BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    content = bytes(row.content)
    if hashlib.sha256(content).hexdigest() != row.hash:
        raise ValueError("the dictionary does not have its hash")
    return row.hash, content


def _frames(name: str, content: bytes, blocks: pa.RecordBatch) -> Iterator[tuple[dict, list[np.ndarray]]]:
    import zstandard

    coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None)
    for row in blocks.to_pylist():
        if row["dictionary"] != name:
            raise ValueError("the block was written with another dictionary")
        begins = [0, *row["ends"][:-1]]
        view = memoryview(row["payload"])
        yield row, [np.frombuffer(coder.decompress(view[b:e]), "<u4") for b, e in zip(begins, row["ends"])]


def read(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document; ``start`` counts the ids of all before it.

    Null and repeated ids come back as they were written; files without documents give no rows.
    """
    name, content = _dictionary(spark, folder)
    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids

    def unpacked(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                for row, arrays in _frames(name, content, batch.slice(k, 1)):
                    sizes = [len(a) for a in arrays]
                    starts = row["before"] + np.cumsum([0, *sizes[:-1]])
                    columns = [
                        pa.array([row["part"]] * len(sizes), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([zlib.crc32(a.tobytes()) for a in arrays], pa.int64()),
                    ]
                    if ids:
                        columns.append(pa.array([a.astype(np.int64) for a in arrays], pa.list_(pa.int64())))
                    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    blocks = spark.read.parquet(f"{folder}/blocks")
    sums = blocks.select("part", F.expr("aggregate(sizes, 0L, (s, x) -> s + x)").alias("n"))
    sums = sums.groupBy("part").agg(F.sum("n").alias("n"))  # a row per part: few, whatever the input
    past = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("offset"))
    rows = blocks.mapInArrow(tidy(unpacked), schema).join(offsets, "part")
    return rows.withColumn("start", F.col("start") + F.col("offset")).drop("part", "offset")


def fetch(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document: its block's index, then its frames alone."""
    name, content = _dictionary(spark, folder)
    import zstandard

    coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None)
    at = spark.read.parquet(f"{folder}/blocks").where(F.array_contains("doc_ids", doc_id))
    at = at.withColumn("k", F.explode(F.sequence(F.lit(0), F.size("doc_ids") - 1)))
    at = at.where(F.col("doc_ids")[F.col("k")] == doc_id)
    begin = F.when(F.col("k") == 0, 0).otherwise(F.get("ends", F.col("k") - 1))
    frames = at.orderBy("part", "block", "k").select(
        "dictionary", F.substring("payload", begin.cast("int") + 1, (F.get("ends", "k") - begin).cast("int")).alias("frame")
    )
    out = []
    for row in frames.collect():
        if row.dictionary != name:
            raise ValueError("the block was written with another dictionary")
        out.append(np.frombuffer(coder.decompress(bytes(row.frame)), "<u4"))
    return out
