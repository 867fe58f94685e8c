"""Helpers shared by the operators on texts and vectors."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.session import new_folder

# Rows without an id still take part in links. Their stand-in ids lie above any real id, so that
# they never become the smallest id of a group that has a real one.
STAND_IN = 1 << 62


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_open: list[list[str]] = []  # folders written inside each open scratch block


def stored(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write to a fresh folder under the shared one and go on from there: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    if _open and not lasting:
        _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_order(df: DataFrame) -> list[Column]:
    """Sort keys of the order in which the rows of a written table lie in its part files; none for other frames."""
    try:
        about = df.metadataColumn("_metadata")
        df.select(about["row_index"]).schema
    except AnalysisException:
        return []
    part = F.regexp_extract(about["file_name"], r"^part-(\d+)", 1).cast("long")
    return [part, about["file_name"], about["row_index"]]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside the block are deleted at its end, but for lasting ones: only those may be used after it."""
    _open.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for folder in _open.pop():
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of one text column; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        start = taken = 0
        for row, size in enumerate(sizes):
            if taken and taken + size > limit:
                yield batch.slice(start, row - start)
                start, taken = row, 0
            taken += size
        if start < batch.num_rows:
            yield batch.slice(start)


def node_of(doc_id: str, digest: str):
    """The id of a row as a graph node; a stand-in made of its digest where it has none."""
    bits = F.shiftrightunsigned(F.xxhash64(digest), 3)
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(STAND_IN) + bits)


def id_of(node: str):
    """The real id of a node, null for a stand-in."""
    return F.when(F.col(node) < STAND_IN, F.col(node))


def give_back() -> None:
    """Return freed memory to the system. A Python worker outlives its task, idle beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run):
    """A function of batches that gives its worker's memory back once its task's rows are through."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
