"""The corpus pipeline: reject poor documents, near-copies and benchmark passages, mix, write token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.llm import decontaminate, mixing, near_dup, quality, token_files
from ferrybook.llm.common import file_order, stored, table
from ferrybook.llm.queries import tokenizer_path
from ferrybook.session import new_folder


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null, empty and long texts are scored like others; repeated rows share a fate; a document with
    several labels counts with the smallest; without labels of both classes all stay. An empty table gives an
    empty one. Extra columns, whatever their names, pass through.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: the one with the smallest id.

    Null and blank texts are like no other. Of rows with equal id and text one stays; different texts
    under one id are different documents. Long texts are compared whole. An empty table gives an empty one.
    Extra columns, whatever their names, pass through.
    """
    return near_dup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than the allowed share of benchmark passages.

    Null and empty texts hold none and stay; repeated rows share a fate; long texts are searched whole. An
    empty table gives an empty one. Extra columns, whatever their names, pass through.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, those of small sources more than once, so that the sources have their target weights.

    The rows come in the order of the mixture, and part files written from them keep it. A null source
    is a source; null and long texts and repeated rows are documents like others. An empty table gives
    an empty one. Extra columns pass through, but a column ``mixed`` comes back as null.
    """
    placed = mixing.mix(docs)
    order = F.col("mixed")["position"]
    placed = placed.repartitionByRange(order).sortWithinPartitions(order)
    return placed.select(*[F.lit(None).cast(t).alias(c) if c.lower() == "mixed" else F.col(c) for c, t in docs.dtypes])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, written to token files and read back: (doc_id, start, n_tokens, ids_crc32).

    The files hold the documents in the order of the part files that ``docs`` is read from, that is of
    the mixture; a frame that is no table of files in the order of its rows. A null text has the end id
    alone; repeated rows are all written; long texts are encoded alone. An empty table gives no rows.
    Extra columns are not read.
    """
    folder = new_folder(spark, "token-files")
    token_files.write(docs, folder, str(tokenizer_path()), order=file_order(docs))
    return token_files.read(spark, folder, ids=False)


STAGES = [
    ("quality_classifier", accept),
    ("minhash_near_dedup", deduplicate),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
    ("token_output", tokens),
]
# SQL can express neither the classifier nor the tokenizer; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
