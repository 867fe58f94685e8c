"""Sources: text files with exact line numbers, one-row specs, delimited files, routing by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrybook.functions.text import base_name, clean_utf8, name_prefix
from ferrybook.session import broadcast_if_small, settle


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line_number, value`` of all text files under a path or several, files cut into splits as usual.

    A line's number is its place in its split plus the lines of the file's earlier splits. Only one
    row per split is aggregated and ordered; no line is shuffled.
    """
    raw = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        )
    )
    raw = raw.withColumn("path", F.xxhash64("file"))  # narrow, so that the splits of a large input stay small
    blocks = raw.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select(
        "path", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift")
    )
    return raw.join(broadcast_if_small(settle(shifts)), ["path", "block"]).select(
        "file",
        (F.col("at") + F.col("shift")).alias("line_number"),
        clean_utf8(F.regexp_replace("value", r"\r\z", "")).alias("value"),
    )


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """``line_number, value`` of one outbound file that was written as consecutive part files."""
    lines = read_lines(spark, path)
    sizes = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n"))  # a row per part file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return lines.join(broadcast_if_small(settle(shifts)), "file").select(
        (F.col("line_number") + F.col("shift")).alias("line_number"), "value"
    )


def read_spec(spark: SparkSession, path: str):
    """The single row of a CSV file with a header."""
    return spark.read.option("header", True).csv(path).first()


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Pipe-delimited rows into all columns of a table."""
    return spark.read.csv(path, sep="|", schema=schema, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_subset(
    spark: SparkSession,
    path: str,
    columns: T.StructType,
    target: T.StructType,
    defaults: Mapping[str, object],
) -> DataFrame:
    """Pipe-delimited rows into named columns; the table's other columns take defaults or NULL."""
    loaded = read_delimited(spark, path, columns)
    present = set(columns.fieldNames())
    return loaded.select(
        *[
            F.col(f.name) if f.name in present else F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def route_by_name(arrivals: DataFrame, feeds: DataFrame) -> DataFrame:
    """Adds the feed whose name pattern holds the text before the file name's third underscore.

    Feed rows are cut to the prefix of their pattern up to each underscore, so the lookup is an equi
    join: ``pattern LIKE '%prefix\\_%'`` holds for a name with three underscores when the prefix ends
    where the pattern has an underscore.
    """
    ends = F.expr(
        "filter(sequence(1, length(name_pattern)), i -> substring(name_pattern, i, 1) = '_')"
    )
    prefixes = (
        feeds.select("*", F.explode(ends).alias("_end"))
        .select("*", F.explode(F.expr("sequence(1, _end - 1)")).alias("_start"))
        .select("*", F.expr("substring(name_pattern, _start, _end - _start)").alias("prefix"))
        .groupBy("prefix")
        .agg(F.min(F.struct("feed_id", "feed_type", "is_active")).alias("feed"))
        .select("prefix", "feed.*")
    )
    named = arrivals.withColumn("prefix", name_prefix(base_name(F.col("file_name"))))
    return named.join(broadcast_if_small(prefixes), "prefix", "left")


def with_route(routed: DataFrame) -> DataFrame:
    """Where an arrival goes: processed, ignored, or parked as unknown."""
    return routed.withColumn(
        "route",
        F.when(F.col("feed_id").isNull(), "unknown")
        .when(F.col("feed_type") != "INBOUND", "not inbound")
        .when(~F.col("is_active"), "inactive")
        .otherwise("process"),
    )
