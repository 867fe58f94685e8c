"""Header, detail and trailer sections of files, and their record counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.functions.text import is_digits, slice_of, strip
from ferrybook.session import broadcast_if_small, settle


def split_sections(lines: DataFrame, key: str = "job_key") -> DataFrame:
    """Adds ``section``. Line 1 is the header, the last line the trailer; files of two lines or
    fewer have nothing to load and drop out."""
    ends = (
        lines.groupBy(key)
        .agg(F.max("line_number").alias("last_line"), F.count(F.lit(1)).alias("lines"))
        .where(F.col("lines") > 2)
        .select(key, "last_line")
    )
    return (
        lines.join(broadcast_if_small(ends), key)
        .withColumn(
            "section",
            F.when(F.col("line_number") == 1, "header")
            .when(F.col("line_number") == F.col("last_line"), "trailer")
            .otherwise("detail"),
        )
        .drop("last_line")
    )


def record_counts(lines: DataFrame, start: int, end: int, key: str = "job_key") -> DataFrame:
    """Record count of every file: from its lines, and from the count slice of its last line.

    Numbers of lines come from a hash aggregate; the last line of a file is then looked up by its number.
    """
    text = strip(slice_of(F.col("value"), start, end))
    sizes = settle(lines.groupBy(key).agg(F.count(F.lit(1)).alias("lines"), F.max("line_number").alias("line_number")))
    return lines.join(broadcast_if_small(sizes), [key, "line_number"]).select(
        key,
        (F.col("lines") - 2).alias("by_lines"),
        F.when(is_digits(text), text.try_cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("by_trailer"),
    )
