"""Sinks: merged fixed-width files, delimited files, outcome tables, reload by delete and insert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_sections(header: DataFrame, detail: DataFrame, trailer: DataFrame, order: Sequence[str]) -> DataFrame:
    """One relation of ``section, <order columns>, value``: header, details, trailer.

    ``order`` names the detail columns that give the line order; header and trailer carry NULLs.
    """

    def part(df: DataFrame, section: int) -> DataFrame:
        keys = [F.col(c) if section == 2 else F.lit(None).cast(detail.schema[c].dataType).alias(c) for c in order]
        return df.select(F.lit(section).alias("section"), *keys, "value")

    return part(header, 1).unionByName(part(detail, 2)).unionByName(part(trailer, 3))


def write_merged(merged: DataFrame, order: Sequence[str], path: str, mode: str = "error") -> None:
    """Write the lines in file order. The sort is a range shuffle, so part files follow each other
    and their concatenation is the outbound file; no task sees the whole file."""
    merged.orderBy("section", *order).select("value").write.mode(mode).text(path)


def write_delimited(df: DataFrame, path: str) -> None:
    df.write.csv(
        path, sep="|", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """Outcome rows, each partition in the order of job and line, so that row groups can be skipped."""
    outcomes.write.parquet(path)


def append_ledger(rows: DataFrame, path: str) -> DataFrame:
    """Append rows to a table that only grows, and give the whole table."""
    rows.write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def outbound_name(prefix: str, stamp: Column) -> Column:
    return F.upper(F.concat(F.lit(prefix), stamp, F.lit(".TXT")))


def without_value(table: DataFrame, column: str, value: object) -> DataFrame:
    """The table after deleting the rows that hold a value; NULLs stay."""
    return table.where(~F.col(column).eqNullSafe(F.lit(value)))


def without_children(child: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The child table after deleting the rows of the given parents."""
    return child.join(parents.select(key), key, "left_anti")
