"""Layout conversion: a mapping table compiled to one expression per kind of row."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrybook.functions.conversions import FORMULAS, Row
from ferrybook.functions.text import pad_only, strip
from ferrybook.operators.deadlines import at
from ferrybook.operators.sections import split_sections
from ferrybook.session import broadcast_if_small


@dataclass(frozen=True)
class Mapping:
    """One target field. ``source`` is 1-based with both ends included."""

    mapping_id: int
    row_type: str
    kind: str
    width: int
    source: tuple[int, int] | None = None
    value: str = ""
    formula: str = ""
    arguments: tuple = ()


def raw_value(mapping: Mapping, row: Row) -> Column:
    source = row.at(*mapping.source) if mapping.source else F.lit("")
    if mapping.kind == "COPY_AS_IS":
        return source
    if mapping.kind == "REPLACE":
        return F.lit(mapping.value)
    if mapping.kind == "CUSTOM":
        own = Row(row.text, source, row.header, row.line_number, row.batch, row.as_of)
        return FORMULAS[mapping.formula](own, *mapping.arguments)
    return F.lit("")


def target_value(mapping: Mapping, row: Row) -> Column:
    """Stripped, left-justified and filled to the width, never cut. What can not be converted is blank;
    see :func:`conversion_errors`."""
    fill = mapping.value if mapping.kind == "FILL_WITH_THIS_VALUE" else " "
    if mapping.kind == "FILL_WITH_THIS_VALUE":
        return F.repeat(F.lit(fill), mapping.width)
    return pad_only(F.coalesce(strip(raw_value(mapping, row)), F.lit("")), mapping.width, fill)


def standard_value(mappings: Sequence[Mapping], row_type: str, row: Row) -> Column:
    chosen = sorted((m for m in mappings if m.row_type == row_type), key=lambda m: m.mapping_id)
    return F.concat(*[target_value(m, row) for m in chosen])


def _row(as_of: datetime, header: Column | None = None) -> Row:
    return Row(
        F.col("value"), F.lit(""), F.lit("") if header is None else header, F.col("number"), F.col("batch"), as_of
    )


def standard_rows(rows: DataFrame, mappings: Sequence[Mapping], row_type: str, as_of: datetime, keep: Sequence[str]) -> DataFrame:
    """Rows of one kind converted; ``rows`` carry value, number, batch and perhaps header."""
    header = F.col("header") if "header" in rows.columns else None
    return rows.select(*keep, standard_value(mappings, row_type, _row(as_of, header)).alias("value"))


def conversion_errors(rows: DataFrame, mappings: Sequence[Mapping], row_type: str, as_of: datetime, keep: Sequence[str]) -> DataFrame:
    """A row per field that can not be converted: the key columns and ``mapping_id``."""
    header = F.col("header") if "header" in rows.columns else None
    row = _row(as_of, header)
    failed = [F.when(raw_value(m, row).isNull(), m.mapping_id) for m in mappings if m.row_type == row_type and m.kind == "CUSTOM"]
    found = F.array_compact(F.array(*failed, F.lit(None).cast("int")))
    return rows.select(*keep, F.explode(found).alias("mapping_id"))


def mapping_rows(mappings: DataFrame, feed_id: int | None = None) -> DataFrame:
    """The rows of a mapping table, of one feed if given, in the order they are applied."""
    if feed_id is not None:
        mappings = mappings.where(F.col("feed_id") == feed_id)
    return mappings.select(
        "feed_id", "mapping_id", "row_type", "kind", "width", "source", "value", "formula", "arguments"
    ).orderBy("feed_id", "mapping_id")


def compile_mappings(mappings: DataFrame, feed_id: int) -> list[Mapping]:
    """One feed's mapping as objects. ``source`` is ``first:last``; ``arguments`` a JSON list."""

    def fixed(x):
        return tuple(fixed(y) for y in x) if isinstance(x, list) else x

    out = []
    for r in mapping_rows(mappings, feed_id).collect():  # what a person keeps for one feed
        source = tuple(int(n) for n in r.source.split(":")) if r.source else None
        arguments = fixed(json.loads(r.arguments)) if r.arguments else ()
        out.append(Mapping(r.mapping_id, r.row_type, r.kind, r.width, source, r.value or "", r.formula or "", arguments))
    return out


def standard_files(lines: DataFrame, mappings: Sequence[Mapping], batches: DataFrame, as_of: datetime, key: str = "file_id") -> DataFrame:
    """Custom files converted whole: header, details with a running number, footer.

    A file without a batch number is converted with a blank one. Only the one header row per file is joined to the other rows.
    """
    parts = split_sections(lines, key).join(broadcast_if_small(batches), key, "left")
    numbered = parts.withColumn("number", F.when(F.col("section") == "header", 0).otherwise(F.col("line_number") - 1))
    headers = standard_rows(
        numbered.where(F.col("section") == "header"), mappings, "Header", as_of, [key, "section", "line_number"]
    )
    known = broadcast_if_small(headers.select(key, F.col("value").alias("header")))
    others = numbered.where(F.col("section") != "header").join(known, key, "left")
    converted = others.select(
        key, "section", "line_number",
        F.when(F.col("section") == "detail", standard_value(mappings, "Detail", _row(as_of, F.col("header"))))
        .otherwise(standard_value(mappings, "Footer", _row(as_of, F.col("header")))).alias("value"),
    )
    return headers.unionByName(converted)


def batch_numbers(jobs: DataFrame, feeds: DataFrame, zone: str, as_of: datetime) -> DataFrame:
    """Successful jobs of each feed since local midnight, plus one.

    Midnight is that of the UTC calendar day, so close to it the day may differ from the local one.
    """
    midnight = F.to_utc_timestamp(F.lit(as_of.date().isoformat()).cast("timestamp"), zone).cast("timestamp_ntz")
    today = (
        jobs.where((F.col("status") == "Success") & F.col("start_ts").between(midnight, at(as_of)))
        .groupBy("feed_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return feeds.select("feed_id").join(today, "feed_id", "left").select(
        "feed_id", (F.coalesce("n", F.lit(0).cast("bigint")) + 1).alias("batch")
    )
