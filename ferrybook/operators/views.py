"""Reporting views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.session import broadcast_if_small


def rule_report(outcomes: DataFrame, rules: DataFrame, columns: DataFrame, codes: DataFrame) -> DataFrame:
    """Outcomes with column name, code, level and standard text; the three sides are a catalogue,
    joined one after the other so that the outcomes stay where they are."""
    return (
        outcomes.join(broadcast_if_small(rules), "rule_id", "left")
        .join(broadcast_if_small(columns), "file_column_id", "left")
        .join(broadcast_if_small(codes), "error_code", "left")
        .select(
            "job_key", "line_number", "column_name",
            F.when(F.col("validation_result") == "Y", "Passed").when(F.col("validation_result") == "N", "Failed")
            .otherwise("").alias("validation_result"),
            F.col("error_message").alias("validation_result_error_message"), "error_code", "error_level",
            "standard_error_message",
        )
    )


def tagged(
    records: DataFrame, tags: Mapping[str, str], jobs: DataFrame, feeds: DataFrame, keep: Sequence[str]
) -> DataFrame:
    """Records with each sensitive column also wrapped in the markers of its type.

    ``tags`` maps a column to its marker; the wrapped value stands next to the raw one.
    """
    wrapped = [
        F.concat(F.lit(f"<{tag}>"), F.trim(c), F.lit(f"</{tag}>")).alias(f"{c}_tagged") for c, tag in tags.items()
    ]
    return (
        records.join(jobs.select("job_key", "feed_id", "file_name"), "job_key", "left")
        .join(feeds.select("feed_id", "client_id"), "feed_id", "left")
        .select(*keep, "feed_id", "file_name", "client_id", *tags, *wrapped)
    )


def restamped(table: DataFrame, columns: Sequence[str], zone: str) -> DataFrame:
    """Adds each local timestamp as UTC."""
    return table.withColumns(
        {
            f"{c}_utc": F.to_utc_timestamp(F.col(c).cast("timestamp"), zone).cast("timestamp_ntz")
            for c in columns
        }
    )
