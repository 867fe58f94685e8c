"""What follows from rule outcomes: duplicates, error counts, alerts, the top error of a line."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrybook.functions import messages as M
from ferrybook.functions.messages import message
from ferrybook.operators.catalogue import RuledColumn
from ferrybook.session import broadcast_if_small, small_table


def rule_meta(spark: SparkSession, columns: Iterable[RuledColumn]) -> DataFrame:
    """Rule, column, code and level of a compiled catalogue; as small as the catalogue itself."""
    rows = [
        (r.rule_id, c.column_id, c.name, r.error_code, r.error_level, r.kind) for c in columns for r in c.rules
    ]
    rows.sort(key=lambda r: (r[4], r[1], r[0]))
    return small_table(
        spark,
        [(*r, i) for i, r in enumerate(rows)],
        "rule_id int, file_column_id int, column_name string, error_code int, error_level int, kind string, severity int",
    )


def duplicate_ids(
    records: DataFrame, id_column: str, rule_id: int, position: str, error_code: int, error_level: int
) -> DataFrame:
    """A failure row for every occurrence of an id in a job after the first one by line.

    First lines are pre-aggregated; only ids that repeat are joined back. While these are few, records are not
    shuffled for it. A repeated id may hold most rows of a job: the join side is one row per id and the
    record side is split when skewed.
    """
    repeated = (
        records.where(F.col(id_column).isNotNull())
        .groupBy("job_key", id_column)
        .agg(F.min("line_number").alias("first_line"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    text = message(
        M.DUPLICATE_ID, {"value": id_column}, name="Transmission ID", pos=position, code=error_code, level=error_level
    )
    return (
        records.join(broadcast_if_small(repeated), ["job_key", id_column])
        .where(F.col("line_number") > F.col("first_line"))
        .selectExpr(
            "job_key", "line_number", f"{rule_id} as rule_id", "'N' as validation_result", f"{text} as error_message"
        )
    )


def error_line_counts(outcomes: DataFrame, jobs: DataFrame) -> DataFrame:
    """Lines with at least one failure per job, 0 for jobs without."""
    counts = (
        outcomes.where(F.col("validation_result") == "N")
        .groupBy("job_key")
        .agg(F.count_distinct("line_number").alias("error_lines"))
    )
    return jobs.select("job_key").join(counts, "job_key", "left").select(
        "job_key", F.coalesce("error_lines", F.lit(0).cast("bigint")).alias("error_lines")
    )


def threshold_alerts(counts: DataFrame, details: DataFrame, jobs: DataFrame, feeds: DataFrame) -> DataFrame:
    """``alert`` per job: a threshold below 1 is a share of the detail lines, else a number."""
    bound = F.when(F.col("threshold") < 1, F.col("detail_lines") * F.col("threshold")).otherwise(F.col("threshold"))
    return (
        jobs.select("job_key", "feed_id")
        .join(counts, "job_key")
        .join(details, "job_key", "left")
        .join(feeds.select("feed_id", "threshold"), "feed_id")
        .withColumn("detail_lines", F.coalesce("detail_lines", F.lit(0).cast("bigint")))
        .select(
            "job_key", "feed_id", "error_lines", "detail_lines",
            ((F.col("error_lines") > 0) & (F.col("error_lines") >= bound)).alias("alert"),
        )
    )


def level_one(outcomes: DataFrame, meta: DataFrame) -> DataFrame:
    """The failures of level 1; a line's top error is one exactly when it has any. No aggregation."""
    hard = meta.where(F.col("error_level") == 1).select("rule_id", "error_code")
    failed = outcomes.where(F.col("validation_result") == "N")
    return failed.join(broadcast_if_small(hard), "rule_id").select("job_key", "line_number", "rule_id", "error_code")


def top_errors(outcomes: DataFrame, meta: DataFrame) -> DataFrame:
    """The failure of each line with the lowest level, then the lowest column, then the lowest rule.

    The catalogue numbers its rules in that order, so one small number per line is aggregated.
    """
    meta = broadcast_if_small(meta)
    worst = (
        outcomes.where(F.col("validation_result") == "N")
        .join(meta.select("rule_id", "severity"), "rule_id")
        .groupBy("job_key", "line_number")
        .agg(F.min("severity").alias("severity"))
    )
    return worst.join(meta, "severity").select(
        "job_key", "line_number", "error_level", "file_column_id", "rule_id", "error_code"
    )
