"""Outbound export: what may be sent, once each, rejects, defaults, order, header and trailer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrybook.functions.text import default_if_blank, is_digits

KEY = ("job_key", "line_number")
LEDGER = "job_key bigint, line_number bigint, out_job_key bigint"


def settings_at(settings: DataFrame, day: date) -> DataFrame:
    """Export settings in force on a day, both ends included."""
    return settings.where((F.col("valid_from") <= F.lit(day)) & (F.lit(day) <= F.col("valid_to")))


def last_export(records: DataFrame, jobs: DataFrame, feed_id: int) -> DataFrame:
    """One row: the newest job of an outbound feed that records were sent with, 0 when there is none."""
    sent = records.where(F.col("out_job_key").isNotNull()).select(F.col("out_job_key").alias("job_key")).distinct()
    own = jobs.where(F.col("feed_id") == feed_id).select("job_key")
    return own.join(sent, "job_key", "left_semi").agg(
        F.coalesce(F.max("job_key"), F.lit(0).cast("bigint")).alias("last_job")
    )


def precondition(wanted: DataFrame, last: DataFrame) -> DataFrame:
    """One row: wanted files newer than the last export; nothing is exported when there are none."""
    return wanted.where(F.col("job_key") > last.scalar()).agg(F.count(F.lit(1)).alias("files"))


def open_requests(records: DataFrame) -> DataFrame:
    """Requests without response that were not sent yet."""
    return records.where(
        F.col("out_job_key").isNull() & (F.col("file_type") == "DQ") & (F.rtrim("response") == "")
    )


def upstream_jobs(jobs: DataFrame, upstream: int) -> DataFrame:
    """Upstream jobs whose day is complete and that nothing was generated from."""
    return jobs.where(
        (F.col("client_id") == upstream)
        & (F.col("status") == "Success")
        & (F.col("file_status") == "Available")
        & ~F.col("complete")
    ).select("job_key")


def eligible_for_client(
    records: DataFrame, jobs: DataFrame, upstream: int, sender: DataFrame, tags: Sequence[str], extra: Column | None = None
) -> DataFrame:
    """Upstream records for one client: from the given sender (a one-row relation), with its tag."""
    mine = (F.col("sender") == sender.scalar()) & F.rtrim("tag").isin(*tags)
    if extra is not None:
        mine = mine & extra
    return open_requests(records).where(mine).join(upstream_jobs(jobs, upstream), "job_key", "left_semi")


def eligible_for_upstream(
    records: DataFrame, jobs: DataFrame, feeds: DataFrame, blocked: DataFrame, upstream: int
) -> DataFrame:
    """Client records whose line is not ``blocked`` by a level-1 failure. A level-2 line still ships."""
    inbound = feeds.where((F.col("feed_type") == "INBOUND") & (F.col("client_id") != upstream)).select("feed_id")
    good = jobs.where(F.col("status") == "Success").join(inbound, "feed_id", "left_semi")
    return (
        open_requests(records)
        .join(good.select("job_key"), "job_key", "left_semi")
        .join(blocked.select(*KEY), list(KEY), "left_anti")
    )


def first_per_business_key(records: DataFrame, business: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first record per business key; the record key makes the order total.

    Each task keeps one row per key before the shuffle, so a key with most of the rows stays small.
    """
    window = Window.partitionBy(*business).orderBy(*order, *KEY)
    return records.withColumn("_place", F.row_number().over(window)).where(F.col("_place") == 1).drop("_place")


def rejects(
    records: DataFrame, jobs: DataFrame, top_errors: DataFrame, upstream: int, own_feed: int, sender: DataFrame, tags: Sequence[str]
) -> DataFrame:
    """Upstream rejections and own level-1 errors, distinct, type and status overwritten."""
    unsent = records.where(F.col("out_job_key").isNull())
    available = jobs.where(
        (F.col("client_id") == upstream) & (F.col("status") == "Success") & (F.col("file_status") == "Available")
    ).select("job_key")
    theirs = (
        unsent.where(
            (F.col("sender") == sender.scalar())
            & (F.col("file_type") == "DR")
            & (F.col("response") == "R")
            & F.rtrim("tag").isin(*tags)
        )
        .join(available, "job_key", "left_semi")
        .withColumn("reject_code", F.col("reject"))
    )
    own_jobs = jobs.where(F.col("feed_id") == own_feed).select("job_key")
    level_one = top_errors.where(F.col("error_level") == 1).select(*KEY, F.col("error_code").cast("string").alias("reject_code"))
    ours = unsent.join(own_jobs, "job_key", "left_semi").join(level_one, list(KEY))
    return (
        theirs.unionByName(ours)
        .dropDuplicates([*KEY, "reject_code"])
        .withColumn("file_type", F.lit("DR"))
        .withColumn("response", F.lit("R"))
    )


def with_defaults(records: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Blank values replaced by the default of their column."""
    return records.withColumns({c: default_if_blank(F.col(c), F.lit(d)) for c, d in defaults.items()})


def sent_order(day: Column, time: Column) -> Column:
    """Text that sorts like the transmission timestamp; a time that is no number counts as midnight."""
    return F.concat(day, F.when(is_digits(time), time).otherwise("000000"))


def marked_sent(records: DataFrame, exported: DataFrame, job_key: int) -> DataFrame:
    """A new snapshot of the records with the exported ones marked."""
    keys = exported.select(*KEY, F.lit(job_key).cast("bigint").alias("_sent_with"))
    return (
        records.join(keys, list(KEY), "left")
        .withColumn("out_job_key", F.coalesce("_sent_with", "out_job_key"))
        .drop("_sent_with")
    )


def sent_rows(exported: DataFrame, job_key: int) -> DataFrame:
    """What an export adds to the ledger of sent records: their keys and the job, nothing else."""
    return exported.select(*KEY, F.lit(job_key).cast("bigint").alias("out_job_key"))


def last_in_ledger(ledger: DataFrame, out_jobs: DataFrame) -> DataFrame:
    """One row: the newest of the given jobs that the ledger knows, 0 when it knows none."""
    jobs = ledger.select(F.col("out_job_key").alias("job_key")).distinct()
    return jobs.join(out_jobs.select("job_key"), "job_key", "left_semi").agg(
        F.coalesce(F.max("job_key"), F.lit(0).cast("bigint")).alias("last_job")
    )


def not_sent(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """Records that no export of the ledger has sent."""
    return records.join(ledger.select(*KEY), list(KEY), "left_anti")


def initialised(records: DataFrame, jobs: DataFrame, upstream: int) -> DataFrame:
    """One-time start: everything counts as sent, but for upstream files still waiting."""
    waiting = jobs.where((F.col("client_id") == upstream) & (F.col("file_status") == "Not Available")).select(
        "job_key", F.lit(True).alias("_waiting")
    )
    return (
        records.join(waiting, "job_key", "left")
        .withColumn(
            "out_job_key",
            F.when(F.col("_waiting"), F.col("out_job_key")).otherwise(
                F.coalesce("out_job_key", F.lit(0).cast("bigint"))
            ),
        )
        .drop("_waiting")
    )


def initial_marks(records: DataFrame, jobs: DataFrame, upstream: int) -> DataFrame:
    """What :func:`initialised` changes, as an update of a stored record table."""
    waiting = jobs.where((F.col("client_id") == upstream) & (F.col("file_status") == "Not Available")).select("job_key")
    unsent = records.where(F.col("out_job_key").isNull()).join(waiting, "job_key", "left_anti")
    return unsent.select(*KEY, F.lit(0).cast("bigint").alias("out_job_key"))
