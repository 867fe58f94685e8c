"""Delivery deadlines: schedules due, their windows, and what did or did not arrive in them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrybook.session import broadcast_if_small

# Kinds of schedules.
INBOUND, OUTBOUND, UPSTREAM, FILE_COUNT = "INBOUND->HUB", "HUB->OUTBOUND", "HUB->UPSTREAM", "FILE COUNT"


def at(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def minutes(n: Column | int) -> Column:
    return F.make_interval(mins=n if isinstance(n, Column) else F.lit(n))


def schedules_due(schedules: DataFrame, feeds: DataFrame, clients: DataFrame, as_of: datetime) -> DataFrame:
    """Active, idle schedules whose next poll has come, with feed and client where known."""
    due = schedules.where(F.col("is_active") & ~F.col("is_running") & (F.col("next_poll") <= at(as_of)))
    return due.join(feeds.select("feed_id", "client_id"), "feed_id", "left").join(
        clients, "client_id", "left"
    )


def with_windows(schedules: DataFrame) -> DataFrame:
    """Window of a schedule: up to its next poll, from the grace period before it."""
    end = F.col("next_poll")
    return schedules.select(
        "*",
        (end - minutes(F.col("grace_minutes"))).alias("window_start"),
        end.alias("window_end"),
        (end - minutes(30)).alias("less_end"),
    )


def in_windows(
    points: DataFrame, moment: str, windows: DataFrame, start: str, end: str, keys: Sequence[str] = ("feed_id",)
) -> DataFrame:
    """Points joined to the windows of the same key they fall into, both ends included.

    Windows are listed under each day they touch, so the join is an equi join on key and day. A
    checked small list is broadcast and the points stay where they are; beyond that both sides are
    shuffled, and a hot day is split by the skew join.
    """
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))
    listed = windows.where(F.col(start) <= F.col(end)).withColumn("_day", F.explode(days))
    return (
        points.withColumn("_day", F.col(moment).cast("date"))
        .join(broadcast_if_small(listed), [*keys, "_day"])
        .where(F.col(moment).between(F.col(start), F.col(end)))
        .drop("_day")
    )


BUCKET_SECONDS = 3600


def window_sums(
    points: DataFrame, moment: str, n: str, windows: DataFrame, start: str, end: str, keys: Sequence[str] = ("feed_id",)
) -> DataFrame:
    """(schedule_id, n): the sum of ``n`` over the points in each window, both ends included, without pairs.

    A window's sum is the running sum up to its end less the running sum before its start. Points are
    summed per moment and put in one list with the bounds; the list of each hour is summed up in order, so
    every bound learns the sum of its hour up to it. What lies in earlier hours is a running sum over
    the hours of a key. No point meets a window, however many windows hold it. Sums of 0 are left out.
    """
    bucket = F.floor(F.unix_micros(F.col("_at").cast("timestamp")) / (BUCKET_SECONDS * 1_000_000))
    moments = points.where(F.col(moment).isNotNull()).groupBy(*keys, F.col(moment).alias("_at")).agg(F.sum(n).alias("_n"))
    moments = moments.withColumn("_bucket", bucket)
    # a start comes before the points of its moment, an end behind them
    ends = F.array(
        F.struct(F.col(start).alias("at"), F.lit(0).alias("place"), F.lit(-1).alias("sign")),
        F.struct(F.col(end).alias("at"), F.lit(2).alias("place"), F.lit(1).alias("sign")),
    )
    bounds = windows.where(F.col(start) <= F.col(end)).select("schedule_id", *keys, F.explode(ends).alias("_b"))
    bounds = bounds.select("schedule_id", *keys, F.col("_b.at").alias("_at"), F.col("_b.place").alias("_place"), F.col("_b.sign").alias("_sign"))
    bounds = bounds.withColumn("_bucket", bucket)
    both = bounds.unionByName(moments.withColumn("_place", F.lit(1)), allowMissingColumns=True)
    inner = Window.partitionBy(*keys, "_bucket").orderBy("_at", "_place").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_inside", F.coalesce(F.sum("_n").over(inner), F.lit(0))).where(F.col("_sign").isNotNull())
    # a row per key and hour: bounded by the time that is looked at
    hours = moments.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_n"))
    asked = bounds.select(*keys, "_bucket", F.lit(0).cast("long").alias("_n")).distinct()
    past = Window.partitionBy(*keys, F.lit(0)).orderBy("_bucket").rangeBetween(Window.unboundedPreceding, -1)
    before = hours.unionByName(asked).withColumn("_before", F.coalesce(F.sum("_n").over(past), F.lit(0)))
    before = before.where(F.col("_n") == 0).select(*keys, "_bucket", "_before").distinct()
    told = inside.join(before, [*keys, "_bucket"]).withColumn("_sum", F.col("_sign") * (F.col("_before") + F.col("_inside")))
    return told.groupBy("schedule_id").agg(F.sum("_sum").alias("n")).where(F.col("n") != 0)


def window_counts(points: DataFrame, moment: str, windows: DataFrame, start: str, end: str) -> DataFrame:
    """Number of points per schedule window, 0 where nothing arrived."""
    ones = points.select("feed_id", moment, F.lit(1).cast("bigint").alias("n"))
    found = window_sums(ones, moment, "n", windows, start, end).withColumnRenamed("n", "files")
    return windows.join(found, "schedule_id", "left").withColumn(
        "files", F.coalesce("files", F.lit(0).cast("bigint"))
    )


def successful(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("status") == "Success")


def outside_maintenance(schedules: DataFrame, maintenance: DataFrame, moment: Column) -> DataFrame:
    """Schedules whose feed has no maintenance window around the given moment."""
    windows = maintenance.select(F.col("feed_id").alias("m_feed"), "from_ts", "to_ts")
    return schedules.join(
        windows, (F.col("feed_id") == F.col("m_feed")) & moment.between(F.col("from_ts"), F.col("to_ts")), "left_anti"
    )


def sla_met(jobs: DataFrame, moment: str, schedules: DataFrame) -> DataFrame:
    """Counts successful jobs in the window of every schedule and tells whether there was one."""
    return (
        window_counts(successful(jobs), moment, with_windows(schedules), "window_start", "window_end")
        .select("schedule_id", "feed_id", "processing_type", "files", (F.col("files") > 0).alias("met"))
    )


def undelivered(
    records: DataFrame, jobs: DataFrame, feeds: DataFrame, blocked: DataFrame, schedules: DataFrame, upstream: int
) -> DataFrame:
    """Requests not yet sent, of client jobs ended in the window and free of any level-1 line.

    ``blocked`` are the level-1 failures. Job level on purpose: one bad line keeps the whole job out.
    """
    inbound = feeds.where((F.col("feed_type") == "INBOUND") & (F.col("client_id") != upstream)).select("feed_id")
    clean = (
        successful(jobs)
        .join(inbound, "feed_id", "left_semi")
        .join(blocked.select("job_key"), "job_key", "left_anti")
        .select("job_key", "end_ts")
    )
    pending = (
        records.where(F.col("out_job_key").isNull() & (F.col("file_type") == "DQ"))
        .groupBy("job_key")
        .agg(F.count(F.lit(1)).alias("pending"))
    )
    windows = with_windows(schedules).select("schedule_id", "window_start", "less_end")
    ended = clean.join(pending, "job_key")
    found = window_sums(ended, "end_ts", "pending", windows, "window_start", "less_end", keys=[])
    found = found.withColumnRenamed("n", "undelivered")
    return (
        schedules.join(found, "schedule_id", "left")
        .select("schedule_id", "feed_id", F.coalesce("undelivered", F.lit(0).cast("bigint")).alias("undelivered"))
    )


def waiting(jobs: DataFrame) -> DataFrame:
    """Successful jobs that are neither available nor generated yet."""
    return successful(jobs).where(~F.col("complete") & (F.col("file_status") == "Not Available"))


def file_counts(jobs: DataFrame, schedules: DataFrame) -> DataFrame:
    """Waiting files in the window, its last second excluded, against the required number."""
    windows = with_windows(schedules).withColumn("window_end", F.col("window_end") - F.make_interval(secs=F.lit(1)))
    return window_counts(waiting(jobs), "start_ts", windows, "window_start", "window_end").select(
        "schedule_id", "feed_id", "window_start", "window_end", "files", "files_per_day",
        F.when(F.col("files") == 0, "nothing").when(F.col("files") == F.col("files_per_day"), "complete")
        .otherwise("alert").alias("result"),
    )


def late_receipts(jobs: DataFrame, schedules: DataFrame, today: datetime) -> DataFrame:
    """Successful jobs that ended between the last poll and the start of the next window of an inbound schedule.

    Feeds with several inbound schedules only count those that poll today.
    """
    day = F.lit(today.date())
    schedules = schedules.where(F.col("processing_type") == INBOUND)
    per_feed = schedules.groupBy("feed_id").agg(F.count(F.lit(1)).alias("schedules"))
    usable = (
        schedules.join(per_feed, "feed_id")
        .where(
            (F.col("schedules") <= 1)
            | (F.col("last_poll").cast("date") == day)
            | (F.col("next_poll").cast("date") == day)
        )
        .select(
            "schedule_id", "feed_id", "last_poll",
            (F.col("last_poll") - minutes(F.col("grace_minutes"))).alias("sla_start"),
            (F.col("next_poll") - minutes(F.col("grace_minutes"))).alias("late_until"),
        )
    )
    late = in_windows(
        successful(jobs).select("job_key", "feed_id", "end_ts"), "end_ts", usable, "last_poll", "late_until"
    )
    return late.select(
        "job_key", "feed_id", "schedule_id", "sla_start", F.col("last_poll").alias("sla_end"),
        F.col("end_ts").alias("received"), "late_until",
    )


def stuck_files(landed: DataFrame, jobs: DataFrame) -> DataFrame:
    """Landed files without a successful job of that name."""
    done = successful(jobs).select("file_name")
    return landed.join(done, "file_name", "left_anti")


def alerts(
    schedules: DataFrame, quiet: DataFrame, jobs: DataFrame, stuck: DataFrame, pending: DataFrame, today: datetime
) -> DataFrame:
    """Every schedule checked by its kind: alert_type, schedule_id, feed_id, n.

    ``quiet`` are the schedules outside maintenance, ``pending`` their rows of :func:`undelivered`,
    ``stuck`` the rows of :func:`stuck_files`. A missed inbound schedule whose feed has landed files is
    reported as stuck, with their number, and not as missing. Late receipts are counted per schedule of
    all ``schedules``: a receipt is late whatever maintenance is on now.
    """

    def of(kind: str) -> DataFrame:
        return quiet.where(F.col("processing_type") == kind)

    def alert(name: Column | str, found: DataFrame, n: Column | str) -> DataFrame:
        name = F.lit(name) if isinstance(name, str) else name
        n = F.col(n) if isinstance(n, str) else n
        return found.select(name.alias("alert_type"), "schedule_id", "feed_id", n.alias("n"))

    landed = stuck.groupBy("feed_id").agg(F.count(F.lit(1)).alias("landed"))
    missed = sla_met(jobs, "start_ts", of(INBOUND)).where(~F.col("met")).join(landed, "feed_id", "left")
    kind = F.when(F.col("landed").isNull(), "inbound missing").otherwise("stuck file")
    late = late_receipts(jobs, schedules, today).groupBy("schedule_id", "feed_id").agg(F.count(F.lit(1)).alias("late"))
    unsent = pending.where(F.col("undelivered") > 0).join(of(UPSTREAM).select("schedule_id"), "schedule_id", "left_semi")
    return (
        alert(kind, missed, F.coalesce("landed", "files"))
        .unionByName(alert("outbound missing", sla_met(jobs, "end_ts", of(OUTBOUND)).where(~F.col("met")), "files"))
        .unionByName(alert("undelivered", unsent, "undelivered"))
        .unionByName(alert("file count", file_counts(jobs, of(FILE_COUNT)).where(F.col("result") == "alert"), "files"))
        .unionByName(alert("late receipt", late, "late"))
    )


def next_schedule(schedules: DataFrame) -> DataFrame:
    """Per feed and type the schedule with the earliest next poll."""
    return (
        schedules.groupBy("feed_id", "processing_type")
        .agg(F.min(F.struct("next_poll", "schedule_id")).alias("first"))
        .select("feed_id", "processing_type", "first.schedule_id", "first.next_poll")
    )


# Date part of a name pattern, how today is written into it, what stays as text.
NAME_SUFFIXES = {
    "YYMMDDHHMMSS": ("yyMMdd", "HHMMSS"),
    "MMDDYY.HHMMSS": ("MMddyy", ".HHMMSS"),
    "MMDDYYHHMMSS": ("MMddyy", "HHMMSS"),
}


def expected_name(pattern: Column, moment: Column) -> Column:
    """The name a file of today would have; the time of day is left open."""
    suffix = F.substring_index(pattern, "_", -1)
    prefix = F.substring(pattern, F.lit(1), F.length(pattern) - F.length(suffix))
    out: Column | None = None
    for text, (dated, rest) in NAME_SUFFIXES.items():
        name = F.concat(prefix, F.date_format(moment, dated), F.lit(rest))
        out = F.when(suffix == text, name) if out is None else out.when(suffix == text, name)
    return out
