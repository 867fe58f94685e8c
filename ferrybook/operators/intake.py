"""Load and intake control: holds, job states, duration alerts, marking files available."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrybook.functions.text import strip
from ferrybook.operators.deadlines import FILE_COUNT, at, in_windows, waiting, with_windows, window_counts
from ferrybook.session import broadcast_if_small


def held_files(jobs: DataFrame, feeds: DataFrame, exempt: Sequence[int] = (), used: DataFrame | None = None) -> DataFrame:
    """Inbound files beyond the number a feed may send per day.

    Every file that did not fail takes a place. ``used`` (feed_id, day, used) tells how many places earlier
    runs have given away. Only the first few files of each feed and day are ranked, and each task sends no
    more than those to the shuffle; the last allowed file of a day is then the bar for all others.
    """
    candidates = jobs.where(
        (F.col("file_type") == "INBOUND") & (F.col("status") != "Fail") & ~F.col("feed_id").isin(*exempt)
    ).select("job_key", "feed_id", "start_ts", F.col("start_ts").cast("date").alias("day"))
    most = feeds.agg(F.max("per_day")).first()[0]
    by_start = Window.partitionBy("feed_id", "day").orderBy("start_ts", "job_key")
    left = F.col("per_day")
    allowed = feeds.select("feed_id", "per_day")
    if used is not None:
        left = left - F.coalesce("used", F.lit(0))
    placed = candidates.withColumn("place", F.row_number().over(by_start)).where(F.col("place") <= F.lit(most)).join(allowed, "feed_id")
    places = candidates.join(allowed, "feed_id")
    if used is not None:
        placed, places = (x.join(used, ["feed_id", "day"], "left") for x in (placed, places))
    bars = placed.where(F.col("place") == left).select("feed_id", "day", F.struct("start_ts", "job_key").alias("bar"))
    beyond = candidates.join(broadcast_if_small(bars), ["feed_id", "day"]).where(F.struct("start_ts", "job_key") > F.col("bar"))
    closed = places.where(left <= 0)  # where no place is left, there is no file to be the bar
    return beyond.select("job_key", "feed_id", "day").unionByName(closed.select("job_key", "feed_id", "day"))


def latest(rows: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """``key, events, order, columns``: the row of every key with the highest ``order``, and the sum of ``events``.

    Counts and the highest order come from a hash aggregate over numbers; the rows that have it are then
    looked up. Of several with the same order the highest by ``columns`` counts.
    """
    last = rows.groupBy(key).agg(F.sum("events").alias("events"), F.max(order).alias(order))
    held = rows.drop("events").join(broadcast_if_small(last), [key, order])
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in columns]))
    return held.withColumn("_place", place).where("_place = 1").select(key, "events", order, *columns)


def current_state(events: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """The latest event of every key, and how many there were."""
    return latest(events.withColumn("events", F.lit(1).cast("bigint")), key, order, columns)


def duration_alerts(jobs: DataFrame, feeds: DataFrame) -> DataFrame:
    """Jobs that ran at least as long as their feed's limit in seconds."""
    seconds = F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts"))
    return (
        jobs.join(feeds.select("feed_id", "duration"), "feed_id")
        .select("job_key", "feed_id", seconds.alias("seconds"), "duration")
        .where(F.col("seconds") >= F.col("duration"))
    )


def _waiting_of(feed_id: int) -> Column:
    return (
        (F.col("feed_id") == feed_id)
        & (F.col("status") == "Success")
        & ~F.col("complete")
        & (F.col("file_status") == "Not Available")
    )


def _marked(jobs: DataFrame, chosen: Column) -> DataFrame:
    return jobs.withColumn("file_status", F.when(chosen, "Available").otherwise(F.col("file_status")))


def mark_by_time(jobs: DataFrame, feed_id: int, start: datetime, end: datetime) -> DataFrame:
    """A new job snapshot with the waiting files of a time range made available."""
    return _marked(jobs, _waiting_of(feed_id) & F.col("start_ts").between(at(start), at(end)))


def available_by_time(jobs: DataFrame, feed_id: int, start: datetime, end: datetime) -> DataFrame:
    """What :func:`mark_by_time` changes, as an update of a stored job table."""
    chosen = jobs.where(_waiting_of(feed_id) & F.col("start_ts").between(at(start), at(end)))
    return chosen.select("job_key", F.lit("Available").alias("file_status"))


def mark_by_names(jobs: DataFrame, feed_id: int, names: DataFrame) -> DataFrame:
    """The same for a list of names; refuses the whole list when one is not a waiting file."""
    wanted = names.select("file_name").distinct()
    missing = wanted.join(jobs.where(_waiting_of(feed_id)), "file_name", "left_anti")
    if wanted.isEmpty() or not missing.isEmpty():
        raise ValueError("a given file is not a waiting file of the feed")
    flagged = jobs.join(broadcast_if_small(wanted.withColumn("_named", F.lit(True))), "file_name", "left")
    return _marked(flagged, _waiting_of(feed_id) & F.coalesce("_named", F.lit(False))).select(*jobs.columns)


def available_by_days(jobs: DataFrame, schedules: DataFrame) -> DataFrame:
    """Waiting files whose file-count window holds exactly the required number, as an update of a stored job table."""
    windows = with_windows(schedules.where(F.col("processing_type") == FILE_COUNT)).withColumn("window_end", F.col("window_end") - F.make_interval(secs=F.lit(1)))
    counted = window_counts(waiting(jobs), "start_ts", windows, "window_start", "window_end")
    complete = counted.where(F.col("files") == F.col("files_per_day")).select(
        "schedule_id", "feed_id", "window_start", "window_end"
    )
    hit = in_windows(waiting(jobs).select("job_key", "feed_id", "start_ts"), "start_ts", complete, "window_start", "window_end")
    return hit.select("job_key").distinct().select("job_key", F.lit("Available").alias("file_status"))


def mark_complete_days(jobs: DataFrame, schedules: DataFrame) -> DataFrame:
    """A new job snapshot with the files of :func:`available_by_days` made available."""
    hit = available_by_days(jobs, schedules).select("job_key", F.lit(True).alias("_hit"))
    flagged = jobs.join(broadcast_if_small(hit), "job_key", "left")
    return _marked(flagged, F.coalesce("_hit", F.lit(False))).select(*jobs.columns)


def request_error(start: datetime | None, end: datetime | None, has_names: bool) -> str | None:
    """Code of what is wrong with a request to mark files: it takes a whole time range or names, one of them."""
    bounds = sum(x is not None for x in (start, end))
    if bounds == 1:
        return "half_range"
    if bool(bounds) == has_names:
        return "range_and_names" if has_names else "nothing_asked"
    return "range_reversed" if bounds and end < start else None


def name_errors(names: DataFrame, pattern: str) -> DataFrame:
    """Adds the code of what is wrong with a file name: extension, characters, or text before its first digit."""
    name = strip(F.col("file_name"))
    prefix = F.regexp_extract(name, r"\A[^0-9]*", 0)
    error = (
        F.when(~F.lower(name).endswith(".txt"), "extension")
        .when(~F.replace(name, F.lit("."), F.lit("")).rlike(r"\A[\w\-]+\z"), "characters")
        .when(~F.startswith(F.lit(pattern), prefix), "prefix")
    )
    return names.withColumn("error", error)


def not_outbound(ids: DataFrame, feeds: DataFrame) -> DataFrame:
    """Requested feeds that are no outbound feeds."""
    return ids.join(feeds.where(F.col("feed_type") == "OUTBOUND").select("feed_id"), "feed_id", "left_anti")
