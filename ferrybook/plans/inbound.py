"""Inbound: from lines of files to loaded records and rule outcomes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.functions.text import base_name
from ferrybook.operators.deadlines import late_receipts
from ferrybook.operators.feeds import COMPILED, FeedPlan, by_layout, evaluate_feeds, feed_verdicts, numbered
from ferrybook.operators.intake import held_files
from ferrybook.operators.layout import parse
from ferrybook.operators.outcomes import duplicate_ids, error_line_counts, threshold_alerts
from ferrybook.operators.rules import RuleSet, evaluate, with_first_value
from ferrybook.operators.structure import FAIL, INCOMPLETE, SUCCESS, SpecColumn, StructureSpec, already_processed, marked, spec_table, verdict
from ferrybook.session import broadcast_if_small, new_folder, settle
from ferrybook.sources.sinks import write_outcomes
from ferrybook.sources.store import Store, name_bucket

REPEATED, HELD, UNKNOWN = "Repeated", "Held", "Unknown"


@dataclass(frozen=True)
class Loaded:
    records: DataFrame
    outcomes: DataFrame


def load(lines: DataFrame, rules: RuleSet, id_column: str, duplicate_rule, position: str) -> Loaded:
    """Store the records and the rule outcomes of detail lines, duplicates of an id included.

    Both lie by job and line inside their files. The lines are sorted, not the parsed records or the many
    outcomes of a line, which come out in the order of the lines.
    """
    order = ("job_key", "line_number")
    spark = lines.sparkSession
    records_path, outcomes_path = new_folder(spark, "records"), new_folder(spark, "outcomes")
    parse(lines.sortWithinPartitions(*order), rules.layout).write.parquet(records_path)
    records = spark.read.parquet(records_path)
    duplicates = duplicate_ids(
        records, id_column, duplicate_rule.rule_id, position, duplicate_rule.error_code, duplicate_rule.error_level
    )
    checked = evaluate(with_first_value(lines, rules).sortWithinPartitions(*order), rules)
    write_outcomes(checked.unionByName(duplicates.sortWithinPartitions(*order)), outcomes_path)
    return Loaded(records, spark.read.parquet(outcomes_path))


def _seen_before(named: DataFrame, store: Store, run: str) -> DataFrame:
    """Files whose name an earlier run has accepted; only the buckets of their names are read."""
    buckets = [r.bucket for r in named.select(name_bucket(F.col("file_name")).alias("bucket")).distinct().collect()]
    known = store.read("names", but=run).where(F.col("bucket").isin(buckets)).select("file_name")
    return named.join(known, "file_name", "left_semi").select("job_key")


def _repeats(checked: DataFrame) -> DataFrame:
    """Of files that pass under one name, all but the first one."""
    passed = checked.where(F.col("status") == SUCCESS).select("job_key", "file_name", "start_ts")
    again = passed.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.min("start_ts").alias("first")).where("n > 1")
    rows = passed.join(broadcast_if_small(again), "file_name")
    # the first moment may be that of several files: the smallest key of them stays
    heads = rows.where("start_ts = first").groupBy("file_name").agg(F.min("job_key").alias("head"))
    return rows.join(broadcast_if_small(heads), "file_name").where("job_key <> head").select("job_key")


def _used_places(store: Store, run: str, checked: DataFrame) -> DataFrame:
    """(feed_id, day, used): inbound files of earlier runs that did not fail; only the days at hand are read."""
    days = [r.day for r in checked.select(F.col("start_ts").cast("date").alias("day")).distinct().collect()]
    taken = store.read("files", but=run).where(F.col("day").isin(days) & (F.col("file_type") == "INBOUND"))
    taken = taken.where(F.col("state").isin(SUCCESS, HELD, INCOMPLETE))
    return taken.groupBy("feed_id", "day").agg(F.count(F.lit(1)).alias("used"))


def file_states(
    jobs: DataFrame, feeds: DataFrame, archive: DataFrame, told: DataFrame, store: Store | None = None, run: str = ""
) -> DataFrame:
    """job_key, feed_id, state, message: what becomes of every listed file, the first reason that holds.

    A file whose name is in the archive or was accepted before is repeated; one of a feed with a check
    switched off is parked; one with a structure error (``told``, the verdicts) fails; one under the name
    of an earlier file of the run is repeated; one beyond the number a feed may send per day is held.
    Parked and held files take places of the day too. A file without a verdict is of no known feed.
    """
    named = jobs.select("job_key", base_name(F.col("file_name")).alias("file_name"))
    seen = already_processed(jobs.select("job_key", F.col("file_name").alias("path")), archive).select("job_key")
    if store:
        seen = seen.unionByName(_seen_before(named, store, run))
    parked = feeds.where(~F.col("check_structure") | ~F.col("check_details")).select("feed_id", F.lit(True).alias("parked"))
    state = (
        F.when(F.col("seen"), REPEATED).when(F.col("told").isNull(), UNKNOWN).when(F.col("parked"), INCOMPLETE).otherwise(F.col("told"))
    )
    checked = settle(
        jobs.select("job_key", "feed_id", "file_type", "start_ts")
        .join(named, "job_key")
        .join(seen.distinct().withColumn("seen", F.lit(True)), "job_key", "left")
        .join(parked, "feed_id", "left")
        .join(told.select("job_key", F.col("status").alias("told"), "error_message"), "job_key", "left")
        .select("job_key", "feed_id", "file_type", "file_name", "start_ts", state.alias("status"), "error_message")
    )
    again = broadcast_if_small(_repeats(checked).withColumn("again", F.lit(True)))
    checked = checked.join(again, "job_key", "left").withColumn("status", F.when(F.col("again"), REPEATED).otherwise(F.col("status")))
    used = _used_places(store, run, checked) if store else None
    beyond = held_files(checked.where(F.col("status").isin(SUCCESS, INCOMPLETE)), feeds, used=used)
    held = beyond.select("job_key", F.lit(True).alias("held"))
    return checked.join(held, "job_key", "left").select(
        "job_key",
        "feed_id",
        F.when(F.col("held") & (F.col("status") == SUCCESS), HELD).otherwise(F.col("status")).alias("state"),
        F.when(F.col("status") == FAIL, F.col("error_message")).otherwise("").alias("message"),
    )


@dataclass(frozen=True)
class Inbound:
    states: DataFrame
    loaded: Loaded
    alerts: DataFrame


DETAIL = "line_number > 1 and not _is_header and not _is_trailer"


def run(
    lines: DataFrame, jobs: DataFrame, feeds: DataFrame, archive: DataFrame, spec: StructureSpec, rules: RuleSet,
    id_column: str, duplicate_rule, position: str,
) -> Inbound:
    """One run over arrived files: their states, and of those that pass the records, rule outcomes and
    threshold alerts. Lines of other files are not looked at after their verdict."""
    told = verdict(lines, spec, listing=jobs.select("job_key"))
    states = settle(file_states(jobs, feeds, archive, told))
    passed = states.where(F.col("state") == SUCCESS).select("job_key", "feed_id")
    marks = marked(lines, spec, ["job_key"]).where(DETAIL)
    details = marks.select("job_key", "line_number", "value").join(passed.select("job_key"), "job_key", "left_semi")
    loaded = load(settle(details), rules, id_column, duplicate_rule, position)
    sizes = loaded.records.groupBy("job_key").agg(F.count(F.lit(1)).alias("detail_lines"))
    alerts = threshold_alerts(error_line_counts(loaded.outcomes, passed), sizes, passed, feeds)
    return Inbound(states, loaded, alerts)


@dataclass(frozen=True)
class FeedsInbound:
    """``records`` by layout name."""

    states: DataFrame
    records: Mapping[str, DataFrame]
    outcomes: DataFrame
    alerts: DataFrame
    late: DataFrame


def _part(store: Store, table: str, run: str) -> str:
    return f"{store.path(table)}/run={run}"


def run_feeds(
    lines: DataFrame, jobs: DataFrame, feeds: DataFrame, archive: DataFrame, plans: Mapping[int, FeedPlan], store: Store, run: str,
    schedules: DataFrame | None = None, today: datetime | None = None, compiled: int = COMPILED,
) -> FeedsInbound:
    """One run over the files of many feeds, each with its own spec and rules, that knows the runs before it.

    Verdicts take one scan of the lines. Details of files that pass are stored once, a folder per
    distinct catalogue, and every catalogue reads its own. Records, outcomes, the log and what later
    runs have to know are written under the run's name and count from the commit at the end on: a run
    that is repeated, after a crash or by mistake, replaces itself. With ``schedules`` the receipts behind
    their deadline are told too; ``jobs`` then need ``end_ts``. Runs are meant to follow each other in time:
    places of a day that earlier runs gave away stay given.
    """
    spark = lines.sparkSession
    if "/" in run or "=" in run or not run:
        raise ValueError(f"no name for a run: {run!r}")
    told = feed_verdicts(lines, jobs, plans)
    states = settle(file_states(jobs, feeds, archive, told, store, run))
    passed = states.where(F.col("state") == SUCCESS).select("job_key", "feed_id")
    _, of_feed = numbered(plans)
    number = spark.createDataFrame(sorted(of_feed.items()), "feed_id int, catalogue int")
    specs = spec_table(spark, {f: p.spec for f, p in plans.items()}).join(number, "feed_id")
    own = lines.join(broadcast_if_small(passed), "job_key").join(F.broadcast(specs), "feed_id")
    details = marked(own, SpecColumn(), ["job_key", "feed_id", "catalogue"]).where(DETAIL)
    path = new_folder(spark, "details")
    details.select("job_key", "feed_id", "line_number", "value", "catalogue").write.partitionBy("catalogue").parquet(path)
    kind = lines.schema["job_key"].dataType.simpleString()
    details = spark.read.schema(f"job_key {kind}, feed_id int, line_number bigint, value string, catalogue int").parquet(path)

    records, duplicates = {}, []
    for name, (rules, numbers) in by_layout(plans).items():
        part = _part(store, f"records/{name}", run)
        own = details.where(F.col("catalogue").isin(numbers)).sortWithinPartitions("job_key", "line_number")
        parsed = parse(own, rules.layout, ("job_key", "feed_id", "line_number"))
        parsed.write.mode("overwrite").parquet(part)
        records[name] = spark.read.schema(parsed.schema).parquet(part)
        told_by: dict[tuple, list[int]] = {}
        for feed, plan in plans.items():
            if plan.duplicates and plan.rules.layout.name == name:
                told_by.setdefault((plan.id_column, *plan.duplicates), []).append(feed)
        for (id_column, column, rule), ids in told_by.items():
            mine = records[name].where(F.col("feed_id").isin(ids))
            again = duplicate_ids(mine, id_column, rule.rule_id, column.report_position, rule.error_code, rule.error_level)
            duplicates.append(again.sortWithinPartitions("job_key", "line_number"))
    checked = reduce(DataFrame.unionByName, [evaluate_feeds(details, plans, compiled), *duplicates])
    part = _part(store, "outcomes", run)
    checked.write.mode("overwrite").parquet(part)
    outcomes = spark.read.schema(checked.schema).parquet(part)

    sizes = settle(details.groupBy("job_key").agg(F.count(F.lit(1)).alias("detail_lines")))
    alerts = threshold_alerts(error_line_counts(outcomes, passed), sizes, passed, feeds)
    done = jobs.join(states.select("job_key", "state", "message"), "job_key")
    late = states.select("job_key", "feed_id").limit(0)
    if schedules is not None:
        ended = done.where(F.col("state") == SUCCESS).select("job_key", "feed_id", "end_ts", F.col("state").alias("status"))
        late = late_receipts(ended, schedules, today)
    remember(store, run, done, sizes)
    return FeedsInbound(states, records, outcomes, alerts, late)


def remember(store: Store, run: str, done: DataFrame, sizes: DataFrame) -> None:
    """Write the run's files, accepted names and log, then commit it."""
    done = done.withColumn("file_name", base_name(F.col("file_name")))
    store.put("files", done.withColumn("day", F.col("start_ts").cast("date")), run)
    accepted = done.where(F.col("state").isin(SUCCESS, HELD))
    store.put("names", accepted.withColumn("bucket", name_bucket(F.col("file_name"))), run)
    steps = done.join(sizes, "job_key", "left").selectExpr(
        "job_key",
        f"""inline(array_compact(array(
          named_struct('event_no', 1L, 'step', 'received', 'state', 'Running', 'records', 0L, 'message', ''),
          named_struct('event_no', 2L, 'step', 'checked', 'state', state, 'records', 0L, 'message', message),
          case when state = '{SUCCESS}' then
            named_struct('event_no', 3L, 'step', 'loaded', 'state', state, 'records', coalesce(detail_lines, 0L), 'message', message) end)))""",
    )
    store.put("log", steps, run)
    store.commit(run)
