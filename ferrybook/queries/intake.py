"""Intake control queries."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import intake as I
from ferrybook.operators.feeds import FeedPlan
from ferrybook.fixtures.dialect import DUCK
from ferrybook.plans import inbound
from ferrybook.plans.inbound import load
from ferrybook.queries.base import RECORD_SQL, SPEC, Tables, registry, with_relations
from ferrybook.queries.deadlines import COUNTS
from ferrybook.queries.files import ORACLES as STRUCTURE_ORACLES
from ferrybook.queries.rules import ALL, DUPLICATES, FLAGS, engine_sql, failing, outcome_sql, slice_sql, wording
from ferrybook.session import new_folder
from ferrybook.sources.store import Store

QUERIES, ORACLES, query = registry()


@query(
    "load_record_and_results",
    f"""{with_relations("line", "").rstrip()}, record as ({RECORD_SQL}){FLAGS}, outcome as ({engine_sql()}),
      every as (select job_key, rule_id, validation_result from outcome union all
        select job_key, rule_id, validation_result from ({DUPLICATES}))
      select r.job_key, records, outcomes, failures, duplicates
      from (select job_key, count(*) as records from record group by 1) r
        join (select job_key, count(*) as outcomes, count(*) filter (where validation_result = 'N') as failures,
          count(*) filter (where rule_id = 61) as duplicates from every group by 1) e on r.job_key = e.job_key""",
)
def load_record_and_results(t: Tables):
    """Loads all lines; per job the stored records, outcomes, failures and duplicate ids."""
    column, rule = ALL[61]
    loaded = load(t.relation("line"), R.rule_set(), "transmission_id", rule, column.report_position)
    records = loaded.records.groupBy("job_key").agg(F.count(F.lit(1)).alias("records"))
    outcomes = loaded.outcomes.groupBy("job_key").agg(
        F.count(F.lit(1)).alias("outcomes"),
        F.count(F.when(F.col("validation_result") == "N", 1)).alias("failures"),
        F.count(F.when(F.col("rule_id") == rule.rule_id, 1)).alias("duplicates"),
    )
    return records.join(outcomes, "job_key")


@query(
    "multi_file_hold",
    with_relations(
        "job feed",
        """select job_key, r.feed_id, day from (select *, cast(start_ts as date) as day, row_number() over (
            partition by feed_id, cast(start_ts as date) order by start_ts, job_key) as rn
          from job where file_type = 'INBOUND' and status <> 'Fail' and feed_id <> 3) r
        join feed f on r.feed_id = f.feed_id where rn > per_day""",
    ),
)
def multi_file_hold(t: Tables):
    return I.held_files(t.relation("job"), t.relation("feed"), exempt=(3,))


@query(
    "job_state",
    """select l_orderkey as job_key, count(*) as events,
      max(l_linenumber * 1000000 + l_partkey) as event_no,
      arg_max(case l_returnflag when 'R' then 'Running' when 'A' then 'Success' else 'Fail' end,
        [l_linenumber * 1000000 + l_partkey, l_suppkey, cast(l_quantity as bigint)]) as status
    from lineitem group by 1""",
)
def job_state(t: Tables):
    """Step events of every job, and the state after the last one."""
    events = t.table("lineitem").selectExpr(
        "l_orderkey as job_key", "l_linenumber * 1000000 + l_partkey as event_no", "l_suppkey as tie",
        "cast(l_quantity as bigint) as tie2",
        "case l_returnflag when 'R' then 'Running' when 'A' then 'Success' else 'Fail' end as status",
    )
    return I.current_state(events, "job_key", "event_no", ["tie", "tie2", "status"]).drop("tie", "tie2")


@query(
    "duration_alert",
    with_relations(
        "job feed",
        """select job_key, j.feed_id, date_sub('second', start_ts, end_ts) as seconds, duration
        from job j join feed f on j.feed_id = f.feed_id where date_sub('second', start_ts, end_ts) >= duration""",
    ),
)
def duration_alert(t: Tables):
    return I.duration_alerts(t.relation("job"), t.relation("feed"))


FROM, TO = datetime(1996, 1, 1), datetime(1997, 6, 30, 23, 59, 59)
WAITING = "feed_id = {} and status = 'Success' and not complete and file_status = 'Not Available'"


@query(
    "mark_available",
    with_relations(
        "job",
        f"""select job_key, case when {WAITING.format(3)} and (start_ts between timestamp '{FROM}' and timestamp '{TO}'
            or file_name in (select file_name from job where {WAITING.format(3)} and not start_ts between timestamp '{FROM}' and timestamp '{TO}' and job_key % 4 = 0))
          then 'Available' else file_status end as file_status from job""",
    ),
)
def mark_available(t: Tables):
    """First the files of a time range, then a list of names."""
    jobs = I.mark_by_time(t.relation("job"), 3, FROM, TO)
    names = jobs.where("feed_id = 3 and status = 'Success' and not complete and file_status = 'Not Available' and job_key % 4 = 0")
    return I.mark_by_names(jobs, 3, names).select("job_key", "file_status")


@query(
    "mark_complete_day",
    with_relations(
        "schedule job",
        f"""select j.job_key, case when not complete and status = 'Success' and file_status = 'Not Available'
          and exists (select 1 from ({COUNTS}) c join schedule x on c.schedule_id = x.schedule_id
            where x.processing_type = 'FILE COUNT' and c.result = 'complete' and c.feed_id = j.feed_id and j.start_ts between c.window_start and c.window_end) then 'Available' else file_status end as file_status
        from job j""",
    ),
)
def mark_complete_day(t: Tables):
    return I.mark_complete_days(t.relation("job"), t.relation("schedule")).select("job_key", "file_status")


NAMES = """case job_key % 10 when 1 then replace(file_name, '.TXT', '.csv') when 2 then replace(file_name, '_TST', ' TST')
  when 3 then 'X' || file_name else file_name end"""


@query(
    "name_checks",
    with_relations(
        "job feed",
        f"""select job_key, file_name, case
            when lower(file_name) not like '%.txt' then 'extension'
            when not regexp_full_match(replace(file_name, '.', ''), '[A-Za-z0-9_-]+')
              then 'characters'
            when not starts_with('FEED3_TST_HUB_YYMMDDHHMMSS', regexp_extract(file_name, '^[^0-9]*'))
              then 'prefix' end as error,
          feed_id not in (select feed_id from feed where feed_type = 'OUTBOUND') as wrong_feed
        from (select job_key, feed_id, {NAMES} as file_name from job)""",
    ),
)
def name_checks(t: Tables):
    """Checks of the names and feeds a person asks to mark."""
    asked = t.relation("job").selectExpr("job_key", "feed_id", f"{NAMES} as file_name")
    wrong = I.not_outbound(asked.select("feed_id").distinct(), t.relation("feed")).withColumn("wrong", F.lit(True))
    return (
        I.name_errors(asked, "FEED3_TST_HUB_YYMMDDHHMMSS")
        .join(wrong, "feed_id", "left")
        .select("job_key", "file_name", "error", F.coalesce("wrong", F.lit(False)).alias("wrong_feed"))
    )


# Files of every seventh job came before; the checks of a file are told in their order.
STATES = f"""select j.job_key, j.feed_id, j.start_ts, j.file_type, case when j.job_key % 7 = 0 then 'Repeated'
    when not check_structure or not check_details then 'Incomplete' else v.status end as first_state
  from job j join feed f on j.feed_id = f.feed_id join ({STRUCTURE_ORACLES["structure_verdict"]}) v on v.job_key = j.job_key"""
HELD = """select job_key from (select job_key, feed_id, row_number() over (partition by feed_id, cast(start_ts as date)
      order by start_ts, job_key) as rn, first_state from first_states where first_state in ('Success', 'Incomplete') and file_type = 'INBOUND') r
    join feed f on r.feed_id = f.feed_id where rn > per_day and first_state = 'Success'"""


# Feeds with specs and rules of their own: feed 2 is sent for another receiver, feed 6 names no sender, feed 3
# has a part of the rules and feeds 1 and 4 another part.
FEW, PLAIN = (10, 11, 20, 100, 101, 110), (10, 60, 70, 71, 80, 90, 51)
PARTS = {1: PLAIN, 3: FEW, 4: PLAIN}


def feed_plans() -> dict[int, FeedPlan]:
    specs = {2: replace(SPEC, receiver="ELSEWHERE"), 6: replace(SPEC, sender="")}
    parts = {feed: R.rule_set().only(*ids) for feed, ids in PARTS.items()}
    column, rule = ALL[61]
    return {
        f: FeedPlan(specs.get(f, SPEC), parts.get(f, R.rule_set()), "transmission_id", None if f == 4 else (column, rule))
        for f in range(1, 7)
    }


def part_sql(ids: tuple[int, ...]) -> str:
    return " union all ".join(outcome_sql(*ALL[i], failing(ALL[i][1], slice_sql(ALL[i][0])), wording(*ALL[i], slice_sql(ALL[i][0]))) for i in ids)


def _verdict_sql(sender: str, receiver: str) -> str:
    sql = STRUCTURE_ORACLES["structure_verdict"].replace("<> 'SENDER'", f"<> '{sender}'").replace("<> 'HUB'", f"<> '{receiver}'")
    return sql.replace("expected value of SENDER ", f"expected value of {sender} ").replace("expected value of HUB'", f"expected value of {receiver}'")


FEED_RUN = f"""with all_lines as ({R.line(DUCK)}), job as ({R.job(DUCK)}), feed as ({R.feed(DUCK)}),
  told as (select *, 0 as kind from ({_verdict_sql("SENDER", "HUB")}) union all select *, 2 from ({_verdict_sql("SENDER", "ELSEWHERE")})
    union all select *, 6 from ({_verdict_sql("", "HUB")})),
  first_states as (select j.job_key, j.feed_id, j.start_ts, j.file_type, case when j.job_key % 7 = 0 then 'Repeated'
      when not check_structure or not check_details then 'Incomplete' else t.status end as first_state, error_message
    from job j join feed f on j.feed_id = f.feed_id
      join told t on t.job_key = j.job_key and t.kind = case when j.feed_id in (2, 6) then j.feed_id else 0 end),
  states as (select job_key, feed_id, case when job_key in ({HELD}) then 'Held' else first_state end as state,
    case when first_state = 'Fail' then error_message else '' end as message from first_states),
  line as (select * from all_lines where job_key % 16 <> 11 and job_key in (select job_key from states where state = 'Success')),
  record as ({RECORD_SQL}){FLAGS}, outcome as ({engine_sql()}),
  few as ({part_sql(FEW)}), part as ({part_sql(PLAIN)}), feed_of as (select job_key, feed_id from states),
  every as (
    select o.* from outcome o join feed_of using (job_key) where feed_id not in (1, 3, 4)
    union all select o.* from few o join feed_of using (job_key) where feed_id = 3
    union all select o.* from part o join feed_of using (job_key) where feed_id in (1, 4)
    union all select o.* from ({DUPLICATES}) o join feed_of using (job_key) where feed_id <> 4),
  found as (select job_key, count(*) as outcomes, count(*) filter (where validation_result = 'N') as failures,
    cast(sum(length(error_message)) as bigint) as chars, count(distinct line_number) filter (where validation_result = 'N') as error_lines from every group by 1),
  sizes as (select job_key, count(*) as n from line group by 1)
  select s.job_key, state, message, coalesce(n, 0) as records, coalesce(outcomes, 0) as outcomes, coalesce(failures, 0) as failures,
    coalesce(chars, 0) as message_chars, case when state = 'Success' then coalesce(error_lines, 0) > 0 and error_lines >=
      case when threshold < 1 then coalesce(n, 0) * threshold else threshold end end as alert
  from states s join feed f on s.feed_id = f.feed_id left join found e on s.job_key = e.job_key left join sizes z on s.job_key = z.job_key"""


def feed_run(t: Tables, store: Store, run: str, where: str = "true", compiled: int = 24):
    """The files of all feeds that a condition picks, as one run."""
    jobs = t.relation("job").withColumn("file_name", F.concat_ws("-", "job_key", "file_name"))
    archive = jobs.where("job_key % 7 = 0").select(F.concat(F.lit("archive/"), "file_name").alias("path"))
    jobs = jobs.where(where)
    lines = t.relation("file").join(jobs.select("job_key"), "job_key", "left_semi")
    done = inbound.run_feeds(lines, jobs, t.relation("feed"), archive, feed_plans(), store, run, compiled=compiled)
    none = F.lit(0).cast("bigint")
    records = done.records["record"].groupBy("job_key").agg(F.count(F.lit(1)).alias("records"))
    outcomes = done.outcomes.groupBy("job_key").agg(
        F.count(F.lit(1)).alias("outcomes"), F.count(F.when(F.col("validation_result") == "N", 1)).alias("failures"),
        F.sum(F.length("error_message")).alias("message_chars"),
    )
    out = done.states.join(records, "job_key", "left").join(outcomes, "job_key", "left").join(done.alerts.select("job_key", "alert"), "job_key", "left")
    counts = [F.coalesce(c, none).alias(c) for c in ("records", "outcomes", "failures", "message_chars")]
    return out.select("job_key", "state", "message", *counts, "alert")


@query("inbound_run_feeds", FEED_RUN)
def inbound_run_feeds(t: Tables):
    """All feeds in one run: verdicts from one scan, every catalogue over its own part, plain ones as data."""
    return feed_run(t, Store(t.spark, new_folder(t.spark, "store")), "all", compiled=1)


FIRST_RUN = "start_ts < timestamp_ntz'1995-03-17 11:00:00'"


@query("inbound_two_runs", FEED_RUN)
def inbound_two_runs(t: Tables):
    """The same files in two runs that follow each other in time, the second one twice: equal to one run over all."""
    store = Store(t.spark, new_folder(t.spark, "store"))
    first = feed_run(t, store, "one", FIRST_RUN)
    feed_run(t, store, "two", f"not {FIRST_RUN}")
    return first.unionByName(feed_run(t, store, "two", f"not {FIRST_RUN}"))


@query(
    "inbound_job_log",
    f"""with run as ({FEED_RUN}) select job_key, 'received' as step, 'Running' as state, 0 as records from run
      union all select job_key, 'checked', state, 0 from run union all select job_key, 'loaded', state, records from run where state = 'Success'""",
)
def inbound_job_log(t: Tables):
    """The steps that a run of all feeds has logged."""
    store = Store(t.spark, new_folder(t.spark, "store"))
    feed_run(t, store, "all")
    return store.read("log").select("job_key", "step", "state", "records")


@query(
    "job_log_state",
    f"""select job_key, case when state = 'Success' then 3 else 2 end as events, case when state = 'Success' then 'loaded' else 'checked' end as step,
      state, records from ({FEED_RUN})""",
)
def job_log_state(t: Tables):
    """The state of all jobs after two runs, brought up to date after each from the newest part of the log."""
    store = Store(t.spark, new_folder(t.spark, "store"))
    feed_run(t, store, "one", FIRST_RUN)
    store.job_states()
    feed_run(t, store, "two", f"not {FIRST_RUN}")
    return store.job_states().select("job_key", F.col("events").cast("int").alias("events"), "step", "state", "records")


@query(
    "inbound_run",
    f"""with all_lines as ({R.line(DUCK)}), job as ({R.job(DUCK)}), feed as ({R.feed(DUCK)}), first_states as ({STATES}),
      states as (select job_key, feed_id, case when job_key in ({HELD}) then 'Held' else first_state end as state from first_states),
      line as (select * from all_lines where job_key % 16 <> 11 and job_key in (select job_key from states where state = 'Success')),
      record as ({RECORD_SQL}){FLAGS}, outcome as ({engine_sql()}),
      every as (select job_key, line_number, validation_result from outcome union all
        select job_key, line_number, validation_result from ({DUPLICATES})),
      found as (select job_key, count(*) as outcomes, count(*) filter (where validation_result = 'N') as failures,
        count(distinct line_number) filter (where validation_result = 'N') as error_lines from every group by 1),
      sizes as (select job_key, count(*) as n from line group by 1)
      select s.job_key, state, coalesce(n, 0) as records, coalesce(outcomes, 0) as outcomes, coalesce(failures, 0) as failures,
        case when state = 'Success' then coalesce(error_lines, 0) > 0 and error_lines >=
          case when threshold < 1 then coalesce(n, 0) * threshold else threshold end end as alert
      from states s join feed f on s.feed_id = f.feed_id left join found e on s.job_key = e.job_key left join sizes z on s.job_key = z.job_key""",
)
def inbound_run(t: Tables):
    """A whole run: per file its state, stored records, outcomes and failures, and the threshold alert."""
    jobs, feeds = t.relation("job"), t.relation("feed")
    column, rule = ALL[61]
    names = jobs.withColumn("file_name", F.concat_ws("-", "job_key", "file_name"))
    archive = names.where("job_key % 7 = 0").select(F.concat(F.lit("archive/"), "file_name").alias("path"))
    done = inbound.run(t.relation("file"), names, feeds, archive, SPEC, R.rule_set(), "transmission_id", rule, column.report_position)
    records = done.loaded.records.groupBy("job_key").agg(F.count(F.lit(1)).alias("records"))
    outcomes = done.loaded.outcomes.groupBy("job_key").agg(
        F.count(F.lit(1)).alias("outcomes"), F.count(F.when(F.col("validation_result") == "N", 1)).alias("failures")
    )
    out = done.states.join(records, "job_key", "left").join(outcomes, "job_key", "left")
    out = out.join(done.alerts.select("job_key", "alert"), "job_key", "left")
    none = F.lit(0).cast("bigint")
    return out.select("job_key", "state", *[F.coalesce(c, none).alias(c) for c in ("records", "outcomes", "failures")], "alert")
