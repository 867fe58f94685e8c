"""Deadline and delivery queries over the job log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import deadlines as D
from ferrybook.operators import outcomes as O
from ferrybook.queries.base import RECORD_SQL, Tables, registry, with_relations
from ferrybook.queries.rules import all_failures, with_top
from ferrybook.sources.text import route_by_name

QUERIES, ORACLES, query = registry()


AS_OF = datetime(1996, 9, 1, 12, 0, 0)
IN_MAINTENANCE = datetime(1996, 2, 28, 11, 0, 0)
TODAY = datetime(1996, 1, 29, 9, 0, 0)  # an inbound schedule polls
UPSTREAM = 2

WINDOW_SQL = """next_poll - to_minutes(cast(grace_minutes as int)) as window_start, next_poll as window_end,
  next_poll - to_minutes(30) as less_end"""


def clients(t: Tables):
    return t.table("region").select(F.col("r_regionkey").alias("client_id"), F.col("r_name").alias("client_name"))


@query(
    "schedules_due",
    with_relations(
        "schedule_book feed",
        f"""select s.schedule_id, s.feed_id, s.next_poll, f.client_id, r_name as client_name
        from schedule_book s left join feed f on s.feed_id = f.feed_id left join region on f.client_id = r_regionkey
        where s.is_active and not s.is_running and s.next_poll <= timestamp '{AS_OF}'""",
    ),
)
def schedules_due(t: Tables):
    due = D.schedules_due(t.relation("schedule_book"), t.relation("feed"), clients(t), AS_OF)
    return due.select("schedule_id", "feed_id", "next_poll", "client_id", "client_name")


@query(
    "schedule_window",
    with_relations("schedule_book", f"select schedule_id, {WINDOW_SQL} from schedule_book"),
)
def schedule_window(t: Tables):
    return D.with_windows(t.relation("schedule_book")).select("schedule_id", "window_start", "window_end", "less_end")


def met_sql(moment: str, where: str = "true") -> str:
    return f"""select s.schedule_id, s.feed_id, s.processing_type, coalesce(n, 0) as files, coalesce(n, 0) > 0 as met
      from schedule s left join (select w.schedule_id, count(*) as n from (select *, {WINDOW_SQL} from schedule) w
        join job j on j.feed_id = w.feed_id and j.{moment} between w.window_start and w.window_end and j.status = 'Success'
        group by 1) c on s.schedule_id = c.schedule_id where {where}"""


@query("sla_inbound", with_relations("schedule job", met_sql("start_ts")))
def sla_inbound(t: Tables):
    return D.sla_met(t.relation("job"), "start_ts", t.relation("schedule"))


@query("sla_outbound", with_relations("schedule job", met_sql("end_ts")))
def sla_outbound(t: Tables):
    return D.sla_met(t.relation("job"), "end_ts", t.relation("schedule"))


QUIET = f"""not exists (select 1 from maintenance m where m.feed_id = s.feed_id
  and timestamp '{IN_MAINTENANCE}' between from_ts and to_ts)"""


@query("sla_maintenance", with_relations("schedule job maintenance", met_sql("start_ts", QUIET)))
def sla_maintenance(t: Tables):
    """Inbound check with the schedules of feeds under maintenance left out."""
    schedules = D.outside_maintenance(t.relation("schedule"), t.relation("maintenance"), D.at(IN_MAINTENANCE))
    return D.sla_met(t.relation("job"), "start_ts", schedules)


UNDELIVERED = f"""select s.schedule_id, s.feed_id, cast(coalesce(n, 0) as bigint) as undelivered from schedule s left join (
    select w.schedule_id, count(*) as n from (select *, {WINDOW_SQL} from schedule) w
      join job j on j.end_ts between w.window_start and w.less_end
      join record r on r.job_key = j.job_key
    where j.status = 'Success' and j.feed_id in (select feed_id from feed where feed_type = 'INBOUND' and client_id <> {UPSTREAM})
      and r.out_job_key is null and r.file_type = 'DQ'
      and j.job_key not in (select job_key from top where error_level = 1)
    group by 1) c on s.schedule_id = c.schedule_id"""


def undelivered(t: Tables, schedules):
    blocked = O.level_one(all_failures(t, level=1), O.rule_meta(t.spark, R.ruled_columns()))
    return D.undelivered(t.record(), t.relation("job"), t.relation("feed"), blocked, schedules, UPSTREAM)


@query("sla_undelivered", with_top("line job feed schedule", UNDELIVERED))
def sla_undelivered(t: Tables):
    return undelivered(t, t.relation("schedule"))


COUNTS = f"""select s.schedule_id, s.feed_id, s.window_start, s.window_end - to_seconds(1) as window_end,
    coalesce(n, 0) as files, s.files_per_day, case when coalesce(n, 0) = 0 then 'nothing'
      when n = s.files_per_day then 'complete' else 'alert' end as result
  from (select *, {WINDOW_SQL} from schedule) s left join (
    select w.schedule_id, count(*) as n from (select *, {WINDOW_SQL} from schedule) w join job j
      on j.feed_id = w.feed_id and j.start_ts between w.window_start and w.window_end - to_seconds(1)
    where j.status = 'Success' and not j.complete and j.file_status = 'Not Available' group by 1) c
    on s.schedule_id = c.schedule_id"""


@query("sla_file_count", with_relations("schedule job", COUNTS))
def sla_file_count(t: Tables):
    return D.file_counts(t.relation("job"), t.relation("schedule"))


LATE = f"""select j.job_key, j.feed_id, s.schedule_id, s.last_poll - to_minutes(s.grace_minutes) as sla_start,
    s.last_poll as sla_end, j.end_ts as received, s.next_poll - to_minutes(s.grace_minutes) as late_until
  from job j join schedule s on j.feed_id = s.feed_id and s.processing_type = 'INBOUND->HUB'
    and j.end_ts between s.last_poll and s.next_poll - to_minutes(s.grace_minutes)
  where j.status = 'Success'
    and ((select count(*) from schedule x where x.feed_id = s.feed_id and x.processing_type = 'INBOUND->HUB') <= 1
      or cast(s.last_poll as date) = date '{TODAY:%Y-%m-%d}' or cast(s.next_poll as date) = date '{TODAY:%Y-%m-%d}')"""


@query("sla_late_receipt", with_relations("schedule job", LATE))
def sla_late_receipt(t: Tables):
    return D.late_receipts(t.relation("job"), t.relation("schedule"), TODAY)


STUCK = """select l.file_name, f.feed_id from (select distinct file_name from job where job_key % 5 < 2) l
  join feed f on length(l.file_name) - length(replace(l.file_name, '_', '')) > 2
    and contains(f.name_pattern, array_to_string(string_split(l.file_name, '_')[1:3], '_') || '_')
  where l.file_name not in (select file_name from job where status = 'Success')"""


def stuck(t: Tables):
    landed = t.relation("job").where("job_key % 5 < 2").select("file_name").distinct()
    routed = route_by_name(landed, t.relation("feed")).where(F.col("feed_id").isNotNull())
    return D.stuck_files(routed.select("file_name", "feed_id"), t.relation("job"))


@query("sla_stuck", with_relations("job feed", STUCK))
def sla_stuck(t: Tables):
    return stuck(t)


@query(
    "sla_alerts",
    with_top(
        "line job feed schedule maintenance",
        f"""select case when landed is null then 'inbound missing' else 'stuck file' end as alert_type, schedule_id, i.feed_id,
          coalesce(landed, files) as n from ({met_sql("start_ts", QUIET)}) i
          left join (select feed_id, count(*) as landed from ({STUCK}) group by 1) k on i.feed_id = k.feed_id
          where processing_type = 'INBOUND->HUB' and not met
        union all select 'outbound missing', schedule_id, feed_id, files from ({met_sql("end_ts", QUIET)}) o
          where processing_type = 'HUB->OUTBOUND' and not met
        union all select 'undelivered', u.schedule_id, u.feed_id, undelivered from ({UNDELIVERED}) u
          join schedule s on u.schedule_id = s.schedule_id where processing_type = 'HUB->UPSTREAM' and undelivered > 0 and {QUIET}
        union all select 'file count', c.schedule_id, c.feed_id, files from ({COUNTS}) c join schedule s
          on c.schedule_id = s.schedule_id where processing_type = 'FILE COUNT' and result = 'alert' and {QUIET}
        union all select 'late receipt', schedule_id, feed_id, count(*) from ({LATE}) group by 1, 2, 3""",
    ),
)
def sla_alerts(t: Tables):
    """Every schedule checked by its type, as one alert table."""
    schedules = t.relation("schedule")
    quiet = D.outside_maintenance(schedules, t.relation("maintenance"), D.at(IN_MAINTENANCE))
    return D.alerts(schedules, quiet, t.relation("job"), stuck(t), undelivered(t, quiet), TODAY)


@query(
    "next_schedule",
    with_relations(
        "schedule_book",
        """select feed_id, processing_type, schedule_id, next_poll from (select *, row_number() over (
          partition by feed_id, processing_type order by next_poll, schedule_id) as rn from schedule_book) where rn = 1""",
    ),
)
def next_schedule(t: Tables):
    return D.next_schedule(t.relation("schedule_book"))


@query(
    "expected_name",
    with_relations(
        "job feed",
        """select j.job_key, case when name_pattern like '%\\_YYMMDDHHMMSS' escape '\\'
            then replace(name_pattern, 'YYMMDDHHMMSS', strftime(start_ts, '%y%m%d') || 'HHMMSS')
          when name_pattern like '%\\_MMDDYY.HHMMSS' escape '\\'
            then replace(name_pattern, 'MMDDYY.HHMMSS', strftime(start_ts, '%m%d%y') || '.HHMMSS')
          else replace(name_pattern, 'MMDDYYHHMMSS', strftime(start_ts, '%m%d%y') || 'HHMMSS') end as expected
        from job j join feed f on j.feed_id = f.feed_id""",
    ),
)
def expected_name(t: Tables):
    jobs = t.relation("job").join(t.relation("feed").select("feed_id", "name_pattern"), "feed_id")
    return jobs.select("job_key", D.expected_name(F.col("name_pattern"), F.col("start_ts")).alias("expected"))
