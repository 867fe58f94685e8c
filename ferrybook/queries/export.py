"""Outbound export queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import export as X
from ferrybook.operators import outcomes as O
from ferrybook.plans.outbound import Export, Parties, header_value, routing_id
from ferrybook.queries.base import RECORD_SQL, Tables, registry, with_relations
from ferrybook.queries.rules import all_failures, with_top
from ferrybook.plans import outbound
from ferrybook.session import new_folder, settle, small_table
from ferrybook.sources.ledger import SentLedger
from ferrybook.sources.sinks import append_ledger, write_merged
from ferrybook.sources.text import read_merged

QUERIES, ORACLES, query = registry()


UPSTREAM, OWN_FEED, OUT_FEED, EXPORT_JOB = 2, 1, 4, 999_999_999_999
MOMENT = datetime(1999, 6, 15, 13, 5, 9)
PARTIES = Parties("HUB", "SENDER1", "P")
LENGTH = 200
BUSINESS = (
    "transmission_id", "category", "qualifier_1", "qualifier_2", "qualifier_3", "qualifier_4",
    "applied_1", "applied_2", "applied_3", "applied_4", "action",
)
DEFAULTS = {**{c: "00" for c in R.QUALIFIERS}, **{c: "0000" for c in R.APPLIED}}


def top_errors(t: Tables):
    return O.top_errors(all_failures(t), O.rule_meta(t.spark, R.ruled_columns()))


def sender(t: Tables):
    """One row: the sender the upstream feed is configured with."""
    return t.relation("feed").where("feed_id = 3").select("sender")


@query(
    "export_setting_asof",
    with_relations(
        "setting",
        "select * from setting where valid_from <= date '1997-05-20' and date '1997-05-20' <= valid_to",
    ),
)
def export_setting_asof(t: Tables):
    return X.settings_at(t.relation("setting"), date(1997, 5, 20))


@query(
    "export_precondition",
    with_relations(
        "record job feed",
        f"""select count(*) as files from job where feed_id in (select feed_id from feed where client_id = {UPSTREAM}
          and feed_type = 'INBOUND') and file_status = 'Available' and job_key > (select coalesce(max(r.out_job_key), 0)
          from record r join job j on r.out_job_key = j.job_key where j.feed_id = {OUT_FEED})""",
    ),
)
def export_precondition(t: Tables):
    jobs = t.relation("job")
    feeds = t.relation("feed").where(f"client_id = {UPSTREAM} and feed_type = 'INBOUND'").select("feed_id")
    wanted = jobs.where(F.col("file_status") == "Available").join(feeds, "feed_id", "left_semi")
    return X.precondition(wanted, X.last_export(t.record(), jobs, OUT_FEED))


OPEN = "out_job_key is null and file_type = 'DQ' and rtrim(response) = ''"
UP_JOBS = f"select job_key from job where client_id = {UPSTREAM} and status = 'Success' and file_status = 'Available' and not complete"
FOR_CLIENT = f"""select * from record where {OPEN} and sender = (select sender from feed where feed_id = 3)
  and rtrim(tag) in ('LOW') and action = '+' and job_key in ({UP_JOBS})"""


def for_client(t: Tables):
    return X.eligible_for_client(
        t.record(), t.relation("job"), UPSTREAM, sender(t), ["LOW"], F.col("action") == "+"
    )


@query(
    "export_eligible_client",
    with_relations("record job feed", f"select job_key, line_number, transmission_id from ({FOR_CLIENT})"),
)
def export_eligible_client(t: Tables):
    return for_client(t).select("job_key", "line_number", "transmission_id")


FOR_UPSTREAM = f"""select r.* from record r where {OPEN} and job_key in (select job_key from job where status = 'Success'
    and feed_id in (select feed_id from feed where feed_type = 'INBOUND' and client_id <> {UPSTREAM}))
  and not exists (select 1 from top where top.job_key = r.job_key and top.line_number = r.line_number and error_level = 1)"""


def for_upstream(t: Tables):
    blocked = O.level_one(all_failures(t, level=1), O.rule_meta(t.spark, R.ruled_columns()))
    return X.eligible_for_upstream(t.record(), t.relation("job"), t.relation("feed"), blocked, UPSTREAM)


@query(
    "export_eligible_upstream",
    with_top("line job feed", f"select job_key, line_number, transmission_id from ({FOR_UPSTREAM})"),
)
def export_eligible_upstream(t: Tables):
    return for_upstream(t).select("job_key", "line_number", "transmission_id")


def dedup_sql(source: str) -> str:
    return f"""select * from (select *, row_number() over (partition by {", ".join(BUSINESS)}
      order by service_date, job_key, line_number) as rn from ({source})) where rn = 1"""


@query(
    "export_dedup",
    with_relations(
        "record job feed", f"select job_key, line_number, transmission_id, service_date from ({dedup_sql(FOR_CLIENT)})"
    ),
)
def export_dedup(t: Tables):
    return X.first_per_business_key(for_client(t), BUSINESS, ["service_date"]).select(
        "job_key", "line_number", "transmission_id", "service_date"
    )


REJECTS = f"""select r.*, r.reject as reject_code from record r where out_job_key is null and sender = (select sender from feed where feed_id = 3)
    and file_type = 'DR' and response = 'R' and rtrim(tag) in ('LOW', 'MID') and job_key in (select job_key from job
      where client_id = {UPSTREAM} and status = 'Success' and file_status = 'Available')
  union select r.*, cast(top.error_code as varchar) from record r join top
    on top.job_key = r.job_key and top.line_number = r.line_number and error_level = 1
    where out_job_key is null and r.job_key in (select job_key from job where feed_id = {OWN_FEED})"""


@query(
    "export_rejects",
    with_top(
        "line job feed",
        f"""select job_key, line_number, 'DR' as file_type, 'R' as response, reject_code, transmission_id
        from ({dedup_sql(REJECTS)})""",
    ),
)
def export_rejects(t: Tables):
    found = X.rejects(t.record(), t.relation("job"), top_errors(t), UPSTREAM, OWN_FEED, sender(t), ["LOW", "MID"])
    return X.first_per_business_key(found, BUSINESS, ["service_date"]).select(
        "job_key", "line_number", "file_type", "response", "reject_code", "transmission_id"
    )


def defaulted(c: str) -> str:
    return f"case when length(trim({c})) > 0 then {c} else '{DEFAULTS[c]}' end"


@query(
    "export_defaults",
    with_relations("record", f"select job_key, line_number, {', '.join(f'{defaulted(c)} as {c}' for c in DEFAULTS)} from record"),
)
def export_defaults(t: Tables):
    return X.with_defaults(t.record(), DEFAULTS).select("job_key", "line_number", *DEFAULTS)


FIELDS = [
    (F.col, "record_type", 2), (F.col, "file_type", 2), (F.lit, "10", 2), (F.col, "transmission_id", 12), (F.col, "service_date", 8),
    (F.col, "transmission_time", 8), (F.col, "amount", 10), (F.col, "action", 1), (F.col, "tag", 4), (F.lit, "", 3),
    *[(F.col, c, R.RECORD[c].width) for c in DEFAULTS],
]


def fields():
    """Detail fields with their widths: record values, constants, and a blanked one."""
    return [(make(name), width) for make, name, width in FIELDS]


ROUTING = "HUB06151999130509"
PADDED = " || ".join(
    f"rpad({defaulted(name) if name in DEFAULTS else name if make is F.col else repr(name)}, {width}, ' ')"
    for make, name, width in FIELDS
)
USED = 40 + sum(w for *_, w in FIELDS)
DETAIL = f"rpad('{ROUTING}', 40, ' ') || {PADDED} || repeat(' ', {LENGTH - USED})"
SORT = "service_date || case when regexp_full_match(transmission_time, '[0-9]+') then transmission_time else '000000' end"


def exported(t: Tables) -> Export:
    chosen = X.first_per_business_key(for_client(t), BUSINESS, ["service_date"])
    return Export.of(X.with_defaults(chosen, DEFAULTS), PARTIES, MOMENT, LENGTH)


def details_sql(source: str) -> str:
    return f"select {SORT} as sort_key, job_key, line_number, {DETAIL} as value from ({dedup_sql(source)})"


@query("export_detail", with_relations("record job feed", details_sql(FOR_CLIENT)))
def export_detail(t: Tables):
    return exported(t).details(fields())


@query(
    "export_order",
    with_relations("record job feed", f"select sort_key, job_key, line_number from ({details_sql(FOR_CLIENT)}) order by 1, 2, 3"),
)
def export_order(t: Tables):
    rows = exported(t).details(fields()).select("sort_key", "job_key", "line_number")
    return rows.orderBy("sort_key", "job_key", "line_number")


HEADER_REST = "'T' || {day} || {clock} || rpad({sender}, 10, ' ') || rpad({receiver}, 10, ' ') || '0000001' || 'P' || '10'"


@query(
    "export_header",
    with_relations(
        "job feed",
        f"""select job_key, f.sender || strftime(end_ts, '%m%d%Y%H%M%S') as routing_id,
          rpad(f.sender || strftime(end_ts, '%m%d%Y%H%M%S'), 40, ' ') || 'HD' || {HEADER_REST.format(
              day="strftime(end_ts, '%Y%m%d')", clock="strftime(end_ts, '%I%M')", sender="f.sender", receiver="f.receiver")}
          || repeat(' ', {LENGTH - 85}) as value
        from job j join feed f on j.feed_id = f.feed_id""",
    ),
)
def export_header(t: Tables):
    """The header each job would have sent at its end."""
    jobs = t.relation("job").join(t.relation("feed").select("feed_id", "sender", "receiver"), "feed_id")
    routing = routing_id(F.col("sender"), F.col("end_ts"))
    value = header_value(routing, F.col("end_ts"), F.col("sender"), F.col("receiver"), PARTIES, LENGTH)
    return jobs.select("job_key", routing.alias("routing_id"), value.alias("value"))


TRAILER = f"""select rpad('{ROUTING}', 40, ' ') || 'TR' || '0000001' || lpad(cast(count(*) as varchar), 10, '0')
  || repeat(' ', {LENGTH - 59}) as value from"""


@query("export_trailer", with_relations("record job feed", f"{TRAILER} ({dedup_sql(FOR_CLIENT)})"))
def export_trailer(t: Tables):
    return exported(t).trailer()


@query(
    "export_mark_sent",
    with_relations(
        "record job feed",
        f"""select r.job_key, r.line_number, coalesce(case when e.job_key is not null then {EXPORT_JOB} end, r.out_job_key) as out_job_key
        from record r left join ({dedup_sql(FOR_CLIENT)}) e on r.job_key = e.job_key and r.line_number = e.line_number""",
    ),
)
def export_mark_sent(t: Tables):
    return X.marked_sent(t.record(), exported(t).exported, EXPORT_JOB).select("job_key", "line_number", "out_job_key")


FIRST_RUN = dedup_sql(FOR_CLIENT)
REST = f"""select r.* from ({FOR_CLIENT}) r where not exists (select 1 from ({FIRST_RUN}) e
  where e.job_key = r.job_key and e.line_number = r.line_number)"""


@query(
    "export_sent_ledger",
    with_relations(
        "record job feed",
        f"""select {EXPORT_JOB} as out_job_key, job_key, line_number from ({FIRST_RUN})
        union all select {EXPORT_JOB + 1}, job_key, line_number from ({dedup_sql(REST)})""",
    ),
)
def export_sent_ledger(t: Tables):
    """Two exports in a row through an append-only ledger; the second sends none of the first's records."""
    path, open_records = new_folder(t.spark, "sent"), for_client(t)
    for job in (EXPORT_JOB, EXPORT_JOB + 1):
        left = open_records if job == EXPORT_JOB else X.not_sent(open_records, ledger)
        chosen = X.first_per_business_key(left, BUSINESS, ["service_date"])
        ledger = append_ledger(X.sent_rows(chosen, job), path)
    return ledger.select("out_job_key", "job_key", "line_number")


@query(
    "export_empty_guard",
    with_relations(
        "record job feed",
        f"""select 'full' as run, section, n from (select 1 as section, cast(1 as bigint) as n union all select 3, 1
            union all select 2, count(*) from ({dedup_sql(FOR_CLIENT)}))
        union all select 'empty wanted', 1, 1 union all select 'empty wanted', 3, 1""",
    ),
)
def export_empty_guard(t: Tables):
    """Lines per section of a full run, and of empty runs with and without the wish for empty files."""
    full = exported(t)
    none = Export.of(full.exported.where("transmission_id = 'no such id'"), PARTIES, MOMENT, LENGTH)

    def run(name: str, export: Export, create_empty: bool):
        file = export.file(fields(), create_empty)
        return file.groupBy("section").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("run"), "section", "n")

    return run("full", full, False).unionByName(run("empty wanted", none, True)).unionByName(run("empty", none, False))


HEADER = f"rpad('{ROUTING}', 40, ' ') || 'HD' || {HEADER_REST}".format(
    day="'19990615'", clock="'0105'", sender="'HUB'", receiver="'SENDER1'"
)
FILE = f"""select 1 as section, cast(null as varchar) as sort_key, cast(null as bigint) as job_key, cast(null as bigint) as line_number,
    {HEADER} || repeat(' ', {LENGTH - 85}) as value
  union all select 2, sort_key, job_key, line_number, value from ({details_sql(FOR_UPSTREAM)})
  union all select 3, null, null, null, value from ({TRAILER} ({dedup_sql(FOR_UPSTREAM)}))"""


@query("export_file", with_top("line job feed", FILE))
def export_file(t: Tables):
    """Clean client records, once each, as a file for the upstream partner."""
    chosen = X.first_per_business_key(for_upstream(t), BUSINESS, ["service_date"])
    export = Export.of(X.with_defaults(chosen, DEFAULTS), PARTIES, MOMENT, LENGTH)
    return export.file(fields(), create_empty=True)


@query(
    "init_sent_flag",
    with_relations(
        "record job",
        f"""select job_key, line_number, case when job_key in (select job_key from job where client_id = {UPSTREAM}
          and file_status = 'Not Available') then out_job_key else coalesce(out_job_key, 0) end as out_job_key from record""",
    ),
)
def init_sent_flag(t: Tables):
    return X.initialised(t.record(), t.relation("job"), UPSTREAM).select("job_key", "line_number", "out_job_key")


@query(
    "outbound_run",
    with_top(
        "line job feed",
        f"""select 'first' as run, row_number() over (order by section, sort_key, job_key, line_number) as line_number, value from ({FILE})
        union all select 'second', 0, 'nothing newer'""",
    ),
)
def outbound_run(t: Tables):
    """A whole export, written and read back, and a second one that finds nothing new."""
    setting = X.settings_at(t.relation("setting"), date(1997, 5, 20))
    wanted = t.relation("job").where("file_status = 'Available' and file_type = 'INBOUND'").select("job_key")
    chosen = X.first_per_business_key(for_upstream(t), BUSINESS, ["service_date"])
    own = small_table(t.spark, [(EXPORT_JOB,), (EXPORT_JOB + 1,)], "job_key bigint")
    ledger = new_folder(t.spark, "ledger")
    given = (setting, wanted, ledger, chosen, DEFAULTS, PARTIES, MOMENT, LENGTH, fields())
    path, _ = outbound.run(*given, EXPORT_JOB, own)
    again, _ = outbound.run(*given, EXPORT_JOB + 1, own)
    first = read_merged(t.spark, path).select(F.lit("first").alias("run"), "line_number", "value")
    second = small_table(t.spark, [("second", 0, "nothing newer" if again is None else again)], "run string, line_number bigint, value string")
    return first.unionByName(second)


@query(
    "export_recovery",
    with_top(
        "line job feed",
        f"""select 'two' as run, row_number() over (order by section, sort_key, job_key, line_number) as line_number, value from ({FILE})
        union all select 'one', 0, 'dropped' union all select 'two', 0, 'committed' union all select 'three', 0, 'nothing newer'""",
    ),
)
def export_recovery(t: Tables):
    """An export that died before its file, one that died before its commit, and one after both: all is sent once."""
    setting = X.settings_at(t.relation("setting"), date(1997, 5, 20))
    wanted = t.relation("job").where("file_status = 'Available' and file_type = 'INBOUND'").select("job_key")
    chosen = settle(X.first_per_business_key(for_upstream(t), BUSINESS, ["service_date"]))
    own = small_table(t.spark, [(EXPORT_JOB + k,) for k in range(3)], "job_key bigint")
    ledger = SentLedger(t.spark, new_folder(t.spark, "ledger"))
    ledger.intend("one", X.sent_rows(chosen, EXPORT_JOB), 0)
    told = [("one", 0, ledger.recover()["one"])]
    exported = Export.of(X.with_defaults(chosen.join(ledger.taken("two"), list(X.KEY), "left_anti"), DEFAULTS), PARTIES, MOMENT, LENGTH)
    ledger.intend("two", X.sent_rows(exported.exported, EXPORT_JOB + 1), 0)
    write_merged(exported.file(fields(), create_empty=True), outbound.ORDER, ledger.file_of("two"))
    told.append(("two", 0, ledger.recover()["two"]))
    path, _ = outbound.run_export(
        ledger, "three", setting, wanted, chosen, DEFAULTS, PARTIES, MOMENT, LENGTH, fields(), EXPORT_JOB + 2, own
    )
    told.append(("three", 0, path or "nothing newer"))
    first = read_merged(t.spark, ledger.file_of("two")).select(F.lit("two").alias("run"), "line_number", "value")
    return first.unionByName(small_table(t.spark, told, "run string, line_number bigint, value string"))
