"""Reporting view queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import views as V
from ferrybook.operators.outcomes import rule_meta
from ferrybook.queries.base import RECORD_SQL, Tables, registry, with_relations
from ferrybook.queries.rules import ALL, DUPLICATES, FLAGS, duplicates, engine_sql, full_outcomes, q
from ferrybook.session import new_folder, small_table
from ferrybook.sources.tables import Table

QUERIES, ORACLES, query = registry()


# a standard text for every second code
STANDARD = {r.error_code: f"Standard text {r.error_code}" for c, r in ALL.values() if r.error_code % 2 == 0}
RULES_SQL = "(values " + ", ".join(
    f"({i}, {q(c.name)}, {r.error_code}, {r.error_level}, {q(STANDARD[r.error_code]) if r.error_code in STANDARD else 'null'})"
    for i, (c, r) in ALL.items()
) + ") as m(rule_id, column_name, error_code, error_level, standard_error_message)"


@query(
    "view_rule_report",
    f"""{with_relations("line", "").rstrip()}, record as ({RECORD_SQL}){FLAGS}, outcome as ({engine_sql()}),
      every as (select rule_id, validation_result, error_message, line_number from outcome
        union all select rule_id, validation_result, error_message, line_number from ({DUPLICATES}))
    select column_name, case validation_result when 'Y' then 'Passed' when 'N' then 'Failed' else '' end as validation_result,
      error_code, error_level, standard_error_message, count(*) as outcomes, cast(sum(length(error_message)) as bigint) as message_chars,
      cast(sum(line_number % 1000003) as bigint) as line_sum
    from every join {RULES_SQL} on every.rule_id = m.rule_id group by 1, 2, 3, 4, 5""",
)
def view_rule_report(t: Tables):
    """The report over all rules and lines, summed up per column, result and code."""
    outcomes = full_outcomes(t).unionByName(duplicates(t))
    meta = rule_meta(t.spark, R.ruled_columns())
    rules = meta.select("rule_id", "file_column_id", "error_code", "error_level")
    columns = meta.select("file_column_id", "column_name").distinct()
    codes = small_table(t.spark, sorted(STANDARD.items()), "error_code int, standard_error_message string")
    report = V.rule_report(outcomes, rules, columns, codes)
    return report.groupBy("column_name", "validation_result", "error_code", "error_level", "standard_error_message").agg(
        F.count(F.lit(1)).alias("outcomes"),
        F.sum(F.length("validation_result_error_message")).cast("bigint").alias("message_chars"),
        F.sum(F.col("line_number") % 1000003).cast("bigint").alias("line_sum"),
    )


def tagged_sql(tags: dict[str, str]) -> str:
    wrapped = ", ".join(f"{c}, '<{tag}>' || trim({c}) || '</{tag}>' as {c}_tagged" for c, tag in tags.items())
    return with_relations(
        "record job feed",
        f"""select r.job_key, r.line_number, j.feed_id, j.file_name, f.client_id, {wrapped} from record r
          left join job j on r.job_key = j.job_key left join feed f on j.feed_id = f.feed_id""",
    )


PERSON = {"transmission_id": "ID", "service_date": "DATE", "tag": "NAME", "amount": "AMOUNT"}
RECON = {"transmission_id": "ID", "submission": "NUMBER", "category": "TYPE"}


@query("view_tagged", tagged_sql(PERSON))
def view_tagged(t: Tables):
    return V.tagged(t.record(), PERSON, t.relation("job"), t.relation("feed"), ["job_key", "line_number"])


@query("view_recon_tagged", tagged_sql(RECON))
def view_recon_tagged(t: Tables):
    return V.tagged(t.record(), RECON, t.relation("job"), t.relation("feed"), ["job_key", "line_number"])


@query("view_refresh", tagged_sql(PERSON) + " where r.job_key % 8 <> 3")
def view_refresh(t: Tables):
    """The report kept as a table: after each change of the records only the parts with changed jobs are computed."""
    keys, bucket = ("job_key", "line_number"), "pmod(job_key, 8)"
    records, jobs, feeds = t.record().select("job_key", "line_number", *PERSON), t.relation("job"), t.relation("feed")
    build = lambda rows: V.tagged(rows, PERSON, jobs, feeds, list(keys))
    kinds = lambda df: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    held = Table(t.spark, new_folder(t.spark, "records"), kinds(records), keys, bucket)
    report = Table(t.spark, new_folder(t.spark, "report"), kinds(build(records)), keys, bucket)
    held.append("first", records.where("job_key % 4 <> 0"))
    report.refresh("first", held, build)
    held.append("second", records.where("job_key % 4 = 0"))
    held.delete("third", held.rows().where("job_key % 8 = 3").select(*keys))
    report.refresh("second", held, build)
    return report.rows()


# Eastern summer time until 2006: from the first Sunday of April (the missing hour counts as winter) to
# the last Sunday of October (the hour that comes twice counts as summer).
SUMMER = """{0} >= make_date(year({0}), 4, 1) + cast((7 - isodow(make_date(year({0}), 4, 1))) % 7 as int) + interval 3 hour
  and {0} < make_date(year({0}), 10, 31) - cast(isodow(make_date(year({0}), 10, 31)) % 7 as int) + interval 2 hour"""


@query(
    "restamp_utc",
    with_relations(
        "job",
        f"""select job_key, start_ts, end_ts,
          start_ts + case when {SUMMER.format("start_ts")} then interval 4 hour else interval 5 hour end as start_ts_utc,
          end_ts + case when {SUMMER.format("end_ts")} then interval 4 hour else interval 5 hour end as end_ts_utc from job""",
    ),
)
def restamp_utc(t: Tables):
    return V.restamped(t.relation("job").select("job_key", "start_ts", "end_ts"), ["start_ts", "end_ts"], "US/Eastern")
