"""Layout conversion queries."""

from __future__ import annotations

import json
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.operators import convert as C
from ferrybook.operators.sections import split_sections
from ferrybook.queries.base import Tables, registry, with_relations
from ferrybook.session import small_table

QUERIES, ORACLES, query = registry()


AS_OF = datetime(1998, 6, 15, 12, 0, 0)
FEED = 1
M = C.Mapping
# A layout for a customer list: segment first, then who, how much, since when.
MAPPINGS = [
    M(1, "Header", "REPLACE", 3, value="CUS"),
    M(2, "Header", "COPY_AS_IS", 2, source=(1, 2)),
    M(3, "Header", "CUSTOM", 10, source=(3, 10), formula="date_format", arguments=("yyyyMMdd", "dd.MM.yyyy")),
    M(4, "Header", "CUSTOM", 4, formula="batch_number", arguments=(4,)),
    M(5, "Header", "CUSTOM", 16, formula="run_stamp", arguments=("yyyy-MM-dd HH:mm", "UTC")),
    M(6, "Header", "CUSTOM", 3, source=(15, 18), formula="lookup", arguments=({"PROD": "LIV", "TEST": "TRY"}, "ANY")),
    M(21, "Detail", "COPY_AS_IS", 10, source=(72, 81)),
    M(22, "Detail", "CUSTOM", 14, formula="combine", arguments=((50, 50), (72, 81))),
    M(23, "Detail", "CUSTOM", 12, source=(3, 27), formula="id_limit", arguments=(12, "?")),
    M(24, "Detail", "CUSTOM", 9, source=(60, 71), formula="cap_amount", arguments=(5000000, 0, 9)),
    M(25, "Detail", "CUSTOM", 8, source=(51, 58), formula="earlier_date", arguments=("UTC",)),
    M(26, "Detail", "CUSTOM", 7, source=(50, 50), formula="lookup", arguments=({"U": "unknown"}, "known")),
    M(27, "Detail", "CUSTOM", 6, formula="line_number", arguments=(6,)),
    M(28, "Detail", "CUSTOM", 5, formula="header_slice", arguments=(0, 5)),
    M(29, "Detail", "REPLACE", 1, value=";"),
    M(30, "Detail", "FILL_WITH_THIS_VALUE", 3, value="-"),
    M(31, "Detail", "COPY_AS_IS", 1, source=(59, 59)),
    M(41, "Footer", "REPLACE", 3, value="END"),
    M(42, "Footer", "CUSTOM", 8, source=(3, 11), formula="count_minus", arguments=(1,)),
    M(43, "Footer", "CUSTOM", 4, formula="header_slice", arguments=(15, 19)),
    M(44, "Footer", "FILL_WITH_THIS_VALUE", 6, value="."),
]
BY_ID = {m.mapping_id: m for m in MAPPINGS}
TABLE = "mapping_id int, feed_id int, row_type string, kind string, width int, source string, value string, formula string, arguments string"


def mapping_table(t: Tables):
    """The mappings as the rows of a table."""
    rows = [
        (m.mapping_id, FEED, m.row_type, m.kind, m.width, ":".join(map(str, m.source)) if m.source else None, m.value, m.formula, json.dumps(m.arguments))
        for m in MAPPINGS
    ]
    return small_table(t.spark, rows, TABLE)


# The same in the checking dialect: ``h`` is the standard header, ``value`` the custom row.
ENDS = """, ends as (select *, max(line_number) over (partition by file_id) as hi from custom_file),
  head as (select file_id, 'CUS' || substring(value, 1, 2) || strftime(strptime(substring(value, 3, 8), '%Y%m%d'), '%d.%m.%Y')
      || case when file_id % 10 = 9 then '    ' else lpad(cast(file_id + 1 as varchar), 4, '0') end || '1998-06-15 12:00'
      || case substring(value, 15, 4) when 'PROD' then 'LIV' when 'TEST' then 'TRY' else 'ANY' end as h from ends where line_number = 1),
  detail as (select e.*, h from ends e join head using (file_id) where line_number > 1 and line_number < hi),
  footer as (select e.*, h from ends e join head using (file_id) where line_number = hi)"""
SEGMENT = "rpad(trim(substring(value, 72, 10)), 10, ' ')"
COMBINED = "rpad(substring(value, 50, 1) || trim(substring(value, 72, 10)), 14, ' ')"
ID = "rpad(case when length(trim(substring(value, 3, 25))) > 12 then repeat('?', 12) else trim(substring(value, 3, 25)) end, 12, ' ')"
AMOUNT = """case when not regexp_full_match(substring(value, 60, 12), '[0-9]+') then repeat(' ', 9)
  when cast(substring(value, 60, 12) as bigint) > 5000000 then repeat('0', 9)
  else lpad(cast(cast(substring(value, 60, 12) as bigint) as varchar), 9, '0') end"""
EARLIER = "least(substring(value, 51, 8), '19980615')"
GENDER = "case substring(value, 50, 1) when 'U' then 'unknown' else 'known  ' end"
DIGITS = "cast(line_number - 1 as varchar)"
NUMBER = f"case when length({DIGITS}) < 6 then lpad({DIGITS}, 6, '0') else {DIGITS} end"
DETAIL = f"{SEGMENT} || {COMBINED} || {ID} || {AMOUNT} || {EARLIER} || {GENDER} || {NUMBER} || substring(h, 1, 5) || ';---' || substring(value, 59, 1)"
COUNT = "rpad(cast(cast(substring(value, 3, 9) as bigint) - 1 as varchar), 8, ' ')"
FOOTER = f"'END' || {COUNT} || substring(h, 16, 4) || '......'"


def sql(body: str, relations: str = "custom_file") -> str:
    return f"{with_relations(relations, '').rstrip()}{ENDS}\n{body}"


def batches(t: Tables):
    """The batch number files are given; some have none."""
    rows = t.table("nation").selectExpr("cast(n_nationkey as int) as file_id", "n_nationkey + 1 as batch")
    return rows.where("file_id % 10 <> 9")


def parts(t: Tables):
    return (
        split_sections(t.relation("custom_file"), "file_id")
        .join(batches(t), "file_id", "left")
        .withColumn("number", F.col("line_number") - 1)
    )


def field(name: str, mapping_id: int, oracle: str, row_type: str = "detail"):
    """One mapped field over all rows of a kind."""

    def build(t: Tables):
        rows = parts(t).where(F.col("section") == row_type)
        return C.standard_rows(rows, [BY_ID[mapping_id]], BY_ID[mapping_id].row_type, AS_OF, ["file_id", "line_number"])

    query(name, sql(f"select file_id, line_number, {oracle} as value from {row_type}"))(build)


field("map_copy", 21, SEGMENT)
field("map_constant", 29, "';'")
field("map_fill", 30, "'---'")
field("map_lookup", 26, GENDER)
field("map_cap_amount", 24, AMOUNT)
field("map_id_limit", 23, ID)
field("map_earlier_date", 25, EARLIER)
field("map_combine", 22, COMBINED)


@query(
    "map_date_format",
    with_relations(
        "record",
        """select job_key, line_number, case when regexp_full_match(service_date, '[0-9]{8}') and try_strptime(service_date, '%Y%m%d') is not null
          then strftime(try_strptime(service_date, '%Y%m%d'), '%m/%d/%Y') end as value from record""",
    ),
)
def map_date_format(t: Tables):
    """Every record's date in another format; NULL where it is no date."""
    row = C.Row(F.col("service_date"), F.col("service_date"), F.lit(""), F.lit(0), F.lit(0), AS_OF)
    return t.record().select("job_key", "line_number", C.FORMULAS["date_format"](row, "yyyyMMdd", "MM/dd/yyyy").alias("value"))


@query("map_run_stamp", sql("select file_id, line_number, '1998-06-15 12:00' as value from detail"))
def map_run_stamp(t: Tables):
    rows = parts(t).where(F.col("section") == "detail")
    stamp = M(5, "Detail", "CUSTOM", 16, formula="run_stamp", arguments=("yyyy-MM-dd HH:mm", "UTC"))
    return C.standard_rows(rows, [stamp], "Detail", AS_OF, ["file_id", "line_number"])


@query(
    "map_header_ref",
    sql(f"""select file_id, line_number, {NUMBER} || substring(h, 1, 5) as value from detail
      union all select file_id, line_number, {COUNT} || substring(h, 16, 4) from footer"""),
)
def map_header_ref(t: Tables):
    """Fields that refer to the header row, the running number or the footer's count."""
    chosen = [BY_ID[i] for i in (27, 28, 42, 43)] + [m for m in MAPPINGS if m.row_type == "Header"]
    files = C.standard_files(t.relation("custom_file"), chosen, batches(t), AS_OF)
    return files.where(F.col("section") != "header").select("file_id", "line_number", "value")


@query("standard_row", sql(f"select file_id, line_number, {DETAIL} as value from detail"))
def standard_row(t: Tables):
    files = C.standard_files(t.relation("custom_file"), MAPPINGS, batches(t), AS_OF)
    return files.where(F.col("section") == "detail").select("file_id", "line_number", "value")


@query(
    "standard_row_errors",
    sql("select file_id, line_number, 24 as mapping_id from detail where not regexp_full_match(substring(value, 60, 12), '[0-9]+')"),
)
def standard_row_errors(t: Tables):
    """Fields of detail rows that could not be converted."""
    rows = parts(t).where(F.col("section") == "detail").withColumn("header", F.lit(""))
    return C.conversion_errors(rows, MAPPINGS, "Detail", AS_OF, ["file_id", "line_number"])


@query(
    "mapping_catalogue",
    with_relations("big_mapping", "select feed_id, mapping_id, row_type, kind, width, source, value, formula, arguments from big_mapping"),
)
def mapping_catalogue(t: Tables):
    """The mapping rows of all feeds, as they are compiled feed by feed."""
    return C.mapping_rows(t.relation("big_mapping"))


@query(
    "standard_file",
    sql(f"""select file_id, 'header' as section, cast(1 as bigint) as line_number, h as value from head
      union all select file_id, 'detail', line_number, {DETAIL} from detail
      union all select file_id, 'trailer', line_number, {FOOTER} from footer"""),
)
def standard_file(t: Tables):
    """Whole files, with the mapping read from its table."""
    mappings = C.compile_mappings(mapping_table(t), FEED)
    return C.standard_files(t.relation("custom_file"), mappings, batches(t), AS_OF)


BATCH_DAYS = [datetime(y, 6, 15, 23, 59, 59) for y in range(1992, 1999)]


@query(
    "batch_number",
    with_relations(
        "job feed",
        " union all ".join(
            f"""select date '{d:%Y-%m-%d}' as day, f.feed_id, coalesce(n, 0) + 1 as batch from feed f left join (
              select feed_id, count(*) as n from job where status = 'Success'
                and start_ts between timestamp '{d:%Y-%m-%d} 04:00:00' and timestamp '{d}' group by 1) c on f.feed_id = c.feed_id"""
            for d in BATCH_DAYS
        ),
    ),
)
def batch_number(t: Tables):
    """The next batch of every feed late on one day of each year."""
    per_day = [
        C.batch_numbers(t.relation("job"), t.relation("feed"), "America/New_York", d).select(F.lit(d.date()).alias("day"), "feed_id", "batch")
        for d in BATCH_DAYS
    ]
    return reduce(DataFrame.unionByName, per_day)
