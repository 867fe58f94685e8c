"""Scans, sinks and file structure checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrybook.fixtures import relations as R
from ferrybook.functions import messages as M
from ferrybook.operators import sections, structure
from ferrybook.operators.catalogue import Rule, RuledColumn
from ferrybook.operators.layout import encode, encode_record, parse
from ferrybook.queries.base import LOADED, SPEC, Tables, registry, with_relations
from ferrybook.session import new_folder, small_table
from ferrybook.sources import sinks, text
from ferrybook.sources.tables import Table

QUERIES, ORACLES, query = registry()


@query(
    "scan_lines",
    with_relations(
        "line",
        """select substring(value, 3, 2) as file_type, count(*) as lines, cast(0 as bigint) as misnumbered,
          cast(sum(length(value)) as bigint) as characters from line group by 1""",
    ),
)
def scan_lines(t: Tables):
    """Writes the lines as text, each with its place in its file, and reads them back numbered."""
    path = new_folder(t.spark, "scan")
    place = (F.monotonically_increasing_id() % F.lit(2**33) + 1).cast("string")
    t.relation("line").select(F.concat_ws("|", place, "value").alias("value")).write.text(path)
    read = text.read_lines(t.spark, path).select(
        "line_number", F.split_part("value", F.lit("|"), F.lit(1)).alias("place"),
        F.split_part("value", F.lit("|"), F.lit(2)).alias("value"),
    )
    return read.groupBy(F.substring("value", 3, 2).alias("file_type")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(F.col("line_number") != F.col("place").cast("bigint"), 1).otherwise(0)).cast("bigint").alias("misnumbered"),
        F.sum(F.length("value")).cast("bigint").alias("characters"),
    )


@query("fixed_width_parse", with_relations("line", f"select job_key, line_number, {R.record_columns()} from line"))
def fixed_width_parse(t: Tables):
    return parse(t.relation("line"), R.RECORD)


@query(
    "split_sections",
    with_relations(
        "file",
        """select job_key, line_number, case when line_number = 1 then 'header' when line_number = hi then 'trailer'
          else 'detail' end as section
        from (select *, max(line_number) over (partition by job_key) as hi, count(*) over (partition by job_key) as n
              from file) where n > 2""",
    ),
)
def split_sections(t: Tables):
    return sections.split_sections(t.relation("file")).select("job_key", "line_number", "section")


SUBSET = T.StructType([T.StructField("job_key", T.LongType()), T.StructField("amount", T.StringType())])
TARGET = T.StructType(
    [
        T.StructField("job_key", T.LongType()),
        T.StructField("currency", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("note", T.StringType()),
    ]
)


@query(
    "delimited_load",
    with_relations("record", "select job_key, line_number, transmission_id, amount, service_date from record"),
)
def delimited_load(t: Tables):
    """Pipe-delimited write, and bulk load of all columns."""
    path = new_folder(t.spark, "delimited")
    out = t.record().select("job_key", "line_number", "transmission_id", "amount", "service_date")
    sinks.write_delimited(out, path)
    return text.read_delimited(t.spark, path, out.schema)


@query(
    "subset_load_defaults",
    with_relations(
        "record", "select job_key, 'USD' as currency, amount, cast(null as varchar) as note from record"
    ),
)
def subset_load_defaults(t: Tables):
    path = new_folder(t.spark, "subset")
    sinks.write_delimited(t.record().select("job_key", "amount"), path)
    return text.read_subset(t.spark, path, SUBSET, TARGET, {"currency": "USD"})


ROUTED = """
select j.job_key, j.file_name, f.feed_id, f.feed_type, f.is_active from job j left join feed f
  on length(file_name) - length(replace(file_name, '_', '')) > 2
  and contains(f.name_pattern, array_to_string(string_split(file_name, '_')[1:3], '_') || '_')"""


@query("feed_routing", with_relations("job feed", f"select job_key, file_name, feed_id from ({ROUTED})"))
def feed_routing(t: Tables):
    jobs = t.relation("job").select("job_key", "file_name")
    return text.route_by_name(jobs, t.relation("feed")).select("job_key", "file_name", "feed_id")


@query(
    "arrival_route",
    with_relations(
        "job feed",
        f"""select job_key, file_name, case when feed_id is null then 'unknown' when feed_type <> 'INBOUND'
          then 'not inbound' when not is_active then 'inactive' else 'process' end as route from ({ROUTED})""",
    ),
)
def arrival_route(t: Tables):
    jobs = t.relation("job").select("job_key", "file_name")
    routed = text.with_route(text.route_by_name(jobs, t.relation("feed")))
    return routed.select("job_key", "file_name", "route")


@query(
    "file_record_count",
    with_relations(
        "file",
        """select job_key, count(*) - 2 as by_lines,
          coalesce(try_cast(substring(arg_max(value, line_number), 13, 10) as bigint), 0) as by_trailer
        from file group by job_key""",
    ),
)
def file_record_count(t: Tables):
    return sections.record_counts(t.relation("file"), *SPEC.trailer_count)


@query(
    "fixed_width_encode",
    with_relations(
        "record",
        """select job_key, line_number, rpad('R' || cast(job_key as varchar), 20, ' ') || record_type || rpad(amount, 12, ' ')
          || rpad(tag, 4, ' ') || rpad(coalesce(cast(out_job_key as varchar), ''), 10, ' ') as line,
          job_key is not null as round_trip from record""",
    ),
)
def fixed_width_encode(t: Tables):
    outbound = encode(
        [(F.concat(F.lit("R"), F.col("job_key").cast("string")), 20), (F.col("record_type"), 2),
         (F.col("amount"), 12), (F.col("tag"), 4), (F.col("out_job_key"), 10)]
    )
    lines = t.relation("line")
    parsed = parse(lines, R.RECORD, ("job_key", "line_number", "value")).selectExpr("*", *LOADED)
    return parsed.select(
        "job_key", "line_number", outbound.alias("line"), (encode_record(R.RECORD) == F.col("value")).alias("round_trip")
    )


@query(
    "merge_sections",
    with_relations(
        "line",
        """select row_number() over (order by section, job_key, line_number) as line_number, value from (
          select 1 as section, cast(null as bigint) as job_key, cast(null as bigint) as line_number, rpad('HD0000001', 133, ' ') as value
          union all select 2, job_key, line_number, value from line
          union all select 3, null, null, rpad('TR0000001' || lpad(cast(count(*) as varchar), 10, '0'), 133, ' ') from line)""",
    ),
)
def merge_sections(t: Tables):
    """All lines between a header and a trailer, written in file order and read back numbered."""
    detail = t.relation("line")
    count = detail.agg(F.lpad(F.count(F.lit(1)).cast("string"), 10, "0").alias("n"))
    header = t.spark.range(1).select(encode([(F.lit("HD0000001"), R.LINE_LENGTH)]).alias("value"))
    trailer = count.select(encode([(F.concat(F.lit("TR0000001"), "n"), R.LINE_LENGTH)]).alias("value"))
    path, order = new_folder(t.spark, "merged"), ["job_key", "line_number"]
    sinks.write_merged(sinks.merge_sections(header, detail, trailer, order), order, path)
    return text.read_merged(t.spark, path)


@query(
    "delete_by_value",
    with_relations("record", "select job_key, line_number, tag from record where tag <> 'HIGH  '"),
)
def delete_by_value(t: Tables):
    return sinks.without_value(t.record().select("job_key", "line_number", "tag"), "tag", "HIGH  ")


@query(
    "purge_by_parent",
    with_relations(
        "line job",
        """select job_key, line_number from line where job_key not in
          (select job_key from job where upper(file_name) like '%FEED3%')""",
    ),
)
def purge_by_parent(t: Tables):
    parents = t.relation("job").where(F.upper("file_name").like("%FEED3%"))
    return sinks.without_children(t.relation("line").select("job_key", "line_number"), parents, "job_key")


SENT, LATE = 900, 901  # jobs that mark records as sent


@query(
    "reload_job",
    with_relations(
        "record job",
        f"""select job_key, line_number, case when job_key % 5 = 0 then 'AGAIN' else tag end as tag,
          case when job_key % 7 = 0 then {LATE} when job_key % 5 <> 0 and job_key % 3 = 0 then coalesce(out_job_key, {SENT})
            else out_job_key end as out_job_key
        from record where job_key % 5 = 0 or tag <> 'HIGH  ' and job_key not in
          (select job_key from job where upper(file_name) like '%FEED3%')""",
    ),
)
def reload_job(t: Tables):
    """A stored record table: rows deleted by value and by parent, marked as sent, jobs reloaded, parts rewritten."""
    records = t.record().select("job_key", "line_number", "tag", "out_job_key")
    keys, again = ("job_key", "line_number"), F.col("job_key") % 5 == 0
    schema = "job_key bigint, line_number bigint, tag string, out_job_key bigint"
    held = Table(t.spark, new_folder(t.spark, "records"), schema, keys, "pmod(job_key, 16)", ["out_job_key"])
    held.append("load", records)
    held.delete("by value", held.rows().where("tag = 'HIGH  '").select(*keys))
    parents = t.relation("job").where(F.upper("file_name").like("%FEED3%"))
    held.delete("by parent", held.rows().join(parents.select("job_key"), "job_key", "left_semi").select(*keys))
    unsent = held.rows().where("job_key % 3 = 0 and out_job_key is null")
    held.update("sent", unsent.select(*keys, F.lit(SENT).alias("out_job_key")))
    held.reload("again", records.where(again).withColumn("tag", F.lit("AGAIN")), held.rows().where(again).select(*keys))
    held.compact("tidy")
    for _ in range(2):  # a repeated run changes nothing
        held.update("late", held.rows().where("job_key % 7 = 0").select(*keys, F.lit(LATE).alias("out_job_key")))
    return held.rows()


@query(
    "dup_file",
    with_relations(
        "job",
        """select job_key, 'inbound/txt/' || file_name as path from job where file_name in
          (select file_name from job where job_key % 7 = 0)""",
    ),
)
def dup_file(t: Tables):
    jobs = t.relation("job")
    arrivals = jobs.select("job_key", F.concat(F.lit("inbound/txt/"), "file_name").alias("path"))
    archive = jobs.where("job_key % 7 = 0").select(F.concat(F.lit("archive/2020/"), "file_name").alias("path"))
    return structure.already_processed(arrivals, archive)


def line_check(name: str, error: str, oracle_where: str, oracle_message: str):
    query(
        name,
        with_relations(
            "file", f"select job_key, line_number, {oracle_message} as message from file where {oracle_where}"
        ),
    )(lambda t: structure.check_lines(t.relation("file"), SPEC, error))


NUMBERED = "'Line Number : ' || cast(line_number as varchar) || "
line_check(
    "struct_length", structure.length_error(SPEC), "length(value) <> 133",
    NUMBERED + """' , Expecting line of a  133 character long. However, it is only ' || cast(length(value) as varchar)
      || ' character long '""",
)
line_check(
    "struct_header", structure.header_error(SPEC), "line_number = 1 and substring(value, 1, 2) <> 'HD'",
    NUMBERED + "' , Header identifier is missing '",
)
line_check(
    "struct_party", structure.party_error(SPEC),
    """line_number = 1 and substring(value, 1, 2) = 'HD'
      and (trim(substring(value, 13, 10)) <> 'SENDER' or trim(substring(value, 23, 10)) <> 'HUB')""",
    NUMBERED + """case when trim(substring(value, 13, 10)) <> 'SENDER'
      then ',  Sender ID ' || trim(substring(value, 13, 10)) || ' does not match with system expected value of SENDER '
      else ',  Receiver ID ' || trim(substring(value, 23, 10)) || ' does not match with system expected value of HUB' end""",
)
line_check(
    "struct_second_header", structure.second_header_error(SPEC),
    "line_number > 1 and substring(value, 1, 2) = 'HD'", NUMBERED + "' , Header found in the detail records '",
)

DETAIL_RULES = [
    RuledColumn(2, "Message Kind", 2, 4, False, (Rule(900, 1, "EQUALTO", "DQ", error_code=161, error_level=1),)),
    RuledColumn(6, "Transmission ID", 16, 26, False, (Rule(901, 1, "REQUIRED", "an id", error_code=162, error_level=2),)),
]
DETAIL_MESSAGE = """case when trim(substring(value, 3, 2)) <> 'DQ' then ' Line Number : ' || cast(line_number as varchar)
    || ' , Column : Message Kind  at position 3:4 has the value ' || trim(substring(value, 3, 2))
    || ', expected value must be DQ Error Code : 161, Error Level : 1'
  when trim(substring(value, 17, 10)) = '' then 'Line Number : ' || cast(line_number as varchar)
    || ' , Column : Transmission ID  at position 17:26 can not be empty. Expected Value must be  an id.'
    || ' Error Code : 162, Error Level : 2' end"""
line_check(
    "struct_detail_rules", structure.detail_error(DETAIL_RULES),
    "line_number > 1 and substring(value, 1, 2) not in ('HD', 'TR')"
    " and (trim(substring(value, 3, 2)) <> 'DQ' or trim(substring(value, 17, 10)) = '')",
    DETAIL_MESSAGE,
)

TRAILERS = """trailers as (select job_key, min(line_number) as at_line from file
    where line_number > 1 and substring(value, 1, 2) = 'TR' group by job_key),
  first_trailer as (select f.job_key, at_line, value from file f join trailers t
    on f.job_key = t.job_key and f.line_number = t.at_line),
  behind as (select f.job_key, min(line_number) as line_number, arg_min(value, line_number) as value
    from file f join trailers t on f.job_key = t.job_key where line_number > at_line group by f.job_key),
  counts as (select job_key, count(*) as lines,
      count(*) filter (where line_number > 1 and substring(value, 1, 2) not in ('HD', 'TR')) as details from file group by job_key),
  heads as (select job_key, value from file where line_number = 1 and substring(value, 1, 2) = 'HD')"""


def with_trailers(body: str) -> str:
    base = with_relations("file", "")
    return f"{base.rstrip()}, {TRAILERS}\n{body}"


def file_check(name: str, error: str, oracle: str):
    query(name, with_trailers(oracle))(lambda t: structure.check_files(t.relation("file"), SPEC, error))


DIGITS_SQL = """'Line Number : ' || cast(at_line as varchar) || ' (Trailer), Trailer Record Count Value is :'
    || substring(value, 13, 10) || ' and it is not a valid number'"""
SECOND_SQL = "'Line Number : ' || cast(line_number as varchar) || '  ( Trailer),  Another trailer found '"
AFTER_SQL = "'Line Number : ' || cast(line_number as varchar) || ' , a detail record was found after a trailer'"
COUNT_SQL = """'Line Number :' || cast(lines as varchar) || '  ( Trailer),  Total ' || cast(details as varchar)
    || ' records found, which does not match with Total : '
    || cast(try_cast(substring(t.value, 13, 10) as bigint) as varchar) || '  specified in the trailer'"""
BATCH_SQL = """'Line Number : ' || cast(lines + 1 as varchar) || '  ( Trailer),  Batch Identifier does not match,  Header Value : '
    || substring(h.value, 3, 10) || ' , Trailer Value : ' || substring(t.value, 3, 10)"""
file_check(
    "struct_trailer_digits", structure.DIGITS_ERROR,
    f"select job_key, {DIGITS_SQL} as message from first_trailer where not regexp_full_match(substring(value, 13, 10), '[0-9]+')",
)
file_check(
    "struct_second_trailer", structure.SECOND_TRAILER_ERROR,
    f"select job_key, {SECOND_SQL} as message from behind where substring(value, 1, 2) = 'TR'",
)
file_check(
    "struct_detail_after", structure.DETAIL_AFTER_ERROR,
    f"select job_key, {AFTER_SQL} as message from behind where substring(value, 1, 2) <> 'TR'",
)
file_check(
    "struct_count_match", structure.COUNT_ERROR,
    f"""select job_key, {COUNT_SQL} as message from first_trailer t join counts using (job_key)
      where regexp_full_match(substring(t.value, 13, 10), '[0-9]+') and cast(substring(t.value, 13, 10) as bigint) <> details""",
)
file_check(
    "struct_batch_match", structure.BATCH_ERROR,
    f"""select job_key, {BATCH_SQL} as message from first_trailer t join heads h using (job_key) join counts using (job_key)
      where substring(h.value, 3, 10) <> substring(t.value, 3, 10)""",
)
file_check(
    "struct_no_trailer", structure.NO_TRAILER_ERROR,
    """select job_key, ' No trailer was found' as message from counts where job_key not in (select job_key from trailers)""",
)


@query(
    "structure_verdict",
    with_trailers(
        f""", line_errors as (
          select job_key, line_number, case
            when length(value) <> 133 then {NUMBERED}' , Expecting line of a  133 character long. However, it is only '
              || cast(length(value) as varchar) || ' character long '
            when line_number = 1 and substring(value, 1, 2) <> 'HD' then {NUMBERED}' , Header identifier is missing '
            when line_number = 1 and trim(substring(value, 13, 10)) <> 'SENDER' then {NUMBERED}',  Sender ID '
              || trim(substring(value, 13, 10)) || ' does not match with system expected value of SENDER '
            when line_number = 1 and trim(substring(value, 23, 10)) <> 'HUB' then {NUMBERED}',  Receiver ID '
              || trim(substring(value, 23, 10)) || ' does not match with system expected value of HUB'
            when line_number > 1 and substring(value, 1, 2) = 'HD' then {NUMBERED}' , Header found in the detail records '
            end as message from file
          union all select job_key, at_line, {DIGITS_SQL} from first_trailer
            where not regexp_full_match(substring(value, 13, 10), '[0-9]+')
          union all select job_key, line_number, case when substring(value, 1, 2) = 'TR' then {SECOND_SQL} else {AFTER_SQL} end
            from behind),
        first_errors as (select job_key, arg_min(message, line_number) as message from line_errors
          where message is not null group by job_key),
        found as (select c.job_key, lines, h.value as head, coalesce(e.message,
            case when t.value is null then ' No trailer was found' end,
            case when try_cast(substring(t.value, 13, 10) as bigint) <> details then {COUNT_SQL} end,
            case when substring(h.value, 3, 10) <> substring(t.value, 3, 10) then {BATCH_SQL} end) as message
          from counts c left join first_errors e using (job_key) left join first_trailer t using (job_key)
            left join heads h using (job_key))
        select job_key, case when message is null then 'Success' else 'Fail' end as status,
          coalesce(message, '') as error_message, case when message is null then lines - 2 else 0 end as record_count,
          coalesce(trim(substring(head, 13, 10)), '') as sender, coalesce(trim(substring(head, 23, 10)), '') as receiver
        from found""".replace(", line_errors", "line_errors", 1)
    ).replace("\nline_errors", ",\nline_errors", 1),
)
def structure_verdict(t: Tables):
    return structure.verdict(t.relation("file"), SPEC)


@query(
    "flag_hold",
    with_relations(
        "file feed job",
        """select c.job_key, j.feed_id, case when not check_structure then 'structure'
            else 'details' end as flag, 'Incomplete' as status, lines - 2 as record_count
        from (select job_key, count(*) as lines from file group by job_key) c join job j using (job_key)
          join feed f on j.feed_id = f.feed_id where not (check_structure and check_details)""",
    ),
)
def flag_hold(t: Tables):
    counts = t.relation("file").groupBy("job_key").agg(F.count(F.lit(1)).alias("lines"))
    files = counts.join(t.relation("job").select("job_key", "feed_id"), "job_key")
    return structure.flag_hold(files, t.relation("feed"))


FIELD_CONFIG = {
    "file_type": {"position": [2, 4], "required": True, "range": ["dq", "dr"]},
    "transmission_id": {"position": [16, 26], "required": True},
    "category": {"position": [59, 61], "range": ["", "01"]},
    "service_date": {"position": [8, 16], "required": True, "format": "$date"},
}


def _finding(field: str, condition: str, text: str) -> str:
    return f"select job_key, line_number, '{field}' as field, {text} as message from line where {condition}"


@query(
    "config_validate_all",
    with_relations(
        "line file",
        " union all ".join(
            [
                _finding("file_type", "trim(substring(value, 3, 2)) = ''", "'Field file_type is required but does not have a value'"),
                _finding("file_type", "lower(trim(substring(value, 3, 2))) not in ('dq', 'dr')",
                         "'Expected file_type''s value, ' || substring(value, 3, 2) || ', to be in range: [''dq'', ''dr'']'"),
                _finding("transmission_id", "trim(substring(value, 17, 10)) = ''",
                         "'Field transmission_id is required but does not have a value'"),
                _finding("category", "lower(trim(substring(value, 60, 2))) not in ('', '01')",
                         "'Expected category''s value, ' || substring(value, 60, 2) || ', to be in range: ['''', ''01'']'"),
                _finding("service_date", "try_strptime(substring(value, 9, 8), '%Y%m%d') is null",
                         "'Field service_date does not contain a valid date (' || substring(value, 9, 8) || ')'"),
            ]
        )
        + """ union all select job_key, null, null, unnest(list_filter([
            case when substring(arg_min(value, line_number), 1, 2) <> 'HD' then 'first line is no header' end,
            case when substring(arg_max(value, line_number), 1, 2) <> 'TR' then 'last line is no trailer' end,
            case when count(*) filter (where line_number > 1 and line_number < hi and substring(value, 1, 2) <> 'DT') > 0
              then 'line between is no detail' end], lambda x: x is not null))
          from (select *, max(line_number) over (partition by job_key) as hi from file) group by job_key""",
    ),
)
def config_validate_all(t: Tables):
    """Every finding of the light checks: of fields on all lines, and of whole files."""
    fields = structure.field_findings(t.relation("line"), FIELD_CONFIG)
    files = structure.file_findings(t.relation("file"), SPEC, "DT").select(
        "job_key", F.lit(None).cast("bigint").alias("line_number"), F.lit(None).cast("string").alias("field"),
        F.col("check_name").alias("message"),
    )
    return fields.unionByName(files)


EMPTY = 1_000_000_000_000


@query(
    "empty_file_verdict",
    f"""select job_key, status, error_message, record_count from ({ORACLES["structure_verdict"]})
    union all select o_orderkey + {EMPTY}, 'Fail', '{M.NO_TRAILER.replace("'", "''")}', 0 from orders where o_orderkey % 50 = 0""",
)
def empty_file_verdict(t: Tables):
    """Verdicts of a listing in which some files have no line at all."""
    listed = t.relation("job").select("job_key")
    empty = listed.where("job_key % 50 = 0").select((F.col("job_key") + EMPTY).alias("job_key"))
    found = structure.verdict(t.relation("file"), SPEC, listing=listed.unionByName(empty))
    return found.select("job_key", "status", "error_message", "record_count")


@query("verdict_from_spec_file", ORACLES["structure_verdict"])
def verdict_from_spec_file(t: Tables):
    """Verdicts of all files, with the positions read from a partner's one-row file."""
    spans = {
        "HEADER": SPEC.header_at, "TRAILER": SPEC.trailer_at, "HEADER_BATCH_ID": SPEC.header_batch,
        "TRAILER_BATCH_ID": SPEC.trailer_batch, "TRAILER_RECORD_COUNT": SPEC.trailer_count,
        "SENDER_ID": SPEC.sender_at, "RECEIVER_ID": SPEC.receiver_at,
    }
    row = {f"{k}_POS_{end}": str(v) for k, at in spans.items() for end, v in zip(("START", "END"), at)}
    row |= {
        "HEADER_IDENTIFIER": SPEC.header_id, "TRAILER_IDENTIFIER": SPEC.trailer_id,
        "SENDER_ID_VALUE": SPEC.sender, "RECEIVER_ID_VALUE": SPEC.receiver,
    }
    path = new_folder(t.spark, "spec")
    small_table(t.spark, [tuple(row.values())], ", ".join(f"{c} string" for c in row)).write.option("header", True).csv(path)
    spec = structure.StructureSpec.from_row(text.read_spec(t.spark, path), R.LINE_LENGTH)
    return structure.verdict(t.relation("file"), spec)
