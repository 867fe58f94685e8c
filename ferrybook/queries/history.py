"""History crosswalk queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrybook.functions.text import overpunch_encode
from ferrybook.operators import history as H
from ferrybook.operators.layout import encode
from ferrybook.queries.base import Tables, registry, with_relations
from ferrybook.sources.sinks import merge_sections

QUERIES, ORACLES, query = registry()


AMOUNT = """(case when instr('{ABCDEFGHI', right(adj_amt, 1)) > 0 then 1 else -1 end) * cast(substring(adj_amt, 1, 11)
  || translate(right(adj_amt, 1), '{ABCDEFGHI}JKLMNOPQR', '01234567890123456789') as bigint)"""
DECODED = f", dec as (select *, {AMOUNT} as int_amount, right(adj_amt, 7) as adj_amount_revised from history)"
NEWEST = """, newest as (select carrier, account, group_id, new_carrier, new_account, new_group from (
    select *, row_number() over (partition by carrier, account, group_id order by term_date desc, version desc) as rn
    from crosswalk) where rn = 1)"""
PARTS = """, parts as (select d.*, p.part, case when int_amount < 0 then -1 else 1 end *
    least(abs(int_amount) - (p.part - 1) * 9999999, 9999999) as part_amount
  from dec d, lateral (select unnest(generate_series(1, greatest(1, cast(ceil(abs(int_amount) / 9999999.0) as bigint)))) as part) p)"""


def punch(e: str) -> str:
    digits = f"lpad(cast(abs({e}) as varchar), 7, '0')"
    return (
        f"substring({digits}, 1, 6) || case when {e} >= 0 then translate(right({digits}, 1), '0123456789', '{{ABCDEFGHI')"
        f" else translate(right({digits}, 1), '0123456789', '}}JKLMNOPQR') end"
    )


def sql(relations: str, ctes: str, body: str) -> str:
    return f"{with_relations(relations, '').rstrip()}{ctes}\n{body}"


KEYS = ["carrier", "account", "group_id"]


@query("overpunch_decode", sql("history", DECODED, "select line_number, adj_amt, int_amount, adj_amount_revised from dec"))
def overpunch_decode(t: Tables):
    return H.decoded(t.relation("history")).select("line_number", "adj_amt", "int_amount", "adj_amount_revised")


@query(
    "overpunch_encode",
    sql("record", "", f"select job_key, line_number, {punch('amount_cents')} as punched from (select *,"
        " case when action = '-' then -1 else 1 end * cast(substring(amount, 2, 9) as bigint) % 10000000 as amount_cents from record)"),
)
def encode_amounts(t: Tables):
    signed = F.when(F.col("action") == "-", -1).otherwise(1) * F.substring("amount", 2, 9).cast("bigint") % 10_000_000
    return t.record().select("job_key", "line_number", overpunch_encode(signed).alias("punched"))


@query(
    "crosswalk_latest",
    sql("history crosswalk", NEWEST, "select line_number, carrier, new_carrier, new_account, new_group"
        " from history left join newest using (carrier, account, group_id)"),
)
def crosswalk_latest(t: Tables):
    joined = H.with_new_ids(t.relation("history"), t.relation("crosswalk"), KEYS, "term_date", "version")
    return joined.select("line_number", "carrier", "new_carrier", "new_account", "new_group")


@query(
    "amount_split",
    sql("history", DECODED + PARTS, f"select line_number, cast(part as integer) as part, part_amount, {punch('part_amount')} as punched"
        " from parts where int_amount not between -9999999 and 9999999"),
)
def amount_split(t: Tables):
    large = H.decoded(t.relation("history")).where(H.too_large(F.col("int_amount")))
    return H.split_amounts(large).select(
        "line_number", "part", "part_amount", overpunch_encode(F.col("part_amount")).alias("punched")
    )


LINE = f"""'4' || rpad(member_id, 18, ' ') || rpad(coalesce(new_carrier, ''), 9, ' ') || rpad(coalesce(new_account, ''), 15, ' ')
  || rpad(coalesce(new_group, ''), 15, ' ') || 'A' || case when int_amount between -9999999 and 9999999 then adj_amount_revised
  else {punch("part_amount")} end || rpad(accum_code, 10, ' ') || rpad(adjusted, 7, ' ') || repeat(' ', 217)"""
UNION = f"""select line_number, cast(part as integer) as part, {LINE} as value
  from parts left join newest using (carrier, account, group_id)"""


def history_lines(t: Tables):
    joined = H.with_new_ids(H.decoded(t.relation("history")), t.relation("crosswalk"), KEYS, "term_date", "version")
    return H.detail_lines(joined)


@query("history_union", sql("history crosswalk", DECODED + NEWEST + PARTS, UNION))
def history_union(t: Tables):
    return history_lines(t)


CARRIER = "C00000001"
TRAILER = f"select '9' || '{CARRIER}' || lpad(cast(count(*) as varchar), 9, '0') || repeat(' ', 281) as value from parts"


@query("history_trailer", sql("history", DECODED + PARTS, TRAILER))
def history_trailer(t: Tables):
    return H.trailer_line(H.split_amounts(H.decoded(t.relation("history"))), CARRIER)


@query(
    "history_file",
    sql(
        "history crosswalk", DECODED + NEWEST + PARTS,
        f"""select 1 as section, cast(null as bigint) as line_number, cast(null as integer) as part, rpad('0{CARRIER}', 300, ' ') as value
        union all select 2, line_number, part, value from ({UNION})
        union all select 3, null, null, value from ({TRAILER})""",
    ),
)
def history_file(t: Tables):
    """Header, all detail lines and the trailer; the carrier id is cut from the header line."""
    header_text = "0" + CARRIER
    header = t.spark.range(1).select(encode([(F.lit(header_text), 300)]).alias("value"))
    lines = history_lines(t)
    parts = H.split_amounts(H.decoded(t.relation("history")))
    return merge_sections(header, lines, H.trailer_line(parts, header_text[1:10]), ["line_number", "part"])
