"""The derived relations: lines, files, jobs, feeds, histories, schedules and so on."""

from __future__ import annotations

from datetime import date

from ferrybook.fixtures.dialect import Dialect
from ferrybook.functions.text import NARROW
from ferrybook.operators.catalogue import Rule, RuledColumn
from ferrybook.operators.layout import Layout
from ferrybook.operators.rules import RuleSet

SLOTS = range(1, 13)
SLOT_START = 61
SLOT_WIDTH = 6
STRIP_SLOTS = 300

RECORD = Layout.of(
    "record",
    ("record_type", 0, 2),
    ("file_type", 2, 4),
    ("response", 4, 5),
    ("reject", 5, 8),
    ("service_date", 8, 16),
    ("transmission_id", 16, 26),
    ("quantity", 26, 28),
    ("amount", 28, 38),
    ("action", 38, 39),
    ("tag", 39, 45),
    ("transmission_time", 45, 53),
    ("submission", 53, 57),
    ("slot_count", 57, 59),
    ("category", 59, 61),
    *[
        f
        for i in SLOTS
        for f in (
            (f"qualifier_{i}", SLOT_START + SLOT_WIDTH * (i - 1), SLOT_START + SLOT_WIDTH * (i - 1) + 2),
            (f"applied_{i}", SLOT_START + SLOT_WIDTH * (i - 1) + 2, SLOT_START + SLOT_WIDTH * i),
        )
    ],
)
LINE_LENGTH = RECORD.length  # 133
QUALIFIERS = tuple(f"qualifier_{i}" for i in SLOTS)
APPLIED = tuple(f"applied_{i}" for i in SLOTS)

# A trailer stands behind every detail line; detail positions stay far below this.
TRAILER_LINE = 900_000_000_000_000_000

AS_OF = date(1999, 6, 15)
WINDOW_DAYS = 670


def slot_strip() -> str:
    """Text the slots of a line are cut from: mostly valid pairs, now and then a bad one."""
    out = []
    for i in range(STRIP_SLOTS + len(SLOTS)):
        qualifier = "X1" if i % 97 == 31 else "99" if i % 89 == 60 else "08" if i % 19 == 7 else f"{(2, 4, 5, 6)[i % 4]:02d}"
        applied = "12 4" if i % 61 == 17 else f"{i * 37 % 10000:04d}"
        out.append(qualifier + applied)
    return "".join(out)


def _slots(d: Dialect, at: str, filled: str) -> str:
    """The text of some slots of the strip, from a place on.

    A substring of the whole strip walks along it character by character, which was half the cost of a
    line; Spark takes the longest text from each place out of a list instead.
    """
    whole = f"""substring('{slot_strip()}', cast(1 + {SLOT_WIDTH} * ({at}) as int),
       cast({SLOT_WIDTH} * ({filled}) as int))"""
    if not d.spark:
        return whole
    strip, most = slot_strip(), SLOT_WIDTH * len(SLOTS)
    texts = ", ".join(f"'{strip[SLOT_WIDTH * i:SLOT_WIDTH * i + most]}'" for i in range(STRIP_SLOTS))
    short = f"substring(array({texts})[cast({at} as int)], 1, cast({SLOT_WIDTH} * ({filled}) as int))"
    return f"case when {at} < 0 or {filled} < 0 then {whole} else {short} end"


def line(d: Dialect) -> str:
    """One 133-character detail line per lineitem row.

    ``line_number`` is a position: unique in its job and increasing, not dense.
    """
    filled = "(l_partkey + l_linenumber) % 13"
    cents = d.cents("l_extendedprice")
    return f"""
select l_orderkey as job_key,
  2 + ((l_partkey * 7 + l_linenumber - 1) * 10007 + l_suppkey % 10007) * 561
    + cast(l_quantity as bigint) * 11 + cast(round(l_discount * 100) as bigint) as line_number,
  'DT'
  || case when l_quantity = 13 then 'ZZ' when l_returnflag = 'R' then 'DR' else 'DQ' end
  || case when l_returnflag <> 'R' then ' ' when l_linestatus = 'F' then 'R' else 'A' end
  || case when l_linenumber = 6 and l_suppkey % 5 = 0 then '9  '
     when l_returnflag = 'R' and l_linestatus = 'F' and l_linenumber < 7 then '104' else '   ' end
  || case when l_suppkey % 50 = 7 then '20011345' else {d.ymd("l_shipdate")} end
  || case when l_partkey % 211 = 5 then '          ' else {d.zero("l_partkey % 997", 10)} end
  || {d.zero("cast(l_quantity as int)", 2)}
  || case when l_suppkey % 37 = 3 then '$' else '0' end || {d.zero(cents, 9)}
  || case when l_linenumber < 4 then '+' when l_linenumber = 4 then '-' else ' ' end
  || case when l_linenumber = 6 then '      ' when l_suppkey % 41 = 0 then 'MID   '
     when l_discount > 0.08 then 'HIGH  ' else 'LOW   ' end
  || {d.zero("(l_partkey % 25) * 1000000 + (l_suppkey % 61) * 10000 + l_partkey % 60 * 100 + 7", 8)}
  || case when l_orderkey % 9 = 0 and l_linenumber = 5 then '0002' when l_suppkey % 83 = 1 then 'A001'
     else '0001' end
  || case when l_suppkey % 59 = 2 then '  ' else {d.zero(filled, 2)} end
  || case l_partkey % 4 when 0 then '01' when 1 then '07' else '  ' end
  || rpad({_slots(d, f"(l_partkey * 7 + l_suppkey) % {STRIP_SLOTS}", filled)}, {SLOT_WIDTH * len(SLOTS)},
     case l_suppkey % 9 when 0 then '  0000' when 1 then '  0012' else ' ' end) as value
from {d.table("lineitem")}"""


def record_columns(layout: Layout = RECORD) -> str:
    """The slices of a line as select items, for the checking engine."""
    return ",\n  ".join(f"substring(value, {f.start + 1}, {f.width}) as {f.name}" for f in layout.fields)


def job(d: Dialect) -> str:
    """One file-processing job per order."""
    start = f"o_orderdate + {d.minutes('o_orderkey % 1440')}"
    return f"""
select o_orderkey as job_key,
  cast(o_custkey % 6 + 1 as int) as feed_id,
  cast(case when o_custkey % 6 in (2, 5) then 2 else 1 end as int) as client_id,
  case when o_custkey % 11 = 0 then 'OUTBOUND' else 'INBOUND' end as file_type,
  {start} as start_ts,
  {start} + {d.seconds(d.cents("o_totalprice") + " % 900")} as end_ts,
  case when o_orderstatus = 'P' then 'Fail' else 'Success' end as status,
  case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'Available' else 'Not Available' end
    as file_status,
  o_orderkey % 8 = 1 as complete,
  case when o_custkey % 13 = 0 then 'ODD.' || {d.s("o_orderkey")} || '.TXT'
    else 'FEED' || {d.s("o_custkey % 7 + 1")} || '_TST_HUB_' || {d.stamp(start)} || '.TXT' end as file_name
from {d.table("orders")}"""


def feed(d: Dialect) -> str:
    """Configuration of the six feeds; a fixed handful of rows that every query joins to big ones."""
    rows = [
        "(1, 1, 'FEED1_TST_HUB_YYMMDDHHMMSS', 'INBOUND', true, 0.05, 300, 1, true, true, 'SENDER1', 'HUB')",
        "(2, 1, 'FEED2_TST_HUB_MMDDYY.HHMMSS', 'INBOUND', true, 0.5, 600, 2, true, false, 'SENDER2', 'HUB')",
        "(3, 2, 'FEED3_TST_HUB_YYMMDDHHMMSS', 'INBOUND', true, 2.0, 450, 12, true, true, 'UPSTREAM', 'HUB')",
        "(4, 1, 'FEED4_TST_HUB_MMDDYYHHMMSS', 'OUTBOUND', true, 0.0, 300, 1, true, true, 'HUB', 'SENDER1')",
        "(5, 1, 'FEED5_TST_HUB_YYMMDDHHMMSS', 'INBOUND', false, 1.0, 100, 3, false, true, 'SENDER5', 'HUB')",
        "(6, 2, 'FEED6_TST_HUB_MMDDYY.HHMMSS', 'INBOUND', true, 3.0, 800, 4, true, true, 'UPSTREAM', 'HUB')",
    ]
    return f"""
select cast(feed_id as int) as feed_id, cast(client_id as int) as client_id, name_pattern, feed_type, is_active,
  cast(threshold as double) as threshold, cast(duration as int) as duration, cast(per_day as int) as per_day,
  check_structure, check_details, sender, receiver
from (values {", ".join(rows)}) as t(feed_id, client_id, name_pattern, feed_type, is_active, threshold,
  duration, per_day, check_structure, check_details, sender, receiver)"""


def _head(d: Dialect) -> str:
    batch = d.zero("o_orderkey % 10000000", 10)
    return f"""
select o_orderkey as job_key, cast(1 as bigint) as line_number,
  rpad(case when o_orderkey % 16 = 1 then 'XX' else 'HD' end || {batch}
    || case when o_orderkey % 16 = 2 then 'STRANGER  ' else 'SENDER    ' end
    || case when o_orderkey % 16 = 3 then 'ELSEWHERE ' else 'HUB       ' end, {LINE_LENGTH}, ' ') as value
from {d.table("orders")}"""


def file(d: Dialect) -> str:
    """Whole files: header, details, trailer, with a defect chosen by ``job_key % 16``."""
    batch = d.zero("o_orderkey % 10000000", 10)
    other = d.zero("(o_orderkey + 1) % 10000000", 10)
    return f"""
{_head(d)}
union all
select job_key, line_number,
  case when job_key % 16 = 0 and line_number % 5 = 3 then substring(value, 1, {LINE_LENGTH - 3})
    when job_key % 16 = 4 and line_number % 5 = 2 then 'HD' || substring(value, 3, {LINE_LENGTH - 2})
    else value end as value
from ({line(d)}) l where job_key % 16 <> 11
union all
select o_orderkey as job_key, cast({TRAILER_LINE} as bigint) as line_number,
  rpad('TR' || case when o_orderkey % 16 = 9 then {other} else {batch} end
    || case when o_orderkey % 16 = 5 then '000000X001'
       else lpad({d.s('''case when o_orderkey % 16 = 8 then coalesce(n, 0) + 1
         when o_orderkey % 16 = 11 then 0 else coalesce(n, 0) end''')}, 10, '0') end,
    {LINE_LENGTH}, ' ') as value
from {d.table("orders")}
left join (select l_orderkey, count(*) as n from {d.table("lineitem")} group by l_orderkey) c
  on o_orderkey = l_orderkey
where o_orderkey % 16 <> 10
union all
select o_orderkey as job_key, cast({TRAILER_LINE + 1} as bigint) as line_number,
  rpad(case when o_orderkey % 16 = 6 then 'TR' else 'DT' end, {LINE_LENGTH}, ' ') as value
from {d.table("orders")} where o_orderkey % 16 in (6, 7)"""


def history(d: Dialect) -> str:
    """One history row per order; the amount is 11 digits and a sign-and-digit letter."""
    cents = d.cents("o_totalprice")
    return f"""
select o_orderkey as line_number, {d.s("o_custkey")} as carrier, o_orderpriority as account,
  'G' || {d.s("o_custkey % 17")} as group_id, 'M' || {d.zero("o_custkey", 9)} as member_id,
  'D' || substring(o_orderpriority, 1, 1) as accum_code, {d.ymd("o_orderdate")} as adjusted,
  lpad({d.s(f"cast(floor({cents} / 10) as bigint)")}, 11, '0') ||
  substring(case when o_custkey % 3 = 0 then '}}JKLMNOPQR' else '{{ABCDEFGHI' end,
    cast({cents} % 10 as int) + 1, 1) as adj_amt
from {d.table("orders")}"""


def crosswalk(d: Dialect) -> str:
    """Versions of replacement ids per (carrier, account, group), newest term date wins."""
    return f"""
select {d.s("o_custkey")} as carrier, o_orderpriority as account, 'G' || {d.s("o_custkey % 17")} as group_id,
  o_orderdate as term_date, o_orderkey as version,
  'NC' || {d.zero("o_orderkey % 1000000", 7)} as new_carrier,
  'NA' || substring(o_orderpriority, 1, 1) || {d.zero("o_orderkey % 1000", 4)} as new_account,
  'NG' || {d.zero("o_orderkey % 100", 3)} as new_group
from {d.table("orders")} where o_orderkey % 3 <> 0"""


def schedule(d: Dialect) -> str:
    """Delivery windows of the feeds: one row per nation, a handful however large the data."""
    base = d.ts("1996-01-01 10:30:00")
    last = f"{base} + {d.minutes('n_nationkey * 10080')}"
    return f"""
select cast(n_nationkey * 10 as int) as schedule_id, cast(n_nationkey % 6 + 1 as int) as feed_id,
  case n_nationkey % 4 when 0 then 'INBOUND->HUB' when 1 then 'HUB->OUTBOUND' when 2 then 'HUB->UPSTREAM'
    else 'FILE COUNT' end as processing_type,
  {last} as last_poll, {last} + {d.minutes("43200")} as next_poll,
  cast(1440 * (n_nationkey % 12 + 1) as int) as grace_minutes,
  n_nationkey % 5 <> 0 as is_active, n_nationkey % 7 = 0 as is_running,
  cast(n_nationkey % 3 + 1 as int) as files_per_day
from {d.table("nation")}"""


def schedule_book(d: Dialect) -> str:
    """Many schedules, one per supplier, for the queries that look at schedules alone."""
    base = d.ts("1996-01-01 10:30:00")
    last = f"{base} + {d.minutes('s_suppkey * 97 % 1000000')}"
    return f"""
select s_suppkey * 10 as schedule_id, cast(s_suppkey % 8 + 1 as int) as feed_id,
  case s_suppkey % 4 when 0 then 'INBOUND->HUB' when 1 then 'HUB->OUTBOUND' when 2 then 'HUB->UPSTREAM'
    else 'FILE COUNT' end as processing_type,
  {last} as last_poll, {last} + {d.minutes("1440")} as next_poll,
  cast(60 * (s_suppkey % 12 + 1) as int) as grace_minutes,
  s_suppkey % 5 <> 0 as is_active, s_suppkey % 7 = 0 as is_running
from {d.table("supplier")}"""


def maintenance(d: Dialect) -> str:
    """Three-hour maintenance windows around some next polls, a handful of rows."""
    return f"""
select feed_id, next_poll - {d.minutes("90")} as from_ts, next_poll + {d.minutes("90")} as to_ts
from ({schedule(d)}) s where schedule_id % 40 = 0"""


def arrival(d: Dialect) -> str:
    return f"""
select event_id, ts, user_id, cast(user_id % 6 + 1 as int) as feed_id, event_type,
  {d.cents("value")} as cents
from {d.table("events")}"""


def setting(d: Dialect) -> str:
    """Export settings with overlapping and expired date ranges, one per order."""
    day = "cast(o_orderdate as date)"
    plus = f"date_add({day}, cast(o_orderkey % 90 as int))" if d.spark else f"{day} + cast(o_orderkey % 90 as int)"
    return f"""
select o_orderkey as setting_id, cast(o_custkey % 6 + 1 as int) as feed_id, {day} as valid_from,
  {plus} as valid_to, o_orderkey % 2 = 0 as create_empty
from {d.table("orders")}"""


def big_column(d: Dialect) -> str:
    """A catalogue as large as the data: columns from parts, see big_rule and big_error."""
    return f"""
select p_partkey as file_column_id, cast(p_partkey % 500 + 1 as int) as feed_id, p_name as file_column_name,
  {d.s("p_size")} || ':' || {d.s("p_size + 5")} as column_position,
  case when p_partkey % 7 = 0 then 'Y' else 'N' end as is_accumulator
from {d.table("part")}"""


def big_feed(d: Dialect) -> str:
    return f"""
select cast(s_suppkey as int) as feed_id, cast(s_nationkey as int) as client_id from {d.table("supplier")}"""


def big_rule(d: Dialect) -> str:
    return f"""
select l_orderkey * 8 + l_linenumber as rule_id, l_partkey as file_column_id, l_linenumber as priority,
  case l_linenumber when 1 then 'REQUIRED' when 2 then 'EQUALTO' when 3 then 'RANGE' when 4 then 'EXTERNAL'
    when 6 then 'CUSTOM' else 'NUMBER' end as validation_type,
  case when l_linenumber = 2 then l_returnflag end as equal_to,
  case when l_linenumber = 3 then l_returnflag || ',' || l_linestatus end as list_of_values,
  case when l_linenumber = 6 then 'date_window' end as formula,
  cast(l_suppkey % 100 as int) as error_code, cast(l_linenumber % 2 + 1 as int) as error_level,
  case when l_quantity < 45 then 'Y' else 'N' end as is_active
from {d.table("lineitem")}"""


def big_error(d: Dialect) -> str:
    return f"""
select distinct cast(s_suppkey % 100 as int) as error_code, 'Error of kind ' || {d.s("s_suppkey % 100")} as error_message
from {d.table("supplier")}"""


def big_mapping(d: Dialect) -> str:
    """Mapping rows of many feeds, one per part."""
    return f"""
select cast(p_partkey as int) as mapping_id, cast(p_size as int) as feed_id,
  case p_partkey % 3 when 0 then 'Header' when 1 then 'Detail' else 'Footer' end as row_type,
  case p_partkey % 4 when 0 then 'COPY_AS_IS' when 1 then 'REPLACE' when 2 then 'CUSTOM' else 'FILL_WITH_THIS_VALUE' end as kind,
  cast(p_size + 1 as int) as width, case when p_partkey % 4 in (0, 2) then '1:' || {d.s("p_size")} end as source,
  case when p_partkey % 4 in (1, 3) then p_brand end as value, case when p_partkey % 4 = 2 then 'id_limit' end as formula,
  case when p_partkey % 4 = 2 then '[' || {d.s("p_size")} || ', "9"]' end as arguments
from {d.table("part")}"""


def custom_file(d: Dialect) -> str:
    """Partner files in their own layout: one file per nation, a detail per customer.

    Header: type 0:2, date 2:10, clock 10:14, mode 14:18. Detail: type 0:2, id 2:27, name 27:47,
    gender 47:48, date 48:56, sign 56:57, amount 57:69, segment 69:79. Footer: type 0:2, lines 2:11.
    """
    cents = d.cents("abs(c_acctbal)")
    return f"""
select cast(n_nationkey as int) as file_id, cast(1 as bigint) as line_number,
  'FH' || '199806' || {d.zero("n_nationkey + 1", 2)} || '0930'
  || case n_nationkey % 3 when 0 then 'PROD' when 1 then 'TEST' else 'WHAT' end as value
from {d.table("nation")}
union all
select cast(c_nationkey as int) as file_id, c_custkey + 2 as line_number,
  'CD' || rpad('ID' || repeat('7', cast(c_custkey % 24 as int)), 25, ' ') || rpad('  ' || c_name || '  ', 22, ' ')
  || case c_custkey % 4 when 0 then 'M' when 1 then 'F' else 'U' end
  || '1998' || {d.zero("c_custkey % 12 + 1", 2)} || {d.zero("c_custkey % 28 + 1", 2)}
  || case when c_acctbal < 0 then '-' else '+' end
  || case when c_custkey % 17 = 5 then 'no amount   ' else lpad({d.s(f"{cents} * (c_custkey % 30000)")}, 12, '0') end
  || rpad(c_mktsegment, 10, ' ') as value
from {d.table("customer")}
union all
select cast(n_nationkey as int) as file_id, cast({TRAILER_LINE} as bigint) as line_number,
  'FT' || lpad({d.s("coalesce(n, 0) + 2")}, 9, '0') as value
from {d.table("nation")}
left join (select c_nationkey, count(*) as n from {d.table("customer")} group by c_nationkey) c
  on n_nationkey = c_nationkey"""


# The catalogue of the record layout. One rule of every kind, both levels, one inactive, one external.
def ruled_columns() -> list[RuledColumn]:
    def span(name: str) -> tuple[int, int]:
        f = RECORD[name]
        return f.start, f.end

    def column(column_id: int, name: str, slice_name: str, *rules: Rule, accumulator: bool = False):
        return RuledColumn(column_id, name, *span(slice_name), accumulator, rules)

    out = [
        column(1, "Record Type", "record_type",
               Rule(10, 1, "REQUIRED", error_code=10, error_level=1),
               Rule(11, 2, "EQUALTO", "DT", error_code=11, error_level=1)),
        column(2, "Message Kind", "file_type",
               Rule(20, 1, "RANGE", values=("DQ", "DR"), error_code=12, error_level=1)),
        column(3, "Answer", "response",
               Rule(30, 1, "CUSTOM", custom="response_presence", error_code=13, error_level=1),
               Rule(31, 2, "CUSTOM", custom="response_by_file_type", error_code=24, error_level=1),
               Rule(32, 3, "CUSTOM", custom="skip_answered", error_code=27, error_level=2)),
        column(4, "Refusal", "reject",
               Rule(40, 1, "CUSTOM", custom="reject_code_by_response", error_code=26, error_level=1)),
        column(5, "Service Day", "service_date",
               Rule(50, 1, "REQUIRED", error_code=18, error_level=1),
               Rule(51, 2, "DATE", error_code=20, error_level=2),
               Rule(52, 3, "CUSTOM", custom="date_window", error_code=19, error_level=2)),
        column(6, "Transmission ID", "transmission_id",
               Rule(60, 1, "REQUIRED", error_code=23, error_level=1),
               Rule(61, 2, "EXTERNAL", error_code=12, error_level=1)),
        column(7, "Quantity", "quantity",
               Rule(70, 1, "NUMBER", error_code=14, error_level=2),
               Rule(71, 2, "MUST_NOT_EQUAL_TO", "07", error_code=15, error_level=2),
               Rule(72, 3, "ALL_ZEROS", error_code=16, error_level=2, active=False)),
        column(8, "Amount", "amount", Rule(80, 1, "NUMBER", error_code=17, error_level=1)),
        column(9, "Sign", "action",
               Rule(90, 1, "REQUIRED_AND_RANGE", values=("+", "-"), error_code=33, error_level=1)),
        column(10, "Label", "tag",
               Rule(100, 1, "MUST_NOT_EQUAL_TO", "HIGH", error_code=29, error_level=2),
               Rule(101, 2, "BLANK_OR_RANGE", values=("LOW", "HIGH"), error_code=30, error_level=2)),
        column(11, "Sending Time", "transmission_time", Rule(110, 1, "TIME", error_code=21, error_level=2)),
        column(12, "Submission Number", "submission",
               Rule(120, 1, "REQUIRED", error_code=25, error_level=2),
               Rule(121, 2, "NUMBER", error_code=28, error_level=2)),
        column(13, "Balance Count", "slot_count",
               Rule(130, 1, "REQUIRED", error_code=34, error_level=2),
               Rule(131, 2, "NUMBER", error_code=35, error_level=2)),
        column(14, "Specific Category Type", "category",
               Rule(140, 1, "REQUIRED_AND_RANGE", values=("01", "02", "03"), error_code=36, error_level=2)),
    ]
    for i in SLOTS:
        out += [
            column(100 + 2 * i, f"Slot Kind {i:02d}", f"qualifier_{i}",
                   Rule(1000 + 10 * i, 1, "REQUIRED_AND_RANGE", values=("02", "04", "05", "06", "07", "08"),
                        error_code=22, error_level=2), accumulator=True),
            column(101 + 2 * i, f"Applied Amount {i:02d}", f"applied_{i}",
                   Rule(1001 + 10 * i, 1, "REQUIRED", error_code=31, error_level=2),
                   Rule(1002 + 10 * i, 2, "NUMBER", error_code=32, error_level=2), accumulator=True),
        ]
    return out


def rule_set() -> RuleSet:
    return RuleSet.of(
        RECORD, ruled_columns(), slots=QUALIFIERS, as_of=AS_OF, settings={"date_window_days": WINDOW_DAYS}
    )


# A line as wide as partners send: the record, then twelve sections of twelve fields.
SECTIONS, PER_SECTION, SECTION_WIDTH, WIDE_LENGTH = 12, 12, 130, 1700
WIDE = Layout.of(
    "wide",
    *[(f.name, f.start, f.end) for f in RECORD.fields],
    *[
        (f"part_{s}_{k}", start, start + {2: 8, PER_SECTION - 1: 20}.get(k, 10))
        for s in range(SECTIONS)
        for k in range(PER_SECTION)
        for start in [LINE_LENGTH + SECTION_WIDTH * s + 10 * k]
    ],
)


def wide_line(d: Dialect) -> str:
    """Lines of 1,700 characters: every section repeats a mix of the record's digits, dates and blanks."""
    cut = (lambda start, n: f"case when narrow then cast(substring(bytes, {start}, {n}) as string) else substring(value, {start}, {n}) end") if d.spark else (
        lambda start, n: f"substring(value, {start}, {n})"
    )
    section = (
        f"rpad({cut(17, 10)}, 10, ' ') || rpad({cut(29, 10)}, 10, ' ') || {cut(9, 8)} || '  '"
        f" || rpad({cut(46, 8)}, 10, ' ') || rpad({cut(60, 2)}, 10, ' ') || rpad({cut(40, 6)}, 10, ' ')"
        f" || '0000000000' || rpad({cut(3, 2)}, 10, ' ') || rpad({cut(62, 6)}, 10, ' ') || repeat(' ', 10)"
        f" || rpad({cut(54, 4)}, 10, ' ') || rpad({cut(80, 20)}, 20, ' ')"
    )
    made, padded = f"value || repeat({section}, {SECTIONS})", f"rpad({{}}, {WIDE_LENGTH}, ' ')"
    if not d.spark:
        return f"select job_key, line_number, {padded.format(made)} as value from ({line(d)}) l"
    # Spark walks a text character by character to cut or pad it; one byte per character needs no walk
    return f"""
select job_key, line_number, case when narrow and octet_length(made) <= {WIDE_LENGTH}
    then made || repeat(' ', {WIDE_LENGTH} - octet_length(made)) else {padded.format("made")} end as value
from (select job_key, line_number, narrow, {made} as made
  from (select *, cast(value as binary) as bytes, value rlike '{NARROW}' as narrow from ({line(d)}) l) n) m"""


def wide_columns() -> list[RuledColumn]:
    """A rule or two for every field of every section."""
    kinds = [
        [("REQUIRED", {})], [("NUMBER", {})], [("DATE", {}), ("REQUIRED", {})], [("NUMBER", {})],
        [("BLANK_OR_RANGE", {"values": ("01", "07", "12")})], [("MUST_NOT_EQUAL_TO", {"equal_to": "HIGH"}), ("REQUIRED", {})],
        [("ALL_ZEROS", {})], [("RANGE", {"values": ("DQ", "DR")}), ("REQUIRED", {})], [("REQUIRED", {})], [("BLANK", {})],
        [("NUMBER", {}), ("REQUIRED", {})], [("REQUIRED", {})],
    ]
    out = []
    for s in range(SECTIONS):
        for k, rules in enumerate(kinds):
            number = 100 * s + k
            made = [Rule(5000 + 10 * number + i, i + 1, kind, error_code=40 + k, error_level=2, **kw) for i, (kind, kw) in enumerate(rules)]
            f = WIDE[f"part_{s}_{k}"]
            out.append(RuledColumn(1000 + number, f"Part {s} field {k}", f.start, f.end, False, tuple(made)))
    return out


def wide_rule_set() -> RuleSet:
    return RuleSet.of(WIDE, wide_columns(), as_of=AS_OF)
