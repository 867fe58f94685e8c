"""The rule catalogue, every rule kind, the whole engine and what follows from its outcomes."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.fixtures.dialect import DUCK
from ferrybook.operators import outcomes as O
from ferrybook.operators import rules as E
from ferrybook.operators.catalogue import Rule, RuledColumn, catalogue_rows, compile_rows, clone_rules, evaluated, feeds_with_rules
from ferrybook.queries.base import RECORD_SQL, Tables, registry, with_relations
from ferrybook.session import small_table

QUERIES, ORACLES, query = registry()


# ---- checking SQL of single rules, written from the rule's wording ------------------------------


def q(text: object) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def head(c: RuledColumn) -> str:
    return q(f"Column : {c.name}  at position {c.start + 1}:{c.end}")


def tail(r: Rule, gap: str = "") -> str:
    return q(f" Error Code : {r.error_code}{gap}, Error Level : {r.error_level}")


def failing(r: Rule, v: str) -> str:
    s, among = f"trim({v})", ", ".join(q(x) for x in r.values)
    return {
        "REQUIRED": f"{s} = ''",
        "EQUALTO": f"{s} <> {q(r.equal_to)}",
        "MUST_NOT_EQUAL_TO": f"{s} = {q(r.equal_to)}",
        "RANGE": f"{s} not in ({among or q('')})",
        "BLANK_OR_RANGE": f"{s} <> '' and {s} not in ({among or q('')})",
        "REQUIRED_AND_RANGE": f"({s} = '' or {s} not in ({among or q('')}))",
        "NUMBER": f"not regexp_full_match({v}, '[0-9]+')",
        "BLANK": f"{s} <> ''",
        "ALL_ZEROS": f"not regexp_full_match({v}, '0+')",
        "DATE": f"(not regexp_full_match({v}, '[0-9]{{8}}') or try_strptime({v}, '%Y%m%d') is null)",
        "TIME": f"not regexp_full_match({v}, '([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9][0-9]{{1,2}}')",
    }[r.kind]


def wording(c: RuledColumn, r: Rule, v: str, kind: str | None = None) -> str:
    has, listed = q(" has the value "), q(f", and it does not belong to the list {list(r.values)}.")
    empty = f"{head(c)} || ' can not be empty.' || {tail(r, ' ')}"
    range_text = f"{head(c)} || {has} || {v} || {listed} || {tail(r)}"
    return {
        "REQUIRED": empty,
        "EQUALTO": f"{head(c)} || {has} || trim({v}) || {q(f', expected value is {r.equal_to}')} || {tail(r)}",
        "MUST_NOT_EQUAL_TO": f"{head(c)} || {has} || trim({v})"
        f" || {q(f', System does not expect this value {r.equal_to} here.')} || {tail(r)}",
        "RANGE": range_text,
        "BLANK_OR_RANGE": range_text,
        "REQUIRED_AND_RANGE": f"case when trim({v}) = '' then {empty} else {range_text} end",
        "NUMBER": f"{head(c)} || {has} || {v} || ' and it is not a number. Field can only contain digits and no other"
        f" characters.' || {tail(r)}",
        "BLANK": f"{head(c)} || {has} || {v} || ', but blank/empty space(s) is expected here.' || {tail(r)}",
        "ALL_ZEROS": f"{head(c)} || {has} || {v} || '  Value filled with 0 (zero) is expected here.' || {tail(r)}",
        "DATE": f"{head(c)} || {has} || {v} || ', it is not a valid date format.' || {tail(r)}",
        "TIME": f"{head(c)} || {has} || {v} || ', it is not a valid time format.' || {tail(r)}",
        "CUSTOM": f"{head(c)} || {has} || {v} || ', and it does not pass the require validations.' || {tail(r, ' ')}",
    }[kind or r.kind]


def slice_sql(c: RuledColumn) -> str:
    return f"substring(value, {c.start + 1}, {c.end - c.start})"


def outcome_sql(c: RuledColumn, r: Rule, condition: str, text: str, source: str = "line", where: str = "true") -> str:
    return f"""select job_key, line_number, {r.rule_id} as rule_id,
      case when {condition} then 'N' else 'Y' end as validation_result,
      case when {condition} then {text} else ' ' end as error_message from {source} where {where}"""


# ---- one query per kind --------------------------------------------------------------------------

ALL = {r.rule_id: (c, r) for c in R.ruled_columns() for r in c.rules}


def kind_query(name: str, *pairs: tuple[RuledColumn, Rule]):
    oracle = " union all ".join(
        outcome_sql(c, r, failing(r, slice_sql(c)), wording(c, r, slice_sql(c))) for c, r in pairs
    )
    columns = [RuledColumn(c.column_id, c.name, c.start, c.end, False, (r,)) for c, r in pairs]
    rules = E.RuleSet.of(R.RECORD, columns)
    query(name, with_relations("line", oracle))(lambda t: E.evaluate(t.relation("line"), rules))


kind_query("rule_required", ALL[60])
kind_query("rule_equal_to", ALL[11])
kind_query("rule_not_equal_to", ALL[71], ALL[100])
kind_query("rule_range", ALL[20])
kind_query("rule_blank_or_range", ALL[101])
kind_query("rule_required_and_range", ALL[90])
kind_query("rule_number", ALL[70], ALL[80])
kind_query("rule_blank", (RuledColumn(4, "Refusal", 5, 8), Rule(400, 1, "BLANK", error_code=130, error_level=2)))
kind_query("rule_all_zeros", (RuledColumn(125, "Last Amount", 129, 133), Rule(401, 1, "ALL_ZEROS", error_code=131)))
kind_query("rule_date", ALL[51])
kind_query("rule_time", ALL[110])

TYPE, RESPONSE, REJECT = "substring(value, 3, 2)", "substring(value, 5, 1)", "substring(value, 6, 3)"
DAY = "try_strptime(substring(value, 9, 8), '%Y%m%d')"
CUSTOM_FAILS = {
    30: f"case when {TYPE} = 'DQ' then trim({RESPONSE}) <> '' else trim({RESPONSE}) = '' end",
    31: f"case when {TYPE} = 'DR' then {RESPONSE} not in ('A', 'R') when {TYPE} = 'DQ' then trim({RESPONSE}) <> ''"
    " else true end",
    32: "false",
    40: f"case when {TYPE} = 'DR' and {RESPONSE} = 'R' then trim({REJECT}) = '' else trim({REJECT}) <> '' end",
    52: f"coalesce({DAY} < date '{R.AS_OF}' - {R.WINDOW_DAYS} or {DAY} > date '{R.AS_OF}', true)",
}


def custom_sql(rule_id: int) -> str:
    c, r = ALL[rule_id]
    return outcome_sql(c, r, CUSTOM_FAILS[rule_id], wording(c, r, slice_sql(c)))


def only(*rule_ids: int) -> E.RuleSet:
    return R.rule_set().only(*rule_ids)


@query("rule_conditional", with_relations("line", " union all ".join(custom_sql(i) for i in (30, 31, 40))))
def rule_conditional(t: Tables):
    return E.evaluate(t.relation("line"), only(30, 31, 40))


@query("rule_date_window", with_relations("line", custom_sql(52)))
def rule_date_window(t: Tables):
    return E.evaluate(t.relation("line"), only(52))


FILLED = (RuledColumn(13, "Count", 57, 59), Rule(402, 1, "CUSTOM", custom="filled_slot_count", error_code=635))
SLOT_STARTS = [R.RECORD[name].start + 1 for name in R.QUALIFIERS]
SLOT_LIST = "[" + ", ".join(f"substring(value, {s}, 2)" for s in SLOT_STARTS) + "]"


@query(
    "rule_slot_count",
    with_relations(
        "line",
        outcome_sql(
            *FILLED,
            f"coalesce(len(list_filter({SLOT_LIST}, lambda x: trim(x) <> '')) <> try_cast(substring(value, 58, 2) as int), true)",
            wording(*FILLED, slice_sql(FILLED[0]), "CUSTOM"),
        ),
    ),
)
def rule_slot_count(t: Tables):
    column, rule = FILLED
    rules = E.RuleSet.of(R.RECORD, [RuledColumn(13, column.name, 57, 59, False, (rule,))], slots=R.QUALIFIERS)
    return E.evaluate(t.relation("line"), rules)


# ---- the whole engine ----------------------------------------------------------------------------

COUNT_COLUMN, COUNT_RULE = ALL[130]
VALUE_COLUMN, VALUE_RULE = ALL[121]
FLAGS = f""", cut as (select *, {TYPE} = 'DR' and {RESPONSE} in ('A', 'R') as skipped, {SLOT_LIST} as slots,
    substring(value, 58, 2) as count_text, substring(value, 54, 4) as number_text,
    first_value(substring(value, 54, 4)) over (partition by job_key order by line_number) as first_number from line),
  placed as (select *, coalesce(nullif(list_position(list_transform(slots,
      lambda x: coalesce(try_cast(trim(x) as int) in (2, 4, 5, 6, 7, 8, 14, 15), false)), false), 0), 13) as bad from cut),
  ran as (select *, case when bad = 13 then 12 when trim(slots[bad]) <> '' and try_cast(trim(slots[bad]) as int) is null
      then 0 else bad - 1 end as run, not regexp_full_match(count_text, '[0-9]+') as count_failed,
    regexp_full_match(number_text, '[0-9]+') and number_text <> first_number as differs from placed),
  flagged as (select *, try_cast(count_text as int) as slot_count,
    not count_failed and try_cast(count_text as int) <> run as count_wrong, list_contains(slots, '08') as category_asked
    from ran)"""
COUNT_TEXT = (
    f"{head(COUNT_COLUMN)} || ' is ' || count_text || '. This value does not match the total number of non-empty and"
    " valid Accumulator Balance Qualifiers in Accumulator Section ( from 1 up to 12).'"
    f" || {tail(COUNT_RULE)}"
)
VALUE_TEXT = (
    f"{head(VALUE_COLUMN)} || ' is ' || number_text || ' and it does not  match the first submission value '"
    f" || first_number || '.' || {tail(VALUE_RULE)}"
)


def engine_sql(with_first: bool = True) -> str:
    parts = []
    for c in evaluated(R.ruled_columns()):
        live = ["true"]
        if c.start >= 5:
            live.append("not skipped")
        if c.start >= 59:
            live.append("not count_failed and not count_wrong")
        v = slice_sql(c)
        for r in c.rules:
            where, fails, text = list(live), None, None
            if r.kind == "CUSTOM":
                fails, text = CUSTOM_FAILS[r.rule_id], wording(c, r, v)
            else:
                fails, text = failing(r, v), wording(c, r, v)
            if r.rule_id == 130:
                fails, text = f"({fails} or count_wrong)", f"case when count_wrong then {COUNT_TEXT} else {text} end"
            if r.rule_id == 131:
                where.append("not count_wrong")
            if r.rule_id == 120 and with_first:
                where.append("not differs")
            if r.rule_id == 121 and with_first:
                fails, text = f"({fails} or differs)", f"case when differs then {VALUE_TEXT} else {text} end"
            if r.rule_id == 140:
                unasked = f"trim({v}) <> ''"
                fails = f"case when category_asked then {fails} else {unasked} end"
                text = f"case when category_asked then {text} else {wording(c, r, v, 'BLANK')} end"
            if c.accumulator:
                used = f"{int(c.name[-2:])} <= slot_count"
                if r.kind == "REQUIRED_AND_RANGE":
                    fails = f"case when {used} then {fails} else trim({v}) <> '' end"
                    text = f"case when {used} then {text} else {wording(c, r, v, 'BLANK')} end"
                elif r.kind == "REQUIRED":
                    unused = f"trim({v}) <> '' and not regexp_full_match({v}, '0+')"
                    fails = f"case when {used} then {fails} else {unused} end"
                    text = f"case when {used} then {text} else {wording(c, r, v, 'ALL_ZEROS')} end"
                else:
                    where.append(f"{used} and trim({v}) <> ''")
            parts.append(outcome_sql(c, r, fails, text, "flagged", " and ".join(where)))
    return " union all ".join(parts)


def with_engine(body: str, relations: str = "line", with_first: bool = True) -> str:
    base = with_relations(relations, "").rstrip()
    return f"{base}{FLAGS}, outcome as ({engine_sql(with_first)})\n{body}"


def catalogue_tables(t: Tables):
    """The test catalogue as the four tables a hub keeps it in."""
    columns, rules = [], []
    for c in R.ruled_columns():
        columns.append((c.column_id, 1, c.name, f"{c.start}:{c.end}", "Y" if c.accumulator else "N"))
        for r in c.rules:
            listed = ",".join(r.values) or None
            rules.append((r.rule_id, c.column_id, r.priority, r.kind, r.equal_to, listed, r.custom, r.error_code, r.error_level, "Y" if r.active else "N"))
    codes = sorted({r[7] for r in rules})
    return (
        small_table(t.spark, [(1, 1)], "feed_id int, client_id int"),
        small_table(t.spark, columns, "file_column_id int, feed_id int, file_column_name string, column_position string, is_accumulator string"),
        small_table(t.spark, rules, "rule_id int, file_column_id int, priority int, validation_type string, equal_to string, "
                    "list_of_values string, formula string, error_code int, error_level int, is_active string"),
        small_table(t.spark, [(c, f"Error {c}") for c in codes], "error_code int, error_message string"),
    )


def compiled_rules(t: Tables) -> E.RuleSet:
    """The rule set compiled from the tables."""
    columns = compile_rows(catalogue_rows(*catalogue_tables(t), feed_id=1))
    return replace(R.rule_set(), columns=tuple(columns))


def full_outcomes(t: Tables):
    rules = compiled_rules(t)
    return E.evaluate(E.with_first_value(t.relation("line"), rules), rules)


def all_failures(t: Tables, level: int | None = None):
    rules = R.rule_set()
    return E.evaluate(E.with_first_value(t.relation("line"), rules), rules, failures_only=True, level=level)


def stateless_outcomes(t: Tables):
    return E.evaluate(t.relation("line"), R.rule_set())


def rule_ids_from(start: int, end: int) -> tuple[int, ...]:
    return tuple(r.rule_id for c in evaluated(R.ruled_columns()) if start <= c.start < end for r in c.rules)


COLUMNS = "job_key, line_number, rule_id, validation_result, error_message"


@query(
    "rule_leading_slots",
    with_engine(
        " union all ".join(
            outcome_sql(
                *ALL[i],
                f"({failing(ALL[i][1], 'count_text')}{' or count_wrong' if i == 130 else ''})",
                f"case when count_wrong then {COUNT_TEXT} else {wording(*ALL[i], 'count_text')} end"
                if i == 130
                else wording(*ALL[i], "count_text"),
                "flagged",
                "true" if i == 130 else "not count_wrong",
            )
            for i in (130, 131)
        )
    ),
)
def rule_leading_slots(t: Tables):
    """The count rules alone, on all lines: nothing before them skips a line."""
    return E.evaluate(t.relation("line"), only(130, 131))


@query(
    "rule_category_type",
    with_engine(
        outcome_sql(
            *ALL[140],
            f"case when category_asked then {failing(ALL[140][1], 'substring(value, 60, 2)')} else trim(substring(value, 60, 2)) <> '' end",
            f"case when category_asked then {wording(*ALL[140], 'substring(value, 60, 2)')}"
            f" else {wording(*ALL[140], 'substring(value, 60, 2)', 'BLANK')} end",
            "flagged",
        )
    ),
)
def rule_category_type(t: Tables):
    return E.evaluate(t.relation("line"), only(140))


@query(
    "rule_slot_fields",
    with_engine(
        """select rule_id, validation_result, count(*) as lines, cast(sum(length(error_message)) as bigint) as message_chars,
          cast(sum(line_number % 1000003) as bigint) as line_sum
        from outcome where rule_id >= 1000 group by 1, 2""",
        with_first=False,
    ),
)
def rule_slot_fields(t: Tables):
    """All slot rules with the rules before them, as counts and checksums per rule and result."""
    out = stateless_outcomes(t).where(F.col("rule_id") >= 1000)
    return out.groupBy("rule_id", "validation_result").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.length("error_message")).cast("bigint").alias("message_chars"),
        F.sum(F.col("line_number") % 1000003).cast("bigint").alias("line_sum"),
    )


@query(
    "rule_first_value",
    with_engine(
        " union all ".join(
            outcome_sql(
                *ALL[i],
                f"({failing(ALL[i][1], 'number_text')}{' or differs' if i == 121 else ''})",
                f"case when differs then {VALUE_TEXT} else {wording(*ALL[i], 'number_text')} end"
                if i == 121
                else wording(*ALL[i], "number_text"),
                "flagged",
                "true" if i == 121 else "not differs",
            )
            for i in (120, 121)
        )
    ),
)
def rule_first_value(t: Tables):
    rules = only(120, 121)
    return E.evaluate(E.with_first_value(t.relation("line"), rules), rules)


@query(
    "rule_short_circuit",
    with_engine(
        """select job_key, line_number, count(*) as evaluated, max(rule_id) as last_rule from outcome group by 1, 2""",
        with_first=False,
    ),
)
def rule_short_circuit(t: Tables):
    """How far every line was evaluated before a stop."""
    return stateless_outcomes(t).groupBy("job_key", "line_number").agg(
        F.count(F.lit(1)).alias("evaluated"), F.max("rule_id").alias("last_rule")
    )


@query(
    "rule_results",
    with_engine(
        """select rule_id, validation_result, count(*) as outcomes, cast(sum(length(error_message)) as bigint) as message_chars,
          cast(sum(line_number % 1000003) as bigint) as line_sum from outcome group by 1, 2"""
    ),
)
def rule_results(t: Tables):
    """The whole engine over all lines, as counts and checksums per rule and result."""
    return full_outcomes(t).groupBy("rule_id", "validation_result").agg(
        F.count(F.lit(1)).alias("outcomes"),
        F.sum(F.length("error_message")).cast("bigint").alias("message_chars"),
        F.sum(F.col("line_number") % 1000003).cast("bigint").alias("line_sum"),
    )


@query("rule_failures", with_engine(f"select {COLUMNS} from outcome where validation_result = 'N'"))
def rule_failures(t: Tables):
    """Every failure row of the whole engine."""
    return all_failures(t)


# ---- catalogue and follow-ups --------------------------------------------------------------------


@query(
    "rule_catalogue",
    with_relations(
        "big_feed big_column big_rule big_error",
        """select b.client_id, a.feed_id, a.file_column_id, a.file_column_name, a.column_position, c.rule_id,
          c.validation_type, c.priority, c.equal_to, c.list_of_values, c.formula, c.error_code, d.error_message,
          a.is_accumulator, c.error_level
        from big_column a join big_rule c on a.file_column_id = c.file_column_id join big_feed b on a.feed_id = b.feed_id
          join big_error d on c.error_code = d.error_code
        where c.is_active = 'Y' and c.validation_type not in ('EXTERNAL')""",
    ),
)
def rule_catalogue(t: Tables):
    return catalogue_rows(*[t.relation(f"big_{n}") for n in ("feed", "column", "rule", "error")])


@query(
    "feeds_with_rules",
    with_relations(
        "big_feed big_column", "select feed_id from big_feed where feed_id in (select feed_id from big_column)"
    ),
)
def feeds_rules(t: Tables):
    return feeds_with_rules(t.relation("big_feed"), t.relation("big_column"))


@query(
    "clone_rules",
    with_relations(
        "big_column big_rule",
        """select * from big_rule union all
        select r.rule_id + 120000000000, r.file_column_id + 120000000000, priority, validation_type,
          case when validation_type = 'EQUALTO' and file_column_name = 'Part#000000010' then 'TAG1'
            when validation_type = 'EQUALTO' and file_column_name = 'Part#000000510' then 'TAG2' else equal_to end,
          list_of_values, formula, error_code, error_level, is_active
        from big_rule r join big_column c on r.file_column_id = c.file_column_id where c.feed_id = 11""",
    ),
)
def clone(t: Tables):
    overrides = {"Part#000000010": "TAG1", "Part#000000510": "TAG2"}
    return clone_rules(t.relation("big_column"), t.relation("big_rule"), 11, 120_000_000_000, overrides)


DUPLICATES = f"""select job_key, line_number, 61 as rule_id, 'N' as validation_result,
    'Column : Transmission ID  at position 17:26 is duplicate.  Duplicate Value is ' || transmission_id
      || ' Error Code : {ALL[61][1].error_code}, Error Level : 1 ' as error_message
  from (select *, row_number() over (partition by job_key, transmission_id order by line_number) as rn from record)
  where rn > 1"""


def duplicates(t: Tables):
    column, rule = ALL[61]
    return O.duplicate_ids(
        t.record(), "transmission_id", rule.rule_id, column.report_position, rule.error_code, rule.error_level
    )


@query("dup_transmission", with_relations("record", DUPLICATES))
def dup_transmission(t: Tables):
    return duplicates(t)


@query(
    "error_line_count",
    with_engine(
        """select j.job_key, coalesce(n, 0) as error_lines from job j left join
          (select job_key, count(distinct line_number) as n from outcome where validation_result = 'N' group by 1) e
          using (job_key)""",
        "line job",
    ),
)
def error_line_count(t: Tables):
    return O.error_line_counts(all_failures(t), t.relation("job"))


@query(
    "threshold_alert",
    with_engine(
        """select j.job_key, j.feed_id, coalesce(n, 0) as error_lines, coalesce(d, 0) as detail_lines,
          coalesce(n, 0) > 0 and coalesce(n, 0) >= case when threshold < 1 then coalesce(d, 0) * threshold else threshold end
            as alert
        from job j join feed f on j.feed_id = f.feed_id
          left join (select job_key, count(distinct line_number) as n from outcome where validation_result = 'N' group by 1) e
            on j.job_key = e.job_key
          left join (select job_key, count(*) as d from line group by 1) c on j.job_key = c.job_key""",
        "line job feed",
    ),
)
def threshold_alert(t: Tables):
    details = t.relation("line").groupBy("job_key").agg(F.count(F.lit(1)).alias("detail_lines"))
    counts = O.error_line_counts(all_failures(t), t.relation("job"))
    return O.threshold_alerts(counts, details, t.relation("job"), t.relation("feed"))


META_SQL = "(values " + ", ".join(
    f"({r.rule_id}, {c.column_id}, {r.error_code}, {r.error_level})" for c in R.ruled_columns() for r in c.rules
) + ") as m(rule_id, file_column_id, error_code, error_level)"
TOP_SQL = f"""select job_key, line_number, error_level, file_column_id, rule_id, error_code from (
    select o.job_key, o.line_number, m.error_level, m.file_column_id, m.rule_id, m.error_code,
      row_number() over (partition by job_key, line_number order by error_level, file_column_id, m.rule_id) as rn
    from outcome o join {META_SQL} on o.rule_id = m.rule_id where validation_result = 'N') where rn = 1"""


@query("top_error_per_line", with_engine(TOP_SQL))
def top_error_per_line(t: Tables):
    return O.top_errors(all_failures(t), O.rule_meta(t.spark, R.ruled_columns()))


def with_top(relations: str, body: str) -> str:
    """A checking query over relations, the parsed records and the top error of every line."""
    base = with_relations(relations, "").rstrip()
    return f"{base}, record as ({RECORD_SQL}){FLAGS}, outcome as ({engine_sql()}), top as ({TOP_SQL})\n{body}"


WIDE_PARTS = " union all ".join(
    f"""select {r.rule_id} as rule_id, case when {failing(r, slice_sql(c))} then 'N' else 'Y' end as validation_result, line_number,
      case when {failing(r, slice_sql(c))} then {wording(c, r, slice_sql(c))} else ' ' end as error_message from wide_line"""
    for c in R.wide_columns() for r in c.rules
)


@query(
    "rule_results_wide",
    f"""with wide_line as materialized ({R.wide_line(DUCK)}) select rule_id, validation_result, count(*) as outcomes,
      cast(sum(length(error_message)) as bigint) as message_chars, cast(sum(line_number % 1000003) as bigint) as line_sum
      from ({WIDE_PARTS}) group by 1, 2""",
)
def rule_results_wide(t: Tables):
    """The engine over lines of 1,700 characters with 182 fields and 192 rules, as counts and checksums."""
    return E.evaluate(t.relation("wide_line"), R.wide_rule_set()).groupBy("rule_id", "validation_result").agg(
        F.count(F.lit(1)).alias("outcomes"),
        F.sum(F.length("error_message")).cast("bigint").alias("message_chars"),
        F.sum(F.col("line_number") % 1000003).cast("bigint").alias("line_sum"),
    )
