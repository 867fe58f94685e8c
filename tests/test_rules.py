from datetime import date

import pytest
from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import catalogue as C
from ferrybook.operators import outcomes as O
from ferrybook.operators.catalogue import Rule, RuledColumn
from ferrybook.operators.layout import Layout
from ferrybook.operators.rules import RuleSet, evaluate, with_first_value

LAYOUT = Layout.of("small", ("file_type", 0, 2), ("response", 2, 3), ("reject", 3, 6), ("value", 6, 14))
SCHEMA = "job_key bigint, line_number bigint, value string"


def results(spark, rules, *values):
    lines = spark.createDataFrame([(1, i + 2, v) for i, v in enumerate(values)], SCHEMA)
    rows = evaluate(lines, rules).orderBy("line_number", "rule_id").collect()
    return [r.validation_result for r in rows]


def rule_set(kind, **kw):
    column = RuledColumn(1, "Value", 6, 14, False, (Rule(1, 1, kind, **kw),))
    return RuleSet.of(LAYOUT, [column], as_of=date(2020, 6, 1), settings={"date_window_days": 10})


@pytest.mark.parametrize(
    "kind, kw, good, bad",
    [
        ("REQUIRED", {}, ["x", " x", "0"], ["", "   ", "\t "]),
        ("EQUALTO", {"equal_to": "AB"}, ["AB", " AB "], ["ab", "", "ABC"]),
        ("EQUALTO", {"equal_to": ""}, ["AB", ""], []),
        ("MUST_NOT_EQUAL_TO", {"equal_to": "99"}, ["98", "", "999"], ["99", " 99 "]),
        ("RANGE", {"values": ("A", " B", "C'")}, ["A", " A", "C'"], ["B", "", "a"]),
        ("BLANK_OR_RANGE", {"values": ("A",)}, ["A", "", "  "], ["B"]),
        ("REQUIRED_AND_RANGE", {"values": ("A",)}, ["A "], ["", "B"]),
        ("NUMBER", {}, ["1", "00012345"], ["", " 1", "+1", "1.0", "1 "]),
        ("BLANK", {}, ["", "  "], ["0", "x"]),
        ("ALL_ZEROS", {}, ["0", "00000000"], ["", " 0", "01"]),
        ("DATE", {}, ["20200229"], ["20190229", "2020-1-1", "", "20201340"]),
        ("TIME", {}, ["23595999", "0000000"], ["24000000", "120000", ""]),
        ("CUSTOM", {"custom": "date_window"}, ["20200601", "20200522"], ["20200602", "20200521", "junk", ""]),
        ("SOMETHING ELSE", {}, ["x", ""], []),
    ],
)
def test_kinds(spark, kind, kw, good, bad):
    lines = [f"DQ    {v}" for v in (*good, *bad)]
    assert results(spark, rule_set(kind, **kw), *lines) == ["Y"] * len(good) + ["N"] * len(bad)


def test_conditional_rules(spark):
    column = RuledColumn(1, "Response", 2, 3, False, (Rule(1, 1, "CUSTOM", custom="response_by_file_type"),))
    reject = RuledColumn(2, "Reject", 3, 6, False, (Rule(2, 1, "CUSTOM", custom="reject_code_by_response"),))
    rules = RuleSet.of(LAYOUT, [column, reject])
    assert results(spark, rules, "DQ    ", "DQA   ", "DRA   ", "DRR104", "DRR   ", "DR    ", "ZZ 104") == [
        "Y", "Y", "N", "Y", "Y", "Y", "Y", "Y", "Y", "N", "N", "Y", "N", "N",
    ]


def slot_line(count, *qualifiers, amounts=None, category="  "):
    slots = list(qualifiers) + ["  "] * (12 - len(qualifiers))
    amounts = amounts or ["0001" if i < len(qualifiers) else "    " for i in range(12)]
    body = "".join(q + a for q, a in zip(slots, amounts))
    return "DTDQ    " + "20200101" + "0000000001" + "01" + "0000000001" + "+" + "LOW   " + "12000000" + "0001" + count + category + body


def slot_results(spark, *lines, ids=None):
    frame = spark.createDataFrame([(1, i + 2, v) for i, v in enumerate(lines)], SCHEMA)
    rules = R.rule_set()
    out = evaluate(frame, rules).where(F.col("rule_id") >= 130)
    got = {}
    for r in out.collect():
        got.setdefault(r.line_number - 2, {})[r.rule_id] = r.validation_result
    return got


def test_slots(spark):
    got = slot_results(
        spark,
        slot_line("02", "02", "14"),
        slot_line("02", "02", "99", "04"),
        slot_line("00", "02", "X1"),
        slot_line("01", "02", "  ", "04"),
        slot_line("  ", "02"),
        slot_line("01", "08", category="02"),
        slot_line("01", "08", category="  "),
        slot_line("01", "02", amounts=["12 4", "0000", "0012"] + ["    "] * 9),
    )
    assert got[0][130] == "Y" and got[0][1010] == "Y" and got[0][1020] == "N"  # 14 counts, but is not in the list
    assert got[1] == {130: "N"}  # the run ends at 99 with length 1
    assert got[2][130] == "Y"  # junk resets the run to 0
    assert got[3][130] == "Y" and got[3][1030] == "N"  # filled behind the count
    assert set(got[4]) == {130, 131} and got[4][130] == "N"
    assert got[5][140] == "Y" and got[6][140] == "N"
    assert (got[7][1011], got[7][1012], got[7][1021], got[7][1031]) == ("Y", "N", "Y", "N")
    assert 1022 not in got[7]


def test_skip_and_first_value(spark):
    lines = [
        (1, 2, "DTDQ    202001010000000001010000000001+LOW   120000000001" + "00"),
        (1, 3, "DTDQ    202001010000000001010000000001+LOW   120000000002" + "00"),
        (1, 4, "DTDRA   202001010000000001010000000001+LOW   120000000002" + "00"),
        (2, 2, "DTDQ    202001010000000001010000000001+LOW   120000000002" + "00"),
    ]
    frame = spark.createDataFrame(lines, SCHEMA)
    rules = R.rule_set()
    rows = evaluate(with_first_value(frame, rules), rules).collect()
    got = {(r.job_key, r.line_number, r.rule_id): (r.validation_result, r.error_message) for r in rows}
    assert got[1, 2, 121][0] == "Y" and got[2, 2, 121][0] == "Y"
    assert got[1, 3, 121] == (
        "N",
        "Column : Submission Number  at position 54:57 is 0002 and it does not  match the first submission value 0001."
        " Error Code : 28, Error Level : 2",
    )
    assert (1, 3, 120) not in got
    assert max(k[2] for k in got if k[:2] == (1, 4)) == 32


def test_partitions_do_not_matter(spark, folder):
    from ferrybook.queries.base import Tables

    lines = Tables(spark, folder).relation("line")
    rules = R.rule_set()

    def digest(n):
        out = evaluate(with_first_value(lines.repartition(n), rules), rules)
        return out.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*out.columns).cast("decimal(38,0)"))).first()

    assert digest(1) == digest(3) == digest(16)


def test_engine_is_one_stage_without_python(spark, folder):
    from ferrybook.queries.base import Tables

    plan = evaluate(Tables(spark, folder).relation("line"), R.rule_set())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_catalogue_to_rules(spark):
    feeds = spark.createDataFrame([(1, 7)], "feed_id int, client_id int")
    columns = spark.createDataFrame([(5, 1, "Amount", "28:38", "N")], "file_column_id int, feed_id int, file_column_name string, column_position string, is_accumulator string")
    rules = spark.createDataFrame(
        [(50, 5, 2, "RANGE", None, "a,b", None, 10, 1, "Y"), (51, 5, 1, "REQUIRED", "", None, None, 11, 2, "Y"), (52, 5, 3, "EXTERNAL", None, None, None, 10, 1, "Y"),
         (53, 5, 4, "NUMBER", None, None, None, 10, 1, "N")],
        "rule_id int, file_column_id int, priority int, validation_type string, equal_to string, list_of_values string, formula string, error_code int, error_level int, is_active string",
    )
    errors = spark.createDataFrame([(10, "ten"), (11, "eleven")], "error_code int, error_message string")
    (column,) = C.compile_rows(C.catalogue_rows(feeds, columns, rules, errors))
    assert [r.rule_id for r in column.rules] == [51, 50] and column.rules[1].values == ("a", "b")
    assert column.report_position == "29:38"


def test_duplicates_against_brute_force(spark):
    rows = [(j, n, f"id{(n * 7 + j) % 5}" if n % 6 else None) for j in range(4) for n in range(2, 40)]
    frame = spark.createDataFrame(rows, "job_key bigint, line_number bigint, ident string")
    got = {(r.job_key, r.line_number) for r in O.duplicate_ids(frame, "ident", 61, "1:2", 103, 1).collect()}
    seen, want = set(), set()
    for j, n, i in rows:
        if i is not None and (j, i) in seen:
            want.add((j, n))
        seen.add((j, i))
    assert got == want


def test_lines_of_wide_characters_are_cut_by_characters(spark):
    from ferrybook.operators.layout import ByteCutter

    spans = [(0, 3), (3, 5), (70, 75), (80, 90)]
    cutter = ByteCutter(spans)
    narrow = "".join(chr(33 + i % 90) for i in range(84))
    values = [narrow, narrow.replace("!", "é"), "äöü" + narrow, "ab", "", None]
    lines = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "line_number bigint, value string")
    blocks = cutter.measured(lines, "line_number").selectExpr("line_number", *cutter.block_columns())
    cut = blocks.selectExpr("line_number", *[f"{cutter.field(*s)} as f{i}" for i, s in enumerate(spans)]).orderBy("line_number")
    assert [tuple(r)[1:] for r in cut.collect()] == [tuple(None if v is None else v[a:b] for a, b in spans) for v in values]


def test_queries_keep_generated_methods_short_enough_to_compile(spark):
    from ferrybook.queries.base import Tables

    other = spark.newSession()
    other.conf.set("spark.sql.codegen.hugeMethodLimit", 65535)
    Tables(other, "/nowhere")
    assert other.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
