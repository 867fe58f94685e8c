from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ferrybook.functions import text as X
from ferrybook.functions.messages import message
from ferrybook.operators import deadlines as D
from ferrybook.operators import history as H
from ferrybook.operators import intake as I
from ferrybook.operators.layout import Cutter, Layout, encode, encode_record, parse


def values(spark, rows, column, schema="v string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_overpunch_examples(spark):
    assert values(spark, [45993, -56789], X.overpunch_encode(F.col("v")), "v bigint") == ["004599C", "005678R"]
    assert values(spark, ["00000004599C", "00000005678R", "00000000000}"], X.overpunch_decode(F.col("v"))) == [45993, -56789, 0]


def test_overpunch_round_trip(spark):
    amounts = [0, 1, -1, 10, -10, 9_999_999, -9_999_999, 1234567, -7654321]
    padded = F.lpad(X.overpunch_encode(F.col("v")), 12, "0")
    assert values(spark, amounts, X.overpunch_decode(padded), "v bigint") == amounts


@pytest.mark.parametrize(
    "amount, parts",
    [(20_000_000, [9_999_999, 9_999_999, 2]), (19_999_998, [9_999_999, 9_999_999]), (-10_000_000, [-9_999_999, -1]),
     (9_999_999, [9_999_999]), (0, [0]), (-5, [-5])],
)
def test_split(spark, amount, parts):
    rows = H.split_amounts(spark.createDataFrame([(amount,)], "int_amount bigint")).orderBy("part").collect()
    assert [r["part_amount"] for r in rows] == parts


def test_strip_is_pythons_strip(spark):
    samples = [" a ", "\t\na\x0b", "　a ", "a\x1f", "", "  ", "\xa0"]
    assert values(spark, samples, X.strip(F.col("v"))) == [s.strip() for s in samples]


def test_name_prefix(spark):
    assert values(spark, ["A_B_C_123.txt", "A_B.txt", "A_B_C_D_E"], X.name_prefix(F.col("v"))) == ["A_B_C", None, "A_B_C"]




def test_pads(spark):
    assert values(spark, ["abc", "abcdef"], X.pad_only(F.col("v"), 5)) == ["abc  ", "abcdef"]
    assert values(spark, ["7", "123456"], X.zero_left(F.col("v"), 3)) == ["007", "123456"]
    assert values(spark, ["  ", "x ", None], X.default_if_blank(F.col("v"), F.lit("00"))) == ["00", "x ", "00"]


def test_expected_name(spark):
    when = F.lit("2020-12-01 14:15:16").cast("timestamp_ntz")
    names = ["A_T_B_MMDDYY.HHMMSS", "A_T_B_YYMMDDHHMMSS", "A_T_B_MMDDYYHHMMSS"]
    assert values(spark, names, D.expected_name(F.col("v"), when)) == ["A_T_B_120120.HHMMSS", "A_T_B_201201HHMMSS", "A_T_B_120120HHMMSS"]


def test_message_quotes_and_values(spark):
    sql = message("it's {name}: \\{value}", {"value": "v"}, name="a'b")
    assert spark.sql(f"select {sql} from (select 'x' as v)").first()[0] == "it's a'b: \\x"


def test_layouts(spark):
    layout = Layout.from_widths("w", "0:3,1:70,2:2", ["a", "b", "c"])
    assert layout.length == 75 and layout["c"].start == 73
    assert Layout.from_spec("s", "0:3,3:73,73:75", ["a", "b", "c"]).fields == layout.fields
    line = "abc" + "é" * 70 + "xy"
    lines = spark.createDataFrame([(1, 2, line), (1, 3, "ab"), (1, 4, line + "more")], "job_key bigint, line_number bigint, value string")
    rows = parse(lines, layout).orderBy("line_number").collect()
    assert (rows[0].a, rows[0].b, rows[0].c) == ("abc", "é" * 70, "xy")
    assert (rows[1].a, rows[1].b, rows[1].c) == ("ab", "", "")
    back = [r[0] for r in parse(lines, layout).orderBy("line_number").select(encode_record(layout)).collect()]
    assert back == [line, "ab".ljust(75), line]


def test_encode_cuts_and_pads(spark):
    assert spark.range(1).select(encode([(F.lit("abcdef"), 3), (F.lit(None), 2), (F.lit(7), 3)])).first()[0] == "abc  7  "


def test_cutter_keeps_long_fields_whole():
    cutter = Cutter([(0, 200), (200, 202), (202, 300)])
    assert cutter.blocks == [(0, 200), (200, 202), (202, 300)]


def test_request_errors():
    a, b = datetime(2020, 1, 1), datetime(2020, 1, 2)
    assert I.request_error(None, None, False) == "nothing_asked"
    assert I.request_error(a, None, False) == "half_range"
    assert I.request_error(a, b, True) == "range_and_names"
    assert I.request_error(b, a, False) == "range_reversed"
    assert I.request_error(a, b, False) is None and I.request_error(None, None, True) is None


def test_names_are_marked_only_together(spark):
    jobs = spark.createDataFrame(
        [(1, 3, "Success", False, "Not Available", "a.txt"), (2, 3, "Fail", False, "Not Available", "b.txt")],
        "job_key int, feed_id int, status string, complete boolean, file_status string, file_name string",
    )
    one = I.mark_by_names(jobs, 3, spark.createDataFrame([("a.txt",)], "file_name string"))
    assert {r.job_key: r.file_status for r in one.collect()} == {1: "Available", 2: "Not Available"}
    with pytest.raises(ValueError):
        I.mark_by_names(jobs, 3, spark.createDataFrame([("a.txt",), ("b.txt",)], "file_name string"))


def test_both_ways_of_window_lookup_agree(spark, folder, monkeypatch):
    from ferrybook.queries.base import Tables

    t = Tables(spark, folder)
    windows = D.with_windows(t.relation("schedule")).select("schedule_id", "feed_id", "window_start", "window_end")
    points = t.relation("job").select("job_key", "feed_id", "start_ts")

    def found():
        hits = D.in_windows(points, "start_ts", windows, "window_start", "window_end")
        return sorted((r.job_key, r.schedule_id) for r in hits.collect())

    small = found()
    monkeypatch.setattr(D, "broadcast_if_small", lambda df: df)
    assert small and found() == small


def test_batch_number_uses_local_midnight(spark):
    from ferrybook.operators.convert import batch_numbers

    rows = [(1, "Success", "1998-06-15 03:59:59"), (1, "Success", "1998-06-15 04:00:00"), (1, "Fail", "1998-06-15 05:00:00")]
    jobs = spark.createDataFrame(rows, "feed_id int, status string, s string").selectExpr("feed_id", "status", "cast(s as timestamp_ntz) as start_ts")
    feeds = spark.createDataFrame([(1,), (2,)], "feed_id int")
    got = {r.feed_id: r.batch for r in batch_numbers(jobs, feeds, "America/New_York", datetime(1998, 6, 15, 12)).collect()}
    assert got == {1: 2, 2: 1}
    assert date(1998, 6, 15)
