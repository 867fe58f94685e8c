"""Cases that once lost rows, ended a job, or were judged wrongly."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import convert as C
from ferrybook.operators import deadlines as D
from ferrybook.operators import intake as I
from ferrybook.operators import outcomes as O
from ferrybook.operators import rules as E
from ferrybook.operators import structure as S
from ferrybook.operators.catalogue import evaluated
from ferrybook.queries import QUERIES
from ferrybook.queries import convert as QC
from ferrybook.queries import rules as QR
from ferrybook.queries.base import SPEC, Tables
from ferrybook.session import broadcast_if_small, configure, new_folder, plan_bytes, small_table
from ferrybook.streaming import arrivals as A

FILE = "job_key bigint, line_number bigint, value string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def file(job, count="0000000001", sender="SENDER    ", details=1):
    pad = lambda x: x.ljust(R.LINE_LENGTH)
    rows = [pad("HD" + "0000000007" + sender + "HUB       ")] + [pad("DT")] * details + [pad("TR0000000007" + count)]
    return [(job, i + 1, v) for i, v in enumerate(rows)]


def verdicts(spark, rows, listing=None):
    return {r.job_key: (r.status, r.error_message) for r in S.verdict(spark.createDataFrame(rows, FILE), SPEC, listing=listing).collect()}


def test_a_count_beyond_a_long_fails_one_file_alone(spark):
    from dataclasses import replace

    wide = replace(SPEC, trailer_count=(12, 40))
    rows = file(1) + file(2, count="9" * 28)
    rows = [(j, n, v if n < 3 or j == 2 else v[:12] + "1".zfill(28) + v[40:]) for j, n, v in rows]
    got = {r.job_key: r.status for r in S.verdict(spark.createDataFrame(rows, FILE), wide).collect()}
    assert got == {1: "Success", 2: "Fail"}


def test_files_without_lines_have_a_verdict(spark):
    listing = spark.createDataFrame([(1,), (2,)], "job_key bigint")
    got = verdicts(spark, file(1), listing)
    assert got[1][0] == "Success" and got[2][0] == "Fail" and got[2][1]


def test_white_space_around_a_sender(spark):
    assert verdicts(spark, file(1, sender="SENDER\t   "))[1][0] == "Success"


def test_a_feed_without_files_per_day_holds_all(spark):
    jobs = spark.sql("select 1L job_key, 1 feed_id, 'INBOUND' file_type, 'Success' status, timestamp_ntz'2020-01-01 00:00:00' start_ts")
    feeds = spark.createDataFrame([(1, 0), (2, 1)], "feed_id int, per_day int")
    assert [r.job_key for r in I.held_files(jobs, feeds).collect()] == [1]


def test_what_can_not_be_converted_is_blank_and_reported(spark):
    amount = C.Mapping(1, "Detail", "CUSTOM", 6, source=(1, 6), formula="cap_amount", arguments=(100, 100, 6))
    rest = C.Mapping(2, "Detail", "COPY_AS_IS", 3, source=(7, 9))
    rows = spark.createDataFrame([("-00012abc", 1, 1), ("12a456def", 2, 1), ("000050ghi", 3, 1), (None, 4, 1)], "value string, number int, batch int")
    as_of = datetime(2020, 1, 1)
    got = {r.number: r.value for r in C.standard_rows(rows, [amount, rest], "Detail", as_of, ["number"]).collect()}
    assert got == {1: "      abc", 2: "      def", 3: "000050ghi", 4: "         "}
    errors = C.conversion_errors(rows, [amount, rest], "Detail", as_of, ["number"]).collect()
    assert sorted((r.number, r.mapping_id) for r in errors) == [(1, 1), (2, 1), (4, 1)]


def test_mappings_go_through_a_table(spark, folder):
    assert C.compile_mappings(QC.mapping_table(Tables(spark, folder)), QC.FEED) == sorted(QC.MAPPINGS, key=lambda m: m.mapping_id)


def test_rules_go_through_tables_custom_included(spark, folder):
    compiled = QR.compiled_rules(Tables(spark, folder))
    assert list(compiled.columns) == evaluated(R.ruled_columns())
    assert any(r.custom for c in compiled.columns for r in c.rules)


def test_window_sums_equal_pairs(spark, folder):
    t = Tables(spark, "/root/testdata/sf0.01")
    windows = D.with_windows(t.relation("schedule")).select("schedule_id", "feed_id", "window_start", "window_end")
    points = t.relation("job").select("feed_id", "start_ts", F.lit(2).cast("bigint").alias("n"))
    pairs = D.in_windows(points, "start_ts", windows, "window_start", "window_end").groupBy("schedule_id").agg(F.sum("n").alias("n"))
    sums = D.window_sums(points, "start_ts", "n", windows, "window_start", "window_end")
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, pairs.collect())) != []
    odd = spark.sql("""select 1 schedule_id, 1 feed_id, timestamp_ntz'2020-01-02 00:00:00' a, timestamp_ntz'2020-01-01 00:00:00' b
      union all select 2, 1, timestamp_ntz'2020-01-01 00:00:00', timestamp_ntz'2020-01-01 00:00:00'
      union all select 3, 1, timestamp_ntz'2019-12-30 05:00:00', timestamp_ntz'2020-01-03 00:00:00'""")
    points = spark.sql("select 1 feed_id, timestamp_ntz'2020-01-01 00:00:00' at, 5L n union all select 1, timestamp_ntz'2020-01-02 01:00:00', 7L")
    got = {r.schedule_id: r.n for r in D.window_sums(points, "at", "n", odd, "a", "b").collect()}
    assert got == {2: 5, 3: 12}


def test_many_windows_of_one_day_meet_no_points(spark):
    points = spark.range(20000).selectExpr(
        "cast(id % 3 as int) feed_id", "timestampadd(SECOND, cast(id * 37 % 200000 as int), timestamp_ntz'2020-01-01 00:00:00') at", "id % 5 n"
    )
    windows = spark.range(5000).selectExpr(
        "id schedule_id", "cast(id % 4 as int) feed_id", "timestampadd(SECOND, cast(id * 7 % 86400 as int), timestamp_ntz'2020-01-01 00:00:00') a",
        "timestampadd(SECOND, cast(id * 7 % 86400 + id % 9000 as int), timestamp_ntz'2020-01-01 00:00:00') b",
    )
    for keys in (["feed_id"], []):
        sums = D.window_sums(points, "at", "n", windows, "a", "b", keys=keys)
        on = "at between a and b" + "".join(f" and p.{k} = w.{k}" for k in keys)
        pairs = spark.sql(f"select schedule_id, sum(n) n from {{p}} p join {{w}} w on {on} group by 1 having sum(n) > 0", p=points, w=windows)
        assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, pairs.collect()))
        told = plan(sums)
        assert "NestedLoop" not in told and "Cartesian" not in told and "BETWEEN" not in told.upper()


def test_late_receipts_are_inbound_and_stuck_feeds_alert_once(spark, folder):
    late = QUERIES["sla_late_receipt"](spark, "/root/testdata/sf0.01")
    kinds = {r.schedule_id: r.processing_type for r in Tables(spark, folder).relation("schedule").collect()}
    rows = late.collect()
    assert rows and {kinds[r.schedule_id] for r in rows} == {"INBOUND->HUB"}
    alerts = QUERIES["sla_alerts"](spark, "/root/testdata/sf0.01").collect()
    missed = [r.schedule_id for r in alerts if r.alert_type in ("inbound missing", "stuck file")]
    assert len(missed) == len(set(missed)) and any(r.alert_type == "late receipt" for r in alerts)


def test_no_sort_where_numbers_are_enough(spark, folder):
    t = Tables(spark, folder)
    lines, rules = t.relation("line"), R.rule_set()
    failures = E.evaluate(lines, rules, failures_only=True)
    assert "SortAggregate" not in plan(O.top_errors(failures, O.rule_meta(spark, R.ruled_columns())))
    assert "SortAggregate" not in plan(E.first_values(lines, rules.role("first_value")))


def test_sizes_decide_broadcasts(spark):
    few = small_table(spark, [(1, "a"), (2, None)], "k int, v string")
    assert plan_bytes(few) < 1000 and few.collect()[1].v is None
    big = spark.range(1000).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    assert "BroadcastHashJoin" not in plan(big.join(broadcast_if_small(spark.createDataFrame(big.rdd, big.schema), 1000).hint("merge"), "id"))
    assert "BroadcastHashJoin" in plan(big.join(broadcast_if_small(few.withColumnRenamed("k", "id")), "id"))


def test_a_callers_session_keeps_its_settings(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.codegen.maxFields", "spark.sql.shuffle.partitions")}
    configure(spark)
    assert before == {k: spark.conf.get(k) for k in before}


def test_feeds_without_deadline_are_never_late(spark):
    arrivals = spark.sql("select 1 feed_id, timestamp'2020-01-01 10:00:00' ts union all select 2, timestamp'2020-01-01 10:00:00'")
    deadlines = spark.createDataFrame([(1, 60)], "feed_id int, deadline_minutes int")
    assert {r.feed_id: r.late for r in A.late_arrivals(arrivals, deadlines, "ts").collect()} == {1: True, 2: False}


def test_one_file_per_trigger_equals_one_batch(spark):
    folder = new_folder(spark, "texts")
    os.makedirs(folder.removeprefix("file:"))
    for job in range(4):
        lines = [v for _, _, v in file(job, count="0000000002" if job == 2 else "0000000001")]
        with open(f"{folder.removeprefix('file:')}/{job}.txt", "w") as out:
            out.write("\n" if job == 3 else "\n".join(lines) + "\n")

    def run(files):
        paths = [new_folder(spark, n) for n in ("verdicts", "outcomes", "state")]
        A.intake(files, SPEC, R.rule_set(), *paths).awaitTermination()
        told = sorted((r.job_key[-5:], r.status, r.error_message) for r in spark.read.parquet(paths[0]).collect())
        return told, spark.read.parquet(paths[1]).count()

    got = run(A.whole_files(spark, folder, 1))
    assert got == run(A.whole_files(spark, folder)) and got[1] > 0
    assert [s for _, s, _ in got[0]][:3] == ["Success", "Success", "Fail"] and len(got[0]) == 4


def test_a_file_in_two_rows_is_refused(spark):
    path = new_folder(spark, "twice")
    spark.createDataFrame([(1, "a"), (1, "b")], "job_key bigint, text string").write.parquet(path)
    files = spark.readStream.schema("job_key bigint, text string").parquet(path)
    with pytest.raises(Exception, match="more than one row"):
        A.intake(files, SPEC, R.rule_set(), *[new_folder(spark, n) for n in "abc"]).awaitTermination()
