"""Runs over many feeds that know the runs before them."""

import os
import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import rules as E
from ferrybook.operators.catalogue import Rule, RuledColumn
from ferrybook.operators.feeds import FeedPlan, evaluate_feeds, numbered
from ferrybook.operators.intake import current_state, held_files
from ferrybook.operators.layout import Layout
from ferrybook.operators.rule_data import evaluate_from_data, is_plain, rule_table
from ferrybook.plans import inbound
from ferrybook.queries.base import SPEC
from ferrybook.session import new_folder
from ferrybook.sources.store import Store
from ferrybook.streaming import arrivals as A

FEEDS = "feed_id int, per_day int, check_structure boolean, check_details boolean, threshold double"
JOBS = "job_key bigint, feed_id int, file_type string, file_name string, start_ts timestamp_ntz, end_ts timestamp_ntz"
LINE = "job_key bigint, line_number bigint, value string"
DAY = datetime(2020, 3, 1, 8)
LAYOUT = Layout.of("small", ("kind", 0, 2), ("id", 2, 6), ("day", 6, 14), ("clock", 14, 22))


def test_rules_from_data_equal_compiled_rules(spark):
    rng = random.Random(5)
    kinds = "REQUIRED EQUALTO MUST_NOT_EQUAL_TO RANGE BLANK_OR_RANGE REQUIRED_AND_RANGE NUMBER BLANK ALL_ZEROS DATE TIME".split()
    columns = [
        RuledColumn(i, f"It's {i}", f.start, f.end, False, tuple(
            Rule(100 * i + k, k, kind, rng.choice(["", "AB", "0000"]), tuple(rng.sample(["AB", "", "12", "it's"], 2)), error_code=k, error_level=i % 2)
            for k, kind in enumerate(kinds)))
        for i, f in enumerate(LAYOUT.fields)
    ]
    rules = E.RuleSet.of(LAYOUT, columns)
    pool = ["AB", "  ", "0000", "12", "20200229", "20210229", "1200000", "12000000", "\t", " ", "é", "it's", "99999999", "000000001"]
    rows = [(k, 1, "".join(rng.choice(pool) for _ in range(rng.randint(0, 6)))) for k in range(300)]
    lines = spark.createDataFrame(rows, LINE)
    data = evaluate_from_data(lines.withColumn("catalogue", F.lit(3)), rule_table(spark, {3: rules, 4: rules.only(1)}))
    got, want = sorted(map(tuple, data.collect())), sorted(map(tuple, E.evaluate(lines, rules).collect()))
    assert got == want and len(want) == 300 * 44 and {r[3] for r in want} == {"Y", "N"}
    assert is_plain(rules) and not is_plain(R.rule_set())


def test_equal_catalogues_are_one(spark):
    rules = E.RuleSet.of(LAYOUT, [RuledColumn(1, "Id", 2, 6, False, (Rule(1, 1, "REQUIRED"),))])
    plans = {f: FeedPlan(SPEC, replace(rules)) for f in range(1, 6)} | {9: FeedPlan(SPEC, rules.only())}
    catalogues, of_feed = numbered(plans)
    assert len(catalogues) == 2 and of_feed == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 9: 1}
    lines = spark.createDataFrame([(1, 1, "AB12"), (2, 1, "AB  ")], LINE).withColumn("feed_id", F.lit(1)).withColumn("catalogue", F.lit(0))
    one, two = (sorted(map(tuple, evaluate_feeds(lines, plans, n).collect())) for n in (24, 0))
    assert one == two and len(one) == 2


def test_places_of_earlier_runs_are_taken(spark):
    jobs = spark.createDataFrame([(k, 1 + k % 2, "INBOUND", "x", DAY + timedelta(minutes=k), DAY) for k in range(10)], JOBS)
    jobs = jobs.withColumn("status", F.lit("Success"))
    feeds = spark.createDataFrame([(1, 2), (2, 3)], "feed_id int, per_day int")
    used = spark.createDataFrame([(1, DAY.date(), 1), (2, DAY.date(), 3)], "feed_id int, day date, used bigint")
    keys = lambda u: sorted(r.job_key for r in held_files(jobs, feeds, used=u).collect())
    assert keys(None) == [4, 6, 7, 8, 9] and keys(used) == [1, 2, 3, 4, 5, 6, 7, 8, 9]


def lines_of(job, good=True):
    pad = lambda x: x.ljust(R.LINE_LENGTH)
    rows = ["HD0000000007SENDER    HUB       ", "DTDQ", "TR0000000007" + ("0000000001" if good else "0000000002")]
    return [(job, i + 1, pad(v)) for i, v in enumerate(rows)]


class Hub:
    """A hub of two feeds: two files a day, and one whose details are not checked."""

    def __init__(self, spark):
        self.spark, self.store = spark, Store(spark, new_folder(spark, "store"))
        self.feeds = spark.createDataFrame([(1, 2, True, True, 1.0), (2, 2, True, False, 1.0)], FEEDS)
        column = RuledColumn(1, "Kind", 2, 4, False, (Rule(1, 1, "RANGE", values=("DR",), error_code=5),))
        repeat = RuledColumn(6, "Transmission ID", 16, 26), Rule(9, 1, "EXTERNAL", error_code=7)
        self.plans = {f: FeedPlan(SPEC, E.RuleSet.of(R.RECORD, [column]), "transmission_id", repeat) for f in (1, 2)}

    def run(self, name, *files, archive=()):
        """Files are (job, feed, file name, minute, good)."""
        jobs = [(k, f, "INBOUND", n, DAY + timedelta(minutes=m), DAY + timedelta(minutes=m)) for k, f, n, m, _ in files]
        lines = [x for k, _, _, _, good in files for x in lines_of(k, good)]
        done = inbound.run_feeds(
            self.spark.createDataFrame(lines, LINE), self.spark.createDataFrame(jobs, JOBS), self.feeds,
            self.spark.createDataFrame([(a,) for a in archive], "path string"), self.plans, self.store, name,
        )
        return {r.job_key: r.state for r in done.states.collect()}, done

    def rows(self):
        return {t: sorted(map(tuple, self.store.read(t).collect())) for t in ("files", "names", "log")}


def test_states_over_runs(spark):
    hub = Hub(spark)
    first, done = hub.run("r1", (1, 1, "a", 1, True), (2, 1, "in/a", 2, True), (3, 2, "b", 3, True), (4, 1, "bad", 4, False), archive=["old/c"])
    assert first == {1: "Success", 2: "Repeated", 3: "Incomplete", 4: "Fail"}
    assert done.outcomes.count() == 1 and done.alerts.first().alert and done.records["record"].count() == 1
    second = (5, 1, "x/a", 10, True), (6, 1, "c", 11, True), (7, 1, "d", 12, True), (8, 1, "e", 13, True), (9, 2, "f", 14, True), (10, 7, "g", 15, True)
    want = {5: "Repeated", 6: "Repeated", 7: "Success", 8: "Held", 9: "Incomplete", 10: "Unknown"}
    assert hub.run("r2", *second, archive=["old/c"])[0] == want
    before = hub.rows()
    assert hub.run("r2", *second, archive=["old/c"])[0] == want and hub.rows() == before
    assert hub.run("r3", (11, 1, "e", 20, True), (12, 1, "later", 24 * 60, True))[0] == {11: "Repeated", 12: "Success"}
    assert sorted(r.job_key for r in hub.store.read("log").where("step = 'loaded'").collect()) == [1, 7, 12]


def test_a_run_that_died_does_not_count(spark, monkeypatch):
    hub = Hub(spark)
    with monkeypatch.context() as m:
        m.setattr(Store, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            hub.run("r1", (1, 1, "a", 1, True), (2, 1, "b", 2, True))
    assert hub.rows() == {"files": [], "names": [], "log": []}
    assert hub.run("r2", (3, 1, "a", 3, True))[0] == {3: "Success"}
    assert hub.run("r1", (1, 1, "a", 1, True), (2, 1, "b", 2, True))[0] == {1: "Repeated", 2: "Success"}


def test_runs_read_the_days_and_names_at_hand_alone(spark):
    hub = Hub(spark)
    hub.run("r1", (1, 1, "a", 1, True), (2, 1, "b", 24 * 60, True), (3, 1, "c", 48 * 60, True))
    days = hub.store.read("files").where(F.col("day").isin([DAY.date()]))
    assert len(days.inputFiles()) >= 1
    told = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in told and "day#" in told.split("PartitionFilters: [")[1].split("]")[0]


def test_late_receipts_of_a_run(spark):
    hub = Hub(spark)
    schedules = spark.createDataFrame(
        [(1, 1, "INBOUND->HUB", DAY, DAY + timedelta(days=1), 60)],
        "schedule_id int, feed_id int, processing_type string, last_poll timestamp_ntz, next_poll timestamp_ntz, grace_minutes int",
    )
    jobs = spark.createDataFrame([(1, 1, "INBOUND", "a", DAY, DAY + timedelta(minutes=30))], JOBS)
    lines = spark.createDataFrame(lines_of(1), LINE)
    none = spark.createDataFrame([], "path string")
    done = inbound.run_feeds(lines, jobs, hub.feeds, none, hub.plans, hub.store, "r1", schedules, DAY)
    assert [(r.job_key, r.schedule_id) for r in done.late.collect()] == [(1, 1)]
    with pytest.raises(ValueError, match="no name"):
        inbound.run_feeds(lines, jobs, hub.feeds, none, hub.plans, hub.store, "a/b")


def test_job_states_follow_the_log(spark):
    store = Store(spark, new_folder(spark, "store"))
    kinds = "job_key bigint, event_no bigint, step string, state string, records bigint, message string"
    rng, events = random.Random(2), []
    assert store.job_states().count() == 0
    for run in range(4):
        new = [(rng.randint(1, 9), 10 * run + k, f"s{k}", rng.choice("ab"), k, "") for k in range(8)]
        events += new
        store.put("log", spark.createDataFrame(new, kinds), f"r{run}")
        assert store.job_states().count() == len({e[0] for e in events[: 8 * run]}), "not committed yet"
        store.commit(f"r{run}")
        got = sorted(map(tuple, store.job_states().collect()))
        want = {}
        for e in sorted(events, key=lambda e: e[1]):
            want[e[0]] = (e[0], want.get(e[0], (0, 0))[1] + 1, *e[1:])
        assert got == sorted(want.values())
    shown = store._raw("log").where(F.col("run").isin(["r3"]))._jdf.queryExecution().executedPlan().toString()
    assert "run#" in shown.split("PartitionFilters: [")[1].split("]")[0]
    events = spark.createDataFrame([(1, 2, "x"), (1, 2, "y"), (1, 1, "z"), (2, 5, None)], "k int, o bigint, v string")
    assert sorted(map(tuple, current_state(events, "k", "o", ["v"]).collect())) == [(1, 3, 2, "y"), (2, 1, 5, None)]
    assert "SortAggregate" not in current_state(events, "k", "o", ["v"])._jdf.queryExecution().executedPlan().toString()


def test_files_stream_in_with_memory(spark, tmp_path):
    """One file per trigger: splits, holds, repeated names and empty files as in one batch."""
    landing = tmp_path / "landing"
    (landing / "again").mkdir(parents=True)
    text = "\n".join(v for _, _, v in lines_of(1)) + "\n"
    details = text.splitlines(keepends=True)
    big = details[0] + details[1] * 3000 + details[2].replace("0000000001", "0000003000")
    files = [("FEED1_TST_HUB_1.TXT", big), ("FEED1_TST_HUB_2.TXT", text), ("again/FEED1_TST_HUB_1.TXT", text), ("FEED1_TST_HUB_3.TXT", text),
             ("FEED2_TST_HUB_1.TXT", text), ("OTHER.TXT", text), ("FEED1_TST_HUB_0.TXT", ""), ("FEED1_TST_HUB_4.TXT", "short\n")]
    for i, (name, body) in enumerate(files):
        (landing / name).write_text(body)
        os.utime(landing / name, (1_600_000_000 + i, 1_600_000_000 + i))
    feeds = [(1, "FEED1_TST_HUB_YYMMDDHHMMSS", "INBOUND", True, 2, True, True, 1.0), (2, "FEED2_TST_HUB_MMDDYY", "INBOUND", True, 2, True, False, 1.0)]
    kinds = "feed_id int, name_pattern string, feed_type string, is_active boolean, per_day int, check_structure boolean, check_details boolean, threshold double"
    feeds, plans = spark.createDataFrame(feeds, kinds), Hub(spark).plans
    none = spark.createDataFrame([], "path string")
    store = Store(spark, new_folder(spark, "store"), "string")
    settings = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert A.read_lines(spark, [str(landing / files[0][0])]).rdd.getNumPartitions() > 10
        A.stream_inbound(spark, str(landing), feeds, plans, store, none, new_folder(spark, "state"), per_batch=1)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {r.job_key.split("landing/")[1]: r.state for r in store.read("files").collect()}
    assert got == dict(zip((n for n, _ in files), ["Success", "Success", "Repeated", "Held", "Incomplete", "Unknown", "Fail", "Fail"]))
    assert store.runs().count() == 8 and store.read("log").where("records = 3000").count() == 1


def test_a_run_writes_a_file_per_day_and_not_per_task_and_day(spark):
    store = Store(spark, new_folder(spark, "store"))
    rows = spark.range(0, 2000, 1, 8).selectExpr(
        "id as job_key", "1 as feed_id", "'INBOUND' as file_type", "concat('f', id) as file_name", "'Success' as state",
        "cast(timestamp_ntz'2020-01-01 08:00:00' + make_interval(0, 0, 0, cast(id % 120 as int)) as timestamp_ntz) as start_ts",
    ).selectExpr("*", "cast(start_ts as date) as day")
    store.put("files", rows, "one")
    store.commit("one")
    assert store.read("files").count() == 2000
    assert len(spark.read.parquet(store.path("files")).inputFiles()) == 120
