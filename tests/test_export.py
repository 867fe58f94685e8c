import pytest
from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import export as X
from ferrybook.operators import history as H
from ferrybook.plans import outbound
from ferrybook.queries import QUERIES
from ferrybook.queries.base import Tables
from ferrybook.queries.export import BUSINESS, LENGTH, MOMENT, PARTIES, exported, fields, for_client
from ferrybook.session import new_folder
from ferrybook.sources.ledger import SentLedger


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_row_per_key_leaves_a_task(spark, folder):
    t = Tables(spark, folder)
    dedup = plan(X.first_per_business_key(for_client(t), BUSINESS, ["service_date"]))
    newest = plan(H.latest_crosswalk(t.relation("crosswalk"), ["carrier", "account", "group_id"], "term_date", "version"))
    for text in (dedup, newest):
        partial = text.rindex("WindowGroupLimit")
        assert text.index("Exchange hashpartitioning") < partial, "one limit stands below the shuffle"


def test_trailer_counts_details_and_marks_agree(spark, folder):
    t = Tables(spark, folder)
    export = exported(t)
    n = export.details(fields()).count()
    assert n > 0 and int(export.trailer().first().value[49:59]) == n
    before = t.record()
    after = X.marked_sent(before, export.exported, 77)
    assert after.where(F.col("out_job_key") == 77).count() == n and after.count() == before.count()
    again = X.marked_sent(after, export.exported.limit(0), 78)
    assert again.where(F.col("out_job_key") == 77).count() == n


def test_sorted_like_a_timestamp(spark):
    rows = spark.createDataFrame([("20200101", "23000000"), ("20200101", "1a000000"), ("20200102", "00000001")], "d string, t string")
    keys = [r[0] for r in rows.select(X.sent_order(F.col("d"), F.col("t")).alias("k")).orderBy("k").collect()]
    assert keys == ["20200101000000", "2020010123000000", "2020010200000001"]


def test_no_query_runs_python_on_rows(spark, folder):
    for name in ("rule_results", "export_file", "structure_verdict", "history_union", "standard_file", "view_tagged"):
        text = plan(QUERIES[name](spark, folder))
        assert "Python" not in text and "ArrowEval" not in text, name


def test_layout_length():
    assert R.LINE_LENGTH == 133 and len(R.rule_set().columns) == 38


class Exports:
    """Exports of four records whose upstream file is job 5."""

    def __init__(self, spark):
        self.spark, self.ledger = spark, SentLedger(spark, new_folder(spark, "ledger"))
        columns = "job_key bigint, line_number bigint, service_date string, transmission_time string, tag string"
        self.records = spark.createDataFrame([(5, k, "20200101", "10000000", "x") for k in range(4)], columns)

    def run(self, name, job=10, records=None):
        spark = self.spark
        return outbound.run_export(
            self.ledger, name, spark.createDataFrame([(False,)], "create_empty boolean"), spark.createDataFrame([(50,)], "job_key bigint"),
            self.records if records is None else records, {}, PARTIES, MOMENT, LENGTH, [(F.col("tag"), 3)], job,
            spark.createDataFrame([(k,) for k in range(10, 20)], "job_key bigint"),
        )

    def sent(self):
        return sorted((r.job_key, r.line_number, r.out_job_key) for r in self.ledger.sent().collect())


@pytest.mark.parametrize("step", ["intend", "clash", "write_merged", "commit"])
def test_an_export_that_dies_anywhere_sends_each_record_once(spark, monkeypatch, step):
    exports = Exports(spark)
    with monkeypatch.context() as m:
        m.setattr(outbound if step == "write_merged" else SentLedger, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            exports.run("a")
    assert exports.sent() == []
    whole = step == "commit"
    if step != "intend":
        assert exports.run("b", 11) == (None, 0), "an open intent keeps its records"
        assert exports.ledger.recover() == {"a": "committed" if whole else "dropped"}
    path, n = exports.run("c", 12)
    assert (path, n) == ((None, 0) if whole else (exports.ledger.file_of("c"), 4))
    assert exports.sent() == [(5, k, 10 if whole else 12) for k in range(4)]
    assert spark.read.text(exports.ledger.file_of("a" if whole else "c")).count() == 6
    if not whole:
        assert exports.run("c", 12) == (path, 4), "a committed run gives its file again"


def test_a_run_takes_up_its_own_intent(spark, monkeypatch):
    exports = Exports(spark)
    with monkeypatch.context() as m:
        m.setattr(SentLedger, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            exports.run("a")
    assert exports.run("a") == (exports.ledger.file_of("a"), 4) and len(exports.sent()) == 4


def test_of_two_exports_at_once_one_goes_back(spark, monkeypatch):
    exports = Exports(spark)
    taken = SentLedger.taken
    with monkeypatch.context() as m:
        # both have looked before either wrote its intent
        m.setattr(SentLedger, "taken", lambda self, run: taken(self, run).limit(0))
        exports.ledger.intend("a", X.sent_rows(exports.records.where("line_number < 2"), 10), 2)
        with pytest.raises(outbound.Clash):
            exports.run("b", 11)
        assert exports.run("0", 12)[1] == 4, "the smaller name goes first"
    assert exports.ledger.clash("a")
