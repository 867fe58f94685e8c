import pytest
from pyspark.sql import functions as F

from ferrybook.operators import export as X
from ferrybook.operators import intake as I
from ferrybook.queries.base import Tables
from ferrybook.queries.export import UPSTREAM
from ferrybook.queries.intake import FROM, TO
from ferrybook.session import new_folder
from ferrybook.sources.tables import Table

SCHEMA = "id bigint, v string, n int"


def table(spark):
    return Table(spark, new_folder(spark, "held"), SCHEMA, ["id"], "pmod(id, 4)", ["v"])


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(held):
    return sorted(tuple(r) for r in held.rows().collect())


def files(spark, held, name="base"):
    return {f.split(f"/{name}/")[1] for f in spark.read.parquet(f"{held.folder}/{name}").inputFiles()}


def test_changes_in_order(spark):
    held = table(spark)
    assert content(held) == [] and held.version() == 0
    held.append("a", frame(spark, *[(i, "x", i) for i in range(8)]))
    held.update("b", frame(spark, (1, "y", None), (2, None, None), (99, "z", None)))
    held.delete("c", frame(spark, (1, None, None), (3, None, None)))
    assert content(held) == [(0, "x", 0), (2, None, 2), (4, "x", 4), (5, "x", 5), (6, "x", 6), (7, "x", 7)]
    held.append("d", frame(spark, (1, "new", 11)))  # an update from before the delete does not come back
    held.update("e", frame(spark, (2, "last", None), (2, "last", None)))
    want = [(0, "x", 0), (1, "new", 11), (2, "last", 2), (4, "x", 4), (5, "x", 5), (6, "x", 6), (7, "x", 7)]
    assert content(held) == want
    held.compact("f")
    assert content(held) == want
    held.reload("g", frame(spark, (2, "r", 5)), held.rows().where("id in (2, 7)").select("id"))
    assert content(held) == [*want[:2], (2, "r", 5), *want[3:6]]


def test_a_repeated_run_changes_nothing(spark):
    held = table(spark)
    for _ in range(2):
        held.append("a", frame(spark, (1, "x", 1)))
        held.delete("none", frame(spark))
        held.compact("b")
    assert content(held) == [(1, "x", 1)] and held.version() == 3


def test_only_touched_parts_are_rewritten(spark):
    held = table(spark)
    held.append("a", frame(spark, *[(i, "x", i) for i in range(40)]))
    held.delete("b", frame(spark, *[(i, None, None) for i in (1, 5)]))
    before = files(spark, held)
    held.compact("c")
    fresh = files(spark, held) - before
    assert fresh and all(f.startswith("part=1/") for f in fresh)
    before = files(spark, held)
    held.compact("d")  # nothing left to do
    assert files(spark, held) == before and len(content(held)) == 38
    held.delete("e", held.rows().where("pmod(id, 4) = 2").select("id"))
    held.compact("f")  # a part without rows
    assert len(content(held)) == 28


@pytest.mark.parametrize("step", ["_put", "_patch", "_commit"])
def test_a_run_that_dies_leaves_nothing(spark, monkeypatch, step):
    held = table(spark)
    held.append("a", frame(spark, *[(i, "x", i) for i in range(6)]))
    with monkeypatch.context() as m:
        whole = getattr(Table, step)

        def dying(self, *args, **kw):
            if step != "_commit":
                whole(self, *args, **kw)
            raise RuntimeError("lost")

        m.setattr(Table, step, dying)
        with pytest.raises(RuntimeError):
            held.reload("b", frame(spark, (1, "lost", 1), (8, "lost", 8)), frame(spark, (1, None, None), (2, None, None)))
    assert [r[1] for r in content(held)] == ["x"] * 6
    held.reload("c", frame(spark, (3, "y", 3)), frame(spark, (3, None, None)))
    assert content(held) == [(i, "y" if i == 3 else "x", i) for i in range(6)]


def test_a_report_follows_its_records(spark):
    held = table(spark)
    report = Table(spark, new_folder(spark, "report"), "id bigint, twice int", ["id"], "pmod(id, 4)")
    seen = []

    def build(rows):
        seen.append(rows.count())
        return rows.select("id", (F.col("n") * 2).alias("twice"))

    def same():
        return content(report) == sorted((i, 2 * n) for i, _, n in content(held))

    held.append("a", frame(spark, *[(i, "x", i) for i in range(40)]))
    report.refresh("1", held, build)
    assert same() and seen == [40]
    held.delete("b", frame(spark, (4, None, None)))
    held.compact("c")
    report.refresh("2", held, build)
    assert same() and seen == [40, 9]
    before = files(spark, report)
    report.refresh("3", held, build)
    assert files(spark, report) == before and seen[-1] == 0 and same()


def test_marks_as_updates_equal_snapshots(spark, folder):
    t = Tables(spark, folder)
    jobs = t.relation("job").select("job_key", "feed_id", "client_id", "file_type", "file_name", "start_ts", "status", "complete", "file_status")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in jobs.schema)
    held = Table(spark, new_folder(spark, "jobs"), kinds, ["job_key"], "pmod(job_key, 4)", ["file_status"])
    held.append("load", jobs)
    pairs = lambda df: sorted(map(tuple, df.select("job_key", "file_status").collect()))
    marked = I.mark_by_time(jobs, 3, FROM, TO)
    held.update("time", I.available_by_time(held.rows(), 3, FROM, TO))
    assert pairs(held.rows()) == pairs(marked) != pairs(jobs)
    days = I.mark_complete_days(marked, t.relation("schedule"))
    held.update("days", I.available_by_days(held.rows(), t.relation("schedule")))
    assert pairs(held.rows()) == pairs(days)

    records = t.record().select("job_key", "line_number", "out_job_key")
    store = Table(spark, new_folder(spark, "records"), "job_key bigint, line_number bigint, out_job_key bigint", X.KEY, "pmod(job_key, 4)", ["out_job_key"])
    store.append("load", records)
    store.update("start", X.initial_marks(store.rows(), t.relation("job"), UPSTREAM))
    every = lambda df: sorted(map(str, df.collect()))
    assert every(store.rows()) == every(X.initialised(records, t.relation("job"), UPSTREAM).select(*records.columns))
