"""What must not grow with the data: texts built twice, wide sorts, broadcasts of a stream, files of one task."""

from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.fixtures.dialect import Dialect
from ferrybook.functions.text import length_sql
from ferrybook.operators import rules as E
from ferrybook.operators import structure as S
from ferrybook.operators.layout import ByteCutter
from ferrybook.plans import inbound
from ferrybook.queries.base import SPEC, Tables
from ferrybook.queries.rules import ALL
from ferrybook.queries.streams import a_task_each
from ferrybook.session import broadcast_if_small, new_folder, plan_bytes, settle
from ferrybook.streaming import arrivals
from ferrybook.streaming.arrivals import numbered as S_numbered


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def lines(spark, jobs=6, details=5, count=None):
    rows = []
    for j in range(1, jobs + 1):
        rows.append((j, 1, "HD0000000001SENDER    HUB       ".ljust(R.LINE_LENGTH)))
        rows += [(j, 2 + n, "DTDQ".ljust(R.LINE_LENGTH)) for n in range(details)]
        n = details if j != 3 else details + 1  # the third file miscounts
        rows.append((j, 2 + details, f"TR0000000001{n:010d}".ljust(R.LINE_LENGTH)))
    return spark.createDataFrame(rows, "job_key bigint, line_number bigint, value string")


def test_a_filter_does_not_build_lines_again(spark, folder):
    found = plan(Tables(spark, folder).record().where("file_type = 'DQ' and transmission_id is not null"))
    assert found.count("concat(DT") == 1


def test_slots_from_the_list_equal_the_strip(spark):
    d, strip = Dialect(True), R.slot_strip()
    places = spark.range(-3, R.STRIP_SLOTS).selectExpr("id as at", "explode(sequence(-1, 12)) as filled")
    got = places.selectExpr("at", "filled", f"{R._slots(d, 'at', 'filled')} as text", f"substring('{strip}', cast(1 + 6 * at as int), 6 * filled) as want")
    assert got.count() and not got.where("text is distinct from want").count()
    nothing = spark.range(1).selectExpr(f"{R._slots(d, 'cast(null as bigint)', '3')} as text").first()
    assert nothing.text is None


def test_outcomes_are_sorted_as_lines(spark, monkeypatch):
    written = []
    monkeypatch.setattr(inbound, "write_outcomes", lambda df, path, write=inbound.write_outcomes: (written.append(plan(df)), write(df, path)))
    rows = lines(spark).where("line_number between 2 and 6").repartition(3, "line_number")
    column, rule = ALL[61]
    loaded = inbound.load(rows, R.rule_set(), "transmission_id", rule, column.report_position)
    above, below = written[0].split("Generate", 1)
    assert "Sort" not in above and "Sort" in below
    for table in (loaded.records, loaded.outcomes):
        by_file = {}
        for r in table.select(F.col("_metadata.file_name").alias("f"), "job_key", "line_number").collect():
            by_file.setdefault(r.f, []).append((r.job_key, r.line_number))
        assert by_file and all(keys == sorted(keys) for keys in by_file.values())


def test_a_spread_verdict_broadcasts_nothing(spark):
    rows = lines(spark)
    told = S.verdict(rows, SPEC, listing=rows.select("job_key").distinct(), spread=True)
    assert "BroadcastHashJoin" not in told._jdf.queryExecution().executedPlan().toString()
    first = E.with_first_value(rows, R.rule_set(), spread=True)
    assert "BroadcastHashJoin" not in first._jdf.queryExecution().executedPlan().toString()
    key = lambda r: r.job_key
    assert sorted(told.collect(), key=key) == sorted(S.verdict(rows, SPEC, listing=rows.select("job_key").distinct()).collect(), key=key)


def test_plain_files_are_not_looked_up(spark, monkeypatch):
    looked_up, with_texts = [], S.with_texts

    def counted(rows, files, *rest, **kw):
        looked_up.extend(r.job_key for r in files.collect())
        return with_texts(rows, files, *rest, **kw)

    monkeypatch.setattr(S, "with_texts", counted)
    assert [r.job_key for r in S.check_files(lines(spark), SPEC, S.COUNT_ERROR).collect()] == [3]
    assert looked_up == [3]


def test_one_level_of_rules_equals_the_filtered_whole(spark, folder):
    rules = R.rule_set()
    rows = E.with_first_value(Tables(spark, folder).relation("line"), rules)
    hard = [r.rule_id for c in rules.columns for r in c.rules if r.error_level == 1]
    want = E.evaluate(rows, rules, failures_only=True).where(F.col("rule_id").isin(hard))
    got = E.evaluate(rows, rules, failures_only=True, level=1)
    assert want.count() and not got.exceptAll(want).count() and not want.exceptAll(got).count()


def test_a_task_has_one_file(spark):
    rows = spark.range(250).selectExpr("id % 25 as k", "2 as part", "id as a", "0 as b", "'x' as value")
    tasks = a_task_each(rows, 25).select("k", F.spark_partition_id().alias("task")).distinct()
    assert tasks.count() == 25 and tasks.select("task").distinct().count() == 25


def test_a_side_is_broadcast_by_its_rows_in_memory(spark):
    keys = settle(spark.range(0, 300_000, 1, 2).selectExpr("id as job_key", "cast(1 as int) as feed_id"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    limit = 8 << 20
    assert plan_bytes(keys) < limit < 300_000 * 40  # the files are smaller than what they unpack to
    assert not hinted(broadcast_if_small(keys, limit))
    assert not hinted(broadcast_if_small(keys.groupBy("job_key").agg(F.max("feed_id").alias("feed_id")), limit))
    assert hinted(broadcast_if_small(keys.where("job_key < 1000"), limit))
    assert hinted(broadcast_if_small(keys.groupBy("feed_id").count(), limit))


def test_lines_of_whole_files_are_split_as_by_a_pattern(spark):
    texts = ["a\r\nb\n", "a\r\r\nb\r", "\n", "\r\n", "\n\n", "a", "a\r", "é\r\nü\r\n", "\r", "a\n\r\n", "a\r\n\r", "", None]
    files = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "job_key int, text string")
    want = files.where(F.length("text") > 0).select("job_key", F.posexplode(F.split(F.regexp_replace("text", r"\r?\n\z", ""), r"\r?\n")))
    assert sorted(map(tuple, S_numbered(files).collect())) == sorted((r.job_key, r.pos + 1, r.col) for r in want.collect())


def dealt_again(text):
    """Shuffles of a plan that stand above a scan of whole lines, stored relations left out."""
    rows, found = [(len(x) - len(x.lstrip(" :+-*(0123456789)")), x) for x in text.split("\n")], []
    for i, (depth, row) in enumerate(rows):
        if "Exchange" in row:
            inside = next((k for k in range(i + 1, len(rows)) if rows[k][0] <= depth), len(rows))
            found += [row for _, x in rows[i + 1 : inside] if "value#" in x][:1]
    return found


def test_a_batch_of_the_stream_shuffles_its_lines_once(spark, monkeypatch):
    shuffles = []

    def counted(df, *rest, **kw):
        found = dealt_again(df._jdf.queryExecution().executedPlan().toString())
        shuffles.append([x for x in found if "SinglePartition" not in x and "repartition" not in x.lower()])
        return evaluate(df, *rest, **kw)

    evaluate = arrivals.evaluate
    monkeypatch.setattr(arrivals, "evaluate", counted)
    first = lines(spark, 9).groupBy("job_key").agg(F.array_join(F.sort_array(F.collect_list(F.struct("line_number", "value")))["value"], "\n").alias("text"))
    path, verdicts, outcomes, state = (new_folder(spark, n) for n in ("files", "verdicts", "outcomes", "state"))
    first.write.parquet(path)
    files = spark.readStream.schema("job_key bigint, text string").parquet(path)
    arrivals.intake(files, SPEC, R.rule_set(), verdicts, outcomes, state).awaitTermination()
    assert shuffles == [[]]
    status = {r.job_key: r.status for r in spark.read.parquet(verdicts).collect()}
    assert status == {j: "Fail" if j == 3 else "Success" for j in range(1, 10)}
    told = spark.read.parquet(outcomes).where("rule_id = 10").groupBy("job_key").count().collect()
    assert {r.job_key: r["count"] for r in told} == {j: 5 for j in range(1, 10) if j != 3}


def test_narrow_lines_are_told_without_counting_characters(spark):
    rows = [("x" * 40,), ("x\x01" * 20,), ("é" * 40,), ("",), (None,), ("y" * 39 + "\x7f",)]
    given = spark.createDataFrame(rows, "value string")
    cut = ByteCutter([(0, 5), (5, 30)])
    told = cut.measured(given)
    assert "char_length" not in plan(told) and " length(" not in plan(told)
    blocks = told.selectExpr("value", *cut.block_columns()).selectExpr("value", f"{cut.field(0, 5)} as a", f"{cut.field(5, 30)} as b")
    assert blocks.where("a is distinct from substring(value, 1, 5) or b is distinct from substring(value, 6, 25)").count() == 0
    assert given.where(f"{length_sql('value')} is distinct from length(value)").count() == 0


def test_wide_lines_equal_the_plain_text(spark, folder):
    wide = Tables(spark, folder).relation("wide_line")
    assert "length(made" not in plan(wide).replace("octet_length", "")
    section = "rpad(substring(value, 17, 10), 10, ' ') || rpad(substring(value, 29, 10), 10, ' ') || substring(value, 9, 8) || '  '"
    got = wide.selectExpr("length(value) as n", f"substring(value, 134, 30) = {section} as same", "substring(value, 134, 130) = substring(value, 1564, 130) as last")
    assert [tuple(r) for r in got.distinct().collect()] == [(R.WIDE_LENGTH, True, True)]
