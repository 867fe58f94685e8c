import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ferrybook.operators.sections import record_counts, split_sections
from ferrybook.operators.structure import SpecColumn, StructureSpec, file_findings, numbers, spec_table, verdict
from ferrybook.sources import sinks, text

SPEC = StructureSpec(10, "HD", (0, 2), "TR", (0, 2), (2, 4), (2, 4), (4, 6), (4, 6), (6, 8), "S1", "R1")
HEAD, DETAIL, TAIL = "HD01S1R1  ", "DT        ", "TR01{:02d}    "
SCHEMA = "job_key int, line_number bigint, value string"


def verdicts(spark, files):
    rows = [(k, i + 1, v) for k, lines in files.items() for i, v in enumerate(lines)]
    return {r.job_key: r for r in verdict(spark.createDataFrame(rows, SCHEMA), SPEC).collect()}


def by_hand(lines):
    """The checks as a loop over one file: the first error, or None."""
    trailer = None
    for i, v in enumerate(lines):
        if len(v) != 10:
            return f"Line Number : {i + 1} , Expecting line"
        if i == 0:
            if v[:2] != "HD":
                return "Line Number : 1 , Header identifier"
            if v[4:6].strip() != "S1":
                return "Line Number : 1,  Sender ID"
            if v[6:8].strip() != "R1":
                return "Line Number : 1,  Receiver ID"
        elif v[:2] == "HD":
            return f"Line Number : {i + 1} , Header found"
        elif v[:2] == "TR":
            if trailer is not None:
                return f"Line Number : {i + 1}  ( Trailer),  Another trailer"
            if not v[4:6].isdigit():
                return f"Line Number : {i + 1} (Trailer), Trailer Record Count"
            trailer = v
        elif trailer is not None:
            return f"Line Number : {i + 1} , a detail record was found after"
    if trailer is None:
        return " No trailer"
    if int(trailer[4:6]) != len(lines) - 2:
        return f"Line Number :{len(lines)}  ( Trailer),  Total {len(lines) - 2} records found"
    if trailer[2:4] != lines[0][2:4]:
        return f"Line Number : {len(lines) + 1}  ( Trailer),  Batch"
    return None


def test_verdicts_of_random_files(spark):
    rng = random.Random(7)
    pool = [HEAD, DETAIL, DETAIL, DETAIL, TAIL.format(1), TAIL.format(2), "TR01xx    ", "TR0202    ", "short", "HD01S1XX  "]
    files = {0: [HEAD, DETAIL, TAIL.format(1)], 1: [HEAD, TAIL.format(0)], 2: [HEAD, DETAIL, DETAIL, "TR0202    "]}
    for k in range(3, 400):
        body = [rng.choice(pool) for _ in range(rng.randint(0, 5))]
        start = HEAD if rng.random() < 0.8 else rng.choice(pool)
        files[k] = [start, *body] + ([TAIL.format(len(body))] if rng.random() < 0.6 else [])
    got = verdicts(spark, files)
    for k, lines in files.items():
        want = by_hand(lines)
        if want is None:
            assert (got[k].status, got[k].error_message, got[k].record_count) == ("Success", "", len(lines) - 2), lines
        else:
            assert got[k].status == "Fail" and got[k].error_message.startswith(want), (lines, got[k].error_message)
            assert got[k].record_count == 0


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_of_files_are_hash_aggregates(spark):
    frame = spark.createDataFrame([(1, 1, HEAD)], SCHEMA)
    plans = [executed(x) for x in (numbers(frame, SPEC), verdict(frame, SPEC), file_findings(frame, SPEC, "DT"), record_counts(frame, 4, 6))]
    assert not any("SortAggregate" in p for p in plans)
    assert plans[0].count("Exchange hashpartitioning") == 1 and " Sort " not in plans[0]


def test_specs_in_lines_give_the_verdicts_of_each_spec(spark):
    """Files of three feeds in one scan equal a scan per feed."""
    rng = random.Random(3)
    specs = {1: SPEC, 2: replace(SPEC, sender="S2"), 3: replace(SPEC, line_length=12, header_id="H", header_at=(0, 1), trailer_count=(5, 6))}
    pool = [HEAD, HEAD + "  ", "HD01S2R1  ", DETAIL, DETAIL + "  ", TAIL.format(1), TAIL.format(11) + "  ", "short"]
    rows = [(k, i + 1, rng.choice(pool[:3] if i == 0 else pool)) for k in range(300) for i in range(rng.randint(1, 4))]
    good = {0: [HEAD, DETAIL, TAIL.format(1)], 1: ["HD01S2R1  ", DETAIL, TAIL.format(1)], 2: [HEAD + "  ", DETAIL + "  ", TAIL.format(11) + "  "]}
    rows += [(900 + k, i + 1, v) for k, file in good.items() for i, v in enumerate(file)]
    lines = spark.createDataFrame(rows, SCHEMA).withColumn("feed_id", F.col("job_key") % 3 + 1)
    got = sorted(map(tuple, verdict(lines.join(spec_table(spark, specs), "feed_id"), SpecColumn()).collect()))
    want = [tuple(r) for f, s in specs.items() for r in verdict(lines.where(F.col("feed_id") == f), s).collect()]
    assert got == sorted(want) and len({r[1] for r in got}) == 2


@pytest.mark.parametrize("split", [300, 1000, 100_000])
def test_lines_are_numbered_in_any_split(spark, tmp_path, split):
    sizes = {"a.txt": 250, "b.txt": 1, "c.txt": 90}
    for name, n in sizes.items():
        end = "\r\n" if name == "c.txt" else "\n"
        (tmp_path / name).write_bytes("".join(f"{name}|{i}|é{end}" for i in range(1, n + 1)).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = text.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert len(rows) == sum(sizes.values())
    for r in rows:
        name, number, rest = r.value.split("|")
        assert r.file.endswith(name) and r.line_number == int(number) and rest == "é"


def test_bad_bytes_are_dropped(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"ab\xffcd\n")
    assert text.read_lines(spark, str(tmp_path)).first().value == "abcd"


def test_short_files_have_no_sections(spark):
    frame = spark.createDataFrame([(1, 1, "h"), (1, 2, "t"), (2, 1, "h"), (2, 2, "d"), (2, 3, "t")], SCHEMA)
    got = {(r.job_key, r.line_number): r.section for r in split_sections(frame).collect()}
    assert got == {(2, 1): "header", (2, 2): "detail", (2, 3): "trailer"}


def test_spec_row(spark, tmp_path):
    names = "HEADER TRAILER HEADER_BATCH_ID TRAILER_BATCH_ID TRAILER_RECORD_COUNT SENDER_ID RECEIVER_ID".split()
    head = [f"{n}_POS_{e}" for n in names for e in ("START", "END")] + ["HEADER_IDENTIFIER", "TRAILER_IDENTIFIER", "SENDER_ID_VALUE", "RECEIVER_ID_VALUE"]
    row = ["0", "2", "0", "2", "2", "4", "2", "4", "4", "6", "4", "6", "6", "8", "HD", "TR", "S1", "R1"]
    (tmp_path / "spec.csv").write_text(",".join(head) + "\n" + ",".join(row) + "\n")
    assert StructureSpec.from_row(text.read_spec(spark, str(tmp_path / "spec.csv")), 10) == SPEC


def test_merged_file_is_in_order(spark, tmp_path):
    detail = spark.range(1000).select(F.col("id").alias("k"), F.format_string("D%04d", "id").alias("value")).repartition(7)
    one = lambda v: spark.range(1).select(F.lit(v).alias("value"))
    merged = sinks.merge_sections(one("H"), detail, one("T"), ["k"])
    sinks.write_merged(merged, ["k"], str(tmp_path / "out"))
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert lines == ["H", *[f"D{i:04d}" for i in range(1000)], "T"]


def test_routing_takes_the_pattern_with_the_prefix(spark):
    feeds = spark.createDataFrame(
        [(1, "ERR_TST_AB_MMDDYY", "INBOUND", True), (2, "ERR_TST_ABC_MMDDYY", "OUTBOUND", True)],
        "feed_id int, name_pattern string, feed_type string, is_active boolean",
    )
    names = ["ERR_TST_AB_1.txt", "ERR_TST_ABC_1.txt", "in/ERR_TST_AB_2.txt", "ERR_TST.txt", "NO_NO_NO_1"]
    arrivals = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = {r.file_name: r.route for r in text.with_route(text.route_by_name(arrivals, feeds)).collect()}
    assert got == dict(zip(names, ["process", "not inbound", "process", "unknown", "unknown"]))
