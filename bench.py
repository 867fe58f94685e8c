"""Times the headline queries and prints one JSON line.

The derived lines, files and records are written once before the clock starts, the way a hub finds
its files; what is timed is the operator over them, into the no-op sink. ``BENCH_SF_DIR`` names the
tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs after one warm-up (the median
counts).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from ferrybook.fixtures import relations as R
from ferrybook.operators import deadlines as D
from ferrybook.operators import export as X
from ferrybook.operators import history as H
from ferrybook.operators import outcomes as O
from ferrybook.operators import rules as E
from ferrybook.operators import structure
from ferrybook.operators.layout import encode_record, parse
from ferrybook.queries.base import LOADED, SPEC, Tables
from ferrybook.queries.export import BUSINESS, DEFAULTS, LENGTH, MOMENT, PARTIES, UPSTREAM, fields
from ferrybook.plans.outbound import Export
from ferrybook.session import build, new_folder


def stored(df, parts: int):
    path = new_folder(df.sparkSession, "bench")
    df.repartition(parts).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus})
    t = Tables(spark, folder)
    parts = 2 * int(cpus)
    lines, files = stored(t.relation("line"), parts), stored(t.relation("file"), parts)
    jobs, history = stored(t.relation("job"), parts), stored(t.relation("history"), parts)
    feeds, crosswalk = t.relation("feed"), stored(t.relation("crosswalk"), parts)
    rules, wide = R.rule_set(), stored(t.relation("wide_line"), parts)
    outcomes = stored(E.evaluate(E.with_first_value(lines, rules), rules, failures_only=True), parts)
    meta = O.rule_meta(spark, R.ruled_columns())

    def records():
        return parse(lines, R.RECORD).selectExpr("*", *LOADED)

    def export_file():
        eligible = X.eligible_for_upstream(records(), jobs, feeds, O.level_one(outcomes, meta), UPSTREAM)
        chosen = X.with_defaults(X.first_per_business_key(eligible, BUSINESS, ["service_date"]), DEFAULTS)
        return Export.of(chosen, PARTIES, MOMENT, LENGTH).file(fields(), create_empty=True)

    keys = ["carrier", "account", "group_id"]
    queries = {
        "fixed_width_parse": lambda: parse(lines, R.RECORD),
        "fixed_width_encode": lambda: parse(lines, R.RECORD).select(encode_record(R.RECORD).alias("value")),
        "rule_results": lambda: E.evaluate(lines, rules),
        "rule_results_wide": lambda: E.evaluate(wide, R.wide_rule_set()),
        "rule_failures": lambda: E.evaluate(lines, rules, failures_only=True),
        "structure_verdict": lambda: structure.verdict(files, SPEC),
        "dup_transmission": lambda: O.duplicate_ids(records(), "transmission_id", 61, "17:26", 12, 1),
        "top_error_per_line": lambda: O.top_errors(outcomes, meta),
        "export_file": export_file,
        "amount_split": lambda: H.split_amounts(H.decoded(history)),
        "history_union": lambda: H.detail_lines(H.with_new_ids(H.decoded(history), crosswalk, keys, "term_date", "version")),
        "sla_inbound": lambda: D.sla_met(jobs, "start_ts", t.relation("schedule")),
        "sla_inbound_book": lambda: D.sla_met(jobs, "start_ts", t.relation("schedule_book")),
        "threshold_alert": lambda: O.threshold_alerts(
            O.error_line_counts(outcomes, jobs), lines.groupBy("job_key").agg(F.count(F.lit(1)).alias("detail_lines")), jobs, feeds
        ),
    }
    seconds = {}
    for name, query in queries.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "sum of median query times", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
