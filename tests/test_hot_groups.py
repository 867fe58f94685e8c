"""One key holds most rows; results against plain loops, with and without a broadcast."""

import random
from datetime import datetime, timedelta

import pytest

from ferrybook import session
from ferrybook.operators import export as X
from ferrybook.operators import intake as I


@pytest.fixture(params=["broadcast", "shuffle"])
def side(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(session.broadcast_if_small, "__defaults__", (0,))
    return request.param


def test_holds_of_a_hot_feed(spark, side):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = [
        (k, 1 if rng.random() < 0.7 else rng.randint(2, 4), "INBOUND", rng.choice(["Success", "Fail", "Running"]),
         start + timedelta(minutes=rng.randint(0, 3000)))
        for k in range(600)
    ]
    jobs = spark.createDataFrame(rows, "job_key int, feed_id int, file_type string, status string, start_ts timestamp_ntz")
    allowed = {1: 5, 2: 1, 3: 12, 4: 2}
    feeds = spark.createDataFrame(list(allowed.items()), "feed_id int, per_day int")
    got = {r.job_key for r in I.held_files(jobs, feeds, exempt=(3,)).collect()}
    want, seen = set(), {}
    for k, f, _, status, at in sorted(rows, key=lambda r: (r[4], r[0])):
        if status == "Fail" or f == 3:
            continue
        seen[f, at.date()] = seen.get((f, at.date()), 0) + 1
        if seen[f, at.date()] > allowed[f]:
            want.add(k)
    assert want and got == want


def test_first_of_a_hot_business_key(spark):
    rng = random.Random(5)
    rows = [(j, n, "hot" if rng.random() < 0.6 else f"k{n % 7}", f"{rng.randint(1, 9)}") for j in range(20) for n in range(2, 30)]
    records = spark.createDataFrame(rows, "job_key bigint, line_number bigint, k string, day string").repartition(9)
    got = {(r.k, r.job_key, r.line_number) for r in X.first_per_business_key(records, ["k"], ["day"]).collect()}
    first = {}
    for j, n, k, day in rows:
        first[k] = min(first.get(k, (day, j, n)), (day, j, n))
    assert got == {(k, j, n) for k, (_, j, n) in first.items()}
