from collections import Counter
from fractions import Fraction
from itertools import islice

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrybook.llm.mixing import bound, exact, mix, schedule, segment, segment_length, shares, tempered, turns


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.floats(0.01, 10), min_size=1, max_size=12))
def test_less_than_one_block_of_deviation(weights):
    parts = shares(weights, 200)
    slots, frame = schedule(parts), sum(parts.values())
    assert Counter(slots) == parts
    done = dict.fromkeys(parts, 0)
    for t, name in enumerate(slots, 1):
        done[name] += 1
        for k, n in done.items():
            assert abs(n * frame - t * parts[k]) < frame


def brute(n, parts, slots, block):
    """(source, rank, epoch) by position, slot after slot."""
    frame, out, used, slot = len(slots), [], dict.fromkeys(parts, 0), 0
    while any(used[k] < n[k] for k in parts):
        name = slots[slot % frame]
        for _ in range(block):
            out.append((name, used[name] % n[name], used[name] // n[name]))
            used[name] += 1
        slot += 1
    return out


def test_matches_the_slot_by_slot_mixture(spark):
    n = {"a": 100, "b": 37, "c": 5}
    rows = [(i, k, "x") for k in n for i in range(n[k])]
    df = spark.createDataFrame(rows, "doc_id long, source string, position string")
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    out = mix(df, weights, block_rows=4, frame=50).orderBy("mixed.position").collect()
    parts = shares(weights, 50)
    want = brute(n, parts, schedule(parts), 4)
    assert [(r.source, r.mixed.epoch) for r in out] == [(k, e) for k, _, e in want]
    assert [r.mixed.position for r in out] == list(range(len(out)))
    ids = {}
    for r, (k, rank, _) in zip(out, want):
        assert ids.setdefault((k, rank), r.doc_id) == r.doc_id  # the same row for the same rank
    assert len(set((r.source, r.doc_id) for r in out)) == len(rows) and out[0].position == "x"


def test_null_sources_repeated_rows_and_missing_weights(spark):
    rows = [(1, None), (1, None), (2, "a"), (None, "a"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    out = mix(df, block_rows=1, frame=12).collect()
    assert Counter((r.doc_id, r.source) for r in out if r.mixed.epoch == 0) == Counter(rows)
    assert sorted(r.mixed.position for r in out) == list(range(len(out)))
    with pytest.raises(ValueError):
        mix(df, {"a": 1.0})
    assert mix(df.limit(0)).collect() == []


def test_a_hot_source_keeps_all_rows(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 20)) as source")
    out = mix(df)
    assert out.select("doc_id").distinct().count() == 3000
    assert out.count() < 6000


def test_tiny_sources_beside_a_hot_one_keep_a_slot(spark):
    parts = shares({"big": 15849, "a": 1, "b": 1})
    assert parts == {"big": 998, "a": 1, "b": 1} and Counter(schedule(parts)) == parts
    df = spark.range(5000).selectExpr("id as doc_id", "if(id < 4995, 'hot', concat('s', id)) as source")
    out = mix(df, {"hot": 1e6, **{f"s{i}": 1.0 for i in range(4995, 5000)}}, frame=1000)
    assert out.select("doc_id").distinct().count() == 5000


def test_less_than_one_block_from_the_target_weights(spark):
    df = spark.range(8002).selectExpr("id as doc_id", "if(id < 8000, 'a', 'b') as source")
    out = mix(df, {"a": 0.9996, "b": 0.0004}, block_rows=1).orderBy("mixed.position").collect()
    assert len({r.doc_id for r in out}) == 8002 and [r.mixed.position for r in out] == list(range(len(out)))
    done = 0
    for t, r in enumerate(out, 1):
        done += r.source == "b"
        assert abs(done - t * Fraction(4, 10000)) < 1


def brute_turns(parts, slots):
    """Earliest deadline first by looking at every source's next block in every slot."""
    frame, given, out = sum(parts), [0] * len(parts), []
    for t in range(slots):
        released = [i for i, a in enumerate(parts) if given[i] * frame // a <= t]
        i = min(released, key=lambda i: (-(-(given[i] + 1) * frame // parts[i]), i))
        given[i] += 1
        out.append(i)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=9))
def test_turns_by_looking_at_every_source(parts):
    assert list(islice(turns(parts, 0, [0] * len(parts)), 300)) == brute_turns(parts, 300)
    # a single segment is the plain schedule
    length = segment_length(parts, 300)
    assert list(segment(parts, 0, length)) == brute_turns(parts, length)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=30), st.integers(1, 60), st.integers(0, 2000))
def test_segments_stay_less_than_a_block_from_the_weights(parts, least, first):
    length, frame = segment_length(parts, least), sum(parts)
    done = bound(parts, first, length)
    for number in range(first, first + 3):
        assert done == bound(parts, number, length)
        slots = list(segment(parts, number, length))
        assert len(slots) == length
        for t, i in enumerate(slots, number * length + 1):
            done[i] += 1
            assert abs(done[i] * frame - t * parts[i]) < frame
            if t % 17 == 0:
                assert all(abs(n * frame - t * a) < frame for n, a in zip(done, parts))


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 3000), min_size=1, max_size=6))
def test_tempered_weights_hold_over_segments(sizes):
    parts = list(exact(tempered(sizes)).values())
    length, total, done = segment_length(parts, 50), sum(parts), [0] * len(parts)
    for number in range(3):
        for t, i in enumerate(segment(parts, number, length), number * length + 1):
            done[i] += 1
            assert abs(done[i] * total - t * parts[i]) < total


def test_many_segments_make_one_mixture(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 20)) as source")
    sizes = Counter(r.source for r in df.collect())
    parts = exact(tempered(sizes))
    out = mix(df, block_rows=2, segment_slots=64).orderBy("mixed.position").collect()
    assert [r.mixed.position for r in out] == list(range(len(out)))
    assert len({r.doc_id for r in out}) == 3000
    done, total = dict.fromkeys(parts, 0), sum(parts.values())
    for t, r in enumerate(out[::2], 1):
        assert r.mixed.block == done[r.source]
        done[r.source] += 1
        assert all(abs(n * total - t * parts[k]) < total for k, n in done.items())
    # it ends with the source that gives its last rows there
    assert done[out[-1].source] == -(-sizes[out[-1].source] // 2)


def test_weights_have_to_be_positive():
    with pytest.raises(ValueError):
        exact({"a": 1.0, "b": 0.0})
