import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from ferrybook.llm import lines
from ferrybook.llm.common import table

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, least=3):
    held = {}
    for k, (i, text) in enumerate(rows):
        for x in {key(line) for line in (text or "").split("\n")}:
            held.setdefault(x, {})[k] = i
    out = []
    for i, text in rows:
        own, kept = (text or "").split("\n"), []
        for line in own:
            ids = held[key(line)]
            real = [x for x in ids.values() if x is not None]
            gone = len(key(line)) >= 20 and len(ids) >= least and real and max(real) != i
            kept += [] if gone else [line]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "'x' as key", "2 as kept", "3 as lost").repartition(3)
    got = lines.dedup_lines(df, **settings).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


A_LINE = "this very line stands in many documents"
ODD = [
    (0, None), (1, ""), (2, "\n"), (3, A_LINE), (4, f"  {A_LINE.upper()}\t\n\nown line of this document only"), (5, f"{A_LINE}\r\n{A_LINE}\n{A_LINE}"),
    (6, A_LINE + "\n" + "ä" * 20), (7, "ä" * 20 + "\n" + "ä" * 19), (8, "ä" * 20 + "\n" + "Ä" * 20), (9, "ä" * 19), (10, "ä" * 19), (11, "short"),
    (12, "short"), (13, "short"), (None, A_LINE), (None, A_LINE), (None, "nobody with an id holds this"), (None, "nobody with an id holds this\n"),
    (None, "x\nnobody with an id holds this"), (14, "twice only and therefore kept\ntwice only and therefore kept"), (15, "twice only and therefore kept"),
    (16, "repeated row with one id\nx"), (16, "repeated row with one id\nx"), (17, "other"), (16, "repeated row with one id\ny"), (-3, "repeated row with one id"),
    (18, "\n".join(f"line number {i} of a long document" for i in range(3000)) + "z" * 100000), (19, "line number 7 of a long document\n" * 500),
    (20, "line number 7 of a long document\n line number 8 of a long document"), (21, " line number 8 of a long document"),
]


@pytest.mark.parametrize("filter_bytes", [lines.FILTER_BYTES, 0])
def test_odd_rows(spark, filter_bytes):
    check(spark, ODD, filter_bytes=filter_bytes)


@pytest.mark.parametrize("filter_bytes", [lines.FILTER_BYTES, 0])
def test_all_documents(spark, folder, filter_bytes):
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    check(spark, docs, filter_bytes=filter_bytes)


def test_many_segments(spark, monkeypatch):
    monkeypatch.setattr(lines, "BITS_PER_LINE", 1 << 18)
    check(spark, [(i, f"{A_LINE} {i % 40} times\n{A_LINE}\nunique line number {i * i}") for i in range(200)])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dedup_lines(df).collect() == [] and lines.dedup_lines(df, filter_bytes=0).collect() == []


@given(st.lists(st.lists(st.integers(0, 60), max_size=40), max_size=6), st.integers(1, 3))
def test_second_filter_misses_no_repeat(parts, segments):
    """Fragments in any number and order: what comes twice is held."""
    word = lambda k: k * 0x9E3779B97F4A7C15 % (1 << 64)
    hashes = [np.array([word(k) for k in p], np.uint64) for p in parts]
    fragments = [lines._fragments(h, segments) for h in hashes if len(h)]
    flat = np.concatenate([*hashes, np.empty(0, np.uint64)])
    twice = {h for h in flat.tolist() if (flat == h).sum() > 1}
    held = [lines._merged((f.filter(pa.array(np.array(f["segment"]) == s)) for f in fragments), s) for s in range(segments)]
    segment, places = lines._bits(flat, segments)
    found = {h for h, s, p in zip(flat.tolist(), segment, places) if held[s][p].all()}
    assert twice <= found and len(found - twice) <= 2


def test_hot_line_sends_few_bits():
    one = np.full(1 << 16, 7, np.uint64)
    made = lines._fragments(one, 4)
    assert made.num_rows == 1 and made.nbytes < 200
    assert hashlib.sha256(made["twice"][0].as_py()).digest() == hashlib.sha256(made["once"][0].as_py()).digest()
