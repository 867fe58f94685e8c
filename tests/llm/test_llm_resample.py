import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from ferrybook.llm import resample
from ferrybook.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def runs(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, targets):
    made = [(i, *runs(t)) for i, t in docs]
    s, t = Counter(f for _, _, fs in made for f in fs), Counter(f for x in targets for f in runs(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for i, words, fs in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[f] for f in fs)
        out.append((i, len(words), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = able[: 5 * len(able) // 100]
    return out, ranks


def check(spark, docs, targets, **settings):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "'x' as score", "2 as rank", "3 as digest").repartition(4)
    aim = spark.createDataFrame([(t,) for t in targets], "text string")
    got = resample.resample(df, aim, **settings).collect()
    out, ranks = brute(docs, targets)
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(out, key=str)
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, len(ranks) + 1))
    assert [(r.doc_id, r.score) for r in drawn] == [(r[0], r[4]) for r in ranks]
    return drawn


@pytest.mark.parametrize("error", [resample.SKETCH_ERROR, 0.2])
def test_all_documents(spark, folder, error):
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    targets = [r.text for r in table(spark, folder, "benchmark").select("text").collect()]
    assert check(spark, docs, targets, error=error)


LONG = "one two three four five six seven eight nine ten " * 3
ODD = [
    (0, None), (1, ""), (2, "a"), (3, "a b"), (4, "İstanbul ÄÖ éa 漢字 x1y2 \x00 _under_score-d"), (5, "w" * 70000 + " b " + "v" * 300), (6, LONG),
    (7, LONG.upper()), (None, LONG), (None, LONG), (8, LONG), (8, LONG), (8, LONG + "x"), (9, "x " * 19), (10, "x " * 20), (11, "y" * 64 + " " + "z" * 65 + " a" * 30),
]


def test_odd_rows(spark):
    check(spark, ODD, [None, "", "one two three", "a b c"])
    check(spark, ODD + [(100 + i, LONG) for i in range(90)], ["seven eight"])
    check(spark, ODD, [])


def test_ties(spark):
    """Rows of one id have one noise, so equal texts tie; smaller ids go first."""
    check(spark, [(i // 9, LONG) for i in range(400)], [LONG])


def test_bracket_is_widened_until_it_holds_the_cutoff(spark):
    class Skewed:
        """Rows whose sketch is far off."""

        def __init__(self, df):
            self.df, self.asked = df, 0

        def approxQuantile(self, *args):
            self.asked += 1
            return [1.0, 2.0] if self.asked == 1 else self.df.approxQuantile(*args)

        def agg(self, *columns):
            return self.df.agg(*columns)

    rows = Skewed(spark.range(1000).selectExpr("id as score"))
    low, high, above = resample.bracket(rows, 50, 1000)
    assert rows.asked > 1 and above < 50 <= 1000 - low and above == 999 - high and high - low < 1000


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(df, df).collect() == []


def test_draw_gives_documents(spark):
    rows = [(i, f"{LONG} {i}", "keep") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, body string, score string")
    out = resample.draw(df, spark.createDataFrame([("one two",)], "text string"), "id", text="body").collect()
    assert len(out) == 3 and all(tuple(r) in set(rows) for r in out)


@given(st.lists(st.text(alphabet="abAB1 é漢.\n", max_size=200) | st.just(None), max_size=5))
def test_features(texts):
    counts, rows, found = resample.features(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        words, buckets = runs(text)
        assert counts[k] == len(words) and sorted(found[rows == k].tolist()) == sorted(buckets)


def test_shift_of_long_words():
    for n in (0, 1, 63, 64, 65, 300, 100000):
        b = bytes(range(256)) * (n // 256 + 1)
        got = resample._SHIFT(np.array([zlib.crc32(b"abc")], np.uint32), np.array([n])) ^ np.uint32(zlib.crc32(b[:n]))
        assert int(got[0]) == zlib.crc32(b"abc" + b[:n])
