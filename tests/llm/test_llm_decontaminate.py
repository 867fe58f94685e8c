import random
import re

import pytest

from ferrybook.llm import decontaminate
from ferrybook.llm.common import stored
from ferrybook.llm.decontaminate import clean, report


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i) if i is not None else "null")
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    ids |= windows[g]
        out.append((d, len(w), len(hit), len(ids), ",".join(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def result(spark, docs, items):
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as key", "'x' as n_words")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as w")
    rows = report(a, b).collect()
    kept = sorted(str(r.doc_id) for r in clean(a, b).collect())
    assert kept == sorted(str(r.doc_id) for r in rows if not r.contaminated)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in rows), key=str)


@pytest.mark.parametrize("shortest", [13, 7, 3, 1])
def test_matches_all_windows(spark, shortest):
    rng = random.Random(shortest)
    vocabulary = [f"W{k}" for k in range(40)] + ["é", "Éa", "x1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([shortest, 14, 20, 30])))) for i in range(8)]
    items += [(3, items[0][1]), (None, items[1][1]), (50, None), (51, "..."), (52, items[2][1] + " more")]
    docs = []
    for d in range(40):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if rng.random() < 0.6:
            w = words(rng.choice(items[:8])[1])
            cut = w[rng.randint(0, 3) : len(w) - rng.randint(0, 3)]
            at = rng.randint(0, len(text))
            text = text[:at] + [x.upper() if x.isascii() else x for x in cut] + text[at:]
        docs.append((d, ", ".join(text)))
    docs += [(90, None), (91, ""), (None, items[0][1]), (None, items[0][1]), (92, "a " * 3000)]
    assert result(spark, docs, items) == brute(docs, items)


def test_repeated_words(spark):
    docs = [(1, "a " * 4000), (2, "a " * 12), (3, "b " + "a " * 13)]
    items = [(1, "a " * 40), (2, "a " * 13 + "b")]
    assert result(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs = [(1, "one two"), (2, None)]
    assert result(spark, docs, []) == brute(docs, []) and result(spark, [], [(1, "a b")]) == []


def test_a_short_item_does_not_add_fingerprints(spark, monkeypatch):
    sizes = {}

    def watched(df, name, lasting=False):
        out = stored(df, name, lasting)
        if name in ("kept", "prints"):
            sizes.setdefault(name, []).append(out.count() if name == "kept" else out.selectExpr("sum(size(codes))").first()[0])
        return out

    monkeypatch.setattr(decontaminate, "stored", watched)
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randint(0, 60)}" for _ in range(40))) for i in range(4)]
    docs = [(d, " ".join(f"w{rng.randint(0, 60)}" for _ in range(200)) + " " + items[d % 4][1]) for d in range(8)]
    for more in ([], [(9, "w7")], [(9, "w7"), (10, "w1 w2")]):
        got = report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items + more, "item_id long, text string"))
        rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got.collect()]
        assert sorted(rows, key=str) == brute(docs, items + more)
    assert all(len(set(v)) == 1 and len(v) == 3 for v in sizes.values())
