import random
import re

import pytest
from pyspark.sql import functions as F

from ferrybook.llm import near_dup
from ferrybook.llm.near_dup import keep_one, near_duplicates


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """{doc_id: (n, component)} by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def corpus(seed, groups=12, size=6, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, words))]
        for _ in range(rng.randint(1, size)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.4:  # a passage that many share
                text = text + passage if rng.random() < 0.5 else passage + text
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_matches_all_pairs(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df)) == brute(rows)


def test_small_blocks_and_a_hot_passage(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rows = corpus(9, groups=30, size=4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df)) == brute(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(1)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(text)))
    found = result(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == brute(rows)


def test_nulls_blanks_ties_and_clashing_names(spark):
    same = "one two three four five six seven"
    rows = [
        (5, same, 1), (3, same.upper(), 2), (3, same, 2), (7, "", 3), (8, None, 4), (9, " \t\n", 5), (None, same, 6),
        (None, "alone in the world it is", 7), (None, "alone in the world it is", 7), (11, "ab cd", 8), (12, "AB\tcd", 9),
        (13, "ab", 10), (None, None, 11), (20, "x " * 30000, 12), (21, "x " * 40000, 12),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumn("digest", F.lit("d")).withColumn("node", F.lit(1))
    out = near_duplicates(df).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[5].component_id == 3 and not by[5].kept and by[3].kept
    assert by[7].n_shingles == by[8].n_shingles == by[9].n_shingles == 0
    assert by[7].component_id == 7 and by[7].kept and by[8].kept and by[9].kept
    assert by[12].component_id == 11 and by[13].component_id == 13
    assert by[21].component_id == 20 and by[20].n_shingles == 1
    assert sorted((r.component_id or -1, r.n_shingles, r.kept) for r in out if r.doc_id is None) == [
        (-1, 0, False), (-1, 2, False), (-1, 2, False), (3, 3, False)
    ]
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, -1, 3, 7, 8, 9, 11, 13, 20]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == [] and keep_one(empty).collect() == []
