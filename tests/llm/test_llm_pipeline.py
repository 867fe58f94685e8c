"""Every stage on its own input against a brute-force version of it."""

import zlib
from collections import Counter
from itertools import accumulate

import corpus_pipeline
import pytest
from test_llm_decontaminate import brute as windows
from test_llm_near_dup import brute as groups
from tokenizers import Tokenizer

from ferrybook.llm import quality
from ferrybook.llm.common import file_order, stored, table
from ferrybook.llm.mixing import tempered
from ferrybook.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs, out = table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, folder), name)
        out.append((docs, after))
        docs = after
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(steps, spark, folder):
    columns = table(spark, folder, "documents").dtypes
    assert all(after.dtypes == columns for _, after in steps[:-1])


def test_quality(steps, spark, folder):
    before, after = steps[0]
    kept = quality.classify(before, table(spark, folder, "labels")).where("predicted = 1").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, _ in pairs(after))


def test_near_duplicates(steps):
    before, after = steps[1]
    want = {i for i, (_, root) in groups(pairs(before)).items() if i == root}
    assert sorted(i for i, _ in pairs(after)) == sorted(want)


def test_benchmark(steps, spark, folder):
    before, after = steps[2]
    items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
    assert sorted(i for i, _ in pairs(after)) == sorted(r[0] for r in windows(pairs(before), items) if not r[5])


def test_mixture(steps):
    before, after = steps[3]
    assert {i for i, _ in pairs(after)} == {i for i, _ in pairs(before)}
    sizes = Counter(r.source for r in before.collect())
    weights = tempered(sizes)
    total, done = sum(weights.values()), Counter()
    # less than one block of eight rows off, at every place of the order that the files keep
    for t, r in enumerate(after.orderBy(*file_order(after)).collect(), 1):
        done[r.source] += 1
        if t % 8 == 0:
            assert all(abs(done[k] - w / total * t) < 8 for k, w in weights.items())


def test_token_files_have_the_order_of_the_mixture(steps):
    before, after = steps[4]
    want = [r.doc_id for r in before.orderBy(*file_order(before)).collect()]
    rows = after.orderBy("start").collect()
    assert [r.doc_id for r in rows] == want != sorted(want)
    assert [r.start for r in rows[1:]] == list(accumulate(r.n_tokens for r in rows[:-1]))


CLASHING = "doc_id long, source string, lang string, text string, digest string, mixed string, node long, own int, key string, _metadata string"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows_and_clashing_names(spark, folder, name, stage):
    long = " ".join(f"w{i}" for i in range(30000))
    texts = [(1, None), (2, ""), (3, long), (3, long), (3, "another text under the same id"), (None, "without an id"), (7, " \t")]
    rows = [(i, f"s{k % 2}" if k else None, "en", t, "d", "m", k, k, "k", "x") for k, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, CLASHING)
    out, none = stage(spark, df, folder), stage(spark, df.limit(0), folder)
    assert none.collect() == []
    got = {(r.doc_id, r.n_tokens) for r in out.collect()} if name == "token_output" else {(r.doc_id, r.text) for r in out.collect()}
    if name == "token_output":
        assert out.count() == len(rows) and {i for i, _ in got} == {1, 2, 3, 7, None} and {n for i, n in got if i in (1, 2)} == {1}
    else:
        assert out.dtypes == df.dtypes
        assert got <= set(texts)
    if name in ("minhash_near_dedup", "benchmark_decontamination", "source_mixing"):
        assert got == set(texts)  # none of them is a near-copy, a passage, or left out
    if name == "minhash_near_dedup":
        assert out.count() == len(set(texts))


def test_tokens(steps, spark, folder):
    before, after = steps[4]
    plain = Tokenizer.from_file(str(tokenizer_path()))
    want = Counter((i, len(plain.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in pairs(before))
    assert Counter((r.doc_id, r.n_tokens) for r in after.collect()) == want
    assert corpus_pipeline.run(spark, folder).agg({"ids_crc32": "sum"}).first()[0] == sum(r.ids_crc32 for r in after.collect())
    assert zlib.crc32(b"") == 0
