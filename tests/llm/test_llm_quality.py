import zlib

import numpy as np
import pyarrow as pa

from ferrybook.llm import quality
from ferrybook.llm.common import table


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out = quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert len(rows) > 50 and right >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_scores_depend_on_the_text_alone(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    feats = quality.featured(docs)
    a = {r.doc_id: r.f for r in feats.collect()}
    moved = docs.selectExpr("doc_id + 1000 as doc_id", "text", "'x' as lang", "'y' as source", "0 as f")
    assert {r.doc_id - 1000: r.f for r in quality.featured(moved).collect()} == a
    kept = {r.doc_id for r in quality.accepted(docs, labels).collect()}
    assert kept == {r.doc_id for r in quality.classify(docs, labels).where("score >= 0.3").collect()}


def test_odd_texts():
    texts = pa.array([None, "", " \n", "a", "!" * 10000, "é" * 5, "x " * 50000, "word"])
    out = quality.features(texts)
    assert out.shape == (8, quality.FEATURES) and (out == out).all() and (abs(out) < 100).all()


def test_held_out_is_a_checksum(spark):
    rows = spark.range(200).withColumn("h", quality.held_out("id")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score, r.predicted) for r in quality.classify(docs, none).collect()] == [(0.5, 1)] * 3
    assert quality.accepted(docs, none).count() == 3
    assert quality.classify(docs.limit(0), none).collect() == []


def plain_scores(rows):
    """The discriminant written out with numpy over (features, label or None): no sums, factors or histograms of the module."""
    x = np.array([f for f, _ in rows])
    per = [np.array([f for f, y in rows if y == label]) for label in (0, 1)]
    total = sum(map(len, per))
    pooled = np.maximum(sum(((p - p.mean(0)) ** 2).sum(0) for p in per) / total, 1e-6)
    logs = []
    for p in per:
        cov = (1 - quality.SHRINKAGE) * np.cov(p.T, bias=True) + quality.SHRINKAGE * np.diag(pooled)
        away = x - p.mean(0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
        logs.append(np.log(len(p) / total) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * distance)
    return np.clip(logs[1] - logs[0], -quality.CLIP, quality.CLIP)


def test_scores_equal_a_plain_discriminant(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    marked = {r.doc_id: r.quality for r in labels.collect()}
    feats = sorted((r.doc_id, r.f) for r in quality.featured(docs).collect())
    learnt = lambda i: marked.get(i) if zlib.crc32(str(i).encode()) % 5 else None
    want = plain_scores([(f, learnt(i)) for i, f in feats])
    model = quality.fit(quality.featured(docs), labels)
    got = model.difference(np.array([f for _, f in feats]))
    assert np.allclose(got, want, rtol=1e-6, atol=1e-6) and want.min() < 0 < want.max()
    # the logistic curve over the differences, by plain gradient steps on the same bins
    width = 2 * quality.CLIP / quality.BINS
    centre = lambda d: (np.floor((d + quality.CLIP) / width) + 0.5) * width - quality.CLIP
    d, y = map(np.array, zip(*[(centre(v), learnt(i)) for (i, _), v in zip(feats, want) if learnt(i) is not None]))

    def loss(w):
        z = d / 10 * w[0] + w[1]
        return (np.logaddexp(0, z) - y * z).sum() + ((w[0] - 1) ** 2 + w[1] ** 2) / 2

    fitted = np.array([model.slope * 10, model.offset])
    for step in ([1e-2, 0], [-1e-2, 0], [0, 1e-2], [0, -1e-2]):
        assert loss(fitted) < loss(fitted + step)
    scores = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    plain = 1 / (1 + np.exp(-(model.slope * want + model.offset)))
    assert np.allclose([scores[i] for i, _ in feats], plain, atol=1e-6)


def test_the_smallest_of_several_labels_counts(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels").select("doc_id", "quality")
    ones = labels.where("quality = 0").selectExpr("doc_id", "1 as quality")
    scores = lambda y: sorted((r.doc_id, r.score) for r in quality.classify(docs, y).collect())
    a, b = scores(labels), scores(ones.union(labels).union(labels))
    assert [i for i, _ in a] == [i for i, _ in b] and np.allclose([s for _, s in a], [s for _, s in b])
