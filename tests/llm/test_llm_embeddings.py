import numpy as np

from ferrybook.llm import embeddings
from ferrybook.llm.embeddings import near_duplicates


def brute(rows, limit=0.95):
    good = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = {i: set() for i, _ in rows}
    for i, a in good.items():
        for j, b in good.items():
            if i < j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= limit:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(links[i]), min(seen))
    return out


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_groups_beyond_the_window(spark):
    rng = np.random.default_rng(3)
    rows = []
    for size, noise in ((150, 0.02), (40, 0.03), (3, 0.02), (2, 0.01), (1, 0), (1, 0)):
        centre = rng.standard_normal(24)
        for _ in range(size):
            rows.append((len(rows), [float(x) for x in centre + noise * rng.standard_normal(24)]))
    rows += [(len(rows) + k, rows[0][1]) for k in range(20)]  # exact copies
    rows += [(len(rows) + k, [float(x) for x in rng.standard_normal(24)]) for k in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    want, got = brute(rows), result(near_duplicates(df, window=8))
    true, found = sum(n for n, _ in want.values()), sum(n for n, _ in got.values())
    assert found <= true and found >= 0.9 * true
    assert all(got[i][0] <= want[i][0] for i in want)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [1.0, None]),
        (7, [float("inf"), 0.0]), (8, [1e300, 0.0]), (9, []), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, digest string")
    out = near_duplicates(df).collect()
    assert len(out) == len(rows)
    by = {r.vec_id: r for r in out}
    assert (by[2].n_links, by[2].component_id, by[2].kept) == (4, 1, False)
    assert (by[8].n_links, by[8].component_id) == (4, 1)
    assert by[1].kept and by[None].component_id == 1 and not by[None].kept
    for i in (3, 4, 5, 6, 7, 9, 10):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def dense(rng, near, planted, others, dim=24):
    """``near`` vectors of mutual cosines of about 0.8, ``planted`` of them with a partner at about 0.96, and ``others``."""
    centre = rng.standard_normal(dim)
    centre /= np.linalg.norm(centre)
    x = centre * np.sqrt(0.8) + rng.standard_normal((near, dim)) * np.sqrt(0.2 / dim)
    x = np.concatenate([x, x[:planted] + rng.standard_normal((planted, dim)) * 0.29 / np.sqrt(dim)])
    return np.concatenate([x, rng.standard_normal((others, dim))])


def test_links_of_a_dense_third(spark):
    for scale in (1, 3):
        x = dense(np.random.default_rng(5), 400 * scale, 200 * scale, 1000 * scale, 64)
        rows = [(i, [float(v) for v in e]) for i, e in enumerate(np.concatenate([x, x[:5]]))]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        unit = np.array([v for _, v in rows])
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        want = (unit @ unit.T >= 0.95).sum(1) - 1
        got = np.array([n for _, (n, _) in sorted(result(near_duplicates(df, window=4)).items())])
        assert (got <= want).all() and got.sum() >= 0.95 * want.sum() > 200


def test_components_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_BYTES", 6_000)  # some thirty vectors
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(24)
    x = np.concatenate([centre + 0.15 * rng.standard_normal((200, 24)), rng.standard_normal((50, 24))])
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(np.concatenate([x, x[:7], x[:7]]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(near_duplicates(df)) == brute(rows)
    assert max(n for n, _ in brute(rows).values()) > 100
