"""MinHash near-dedup with bottom-k sketches of one hash function.

A document's set is that of its distinct 5-word shingles. Its sketch holds the ``K`` smallest
hashes of the set. Two sets with a Jaccard similarity of 0.75 share each of the smallest hashes of
their union with a chance of 0.75 or more, so

* the chance that they share fewer than a third of their retained values is below 1e-8 and that
  the union sketch estimates less than a third is the same event; smaller sets are held whole and
  there both bounds are certain;
* hence, with a document's retained values ordered from the rarest to the most frequent, the last
  values short of a third can be left out of the inverted lists: a pair shares another one. A
  document whose values are nearly all its own drops out, and a passage that many documents share
  makes no long list for them.

Equal sets are one class from the start. In every inverted list the members are linked with its
smallest member: one candidate per member, never all pairs. Lists that are one component after
verification are settled. The members of the rest are compared in blocks of bounded size, across
components only: by sketches first, then by full sets, and no more links leave a block than join
its components. All links are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import give_back, id_of, node_of, pieces, scratch, stored, tidy
from ferrybook.llm.graph import components
from ferrybook.llm.shingles import digest, shingle_sets

K = 48
PERCENT = 75
BLOCK = 256
BLOCK_BYTES = 4 << 20  # of the sets in a block, about; a larger set is a block of its own
SLOT_BYTES = 8 << 20  # of the sets of small lists that one task holds together, about


# retained values that a set of n shingles shares with any similar one
LEAST_SHARED = f"greatest(1, cast(floor(least(n, {K}) / 3) as int))"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, 1):
        sets = shingle_sets(part.column(1))
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([s[:K].astype(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            ["doc_id", "n", "digest", "sketch"],
        )


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, digest, sketch, node) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    made = rows.mapInArrow(tidy(_sketches), "doc_id long, n long, digest binary, sketch array<long>")
    return made.withColumn("node", node_of("doc_id", "digest"))


def _enough(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> bool:
    """Does the union sketch leave a similarity of 0.75 possible?"""
    if 100 * min(n_a, n_b) < PERCENT * max(n_a, n_b):
        return False
    shared = np.intersect1d(a, b, assume_unique=True)
    if max(n_a, n_b) <= K:
        return 100 * len(shared) >= PERCENT * (n_a + n_b - len(shared))
    top = np.union1d(a, b)[: min(K, n_a + n_b)]
    return int((shared <= top[-1]).sum()) * 3 >= len(top)


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs with both sketches -> the pairs that pass the estimate."""
    for batch in batches:
        rows = batch.to_pydict()
        keep = [
            _enough(np.asarray(x), np.asarray(y), n, m)
            for x, y, n, m in zip(rows["sketch_a"], rows["sketch_b"], rows["n_a"], rows["n_b"])
        ]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(pieces(batches, 2), 3):
        left, right = shingle_sets(part.column(2)), shingle_sets(part.column(3))
        keep = []
        for x, y in zip(left, right):
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both))
        yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _side(sketched: DataFrame, name: str) -> DataFrame:
    return sketched.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))


def _inverted(classes: DataFrame) -> DataFrame:
    """(node, value): the lists that can hold a similar pair, without values of one document."""
    rows = classes.select("node", "n", F.explode("sketch").alias("value"))
    sizes = rows.groupBy("value").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = rows.join(sizes, "value")
    # the rarest values first; those of a single document came before all of these
    kept = shared.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("members", "value"))).alias("held"))
    prefix = kept.selectExpr("node", "n", f"slice(held, 1, greatest(0, size(held) - {LEAST_SHARED} + 1)) as held")
    return prefix.select("node", F.explode("held.value").alias("value"))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
    return both.mapInArrow(tidy(_verified), "a long, b long").distinct()


def _shared(one: list[np.ndarray], two: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many values each of ``one`` shares with each of ``two``; some thousand values at a time."""
    values = np.concatenate(one + two)
    owner = np.repeat(np.arange(len(one) + len(two)), [len(s) for s in one + two])
    order = np.argsort(values, kind="stable")
    _, at, times = np.unique(values[order], return_inverse=True, return_counts=True)
    common = times > 1
    column = (np.cumsum(common) - 1)[at]
    kept = common[at]
    owner, column = owner[order][kept], column[kept]
    out = np.zeros((len(one), len(two)), np.float32)
    for low in range(0, int(common.sum()), columns):
        a, b = np.searchsorted(column, [low, low + columns])
        held = np.zeros((len(one) + len(two), columns), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held[: len(one)] @ held[len(one) :].T
    return out


def _forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pairs that join what earlier ones have not joined yet."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[y] = x
            out.append((a, b))
    return out


def _blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """Links across components, per leader and block pair of a slot: as many as join what is similar there."""
    found: list[tuple[int, int]] = []
    for (_, x, y), group in rows.groupby(["leader", "x", "y"], sort=False):
        own, node, root = (group[c].to_numpy() for c in ("own", "node", "root"))
        sets = [np.frombuffer(v, np.uint64) for v in group["set"]]
        one, two = np.flatnonzero(own == x), np.flatnonzero(own == y)
        if not len(one) or not len(two):
            continue
        n = np.array([len(s) for s in sets])
        less, more = np.minimum(n[one][:, None], n[two]), np.maximum(n[one][:, None], n[two])
        met = _shared([sets[i][:K] for i in one], [sets[i][:K] for i in two])
        near = (met >= np.maximum(1, np.minimum(less, K) // 3)) & (root[one][:, None] != root[two])
        near &= 100 * less >= PERCENT * more
        left, right = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(left):
            continue
        both = _shared([sets[one[i]] for i in left], [sets[two[i]] for i in right])
        total = n[one[left]][:, None] + n[two[right]] - both
        linked = near[np.ix_(left, right)] & (100 * both >= PERCENT * total)
        pairs = [(one[left[i]], two[right[j]]) for i, j in zip(*np.nonzero(linked))]
        keep = set(_forest((root[i], root[j]) for i, j in pairs))
        for i, j in pairs:
            if (root[i], root[j]) in keep:
                keep.discard((root[i], root[j]))
                found.append((node[i], node[j]))
    if rows["set"].map(len).sum() > BLOCK_BYTES:
        give_back()
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, 1):
        sets = pa.array([s.tobytes() for s in shingle_sets(part.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column(0), sets], ["node", "set"])


def _rest(lists: DataFrame, leaders: DataFrame, classes: DataFrame, texts: DataFrame, roots: DataFrame) -> DataFrame:
    """Links across the components of the lists that are not one component yet.

    Lists with the same smallest member are compared as one, so that a pair is not met once per
    value that it shares.
    """
    placed = lists.join(roots, "node", "left").select("value", "node", F.coalesce("root", "node").alias("root"))
    open_lists = placed.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    led = leaders.join(open_lists, "value", "left_semi").select("value", F.col("a").alias("leader"))
    held = classes.groupBy("node").agg((8 * F.sum("n")).alias("bytes"))
    rows = stored(placed.join(led, "value").select("leader", "node", "root").distinct().join(held, "node"), "open")
    by_rows, by_bytes = F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)
    sizes = rows.groupBy("leader").agg(F.greatest(by_rows, by_bytes).alias("blocks"))
    slots = (rows.agg(F.sum("bytes")).first()[0] or 0) // SLOT_BYTES + 1
    sets = texts.join(rows.select("node").distinct(), "node", "left_semi").mapInArrow(tidy(_full_sets), "node long, set binary")
    rows = rows.join(sizes, "leader").join(sets, "node")
    rows = rows.withColumn("own", F.expr("pmod(xxhash64(node), blocks)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    rows = rows.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})
    few = F.expr(f"if(blocks = 1, pmod(xxhash64(leader), {slots}), xxhash64(leader, x, y))").alias("slot")
    found = rows.select(few, "leader", "x", "y", "own", "node", "root", "set").groupBy("slot")
    return found.applyInPandas(_blocks, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, node, root, digest of its set.

    ``component_id`` is the smallest doc_id reachable by links, ``kept`` whether it is the row's own.
    ``node`` and ``root`` are the same with stand-ins for null ids, whose rows are never ``kept`` but
    link like others; a component without any id has a null ``component_id``. Null, empty and blank
    texts have an empty set and link with nothing. Rows that repeat a doc_id are one node. An empty
    table gives no rows; other columns of ``docs`` are not read.
    """
    base = stored(sketches(docs, doc_id, text), "sketches")
    equal = stored(base.where("n > 0").groupBy("digest").agg(F.min("node").alias("root")), "classes")
    # every class is known by its smallest node; a node with several texts holds several classes
    held = base.join(equal.withColumnRenamed("root", "node"), ["digest", "node"], "left_semi")
    classes = stored(held.groupBy("digest", "node", "n").agg(F.first("sketch").alias("sketch")).drop("digest"), "sets")
    lists = stored(_inverted(classes), "lists")
    texts = stored(_texts(docs, doc_id, text, base).join(lists.select("node").distinct(), "node", "left_semi").distinct(), "texts")
    leaders = lists.groupBy("value").agg(F.min("node").alias("a"))
    stars = lists.join(leaders, "value").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    wide = stars.join(_side(classes, "a"), "a").join(_side(classes, "b"), "b")
    pairs = wide.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(tidy(_passing), "a long, b long").distinct()
    linked = _confirmed(pairs, texts)
    same = base.join(equal, "digest").where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    first = components(linked.union(same))
    more = stored(_rest(lists, leaders, classes, texts, first), "more")
    if more.limit(1).count():
        first = components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    out = base.join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        id_of("root").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("root"), F.lit(False)).alias("kept"),
        "node",
        "root",
        "digest",
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of near-duplicates, with all its columns: the one with the smallest id.

    Of rows that repeat an id and its text one stays. Different texts under one id are different
    documents: one of them goes by the id, the others have none. A row without id stays where no row of
    its group has one, and of such a group's equal texts one; blank rows without id all stay.
    """
    own, name = _free("own", docs), _free("digest", docs)
    named = _one_text_an_id(docs, doc_id, text, own)
    with scratch(docs.sparkSession):
        found = stored(near_duplicates(named, own, text), "groups", lasting=True)
    kept = found.where("kept").select(F.col("doc_id").alias(own)).distinct()
    out = named.join(kept, own, "left_semi").dropDuplicates([own]).select(*docs.columns)
    nameless = named.where(F.col(own).isNull())
    if not nameless.limit(1).count():
        return out
    made = nameless.withColumn(name, F.arrow_udf(_digest_column, "binary")(F.col(text).cast("string")))
    alone = found.where("doc_id is null and digest is not null and node = root").select(F.col("digest").alias(name)).distinct()
    some = made.join(alone, name, "left_semi").dropDuplicates([name]).select(*docs.columns)
    return out.union(some).union(made.where(F.col(name).isNull()).select(*docs.columns))


def _free(name: str, df: DataFrame) -> str:
    while name in (c.lower() for c in df.columns):
        name += "_"
    return name


def _one_text_an_id(docs: DataFrame, doc_id: str, text: str, own: str) -> DataFrame:
    """``docs`` with a column ``own``: the id, or null where the text is not the one that goes by it."""
    code = F.xxhash64(F.col(text).cast("string"))
    several = docs.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias(own)).agg(F.min(code).alias("lo"), F.max(code).alias("hi"))
    several = stored(several.where("lo <> hi").select(own, "lo"), "several", lasting=True)
    if not several.limit(1).count():
        return docs.withColumn(own, F.col(doc_id).cast("long"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).cast("long").alias(own), code.alias("code"))
    rows = rows.join(several, own, "left")
    return rows.select("row.*", F.when(F.col("lo").isNull() | (F.col("lo") == F.col("code")), F.col(own)).alias(own))


def _digest_column(texts: pa.Array) -> pa.Array:
    parts = pieces([pa.RecordBatch.from_arrays([texts], ["text"])], 0)
    made = [digest(s) if len(s) else None for part in parts for s in shingle_sets(part.column(0))]
    return pa.array(made, pa.binary())


def _texts(docs: DataFrame, doc_id: str, text: str, base: DataFrame) -> DataFrame:
    """(node, text) of every row; rows without an id get the stand-in that their set's digest gave them."""
    source = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    if not source.where("node is null").limit(1).count():
        return source
    made = base.where("doc_id is null").select("digest", F.col("node").alias("own")).distinct()
    rest = source.where("node is null").select("text").mapInArrow(tidy(_digests), "digest binary, text string")
    return source.where("node is not null").union(rest.join(made, "digest").select("own", "text"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, 0):
        made = [digest(s) if len(s) else None for s in shingle_sets(part.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), part.column(0)], ["digest", "text"])
