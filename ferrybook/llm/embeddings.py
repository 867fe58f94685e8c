"""Embedding near-dedup by sorted projection passes.

Each pass draws ``BITS`` random hyperplanes for its seed; the signs of a vector against them, one
after the other, are its code. All vectors are ordered by their codes, so that vectors which agree
in a long run of leading signs become neighbours, and every vector is compared with the ``WINDOW``
before it. Pairs with a cosine of 0.95 or more, in double precision, are links; the links of all
passes are united to components. Identical vectors are one class from the start.

How many passes that takes depends on the vectors: where many lie close together, more of them share
their leading signs than a window holds, and a pass finds fewer of their links. So passes come in
rounds of ``PASSES`` with fresh planes. A round's joins (links between components of the rounds
before) fall from round to round by the share of links that a round misses; the joins still to be
found are estimated from the last two, and the rounds end where they are fewer than ``MISSED`` of those found.

Within a component every link is then counted: its vectors are dealt to blocks of ``BLOCK_BYTES``,
and each pair of blocks is compared by one matrix product, of which only counts leave the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import id_of, node_of, stored, tidy
from ferrybook.llm.graph import components

LIMIT = 0.95
PASSES = 6  # of a round
WINDOW = 32
BITS = 60
MISSED = 0.005  # share of the joins that may be left when the rounds end, by estimate
BLOCK_BYTES = 4 << 20  # of the vectors of a component in one block
PRODUCT_ROWS = 256  # vectors compared with a block at once
SEED = 7


def _unit(raw: bytes) -> np.ndarray | None:
    """The unit vector of serialized doubles; None where it has no direction."""
    x = np.frombuffer(raw, np.float64)
    if not len(x) or not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raws, digests = [], []
        for x in batch.column(1):
            values = x.values if x.is_valid else None
            raw = values.cast(pa.float64()).to_numpy().tobytes() if values is not None and not values.null_count else b""
            good = _unit(raw) is not None
            raws.append(raw if good else None)
            digests.append(hashlib.blake2b(raw, digest_size=16).digest() if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(raws, pa.binary()), pa.array(digests, pa.binary())], ["vec_id", "raw", "digest"]
        )


def _planes(seed: int, dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, seed, dim]).standard_normal((dim, BITS))


def _codes(passes: range):
    places = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            nodes, raws = batch.column(0).to_numpy(), batch.column(1)
            dims = pc.binary_length(raws).to_numpy() // 8
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                held = raws.take(pa.array(mine))
                units = np.stack([_unit(x) for x in held.to_pylist()])
                for k in passes:
                    planes = drawn.setdefault((k, dim), _planes(k, int(dim)))
                    code = ((units @ planes) > 0) @ places
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(mine), k), pa.int32()),
                            pa.array(np.full(len(mine), dim), pa.int32()),
                            pa.array(code, pa.int64()),
                            pa.array(nodes[mine], pa.int64()),
                            held,
                        ],
                        ["pass", "dim", "code", "node", "raw"],
                    )

    return run


class Forest:
    """Joins of one task: a link is kept where it joins what the task's earlier links have not joined."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = self.root
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def joining(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        kept = []
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.root[y] = x
                kept.append(i)
        return kept


def _near(window: int, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # of the batch before: order, dimension, node and unit vector of its last rows
        forest = Forest()
        for batch in batches:
            order = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)
            nodes = batch.column(3).to_numpy()
            units = [_unit(x) for x in batch.column(4).to_pylist()]
            if last is not None:
                order = np.concatenate([last[0], order])
                nodes = np.concatenate([last[1], nodes])
                units = last[2] + units
            fresh = 0 if last is None else len(last[1])
            for dim in np.unique(order[:, 1]):
                mine = np.flatnonzero(order[:, 1] == dim)
                x = np.stack([units[i] for i in mine])
                for back in range(1, min(window, len(mine) - 1) + 1):
                    near = np.einsum("ij,ij->i", x[back:], x[:-back]) >= limit
                    near &= (order[mine[back:], 0] == order[mine[:-back], 0]) & (mine[back:] >= fresh)
                    hit = np.flatnonzero(near)
                    a, b = nodes[mine[hit]], nodes[mine[hit + back]]
                    if kept := forest.joining(a, b):
                        yield pa.RecordBatch.from_arrays([pa.array(v[kept], pa.int64()) for v in (a, b)], ["a", "b"])
            last = (order[-window:], nodes[-window:], units[-window:])

    return tidy(run)


def _joins(roots: DataFrame) -> int:
    """How many links it takes to hold the components together."""
    return roots.where("node <> root").count()


def _linked(held: DataFrame, links: DataFrame, passes: int, window: int, limit: float) -> DataFrame:
    """Components of ``links`` and of the links that rounds of passes over ``held`` find."""
    roots, total, before, seed = components(links), 0, 0, 0
    start = _joins(roots)
    while True:
        seeds = range(seed, seed + passes)
        coded = held.select("node", "raw").mapInArrow(_codes(seeds), "pass int, dim int, code long, node long, raw binary")
        order = ["pass", "dim", "code", "node"]
        coded = coded.repartitionByRange(*order).sortWithinPartitions(*order)
        pairs = coded.mapInArrow(_near(window, limit), "a long, b long")
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(pairs))
        last, total = total, _joins(roots) - start
        found, seed = total - last, seed + passes
        # joins of a round, over those of the round before, are the share that a round misses
        left = found * found / (before - found) if before > found else float("inf")
        if seed > passes and (not found or left <= MISSED * total):
            return roots
        before = found


def _tiles(placed: DataFrame) -> DataFrame:
    """Vectors of components by pairs of blocks: root, lo, hi, block and the vector's own columns."""
    sizes = placed.groupBy("root").agg((F.sum(F.octet_length("raw")) / BLOCK_BYTES).cast("long").alias("blocks"))
    dealt = placed.join(sizes.withColumn("blocks", F.col("blocks") + 1), "root")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("digest"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    tiled = dealt.select("*", other.alias("other")).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    keys = ["root", "lo", "hi"]
    tiled = tiled.select(*keys, "block", "node", "size", "digest", "raw")
    return tiled.repartition(*keys).sortWithinPartitions(*keys, "block")


def _counts(rows: pa.Table, limit: float) -> Iterator[pa.RecordBatch]:
    """(node, links) of one pair of blocks; links of a vector count every row of its partner's class."""
    lengths = pc.binary_length(rows["raw"]).to_numpy()
    for length in np.unique(lengths):
        mine = rows.filter(pa.array(lengths == length))
        units = np.stack([_unit(x) for x in mine["raw"].to_pylist()])
        block, nodes, sizes = (mine[c].to_numpy() for c in ("block", "node", "size"))
        lo, hi = mine["lo"][0].as_py(), mine["hi"][0].as_py()
        one, two = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        counts = np.zeros(len(nodes), np.int64)
        for k in range(0, len(one), PRODUCT_ROWS):
            part = one[k : k + PRODUCT_ROWS]
            near = units[part] @ units[two].T >= limit
            if lo == hi:
                near[np.arange(len(part)), k + np.arange(len(part))] = False
            counts[part] += near @ sizes[two]
            if lo != hi:
                counts[two] += sizes[part] @ near
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[some], pa.int64()), pa.array(counts[some], pa.int64())], ["node", "links"])


def _counted(limit: float):
    """:func:`_counts` of every tile of a task; rows of a tile come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            keys = np.stack([rows[c].to_numpy() for c in ("root", "lo", "hi")], 1)
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for a, b in zip([0, *ends[:-1]], ends):
                yield from _counts(rows.slice(a, b - a), limit)
            rest = rows.slice(ends[-1]) if len(ends) else rows
        if rest is not None and rest.num_rows:
            yield from _counts(rest, limit)

    return tidy(run)


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    limit: float = LIMIT,
    passes: int = PASSES,
    window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; so
    do vectors of different length. Rows that repeat a vec_id are one node. A row without vec_id
    links like others, counts as a link of its partners, is never ``kept``, and its component's id is
    null where no member has one. An empty table gives no rows; other columns are not read.

    A component's links are counted in full; a link that no pass meets and no chain of other links
    bridges is not found.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
    base = rows.mapInArrow(_digested, "vec_id long, raw binary, digest binary")
    base = stored(base.withColumn("node", node_of("vec_id", "digest")), "vectors")
    valid = base.where("digest is not null")
    equal = stored(valid.groupBy("digest").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("size")), "equal")
    held = base.join(equal.withColumnRenamed("rep", "node"), ["digest", "node"]).dropDuplicates(["digest", "node"])
    held = stored(held.select("digest", "node", "raw", "size"), "held")
    same = valid.join(equal, "digest").where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    roots = _linked(held, same, passes, window, limit)
    placed = held.join(roots, "node").select("root", "node", "size", "digest", "raw")
    links = _tiles(placed).mapInArrow(_counted(limit), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    # of a class: its representative's links, and the other rows of the class itself
    totals = equal.join(links, F.col("rep") == F.col("node"), "left")
    totals = totals.select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    out = base.join(totals, "digest", "left").join(roots, "node", "left")
    out = out.withColumn("root", F.coalesce("root", "node"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        id_of("root").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("root"), F.lit(False)).alias("kept"),
    )
