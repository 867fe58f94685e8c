"""Mixing sources to target weights by Pfair scheduling.

A slot of the mixture takes one block of a source's rows. The ``k``-th block of a source with weight
``w`` is released at ``floor((k - 1) / w)`` and due at ``ceil(k / w)``. Taking the released block with
the earliest deadline for every slot meets all deadlines, as the weights sum to one, so at any time a
source's blocks differ by less than one from its weight times the slots. Weights are whole numbers
over their sum, as exact as they were given.

The slots are cut into segments, and each segment is scheduled by a task of its own, from the weights
alone. For that the segments agree on how many blocks every source has given at their bounds. A bound
is rounded from the weights first: all blocks that are due, and those next due for the slots that are
left. Earliest deadlines first meet every deadline from there on, if not the schedule before it. So
the counts that hold at a bound are those that such a run over the whole segment in front of it ends
with. What starts from one bound's counts can reach the next one's: before the end the blocks in a span
of slots are never more than its slots because the start allows a schedule, up to the end because the
end was met by one. Rows find their slot by a join on source and block.

No row is left out: the mixture ends where the last source has given all its rows once. Sources that
would run out before start again (a new epoch). Ranks of rows within a source come from one range
sort and sums per sorted part, not from a window over a whole source.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrybook.llm.common import stored
from ferrybook.session import broadcast_if_small

FRAME = 1000  # slots of a frame, where weights are rounded to one
BLOCK_ROWS = 8
SEGMENT = 1 << 18  # slots that one task schedules, or more where a source has less than a block in them
BATCH = 1 << 16
TEMPERATURE = 0.7


def shares(weights: dict[str, float], frame: int = FRAME) -> dict[str, int]:
    """Integer slots per frame by the largest remainder, one at least; a longer frame where sources are many."""
    frame = max(frame, 10 * len(weights))
    total = sum(weights.values())
    exact = {k: v * frame / total for k, v in weights.items()}
    out = {k: max(1, math.floor(v)) for k, v in exact.items()}
    rest = frame - sum(out.values())
    order = sorted(exact, key=lambda k: (out[k] - exact[k], k))
    for i in range(abs(rest)):
        if rest > 0:
            out[order[i % len(order)]] += 1
        else:
            # a source with one slot keeps it
            out[max((k for k in out if out[k] > 1), key=lambda k: (out[k] - exact[k], out[k], k))] -= 1
    return out


def exact(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in the ratios of the weights, each taken as the decimal number that it is written as."""
    parts = {k: Fraction(str(v)) for k, v in weights.items()}
    if low := sorted(k for k, v in parts.items() if v <= 0):
        raise ValueError(f"no positive weight for {low}")
    whole = math.lcm(*(v.denominator for v in parts.values()))
    out = {k: int(v * whole) for k, v in parts.items()}
    common = math.gcd(*out.values())
    return {k: v // common for k, v in out.items()}


def turns(parts: list[int], slot: int, given: list[int], until: tuple[int, list[int]] | None = None) -> Iterator[int]:
    """The source of every slot from ``slot`` on, earliest deadline first, where the sources have ``given`` so many blocks.

    With ``until``, a slot and the blocks given before it, it ends there; the order of deadlines is the same for those
    behind that slot.
    """
    frame = sum(parts)

    def entry(source: int, k: int) -> tuple[int, int, int]:
        return (k - 1) * frame // parts[source], source, k

    def left(source: int, k: int) -> bool:
        return until is None or k <= until[1][source]

    waiting = [entry(i, n + 1) for i, n in enumerate(given) if left(i, n + 1)]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    while until is None or slot < until[0]:
        while waiting and waiting[0][0] <= slot:
            _, source, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-k * frame // parts[source]), source, k))
        _, source, k = heapq.heappop(ready)
        yield source
        if left(source, k + 1):
            heapq.heappush(waiting, entry(source, k + 1))
        slot += 1


def schedule(parts: dict[str, int]) -> list[str]:
    """The source of every slot of one frame; the slots behind it repeat it."""
    names = sorted(parts)
    return [names[i] for i in islice(turns([parts[k] for k in names], 0, [0] * len(names)), sum(parts.values()))]


def rounded(parts: list[int], slot: int) -> list[int]:
    """Blocks of every source before ``slot``: all that are due, and those next due for the slots that are left."""
    frame = sum(parts)
    out = [slot * a // frame for a in parts]
    part = [i for i, a in enumerate(parts) if slot * a % frame]
    part.sort(key=lambda i: (-(-(out[i] + 1) * frame // parts[i]), i))
    for i in part[: slot - sum(out)]:
        out[i] += 1
    return out


def bound(parts: list[int], number: int, length: int) -> list[int]:
    """Blocks that every source has given before segment ``number`` begins."""
    if not number:
        return [0] * len(parts)
    out = rounded(parts, (number - 1) * length)
    for source in islice(turns(parts, (number - 1) * length, list(out)), length):
        out[source] += 1
    return out


def segment_length(parts: list[int], least: int = SEGMENT) -> int:
    """Slots of a segment: every source has a block in it."""
    return max(least, -(-sum(parts) // min(parts)))


def segment(parts: list[int], number: int, length: int) -> Iterator[int]:
    """The source of every slot of one segment."""
    end = (number + 1) * length, bound(parts, number + 1, length)
    return turns(parts, number * length, bound(parts, number, length), end)


def _scheduled(parts: list[int], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                slot, given = number * length, np.array(bound(parts, number, length), np.int64)
                order = segment(parts, number, length)
                while len(sources := np.fromiter(islice(order, BATCH), np.int32)):
                    blocks = np.empty(len(sources), np.int64)
                    for i in np.unique(sources):
                        mine = np.flatnonzero(sources == i)
                        blocks[mine] = given[i] + np.arange(len(mine))
                        given[i] += len(mine)
                    slots = np.arange(slot, slot + len(sources))
                    slot += len(sources)
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (sources, blocks, slots)], ["number2", "block2", "slot"])

    return run


def scheduled(spark: SparkSession, parts: list[int], slots: int, least: int = SEGMENT) -> DataFrame:
    """(number2, block2, slot): the source, by its number in ``parts``, and its block for at least ``slots`` slots."""
    length = segment_length(parts, least)
    segments = -(-slots // length)
    numbers = spark.range(0, segments, 1, min(segments, 100_000))
    return numbers.mapInArrow(_scheduled(parts, length), "number2 int, block2 long, slot long")


def tempered(counts: dict[str, int], temperature: float = TEMPERATURE) -> dict[str, float]:
    """Weights that even out the sources' sizes: each size to the power of ``temperature``."""
    return {k: float(n) ** temperature for k, n in counts.items() if n}


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    source: str = "source",
    key: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    frame: int | None = None,
    temperature: float = TEMPERATURE,
    segment_slots: int = SEGMENT,
) -> DataFrame:
    """The rows of ``docs``, some repeated, with a struct column ``mixed``: position, slot, block, epoch.

    Positions order the mixture. ``weights`` names the target weight of every source; without it they are
    tempered from the sources' sizes. A source that it does not name raises an error, one without
    rows takes no part. A null source is a source, named ``None``. Rows of a source come in the order
    of a hash of ``key`` and repeated rows stay repeated. An empty table gives an empty one. A column
    called ``mixed`` in ``docs`` is replaced. Weights have to be positive; they hold exactly, or to a share of
    ``frame`` slots where it is given. Texts may be of any length. The driver holds the table of sources alone.
    """
    spark = docs.sparkSession
    counts = {r[0]: r[1] for r in docs.groupBy(F.col(source).cast("string")).agg(F.count(F.lit(1))).collect()}
    kind = "struct<position:long,slot:long,block:long,epoch:long>"
    if not counts:
        return docs.withColumn("mixed", F.expr(f"cast(null as {kind})"))
    named = {str(k): n for k, n in counts.items()}
    if weights is None:
        weights = tempered(named, temperature)
    if missing := sorted(set(named) - set(weights)):
        raise ValueError(f"no weight for {missing}")
    targets = {k: weights[k] for k in named}
    parts = shares(targets, frame) if frame else exact(targets)
    names = sorted(parts)
    number = {k: i for i, k in enumerate(names)}
    blocks = {k: -(-n // block_rows) for k, n in named.items()}
    # the block that a source ends with is due there
    slots = max(-(-blocks[k] * sum(parts.values()) // parts[k]) for k in names)
    slots = stored(scheduled(spark, [parts[k] for k in names], slots, segment_slots), "slots")
    lasts = F.broadcast(spark.createDataFrame([(number[k], blocks[k] - 1) for k in names], "number int, block long"))
    end = slots.join(lasts, (F.col("number") == F.col("number2")) & (F.col("block") == F.col("block2"))).agg(F.max("slot")).first()[0]
    slots = slots.where(F.col("slot") <= end)
    given = {r[0]: r[1] * block_rows for r in slots.groupBy("number2").agg(F.count(F.lit(1))).collect()}
    plan = F.broadcast(
        spark.createDataFrame(
            [(k, number[str(k)], named[str(k)], given[number[str(k)]]) for k in counts], "s string, number int, n long, given long"
        )
    )
    slots = broadcast_if_small(slots)
    held = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(source).cast("string").alias("s"),
        F.xxhash64(F.col(key)).alias("h"),
        F.monotonically_increasing_id().alias("i"),
    )
    held = held.repartitionByRange("s", "h", "i").sortWithinPartitions("s", "h", "i")
    held = stored(held.select("row", "s", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("i")), "mix")
    # a row per part and source that meet: few, whatever the rows
    runs = held.groupBy("s", "part").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("rows"))
    past = F.sum("rows").over(Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = runs.select(
        F.col("s").alias("s2"), F.col("part").alias("part2"), (F.coalesce(past, F.lit(0)) - F.col("first")).alias("shift")
    )
    rows = held.join(offsets, F.col("s").eqNullSafe(F.col("s2")) & (F.col("part") == F.col("part2")))
    rows = rows.withColumn("rank", F.col("i") + F.col("shift")).select("row", "s", "rank")
    rows = rows.join(plan.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")))
    rows = rows.withColumn("epoch", F.explode(F.expr("sequence(0L, (given - 1 - rank) div n)")))
    place = F.col("rank") + F.col("epoch") * F.col("n")
    rows = rows.withColumn("block", F.floor(place / block_rows)).withColumn("within", place % block_rows)
    rows = rows.join(slots, (F.col("number") == F.col("number2")) & (F.col("block") == F.col("block2")))
    mixed = F.struct((F.col("slot") * block_rows + F.col("within")).alias("position"), "slot", "block", "epoch").cast(kind)
    names = [c for c in docs.columns if c.lower() != "mixed"]
    return rows.select(*[F.col("row")[c].alias(c) for c in names], mixed.alias("mixed"))
