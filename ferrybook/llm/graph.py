"""Connected components of a link table by alternating star contraction.

Every step is an aggregation with partial sums and a join that adaptive execution can split, so a
node with a third of all links stays no single task's work. Each round is written to the shared
folder. Stars of links, as the near-duplicate operators make them, end after one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrybook.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b): pairs of long node ids, any order, repeats allowed -> (node, root), root the smallest node.

    Only nodes with a link to another node are returned; nulls and loops are no links. An empty
    table gives an empty one.
    """
    links = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = _mark(links)
    while mark[0]:
        links = stored(_small_star(_large_star(links)), "links")
        last, mark = mark, _mark(links)
        if mark == last:
            break
    roots = links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return stored(roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "roots")
