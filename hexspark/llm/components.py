"""Connected components of an edge table by alternating large and small stars, without collecting it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexspark.llm import common

#: Rounds grow with the logarithm of the longest chain; more than these cannot be needed by edges that fit on disk.
MOST_ROUNDS = 60


#: Edges up to so many have their nodes' minima broadcast; of more, these are written, so that joins read plain
#: shuffles and the rows of a node with very many edges are split among tasks.
BROADCAST_EDGES = 1_000_000


def _large_star(e: DataFrame, few: bool, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
    least = F.broadcast(least) if few else keep(least)
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(e: DataFrame, few: bool, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    # Edges run from the smaller node a to the larger b.
    least = e.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
    least = least if few else keep(least)
    near = e.join(F.broadcast(least) if few else least, F.col("b") == F.col("u"))
    moved = near.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (columns a, b): root is the smallest node of its component.

    Each round writes its edges to the shared folder, where they stay until the next round is written; rounds end when the edges are stars that no longer
    change, after about the logarithm of the longest chain.  Loops and repeated edges do no harm.
    """
    scratch, sides = common.Scratch(edges.sparkSession), []

    def keep(least: DataFrame) -> DataFrame:
        sides.append(scratch.stored(least, "least"))
        return sides[-1]

    def written(e: DataFrame) -> tuple[DataFrame, tuple]:
        return scratch.observed(e, "edges", F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))

    e, mark = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        last, before = e, mark
        few = mark[0] <= BROADCAST_EDGES
        e, mark = written(_small_star(_large_star(e, few, keep), few, keep))
        scratch.drop(last, *sides)
        sides.clear()
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle within {MOST_ROUNDS} rounds")
    roots = e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
