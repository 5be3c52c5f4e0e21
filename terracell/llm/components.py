"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import stash, unstash


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges(a, b)`` (long), where label is the component's smallest node.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the smallest node it
    knows, so that each round at least halves the trees. Rounds are tables in the shared folder. The smallest
    neighbour is a combined minimum and the hand-over a join, so a hub's neighbours never meet in one group.
    """
    now, known = None, None
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    later = stash(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        before, now = now, later
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None:
            unstash(before)
        if state == known or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())
        known = state
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stash(large, "edges")
        least = _least(large)
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        later = stash(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        unstash(large)


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
