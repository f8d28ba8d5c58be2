"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.llm.common import stage


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round; an edge is (a, b) with b < a."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``pairs`` of longs (a, b); a component is its smallest node.

    The rounds are logarithmic in the longest path.  Each is written to the shared folder, which cuts the
    lineage; a node with very many partners is reduced by partial aggregation and its join can be split by
    adaptive execution, so no group meets in one task.  NULL nodes and loops say nothing and are left out;
    without pairs there are no rows.
    """
    edges = stage(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    known = None
    for _ in range(rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
        if state[0]:
            edges = stage(_stars(edges), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(edges.select("b", "b").distinct())
