"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.plans.shared import discard, materialise


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the least node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node, component`` for every end of ``edges``; component is the least node.

    Edges may repeat, point either way or be loops; null ends are ignored. Two
    alternating passes (larger neighbours, then smaller ones, move to the least
    known node) double the reach in each round, so a chain of n nodes takes
    O(log n) rounds. Every pass is a min-aggregate and an equi-join: no group is
    gathered in one row, and a node of very high degree is split by the adaptive
    skew join. Rounds are written to the shared folder.
    """
    pair = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    loops = pair.where("a = b").select("a").distinct()
    now = materialise(
        pair.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "components",
    )
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    seen = now.select(mark.alias("s")).first()["s"]
    while True:
        after = materialise(_smaller_to_least(_larger_to_least(now)), "components")
        discard(now)
        now, before = after, seen
        seen = now.select(mark.alias("s")).first()["s"]
        if seen == before:
            break
    children = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    lone = loops.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return children.unionByName(roots).unionByName(lone.join(children.unionByName(roots), "node", "left_anti"))
