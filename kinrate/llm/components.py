"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinrate.plans.storage import discard, scratch, stage


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: neighbours are linked to the least node next to them.

    Large: of all neighbours, the larger ones. Small: the smaller ones and the node itself.
    """
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # stored, so that the join reads both sides from exchanges, where Spark splits a hub's links
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")), "least")
    joined = both.join(least, "a")
    if small:
        ends = joined.select("b", "least").unionByName(least.select(F.col("a").alias("b"), "least"))
    else:
        ends = joined.where("b > a").select("b", "least")
    return ends.where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the least node reachable.

    Each round only groups by node with partial sums and joins, so that a node with very
    many links is no single task's work. The rounds grow with the logarithm of the size.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(ordered.where("a > b").distinct(), "links")
    seen = _state(now)
    while seen[0]:
        before = now
        with scratch() as step:
            now = step.keep(_stars(stage(_stars(now, small=False), "large"), small=True), "small")
        discard(before)
        after = _state(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )
