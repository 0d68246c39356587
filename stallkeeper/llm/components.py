"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F


def components(links: DataFrame, stage: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """``node, component`` of every node of the links ``a, b``; a component is its least node.

    The star operations (Kiveris et al., Connected Components in MapReduce and Beyond) rewire links
    towards the least neighbour until every node hangs on its component's least node. The minimum of
    a node's neighbours combines before the shuffle; the join that brings it back to the links is by the node,
    so the links of a star's centre (two numbers each) meet in one task unless adaptive execution splits it. The
    iteration writes the links of each round to shared storage.
    """
    a, b = F.col("a"), F.col("b")
    now = links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    number = 0
    while True:
        number += 1
        # Large star: neighbours above a node are linked to the least node around it.
        both = now.unionAll(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where(b > a).join(least, "a").where(b != F.col("m"))
        large = large.select(b.alias("a"), F.col("m").alias("b"))
        # Small star: a node and its lower neighbours are linked to the least of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
        small = small.unionAll(least.select("a", F.col("m").alias("b")))
        now = stage(small.where(a != b).distinct(), f"{name}_{number}")
        # Done when no node has two parents, or is both a parent and a child.
        ends = now.select(a.alias("node"), F.lit(2).alias("x")).unionAll(
            now.select(b.alias("node"), F.lit(1).alias("x")).distinct()
        )
        if ends.groupBy("node").agg(F.sum("x").alias("x")).where("x > 2").isEmpty():
            break
    roots = now.select(b.alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stage(now.select(a.alias("node"), b.alias("component")).unionAll(roots), f"{name}_done")
