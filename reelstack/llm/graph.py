"""Connected components by alternating large-star and small-star steps.

Both steps are group-by and join only, each shrinks the edge set towards stars
around the least node of a component, and their number grows with the logarithm
of the longest path. No list of nodes, edges or components leaves the executors;
the driver sees one count and one checksum per round. Every round is written to
the shared scratch folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelstack.session import materialize


def _least_neighbour(pairs: DataFrame, with_self: bool) -> DataFrame:
    """(u, v) plus the least of v over u (and u itself). The least is stored
    first: a join of two plain exchanges can split a node with many neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if with_self:
        least = least.withColumn("m", F.least("u", "m"))
    return pairs.join(materialize(least, "cc_least"), "u")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    linked = _least_neighbour(_both_ways(edges), with_self=True)
    return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _least_neighbour(down, with_self=False)
    stars = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return stars.unionByName(linked.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): the component is
    its least node. Loops, repeated edges and either direction are fine; nodes
    must not be null."""
    edges = materialize(edges.select("u", "v").filter("u <> v").distinct(), "cc_edges")
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen, n = state(edges), 0
    while seen[0]:
        edges = materialize(_small_star(_large_star(edges)), f"cc_round_{n}")
        now, n = state(edges), n + 1
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("component")))
