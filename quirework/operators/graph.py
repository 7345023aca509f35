"""Connected components by alternating large-star and small-star rounds; no edge or label leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.sources.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(node, component) for every node of edges(a, b); component is the smallest node that is reachable.

    Each round is two hash aggregations with map-side minima and two joins and writes one table; rounds go on until
    all edges are stars.  A star of any size is done in the first round; a path of length n in about log n rounds.
    """
    known = scratch.cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{tag}-0")
    i = 0
    while not settled(known):
        i += 1
        both = known.union(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        now = scratch.cut(moved.where("u <> v").distinct(), f"{tag}-{i}")
        scratch.drop(f"{tag}-{i - 1}")
        known = now
    roots = known.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return known.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def settled(known: DataFrame) -> bool:
    """Whether every node has one edge up at most, and then none comes up to it."""
    ends = known.select(F.col("u").alias("x"), F.lit(1).alias("up")).union(known.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("least")).where("up > 1 or (up = 1 and least = 0)").isEmpty()


def merged(of: DataFrame | None, links: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``of`` (node, component) with further links (a, b): only the components that these join are looked at."""
    if of is None:
        return scratch.cut(components(links, scratch, tag), f"{tag}-of")
    side = lambda x: of.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    edges = links.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    joined = scratch.cut(components(edges, scratch, tag), f"{tag}-joined")
    moved = of.join(joined.select(F.col("node").alias("component"), F.col("component").alias("_to")), "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return scratch.cut(moved.union(joined.join(of, "node", "left_anti").select("node", "component")), f"{tag}-of")
