"""Planning of document work: dependency groups of pages, batches, waves, status, timing.

Everything is computed for all documents at once; ``doc`` is part of every key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.operators import graph, ordered
from quirework.sources.scratch import Scratch

#: Segment types that make a page high-risk.
RISKY_TYPES = ("UI", "image-text", "table-cell", "warning", "caption")
MOST_PAGES, TARGET_SEGMENTS, CONTEXT, MOST_PARALLEL = 8, 80, 1, 4


def page_edges(context: DataFrame, relations: DataFrame, segments: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc, a, b, reason) between pages that must go together.

    context(doc, on_page, page); relations(doc, segment_id, token): segments that share a token, or a token that is a
    segment id; segments(doc, segment_id, page); groups(doc, group, page): explicit groups.
    Shared tokens and groups become stars around their smallest page, so a token on m pages makes m - 1 edges.
    """
    placed = relations.join(segments, ["doc", "segment_id"]).select("doc", "token", "page")
    edges = context.select("doc", F.col("on_page").alias("a"), F.col("page").alias("b"), F.lit("context").alias("reason"))

    def star(rows: DataFrame, key: str, reason: str) -> DataFrame:
        low = rows.groupBy("doc", key).agg(F.min("page").alias("a"))
        return rows.join(low, ["doc", key]).select("doc", "a", F.col("page").alias("b"), F.lit(reason).alias("reason"))

    direct = placed.join(segments.select("doc", F.col("segment_id").alias("token"), F.col("page").alias("b")), ["doc", "token"]).select("doc", F.col("page").alias("a"), "b", F.lit("segment").alias("reason"))
    return edges.unionByName(star(placed, "token", "shared")).unionByName(direct).unionByName(star(groups, "group", "group")).where("a <> b").distinct()


def dependency_groups(pages: DataFrame, edges: DataFrame, scale: int = 1 << 20) -> DataFrame:
    """(doc, page, component, reasons): component is the smallest page of the group, reasons are sorted.

    ``doc`` is a whole number here and pages are below ``scale``; a node is doc * scale + page.
    """
    node = lambda p: F.col("doc").cast("long") * scale + F.col(p)
    of = graph.components(edges.select(node("a").alias("a"), node("b").alias("b")), Scratch(pages.sparkSession, "groups"), "pages")
    placed = pages.withColumn("_n", node("page")).join(of, F.col("_n") == F.col("node"), "left")
    placed = placed.select("doc", "page", F.coalesce(F.col("component") % scale, F.col("page")).cast("int").alias("component"))
    why = edges.select("doc", F.explode(F.array("a", "b")).alias("page"), "reason").join(placed, ["doc", "page"])
    reasons = why.groupBy("doc", "component").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
    return placed.join(reasons, ["doc", "component"], "left").select("doc", "page", "component", F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"))


def is_high(types: Column, marked: Column, visuals: Column, bindings: Column, contracts: Column) -> Column:
    """Aggregate over a group's segments: any risky type, marked page, visual, binding or contract."""
    return F.bool_or(types.isin(*RISKY_TYPES) | marked | (visuals > 0) | (bindings > 0) | (contracts > 0))


def plan(groups: DataFrame, most_pages: int = MOST_PAGES, target: int = TARGET_SEGMENTS, parallel: int = MOST_PARALLEL) -> DataFrame:
    """groups(doc, component, pages, segments, high) -> with batch, oversize and wave.

    Groups go in order of their first page.
    """
    batches = ordered.packed(groups, "doc", "component", "pages", "segments", most_pages, target)
    risk = batches.groupBy("doc", "batch").agg(F.bool_or("high").alias("high"))
    return batches.join(ordered.waves(risk, "doc", "batch", "high", parallel), ["doc", "batch"])


def digest(columns: list[str]) -> Column:
    """Digest of a row: SHA-256 of the JSON of a struct in this order of fields, nulls kept."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def status(batches: DataFrame, results: DataFrame, key: list[str]) -> DataFrame:
    """completed, pending or blocked per batch: a result counts where its plan digest agrees and it has no issue."""
    r = results.select(*key, F.col("plan_digest").alias("_digest"), F.col("issues").alias("_issues"), "elapsed")
    state = F.when(F.col("_digest").isNull(), "pending").when((F.col("_digest") != F.col("plan_digest")) | (F.col("_issues") > 0), "blocked").otherwise("completed")
    return batches.join(r, key, "left").select(*batches.columns, "elapsed", state.alias("state"))
