"""Joins: coverage, references, boxes, tolerances, best matches, precedence, budgets.

Theta joins get an equi key first (grid cells or value buckets), so they shuffle on a key and never compare all
pairs of a page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import geometry as g


def coverage(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with ``side`` missing or unexpected."""
    a = expected.select(*keys).distinct().withColumn("_e", F.lit(True))
    b = actual.select(*keys).distinct().withColumn("_a", F.lit(True))
    both = a.join(b, keys, "full_outer").where("_e is null or _a is null")
    return both.select(*keys, F.when(F.col("_a").isNull(), "missing").otherwise("unexpected").alias("side"))


def dangling(references: DataFrame, targets: DataFrame, reference: str, target: str) -> DataFrame:
    """Rows of ``references`` that point at nothing."""
    return references.where(F.col(reference).isNotNull()).join(targets.select(F.col(target).alias(reference)).distinct(), reference, "left_anti")


def outside_scope(rows: DataFrame, scope: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't in scope."""
    return rows.join(scope.select(*keys).distinct(), keys, "left_anti")


def import_translations(segments: DataFrame, translations: DataFrame, key: str = "segment_id") -> DataFrame:
    """Segments with their target text; preserved ones whose target is blank inherit the source text."""
    own = translations.select(key, F.col("target_text").alias("_t"))
    keep = F.col("action").startswith("preserve") & (F.trim(F.coalesce("_t", F.lit(""))) == "")
    return segments.drop("target_text").join(own, key).withColumn("target_text", F.when(keep, F.col("source_text")).otherwise(F.col("_t"))).drop("_t")


def reconciled(left: DataFrame, right: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Full outer join on ``keys``; ``state`` is missing, unbound, changed or equal."""
    a = left.select(*keys, F.struct(*compare).alias("_l"))
    b = right.select(*keys, F.struct(*compare).alias("_r"))
    state = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "unbound").when(F.col("_l") == F.col("_r"), "equal").otherwise("changed")
    return a.join(b, keys, "full_outer").select(*keys, state.alias("state"))


def grid_join(left: DataFrame, right: DataFrame, on: list[str], box_l: str, box_r: str, cell: float, predicate: Callable[[Column, Column], Column]) -> DataFrame:
    """Pairs of rows with equal ``on`` whose boxes meet, by grid cells.

    A box goes to every cell that it covers; a pair is kept only in the first cell that both cover, so it comes out
    once without a distinct.  Columns of the two sides must differ but for ``on``; ``predicate`` gets both boxes.
    """

    def cells(df: DataFrame, b: str, tag: str) -> DataFrame:
        span = lambda lo, hi: F.sequence(F.floor(F.col(f"{b}.{lo}") / cell).cast("int"), F.floor(F.col(f"{b}.{hi}") / cell).cast("int"))
        df = df.where((F.col(f"{b}.x0") <= F.col(f"{b}.x1")) & (F.col(f"{b}.y0") <= F.col(f"{b}.y1")))
        df = df.withColumns({f"_{tag}x": F.floor(F.col(f"{b}.x0") / cell).cast("int"), f"_{tag}y": F.floor(F.col(f"{b}.y0") / cell).cast("int")})
        return df.withColumn("_cx", F.explode(span("x0", "x1"))).withColumn("_cy", F.explode(span("y0", "y1")))

    both = cells(left, box_l, "l").join(cells(right, box_r, "r"), [*on, "_cx", "_cy"])
    first = (F.col("_cx") == F.greatest("_lx", "_rx")) & (F.col("_cy") == F.greatest("_ly", "_ry"))
    return both.where(first & predicate(F.col(box_l), F.col(box_r))).drop("_cx", "_cy", "_lx", "_ly", "_rx", "_ry")


def overlapping_pairs(boxes: DataFrame, on: list[str], ident: str, b: str, cell: float, least: float, relative: bool = True, apart: str | None = None) -> DataFrame:
    """Unordered pairs of one page whose shared area reaches ``least`` (of the smaller box, or absolutely above it).

    ``apart`` names a column in which the two must differ.
    """
    cols = [*on, ident, b, *([apart] if apart else [])]
    left = boxes.select(*[F.col(c).alias(c if c in on else f"{c}_l") for c in cols])
    right = boxes.select(*[F.col(c).alias(c if c in on else f"{c}_r") for c in cols])

    def test(x: Column, y: Column) -> Column:
        shared = g.shared_area(x, y)
        out = (F.col(f"{ident}_l") < F.col(f"{ident}_r")) & (shared > 0)
        if apart:
            out &= F.col(f"{apart}_l") != F.col(f"{apart}_r")
        return out & (shared / F.least(g.area(x), g.area(y)) >= least if relative else shared > least)

    return grid_join(left, right, on, f"{b}_l", f"{b}_r", cell, test)


def best_overlaps(candidates: DataFrame, sources: DataFrame, on: list[str], candidate: str, source: str, box_c: str, box_s: str, cell: float, least: float = 0.5) -> DataFrame:
    """For each candidate the source box that covers most of it; ties go to the first source."""
    ratio = g.shared_area(F.col(box_c), F.col(box_s)) / g.area(F.col(box_c))
    pairs = grid_join(candidates, sources, on, box_c, box_s, cell, lambda x, y: g.shared_area(x, y) > 0).withColumn("coverage", ratio)
    best = Window.partitionBy(*on, candidate).orderBy(F.desc("coverage"), F.asc(source))
    return pairs.withColumn("_r", F.row_number().over(best)).where((F.col("_r") == 1) & (F.col("coverage") >= least)).drop("_r")


def column_anchors(blocks: DataFrame, on: list[str], b: str, width: str) -> DataFrame:
    """Left edges, in tenths of the page width, that at least two blocks share."""
    return blocks.groupBy(*on, F.round(F.col(f"{b}.x0") / F.col(width), 1).alias("anchor")).agg(F.count("*").alias("support")).where("support >= 2")


def cross_column_pairs(blocks: DataFrame, on: list[str], ident: str, b: str, band: float, least: float = 0.4) -> DataFrame:
    """Pairs of a page side by side: apart horizontally, sharing at least ``least`` of the lower height."""

    def bands(df: DataFrame, tag: str) -> DataFrame:
        df = df.select(*on, F.col(ident).alias(f"{ident}_{tag}"), F.col(b).alias(f"{b}_{tag}"))
        low, high = F.floor(F.col(f"{b}_{tag}.y0") / band).cast("int"), F.floor(F.col(f"{b}_{tag}.y1") / band).cast("int")
        return df.withColumn(f"_{tag}", low).withColumn("_band", F.explode(F.sequence(low, high)))

    x, y = F.col(f"{b}_l"), F.col(f"{b}_r")
    aside = (x["x1"] <= y["x0"]) | (y["x1"] <= x["x0"])
    tall = F.least(g.height(x), g.height(y))
    pairs = bands(blocks, "l").join(bands(blocks, "r"), [*on, "_band"]).where(F.col("_band") == F.greatest("_l", "_r"))
    return pairs.where((F.col(f"{ident}_l") < F.col(f"{ident}_r")) & aside & (tall > 0) & (g.vertical_overlap(x, y) / tall >= least)).drop("_band", "_l", "_r")


def tolerance_join(left: DataFrame, right: DataFrame, on: list[str], value_l: list[str], value_r: list[str], tolerance: float) -> DataFrame:
    """Pairs with equal ``on`` whose values differ by at most ``tolerance`` each.

    The first value is bucketed at twice the tolerance; the right side visits the neighbouring buckets too.
    """
    width = 2 * tolerance
    a = left.withColumn("_b", F.floor(F.col(value_l[0]) / width))
    home = F.floor(F.col(value_r[0]) / width)
    b = right.withColumn("_b", F.explode(F.array(home - 1, home, home + 1)))
    near = F.lit(True)
    for x, y in zip(value_l, value_r):
        near &= F.abs(F.col(x) - F.col(y)) <= tolerance
    return a.join(b, [*on, "_b"]).where(near).drop("_b")


def exactly_once(declared: DataFrame, pairs: DataFrame, declaration: str, record: str) -> DataFrame:
    """Per declaration: matched, not_found, duplicate_match, or reused where its one record is claimed twice."""
    claims = pairs.select(declaration, record).distinct()
    counted = claims.withColumns({"_n": F.count("*").over(Window.partitionBy(declaration)), "_m": F.count("*").over(Window.partitionBy(record))})
    per = counted.groupBy(declaration).agg(F.max("_n").alias("matches"), F.max("_m").alias("claims"))
    state = F.when(F.col("matches").isNull(), "not_found").when(F.col("matches") > 1, "duplicate_match").when(F.col("claims") > 1, "reused").otherwise("matched")
    return declared.select(declaration).distinct().join(per, declaration, "left").select(declaration, state.alias("state"), F.coalesce("matches", F.lit(0)).alias("matches"))


def ambiguous(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs either of whose members has more than one partner."""
    n = pairs.withColumns({"_l": F.count("*").over(Window.partitionBy(left)), "_r": F.count("*").over(Window.partitionBy(right))})
    return n.where("_l <> 1 or _r <> 1").drop("_l", "_r")


def precedence_merge(layers: DataFrame, key: Column, layer: str = "layer", order: str | None = None) -> DataFrame:
    """One row per key: that of the highest layer; of rows of one layer the last by ``order``, else by their values."""
    row = F.struct(*layers.columns)
    rank = F.struct(F.col(layer), *([F.col(order)] if order else []), row)
    return layers.select(key.alias("key"), rank.alias("_rank"), row.alias("_row")).groupBy("key").agg(F.max_by("_row", "_rank").alias("_row")).select("key", "_row.*")


def over_budget(observed: DataFrame, allowed: DataFrame, keys: list[str], count: str = "n", allowance: str = "allowed") -> DataFrame:
    """Observed counts less what is allowed, where something is left."""
    return observed.join(allowed.select(*keys, allowance), keys, "left").withColumn("excess", F.greatest(F.col(count) - F.coalesce(allowance, F.lit(0)), F.lit(0))).where("excess > 0")


def context_pages(owned: DataFrame, selected: DataFrame, group: list[str], page: str, k: int = 1) -> DataFrame:
    """Selected pages within ``k`` of a group's own pages, without those."""
    near = owned.withColumn(page, F.explode(F.sequence(F.col(page) - k, F.col(page) + k))).distinct()
    shared = [c for c in selected.columns if c in owned.columns]
    return near.join(selected.distinct(), shared, "left_semi").join(owned, [*group, page], "left_anti")


def conflicts(rows: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """Groups that declare more than one canonical value."""
    return rows.groupBy(*group).agg(F.countDistinct(F.to_json(F.struct(*values))).alias("declared")).where("declared > 1")
