"""Layout contracts: member relations, dependent boxes, phrase groups, sweeps, superseded segments, inline sequences.

Each gives issue rows (keys, code); a contract without issues gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import geometry as g
from quirework.operators import joins

# Relation types of members.
CONTAINMENT, ALIGNMENT, CLEARANCE = ("contained_in", "contains"), ("align_center_x", "align_center_y", "align_baseline"), ("clearance",)


def member_relations(relations: DataFrame, boxes: DataFrame) -> DataFrame:
    """relations(group_id, component_id, target_id, type, min_clearance, max_delta); boxes(group_id, component_id, bbox)."""
    a = boxes.select("group_id", "component_id", F.col("bbox").alias("a"))
    b = boxes.select("group_id", F.col("component_id").alias("target_id"), F.col("bbox").alias("b"))
    r = relations.join(a, ["group_id", "component_id"], "left").join(b, ["group_id", "target_id"], "left")
    x, y = F.col("a"), F.col("b")
    middle = lambda q, lo, hi: (q[lo] + q[hi]) / 2
    off = (
        F.when(F.col("type") == "align_center_x", F.abs(middle(x, "x0", "x1") - middle(y, "x0", "x1")))
        .when(F.col("type") == "align_center_y", F.abs(middle(x, "y0", "y1") - middle(y, "y0", "y1")))
        .when(F.col("type") == "align_baseline", F.abs(x["y1"] - y["y1"]))
    )
    code = (
        F.when(x.isNull(), "COMPONENT_CANDIDATE_BBOX_MISSING")
        .when(y.isNull(), "COMPONENT_RELATION_TARGET_BBOX_MISSING")
        .when((F.col("type") == "contained_in") & ~g.inside(x, y, 0.001), "COMPONENT_CONTAINMENT_FAILED")
        .when((F.col("type") == "contains") & ~g.inside(y, x, 0.001), "COMPONENT_CONTAINMENT_FAILED")
        .when(off > F.col("max_delta") + 1e-6, "COMPONENT_ALIGNMENT_FAILED")
        .when((F.col("type") == "clearance") & (g.clearance(x, y) + 1e-6 < F.col("min_clearance")), "COMPONENT_MINIMUM_CLEARANCE_FAILED")
    )
    return r.select("group_id", "component_id", "target_id", code.alias("code")).where("code is not null")


def dependent_boxes(bindings: DataFrame, drivers: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Boxes whose four edges follow other boxes: (component_id, bbox, code).

    bindings(component_id, target_edge, basis, edge, driver_id, offset_pt); drivers(driver_id, basis, bbox).  A missing
    driver, a missing edge or an inverted result has a code and no box.
    """
    edge = F.element_at(F.create_map(*[x for e in g.EDGES for x in (F.lit(e), F.col(f"bbox.{e}"))]), F.col("edge"))
    r = bindings.join(drivers, ["driver_id", "basis"], "left").withColumn("v", edge + F.col("offset_pt"))
    per = r.groupBy("component_id").agg(F.countDistinct("target_edge").alias("edges"), F.count("*").alias("n"), F.count("v").alias("found"), *[F.max(F.when(F.col("target_edge") == e, F.col("v"))).alias(e) for e in g.EDGES])
    code = F.when((F.col("edges") != 4) | (F.col("n") != 4), "TRANSLATION_DEPENDENCY_EDGE_BINDINGS").when(F.col("found") < 4, "TRANSLATION_DEPENDENCY_DRIVER_BBOX_MISSING").when((F.col("x1") <= F.col("x0") + tolerance) | (F.col("y1") <= F.col("y0") + tolerance), "TRANSLATION_DEPENDENCY_BOUNDS")
    box = g.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 6)
    return per.withColumn("code", code).select("component_id", F.when(F.col("code").isNull(), box).alias("bbox"), "code")


def phrase_groups(members: DataFrame) -> DataFrame:
    """members(group_id, segment_id, ord, page, listed array<string>, phrase, separator, text): every listed member
    declares the same contract, all are there, on one page, and their texts in order give the phrase."""
    contract = F.to_json(F.struct("listed", "phrase", "separator"))
    per = members.groupBy("group_id").agg(
        F.countDistinct(contract).alias("contracts"),
        F.countDistinct("page").alias("pages"),
        F.array_sort(F.collect_set("segment_id")).alias("have"),
        F.min(F.array_sort("listed")).alias("want"),
        F.min("phrase").alias("phrase"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\u0000").alias("joined"),
        F.min("separator").alias("separator"),
    )
    text = F.replace("joined", F.lit("\u0000"), F.col("separator"))
    checks = [(F.col("contracts") > 1, "TABLE_CELL_PHRASE_CONFLICT"), (F.size(F.array_except("want", "have")) > 0, "TABLE_CELL_PHRASE_MEMBER_MISSING"), (F.size(F.array_except("have", "want")) > 0, "TABLE_CELL_PHRASE_DECLARATION_COVERAGE"), (F.col("pages") > 1, "TABLE_CELL_PHRASE_CONTEXT"), (text != F.col("phrase"), "TABLE_CELL_SOURCE_PHRASE_MISMATCH")]
    found = F.filter(F.array(*[F.when(c, F.lit(code)) for c, code in checks]), lambda x: x.isNotNull())
    return per.select("group_id", F.explode(found).alias("code"))


def sweep_issues(sweeps: DataFrame, sequences: DataFrame) -> DataFrame:
    """sweeps(sweep_id, set_id, expected_ids, expected_count); sequences(segment_id, set_id): the declared list equals the
    set's sequences, and every sequence is in exactly one sweep."""
    ids = sweeps.select("sweep_id", "set_id", F.explode("expected_ids").alias("segment_id"))
    gaps = joins.coverage(sequences.join(sweeps.select("set_id").distinct(), "set_id", "left_semi"), ids, ["set_id", "segment_id"])
    cover = gaps.select(F.col("set_id").alias("id"), F.when(F.col("side") == "missing", "INLINE_VISUAL_SWEEP_COVERAGE").otherwise("INLINE_VISUAL_SWEEP_UNKNOWN_SEGMENT").alias("code"))
    count = sweeps.where(F.size("expected_ids") != F.col("expected_count")).select(F.col("sweep_id").alias("id"), F.lit("INLINE_VISUAL_SWEEP_COUNT").alias("code"))
    twice = ids.groupBy("segment_id").agg(F.countDistinct("sweep_id").alias("n")).where("n > 1").select(F.col("segment_id").alias("id"), F.lit("INLINE_VISUAL_SWEEP_GLOBAL_COVERAGE").alias("code"))
    never = sequences.join(ids, "segment_id", "left_anti").select(F.col("segment_id").alias("id"), F.lit("INLINE_VISUAL_SWEEP_MISSING").alias("code"))
    return cover.unionByName(count).unionByName(twice).unionByName(never).distinct()


def superseded_issues(mapping: DataFrame, segments: DataFrame, covers: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """mapping(segment_id, owner_id); segments(segment_id, page, bbox); covers(owner_id, cover): a superseded segment lies
    inside one of its owner's covers on the same page."""
    s = segments.select("segment_id", F.col("page").alias("p"), "bbox")
    o = segments.select(F.col("segment_id").alias("owner_id"), F.col("page").alias("op"))
    c = covers.groupBy("owner_id").agg(F.collect_list("cover").alias("covers"))
    m = mapping.join(s, "segment_id", "left").join(o, "owner_id", "left").join(c, "owner_id", "left")
    covered = F.exists("covers", lambda x: g.inside(F.col("bbox"), x, tolerance))
    code = (
        F.when(F.col("p").isNull(), "INLINE_SUPERSEDED_UNKNOWN_SEGMENT")
        .when(F.col("op").isNull() | F.col("covers").isNull() | (F.col("owner_id") == F.col("segment_id")), "INLINE_SUPERSEDED_OWNER")
        .when(F.col("p") != F.col("op"), "INLINE_SUPERSEDED_PAGE")
        .when(~covered, "INLINE_SUPERSEDED_NOT_COVERED")
    )
    return m.select("segment_id", code.alias("code")).where("code is not null")


def inline_issues(relocations: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """relocations(segment_id, ord, label, source_bbox, target_bbox, dx, dy): moved without scaling, by what is declared."""
    s, t = F.col("source_bbox"), F.col("target_bbox")
    relocations = relocations.withColumn("_twice", F.count("*").over(Window.partitionBy("segment_id", "label")) > 1)
    checks = [
        (~g.same_size(s, t, tolerance), "INLINE_VISUAL_INTERNAL_SCALING"),
        ((F.abs(t["x0"] - s["x0"] - F.col("dx")) > tolerance) | (F.abs(t["y0"] - s["y0"] - F.col("dy")) > tolerance), "INLINE_VISUAL_SHIFT_MISMATCH"),
        (F.col("_twice"), "INLINE_VISUAL_LABEL_DUPLICATE"),
        (F.trim(F.coalesce("label", F.lit(""))) == "", "INLINE_VISUAL_SEMANTIC_LABEL"),
    ]
    found = F.filter(F.array(*[F.when(c, F.lit(code)) for c, code in checks]), lambda x: x.isNotNull())
    return relocations.select("segment_id", "ord", F.explode(found).alias("code"))


def adjusted_background(segments: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """(segment_id, source_bbox, target_bbox, avoid array<box>): a shrunk background stays inside its source and clear of
    every region to avoid."""
    s, t = F.col("source_bbox"), F.col("target_bbox")
    code = F.when(g.area(t) <= 0, "BACKGROUND_TARGET_BBOX").when(~g.inside(t, s, tolerance), "BACKGROUND_ADJUSTMENT_EXPANDS").when(F.exists("avoid", lambda a: g.shared_area(t, a) > 1e-4), "BACKGROUND_AVOID_REGION_INTERSECTION")
    return segments.select("segment_id", code.alias("code")).where("code is not null")


def resolved_colour(explicit: Column, sources: Column) -> Column:
    """Explicit, else the one source colour, else black; null where several sources leave it open."""
    return F.when(explicit.isNotNull(), explicit).when(F.size(sources) == 1, F.try_element_at(sources, F.lit(1))).when(F.coalesce(F.size(sources), F.lit(0)) == 0, F.lit(0))


def font_roles(fonts: DataFrame) -> DataFrame:
    """fonts(role, path, is_bold): one code for each role that its face doesn't suit, or that shares its file."""
    shared = F.count("*").over(Window.partitionBy("path")) > 1
    code = F.when((F.col("role") == "regular") & F.col("is_bold"), "REGULAR_FONT_ROLE_MISMATCH").when((F.col("role") == "bold") & ~F.col("is_bold"), "BOLD_FONT_ROLE_MISMATCH").when(shared, "SHARED_REGULAR_BOLD_FONT_PATH")
    return fonts.select("role", code.alias("code")).where("code is not null")
