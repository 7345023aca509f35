"""From text spans to segments: projections, selections and page metrics, for all pages of all documents at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import geometry as g
from quirework.functions import text as t
from quirework.plans.rules import PRESERVE_ACTIONS

# What a render block says where its specification doesn't.
RENDER_DEFAULTS = {"line_spacing": 1.18, "align": "left", "valign": "top"}
VECTOR_ACTION = "replace_vector_outlined_text"
EXAMPLES = 30
SHORT_BLOCK = 40


def spans(raw: DataFrame) -> DataFrame:
    """(.., block, line, span, text, bbox, size) -> with ref, sizes and boxes rounded; empty spans go."""
    six = g.box(*[F.round(F.col(f"bbox.{e}"), 3) for e in g.EDGES])
    ref = F.format_string("b%d.l%d.s%d", "block", "line", "span")
    return raw.where(F.coalesce("text", F.lit("")) != "").withColumns({"ref": ref, "bbox": six, "size": F.round("size", 3)})


def united(b: str) -> Column:
    """Aggregate: the union of boxes."""
    return g.box(F.min(f"{b}.x0"), F.min(f"{b}.y0"), F.max(f"{b}.x1"), F.max(f"{b}.y1"))


def lines(placed: DataFrame, page: list[str]) -> DataFrame:
    """Spans to lines: text in order of spans, union of boxes."""
    parts = F.array_sort(F.collect_list(F.struct("span", "text")))  # of one line
    out = placed.groupBy(*page, "block", "line").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"), united("bbox").alias("bbox"), F.max("size").alias("size"), F.count("*").alias("n_spans"))
    return out


def auto_segments(line_rows: DataFrame, page: list[str], joiner: str = " ") -> DataFrame:
    """One segment for each block of a page: key auto-block-NNN, reading order by block, stripped lines joined."""
    text = F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda p: F.btrim(p["text"]))  # of one block
    out = line_rows.groupBy(*page, "block").agg(F.btrim(F.array_join(text, joiner)).alias("source_text"), united("bbox").alias("bbox"), F.sum("n_spans").alias("n_spans"), F.max("size").alias("size"))
    order = F.row_number().over(Window.partitionBy(*page).orderBy("block"))
    return out.withColumns({"segment_key": F.format_string("auto-block-%03d", "block"), "reading_order": order})


def selected(refs: DataFrame, placed: DataFrame, page: list[str]) -> tuple[DataFrame, DataFrame]:
    """Spans that refs (page, ref_id, block, line, spans or null) name, and an issue for each ref that names none."""
    keys = [*page, "block", "line"]
    wanted = refs.where(F.col("spans").isNull() | (F.size("spans") > 0)).withColumn("_one", F.explode_outer("spans"))
    hit = wanted.join(placed, keys).where(F.col("_one").isNull() | (F.col("_one") == F.col("span"))).drop("_one", "spans")
    known = placed.select(*keys).distinct().withColumn("_known", F.lit(True))
    missing = wanted.where("_one is not null").join(placed.select(*keys, F.col("span").alias("_one")).distinct(), [*keys, "_one"], "left_anti").select(*page, "ref_id").distinct().withColumn("_span", F.lit(True))
    judged = refs.join(known, keys, "left").join(missing, [*page, "ref_id"], "left")
    code = F.when(F.col("_known").isNull(), "UNKNOWN_SOURCE_REF").when(F.size("spans") == 0, "SOURCE_REF_SELECTS_NO_SPANS").when(F.col("_span"), "UNKNOWN_SOURCE_SPAN")
    return hit, judged.select(*page, "ref_id", code.alias("code")).where("code is not null")


def render_block(action: Column, bbox: Column, target: Column, mask: Column) -> Column:
    """Defaults of a render block: replace, the segment's box as target, a mask only where text is replaced in place."""
    action = F.coalesce(action, F.lit("replace"))
    masked = ~action.isin(*PRESERVE_ACTIONS, VECTOR_ACTION)
    fixed = [F.lit(v).alias(k) for k, v in RENDER_DEFAULTS.items()]
    return F.struct(action.alias("action"), F.coalesce(target, bbox).alias("target_bbox"), F.when(masked, F.coalesce(mask, bbox)).alias("mask_bbox"), *fixed)


def translation_copy(segments: DataFrame, digest: Column, target: str = "target_text") -> DataFrame:
    """Segments as they go out to be translated: source digest, blank target, status reset, no assertions."""
    out = segments.drop("translation_note").withColumns({"source_segment_sha256": digest, target: F.lit(""), "status": F.lit("EXTRACTED")})
    return out.withColumn("translation_assertions", F.array().cast("array<string>")) if "translation_assertions" in segments.columns else out


def context_copy(segments: DataFrame) -> DataFrame:
    """What a neighbouring batch may see of a segment."""
    wanted = ("segment_id", "page", "semantic_type", "source_text", "protected_tokens", "relationships", "semantic_bindings")
    return segments.select(*[c for c in wanted if c in segments.columns], F.lit(True).alias("context_only"))


def explicit_tokens(texts: DataFrame, detected: DataFrame, explicit: DataFrame, keys: list[str], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Token bag in which explicit (keys, token, kind) replace detected ones, and issues of those that don't occur."""
    told = explicit.join(texts.select(*keys, text), keys).withColumn("source_count", t.count_of(F.col(text), F.col("token")).cast("long")).drop(text)
    told = told.withColumn("kind", F.coalesce("kind", F.lit("explicit")))
    there = told.where("source_count > 0")
    kept = detected.join(there.select(*keys, "token"), [*keys, "token"], "left_anti").select(*keys, "token", "kind", "source_count")
    issues = told.where("source_count = 0").select(*keys, "token", F.lit("EXPLICIT_TOKEN_ABSENT").alias("code"))
    return kept.unionByName(there.select(*keys, "token", "kind", "source_count")), issues


def page_metrics(blocks: DataFrame, keys: list[str], tokens: Column, text: str = "text") -> DataFrame:
    """Characters that aren't blank, tokens with up to EXAMPLES distinct ones, blocks, and the share of short blocks."""
    b = blocks.withColumn("_tokens", tokens)
    counts = b.groupBy(*keys).agg(
        F.sum(F.length(F.regexp_replace(text, r"\s+", ""))).alias("text_characters"),
        F.sum(F.size("_tokens")).cast("long").alias("token_count"),
        F.count("*").alias("text_blocks"),
        F.round(F.avg((F.length(F.btrim(text)) < SHORT_BLOCK).cast("int")), 3).alias("small_text_block_ratio"),
    )
    each = b.select(*keys, F.explode("_tokens").alias("token")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lower("token"), "token"))
    some = each.withColumn("_r", rank).where(F.col("_r") <= EXAMPLES)
    shown = some.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "token"))), lambda x: x["token"]), " ").alias("examples"))
    return counts.join(shown, keys, "left").withColumn("examples", F.coalesce("examples", F.lit("")))


def image_coverage(images: DataFrame, keys: list[str], page_box: str = "page_bbox", b: str = "bbox") -> DataFrame:
    """Images of a page and the share of it that they cover, each clipped to the page, at most 1."""
    share = F.least(F.sum(g.shared_area(F.col(b), F.col(page_box))) / F.first(g.area(F.col(page_box))), F.lit(1.0))
    return images.groupBy(*keys).agg(F.count("*").alias("image_count"), F.round(share, 3).alias("image_area_ratio"))


def histogram(rows: DataFrame, key: str) -> DataFrame:
    """Counts by value, as one sorted list of few values."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(key)


def best_by(rows: DataFrame, keys: list[str], score: Column, tie: str, values: list[str]) -> DataFrame:
    """Per group the row with the highest score; of equal ones that with the smallest ``tie``."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct((-score).alias("s"), F.col(tie))).alias("_b")).select(*keys, "_b.*")


def page_size_changes(sources: DataFrame, candidates: DataFrame, keys: list[str], tolerance: float = 0.75) -> DataFrame:
    """Pages whose width or height moved by more than ``tolerance`` points."""
    both = sources.select(*keys, F.col("width").alias("w"), F.col("height").alias("h")).join(candidates.select(*keys, "width", "height"), keys)
    return both.where((F.abs(F.col("w") - F.col("width")) > tolerance) | (F.abs(F.col("h") - F.col("height")) > tolerance)).select(*keys, F.lit("PAGE_SIZE_CHANGED").alias("code"))


def elapsed_seconds(began: Column, ended: Column) -> Column:
    """Seconds between two ISO instants with an offset; null where one has none, doesn't parse, or they are reversed."""
    offset = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"
    at = lambda c: F.when(c.rlike(offset), F.unix_micros(F.try_to_timestamp(c)))
    gap = (at(ended) - at(began)) / 1e6
    return F.when(gap >= 0, gap)


def coverage_counts(refs: DataFrame, selected_refs: DataFrame, ignored: DataFrame, keys: list[str], ref: str = "ref") -> DataFrame:
    """Spans of each document: all, taken by segments, ignored by name, and left over."""
    taken = selected_refs.select(*keys, ref).distinct().withColumn("_taken", F.lit(True))
    out = ignored.select(*keys, ref).distinct().withColumn("_ignored", F.lit(True))
    both = refs.select(*keys, ref).distinct().join(taken, [*keys, ref], "left").join(out, [*keys, ref], "left")
    left = F.col("_taken").isNull() & F.col("_ignored").isNull()
    return both.groupBy(*keys).agg(F.count("*").alias("spans"), F.count("_taken").alias("taken"), F.count("_ignored").alias("ignored"), F.count_if(left).alias("unassigned"))


def line_layout(lines: DataFrame, keys: list[str], ordinal: str, width: str, box: Column, align: Column, valign: Column, height: Column) -> DataFrame:
    """Where the lines of a text stand in their box: top plus line heights, shifted by both alignments."""
    group = Window.partitionBy(*keys)
    i = F.row_number().over(group.orderBy(ordinal)) - 1
    room = g.height(box) - F.count("*").over(group) * height
    top = box["y0"] + F.when(valign == "middle", room / 2).when(valign == "bottom", room).otherwise(0.0)
    gap = g.width(box) - F.col(width)
    left = box["x0"] + F.when(align == "center", gap / 2).when(align == "right", gap).otherwise(0.0)
    return lines.withColumns({"x": F.round(left, 6), "y": F.round(top + i * height, 6)})


def has_protected_background(members: Column) -> Column:
    """Whether a component declares a background that stays or is adjusted."""
    return F.exists(members, lambda m: (m["role"] == "background") & m["policy"].isin("preserve", "adjust_background"))


def in_order(segments: DataFrame, doc: str) -> DataFrame:
    """Segments by page, reading order and id, as artefacts list them."""
    return segments.orderBy(doc, "page", "reading_order", "segment_id")


def largest(rows: DataFrame, groups: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The largest value of each group, 0 for one without rows."""
    return groups.join(rows.groupBy(*keys).agg(F.max(value).alias("largest")), keys, "left").withColumn("largest", F.coalesce("largest", F.lit(0)))
