"""Aggregations: duplicates, style rollups, page metrics, residue bags, status lattice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as t

#: Worst wins.  One vocabulary for all gates.
SEVERITIES = ("PASS", "NEEDS_REVIEW", "BLOCKED")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def worst(severity: Column) -> Column:
    """Aggregate: the worst severity, PASS where there is none."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity)
    return F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.coalesce(F.max(rank), F.lit(1)).cast("int"))


def style_rollup(spans: DataFrame, keys: list[str], *, font: str, size: str, colour: str, flags: str, ordinal: str) -> DataFrame:
    """Modal font (ties to the first seen), sizes, sorted colours, bold and italic by flag bits."""
    per = spans.groupBy(*keys, font).agg(F.count("*").alias("_n"), F.min(ordinal).alias("_first"))
    modal = per.groupBy(*keys).agg(F.max_by(font, F.struct(F.col("_n"), -F.col("_first"), F.col(font))).alias("primary_font"))
    positive = F.when(F.col(size) > 0, F.col(size))
    rest = spans.groupBy(*keys).agg(
        F.round(F.coalesce(F.avg(positive), F.lit(0.0)), 3).alias("size"),
        F.round(F.coalesce(F.min(positive), F.lit(0.0)), 3).alias("min_size"),
        F.round(F.coalesce(F.max(positive), F.lit(0.0)), 3).alias("max_size"),
        F.bool_or(F.col(flags).bitwiseAND(16) != 0).alias("bold"),
        F.bool_or(F.col(flags).bitwiseAND(2) != 0).alias("italic"),
        F.array_sort(F.collect_set(colour)).alias("source_colors"),
    )
    return rest.join(modal, keys)


def box_union(boxes: DataFrame, keys: list[str], b: str = "bbox") -> DataFrame:
    return boxes.groupBy(*keys).agg(F.struct(F.min(f"{b}.x0").alias("x0"), F.min(f"{b}.y0").alias("y0"), F.max(f"{b}.x1").alias("x1"), F.max(f"{b}.y1").alias("y1")).alias(b))


def ordered_text(rows: DataFrame, keys: list[str], ordinal: str, text: str, separator: str = "") -> DataFrame:
    """Texts of a group joined in order."""
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(ordinal, text))), lambda x: x[text]), separator).alias(text))


def residue(texts: DataFrame, keys: list[str], text: str, allowed: DataFrame | None = None, column: str = "token") -> DataFrame:
    """Counts of Latin-script tokens that are neither allowed (folded) nor like model codes; with their first place."""
    tokens = texts.select(*keys, F.posexplode(t.english_tokens(F.col(text))).alias("place", "token")).where(~t.is_model_like(F.col("token")))
    if allowed is not None:
        tokens = tokens.withColumn("_k", t.folded(F.col("token"))).join(allowed.select(t.folded(F.col(column)).alias("_k")).distinct(), "_k", "left_anti").drop("_k")
    return tokens.groupBy(*keys, "token").agg(F.count("*").alias("n"), F.min("place").alias("first"))


def status_of_page(chars: Column, ratio: Column, images: Column, drawings: Column, blocks: Column, small: Column, columns: Column, pairs: Column) -> tuple[Column, Column]:
    """(route, reasons) of a page by its metrics; the first of the exclusive routes wins, else reasons add up.

    Fixed values: the thresholds.
    """
    reasons = F.filter(
        F.array(
            F.when(drawings >= 25, F.lit("drawings")),
            F.when((blocks >= 18) & (small >= 0.4), F.lit("dense-blocks")).when((blocks >= 6) & (small >= 0.5), F.lit("short-blocks")),
            F.when((columns >= 3) | (pairs >= 4), F.lit("columns")),
        ),
        lambda r: r.isNotNull(),
    )
    route = (
        F.when((chars < 20) & (ratio >= 0.65), "scanned-rebuild")
        .when((chars < 20) & (images == 0), "manual-review")
        .when((ratio >= 0.35) | ((images >= 2) & (chars < 180)), "image-overlay")
        .when(F.size(reasons) > 0, "structured")
        .otherwise("prose")
    )
    overlay = F.filter(F.array(F.lit("image-coverage"), F.when((drawings >= 20) | (blocks >= 12), F.lit("mixed-structure"))), lambda r: r.isNotNull())
    return route, (
        F.when(route == "scanned-rebuild", F.array(F.lit("raster-page")))
        .when(route == "manual-review", F.array(F.lit("no-text")))
        .when(route == "image-overlay", overlay)
        .when(route == "structured", reasons)
        .otherwise(F.array(F.lit("plain")))
    )


def semantic_class(text: Column, max_size: Column, any_bold: Column) -> Column:
    bullet = F.ltrim(text).rlike("^[•-]")
    return F.when(bullet, "list").when((max_size >= 11) | ((F.length(text) < 70) & any_bold), "heading").otherwise("paragraph")


def wave_times(results: DataFrame, wave: str = "wave", elapsed: str = "elapsed") -> DataFrame:
    """Worker seconds, and wall seconds when each wave takes as long as its slowest batch."""
    waves = results.groupBy(wave).agg(F.sum(elapsed).alias("_sum"), F.max(elapsed).alias("_max"))
    return waves.agg(F.sum("_sum").alias("worker_seconds"), F.sum("_max").alias("wall_seconds"), F.count("*").alias("waves"))


def tree_digest(files: DataFrame, keys: list[str], path: str, digest: str) -> DataFrame:
    """SHA-256 over ``path digest`` lines in order of path."""
    lines = F.array_sort(F.collect_list(F.concat(F.col(path), F.lit(" "), F.col(digest))))
    return files.groupBy(*keys).agg(F.sha2(F.array_join(lines, "\n"), 256).alias("tree_sha256"))


def multiset_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Signed counts that differ: positive where ``a`` has more."""
    both = a.select(*keys, F.lit(1).alias("_d")).unionByName(b.select(*keys, F.lit(-1).alias("_d")))
    return both.groupBy(*keys).agg(F.sum("_d").alias("delta")).where("delta <> 0")
