"""Drawing and path records: canonical forms, tolerance equality, signatures, rewrites and their postconditions.

A drawing is a struct of rect, style fields and ``ops``: array<struct<op,coords>> in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import geometry as g
from quirework.operators import matching

# Operators with their number of coordinates, and tolerances.
ARITY = {"l": 4, "c": 8, "re": 4, "qu": 8}
RECT_TOLERANCE, STYLE_TOLERANCE = 0.001, 1e-6
EXACT = ("type", "even_odd", "close_path", "layer", "dashes")
SCHEMA = "doc_id string, page int, idx int, rect struct<x0:double,y0:double,x1:double,y1:double>, type string, fill array<double>, color array<double>, width double, line_join double, fill_opacity double, stroke_opacity double, dashes string, layer string, even_odd boolean, close_path boolean, ops array<struct<op:string,coords:array<double>>>"


def issues(drawings: DataFrame) -> DataFrame:
    """Records that aren't well-formed, instead of dropping them: (doc_id, page, idx, code)."""
    known = F.create_map(*[F.lit(x) for item in ARITY.items() for x in item])
    checks = [
        (F.col("rect").isNull() | ~g.finite(F.col("rect.x0") + F.col("rect.y0") + F.col("rect.x1") + F.col("rect.y1")), "DRAWING_FIELD_MALFORMED"),
        (F.exists(F.coalesce("fill", F.array().cast("array<double>")), lambda x: (x < 0) | (x > 1)) | F.exists(F.coalesce("color", F.array().cast("array<double>")), lambda x: (x < 0) | (x > 1)), "DRAWING_FIELD_MALFORMED"),
        (F.col("ops").isNull() | (F.size("ops") == 0), "DRAWING_RECORD_MALFORMED"),
        (F.exists("ops", lambda o: ~o["op"].isin(*ARITY)), "DRAWING_OPERATOR_UNKNOWN"),
        (F.exists("ops", lambda o: o["op"].isin(*ARITY) & ((F.size(o["coords"]) != F.try_element_at(known, o["op"])) | F.exists(o["coords"], lambda x: ~g.finite(x)))), "DRAWING_OPERATOR_MALFORMED"),
    ]
    found = F.array_distinct(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for c, code in checks]), lambda x: x.isNotNull()))
    return drawings.select("doc_id", "page", "idx", F.explode(found).alias("code"))


def canonical(record: str = "") -> Column:
    """Digest of a drawing with coordinates at six decimals: equal records meet in a hash join."""
    p = f"{record}." if record else ""
    six = lambda a: F.transform(F.coalesce(F.col(p + a), F.array().cast("array<double>")), lambda x: F.round(x, 6) + 0.0)
    ops = F.transform(F.col(p + "ops"), lambda o: F.struct(o["op"].alias("op"), F.transform(o["coords"], lambda x: F.round(x, 6) + 0.0).alias("coords")))
    rect = g.box(*[F.round(F.col(f"{p}rect.{e}"), 6) + 0.0 for e in g.EDGES])
    fields = [rect.alias("rect"), six("fill").alias("fill"), six("color").alias("color"), *[F.round(F.col(p + n), 6).alias(n) for n in ("width", "line_join", "fill_opacity", "stroke_opacity")], *[F.col(p + n).alias(n) for n in EXACT], ops.alias("ops")]
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def near_arrays(a: Column, b: Column, tolerance: float) -> Column:
    """Equal lengths and members within tolerance; nulls equal each other."""
    same = (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= tolerance), lambda x: F.coalesce(x, F.lit(False)))
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(same)


def equal_within(a: Column, b: Column) -> Column:
    """Tolerance equality of two drawings: exact fields, rect and width, colours and opacities, operators in pairs."""
    out = g.same_box(a["rect"], b["rect"], RECT_TOLERANCE)
    for n in EXACT:
        out &= a[n].eqNullSafe(b[n])
    out &= F.coalesce(F.abs(a["width"] - b["width"]) <= RECT_TOLERANCE, a["width"].isNull() & b["width"].isNull())
    for n in ("line_join", "fill_opacity", "stroke_opacity"):
        out &= F.coalesce(F.abs(a[n] - b[n]) <= STYLE_TOLERANCE, a[n].isNull() & b[n].isNull())
    for n in ("fill", "color"):
        out &= near_arrays(a[n], b[n], STYLE_TOLERANCE)
    pairs = F.zip_with(a["ops"], b["ops"], lambda x, y: (x["op"] == y["op"]) & near_arrays(x["coords"], y["coords"], RECT_TOLERANCE))
    return out & (F.size(a["ops"]) == F.size(b["ops"])) & F.forall(pairs, lambda x: F.coalesce(x, F.lit(False)))


def missing(sources: DataFrame, candidates: DataFrame) -> DataFrame:
    """(doc_id, page, idx) of source drawings without a partner in a maximum one-to-one matching of their page.

    Tolerance isn't transitive, so pairing exact copies first can cost a partner.  It is done by hash and rank only
    for signatures that no other signature of the other side is within tolerance of; all rows of the rest meet under
    tolerance and are matched by augmenting paths.
    """

    def ranked(df: DataFrame) -> DataFrame:
        df = df.withColumn("_key", canonical())
        return df.withColumn("_k", F.row_number().over(Window.partitionBy("doc_id", "page", "_key").orderBy("idx")))

    s, c = ranked(sources), ranked(candidates)
    keys = ["doc_id", "page", "_key", "_k"]
    fields = [n for n in sources.columns if n not in ("doc_id", "page", "idx")]
    one = lambda df, side: df.where("_k = 1").select("doc_id", "page", F.size("ops").alias("n"), F.col("_key").alias(f"key_{side}"), F.struct(*fields).alias(side))
    near = one(s, "a").join(one(c, "b"), ["doc_id", "page", "n"]).where((F.col("key_a") != F.col("key_b")) & equal_within(F.col("a"), F.col("b")))
    mixed = near.select("doc_id", "page", F.explode(F.array("key_a", "key_b")).alias("_key")).distinct().withColumn("_mixed", F.lit(True))
    s, c = (df.join(mixed, ["doc_id", "page", "_key"], "left") for df in (s, c))
    sure = lambda df: df.where("_mixed is null").select(*keys)
    rest_s, rest_c = s.join(sure(c), keys, "left_anti"), c.join(sure(s), keys, "left_anti")
    a = rest_s.select("doc_id", "page", F.col("idx").alias("s"), F.struct(*fields).alias("a"), F.size("ops").alias("n"))
    b = rest_c.select("doc_id", "page", F.col("idx").alias("c"), F.struct(*fields).alias("b"), F.size("ops").alias("n"))
    pairs = a.join(b, ["doc_id", "page", "n"]).where(equal_within(F.col("a"), F.col("b"))).select(F.concat_ws("#", "doc_id", "page").alias("g"), "s", "c")
    matched = matching.maximum_matching(pairs, "g", "s", "c").select("g", "s")
    rest = rest_s.select("doc_id", "page", "idx", F.concat_ws("#", "doc_id", "page").alias("g"), F.col("idx").alias("s"))
    return rest.join(matched, ["g", "s"], "left_anti").select("doc_id", "page", "idx")


def operator_histogram(drawings: DataFrame) -> DataFrame:
    return drawings.select("doc_id", F.explode("ops").alias("o")).groupBy("doc_id", F.col("o.op").alias("op")).agg(F.count("*").alias("n"))


def touching(drawings: DataFrame, b: Column, least: float = 0.01) -> DataFrame:
    """Records whose rect meets a box in more than ``least`` square points; order and repetition stay."""
    return drawings.where(g.shared_area(F.col("rect"), b) > least)


def rule_segments(drawings: DataFrame, slack: float = 0.75) -> DataFrame:
    """Stroked straight segments, horizontal or vertical within ``slack``: (doc_id, page, idx, box)."""
    o = drawings.where(F.col("type").contains("s")).select("doc_id", "page", "idx", F.explode("ops").alias("o")).where("o.op = 'l'")
    x = lambda i: F.element_at("o.coords", i)
    straight = (F.abs(x(1) - x(3)) <= slack) | (F.abs(x(2) - x(4)) <= slack)
    return o.where(straight).select("doc_id", "page", "idx", g.box(F.least(x(1), x(3)), F.least(x(2), x(4)), F.greatest(x(1), x(3)), F.greatest(x(2), x(4))).alias("box"))


def translated(drawings: DataFrame, dx: float, dy: float) -> DataFrame:
    """Rect and all coordinates moved."""
    move = lambda v, i: v + F.when(i % 2 == 0, F.lit(dx)).otherwise(F.lit(dy))
    ops = F.transform("ops", lambda o: F.struct(o["op"].alias("op"), F.transform(o["coords"], move).alias("coords")))
    r = F.col("rect")
    return drawings.withColumns({"rect": g.box(r["x0"] + dx, r["y0"] + dy, r["x1"] + dx, r["y1"] + dy), "ops": ops})


def removal_plan(paths: DataFrame, selected: DataFrame) -> DataFrame:
    """Which operation ranges go from each stream, last first, and why a path can't: clipped, shared or overlapping ranges.

    paths: rows of content_paths; selected(doc_id, page, xref, path_index).
    """
    keys = ["doc_id", "page", "xref"]
    chosen = paths.join(selected, [*keys, "path_index"])
    order = Window.partitionBy(*keys).orderBy("first_op", "path_index")
    before = F.max("last_op").over(order.rowsBetween(Window.unboundedPreceding, -1))
    same = F.count("*").over(Window.partitionBy(*keys, "first_op", "last_op"))
    code = F.when(F.col("clip").isNotNull(), "CONTENT_PATH_CLIP_REPLACEMENT_FORBIDDEN").when(same > 1, "CONTENT_PATH_OPERATION_RANGE_NOT_UNIQUE").when(before >= F.col("first_op"), "CONTENT_PATH_OPERATION_RANGE_OVERLAP")
    planned = chosen.withColumn("code", code)
    return planned.select(*keys, "path_index", "first_op", "last_op", "code", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("first_op"))).alias("step"))


def reserialised(a: Column, b: Column) -> Column:
    """Same path but for curves whose second control point is their end written as lines, or the reverse."""

    def pair(x: Column, y: Column) -> Column:
        end = lambda o: F.slice(o["coords"], F.size(o["coords"]) - 1, 2)
        flat = lambda o: F.slice(o["coords"], 1, 2) == end(o)
        as_line = ((x["op"] == "y") & (y["op"] == "l") & flat(x)) | ((x["op"] == "l") & (y["op"] == "y") & flat(y))
        return ((x["op"] == y["op"]) & near_arrays(x["coords"], y["coords"], 1e-6)) | (as_line & near_arrays(end(x), end(y), 1e-6))

    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, pair), lambda x: F.coalesce(x, F.lit(False)))


def restore_plan(source: DataFrame, candidate: DataFrame) -> DataFrame:
    """Candidate paths that are their source re-serialised, one to one; ambiguous ones get a code.

    Only paths with a degenerate curve or a line are compared, bucketed by operator count, clip, paint and matrix.
    """
    keys = ["doc_id", "page", "xref"]
    bucket = [*keys, "n", "c", "paint", "m"]
    key = lambda df: df.withColumns({"n": F.size("ops"), "c": F.coalesce("clip", F.lit("")), "m": F.to_json(F.transform("ctm", lambda v: F.round(v, 4)))})
    s = key(source.where(F.exists("ops", lambda o: o["op"].isin("y", "l")))).select(*bucket, F.col("path_index").alias("s"), F.col("ops").alias("a"))
    t = key(candidate.where(F.exists("ops", lambda o: o["op"].isin("y", "l")))).select(*bucket, F.col("path_index").alias("t"), F.col("ops").alias("b"))
    pairs = s.join(t, bucket).where(reserialised(F.col("a"), F.col("b"))).select(*keys, "s", "t", (F.to_json("a") != F.to_json("b")).alias("changed"))
    degree = pairs.withColumns({"_s": F.count("*").over(Window.partitionBy(*keys, "s")), "_t": F.count("*").over(Window.partitionBy(*keys, "t"))})
    return degree.where("changed or _s > 1 or _t > 1").select(*keys, "s", "t", F.when((F.col("_s") > 1) | (F.col("_t") > 1), F.lit("RESERIALIZED_PATH_AMBIGUOUS")).alias("code"))
