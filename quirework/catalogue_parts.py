"""Registered queries of geometry, drawings, ordering and text parts over tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.catalogue import query, table
from quirework.functions import geometry as g
from quirework.functions import text as t
from quirework.operators import drawings, joins, ordered
from quirework.plans import planner, rules


@query("SELECT l_orderkey, l_partkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) + 9 AS INTEGER) AS n FROM lineitem")
def numbered_rows(spark, sf_dir):
    """Ordinals within a group, from 10."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return ordered.numbered(rows, ["l_orderkey"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], "n", 10).select("l_orderkey", "l_partkey", "n")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 3")
def top_of_group(spark, sf_dir):
    """The report of the three dearest orders of each customer."""
    return ordered.top(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("""
WITH t AS (SELECT l_orderkey, max(CASE WHEN l_quantity > 40 THEN 'text ' || l_orderkey ELSE '  ' END) AS target FROM lineitem GROUP BY 1)
SELECT o_orderkey AS segment_id, CASE WHEN o_orderstatus = 'F' AND trim(target, ' ') = '' THEN o_orderpriority ELSE target END AS target_text FROM orders JOIN t ON l_orderkey = o_orderkey
""")
def translation_import(spark, sf_dir):
    """Orders take their lines' texts as translations; preserved ones with a blank one keep their source."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("segment_id"), F.when(F.col("o_orderstatus") == "F", "preserve").otherwise("replace").alias("action"), F.col("o_orderpriority").alias("source_text"), F.lit(None).cast("string").alias("target_text"))
    text = F.when(F.col("l_quantity") > 40, F.concat(F.lit("text "), F.col("l_orderkey").cast("string"))).otherwise("  ")
    tr = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("segment_id")).agg(F.max(text).alias("target_text"))
    return joins.import_translations(o, tr).select("segment_id", "target_text")


@query(r"""
SELECT doc_id, CAST((length(text) - length(replace(lower(text), 'the', ''))) // 3 AS INTEGER) AS forbidden,
  CAST((length(regexp_replace(text, '[ \t\r\n\f\v]+', '', 'g')) - length(replace(regexp_replace(text, '[ \t\r\n\f\v]+', '', 'g'), 'enand', ''))) // 5 AS INTEGER) AS required FROM documents WHERE regexp_full_match(text, '[\x00-\x7F]*')
""")
def required_and_forbidden(spark, sf_dir):
    """Counts of a forbidden text whatever its case, and of a required one whatever the blanks, in ASCII documents."""
    d = table(spark, sf_dir, "documents").where(F.col("text").rlike(r"^[\x00-\x7F]*$"))
    return d.select("doc_id", t.forbidden_count(F.col("text"), F.lit("THE")).alias("forbidden"), t.required_count(F.col("text"), F.lit("en and")).alias("required"))


@query("SELECT p_partkey, lower(regexp_replace(replace(p_name, ' ', '_.'), '[-_.]+', '-', 'g')) AS package FROM part")
def package_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", t.package_name(F.replace("p_name", F.lit(" "), F.lit("_."))).alias("package"))


def part_boxes(spark, sf_dir) -> DataFrame:
    """Parts as boxes on pages of 60 by 100, some of them over the edge."""
    k = F.col("p_partkey")
    x, y = (k % 53).cast("double"), (k % 89).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", g.box(x, y, x + F.col("p_size"), y + 12).alias("b"), g.box(*[F.lit(v) for v in (0.0, 0.0, 60.0, 100.0)]).alias("page"))


@query("""
WITH b AS (SELECT p_partkey, CAST(p_partkey % 53 AS DOUBLE) AS x, CAST(p_partkey % 89 AS DOUBLE) AS y, p_size AS w FROM part)
SELECT p_partkey, greatest(0.0, x - 2.5)::DOUBLE AS ex0, least(100.0, y + 14.5)::DOUBLE AS ey1, 100.0 - (y + 12) AS fy0, 100.0 - y AS fy1, round(x * 300 / 72, 6) AS px,
  round(w / 2.0 + x - 1, 6)::DOUBLE AS center_x, printf('%d', p_partkey) || ':' || printf('%.2f', x) || ':' || printf('%.2f', y) || ':' || printf('%.2f', x + w) || ':' || printf('%.2f', y + 12) AS signature FROM b
""")
def box_arithmetic(spark, sf_dir):
    """Boxes grown within their page, flipped to user space, in pixels, against an anchor, and as image signatures."""
    b, page = F.col("b"), F.col("page")
    e, f = g.expanded(b, 2.5, page), g.flipped(b, F.lit(100.0))
    a = g.anchored(g.box(*[F.lit(v) for v in (1.0, 1.0, 5.0, 5.0)]), b)
    return part_boxes(spark, sf_dir).select("p_partkey", e["x0"].alias("ex0"), e["y1"].alias("ey1"), f["y0"].alias("fy0"), f["y1"].alias("fy1"), F.round(g.pixels(b["x0"]), 6).alias("px"), F.round(a["center_x"], 6).alias("center_x"), g.image_signature(F.col("p_partkey").cast("string"), b).alias("signature"))


@query("""
WITH p AS (SELECT DISTINCT l_orderkey AS a, l_partkey AS b FROM lineitem)
SELECT a, b FROM (SELECT *, count(*) OVER (PARTITION BY a) AS n, count(*) OVER (PARTITION BY b) AS m FROM p) WHERE n <> 1 OR m <> 1
""")
def ambiguous_pairs(spark, sf_dir):
    """Orders and parts that aren't each other's only partner."""
    p = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b")).distinct()
    return joins.ambiguous(p, "a", "b")


def drawn(spark, sf_dir) -> DataFrame:
    """Lines of orders as drawings: a stroke that is level for odd parts, a rectangle and a curve."""
    n, q, p = F.col("l_linenumber").cast("double"), F.col("l_quantity").cast("double"), F.col("l_partkey")
    stroke = F.struct(F.lit("l").alias("op"), F.array(n, n, n + q, F.when(p % 2 == 1, n + 0.5).otherwise(n + 9)).alias("coords"))
    other = F.struct(F.when(p % 3 == 0, F.lit("re")).otherwise(F.lit("c")).alias("op"), F.array(n, n, q, q).alias("coords"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.col("l_partkey").alias("idx"), g.box(n, n, n + q, n + 9).alias("rect"), F.when(p % 5 == 0, F.lit("f")).otherwise(F.lit("s")).alias("type"), F.array(stroke, other).alias("ops"))


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, op, CAST(count(*) AS BIGINT) AS n FROM (SELECT l_orderkey, unnest(['l', CASE WHEN l_partkey % 3 = 0 THEN 're' ELSE 'c' END]) AS op FROM lineitem) GROUP BY 1, 2
""")
def operator_histogram(spark, sf_dir):
    return drawings.operator_histogram(drawn(spark, sf_dir))


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_partkey AS idx FROM lineitem
WHERE greatest(least(CAST(l_linenumber + l_quantity AS DOUBLE), 30) - greatest(CAST(l_linenumber AS DOUBLE), 20), 0) * greatest(least(l_linenumber + 9.0, 12) - greatest(l_linenumber, 4), 0) > 0.01
""")
def touching_drawings(spark, sf_dir):
    """Drawings that meet a region; repetition stays."""
    return drawings.touching(drawn(spark, sf_dir), g.box(*[F.lit(v) for v in (20.0, 4.0, 30.0, 12.0)])).select("doc_id", "idx")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_partkey AS idx, CAST(l_linenumber + l_quantity AS DOUBLE) AS x1, l_linenumber + CASE WHEN l_partkey % 2 = 1 THEN 0.5 ELSE 9 END::DOUBLE AS y1 FROM lineitem
WHERE l_partkey % 5 <> 0 AND (l_partkey % 2 = 1 OR l_quantity <= 0.75)
""")
def rule_lines(spark, sf_dir):
    """Stroked segments that are level or upright within tolerance."""
    return drawings.rule_segments(drawn(spark, sf_dir)).select("doc_id", "idx", "box.x1", "box.y1")


@query("""
SELECT o_custkey AS doc, bool_or(o_orderpriority IN ('1-URGENT') OR o_orderstatus = 'P') AS high FROM (SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders) GROUP BY 1
""")
def high_risk_groups(spark, sf_dir):
    """Groups with a risky segment type or a marked page."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.when(F.col("o_orderpriority") == "1-URGENT", "warning").otherwise("paragraph").alias("type"), (F.col("o_orderstatus") == "P").alias("marked"))
    return o.groupBy("doc").agg(planner.is_high(F.col("type"), F.col("marked"), F.lit(0), F.lit(0), F.lit(0)).alias("high"))


@query("""
WITH r AS (SELECT p_partkey AS k FROM part)
SELECT k AS page, CASE WHEN k % 4 = 1 OR k % 6 = 0 THEN 'BLOCKED' WHEN k % 4 = 2 THEN 'NEEDS_REVIEW' ELSE 'PASS' END AS status FROM r
""")
def page_reviews(spark, sf_dir):
    """Reviews of pages: some not done, some failed, some bound to another file."""
    k, done = F.col("page"), F.col("page") % 4 != 2
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("page"))
    ok = lambda: F.lit("PASS")
    note = F.concat(t.page_reference(k), F.lit(": all labels compared with the source, none cut"))
    p = p.select("page", F.when(k % 4 == 2, "NOT_REVIEWED").when(k % 4 == 1, "FAIL").otherwise("PASS").alias("visual"), ok().alias("image_text"), ok().alias("geometry"), ok().alias("legibility"), F.when(done, "someone").alias("reviewer"), F.when(done, "2024-05-01T10:00:00+08:00").alias("reviewed_at"), F.when(done, t.page_reference(k)).alias("page_reference"), F.lit(300).alias("review_dpi"), F.lit("x").alias("compare_sha256"), F.when((k % 6 == 0) & done, "y").when(done, "x").alias("reviewed_sha256"), F.when(done, note).alias("notes"))
    p = p.withColumn("review_dpi", F.when((k % 6 == 0) & ~done, 900).otherwise(F.col("review_dpi")))
    return rules.verdict(p, rules.check(p, rules.review_rules(), ["page"]), ["page"])


@query("SELECT p_partkey AS pack, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_size > 40 THEN 'BLOCKED' ELSE 'PASS' END AS status FROM part")
def packs_of_parts(spark, sf_dir):
    """Parts as packs: unsafe paths, versions that aren't ones, cores that are too new."""
    k = F.col("pack")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pack"), "p_size")
    p = p.select("pack", F.when(k % 5 == 0, "1.0").otherwise("1.0.0").alias("version"), F.repeat(F.lit("a"), 64).alias("digest"), F.concat(F.lit("0."), F.col("p_size").cast("string"), F.lit(".0")).alias("min_core"), F.lit("2.0.0").alias("max_core"), F.when(k % 7 == 0, F.array(F.lit("a/../g.csv"))).otherwise(F.array(F.lit("g.csv"))).alias("paths"))
    return rules.verdict(p, rules.check(p, rules.pack_rules("0.40.0"), ["pack"]), ["pack"])


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'BLOCKED' WHEN page_id % 3 = 1 THEN 'NEEDS_REVIEW' ELSE 'PASS' END AS status FROM pages")
def preflight_pages(spark, sf_dir):
    """Pages behind a file header, with a launch action, a link, or neither."""
    k = F.col("page_id")
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("%PDF-1.7 "), F.when(k % 3 == 0, F.lit("/Launch ")).when(k % 3 == 1, F.lit("/URI ")).otherwise(F.lit("")), F.regexp_replace(F.coalesce("html", F.lit("")), "/", " ")).alias("latin"))
    return rules.verdict(p, rules.check(p, rules.preflight_rules(), ["page_id"]), ["page_id"])


@query("""
SELECT o_orderkey AS segment_id, CASE WHEN o_orderkey % 2 = 0 THEN 'AMBIGUOUS_SOURCE_TEXT_COLOR' ELSE 'SOURCE_TEXT_COLOR_CHANGED' END AS code FROM orders WHERE o_orderkey % 3 > 0 AND (o_orderkey % 2 = 0 OR o_orderkey % 5 = 0)
UNION ALL SELECT o_orderkey, 'TEXT_COLOR_POLICY' FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 7 = 0
""")
def colour_issues(spark, sf_dir):
    """Orders as segments with one or two source colours; every third is preserved and not judged."""
    k = F.col("segment_id")
    s = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("segment_id"))
    fragments = F.lit(None).cast("array<struct<text_color:array<double>,text_color_basis:string>>")
    s = s.select("segment_id", F.when(k % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0xFF0000))).alias("source_colors"), F.when(k % 7 == 0, "any").otherwise("preserve_source_exact").alias("policy"), F.when(k % 2 == 0, F.lit(None)).when(k % 5 == 0, F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))).alias("text_color"), F.lit(None).cast("string").alias("text_color_basis"), F.when(k % 3 == 0, "preserve").otherwise("replace").alias("action"), fragments.alias("fragments"))
    return rules.check(s, rules.colour_rules(), ["segment_id"]).select("segment_id", "code")


@query("""
WITH m AS (SELECT page_id, CAST(length(url) AS BIGINT) % 40 AS chars, page_id % 5 AS images, page_id % 31 AS drawings, page_id % 23 AS blocks, (page_id % 10) / 10.0 AS ratio, (page_id % 7) / 7.0 AS small FROM pages),
r AS (SELECT *, CASE WHEN chars < 20 AND ratio >= 0.65 THEN 'scanned-rebuild' WHEN chars < 20 AND images = 0 THEN 'manual-review' WHEN ratio >= 0.35 OR (images >= 2 AND chars < 180) THEN 'image-overlay'
  WHEN drawings >= 25 OR (blocks >= 18 AND small >= 0.4) OR (blocks >= 6 AND small >= 0.5) THEN 'structured' ELSE 'prose' END AS route FROM m)
SELECT page_id, route, CASE route WHEN 'scanned-rebuild' THEN 'raster-page' WHEN 'manual-review' THEN 'no-text' WHEN 'image-overlay' THEN 'image-coverage' || CASE WHEN drawings >= 20 OR blocks >= 12 THEN ',mixed-structure' ELSE '' END
  WHEN 'structured' THEN array_to_string(list_filter([CASE WHEN drawings >= 25 THEN 'drawings' END, CASE WHEN blocks >= 18 AND small >= 0.4 THEN 'dense-blocks' WHEN blocks >= 6 AND small >= 0.5 THEN 'short-blocks' END], lambda x: x IS NOT NULL), ',') ELSE 'plain' END AS reasons FROM r
""")
def page_routes(spark, sf_dir):
    """Routes and reasons over metrics that vary in every input but the columns'."""
    from quirework.operators.aggregates import status_of_page

    k = F.col("page_id")
    m = table(spark, sf_dir, "pages").select("page_id", (F.length("url") % 40).alias("chars"), (k % 5).alias("images"), (k % 31).alias("drawings"), (k % 23).alias("blocks"), ((k % 10) / 10.0).alias("ratio"), ((k % 7) / 7.0).alias("small"))
    route, why = status_of_page(*[F.col(c) for c in ("chars", "ratio", "images", "drawings", "blocks", "small")], F.lit(1), F.lit(0))
    return m.select("page_id", route.alias("route"), F.array_join(why, ",").alias("reasons"))
