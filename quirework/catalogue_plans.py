"""Registered queries of extraction, nested JSON and integrity, and their SQL; they join the others in ``catalogue``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.catalogue import query, table
from quirework.functions import geometry as g
from quirework.functions import text as t
from quirework.operators import aggregates, nested
from quirework.plans import extraction, integrity, rules

# --- text lines of documents as spans: three lines make a block, each line is one span ---------------------------

SPANS = """raw AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS nth, x AS text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE x <> ''),
s AS (SELECT doc_id, CAST(nth // 3 AS INTEGER) AS block, CAST(nth % 3 AS INTEGER) AS line, text, CAST(10.1234567 AS DOUBLE) AS x0, CAST(12.0 * nth AS DOUBLE) AS y0, CAST(10.1234567 + length(text) AS DOUBLE) AS x1, CAST(12.0 * nth + 10 AS DOUBLE) AS y1 FROM raw)"""


def raw_spans(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "text"))
    y, x0 = 12.0 * F.col("at"), F.lit(10.1234567)
    b = g.box(x0, y, x0 + F.length("text"), y + 10)
    return d.select("doc_id", F.floor(F.col("at") / 3).cast("int").alias("block"), (F.col("at") % 3).alias("line"), F.lit(0).alias("span"), "text", b.alias("bbox"), F.lit(9.87654).alias("size"))


@query(f"WITH {SPANS} SELECT doc_id, 'b' || block || '.l' || line || '.s0' AS ref, round(x0, 3) AS x0, round(x1, 3) AS x1, round(y1, 3) AS y1, 9.877::DOUBLE AS size FROM s")
def span_projection(spark, sf_dir):
    """Spans with their refs, boxes and sizes rounded."""
    s = extraction.spans(raw_spans(spark, sf_dir))
    return s.select("doc_id", "ref", "bbox.x0", "bbox.x1", "bbox.y1", "size")


@query(f"""
WITH {SPANS},
b AS (SELECT doc_id, block, trim(string_agg(trim(text, ' '), ' ' ORDER BY line), ' ') AS source_text, count(*) AS n_spans, round(max(x1), 3) AS x1, round(max(y1), 3) AS y1 FROM s GROUP BY 1, 2)
SELECT doc_id, 'auto-block-' || lpad(CAST(block AS VARCHAR), CAST(greatest(3, length(CAST(block AS VARCHAR))) AS INTEGER), '0') AS segment_key, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY block) AS INTEGER) AS reading_order,
  sha256(source_text) AS text_sha256, CAST(n_spans AS BIGINT) AS n_spans, x1, y1, 'replace' AS action, y1 AS mask_y1 FROM b
""")
def auto_segments(spark, sf_dir):
    """Segments of pages without a layout specification, with their render defaults."""
    lines = extraction.lines(extraction.spans(raw_spans(spark, sf_dir)), ["doc_id"])
    out = extraction.auto_segments(lines, ["doc_id"])
    box = F.col("bbox")
    r = extraction.render_block(F.lit(None).cast("string"), box, F.lit(None).cast(f"{g.BOX}"), F.lit(None).cast(f"{g.BOX}"))
    out = out.withColumn("r", r)
    return out.select("doc_id", "segment_key", "reading_order", F.sha2(F.col("source_text").cast("binary"), 256).alias("text_sha256"), "n_spans", "r.target_bbox.x1", "r.target_bbox.y1", "r.action", F.col("r.mask_bbox.y1").alias("mask_y1"))


@query(f"""
WITH {SPANS},
r AS (SELECT doc_id, doc_id % 4 AS block, doc_id % 3 AS line, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN [] WHEN 2 THEN [7] ELSE [0] END AS spans FROM labels),
k AS (SELECT r.doc_id, r.spans, s.doc_id IS NOT NULL AS known FROM r LEFT JOIN s ON s.doc_id = r.doc_id AND s.block = r.block AND s.line = r.line)
SELECT doc_id, CASE WHEN NOT known THEN 'UNKNOWN_SOURCE_REF' WHEN len(spans) = 0 THEN 'SOURCE_REF_SELECTS_NO_SPANS' WHEN spans = [7] THEN 'UNKNOWN_SOURCE_SPAN' ELSE 'OK' END AS code FROM k
""")
def ref_selection(spark, sf_dir):
    """A ref for each label: spans that it names, or why it names none."""
    placed = extraction.spans(raw_spans(spark, sf_dir))
    k = F.col("doc_id")
    spans = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.array().cast("array<int>")).when(k % 5 == 2, F.array(F.lit(7))).otherwise(F.array(F.lit(0)))
    refs = table(spark, sf_dir, "labels").select("doc_id", F.lit("r").alias("ref_id"), (k % 4).cast("int").alias("block"), (k % 3).cast("int").alias("line"), spans.cast("array<int>").alias("spans"))
    hit, issues = extraction.selected(refs, placed, ["doc_id"])
    return hit.select("doc_id", F.lit("OK").alias("code")).unionByName(issues.select("doc_id", "code"))


@query("""
SELECT o_orderkey AS segment_id, sha256('{"segment_id":' || o_orderkey || ',"page":' || o_custkey || ',"semantic_type":"' || o_orderpriority || '"}') AS source_segment_sha256, '' AS target_text, 'EXTRACTED' AS status FROM orders
""")
def translation_copies(spark, sf_dir):
    """Orders as segments that go out to be translated, bound to their digests."""
    from quirework.plans.planner import digest

    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("segment_id"), F.col("o_custkey").alias("page"), F.col("o_orderpriority").alias("semantic_type"), F.col("o_orderstatus").alias("status"))
    return extraction.translation_copy(o, digest(["segment_id", "page", "semantic_type"])).select("segment_id", "source_segment_sha256", "target_text", "status")


@query("""
WITH e AS (SELECT doc_id, unnest(['en', 'the ', 'zq#7']) AS token FROM documents),
n AS (SELECT e.doc_id, e.token, CAST((length(d.text) - length(replace(d.text, e.token, ''))) // length(e.token) AS BIGINT) AS n FROM e JOIN documents d USING (doc_id) WHERE d.text IS NOT NULL)
SELECT doc_id, token, n AS source_count, CASE WHEN n = 0 THEN 'EXPLICIT_TOKEN_ABSENT' ELSE 'explicit' END AS kind FROM n
UNION ALL SELECT doc_id, 'detected', 1, 'code' FROM documents WHERE text IS NOT NULL
""")
def explicit_token_bag(spark, sf_dir):
    """Explicit tokens over detected ones; those that don't occur are issues."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    found = d.select("doc_id", F.explode(F.array(F.lit("detected"), F.lit("en"))).alias("token"), F.lit("code").alias("kind"), F.lit(1).cast("long").alias("source_count"))
    found = found.join(d.where(t.count_of(F.col("text"), F.lit("en")) > 0).select("doc_id", F.lit("en").alias("token")).unionByName(d.select("doc_id", F.lit("detected").alias("token"))), ["doc_id", "token"], "left_semi")
    told = d.select("doc_id", F.explode(F.array(F.lit("en"), F.lit("the "), F.lit("zq#7"))).alias("token"), F.lit(None).cast("string").alias("kind"))
    bag, issues = extraction.explicit_tokens(d, found, told, ["doc_id"])
    return bag.select("doc_id", "token", "source_count", "kind").unionByName(issues.select("doc_id", "token", F.lit(0).cast("long").alias("source_count"), F.col("code").alias("kind")))


@query("""
WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents),
k AS (SELECT doc_id, text, list_filter(regexp_extract_all(text, '[A-Za-z]+'), lambda w: len(w) > 1) AS w FROM b WHERE trim(text, ' ') <> ''),
c AS (SELECT doc_id, CAST(sum(length(regexp_replace(text, '[ \t\r\n\f\v]+', '', 'g'))) AS BIGINT) AS text_characters, CAST(sum(len(w)) AS BIGINT) AS token_count, CAST(count(*) AS BIGINT) AS text_blocks,
  round(avg(CASE WHEN length(trim(text, ' ')) < 40 THEN 1 ELSE 0 END), 3) AS small_text_block_ratio FROM k GROUP BY 1),
t AS (SELECT DISTINCT doc_id, unnest(w) AS token FROM k),
r AS (SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY lower(token), token) AS i FROM t),
x AS (SELECT doc_id, string_agg(token, ' ' ORDER BY i) AS examples FROM r WHERE i <= 30 GROUP BY 1)
SELECT c.*, coalesce(x.examples, '') AS examples FROM c LEFT JOIN x USING (doc_id)
""")
def page_metrics(spark, sf_dir):
    """Lines of a document as blocks of a page; examples are the first 30 tokens, as the report shows them."""
    b = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("text")).where(F.btrim("text") != "")
    words = F.filter(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), lambda w: F.length(w) > 1)
    return extraction.page_metrics(b, ["doc_id"], words)


@query("""
SELECT l_orderkey AS page, CAST(count(*) AS BIGINT) AS image_count, round(least(sum(greatest(least(CAST(l_quantity AS DOUBLE) + 20, 50) - CAST(l_quantity AS DOUBLE), 0) * 10) / 1000.0, 1.0), 3) AS image_area_ratio
FROM lineitem GROUP BY 1
""")
def image_coverage(spark, sf_dir):
    """Lines of an order as images 20 by 10 at their quantity on a page of 50 by 20; what hangs over doesn't count."""
    q = F.col("l_quantity").cast("double")
    i = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), g.box(q, F.lit(0.0), q + 20, F.lit(10.0)).alias("bbox"), g.box(*[F.lit(x) for x in (0.0, 0.0, 50.0, 20.0)]).alias("page_bbox"))
    return extraction.image_coverage(i, ["page"])


@query("SELECT o_orderpriority AS route, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def route_histogram(spark, sf_dir):
    return extraction.histogram(table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "route"), "route")


@query("SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey) AS k FROM lineitem) WHERE k = 1")
def best_by_score(spark, sf_dir):
    """The part of the largest quantity of each order, ties to the smallest."""
    return extraction.best_by(table(spark, sf_dir, "lineitem"), ["l_orderkey"], F.col("l_quantity"), "l_partkey", ["l_partkey"])


@query("SELECT p_partkey, 'PAGE_SIZE_CHANGED' AS code FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 11 = 0")
def page_size_changes(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", (600.0 + F.col("p_size")).alias("width"), F.lit(800.0).alias("height"))
    moved = p.withColumns({"width": F.when(F.col("p_partkey") % 7 == 0, F.col("width") + 0.76).otherwise(F.col("width") + 0.75), "height": F.when(F.col("p_partkey") % 11 == 0, 799.0).otherwise(F.col("height"))})
    return extraction.page_size_changes(p, moved, ["p_partkey"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (4, 5) THEN NULL ELSE CAST((o_orderkey % 6 - 1) * 60 + 3600 AS DOUBLE) END AS seconds FROM orders
""")
def elapsed_times(spark, sf_dir):
    """Instants with offsets: one without, one malformed, and the others an hour and some minutes apart."""
    k = F.col("o_orderkey") % 6
    minutes = F.lpad((F.lit(10) + k).cast("string"), 2, "0")
    ended = F.when(k == 4, F.lit("2024-05-01T12:00:00")).when(k == 5, F.lit("2024-13-01T12:00:00Z")).otherwise(F.concat(F.lit("2024-05-01T12:"), minutes, F.lit(":00+02:00")))
    return table(spark, sf_dir, "orders").select("o_orderkey", extraction.elapsed_seconds(F.lit("2024-05-01T09:11:00Z"), ended).alias("seconds"))


@query(f"""
WITH {SPANS} SELECT doc_id, CAST(count(*) AS BIGINT) AS spans, CAST(count(*) FILTER (block % 2 = 0) AS BIGINT) AS taken, CAST(count(*) FILTER (line = 2) AS BIGINT) AS ignored, CAST(count(*) FILTER (block % 2 = 1 AND line < 2) AS BIGINT) AS unassigned FROM s GROUP BY 1
""")
def span_coverage(spark, sf_dir):
    s = extraction.spans(raw_spans(spark, sf_dir))
    return extraction.coverage_counts(s, s.where("block % 2 = 0"), s.where("line = 2"), ["doc_id"])


@query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity AS w FROM lineitem WHERE l_linenumber = 1 OR l_linenumber = 2 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity) = 1),
n AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS i FROM l)
SELECT l_orderkey, l_linenumber, round(CAST(10 + CASE l_orderkey % 3 WHEN 1 THEN (90 - w) / 2.0 WHEN 2 THEN 90 - w ELSE 0 END AS DOUBLE), 6) AS x, round(CAST(20 + i * 14.16 + CASE l_orderkey % 2 WHEN 1 THEN (80 - n * 14.16) / 2.0 ELSE 0 END AS DOUBLE), 6) AS y FROM n
""")
def line_layout(spark, sf_dir):
    """The first two lines of an order as lines of a text, aligned three ways in a box of 90 by 80."""
    from pyspark.sql import Window

    k = F.col("l_orderkey")
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_quantity")
    l = table(spark, sf_dir, "lineitem").where("l_linenumber in (1, 2)").withColumn("_r", F.row_number().over(w)).where("_r = 1").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("w"))  # noqa: E741
    box = g.box(*[F.lit(v) for v in (10.0, 20.0, 100.0, 100.0)])
    out = extraction.line_layout(l, ["l_orderkey"], "l_linenumber", "w", box, F.when(k % 3 == 1, "center").when(k % 3 == 2, "right").otherwise("left"), F.when(k % 2 == 1, "middle").otherwise("top"), F.lit(14.16))
    return out.select("l_orderkey", "l_linenumber", "x", "y")


@query("SELECT c_custkey, CAST(coalesce(max(o_orderkey), 0) AS BIGINT) AS largest FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def largest_or_zero(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").cast("long").alias("o_orderkey"))
    return extraction.largest(rows, table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], "o_orderkey")


@query("SELECT p_partkey, p_partkey % 3 = 0 AND p_partkey % 2 < 2 AS protected FROM part")
def protected_backgrounds(spark, sf_dir):
    """Components of parts: a background with one of two policies, or only an icon."""
    k = F.col("p_partkey")
    member = F.struct(F.when(k % 3 == 0, "background").otherwise("icon").alias("role"), F.when(k % 2 == 0, "preserve").otherwise("adjust_background").alias("policy"))
    return table(spark, sf_dir, "part").select("p_partkey", extraction.has_protected_background(F.array(member)).alias("protected"))


@query("SELECT o_custkey AS doc, o_orderkey AS segment_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_shippriority, o_orderdate, o_orderkey) AS INTEGER) AS nth FROM (SELECT *, o_orderkey % 3 AS o_shippriority FROM (SELECT o_custkey, o_orderkey, o_orderdate FROM orders))")
def segment_order(spark, sf_dir):
    """Orders as segments, by page, reading order and id; their places within the document."""
    from quirework.operators import ordered

    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("segment_id"), (F.col("o_orderkey") % 3).alias("page"), F.col("o_orderdate").alias("reading_order"))
    return ordered.numbered(extraction.in_order(o, "doc"), ["doc"], ["page", "reading_order", "segment_id"], "nth").select("doc", "segment_id", "nth")


# --- nested JSON --------------------------------------------------------------------------------------------------


def order_json(spark, sf_dir, moved: bool = False) -> DataFrame:
    """Orders and their lines as one JSON text each; ``moved`` changes some numbers and one truth value."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    q = F.col("l_quantity").cast("double")
    q = F.when(F.col("l_linenumber") == 2, q + 0.4).when(F.col("l_linenumber") == 3, q + 0.6).otherwise(q) if moved else q
    item = F.struct(F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("part_id"), q.alias("quantity"), F.array(F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("supplier_ids"))
    rows = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", item.alias("x")))).alias("a"))
    flag = F.when(F.col("l_orderkey") % 9 == 0, F.lit("1")).otherwise(F.lit("true")) if moved else F.lit("true")
    body = F.expr("substring(to_json(struct(transform(a, x -> x.x) as lines)), 2)")
    return rows.select("l_orderkey", F.concat(F.lit('{"done":'), flag, F.lit(","), body).alias("json"))


@query("""
SELECT l_orderkey, 'part-' || l_partkey AS id FROM lineitem UNION SELECT l_orderkey, 's' || l_suppkey FROM lineitem
""")
def json_id_leaves(spark, sf_dir):
    """Every id below an order's JSON, whatever its depth."""
    return nested.id_leaves(order_json(spark, sf_dir), ["l_orderkey"], "json")


@query("""
WITH n AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS i, l_linenumber FROM lineitem)
SELECT l_orderkey, '$.lines[' || i || '].quantity' AS path FROM n WHERE l_linenumber = 3
UNION ALL SELECT DISTINCT l_orderkey, '$.done' FROM lineitem WHERE l_orderkey % 9 = 0
""")
def json_differences(spark, sf_dir):
    """Nested values against a copy: 0.4 is within tolerance, 0.6 isn't, and true isn't 1."""
    return nested.differing(order_json(spark, sf_dir), order_json(spark, sf_dir, moved=True), ["l_orderkey"], "json", 0.5)


@query("""
SELECT p_partkey, 'size' AS key, 'MISSING_KEY' AS code FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 'extra', 'UNKNOWN_KEY' FROM part WHERE p_partkey % 4 = 0
""")
def json_key_issues(spark, sf_dir):
    k = F.col("p_partkey")
    json = F.concat(F.lit('{"id":'), k.cast("string"), F.when(k % 3 != 0, F.lit(',"size":1')).otherwise(F.lit("")), F.when(k % 4 == 0, F.lit(',"extra":null')).otherwise(F.lit("")), F.lit("}"))
    return nested.key_issues(table(spark, sf_dir, "part").select("p_partkey", json.alias("json")), ["p_partkey"], "json", ("id", "size"))


@query("SELECT p_partkey, p_brand AS brand, CASE WHEN p_partkey % 2 = 0 THEN 'new' ELSE p_type END AS kind FROM part")
def map_overlay(spark, sf_dir):
    """A member's fields with an adjustment over them."""
    base = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("kind"), F.col("p_type"))
    patch = F.when(F.col("p_partkey") % 2 == 0, F.create_map(F.lit("kind"), F.lit("new"))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    p = table(spark, sf_dir, "part").withColumn("m", nested.patched(base, patch))
    return p.select("p_partkey", F.col("m")["brand"].alias("brand"), F.col("m")["kind"].alias("kind"))


# --- integrity ----------------------------------------------------------------------------------------------------


@query("""
WITH r AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'r' || (doc_id % 2) END AS ref_id, 1 + doc_id % 3 AS page FROM documents),
e AS (SELECT r.doc_id, r.ref_id, r.page, trim(regexp_replace(substr(d.text, 3, 30), '[ \t\r\n\f\v]+', ' ', 'g'), ' ') AS excerpt FROM r JOIN documents d ON d.doc_id = r.doc_id + (r.doc_id % 3)),
t AS (SELECT doc_id, trim(regexp_replace(text, '[ \t\r\n\f\v]+', ' ', 'g'), ' ') AS text FROM documents)
SELECT doc_id, ref_id, 'DOCUMENT_CONTEXT_REF_PAGE' AS code FROM e WHERE page > 2 AND ref_id <> ''
UNION ALL SELECT doc_id, ref_id, 'DOCUMENT_CONTEXT_REF_ID' FROM e WHERE ref_id = ''
UNION ALL SELECT doc_id, ref_id, 'DOCUMENT_CONTEXT_REF_SOURCE' FROM e WHERE coalesce(excerpt, '') = '' AND ref_id <> ''
UNION ALL SELECT e.doc_id, e.ref_id, 'DOCUMENT_CONTEXT_REF_MISMATCH' FROM e JOIN t USING (doc_id) WHERE e.page = 1 AND e.ref_id <> '' AND excerpt <> '' AND NOT coalesce(contains(t.text, e.excerpt), false) AND t.text IS NOT NULL
""")
def context_ref_issues(spark, sf_dir):
    """Excerpts of this or a following document, looked for on the page that their reference names."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    r = d.select("doc_id", F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("r"), (k % 2).cast("string"))).alias("ref_id"), (1 + k % 3).cast("int").alias("page"), (k + k % 3).alias("of"), F.lit(1).alias("position"))
    r = r.join(d.select(k.alias("of"), F.substring("text", 3, 30).alias("excerpt")), "of").drop("of")
    pages = d.select("doc_id", F.lit(1).alias("page"), "text")
    return integrity.context_ref_issues(r, pages, d.select("doc_id", F.lit(2).alias("page_count")), "doc_id").select("doc_id", "ref_id", "code")


@query("""
WITH o AS (SELECT o_custkey AS plan, o_orderkey // 2 AS batch_id, o_orderkey AS segment_id FROM orders),
n AS (SELECT o_custkey AS plan, o_orderkey AS segment_id FROM orders WHERE o_orderkey % 13 <> 0),
p AS (SELECT DISTINCT plan FROM o)
SELECT plan, CAST(NULL AS VARCHAR) AS id, 'PLAN_SCHEMA' AS code FROM p WHERE plan % 17 = 0
UNION ALL SELECT plan, NULL, 'PLAN_DIGEST_MISMATCH' FROM p WHERE plan % 19 = 0
UNION ALL SELECT plan, CAST(batch_id AS VARCHAR), 'PLAN_DUPLICATE_BATCH' FROM o GROUP BY plan, batch_id HAVING count(*) > 1
UNION ALL SELECT DISTINCT plan, CAST(batch_id AS VARCHAR), 'PLAN_RECORDS_DIFFER' FROM o WHERE segment_id % 11 = 0
UNION ALL SELECT plan, CAST(segment_id AS VARCHAR), 'PLAN_COVERAGE' FROM o WHERE segment_id % 13 = 0
""")
def plan_integrity(spark, sf_dir):
    """Customers as plans and their orders as segments; some records, order entries and digests are off."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("plan"), F.floor(F.col("o_orderkey") / 2).alias("batch_id"), F.col("o_orderkey").alias("segment_id"))
    k = F.col("plan")
    plans = o.select("plan").distinct().select("plan", F.when(k % 17 == 0, "other").otherwise(integrity.PLAN_SCHEMA).alias("schema"), F.when(k % 19 == 0, "x").otherwise("y").alias("declared_digest"), F.lit("y").alias("body_digest"))
    return integrity.plan_issues(plans, o.select("plan", "batch_id"), o, o.where("segment_id % 11 <> 0"), o.where("segment_id % 13 <> 0"), "plan")


@query("""
WITH c AS (SELECT c_custkey AS doc FROM customer), s AS (SELECT o_custkey AS doc, o_orderkey AS segment_id, 1 + o_orderkey % 4 AS page FROM orders)
SELECT doc, CAST(NULL AS VARCHAR) AS id, 'MANIFEST_SCHEMA' AS code FROM c WHERE doc % 5 = 0
UNION ALL SELECT doc, NULL, 'MANIFEST_STATUS' FROM c WHERE doc % 7 = 0
UNION ALL SELECT doc, NULL, 'REPORT_STALE' FROM c WHERE doc % 11 = 0
UNION ALL SELECT doc, NULL, 'REPORT_NOT_PASS' FROM c WHERE doc % 13 = 0
UNION ALL SELECT doc, CAST(doc AS VARCHAR), 'SEGMENTS_EMPTY' FROM c WHERE doc NOT IN (SELECT doc FROM s)
UNION ALL SELECT doc, CAST(segment_id AS VARCHAR), 'SEGMENT_PAGE_UNSELECTED' FROM s WHERE page = 4
UNION ALL SELECT doc, '3', 'PAGE_CONTEXT_MISSING' FROM c
""")
def plan_preconditions(spark, sf_dir):
    """Customers as manifests: what keeps them from being planned."""
    k = F.col("doc")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"))
    manifests = c.select("doc", F.when(k % 5 == 0, "x").otherwise(integrity.MANIFEST_SCHEMA).alias("schema"), F.when(k % 7 == 0, "RENDERED").otherwise("EXTRACTED").alias("status"), F.lit("A").alias("sha256"), F.array(F.lit(1), F.lit(2), F.lit(3)).alias("selected_pages"))
    reports = c.select("doc", F.lit(integrity.REPORT_SCHEMA).alias("schema"), F.lit("extraction").alias("stage"), F.when(k % 11 == 0, "B").otherwise("A").alias("manifest_sha256"), F.lit("PASS").alias("status"), (k % 13 == 0).cast("int").alias("blocking"), F.lit(0).alias("needs_review"))
    segments = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("segment_id"), (1 + F.col("o_orderkey") % 4).cast("int").alias("page"))
    contexts = c.select("doc", F.explode(F.array(F.lit(1), F.lit(2))).alias("page"))
    return integrity.precondition_issues(manifests, reports, segments, contexts, "doc")


@query("""
WITH s AS (SELECT p_partkey AS k FROM part)
SELECT k AS segment_id, 'SCHEMA' AS code FROM s WHERE k % 2 = 0 UNION ALL SELECT k, 'SOURCE_SHA256' FROM s WHERE k % 3 = 0 UNION ALL SELECT k, 'SEGMENTS_EMPTY' FROM s WHERE k % 5 = 0
""")
def header_issues(spark, sf_dir):
    k = F.col("segment_id")
    m = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("segment_id"))
    m = m.select("segment_id", F.when(k % 2 == 0, "v0").otherwise(integrity.MANIFEST_SCHEMA).alias("schema"), F.when(k % 3 == 0, F.repeat(F.lit("a"), 64)).otherwise(F.repeat(F.lit("A"), 64)).alias("source_sha256"), F.when(k % 5 == 0, 0).otherwise(1).alias("n_segments"))
    return integrity.header_issues(m, ["segment_id"]).select("segment_id", "code")


@query("""
WITH s AS (SELECT p_partkey AS k FROM part)
SELECT k AS segment_id, 'TEXT_ALIGNMENT_FIELDS' AS code FROM s WHERE k % 2 = 0
UNION ALL SELECT k, 'TEXT_ALIGNMENT_RENDER_MISMATCH' FROM s WHERE k % 2 = 1 AND k % 3 = 0
UNION ALL SELECT k, 'TEXT_ALIGNMENT_TARGET_CONTAINMENT' FROM s WHERE k % 2 = 1 AND k % 5 = 0
UNION ALL SELECT k, 'TEXT_ALIGNMENT_TOLERANCE' FROM s WHERE k % 2 = 1 AND k % 7 = 0
""")
def alignment_contracts(spark, sf_dir):
    """Parts as segments with alignment contracts, each with its own faults."""
    k, box = F.col("segment_id"), lambda *v: g.box(*[F.lit(float(x)) for x in v])
    contract = F.struct(F.lit(integrity.ALIGNMENT_SCHEMA).alias("schema"), F.lit("left").alias("alignment"), box(1, 1, 50, 50).alias("source_reference_bbox"), box(1, 1, 60, 60).alias("target_reference_bbox"), box(2, 2, 9, 9).alias("source_text_bbox"), F.when(k % 7 == 0, -1.0).otherwise(0.5).alias("maximum_delta_pt"), F.when(k % 2 == 0, F.lit(None)).otherwise(integrity.MEASUREMENT).alias("measurement_basis"))
    s = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("segment_id"))
    s = s.select("segment_id", contract.alias("k"), F.when(k % 3 == 0, "right").otherwise("left").alias("align"), F.when(k % 5 == 0, box(1, 1, 61, 9)).otherwise(box(1, 1, 60, 9)).alias("target_bbox"), box(0, 0, 100, 100).alias("page_bbox"))
    return rules.check(s, integrity.alignment_rules(), ["segment_id"]).select("segment_id", "code")


@query("""
WITH s AS (SELECT o_custkey AS doc, o_orderkey AS k, 'v' || (o_orderkey % 5) AS visual_id, 't' || (o_orderkey % 3) AS txt, o_orderkey % 4 AS m FROM orders)
SELECT doc, CAST(k AS VARCHAR) AS segment_id, 'UNKNOWN_VISUAL_ID' AS code FROM s WHERE visual_id = 'v4' AND m > 0
UNION ALL SELECT doc, CAST(k AS VARCHAR), 'VECTOR_VISUAL_COMPLETE_COMPONENT_REQUIRED' FROM s WHERE visual_id = 'v1' AND m = 1
UNION ALL SELECT doc, CAST(k AS VARCHAR), 'VECTOR_VISUAL_GROUP_MISMATCH' FROM s WHERE visual_id = 'v1' AND m = 2
UNION ALL SELECT doc, CAST(k AS VARCHAR), 'UI_ALLOWLIST_MISSING' FROM s WHERE visual_id <> 'v4' AND txt = 't2' AND m > 0
UNION ALL SELECT doc, CAST(k AS VARCHAR), 'UI_ALLOWLIST_TRANSLATION' FROM s WHERE visual_id <> 'v4' AND txt = 't1' AND m > 0
""")
def visual_links(spark, sf_dir):
    """Orders as preserved segments against five visuals of each customer, one of them unknown."""
    k = F.col("o_orderkey")
    s = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), k.cast("string").alias("segment_id"), F.when(k % 4 > 0, "preserve_source_visual_with_textual_guidance").otherwise("replace").alias("action"), F.concat(F.lit("v"), (k % 5).cast("string")).alias("visual_id"), F.concat(F.lit("t"), (k % 3).cast("string")).alias("source_text"), F.lit("x").alias("target_text"), F.when(k % 4 == 1, "part").otherwise("complete_visual").alias("segment_role"), F.when(k % 4 == 2, "h").otherwise("g").alias("group_id"), F.array(k.cast("string")).alias("guidance_ids"))
    docs = s.select("doc").distinct()
    visuals = docs.select("doc", F.explode(F.array(*[F.lit(f"v{i}") for i in range(4)])).alias("visual_id")).select("doc", "visual_id", F.when(F.col("visual_id") == "v1", "vector_component").otherwise("raster_image").alias("kind"), F.lit("g").alias("group_id"))
    allowed = visuals.select("doc", "visual_id", F.explode(F.array(F.lit("t0"), F.lit("t1"))).alias("source_text")).select("doc", "visual_id", "source_text", F.when(F.col("source_text") == "t1", "y").otherwise("x").alias("target_text"), F.array().cast("array<string>").alias("guidance_ids"))
    return integrity.visual_link_issues(s, visuals, allowed, "doc", True).select("doc", "segment_id", "code")


@query("""
WITH i AS (SELECT l_orderkey, CASE WHEN l_quantity >= 45 THEN 'BLOCKED' WHEN l_quantity >= 40 THEN 'NEEDS_REVIEW' ELSE 'PASS' END AS severity, l_shipmode AS code FROM (SELECT l_orderkey, l_quantity, l_returnflag AS l_shipmode FROM lineitem))
SELECT l_orderkey, CAST(count(*) FILTER (severity = 'BLOCKED') AS BIGINT) AS blocking, CAST(count(*) FILTER (severity = 'NEEDS_REVIEW') AS BIGINT) AS needs_review, CAST(count(DISTINCT code) AS BIGINT) AS codes FROM i GROUP BY 1
""")
def issue_counts(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr("case when l_quantity >= 45 then 'BLOCKED' when l_quantity >= 40 then 'NEEDS_REVIEW' else 'PASS' end").alias("severity"), F.col("l_returnflag").alias("code"))
    return integrity.issue_counts(i, ["l_orderkey"])


@query("SELECT l_orderkey, CAST(min(l_quantity) AS DOUBLE) AS x0, CAST(min(l_linenumber) AS DOUBLE) AS y0, CAST(max(l_quantity) + 5 AS DOUBLE) AS x1, CAST(max(l_linenumber) + 1 AS DOUBLE) AS y1 FROM lineitem GROUP BY 1")
def box_unions(spark, sf_dir):
    """The union of the boxes of an order's lines."""
    q, n = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", g.box(q, n, q + 5, n + 1).alias("bbox"))
    return aggregates.box_union(rows, ["l_orderkey"]).select("l_orderkey", "bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1")


@query("""
SELECT o_orderkey AS batch, 'plan_digest' AS id, 'REQUEST_BINDING_MISMATCH' AS code FROM orders WHERE o_orderkey % 4 = 0
UNION ALL SELECT o_orderkey, 'batch_digest', 'REQUEST_BINDING_MISMATCH' FROM orders WHERE o_orderkey % 6 = 0
""")
def request_bindings(spark, sf_dir):
    """Orders as batch requests; some repeat another plan or batch digest."""
    k = F.col("batch")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("batch"))
    same = {f: F.lit(f) for f in integrity.REQUEST_FIELDS}
    expected = o.withColumns(same | {"source_manifest_sha256": F.lit(None).cast("string")})
    found = expected.withColumns({"plan_digest": F.when(k % 4 == 0, "x").otherwise("plan_digest"), "batch_digest": F.when(k % 6 == 0, F.lit(None)).otherwise("batch_digest")})
    return integrity.binding_issues(expected, found, integrity.REQUEST_FIELDS, "batch", "REQUEST")


@query("""
WITH s AS (SELECT DISTINCT l_orderkey AS batch, l_partkey AS seg FROM lineitem WHERE l_orderkey % 3 > 0)
SELECT DISTINCT batch, CAST(batch AS VARCHAR) AS id, 'RESULT_STATUS' AS code FROM s WHERE batch % 5 = 0
UNION ALL SELECT DISTINCT batch, CAST(batch AS VARCHAR), 'RESULT_TIMING' FROM s WHERE batch % 7 = 0
UNION ALL SELECT batch, CAST(seg AS VARCHAR), 'RESULT_SEGMENT_MISSING' FROM s WHERE seg % 11 = 0
UNION ALL SELECT batch, CAST(seg + 1000000 AS VARCHAR), 'RESULT_SEGMENT_UNEXPECTED' FROM s WHERE seg % 13 = 0 AND seg % 11 > 0
UNION ALL SELECT batch, CAST(seg AS VARCHAR), 'RESULT_SOURCE_STALE' FROM s WHERE seg % 17 = 0 AND seg % 11 > 0 AND seg % 13 > 0
UNION ALL SELECT batch, CAST(seg AS VARCHAR), 'RESULT_TRANSLATION_EMPTY' FROM s WHERE seg % 19 = 0 AND seg % 2 = 0 AND seg % 11 > 0 AND seg % 13 > 0
UNION ALL SELECT batch, CAST(seg AS VARCHAR), 'RESULT_TOKEN_MISSING' FROM s WHERE seg % 19 = 0 AND seg % 11 > 0 AND seg % 13 > 0
UNION ALL SELECT batch, CAST(seg AS VARCHAR), 'RESULT_ASSERTION_COVERAGE' FROM s WHERE seg % 23 = 0 AND seg % 11 > 0 AND seg % 13 > 0
UNION ALL SELECT batch, CAST(seg AS VARCHAR), 'RESULT_SEGMENT_MISSING' FROM s WHERE seg % 13 = 0 AND seg % 11 > 0
""")
def result_bindings(spark, sf_dir):
    """Orders as batches that own their parts; two of three have results, with faults by part number."""
    seg, batch = F.col("segment_id"), F.col("batch")
    owned = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("batch"), F.col("l_partkey").alias("segment_id")).distinct().withColumns({"source_digest": F.lit("d"), "action": F.when(seg % 2 == 0, "replace").otherwise("preserve")})
    done = owned.where("batch % 3 > 0")
    results = done.select("batch").distinct().select("batch", F.when(batch % 5 == 0, "DRAFT").otherwise("TRANSLATED").alias("status"), F.when(batch % 7 == 0, -1.0).otherwise(2.5).alias("elapsed"))
    back = done.where("segment_id % 11 <> 0").select("batch", F.when(seg % 13 == 0, seg + 1000000).otherwise(seg).alias("segment_id"), F.when(seg % 17 == 0, "old").otherwise("d").alias("source_digest"), F.when(seg % 19 == 0, " ").otherwise("keep 5 V").alias("target_text"))
    needed = owned.select("batch", "segment_id", F.lit("5 V").alias("token"), F.lit(1).alias("required"))
    bound = owned.select("batch", "segment_id", F.lit("b").alias("binding_id"))
    return integrity.result_issues(results, owned, back, needed, bound, bound.where("segment_id % 23 <> 0"), "batch")
