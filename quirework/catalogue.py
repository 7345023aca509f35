"""Every registered query, and the SQL that gives the same rows on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.functions import geometry as g
from quirework.functions import text as t
from quirework.operators import aggregates, drawings, graph, joins, layout, matching, ordered
from quirework.plans import planner, rules
from quirework.sources import content_stream, readers
from quirework.sources.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- text -----------------------------------------------------------------------------------------------------

#: Whole tokens between white space that look like codes: four of A-Z, 0-9, . _ / - or more, with a capital and a digit.
CODE_TOKEN = "^[A-Z0-9._/-]{4,}$"


def code_tokens(text):
    words = F.filter(F.split(text, "[ \t\r\n]+"), lambda w: w.rlike(CODE_TOKEN) & w.rlike("[A-Z]") & w.rlike("[0-9]"))
    return words


CODE_SQL = "list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda w: regexp_matches(w, '^[A-Z0-9._/-]{4,}$') AND regexp_matches(w, '[A-Z]') AND regexp_matches(w, '[0-9]'))"


@query(f"""
WITH d AS (SELECT doc_id, {CODE_SQL} AS codes, regexp_extract_all(text, '[A-Za-z]+') AS words, text FROM documents),
m AS (SELECT doc_id, CAST(len(codes) AS BIGINT) AS code_tokens, CAST(len(list_filter(words, lambda w: len(w) > 1)) AS BIGINT) AS latin_tokens,
  regexp_matches(text, '\\[(TODO|TBD|TRANSLATE)\\]') AS placeholder FROM d)
SELECT doc_id, code_tokens, latin_tokens, CASE WHEN placeholder THEN 'BLOCKED' WHEN latin_tokens < 20 THEN 'NEEDS_REVIEW' ELSE 'PASS' END AS status FROM m
""")
def doc_quality_gate(spark, sf_dir):
    """Critical tokens, residue and status of every document."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = d.select("doc_id", F.size(code_tokens(F.col("text"))).cast("long").alias("code_tokens"), F.size(F.filter(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), lambda w: F.length(w) > 1)).cast("long").alias("latin_tokens"), F.col("text").rlike(r"\[(TODO|TBD|TRANSLATE)\]").alias("placeholder"))
    status = F.when(F.col("placeholder"), "BLOCKED").when(F.col("latin_tokens") < 20, "NEEDS_REVIEW").otherwise("PASS")
    return m.select("doc_id", "code_tokens", "latin_tokens", status.alias("status"))


@query("SELECT sha256(text) AS text_sha256, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dup_text_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null")
    return d.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query("""
SELECT doc_id, trim(regexp_replace(lower(source), '[^a-z0-9_-]+', '-', 'g'), '-') || '.p' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') || '.'
  || trim(regexp_replace(lower(lang || ' Key'), '[^a-z0-9_-]+', '-', 'g'), '-') AS segment_id FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL
""")
def stable_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("source is not null and lang is not null")
    return d.select("doc_id", t.stable_id(F.col("source"), F.col("doc_id") % 10000, F.concat("lang", F.lit(" Key"))).alias("segment_id"))


@query()
def protected_token_bag(spark, sf_dir):
    """The exact grammars with look-around: token, kind, count and first place per document."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(t.protected_spans(F.col("text"))).alias("s"))
    out = d.groupBy("doc_id", F.col("s.token").alias("token")).agg(F.min_by("s.kind", "s.begin").alias("kind"), F.count("*").alias("source_count"), F.min("s.begin").alias("first"))
    return out.withColumn("target_token", F.when(F.col("kind") == "number_word", t.number_word_target(F.col("token"))))


@query("""
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[^0-9A-Za-z]+')) AS token FROM documents)
SELECT doc_id, token, CASE WHEN regexp_matches(token, '^[0-9]+$') THEN 'number' ELSE 'code' END AS kind, CAST(count(*) AS BIGINT) AS source_count
FROM w WHERE regexp_matches(token, '^[0-9]+$') OR regexp_matches(token, '^[A-Z]{2,}[0-9][A-Z0-9]*$') GROUP BY 1, 2
""")
def protected_token_bag_portable(spark, sf_dir):
    """Whole-token form of the same idea, which any regular-expression engine gives alike."""
    w = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "[^0-9A-Za-z]+")).alias("token"))
    w = w.where(F.col("token").rlike("^[0-9]+$") | F.col("token").rlike("^[A-Z]{2,}[0-9][A-Z0-9]*$"))
    return w.groupBy("doc_id", "token").agg(F.first(F.when(F.col("token").rlike("^[0-9]+$"), "number").otherwise("code")).alias("kind"), F.count("*").alias("source_count"))


@query(f"""
WITH c AS (SELECT doc_id, unnest({CODE_SQL}) AS token FROM documents),
a AS (SELECT doc_id // 2 AS pair, token, CAST(sum(CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END) AS BIGINT) AS delta FROM c GROUP BY 1, 2)
SELECT pair, token, delta FROM a WHERE delta <> 0
""")
def critical_token_missing_extra(spark, sf_dir):
    """Neighbouring documents as source and candidate: signed multiset difference of their code tokens."""
    c = table(spark, sf_dir, "documents").select((F.floor(F.col("doc_id") / 2)).alias("pair"), (F.col("doc_id") % 2).alias("side"), F.explode(code_tokens(F.col("text"))).alias("token"))
    return aggregates.multiset_difference(c.where("side = 0"), c.where("side = 1"), ["pair", "token"])


@query("""
WITH w AS (SELECT lang, doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS token FROM documents WHERE lang <> 'en'),
b AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS k FROM benchmark),
c AS (SELECT lang, token, CAST(count(*) AS BIGINT) AS n FROM w WHERE len(token) > 1 AND lower(token) NOT IN (SELECT k FROM b) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank FROM c)
SELECT lang, token, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 50
""")
def english_residue_topk(spark, sf_dir):
    """The report of the 50 most frequent tokens of each language that the benchmark's words don't allow."""
    d = table(spark, sf_dir, "documents").where("lang <> 'en'").select("lang", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("token")).where("length(token) > 1")
    allowed = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("k")).select(F.lower("k").alias("k")).distinct()
    counts = d.groupBy("lang", "token").agg(F.count("*").alias("n")).withColumn("k", F.lower("token")).join(allowed, "k", "left_anti")
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "token")))
    return ranked.where("rank <= 50").select("lang", "token", "n", "rank")


@query()
def english_residue(spark, sf_dir):
    """Residue by the exact grammar: links scrubbed, trimmed tokens, model codes left out."""
    d = table(spark, sf_dir, "documents").where("lang <> 'en'").select("doc_id", "text")
    return aggregates.residue(d, ["doc_id"], "text")


@query("""
WITH o AS (SELECT doc_id, token, CAST(count(*) AS BIGINT) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS token FROM documents) GROUP BY 1, 2),
a AS (SELECT token, CAST(count(*) AS BIGINT) AS allowed FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS token FROM benchmark) GROUP BY 1)
SELECT doc_id, token, n - coalesce(allowed, 0) AS excess FROM o LEFT JOIN a USING (token) WHERE n - coalesce(allowed, 0) > 0
""")
def residue_over_budget(spark, sf_dir):
    words = lambda df: df.withColumn("token", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))))
    observed = words(table(spark, sf_dir, "documents")).groupBy("doc_id", "token").agg(F.count("*").alias("n"))
    allowed = words(table(spark, sf_dir, "benchmark")).groupBy("token").agg(F.count("*").alias("allowed"))
    return joins.over_budget(observed, allowed, ["token"]).select("doc_id", "token", "excess")


@query(r"""
WITH f AS (SELECT doc_id, unnest(list_sort(list_distinct(list_concat(regexp_extract_all(text, '\{\{[^{}]{0,200}\}\}'), regexp_extract_all(text, '(?i)\[(?:TRANSLATE|TRANSLATION|TODO|TBD)\]'))))) AS finding FROM documents)
SELECT doc_id, substr(finding, 1, 120) AS finding FROM f
""")
def placeholder_scan(spark, sf_dir):
    both = F.concat(*[F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (t.PLACEHOLDERS[0], t.PLACEHOLDERS[2])])
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_sort(F.array_distinct(both))).alias("f")).select("doc_id", F.substring("f", 1, 120).alias("finding"))


@query()
def placeholder_control_scan(spark, sf_dir):
    """Placeholders and control characters, all patterns."""
    return table(spark, sf_dir, "documents").select("doc_id", t.placeholder_findings(F.col("text")).alias("findings")).where(F.size("findings") > 0)


@query(r"""
WITH c AS (SELECT doc_id, CAST(length(regexp_replace(text, '[ \t\r\n]+', '', 'g')) AS BIGINT) AS chars FROM documents),
p AS (SELECT a.doc_id AS source_doc, b.doc_id AS candidate_doc, a.chars AS source_chars, b.chars AS candidate_chars FROM c a JOIN c b ON b.doc_id = a.doc_id + 1)
SELECT *, CASE WHEN source_chars >= 20 AND candidate_chars = 0 THEN 'CANDIDATE_TEXT_MISSING' WHEN source_chars >= 100 AND candidate_chars * 100 < source_chars * 15 THEN 'POSSIBLE_CONTENT_LOSS' END AS code
FROM p WHERE (source_chars >= 20 AND candidate_chars = 0) OR (source_chars >= 100 AND candidate_chars * 100 < source_chars * 15)
""")
def content_loss(spark, sf_dir):
    """Each document against the next as its candidate."""
    c = table(spark, sf_dir, "documents").select("doc_id", F.length(F.regexp_replace("text", r"[ \t\r\n]+", "")).cast("long").alias("chars"))
    a = c.select(F.col("doc_id").alias("source_doc"), F.col("chars").alias("source_chars"), (F.col("doc_id") + 1).alias("candidate_doc"))
    p = a.join(c.select(F.col("doc_id").alias("candidate_doc"), F.col("chars").alias("candidate_chars")), "candidate_doc")
    s, x = F.col("source_chars"), F.col("candidate_chars")
    code = F.when((s >= 20) & (x == 0), "CANDIDATE_TEXT_MISSING").when((s >= 100) & (x * 100 < s * 15), "POSSIBLE_CONTENT_LOSS")
    return p.withColumn("code", code).where("code is not null").select("source_doc", "candidate_doc", "source_chars", "candidate_chars", "code")


@query("""
SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST((length(text) - length(replace(text, 'en', ''))) // 2 AS BIGINT) AS token_count,
  sha256(replace(lower(text), 'ß', 'ss')) AS folded_sha256, regexp_matches(text, '[\\x{3400}-\\x{9fff}]') AS cjk FROM documents
""")
def text_measures(spark, sf_dir):
    """Length, token count, digest of the whole folded text, and whether it holds CJK characters."""
    x = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.length(x).cast("long").alias("chars"), t.count_of(x, F.lit("en")).cast("long").alias("token_count"), F.sha2(t.folded(x).cast("binary"), 256).alias("folded_sha256"), t.has_cjk(x).alias("cjk"))


@query(r"""
SELECT doc_id, regexp_matches(text, '(?i)([A-Z]:[\\/]Users[\\/]|/(home|Users)/[^/]+/)') AS private_path,
  regexp_matches(text, '(?i)(api[_-]?key|access[_-]?token|client[_-]?secret|password)\s*[:=]\s*["''][^"'']{8,}["'']') AS possible_secret FROM documents
""")
def hygiene_scan(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", t.hygiene_findings(F.lit("text.md"), F.col("text")).alias("f"))
    return d.select("doc_id", F.array_contains("f", "PRIVATE_ABSOLUTE_PATH").alias("private_path"), F.array_contains("f", "POSSIBLE_SECRET").alias("possible_secret"))


@query("""
WITH v AS (SELECT p_partkey, (p_partkey % 3) AS a, (p_partkey % 11) AS b, p_size AS c FROM part)
SELECT p_partkey, a || '.' || b || '.' || c AS version, (a, b, c) >= (1, 2, 10) AND (a, b, c) < (2, 0, 0) AS in_range FROM v
""")
def version_range(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(".", F.col("p_partkey") % 3, F.col("p_partkey") % 11, "p_size").alias("version"))
    v = t.version_numbers(F.col("version"))
    return p.select("p_partkey", "version", ((v >= t.version_numbers(F.lit("1.2.10"))) & (v < t.version_numbers(F.lit("2.0.0")))).alias("in_range"))


# --- joins ----------------------------------------------------------------------------------------------------


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)")
def import_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang", "quality", "toxic")


@query("""
SELECT doc_id, 'missing' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
UNION SELECT doc_id, 'unexpected' FROM labels WHERE quality = 1 AND doc_id NOT IN (SELECT doc_id FROM documents)
""")
def coverage_full_outer(spark, sf_dir):
    return joins.coverage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"), ["doc_id"])


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def unmapped_refs(spark, sf_dir):
    return joins.dangling(table(spark, sf_dir, "part").select("p_partkey"), table(spark, sf_dir, "lineitem").where("l_quantity > 45"), "p_partkey", "l_partkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def dangling_refs(spark, sf_dir):
    return joins.dangling(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@query("SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations s WHERE s.conv_id = c.conv_id AND s.turn = c.turn AND s.role = 'user')")
def scope_subset(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return joins.outside_scope(c, c.where("role = 'user'"), ["conv_id", "turn"]).select("conv_id", "turn")


@query("""
WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity AS q FROM lineitem WHERE l_partkey % 5 <> 0),
b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN l_quantity + 1 ELSE l_quantity END AS q FROM lineitem WHERE l_partkey % 6 <> 0)
SELECT l_orderkey, l_linenumber, CASE WHEN b.q IS NULL THEN 'missing' WHEN a.q IS NULL THEN 'unbound' WHEN a.q = b.q THEN 'equal' ELSE 'changed' END AS state
FROM a FULL JOIN b USING (l_orderkey, l_linenumber)
""")
def composite_key_reconcile(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("q"))
    a = x.where("l_partkey % 5 <> 0")
    b = x.where("l_partkey % 6 <> 0").withColumn("q", F.expr("if(l_partkey % 7 = 0, q + 1, q)"))
    return joins.reconciled(a, b, ["l_orderkey", "l_linenumber"], ["q"])


def boxes(spark, sf_dir) -> DataFrame:
    """Line items as boxes on the page of their order; all coordinates are exact binary fractions."""
    x0, y0 = (F.col("l_partkey") % 97) * 0.5, (F.col("l_suppkey") % 89) * 0.5
    w, h = 8 + (F.col("l_linenumber") % 7) * 4.0, 6 + (F.col("l_quantity") % 9) * 4.0
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("segment"), g.box(x0, y0, x0 + w, y0 + h).alias("bbox"))


BOXES_SQL = """b AS (SELECT l_orderkey AS page, l_linenumber AS line, l_returnflag AS segment, (l_partkey % 97) * 0.5::DOUBLE AS x0, (l_suppkey % 89) * 0.5::DOUBLE AS y0,
  x0 + 8 + (l_linenumber % 7) * 4.0::DOUBLE AS x1, y0 + 6 + (l_quantity % 9) * 4.0::DOUBLE AS y1 FROM lineitem)"""
SHARED_SQL = "greatest(0, least(a.x1, c.x1) - greatest(a.x0, c.x0)) * greatest(0, least(a.y1, c.y1) - greatest(a.y0, c.y0))"


@query(f"""
WITH {BOXES_SQL}
SELECT a.page, a.line AS line_l, c.line AS line_r FROM b a JOIN b c ON a.page = c.page AND a.line < c.line
WHERE {SHARED_SQL} > 0 AND {SHARED_SQL} / least((a.x1 - a.x0) * (a.y1 - a.y0), (c.x1 - c.x0) * (c.y1 - c.y0)) >= 0.35
""")
def line_overlap_pairs(spark, sf_dir):
    return joins.overlapping_pairs(boxes(spark, sf_dir), ["page"], "line", "bbox", 32.0, 0.35).select("page", "line_l", "line_r")


@query(f"""
WITH {BOXES_SQL}
SELECT a.page, a.line AS line_l, c.line AS line_r FROM b a JOIN b c ON a.page = c.page AND a.line < c.line AND a.segment <> c.segment WHERE {SHARED_SQL} > 0.05
""")
def rendered_overlap(spark, sf_dir):
    return joins.overlapping_pairs(boxes(spark, sf_dir), ["page"], "line", "bbox", 32.0, 0.05, relative=False, apart="segment").select("page", "line_l", "line_r")


@query(f"""
WITH {BOXES_SQL},
p AS (SELECT a.page, a.line AS candidate, c.line AS source, {SHARED_SQL} / ((a.x1 - a.x0) * (a.y1 - a.y0)) AS coverage FROM b a JOIN b c ON a.page = c.page AND a.line % 2 = 1 AND c.line % 2 = 0 WHERE {SHARED_SQL} > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY page, candidate ORDER BY coverage DESC, source) AS k FROM p)
SELECT page, candidate, source, coverage FROM r WHERE k = 1 AND coverage >= 0.5
""")
def best_overlap_match(spark, sf_dir):
    b = boxes(spark, sf_dir)
    c = b.where("line % 2 = 1").select("page", F.col("line").alias("candidate"), F.col("bbox").alias("box_c"))
    s = b.where("line % 2 = 0").select("page", F.col("line").alias("source"), F.col("bbox").alias("box_s"))
    return joins.best_overlaps(c, s, ["page"], "candidate", "source", "box_c", "box_s", 32.0).select("page", "candidate", "source", "coverage")


@query(f"""
WITH {BOXES_SQL}
SELECT a.page, a.line AS line_l, c.line AS line_r FROM b a JOIN b c ON a.page = c.page AND a.line < c.line
WHERE (a.x1 <= c.x0 OR c.x1 <= a.x0) AND greatest(0, least(a.y1, c.y1) - greatest(a.y0, c.y0)) / least(a.y1 - a.y0, c.y1 - c.y0) >= 0.4
""")
def cross_column_pairs(spark, sf_dir):
    return joins.cross_column_pairs(boxes(spark, sf_dir), ["page"], "line", "bbox", 16.0).select("page", "line_l", "line_r")


@query(f"WITH {BOXES_SQL} SELECT page % 50 AS page, round(x0 / 64, 1) AS anchor, CAST(count(*) AS BIGINT) AS support FROM b GROUP BY 1, 2 HAVING count(*) >= 2")
def column_anchors(spark, sf_dir):
    b = boxes(spark, sf_dir).select((F.col("page") % 50).alias("page"), "bbox", F.lit(64.0).alias("width"))
    return joins.column_anchors(b, ["page"], "bbox", "width")


@query(f"""
WITH {BOXES_SQL}
SELECT a.line AS visual, CAST(count(*) FILTER (WHERE a.page = c.page) AS BIGINT) AS same_page, CAST(count(*) FILTER (WHERE a.page <> c.page) AS BIGINT) AS rejected
FROM b a JOIN b c ON (a.page = c.page OR a.page + 1 = c.page) AND a.segment = 'R' AND c.segment = 'A' WHERE {SHARED_SQL} > 0.01 GROUP BY 1
""")
def visual_intersections(spark, sf_dir):
    """Intersections on the same page, and coincidences with the next page, which are rejected and counted apart."""
    b = boxes(spark, sf_dir)
    v = b.where("segment = 'R'").select("page", F.col("line").alias("visual"), F.col("bbox").alias("box_v"), F.explode(F.array(F.lit(0), F.lit(1))).alias("off")).withColumn("page", F.col("page") + F.col("off"))
    m = b.where("segment = 'A'").select("page", F.col("line").alias("mask"), F.col("bbox").alias("box_m"))
    pairs = joins.grid_join(v, m, ["page"], "box_v", "box_m", 32.0, lambda x, y: g.shared_area(x, y) > 0.01)
    return pairs.groupBy("visual").agg(F.count_if(F.expr("off = 0")).alias("same_page"), F.count_if(F.expr("off = 1")).alias("rejected"))


@query("""
WITH c AS (SELECT conv_id, turn, regexp_replace(text, '[ \t\r\n]+', '', 'g') AS k FROM conversations)
SELECT a.conv_id, a.turn, CAST(count(*) AS BIGINT) AS equal_spans FROM c a JOIN c b ON a.k = b.k AND a.k <> '' GROUP BY 1, 2
""")
def span_binding(spark, sf_dir):
    """How many spans have a line's text, white space aside: each text is counted once and joined to its rows."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.regexp_replace("text", "[ \t\r\n]+", "").alias("k")).where("k <> ''")
    counts = c.groupBy("k").agg(F.count("*").alias("m"))
    return c.join(counts, "k").groupBy("conv_id", "turn").agg(F.sum("m").alias("equal_spans"))


@query("""
WITH a AS (SELECT vec_id, CAST(round(embedding[1] * 64) AS BIGINT) AS x, CAST(round(embedding[2] * 64) AS BIGINT) AS y, label FROM embeddings),
p AS (SELECT a.vec_id AS d, b.vec_id AS r FROM a JOIN a b ON a.label = b.label AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
n AS (SELECT d, r, count(*) OVER (PARTITION BY d) AS n, count(*) OVER (PARTITION BY r) AS m FROM p),
s AS (SELECT d, max(n) AS matches, max(m) AS claims FROM n GROUP BY 1)
SELECT d AS vec_id, CAST(matches AS BIGINT) AS matches, CASE WHEN matches > 1 THEN 'duplicate_match' WHEN claims > 1 THEN 'reused' ELSE 'matched' END AS state FROM s
""")
def exactly_once_match(spark, sf_dir):
    """Declarations (rounded vectors) against records: matched, ambiguous or claimed twice."""
    e = lambda i: F.round(F.element_at("embedding", i).cast("double") * 64).cast("long")
    a = table(spark, sf_dir, "embeddings").select("vec_id", "label", e(1).alias("x"), e(2).alias("y"))
    r = a.select(F.col("vec_id").alias("record"), "label", F.col("x").alias("rx"), F.col("y").alias("ry"))
    pairs = joins.tolerance_join(a, r, ["label"], ["x", "y"], ["rx", "ry"], 1)
    return joins.exactly_once(a, pairs, "vec_id", "record").select("vec_id", F.col("matches").cast("long").alias("matches"), "state")


@query("""
WITH a AS (SELECT p_brand, p_type, p_size FROM part WHERE p_partkey % 2 = 0), b AS (SELECT p_brand, p_type, p_size FROM part WHERE p_partkey % 2 = 1)
SELECT p_brand, p_type, p_size, CAST(sum(d) AS BIGINT) AS delta FROM (SELECT *, 1 AS d FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY 1, 2, 3 HAVING sum(d) <> 0
""")
def image_multiset_diff(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return aggregates.multiset_difference(p.where("p_partkey % 2 = 0"), p.where("p_partkey % 2 = 1"), ["p_brand", "p_type", "p_size"])


@query("SELECT * FROM (VALUES (1, 1, 2), (1, 2, 1), (1, 3, 3), (2, 7, 9)) v(page, source, candidate)")
def max_matching(spark, sf_dir):
    """Augmenting paths: taking first choices would leave source 2 without a partner."""
    pairs = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (1, 2, 1), (1, 3, 2), (1, 3, 3), (2, 7, 9), (2, 8, 9)], "page int, source int, candidate int")
    return matching.maximum_matching(pairs, "page", "source", "candidate")


@query("SELECT * FROM (VALUES ('d', 1, 5), ('d', 2, 6), ('e', 1, 1)) v(digest, source, candidate)")
def greedy_one_to_one(spark, sf_dir):
    pairs = spark.createDataFrame([("d", 1, 5, 0.0), ("d", 1, 6, 0.001), ("d", 2, 5, 0.0), ("d", 2, 6, 0.001), ("e", 1, 1, 0.0), ("e", 2, 1, 0.0)], "digest string, source int, candidate int, delta double")
    return matching.greedy_nearest(pairs, "digest", "source", "candidate", "delta")


@query("""
WITH l AS (SELECT 1 AS layer, p_name AS source, p_brand AS target, p_partkey AS line FROM part UNION ALL SELECT 2, upper(p_name), p_type, p_partkey FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 3, p_name, 'user', p_partkey FROM part WHERE p_partkey % 11 = 0),
r AS (SELECT *, lower(source) AS key, row_number() OVER (PARTITION BY lower(source) ORDER BY layer DESC, line DESC) AS k FROM l)
SELECT key, CAST(layer AS INTEGER) AS layer, source, target FROM r WHERE k = 1
""")
def precedence_merge(spark, sf_dir):
    """Public, pack and user terms: the last line of the last layer that has a term, folded, gives its target."""
    p = table(spark, sf_dir, "part")
    layers = p.select(F.lit(1).alias("layer"), F.col("p_name").alias("source"), F.col("p_brand").alias("target"), F.col("p_partkey").alias("line"))
    layers = layers.unionByName(p.where("p_partkey % 3 = 0").select(F.lit(2).alias("layer"), F.upper("p_name").alias("source"), F.col("p_type").alias("target"), F.col("p_partkey").alias("line")))
    layers = layers.unionByName(p.where("p_partkey % 11 = 0").select(F.lit(3).alias("layer"), F.col("p_name").alias("source"), F.lit("user").alias("target"), F.col("p_partkey").alias("line")))
    return joins.precedence_merge(layers, t.folded(F.col("source")), order="line").select("key", "layer", "source", "target")


@query("""
WITH s AS (SELECT DISTINCT conv_id, turn FROM conversations), o AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE turn % 3 = 0)
SELECT DISTINCT s.conv_id, s.turn FROM s JOIN o ON s.conv_id = o.conv_id AND abs(s.turn - o.turn) <= 1 WHERE NOT EXISTS (SELECT 1 FROM o x WHERE x.conv_id = s.conv_id AND x.turn = s.turn)
""")
def context_neighbours(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    return joins.context_pages(c.where("turn % 3 = 0"), c, ["conv_id"], "turn")


@query("""
WITH b(binding_id, parameter, mode, tokens) AS (VALUES ('b1', 'pressure', 'cooling', ['5', '7']), ('b2', 'pressure', 'heating', ['9']), ('b3', 'flow', 'cooling', ['3'])),
a(binding_id, parameter, mode, phrase) AS (VALUES ('b1', 'pressure', 'cooling', 'set 5 to 7'), ('b2', 'flow', 'heating', 'set 9 and 3'), ('b4', 'x', 'y', 'z'))
SELECT coalesce(b.binding_id, a.binding_id) AS binding_id, CASE WHEN a.binding_id IS NULL THEN 'SEMANTIC_BINDING_MISSING' WHEN b.binding_id IS NULL THEN 'SEMANTIC_ASSERTION_UNKNOWN_BINDING'
  WHEN a.parameter <> b.parameter THEN 'VALUE_ROLE_SWAPPED' ELSE 'PASS' END AS code FROM b FULL JOIN a ON a.binding_id = b.binding_id
""")
def binding_assertion_check(spark, sf_dir):
    """Bindings against assertions through the rule engine; one code per binding, PASS without any."""
    fields = "binding_id string, parameter string, role string, mode string, `condition` string, comparison string, consequence string, clarification_mode string"
    rest = ("r", "c", ">", "stop", "none")
    b = spark.createDataFrame([("b1", "pressure", rest[0], "cooling", *rest[1:], []), ("b2", "pressure", rest[0], "heating", *rest[1:], []), ("b3", "flow", rest[0], "cooling", *rest[1:], [])], fields + ", cues array<struct<text:string,kind:string,scope:string>>")
    a = spark.createDataFrame([("b1", "pressure", rest[0], "cooling", *rest[1:], "set 5 to 7"), ("b2", "flow", rest[0], "heating", *rest[1:], "set 9 and 3"), ("b4", "x", rest[0], "y", *rest[1:], "z")], fields + ", target_phrase string")
    both = b.select("binding_id", F.struct(*b.columns).alias("b")).join(a.select("binding_id", F.struct(*a.columns).alias("a")), "binding_id", "full_outer")
    both = both.withColumns({"target_text": F.lit("set 5 to 7, set 9 and 3"), "foreign_tokens": F.array().cast("array<string>")})
    found = rules.check(both, rules.assertion_rules(), ["binding_id"])
    return both.select("binding_id").join(found.select("binding_id", "code"), "binding_id", "left").select("binding_id", F.coalesce("code", F.lit("PASS")).alias("code"))


# --- aggregates -----------------------------------------------------------------------------------------------


@query("""
WITH f AS (SELECT l_orderkey, l_shipmode, n, first, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, first, l_shipmode DESC) AS k FROM
  (SELECT l_orderkey, l_returnflag AS l_shipmode, count(*) AS n, min(l_linenumber) AS first FROM lineitem GROUP BY 1, 2))
SELECT l.l_orderkey, round(avg(l_quantity), 3) AS size, round(min(l_quantity), 3) AS min_size, round(max(l_quantity), 3) AS max_size, bool_or(l_linenumber & 4 <> 0) AS bold,
  bool_or(l_linenumber & 2 <> 0) AS italic, any_value(f.l_shipmode) AS primary_font FROM lineitem l JOIN f ON f.l_orderkey = l.l_orderkey AND f.k = 1 GROUP BY 1
""")
def style_rollup(spark, sf_dir):
    """Orders as segments and their lines as spans."""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("font"), F.col("l_quantity").alias("size"), F.col("l_suppkey").cast("int").alias("colour"), (F.col("l_linenumber").bitwiseAND(4) * 4 + F.col("l_linenumber").bitwiseAND(2)).alias("flags"), "l_linenumber")
    out = aggregates.style_rollup(x, ["l_orderkey"], font="font", size="size", colour="colour", flags="flags", ordinal="l_linenumber")
    return out.select("l_orderkey", "size", "min_size", "max_size", "bold", "italic", "primary_font")


@query("SELECT conv_id, string_agg(text, ' / ' ORDER BY turn) AS text FROM conversations WHERE text IS NOT NULL GROUP BY 1")
def ordered_phrase_join(spark, sf_dir):
    return aggregates.ordered_text(table(spark, sf_dir, "conversations").where("text is not null"), ["conv_id"], "turn", "text", " / ")


@query("SELECT conv_id, turn, CAST(count(*) AS BIGINT) AS n FROM (SELECT conv_id, turn % 2 AS turn FROM conversations) GROUP BY 1, 2 HAVING count(*) > 1")
def dup_reading_order(spark, sf_dir):
    return aggregates.duplicates(table(spark, sf_dir, "conversations").withColumn("turn", F.col("turn") % 2), ["conv_id", "turn"])


@query("""
WITH m AS (SELECT l_orderkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN parts = 1 AND suppliers = 1 THEN 'one_to_one' WHEN parts = 1 THEN 'split' WHEN suppliers = 1 THEN 'merge' ELSE 'MAPPING_CARDINALITY' END AS operation FROM m
""")
def mapping_cardinality(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.countDistinct("l_partkey").alias("p"), F.countDistinct("l_suppkey").alias("s"))
    return m.select("l_orderkey", F.when((F.col("p") == 1) & (F.col("s") == 1), "one_to_one").when(F.col("p") == 1, "split").when(F.col("s") == 1, "merge").otherwise("MAPPING_CARDINALITY").alias("operation"))


@query("SELECT l_suppkey, CAST(count(DISTINCT l_returnflag || '|' || l_linestatus) AS BIGINT) AS declared FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag || '|' || l_linestatus) > 1")
def group_conflicts(spark, sf_dir):
    return joins.conflicts(table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_returnflag", "l_linestatus"])


@query("""
WITH s AS (SELECT d.source, CASE WHEN l.doc_id IS NULL THEN 2 WHEN l.quality = 0 THEN 3 ELSE 1 END AS r FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT source, ['PASS', 'NEEDS_REVIEW', 'BLOCKED'][max(r)] AS status, CAST(count(*) AS BIGINT) AS pages FROM s GROUP BY 1
""")
def review_status(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    severity = F.when(F.col("quality").isNull(), "NEEDS_REVIEW").when(F.col("quality") == 0, "BLOCKED").otherwise("PASS")
    return d.withColumn("s", severity).groupBy("source").agg(aggregates.worst(F.col("s")).alias("status"), F.count("*").alias("pages"))


@query("""
WITH n AS (SELECT doc_id, regexp_replace(replace(lower(text), 'ß', 'ss'), '[^\\p{L}\\p{N}]+', '', 'g') AS note FROM documents)
SELECT sha256(note) AS note_sha256, CAST(count(*) AS BIGINT) AS n, list_sort(list(doc_id)) AS pages FROM n WHERE length(note) >= 20 GROUP BY 1 HAVING count(*) > 1
""")
def repeated_notes(spark, sf_dir):
    """Notes that several documents have once case, blanks and punctuation are gone; the whole of each, by digest."""
    note = F.regexp_replace(t.folded(F.col("text")), r"[^\p{L}\p{N}]+", "")
    n = table(spark, sf_dir, "documents").select("doc_id", note.alias("note")).where("length(note) >= 20")
    n = n.select("doc_id", F.sha2(F.col("note").cast("binary"), 256).alias("note_sha256"))
    return n.groupBy("note_sha256").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("doc_id")).alias("pages")).where("n > 1")


@query("SELECT CAST(sum(s) AS DOUBLE) AS worker_seconds, CAST(sum(m) AS DOUBLE) AS wall_seconds, CAST(count(*) AS BIGINT) AS waves FROM (SELECT event_type, sum(round(value)) AS s, max(round(value)) AS m FROM events GROUP BY 1)")
def wave_timing(spark, sf_dir):
    return aggregates.wave_times(table(spark, sf_dir, "events").select(F.col("event_type").alias("wave"), F.round("value").alias("elapsed")))


@query("SELECT event_type AS stage, date_trunc('hour', ts) AS hour, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS units FROM events GROUP BY 1, 2")
def stage_totals(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("stage"), F.expr("cast(date_trunc('hour', ts) as timestamp_ntz)").alias("hour")).agg(F.count("*").alias("attempts"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("units"))


@query("""
SELECT p_brand, sha256(string_agg(CAST(p_partkey AS VARCHAR) || ' ' || sha256(p_name), chr(10) ORDER BY CAST(p_partkey AS VARCHAR) || ' ' || sha256(p_name))) AS tree_sha256 FROM part GROUP BY 1
""")
def tree_digest(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").cast("string").alias("path"), F.sha2(F.col("p_name").cast("binary"), 256).alias("digest"))
    return aggregates.tree_digest(p, ["p_brand"], "path", "digest")


@query("""SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS digest FROM orders""")
def payload_digest(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", planner.digest(["o_custkey", "o_orderstatus"]).alias("digest"))


# --- pages ----------------------------------------------------------------------------------------------------


@query()
def semantic_class(spark, sf_dir):
    """HTML blocks as text blocks: class by bullet, size and weight."""
    b = table(spark, sf_dir, "pages").select("page_id", F.posexplode(readers.html_blocks(F.col("html"))).alias("block", "b"))
    size = F.when(F.col("b.tag").rlike("^h[12]$"), 14.0).when(F.col("b.tag").rlike("^h"), 12.0).otherwise(10.0)
    return b.select("page_id", "block", "b.tag", aggregates.semantic_class(F.col("b.text"), size, F.col("b.tag") == "li").alias("semantic_type"))


@query("""
WITH m AS (SELECT page_id, CAST(length(regexp_replace(html, '[ \t\r\n]+', '', 'g')) AS BIGINT) AS chars, CAST(len(regexp_extract_all(html, '<img')) AS BIGINT) AS images,
  CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS blocks, CAST(len(regexp_extract_all(html, '<a ')) AS BIGINT) AS drawings FROM pages)
SELECT page_id, CASE WHEN chars < 20 AND images = 0 THEN 'manual-review' WHEN images >= 2 AND chars < 180 THEN 'image-overlay' WHEN drawings >= 25 OR blocks >= 18 THEN 'structured' ELSE 'prose' END AS route FROM m
""")
def page_route(spark, sf_dir):
    """Metrics of a page from its markup, then the route by the first rule that fits."""
    n = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    chars = F.length(F.regexp_replace("html", "[ \t\r\n]+", ""))
    m = table(spark, sf_dir, "pages").select("page_id", chars.alias("chars"), n("<img").alias("images"), n("<p[ >]").alias("blocks"), n("<a ").alias("drawings"))
    route, _ = aggregates.status_of_page(F.col("chars"), F.lit(0.0), F.col("images"), F.col("drawings"), F.col("blocks"), F.lit(0.45), F.lit(1), F.lit(0))
    return m.select("page_id", route.alias("route"))


# --- planning -------------------------------------------------------------------------------------------------


@query("""
WITH RECURSIVE e AS (SELECT o_custkey * 2 AS a, (o_custkey % 40) * 2 + 1 AS b FROM orders GROUP BY 1, 2), m AS (SELECT b, min(a) AS low FROM e GROUP BY 1)
SELECT DISTINCT e.a AS node, m.low AS component FROM e JOIN m USING (b)
""")
def dependency_components(spark, sf_dir):
    """Customers joined through a shared token each: components with their smallest member."""
    e = table(spark, sf_dir, "orders").select((F.col("o_custkey") * 2).alias("a"), ((F.col("o_custkey") % 40) * 2 + 1).alias("b")).distinct()
    of = graph.components(e.select("a", (-F.col("b") - 1).alias("b")), Scratch(spark, "deps"), "c")
    low = of.where("node >= 0").groupBy("component").agg(F.min("node").alias("low"))
    return of.where("node >= 0").join(low, "component").select("node", F.col("low").alias("component"))


def order_groups(spark, sf_dir) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("segments"), F.max("l_quantity").alias("q"))
    return x.select((F.col("l_orderkey") % 50).alias("doc"), F.col("l_orderkey").alias("component"), F.lit(1).alias("pages"), (F.col("segments") * 7).alias("segments"), (F.col("q") > 49).alias("high"))


@query("""
WITH RECURSIVE g AS (
  SELECT l_orderkey % 50 AS doc, l_orderkey AS component, 1 AS pages, CAST(count(*) * 7 AS BIGINT) AS segments, max(l_quantity) > 49 AS high,
    row_number() OVER (PARTITION BY l_orderkey % 50 ORDER BY l_orderkey) AS i FROM lineitem GROUP BY l_orderkey),
p(doc, i, component, batch, pages, segments, over, high) AS (
  SELECT doc, i, component, CAST(1 AS BIGINT), pages, segments, pages > 8 OR segments > 80, high FROM g WHERE i = 1
  UNION ALL
  SELECT g.doc, g.i, g.component, CASE WHEN p.pages + g.pages > 8 OR p.segments + g.segments > 80 THEN p.batch + 1 ELSE p.batch END,
    CASE WHEN p.pages + g.pages > 8 OR p.segments + g.segments > 80 THEN g.pages ELSE p.pages + g.pages END,
    CASE WHEN p.pages + g.pages > 8 OR p.segments + g.segments > 80 THEN g.segments ELSE p.segments + g.segments END, g.pages > 8 OR g.segments > 80, g.high
  FROM p JOIN g ON g.doc = p.doc AND g.i = p.i + 1),
b AS (SELECT doc, batch, bool_or(high) AS high FROM p GROUP BY 1, 2),
w(doc, batch, wave, state) AS (
  SELECT doc, batch, 1, [{'n': 1, 'h': high}] FROM b WHERE batch = 1
  UNION ALL
  SELECT doc, batch, nth, CASE WHEN nth > len(state) THEN list_append(state, {'n': 1, 'h': high})
    ELSE list_transform(state, lambda x, k: CASE WHEN k = nth THEN {'n': x.n + 1, 'h': x.h OR high} ELSE x END) END
  FROM (SELECT b.doc, b.batch, b.high, w.state, CAST(coalesce(nullif(list_position(list_transform(w.state, lambda x: x.n < 4 AND NOT (x.h AND b.high)), true), 0), len(w.state) + 1) AS INTEGER) AS nth
    FROM w JOIN b ON b.doc = w.doc AND b.batch = w.batch + 1))
SELECT p.doc, p.component, p.batch, p.over AS oversize, w.wave FROM p JOIN w USING (doc, batch)
""")
def pack_batches(spark, sf_dir):
    """Orders as groups of a document: batches and waves, each a fold in order."""
    return planner.plan(order_groups(spark, sf_dir)).select("doc", "component", "batch", "oversize", "wave")


@query("SELECT * FROM (VALUES (1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 2, 2), (1, 4, 3, 1), (1, 5, 4, 3)) v(doc, component, batch, wave)")
def assign_waves(spark, sf_dir):
    """Hand-computed: 40 + 30 segments fit, the next don't; at most one high-risk batch in a wave."""
    groups = spark.createDataFrame([(1, 1, 1, 40, True), (1, 2, 2, 30, False), (1, 3, 5, 20, True), (1, 4, 4, 70, False), (1, 5, 9, 5, True)], "doc int, component int, pages int, segments int, high boolean")
    out = planner.plan(groups, parallel=2).select("doc", "component", "batch", "wave")
    return out.select("doc", F.col("component").cast("int").alias("component"), F.col("batch").cast("int").alias("batch"), "wave")


@query("""
SELECT o_orderkey AS batch, CASE WHEN l.n IS NULL THEN 'pending' WHEN l.bad > 0 OR o_orderstatus = 'P' THEN 'blocked' ELSE 'completed' END AS state
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(CASE WHEN l_quantity >= 50 THEN 1 ELSE 0 END) AS bad FROM lineitem WHERE l_orderkey % 3 > 0 GROUP BY 1) l ON l.l_orderkey = o.o_orderkey
""")
def plan_status(spark, sf_dir):
    b = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("batch"), F.col("o_orderstatus").alias("plan_digest"))
    r = table(spark, sf_dir, "lineitem").where("l_orderkey % 3 > 0").groupBy(F.col("l_orderkey").alias("batch")).agg(F.count_if(F.expr("l_quantity >= 50")).alias("issues"), F.lit(1.0).alias("elapsed"))
    r = r.join(b, "batch").select("batch", "issues", "elapsed", F.expr("if(plan_digest = 'P', 'stale', plan_digest)").alias("plan_digest"))
    return planner.status(b, r, ["batch"]).select("batch", "state")


# --- layout ---------------------------------------------------------------------------------------------------


@query("""
WITH g AS (SELECT l_orderkey, l_linenumber, (l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)) * 10.0::DOUBLE - 8 AS gap FROM lineitem)
SELECT l_orderkey, l_linenumber, gap, gap BETWEEN -0.02 AND 2.02 AS natural FROM g WHERE gap IS NOT NULL
""")
def inline_gaps(spark, sf_dir):
    x = F.col("l_linenumber") * 10.0
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", g.box(x, F.lit(0.0), x + 8, F.lit(1.0)).alias("b"), F.lit(2.0).alias("most"))
    return ordered.gaps(items, ["l_orderkey"], "l_linenumber", "b", "most").select("l_orderkey", "l_linenumber", "gap", "natural")


@query("SELECT * FROM (VALUES (1, 1, 3.0::DOUBLE, 10.0::DOUBLE), (2, 2, 0.0::DOUBLE, 2.0::DOUBLE), (2, 2, 5.0::DOUBLE, 10.0::DOUBLE)) v(subject, intervals, lo, hi)")
def visible_interval(spark, sf_dir):
    rows = spark.createDataFrame([(1, 0.0, 10.0, [(-1.0, 2.0), (1.0, 3.0)]), (2, 0.0, 10.0, [(2.0, 5.0)]), (3, 0.0, 10.0, [(-1.0, 11.0)])], "subject int, lo double, hi double, o array<struct<lo:double,hi:double>>")
    left = rows.select("subject", ordered.visible_intervals(F.col("lo"), F.col("hi"), F.col("o")).alias("v"))
    return left.select("subject", F.size("v").alias("intervals"), F.explode("v").alias("x")).select("subject", "intervals", "x.lo", "x.hi")


@query("""
WITH f AS (SELECT l_orderkey, l_linenumber, l_quantity, first_value(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 100 + l_quantity) AS base FROM lineitem)
SELECT l_orderkey, l_linenumber FROM f WHERE abs(l_quantity - base) > 20.000001
""")
def repeated_layout(spark, sf_dir):
    """Instances whose metric strays from the first declared one's."""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber").cast("long") * 1000000000 + F.col("l_partkey") * 100 + F.col("l_quantity").cast("int")).alias("o"), F.col("l_quantity").alias("width"), F.lit(20.0).alias("delta"))
    return ordered.against_first(x, ["l_orderkey"], "o", ["width"], "delta").select("l_orderkey", "l_linenumber")


@query(f"""
WITH {BOXES_SQL}
SELECT a.page, a.line, sqrt(pow(greatest(0, a.x0 - c.x1, c.x0 - a.x1), 2) + pow(greatest(0, a.y0 - c.y1, c.y0 - a.y1), 2)) < 2 AS too_close FROM b a JOIN b c ON a.page = c.page AND c.line = a.line + 1
""")
def member_relations(spark, sf_dir):
    """Clearance of each member to its target, the next one."""
    b = boxes(spark, sf_dir)
    pairs = b.select("page", "line", F.col("bbox").alias("x")).join(b.select("page", (F.col("line") - 1).alias("line"), F.col("bbox").alias("y")), ["page", "line"])
    return pairs.select("page", "line", (g.clearance(F.col("x"), F.col("y")) < 2).alias("too_close"))


@query("SELECT * FROM (VALUES ('bg', 8.0::DOUBLE, 18.0::DOUBLE, 52.0::DOUBLE, 42.0::DOUBLE)) v(component_id, x0, y0, x1, y1)")
def dependent_bbox(spark, sf_dir):
    """Edges of a background bound to its text's actual box, two points off on each side."""
    bindings = spark.createDataFrame([("bg", "x0", "x0", "t", -2.0), ("bg", "y0", "y0", "t", -2.0), ("bg", "x1", "x1", "t", 2.0), ("bg", "y1", "y1", "t", 2.0)], "component_id string, target_edge string, edge string, driver_id string, offset_pt double")
    actual = spark.createDataFrame([("t", 10.0, 20.0, 50.0, 40.0)], "driver_id string, x0 double, y0 double, x1 double, y1 double")
    value = F.element_at(F.create_map(*[x for e in g.EDGES for x in (F.lit(e), F.col(e))]), F.col("edge")) + F.col("offset_pt")
    return bindings.join(actual, "driver_id").groupBy("component_id").pivot("target_edge", list(g.EDGES)).agg(F.first(value))


@query("""
SELECT l_orderkey, l_linenumber, abs(CASE WHEN l_linenumber % 2 = 0 THEN (l_quantity - 1) - l_linenumber ELSE (60 - l_quantity) - (9 - l_linenumber) END) AS delta,
  greatest(6.0::DOUBLE, l_quantity * 0.75) AS floor_size, ((l_linenumber * 36) << 16) | ((l_linenumber * 30) << 8) | (l_linenumber * 20) AS colour FROM lineitem
""")
def alignment_font_colour(spark, sf_dir):
    q, n = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    row = table(spark, sf_dir, "lineitem").where("true")
    flat = lambda a, b: g.box(a, F.lit(0.0), b, F.lit(1.0))
    mode = F.when(F.col("l_linenumber") % 2 == 0, "left").otherwise("right")
    delta = g.alignment_delta(mode, flat(n, n), flat(F.lit(0.0), F.lit(9.0)), flat(q, q), flat(F.lit(1.0), F.lit(60.0)))
    return row.select("l_orderkey", "l_linenumber", delta.alias("delta"), g.font_floor(q).alias("floor_size"), g.srgb(n * 36 / 255, n * 30 / 255, n * 20 / 255).alias("colour"))


# --- rules ----------------------------------------------------------------------------------------------------


def sample_segments(spark) -> DataFrame:
    """A small manifest: one good segment, and one for each of several faults."""
    schema = "segment_id string, page int, semantic_type string, status string, action string, bbox struct<x0:double,y0:double,x1:double,y1:double>, page_bbox struct<x0:double,y0:double,x1:double,y1:double>, target_bbox struct<x0:double,y0:double,x1:double,y1:double>, mask_bbox struct<x0:double,y0:double,x1:double,y1:double>, source_text string, target_text string, protected_tokens array<struct<token:string,source_count:int,target_token:string>>, font_size double, source_size double"
    page, box = (0.0, 0.0, 300.0, 200.0), (10.0, 10.0, 100.0, 30.0)
    good = ["d.p0001.a", 1, "paragraph", "TRANSLATED", "replace", box, page, box, None, "Set 5 °C", "設為 5 °C", [("5 °C", 1, None)], 9.0, 10.0]

    def with_(at: int, value, name: str):
        row = list(good)
        row[0], row[at] = name, value
        return tuple(row)

    rows = [tuple(good), with_(2, "poem", "type"), with_(3, "DRAFT", "status"), with_(4, "erase", "action"), with_(5, (0.0, 0.0, 400.0, 10.0), "page"), with_(5, (5.0, 5.0, 5.0, 9.0), "empty"), with_(9, " ", "source"), with_(10, "", "blank"), with_(10, "設為", "lost"), with_(12, 5.0, "ratio"), with_(1, None, "fields")]
    return spark.createDataFrame(rows, schema)


@query("""
SELECT * FROM (VALUES ('type', 'SEMANTIC_TYPE'), ('status', 'STATUS'), ('action', 'RENDER_ACTION'), ('page', 'BBOX_PAGE'), ('empty', 'BBOX'), ('source', 'SOURCE_TEXT_EMPTY'), ('blank', 'TRANSLATION_EMPTY'),
  ('lost', 'PROTECTED_TOKEN_LOST'), ('ratio', 'FONT_RATIO'), ('fields', 'SEGMENT_FIELDS')) v(segment_id, code)
""")
def manifest_issues(spark, sf_dir):
    return rules.check(sample_segments(spark), rules.segment_rules("render"), ["segment_id"]).select("segment_id", "code")


@query("SELECT * FROM (VALUES ('a.pdf', 'BLOCKED'), ('b.pdf', 'NEEDS_REVIEW'), ('c.pdf', 'PASS')) v(path, status)")
def preflight_status(spark, sf_dir):
    files = spark.createDataFrame([("a.pdf", "%PDF-1.7 /JavaScript (x) /URI"), ("b.pdf", "%PDF-1.4 /URI (http)"), ("c.pdf", "%PDF-1.4 plain")], "path string, latin string")
    return rules.verdict(files, rules.check(files, rules.preflight_rules(), ["path"]), ["path"])


@query("SELECT * FROM (VALUES (1, 'BLOCKED'), (2, 'NEEDS_REVIEW'), (3, 'PASS')) v(page, status)")
def page_review_status(spark, sf_dir):
    schema = "page int, visual string, image_text string, geometry string, legibility string, reviewer string, reviewed_at string, page_reference string, review_dpi int, compare_sha256 string, reviewed_sha256 string, notes string"
    done = ("PASS", "PASS", "PASS", "NOT_APPLICABLE", "someone", "2024-05-01T10:00:00+08:00")
    rows = [
        (1, *done, "p001", 300, "x", "y", "p001: all labels compared with the source, none cut"),
        (2, "NOT_REVIEWED", "PASS", "PASS", "PASS", None, None, "p002", 300, "x", None, None),
        (3, *done, "p003", 300, "x", "x", "p003: table borders and units compared, all present"),
    ]
    pages = spark.createDataFrame(rows, schema)
    return rules.verdict(pages, rules.check(pages, rules.review_rules(), ["page"]), ["page"])


@query("SELECT * FROM (VALUES ('good', 'PASS'), ('old', 'BLOCKED'), ('path', 'BLOCKED')) v(pack_id, status)")
def pack_status(spark, sf_dir):
    rows = [("good", "1.0.0", "a" * 64, "0.1.0", "2.0.0", ["g.csv"]), ("old", "1.0.0", "a" * 64, "0.1.0", "0.9.0", ["g.csv"]), ("path", "1.0.0", "a" * 64, "0.1.0", "2.0.0", ["../g.csv"])]
    packs = spark.createDataFrame(rows, "pack_id string, version string, digest string, min_core string, max_core string, paths array<string>")
    return rules.verdict(packs, rules.check(packs, rules.pack_rules("1.2.3"), ["pack_id"]), ["pack_id"])


# --- layout contracts and paths on hand-made rows ---------------------------------------------------------------


def _box(*v: float) -> tuple:
    return tuple(float(x) for x in v)


@query("SELECT * FROM (VALUES ('g', 'a', 'f', 'COMPONENT_CONTAINMENT_FAILED'), ('g', 'b', 'a', 'COMPONENT_MINIMUM_CLEARANCE_FAILED'), ('g', 'b', 'z', 'COMPONENT_RELATION_TARGET_BBOX_MISSING')) v(group_id, component_id, target_id, code)")
def member_relation_issues(spark, sf_dir):
    boxes_ = spark.createDataFrame([("g", "f", _box(0, 0, 10, 10)), ("g", "a", _box(2, 2, 12, 8)), ("g", "b", _box(13, 2, 15, 8))], f"group_id string, component_id string, bbox {g.BOX}")
    rows = [("g", "a", "f", "contained_in", None, None), ("g", "b", "a", "clearance", 2.0, None), ("g", "b", "a", "align_center_y", None, 0.5), ("g", "b", "z", "contains", None, None)]
    return layout.member_relations(spark.createDataFrame(rows, "group_id string, component_id string, target_id string, type string, min_clearance double, max_delta double"), boxes_)


@query("SELECT * FROM (VALUES ('a', 'TRANSLATION_DEPENDENCY_DRIVER_BBOX_MISSING'), ('b', 'TRANSLATION_DEPENDENCY_EDGE_BINDINGS'), ('c', 'OK')) v(component_id, code)")
def dependent_box_issues(spark, sf_dir):
    bind = lambda c, driver, edges: [(c, e, "text", e, driver, 1.0) for e in edges]
    rows = bind("a", "none", g.EDGES) + bind("b", "t", g.EDGES[:3]) + bind("c", "t", g.EDGES)
    bindings = spark.createDataFrame(rows, "component_id string, target_edge string, basis string, edge string, driver_id string, offset_pt double")
    drivers = spark.createDataFrame([("t", "text", _box(1, 1, 5, 5))], f"driver_id string, basis string, bbox {g.BOX}")
    return layout.dependent_boxes(bindings, drivers).select("component_id", F.coalesce("code", F.lit("OK")).alias("code"))


@query("SELECT * FROM (VALUES ('p2', 'TABLE_CELL_PHRASE_MEMBER_MISSING'), ('p2', 'TABLE_CELL_SOURCE_PHRASE_MISMATCH'), ('p3', 'TABLE_CELL_PHRASE_CONTEXT')) v(group_id, code)")
def phrase_group_issues(spark, sf_dir):
    rows = [("p1", "a", 1, 1, ["a", "b"], "x y", " ", "x"), ("p1", "b", 2, 1, ["a", "b"], "x y", " ", "y"), ("p2", "c", 1, 1, ["c", "d"], "u v", " ", "u"), ("p3", "e", 1, 1, ["e", "f"], "s t", " ", "s"), ("p3", "f", 2, 2, ["e", "f"], "s t", " ", "t")]
    return layout.phrase_groups(spark.createDataFrame(rows, "group_id string, segment_id string, ord int, page int, listed array<string>, phrase string, separator string, text string"))


@query("SELECT * FROM (VALUES ('set1', 'INLINE_VISUAL_SWEEP_COVERAGE'), ('set2', 'INLINE_VISUAL_SWEEP_UNKNOWN_SEGMENT'), ('w2', 'INLINE_VISUAL_SWEEP_COUNT'), ('s2', 'INLINE_VISUAL_SWEEP_MISSING')) v(id, code)")
def sweep_issues(spark, sf_dir):
    sweeps = spark.createDataFrame([("w1", "set1", ["s1"], 1), ("w2", "set2", ["s3", "s9"], 3)], "sweep_id string, set_id string, expected_ids array<string>, expected_count int")
    return layout.sweep_issues(sweeps, spark.createDataFrame([("s1", "set1"), ("s2", "set1"), ("s3", "set2")], "segment_id string, set_id string"))


@query("SELECT * FROM (VALUES ('b', 'INLINE_SUPERSEDED_NOT_COVERED'), ('c', 'INLINE_SUPERSEDED_PAGE'), ('x', 'INLINE_SUPERSEDED_UNKNOWN_SEGMENT'), ('o', 'INLINE_SUPERSEDED_OWNER')) v(segment_id, code)")
def superseded_issues(spark, sf_dir):
    segments = spark.createDataFrame([("o", 1, _box(0, 0, 9, 9)), ("a", 1, _box(1, 1, 2, 2)), ("b", 1, _box(8, 8, 12, 9)), ("c", 2, _box(1, 1, 2, 2))], f"segment_id string, page int, bbox {g.BOX}")
    mapping = spark.createDataFrame([(x, "o") for x in "abcxo"], "segment_id string, owner_id string")
    return layout.superseded_issues(mapping, segments, spark.createDataFrame([("o", _box(0, 0, 9, 9))], f"owner_id string, cover {g.BOX}"))


@query("SELECT * FROM (VALUES ('s', 2, 'INLINE_VISUAL_INTERNAL_SCALING'), ('s', 3, 'INLINE_VISUAL_SHIFT_MISMATCH')) v(segment_id, ord, code)")
def inline_relocation_issues(spark, sf_dir):
    rows = [("s", 1, "up", _box(0, 0, 10, 10), _box(5, 0, 15, 10), 5.0, 0.0), ("s", 2, "down", _box(0, 0, 10, 10), _box(5, 0, 16, 10), 5.0, 0.0), ("s", 3, "left", _box(0, 0, 10, 10), _box(5, 0, 15, 10), 4.0, 0.0)]
    return layout.inline_issues(spark.createDataFrame(rows, f"segment_id string, ord int, label string, source_bbox {g.BOX}, target_bbox {g.BOX}, dx double, dy double"))


@query("SELECT * FROM (VALUES ('b', 'BACKGROUND_ADJUSTMENT_EXPANDS'), ('c', 'BACKGROUND_AVOID_REGION_INTERSECTION')) v(segment_id, code)")
def background_issues(spark, sf_dir):
    rows = [("a", _box(0, 0, 9, 9), _box(1, 1, 8, 8), [_box(8, 0, 9, 9)]), ("b", _box(0, 0, 9, 9), _box(1, 1, 10, 8), []), ("c", _box(0, 0, 9, 9), _box(1, 1, 8, 8), [_box(7, 7, 9, 9)])]
    return layout.adjusted_background(spark.createDataFrame(rows, f"segment_id string, source_bbox {g.BOX}, target_bbox {g.BOX}, avoid array<{g.BOX}>"))


@query("SELECT * FROM (VALUES ('a', 0, 'S', 3, 'OK'), ('a', 1, 'f', 1, 'OK'), ('b', NULL, NULL, NULL, 'CONTENT_PATH_UNTERMINATED')) v(doc_id, path_index, paint, n_ops, code)")
def content_path_rows(spark, sf_dir):
    """Content streams to path records; a malformed one is an issue."""
    rows = [("a", 1, 1, bytearray(b"q 1 0 0 1 2 3 cm 0 0 m 5 0 l h S Q 1 1 4 4 re f")), ("b", 1, 1, bytearray(b"0 0 m 1 1 l"))]
    out = content_stream.content_paths(spark.createDataFrame(rows, "doc_id string, page int, xref int, content binary"))
    return out.select("doc_id", "path_index", "paint", F.when(F.col("ops").isNotNull(), F.size("ops")).alias("n_ops"), F.coalesce("code", F.lit("OK")).alias("code"))


@query("SELECT * FROM (VALUES ('d', 1, 3)) v(doc_id, page, idx)")
def missing_drawings(spark, sf_dir):
    """A maximum matching under tolerance; pairing the two at 70 off first would leave the one at 69.9993 alone."""
    row = lambda i, dx: ("d", 1, i, _box(dx, 0, dx + 10, 1), "s", None, [0.0, 0.0, 0.0], 1.0, 0.0, 1.0, 1.0, "[] 0", None, False, False, [("l", [dx, 0.0, dx + 10.0, 0.0])])
    source, candidate = [row(0, 0.0), row(1, 0.0), row(2, 50.0), row(3, 90.0), row(4, 70.0), row(5, 69.9993)], [row(0, 0.0), row(1, 0.0005), row(2, 50.0009), row(3, 90.1), row(4, 70.0), row(5, 70.0007)]
    return drawings.missing(spark.createDataFrame(source, drawings.SCHEMA), spark.createDataFrame(candidate, drawings.SCHEMA))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE list_sort(list_distinct(list_concat([1 + o_orderkey % 5], range(3, 4 + o_orderkey % 4)))) END AS pages FROM orders")
def page_ranges(spark, sf_dir):
    """Expressions such as ``2,3-5`` as sorted distinct pages; reversed ones are null."""
    k = F.col("o_orderkey")
    spec = F.when(k % 9 == 0, F.lit("5-2")).otherwise(F.concat((1 + k % 5).cast("string"), F.lit(",3-"), (3 + k % 4).cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", readers.page_ranges(spec, F.lit(99)).alias("pages"))


@query("SELECT * FROM (VALUES (1, 1, 'OK'), (2, 1, 'OK'), (3, 2, 'OK'), (4, NULL, 'CANDIDATE_TEXT_SPAN_MATCH_COUNT'), (5, NULL, 'CANDIDATE_TEXT_SPAN_MATCH_COUNT')) v(line, span, code)")
def free_span_match(spark, sf_dir):
    """Lines in order take the one span still free; lines with none or several have a code."""
    lines = spark.createDataFrame([(1, 1, "ok", _box(0, 0, 10, 10), 10.0), (2, 2, "ok", _box(0, 0, 10, 10), 10.0), (2, 3, "ok", _box(0, 0, 30, 10), 10.0), (3, 4, "ok", _box(0, 0, 9, 9), 1.0), (4, 5, "two", _box(0, 0, 9, 9), 1.0)], f"page int, line int, text string, box {g.BOX}, size double")
    spans = spark.createDataFrame([(1, 1, "ok", 5.0, 5.0), (2, 1, "ok", 5.0, 5.0), (2, 2, "ok", 25.0, 5.0), (4, 1, "two", 5.0, 5.0), (4, 2, "two", 5.0, 5.0)], "page int, span int, text string, cx double, cy double")
    return matching.free_text_match(lines, spans, ["page"], "line", "span", "text", "cx", "cy", "box", "size").select("line", "span", F.coalesce("code", F.lit("OK")).alias("code"))


@query()
def wrapped_lines(spark, sf_dir):
    """Greedy line breaking of a turn at 40 units, by a fold over its words."""
    words = F.transform(F.split("text", " "), lambda w: F.length(w).cast("double") + 1)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_max(ordered.wrapped(words, F.lit(40.0))).alias("lines"))


@query("SELECT * FROM (VALUES ('a', 'PASS'), ('b', 'BLOCKED'), ('c', 'BLOCKED')) v(token, status)")
def allowlist_status(spark, sf_dir):
    rows = [("a", "brand", "registered trade name", [1, 2], [1], ["s"], True, "policy", "r"), ("b", "brand", "too hard to translate", [1, 2], [1], ["s"], True, "policy", "r"), ("c", "brand", "registered trade name", [1, 2], [3], ["s"], True, "policy", "r")]
    df = spark.createDataFrame(rows, "token string, type string, reason string, scope_pages array<int>, pages array<int>, segment_ids array<string>, exact boolean, basis_type string, basis_reference string")
    return rules.verdict(df, rules.check(df, rules.allowlist_rules(("brand",), ("policy",), ("too hard",)), ["token"]), ["token"])
