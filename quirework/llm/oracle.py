"""DuckDB SQL for those queries that SQL can express, over whole tables."""

from __future__ import annotations

from quirework.llm.mixing import ORACLE as MIX
from quirework.llm.sharding import BITS, curve_steps

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
k AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM k)),
sizes AS (SELECT DISTINCT n FROM win),
runs AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT runs.r, runs.i, runs.n, win.item FROM runs JOIN win USING (n, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items.items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c(node, reached) AS (SELECT a, a FROM e UNION SELECT c.node, e.b FROM c JOIN e ON e.a = c.reached)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.low, t.doc_id) AS component_id
FROM documents t LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node, min(reached) AS low FROM c GROUP BY 1) m ON m.node = t.doc_id
"""


def _shard() -> str:
    top = 1 << BITS
    levels = lambda c: f"SELECT {c} AS v, (CASE WHEN count(*) OVER () > {top} THEN ((row_number() OVER (ORDER BY {c} NULLS LAST) - 1) * {top}) // count(*) OVER () ELSE row_number() OVER (ORDER BY {c} NULLS LAST) - 1 END) AS i FROM (SELECT DISTINCT {c} FROM documents)"
    sql = f"""SELECT doc_id, text, size, length(bin(size)) - 1 AS _h0, x.i AS _h1, y.i AS _h2 FROM
      (SELECT doc_id, lang, source, coalesce(text, '') AS text, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size FROM documents) d
      JOIN ({levels("lang")}) x ON x.v IS NOT DISTINCT FROM lang JOIN ({levels("source")}) y ON y.v IS NOT DISTINCT FROM source"""
    for step in curve_steps():
        sql = f"SELECT * REPLACE ({', '.join(f'{v} AS {k}' for k, v in step.items())}) FROM ({sql})" if "hilbert" not in step else f"SELECT *, {step['hilbert']} AS hilbert FROM ({sql})"
    return f"""
WITH n AS (SELECT count(*) AS n FROM documents),
h AS ({sql}),
r AS (SELECT h.*, n.n, row_number() OVER (ORDER BY hilbert, CAST('0x' || substr(md5('shard:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT), doc_id NULLS FIRST, size) - 1 AS rank FROM h, n),
s AS (SELECT *, ((rank + 1) * 8 - 1) // n AS shard FROM r),
c AS (SELECT doc_id, list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
  lambda c, v: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, v)), 4294967295) AS crc FROM s)
SELECT s.doc_id, s.size, xor(c.crc, 4294967295) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(rank - (shard * n) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s JOIN c USING (doc_id)
"""


SHARD = _shard()

WARC = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY 1),
d AS (SELECT h, first, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
  lambda b: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) >> b) & 31) + 1]), '')), '') AS digest FROM f)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN d USING (h)
"""

ORACLE = {"op1_decontaminate": DECONTAMINATE, "op2_mix": MIX, "op3_ngram_jaccard": JACCARD, "op7_shard": SHARD, "op9_warc_zip": WARC}
