"""Registered queries of readers, sinks and streams: tables are written as artefacts in the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalogue import query, table
from quirework.sources import readers, sinks
from quirework.sources.scratch import Scratch
from quirework.streaming import ledger


@query("""
WITH g AS (SELECT CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE 'id' || (p_partkey - p_partkey % 7 // 6) END AS id, p_name AS source, p_brand AS target FROM part),
f AS (SELECT id, lower(trim(source, ' ')) AS source FROM g)
SELECT id, 'GLOSSARY_FIELD_EMPTY' AS code FROM g WHERE id IS NULL
UNION ALL SELECT id, 'GLOSSARY_DUPLICATE_ID' FROM g WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
UNION ALL SELECT min(id), 'GLOSSARY_DUPLICATE_SOURCE' FROM f GROUP BY source HAVING count(*) > 1
""")
def glossary_files(spark, sf_dir):
    """Parts as a glossary file: fields that are missing, ids and sources that repeat."""
    s, k = Scratch(spark, "glossary"), F.col("p_partkey")
    ident = F.when(k % 50 != 0, F.concat(F.lit("id"), (k - F.floor(k % 7 / 6)).cast("string")))
    rows = table(spark, sf_dir, "part").select(ident.alias("id"), F.col("p_name").alias("source"), F.col("p_brand").alias("target"), F.lit("note, quoted").alias("notes"))
    rows.write.option("header", True).csv(f"{s.top}/csv")
    return readers.glossary_issues(readers.glossary(spark, f"{s.top}/csv", 1)).select("id", "code")


@query("""
SELECT r_name || '.json' AS name, 'INVALID_JSON' AS code FROM region WHERE r_regionkey = 2
UNION ALL SELECT r_name || '.json', 'ALLOWLIST_SCHEMA' FROM region WHERE r_regionkey = 3
UNION ALL SELECT r_name || '.json', lower(r_name) || ' on page ' || p FROM region, (VALUES (1), (4)) v(p) WHERE r_regionkey IN (0, 1, 4) AND NOT contains(r_name, ' ')
UNION ALL SELECT DISTINCT r_name || '.json', lower(unnest(string_split(r_name, ' '))) || ' on page ' || p FROM region, (VALUES (1), (4)) v(p) WHERE r_regionkey IN (0, 1, 4) AND contains(r_name, ' ')
""")
def allowlist_files(spark, sf_dir):
    """Regions as strict allowlists, one broken and one of another schema."""
    s, k = Scratch(spark, "allowlists"), F.col("r_regionkey")
    schema = F.when(k == 3, "other").otherwise(readers.ALLOWLIST_SCHEMA)
    body = F.concat(F.lit('{"schema": "'), schema, F.lit('",\n"allowed": [{"token": "'), F.col("r_name"), F.lit('", "scope": {"pages": [1, 4]}}]'), F.when(k != 2, "}").otherwise(""))
    table(spark, sf_dir, "region").select("r_name", body.alias("value")).repartition("r_name").write.partitionBy("r_name").text(f"{s.top}/json")
    tokens, issues = readers.scoped_allowlist(spark, f"{s.top}/json/*/*")
    name = F.concat(F.replace(F.regexp_extract("path", "r_name=([^/]*)/", 1), F.lit("%20"), F.lit(" ")), F.lit(".json"))
    told = tokens.select(name.alias("name"), F.concat("token", F.lit(" on page "), F.col("page").cast("string")).alias("code"))
    return told.unionByName(issues.select(name.alias("name"), "code"))


@query("SELECT n_name AS name, CAST(length(n_name) + 6 AS BIGINT) AS size, upper(sha256(n_name || ' text' || chr(10))) AS sha256 FROM nation")
def raw_file_digests(spark, sf_dir):
    """Nations' names as files: size and digest of each."""
    s = Scratch(spark, "raw")
    table(spark, sf_dir, "nation").select("n_name", F.concat("n_name", F.lit(" text")).alias("value")).repartition("n_name").write.partitionBy("n_name").text(f"{s.top}/files")
    name = F.replace(F.regexp_extract("path", "n_name=([^/]*)/", 1), F.lit("%20"), F.lit(" "))
    return readers.raw_files(spark, f"{s.top}/files").where(F.col("path").contains("/part-")).select(name.alias("name"), "size", "sha256")


@query("SELECT o_orderpriority AS batch_id, CAST(2 * count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def ledger_appends(spark, sf_dir):
    """Two appends to a ledger, and create-only requests by batch."""
    s, o = Scratch(spark, "ledger"), table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("batch_id"))
    for _ in range(2):
        sinks.append_ledger(o, f"{s.top}/ledger")
    sinks.write_requests(o, f"{s.top}/requests")
    known = spark.read.json(f"{s.top}/requests").select("batch_id").distinct()
    return spark.read.parquet(f"{s.top}/ledger").join(known, "batch_id", "left_semi").groupBy("batch_id").agg(F.count("*").alias("n"))


@query("""
SELECT date_trunc('hour', TIMESTAMP '2024-05-01 00:00:00' + to_seconds(o_orderkey % 20000)) AS window_start, o_orderpriority AS stage, CAST(sum(o_orderkey % 100) AS DOUBLE) AS seconds, CAST(count(*) AS BIGINT) AS attempts FROM orders GROUP BY 1, 2
""")
def stage_stream(spark, sf_dir):
    """Orders as timings that arrive as files: seconds by stage and hour, as a stream that is read to its end."""
    s, k = Scratch(spark, "stream"), F.col("o_orderkey")
    ended = F.timestamp_seconds(F.lit(1714521600) + k % 20000)
    rows = table(spark, sf_dir, "orders").select(k.cast("string").alias("attempt_id"), F.col("o_orderpriority").alias("stage"), (ended - F.make_dt_interval(secs=k % 100)).alias("started_at"), ended.alias("completed_at"), F.lit("done").alias("status"))
    rows.write.json(f"{s.top}/timings")
    stream = spark.readStream.schema(ledger.TIMING).json(f"{s.top}/timings")
    name = f"stage_stream_{abs(hash(s.top))}"
    ledger.run_once(ledger.stage_totals(stream), name, f"{s.top}/state", "complete")
    return s.cut(spark.table(name), "totals")
