"""Readers: JSON artefacts, glossaries, allowlists, page ranges, raw files, HTML pages as blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions.text import folded
from quirework.sources.scratch import Scratch

#: Fixed value: the name that strict allowlists declare.
ALLOWLIST_SCHEMA = "english-allowlist/v3"
GLOSSARY = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "source", "target", "notes")])


def json_objects(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, issues): whole-file JSON objects of a declared schema; what doesn't parse becomes an issue."""
    typed = T.StructType.fromDDL(f"{schema}, _corrupt string")
    raw = spark.read.schema(typed).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("path", F.input_file_name())
    raw = Scratch(spark, "json").cut(raw, "objects")  # a corrupt column alone can't be read from JSON
    return raw.where("_corrupt is null").drop("_corrupt"), raw.where("_corrupt is not null").select("path", F.lit("BLOCKED").alias("severity"), F.lit("INVALID_JSON").alias("code"))


def glossary(spark: SparkSession, path: str, layer: int) -> DataFrame:
    """Rows of id,source,target,notes; a file with another header fails."""
    return spark.read.schema(GLOSSARY).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path).withColumn("layer", F.lit(layer))


def legacy_allowlist(spark: SparkSession, path: str) -> DataFrame:
    """Lines as (kind, token): ``#`` starts a comment, ``re:`` a pattern."""
    line = F.trim("value")
    rows = spark.read.text(path).where((line != "") & ~line.startswith("#"))
    kind = F.when(line.startswith("re:"), "regex").otherwise("exact")
    return rows.select(kind.alias("kind"), F.when(line.startswith("re:"), F.substring(line, 4, 1 << 30)).otherwise(line).alias("token"))


def glossary_issues(rows: DataFrame) -> DataFrame:
    """(layer, id, code) of glossary rows without id, source or target, and of ids and folded sources that repeat."""
    blank = F.lit(False)
    for c in ("id", "source", "target"):
        blank |= F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    empty = rows.where(blank).select("layer", "id", F.lit("GLOSSARY_FIELD_EMPTY").alias("code"))

    def repeated(key: Column, code: str) -> DataFrame:
        twice = rows.withColumn("_key", key).groupBy("layer", "_key").agg(F.count("*").alias("_n"), F.min("id").alias("id")).where("_n > 1 and _key <> ''")
        return twice.select("layer", "id", F.lit(code).alias("code"))

    return empty.unionByName(repeated(F.col("id"), "GLOSSARY_DUPLICATE_ID")).unionByName(repeated(folded(F.trim("source")), "GLOSSARY_DUPLICATE_SOURCE"))


def scoped_allowlist(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(tokens by page, issues) of strict JSON allowlists: every entry holds for the pages of its scope alone."""
    entry = "array<struct<token:string,source_text:string,scope:struct<pages:array<int>>>>"
    rows, issues = json_objects(spark, path, f"`schema` string, allowed {entry}, allowed_ui_english {entry}, allowed_visual_english {entry}")
    wrong = rows.where(~F.col("schema").eqNullSafe(F.lit(ALLOWLIST_SCHEMA))).select("path", F.lit("BLOCKED").alias("severity"), F.lit("ALLOWLIST_SCHEMA").alias("code"))
    lists = [F.coalesce(c, F.array().cast(entry)) for c in ("allowed", "allowed_ui_english", "allowed_visual_english")]
    each = rows.where(F.col("schema") == ALLOWLIST_SCHEMA).select("path", F.explode(F.concat(*lists)).alias("e"))
    words = F.regexp_extract_all(F.coalesce("e.token", "e.source_text"), F.lit("[A-Za-z]+"), F.lit(0))
    tokens = each.select("path", F.explode("e.scope.pages").alias("page"), words.alias("w")).select("path", "page", F.explode("w").alias("token"))
    return tokens.select("path", "page", folded(F.col("token")).alias("token")).distinct(), issues.unionByName(wrong)


def page_ranges(expression: Column, pages: Column) -> Column:
    """``1,3-5`` as sorted distinct pages; null where it is malformed, reversed or beyond the document."""
    parts = F.transform(F.split(expression, ","), lambda p: F.trim(p))
    good = F.forall(parts, lambda p: p.rlike(r"^[1-9]\d{0,8}(-[1-9]\d{0,8})?$"))
    edges = F.transform(parts, lambda p: F.struct(F.try_element_at(F.split(p, "-"), F.lit(1)).try_cast("int").alias("a"), F.try_element_at(F.split(p, "-"), F.lit(-1)).try_cast("int").alias("b")))
    fits = F.forall(edges, lambda e: F.coalesce((e["a"] <= e["b"]) & (e["b"] <= pages), F.lit(False)))
    return F.when(good & fits, F.array_sort(F.array_distinct(F.flatten(F.transform(edges, lambda e: F.sequence(e["a"], F.greatest(e["a"], e["b"])))))))


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """path, size, sha256 in capitals, and the bytes as ISO-8859-1 text."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.upper(F.sha2("content", 256)).alias("sha256"), F.decode("content", "ISO-8859-1").alias("latin"), "content")


def html_blocks(html: Column) -> Column:
    """array<struct<tag,text>> of headings, paragraphs and list items, tags and entities inside them removed."""
    body = F.regexp_replace(html, r"(?is)<(script|style|nav|head)\b.*?</\1>|<!--.*?-->", " ")
    found = F.regexp_extract_all(body, F.lit(r"(?is)<(?:h[1-6]|p|li)\b[^>]*>.*?</(?:h[1-6]|p|li)>"), F.lit(0))
    return F.transform(found, lambda b: F.struct(F.lower(F.regexp_extract(b, r"^<(\w+)", 1)).alias("tag"), F.btrim(F.regexp_replace(F.regexp_replace(b, r"(?s)<[^>]*>", ""), r"\s+", " ")).alias("text")))
