"""Queries of this subpackage: opN_<name>(spark, sf_dir), and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import decontaminate, jaccard_join, langid, linededup, media, mixing, sharding, toxicity, urlfilter, warczip
from quirework.sources.scratch import Scratch
from quirework.llm.oracle import ORACLE  # noqa: F401


def remainder(doc_id: str, n: int) -> Column:
    """crc32(doc_id as text) mod n."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    return mixing.mix(Scratch(spark, "op2").cut(docs, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.neardup(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 3) == 1
    learn = labels.where(~held_out & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    # whatever the labels say, what is scored has the text alone
    model = toxicity.fit(docs.select("doc_id", "text").join(learn, "doc_id"))
    out = toxicity.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"), "spans")


def op5_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read(*media.written(table(spark, sf_dir, "documents")))


def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), "lang", "source")
    return sharding.shard(Scratch(spark, "op7").cut(docs, "sizes")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 5) == 0
    profiles = langid.fit(docs.where(~held_out).select("doc_id", "lang", "text"))
    out = langid.identify(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warczip.written(table(spark, sf_dir, "pages"))
    return warczip.read(packages, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("kept_text").cast("long").alias("kept_chars"), F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


QUERIES = {
    f.__name__: f
    for f in (op1_decontaminate, op2_mix, op3_ngram_jaccard, op4_toxicity, op5_media_chunks, op6_url_templates, op7_shard, op8_language, op9_warc_zip, op10_line_alignment)
}

