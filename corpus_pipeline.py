"""A corpus pipeline of five stages; each takes all that its predecessor kept and its decisions take effect.

language ID -> n-gram Jaccard join -> benchmark decontamination -> mixing sources to target weights -> sharding.
run() writes each stage's rows as Parquet in the session's shared folder and rereads them as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import decontaminate, jaccard_join, langid, mixing, sharding
from quirework.sources.scratch import Scratch
from quirework.llm.queries import remainder


def aside(docs: DataFrame, *names: str) -> DataFrame:
    """Columns that a stage has names for under other names."""
    return docs.withColumnsRenamed({c: f"_own_{c}" for c in names if c in docs.columns})


def back(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"_own_{c}").alias(c) if f"_own_{c}" in df.columns else F.col(c) for c in columns])


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without letters or text go."""
    profiles = langid.fit(docs.where(remainder("doc_id", 5) != 0).select("doc_id", "lang", "text"))
    judged = langid.identify(aside(docs, "lang_pred", "score"), profiles)
    return back(judged.where(F.col("lang_pred") != langid.UNKNOWN), docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that 5-word shingles link at a Jaccard similarity of 0.75, the one with the smallest id; of rows that
    repeat an id, that with the smallest text."""
    groups, scratch = jaccard_join.neardup(docs), Scratch(spark, "pipeline")
    ids = groups.groupBy("doc_id").agg(F.count("*").alias("_rows"), F.bool_or(F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(False))).alias("_goes"))
    told = scratch.cut(ids.where("doc_id is not null and (_goes or _rows > 1)"), "told")
    others, repeated = told.where("_goes").select("doc_id"), told.where("not _goes").select("doc_id")
    kept = docs.join(others, "doc_id", "left_anti").select(*docs.columns)
    if not repeated.head(1):
        return kept
    order = ["text", *[c for c in docs.columns if c not in ("doc_id", "text")]]
    one = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*order)).alias("_row")).select("doc_id", "_row.*").select(*docs.columns)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(one)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontaminate.decontaminate(aside(docs, *decontaminate.RESULT.names), benchmark)
    return back(judged.where(F.size("spans") == 0), docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    named = aside(docs, "size", "source_size", "target", "copies", "taken", "weight")
    return back(mixing.emitted(mixing.mix(named.withColumn("size", mixing.n_words(F.col("text"))))), docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their shard and slot along the Hilbert curve."""
    docs = docs.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long"))
    return sharding.shard(docs)


STAGES = [
    ("language", keep_language),
    ("ngram_jaccard", one_of_each_group),
    ("decontaminate", without_benchmark),
    ("mix", mixed),
    ("shard", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs


#: Language profiles and near-duplicate closure aren't expressible; tests hold run() against a brute-force version.
ORACLE_SQL = None
