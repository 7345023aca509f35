"""The pipeline stage by stage against brute force, on a small corpus with planted cases."""

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("sf")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    item = spark.read.parquet(f"{SF}/benchmark.parquet").collect()[0]["text"]
    first = min(texts)
    planted = [(9000, texts[first], "en", "s", 1), (9001, f"before {item} after", "en", "s", 1), (9002, None, None, None, 0), (9003, "12 34 !?", "en", "s", 8), (9004, texts[first] + " more", "en", "s", 1)]
    docs.unionByName(spark.createDataFrame(planted, docs.schema)).write.parquet(f"{top}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{top}/benchmark.parquet")
    return str(top)


def test_each_stage_on_its_own_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, {}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    before = [r.asDict() for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        after = [r.asDict() for r in out.collect()]
        ids, texts = [r["doc_id"] for r in after], [(r["doc_id"], r["text"]) for r in before]
        if name == "language":
            assert sorted(ids) == sorted(d for d, t in texts if t and re.search(r"[^\W\d_]", t))
        elif name == "ngram_jaccard":
            assert sorted(ids) == sorted(d for d, _, c in brute.neardup(texts) if d == c)
        elif name == "decontaminate":
            assert sorted(ids) == sorted(r[0] for r in brute.decontaminated(texts, items) if not r[5])
        elif name == "mix":
            assert set(ids) <= {d for d, _ in texts} and max(Counter(ids).values()) <= 3
        else:
            assert len(after) == len(before)
            counts = Counter(r["shard"] for r in after)
            assert max(counts.values()) - min(counts.values()) <= 1
        if k < 4:
            assert out.columns == columns
        rows[name] = len(after)
        docs, before = out, after
    assert rows["language"] > rows["ngram_jaccard"] > rows["decontaminate"]


def test_run_gives_the_last_stage(spark, sf_dir):
    a, b = (sorted((r["doc_id"], r["shard"]) for r in corpus_pipeline.run(spark, sf_dir).collect()) for _ in range(2))
    assert a == b and len(a) > 0


CLASHES = ("lang_pred", "score", "spans", "n_words", "items", "size", "target", "copies", "weight", "n", "rep", "comp")


def test_stages_with_clashing_columns_and_repeated_rows(spark, sf_dir):
    rows = [(1, "some words of a text that stand here", "en", "s", 1), (1, "some words of a text that stand here", "en", "s", 1), (1, "another text under the same id, longer than it", "en", "s", 1), (2, "some words of a text that stand here", "en", "s", 1), (3, "und noch ein anderer Text dazu", "de", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns
        out = got.collect()
        assert all(r[c] == f"own {c}" for r in out for c in CLASHES), name
        if name == "ngram_jaccard":  # id 1 links with 2; one of its rows stays
            assert sorted((r["doc_id"], r["text"]) for r in out) == [(1, rows[2][1]), (3, rows[4][1])]
        if name in ("language", "decontaminate"):
            assert len(out) == 5
    assert corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).count() == 5


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
