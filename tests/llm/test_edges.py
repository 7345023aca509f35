"""Nulls, long texts, ties, repeated rows, empty tables and clashing columns of operators one by one."""

import pytest
from pyspark.sql import functions as F

from quirework.llm import decontaminate, jaccard_join, langid, mixing, sharding, urlfilter, warczip
from tests.llm import brute

DOCS = "doc_id long, text string"


def test_decontamination_of_null_ids_and_long_items(spark):
    long_item = " ".join(f"w{i}" for i in range(900))
    bench = [("a", long_item), (None, "a short one"), ("c", None), ("d", "..."), ("a", long_item)]
    rows = [(None, long_item[:400]), (1, None), (2, "x a short one y"), (3, "v " * 30_000 + long_item[-200:]), (2, "x a short one y")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("items", F.lit("clash"))
    got = decontaminate.judged(docs, spark.createDataFrame(bench, "item_id string, text string"), keep=["doc_id"], block_bytes=600)
    got = sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in got.collect()), key=str)
    want = brute.decontaminated([(d or -1, t) for d, t in rows], list(dict.fromkeys(bench)))
    assert got == sorted(((d if d > 0 else None, *rest) for d, *rest in want), key=str)


def test_mix_of_null_ids_and_long_texts(spark):
    rows = [(None, "a", 3), (None, "a", 3), (1, "a", 200_000), (2, "b", 5), (2, "b", 5), (3, "c", 0)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("taken", F.lit("clash"))).collect()
    assert len(out) == 6 and all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    assert {r["source"]: r["target"] for r in out}["b"] == 30


def test_jaccard_of_repeated_ids_with_other_texts_and_clashing_names(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(60)) for p in "abc")
    rows = [(5, a), (5, b), (3, a), (9, b + " and more"), (9, b + " and more"), (7, c), (None, c), (8, ""), (8, None)]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("n", "rep", "comp", "node", "component", "part", "bits"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.neardup(docs).collect()), key=str)
    want = [(5, 56, 3), (5, 56, 3), (3, 56, 3), (9, 58, 3), (9, 58, 3), (7, 56, 7), (None, 56, 7), (8, 0, 8), (8, 0, 8)]
    assert got == sorted(want, key=str)


def test_jaccard_of_a_group_of_near_copies_and_its_neighbours(spark):
    import random

    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 5, 7])):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(base[: 60 + 10 * i])) for i in range(6)]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.neardup(spark.createDataFrame(rows, DOCS)).collect())
    assert got == brute.neardup(rows)


def test_shards_of_repeated_rows_and_long_texts(spark):
    rows = [(1, 5, "en", "s")] * 40 + [(2, 1 << 40, None, None), (None, 1, "de", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, size long, lang string, source string").withColumn("slot", F.lit("clash")).withColumn("hilbert", F.lit(0))
    out = sharding.shard(docs).collect()
    counts = [sum(r["shard"] == s for r in out) for s in range(8)]
    assert len(out) == 42 and max(counts) - min(counts) <= 1
    assert all(sorted(r["slot"] for r in out if r["shard"] == s) == list(range(counts[s])) for s in range(8))


def test_files_of_shards_prune_by_every_dimension(spark):
    rows = [(i, 1 << (i * 7 % 12), f"l{i % 8}", f"s{i * 5 % 11:02}") for i in range(4096)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, size long, lang string, source string"), shards=64)
    ranges = out.groupBy("shard").agg(*[f(c).alias(f"{n}_{c}") for c in ("size", "lang", "source") for n, f in (("lo", F.min), ("hi", F.max))]).collect()
    for c, value in (("size", 64), ("lang", "l3"), ("source", "s05")):
        read = sum(r[f"lo_{c}"] <= value <= r[f"hi_{c}"] for r in ranges)
        assert read <= 48, (c, read)  # of 64


def test_language_of_repeated_rows_and_an_empty_table(spark):
    profiles = langid.fit(spark.createDataFrame([(1, "aa", "the thing"), (2, "bb", "ung keit")], "doc_id long, lang string, text string"))
    out = langid.identify(spark.createDataFrame([(1, "the"), (1, "the"), (None, "keit")], DOCS), profiles).collect()
    assert [r["lang_pred"] for r in out] == ["aa", "aa", "bb"] and out[0] == out[1]
    assert langid.identify(spark.createDataFrame([], DOCS), profiles).count() == 0


def test_urls_that_repeat_tie_and_run_long(spark):
    rows = [(1, "http://a.net/x"), (1, "http://a.net/x"), (2, "http://h.com/" + "y" * 50_000), (3, "http://h.com/" + "z" * 50_000), (4, "://"), (5, "http:///p")]
    out = [r.asDict() for r in urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("purity", F.lit("clash"))).collect()]
    assert len(out) == 6 and out.count(out[0]) >= 1 and {r["template"] for r in out if r["page_id"] in (2, 3)} == {"/*"}
    assert sum(r["page_id"] == 1 and r["verdict"] == "block" for r in out) == 2


def test_archives_of_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (2, "v", "x")], "page_id long, url string, html string")
    for name in ("digest", "first", "n", "path", "refers_to"):
        pages = pages.withColumn(name, F.lit("clash"))
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warczip.read(warczip.written(pages)).collect())
    assert got == [(1, "response", None), (2, "revisit", 1)]


def test_ids_that_are_no_integers_are_told(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        jaccard_join.neardup(spark.createDataFrame([("a", "x")], "doc_id string, text string")).collect()
