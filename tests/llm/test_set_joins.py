"""Decontamination, n-gram Jaccard join and line deduplication against plain versions, and their edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from quirework.llm import decontaminate, jaccard_join, linededup
from tests.llm import brute

DOCS = "doc_id long, text string, n_words int, lang string"


def corpus(seed: int, n: int = 120) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3 and out:
            words = (rng.choice(out)[1] or "").split(" ")
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        else:
            text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
        out.append((i, text, 7, "en"))
    return out + [(n, None, 1, None), (n + 1, "", 1, None), (n + 2, "One  TWO\tthree", 1, None), (n + 3, "one two three", 1, None), (n + 4, "é" * 5000 + " x" * 4000, 1, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_equals_brute_force(spark, seed):
    rows = corpus(seed)
    got = jaccard_join.neardup(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(tuple(r) for r in got) == brute.neardup([r[:2] for r in rows])


def test_jaccard_join_of_a_cluster_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(200)] = f"x{rng.random()}"
        rows.append((i, " ".join(words), 0, "en"))
    got = jaccard_join.neardup(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(tuple(r) for r in got) == brute.neardup([r[:2] for r in rows])


def test_jaccard_join_of_nothing_and_of_repeated_rows(spark):
    assert jaccard_join.neardup(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(3, "a b c d e f g", 0, None)] * 3 + [(1, "a b c d e f g", 0, None), (9, None, 0, None)]
    got = jaccard_join.neardup(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 3, 1), (3, 3, 1), (3, 3, 1), (3, 3, 1), (9, 0, 9)]


def items(rows):
    return [(1, "alpha beta gamma"), (2, None), (3, "..."), (4, " ".join(rows[5][1].split(" ")[3:20])), (4, "zeta"), (5, "One-two THREE"), (6, rows[7][1] + " and more that occurs nowhere " + rows[8][1])]


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rows = corpus(3)
    rows.append((500, "say Alpha, beta. gamma! " + rows[5][1] + " one TWO three", 1, None))
    bench = items(rows)
    got = decontaminate.judged(spark.createDataFrame(rows, DOCS), spark.createDataFrame(bench, "item_id long, text string"), keep=["doc_id"], block_bytes=block_bytes)
    got = [tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(got) == brute.decontaminated([r[:2] for r in rows], bench)


def test_decontamination_of_empty_tables_and_extra_columns(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    out = decontaminate.decontaminate(spark.createDataFrame([], DOCS), bench)
    assert out.count() == 0 and out.columns == ["doc_id", "text", "lang", "n_words", "spans", "items"]
    rows = spark.createDataFrame([(1, "a b c", 99, "en")] * 2, DOCS)
    assert {r["n_words"] for r in decontaminate.decontaminate(rows, bench).collect()} == {3}
    none = decontaminate.judged(rows, spark.createDataFrame([], "item_id long, text string")).collect()
    assert [r["contaminated"] for r in none] == [False, False]


def test_line_dedup_of_long_and_empty_texts(spark):
    rows = [(1, None), (2, ""), (3, "y" * 100_000), (4, "y" * 100_000 + "\nshort"), (None, "a line of an unknown document"), (5, "a line of an unknown document"), (6, "a b")]
    got = {r["doc_id"]: r["kept_text"] for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept_text", F.lit("clash"))).collect()}
    assert got == {1: None, 2: "", 3: "y" * 100_000, 4: "short", None: "a line of an unknown document", 5: "", 6: "a b"}


def test_line_dedup_leaves_own_lines_of_repeated_ids(spark):
    x, y = "the first line that several documents share", "the second line that several documents share"
    rows = [(1, f"{x}\n{y}"), (5, f"{x}\nits own line which nobody else has"), (5, f"another own line that has to stay\n{x}"), (5, f"{x}\nits own line which nobody else has")]
    got = sorted((r["doc_id"], r["kept_text"]) for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, f"{x}\n{y}"), (5, "another own line that has to stay"), (5, "its own line which nobody else has"), (5, "its own line which nobody else has")]


def test_line_dedup_removes_whole_copies(spark):
    x, y = "the first line that several documents share", "the second line that several documents share"
    rows = [(1, f"{y}\nx\n{x}"), (2, f"{x}\n{y}"), (3, f"{x}\n{y}"), (4, f"{x}\nz\n{y}"), (6, f"{x}\nz\n{y}")]
    got = {r["doc_id"]: r["kept_text"] for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[3] == "" and got[6] == "" and got[1] == rows[0][1]


def test_patience_diff_aligns_in_order():
    a, b = list("abcxdefg"), list("zabcdyefg")
    pairs = linededup.patience(a, b)
    assert [a[i] for i, _ in pairs] == [b[j] for _, j in pairs] == list("abcdefg")
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def test_line_dedup_of_an_empty_table(spark):
    assert linededup.dedup(spark.createDataFrame([], "doc_id long, text string, cut int")).count() == 0


def plain_alignment(a, b):
    """Patience diff by its definition: equal ends, then unique lines in their longest common order, then the gaps; where
    no line is unique, equal lines are counted off."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0), *((i + 1, j + 1) for i, j in plain_alignment(a[1:], b[1:]))]
    if a[-1] == b[-1]:
        return [*plain_alignment(a[:-1], b[:-1]), (len(a) - 1, len(b) - 1)]
    pairs = [(i, b.index(x)) for i, x in enumerate(a) if a.count(x) == b.count(x) == 1]
    if not pairs:
        pairs = [(i, [j for j, y in enumerate(b) if y == x][a[:i].count(x)]) for i, x in enumerate(a) if a[:i].count(x) < b.count(x)]
    if not pairs:
        return []
    best = []  # the longest increasing run up to each pair; of several, that which stays lowest
    for k, (_, j) in enumerate(pairs):
        best.append([*min((best[h] for h in range(k) if pairs[h][1] < j), key=lambda r: (-len(r), r[-1][1]), default=[]), pairs[k]])
    anchors = min(best, key=lambda r: (-len(r), r[-1][1]))
    out, (p, q) = [], (0, 0)
    for i, j in [*anchors, (len(a), len(b))]:
        out += [(p + x, q + y) for x, y in plain_alignment(a[p:i], b[q:j])] + [(i, j)]
        p, q = i + 1, j + 1
    return out[:-1]


def plain_removed(later, earlier, least):
    run, out, before = [], set(), None
    for i, j in [*plain_alignment(later, earlier), (-9, -9)]:
        if before != (i - 1, j - 1):
            out |= set(run) if sum(len(later[x]) for x in run) >= least else set()
            run = []
        run.append(i)
        before = (i, j)
    return out


def plain_aligned_with_all(rows, least=20):
    """Alignment with every earlier document that shares a run of lines with ``least`` characters."""
    lines = {d: [x.strip(" ") for x in t.split("\n")] for d, t in rows}
    runs = {}
    for d, x in lines.items():
        runs[d] = {tuple(x[i:k]) for i in range(len(x)) for k in range(i + 1, len(x) + 1) if sum(map(len, x[i:k])) >= least}
    out = {}
    for d, text in rows:
        gone = set()
        for e in lines:
            if e < d and runs[d] & runs[e]:
                gone |= plain_removed(lines[d], lines[e], least)
        out[d] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


def test_line_dedup_with_all_holders_goes_beyond_the_earliest_one(spark):
    x, y = "the first line of a block of two", "the second line of a block of two"
    rows = [(1, f"{y}\nbetween\n{x}"), (2, f"{x}\n{y}\nshort"), (3, f"own words\n{x}\n{y}\nshort")]
    rng = random.Random(3)
    pool = [f"a shared line with number {i} in it" for i in range(12)] + ["x", "", "brief"]
    rows += [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 6)) + [f"a line of document {i} and no other"] * (i % 2))) for i in range(4, 70)]
    rows += [(i + 100, text) for i, text in rows[::5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["kept_text"] for r in linededup.dedup(docs).collect()}
    assert got == plain_aligned_with_all(rows)
    assert got[3] == "own words"


def run_keys(sizes, lines, cut=None):
    import pyarrow as pa

    columns = [pa.array([7]), pa.array([sizes], pa.list_(pa.int64())), pa.array([lines], pa.list_(pa.int64()))]
    columns += [] if cut is None else [pa.array([cut], pa.list_(pa.int32()))]
    batch = pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])
    return {x for out in linededup._windows(20, cut is not None)([batch]) for x in out.column(1).to_pylist()}


@pytest.mark.parametrize("cut", [None, [], [0], [1, 2], [3, 4]])
def test_runs_of_lines_hold_enough_characters(cut):
    rng, odd = random.Random(5), 0x9E3779B97F4A7C15
    for sizes in ([30, 18], [30, 0, 0], [9, 9, 9, 30, 4, 0, 12, 25], [3, 4], [20], rng.choices(range(25), k=30)):
        lines = [rng.randrange(-(1 << 63), 1 << 63) for _ in sizes]
        places, n = set(), len(sizes)
        for i in range(n):
            places |= {(i, k) for k in range(i, n + 1) if sum(sizes[i:k]) >= 20 > sum(sizes[i : k - 1])}
            places |= {(h, i + 1) for h in range(i + 1) if sum(sizes[h : i + 1]) >= 20 > sum(sizes[h + 1 : i + 1])}
        gone = set(x for x in cut or () if x < n)
        places = {(i, k) for i, k in places if set(range(i, k)) - gone}
        sums = {sum(lines[i + j] * odd**j for j in range(k - i)) % (1 << 64) for i, k in places}
        assert run_keys(sizes, lines, cut and sorted(gone)) == {x - (x >> 63 << 64) for x in sums}


def last_round(spark, rows, monkeypatch):
    """Pairs of the last round, and what is kept."""
    pairs, cut = [], linededup.Scratch.cut
    monkeypatch.setattr(linededup.Scratch, "cut", lambda s, df, name, **o: (x := cut(s, df, name, **o), name.startswith("further") and pairs.append(x.count()))[0])
    got = {r["doc_id"]: r["kept_text"] for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return pairs[-1], got


def test_line_dedup_pairs_by_no_short_line_alone(spark, monkeypatch):
    rows = [(i, f"the first line of document {i} and no other\nshort") for i in range(60)]
    pairs, got = last_round(spark, rows, monkeypatch)
    assert pairs == 0 and got == dict(rows)


def test_line_dedup_holders_look_alike_whatever_no_later_document_holds(spark, monkeypatch):
    line = "a line that all of these documents hold twice, or once"
    rows = [(i, f"its own line {i} comes first\n{line}\nand another one {i}" + f"\n{line}\nand a last one {i}" * (i >= 30)) for i in range(60)]
    rows += [(i + 100, rows[i][1]) for i in (40, 50)]
    pairs, got = last_round(spark, rows, monkeypatch)
    assert pairs <= 3 * 32 and got == plain_aligned_with_all(rows)


def test_line_dedup_holders_look_alike_by_lines_of_each_later_document(spark, monkeypatch):
    lines = [f"the common line with number {i} of several" for i in range(12)]
    rows = [(f"{x}\nthe body {k} between {i} and {j}\n{y}") for k in range(4) for i, x in enumerate(lines) for j, y in enumerate(lines) if i != j]
    rows += [f"{x}\nits own body {i} that is long enough\n{x}\nthe last line {i} of it" for i, x in enumerate(lines)]
    rows = list(enumerate(rows))
    pairs, got = last_round(spark, rows, monkeypatch)
    assert pairs <= 2 * 12 and got == plain_aligned_with_all(rows)


@pytest.mark.parametrize("partners", [0, 1, 2])
def test_line_dedup_pairs_stand_for_all_whatever_lines_are_rare(spark, monkeypatch, partners):
    monkeypatch.setattr(linededup, "ROUNDS", 1)
    monkeypatch.setattr(linededup, "PARTNERS", partners)
    rng, rows = random.Random(partners), []
    pool = [f"a common line with number {i} in it" for i in range(5)] + ["x", "brief"]
    for i in range(150):
        text = rng.choices(pool, k=rng.randint(2, 7))
        text[rng.randrange(len(text))] = f"a rare line with number {rng.randrange(40)} in it"
        rows.append((i, "\n".join(text + [f"a line of document {i} and no other"] * (i % 2))))
    pairs, got = last_round(spark, rows, monkeypatch)
    assert pairs and got == plain_aligned_with_all(rows)


def test_blocks_of_a_benchmark_take_memory_in_proportion():
    import tracemalloc

    import numpy as np

    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice((1, 2, 7, 10, 90))))) for i in range(150)]
    tracemalloc.start()
    block = decontaminate.Block(rows, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000_000
    for k in (1, 2, 3):
        of = [decontaminate.gram(block.hashes[s : s + n], k) for s, n in zip(block.start, block.length) if min(n, 3) == k]
        assert np.array_equal(block.shingles[k], np.unique(np.concatenate(of)))
