"""Joins, matchings, folds, paths and streams against brute force and hand-made cases."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from quirework.functions import geometry as g
from quirework.operators import aggregates, drawings, graph, joins, matching, ordered
from quirework.plans import planner
from quirework.sources import content_stream, readers, sinks
from quirework.sources.scratch import Scratch


def random_boxes(seed, n, pages=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rng.randint(-20, 60) / 2, rng.randint(-20, 60) / 2
        out.append((rng.randrange(pages), i, (x, y, x + rng.randint(0, 40) / 2, y + rng.randint(0, 30) / 2)))
    return out


@pytest.mark.parametrize("cell", [3.0, 16.0, 1000.0])
def test_grid_join_equals_all_pairs(spark, cell):
    a, b = random_boxes(1, 60), random_boxes(2, 60)
    schema = f"page int, {{0}} int, {{1}} {g.BOX}"
    left, right = spark.createDataFrame(a, schema.format("l", "bl")), spark.createDataFrame(b, schema.format("r", "br"))
    got = joins.grid_join(left, right, ["page"], "bl", "br", cell, lambda x, y: g.shared_area(x, y) > 0.01).select("l", "r").collect()
    shared = lambda p, q: max(0, min(p[2], q[2]) - max(p[0], q[0])) * max(0, min(p[3], q[3]) - max(p[1], q[1]))
    want = [(i, j) for (p, i, x), (q, j, y) in itertools.product(a, b) if p == q and shared(x, y) > 0.01]
    assert sorted((r["l"], r["r"]) for r in got) == sorted(want)


def test_tolerance_join_equals_all_pairs(spark):
    rng = random.Random(3)
    a, b = [[(i, rng.randint(-50, 50) / 8) for i in range(80)] for _ in range(2)]
    left, right = spark.createDataFrame(a, "l int, x double").withColumn("k", F.lit(1)), spark.createDataFrame(b, "r int, y double").withColumn("k", F.lit(1))
    got = joins.tolerance_join(left, right, ["k"], ["x"], ["y"], 0.25).select("l", "r").collect()
    assert sorted(map(tuple, got)) == sorted((i, j) for (i, x), (j, y) in itertools.product(a, b) if abs(x - y) <= 0.25)


def test_maximum_matching_against_all_assignments():
    rng = random.Random(7)
    for _ in range(60):
        edges = {i: sorted({rng.randrange(5) for _ in range(rng.randint(0, 3))}) for i in range(5)}
        got = matching.augmented(edges, list(edges))
        best = max(sum(1 for i, j in zip(range(5), p) if j in edges[i]) for p in itertools.permutations(range(5)))
        assert len(got) == best and len(set(got.values())) == best and all(j in edges[i] for i, j in got.items())


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1040)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    got = graph.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "x").collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in top}


def test_packing_and_waves_against_a_loop(spark):
    rng = random.Random(11)
    groups = [(d, i, rng.randint(1, 6), rng.randint(1, 60), rng.random() < 0.3) for d in range(5) for i in range(30)]
    got = planner.plan(spark.createDataFrame(groups, "doc int, component long, pages int, segments int, high boolean")).collect()
    want = {}
    for d in range(5):
        batches, pages, segments = [], 0, 0
        for _, i, p, s, h in (x for x in groups if x[0] == d):
            if not batches or pages + p > planner.MOST_PAGES or segments + s > planner.TARGET_SEGMENTS:
                batches.append([])
                pages = segments = 0
            batches[-1].append((i, h))
            pages, segments = pages + p, segments + s
        waves = []
        for b, batch in enumerate(batches, 1):
            high = any(h for _, h in batch)
            at = next((k for k, w in enumerate(waves) if w[0] < planner.MOST_PARALLEL and not (w[1] and high)), len(waves))
            if at == len(waves):
                waves.append([0, False])
            waves[at] = [waves[at][0] + 1, waves[at][1] or high]
            want |= {(d, i): (b, at + 1) for i, _ in batch}
    assert {(r["doc"], r["component"]): (r["batch"], r["wave"]) for r in got} == want


def test_page_groups_by_shared_relations(spark):
    pages = spark.createDataFrame([(1, p) for p in range(1, 7)], "doc int, page int")
    segments = spark.createDataFrame([(1, f"s{p}", p) for p in range(1, 7)], "doc int, segment_id string, page int")
    relations = spark.createDataFrame([(1, "s2", "t"), (1, "s4", "t"), (1, "s5", "s6")], "doc int, segment_id string, token string")
    context = spark.createDataFrame([(1, 1, 2)], "doc int, on_page int, page int")
    edges = planner.page_edges(context, relations, segments, spark.createDataFrame([], "doc int, group string, page int"))
    got = {r["page"]: (r["component"], r["reasons"]) for r in planner.dependency_groups(pages, edges).collect()}
    assert {p: c for p, (c, _) in got.items()} == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 5}
    assert got[4][1] == ["context", "shared"] and got[6][1] == ["segment"] and got[3][1] == []


def test_fit_and_wrap(spark):
    df = spark.createDataFrame([([4.0, 4.0, 4.0], 10.0, 30.0, 10.0), ([30.0], 10.0, 30.0, 10.0)], "w array<double>, bw double, bh double, s double")
    lines = df.select(ordered.wrapped(F.col("w"), F.col("bw"))).collect()
    assert [r[0] for r in lines] == [[1, 1, 2], [1]]
    wide = spark.createDataFrame([([1.0] * 4, 20.0, 24.0, 10.0), ([9.0], 10.0, 30.0, 10.0)], "w array<double>, bw double, bh double, s double")
    assert [r[0] for r in wide.select(ordered.fitted_size(F.col("w"), F.col("bw"), F.col("bh"), F.col("s"))).collect()] == [10.0, None]



def test_content_paths(spark):
    good = b"q 2 0 0 2 1 1 cm % note\n0.5 w [3 1] 0 d 0 0 m 10 0 l 10 5 10 10 y h S Q 1 0 0 RG 5 5 20 10 re W n BT (x\\)y) Tj ET 1 1 3 3 re f*"
    rows = [("a", 1, 7, good), ("b", 1, 7, b"0 0 m 1 w 2 2 l S"), ("c", 1, 7, b"Q"), ("d", 1, 7, b"0 m S"), ("e", 1, 7, b"0 0 m 1 1 l"), ("f", 1, 7, b"(open"), ("g", 1, 7, b"q"), ("h", 1, 7, b"W n S"), ("i", 1, 7, None), ("j", 1, 7, b"1 q Q"), ("k", 1, 7, b"q 1 Q"), ("l", 1, 7, b"0 0 m 1 1 l W W n")]
    got = content_stream.content_paths(spark.createDataFrame(rows, "doc_id string, page int, xref int, content binary")).collect()
    a = [r for r in got if r["doc_id"] == "a"]
    assert [(r["path_index"], r["paint"], r["clip"], [o["op"] for o in r["ops"]]) for r in a] == [(0, "S", None, ["m", "l", "y", "h"]), (1, "n", "W", ["re"]), (2, "f*", None, ["re"])]
    assert a[0]["ctm"] == [2, 0, 0, 2, 1, 1] and a[1]["ctm"] == [1, 0, 0, 1, 0, 0] and json.loads(a[0]["style"])["w"] == [0.5]
    codes = {r["doc_id"]: r["code"] for r in got if r["doc_id"] != "a"}
    assert codes == {"b": "CONTENT_PATH_INTERWOVEN_OPERATOR", "c": "GRAPHICS_STATE_STACK_MALFORMED", "d": "CONTENT_PATH_OPERATOR_MALFORMED", "e": "CONTENT_PATH_UNTERMINATED", "f": "CONTENT_STREAM_PARSE_FAILED", "g": "GRAPHICS_STATE_STACK_MALFORMED", "j": "GRAPHICS_STATE_OPERATOR_MALFORMED", "k": "GRAPHICS_STATE_STACK_MALFORMED", "l": "CONTENT_PATH_CLIP_MALFORMED"}
    paths = content_stream.content_paths(spark.createDataFrame(rows[:1], "doc_id string, page int, xref int, content binary"))
    plan = drawings.removal_plan(paths, spark.createDataFrame([("a", 1, 7, 0), ("a", 1, 7, 1)], "doc_id string, page int, xref int, path_index int")).collect()
    assert {r["path_index"]: (r["code"], r["step"]) for r in plan} == {0: (None, 2), 1: ("CONTENT_PATH_CLIP_REPLACEMENT_FORBIDDEN", 1)}


def drawing(idx, dx=0.0, op="l", doc="d"):
    return (doc, 1, idx, (dx, 0.0, dx + 10.0, 1.0), "s", None, [0.0, 0.0, 0.0], 1.0, 0.0, 1.0, 1.0, "[] 0", None, False, False, [(op, [dx, 0.0, dx + 10.0, 0.0])])


def test_missing_drawings(spark):
    source = [drawing(0), drawing(1), drawing(2, 50.0), drawing(3, 90.0)]
    candidate = [drawing(0), drawing(1, 0.0005), drawing(2, 50.0009), drawing(3, 90.1)]
    s, c = spark.createDataFrame(source, drawings.SCHEMA), spark.createDataFrame(candidate, drawings.SCHEMA)
    assert [(r["page"], r["idx"]) for r in drawings.missing(s, c).collect()] == [(1, 3)]
    assert drawings.issues(spark.createDataFrame([drawing(0, op="z"), drawing(1)], drawings.SCHEMA)).select("idx", "code").collect() == [(0, "DRAWING_OPERATOR_UNKNOWN")]
    moved = drawings.translated(s, 1.0, 2.0).where("idx = 0").collect()[0]
    assert moved["ops"][0]["coords"] == [1, 2, 11, 2] and moved["rect"]["y1"] == 3


def test_readers_and_create_only_sinks(spark, tmp_path):
    ranges = spark.createDataFrame([("1,3-5", 9), ("3-1", 9), ("2, 2", 9), ("10", 9), ("x", 9)], "e string, n int")
    assert [r[0] for r in ranges.select(readers.page_ranges(F.col("e"), F.col("n"))).collect()] == [[1, 3, 4, 5], None, [2], None, None]
    (tmp_path / "g.csv").write_text("id,source,target,notes\n1,a,b,\n")
    (tmp_path / "bad.csv").write_text("id,src,target,notes\n1,a,b,\n")
    assert readers.glossary(spark, str(tmp_path / "g.csv"), 2).collect()[0]["layer"] == 2
    with pytest.raises(Exception):
        readers.glossary(spark, str(tmp_path / "bad.csv"), 2).collect()
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{"a": 1}')
    (tmp_path / "j/b.json").write_text('{"a": ')
    rows, issues = readers.json_objects(spark, str(tmp_path / "j"), "a int")
    assert [r["a"] for r in rows.collect()] == [1] and issues.count() == 1
    (tmp_path / "allow.txt").write_text("# c\nUSB\nre:^A.*\n\n")
    assert sorted(map(tuple, readers.legacy_allowlist(spark, str(tmp_path / "allow.txt")).collect())) == [("exact", "USB"), ("regex", "^A.*")]
    sinks.write_new(rows, str(tmp_path / "out"))
    with pytest.raises(Exception):
        sinks.write_new(rows, str(tmp_path / "out"))


def test_status_lattice(spark):
    df = spark.createDataFrame([(1, "PASS"), (1, "BLOCKED"), (2, "NEEDS_REVIEW"), (3, None)], "k int, s string")
    assert {r["k"]: r["w"] for r in df.groupBy("k").agg(aggregates.worst(F.col("s")).alias("w")).collect()} == {1: "BLOCKED", 2: "NEEDS_REVIEW", 3: "PASS"}


def test_streams(spark, tmp_path):
    from quirework.streaming import ledger

    folder = tmp_path / "in"
    folder.mkdir()
    rows = [{"plan_digest": "p", "batch_id": b, "status": "ok", "elapsed": 1.0, "completed_at": "2024-01-01T00:00:00Z"} for b in ("x", "x", "y")]
    (folder / "a.json").write_text("\n".join(map(json.dumps, rows)))
    ledger.run_once(ledger.first_results(ledger.results(spark, str(folder))), "firsts", str(tmp_path / "c1"))
    assert sorted(r["batch_id"] for r in spark.table("firsts").collect()) == ["x", "y"]
    timing = tmp_path / "timing"
    timing.mkdir()
    (timing / "a.json").write_text("\n".join(json.dumps({"attempt_id": str(i), "stage": "s", "started_at": "2024-01-01T00:00:00Z", "completed_at": f"2024-01-01T00:0{i}:00Z", "status": "ok"}) for i in range(1, 4)))
    stream = spark.readStream.schema(ledger.TIMING).json(str(timing))
    ledger.run_once(ledger.stage_totals(stream), "totals", str(tmp_path / "c2"), "complete")
    assert [(r["seconds"], r["attempts"]) for r in spark.table("totals").collect()] == [(360.0, 3)]
