"""Text and geometry functions against plain models."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quirework.functions import geometry as g
from quirework.functions import text as t

SAMPLES = [
    "AB-40 °C and PM2.5 at 12.5 kW, three Units",
    "no tokens here",
    "Größe1 1 é1 XY12/3-4 5%5 7 mm",
    "zero ZERO Twelve 40 °F40",
    "",
    "A1B2 -5 Pa +3.2 V 1,5 kg; B-52.",
    "{{name}} {v12} [todo] __TBD__ � \x07 ok",
    "see http://a.b/c?d=1 or mail x.y@z.org, then O'Neil-Type R2D2 a b",
]


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x")).alias("r")).collect()[0]["r"]


def values(spark, column, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", column(F.col("x")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


def plain_spans(text):
    out = []
    patterns = [r"(?<!\w)\d+(?:\.\d+)?\s*°[CF](?!\w)", r"\b(?:PM\d+(?:\.\d+)?|[A-Z]{2,}[A-Z0-9._/-]*\d[A-Z0-9._/-]*)\b", r"(?<!\w)\d+(?:\.\d+)?\s*(?:kW|W|V|Hz|Pa|mm|cm|kg|%)(?!\w)", r"(?<![A-Za-z0-9])\d+(?:\.\d+)?(?![A-Za-z0-9])"]
    for pattern in [*patterns, r"(?i)\b(?:" + "|".join(t.NUMBER_WORDS) + r")\b"]:
        for m in re.finditer(pattern, text):
            if not any(m.start() < b and m.end() > a for a, b, _ in out):
                out.append((m.start(), m.end(), m[0]))
    return sorted(out)


def test_protected_spans_follow_priorities(spark):
    for text, got in zip(SAMPLES, values(spark, t.protected_spans, SAMPLES)):
        assert sorted((s["begin"], s["stop"], s["token"]) for s in got) == plain_spans(text)


def test_occurrences_of_random_texts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("a1 .é😀B") for _ in range(rng.randint(0, 30))) for _ in range(100)]
    for text, got in zip(texts, values(spark, lambda c: t.occurrences(c, "[a-z]+1?|é"), texts)):
        assert [(s["begin"], s["stop"], s["token"]) for s in got] == [(m.start(), m.end(), m[0]) for m in re.finditer("[a-z]+1?|é", text)]


def test_tokens_and_findings(spark):
    assert values(spark, t.critical_tokens, SAMPLES)[5] == ["A1B2", "B-52", "-5Pa", "+3.2V", "1,5kg"]
    assert values(spark, t.english_tokens, SAMPLES)[7] == ["see", "or", "mail", "then", "O'Neil-Type", "R2D2"]
    assert value(spark, t.placeholder_findings, SAMPLES[6]) == sorted(["{{name}}", "{v12}", "[todo]", "__TBD__", "�", "CONTROL-U+0007"])
    assert values(spark, t.is_model_like, ["R2D2", "r2d2", "r2-d2", "ABCD", "1234", "A1"]) == [True, False, True, False, False, False]
    assert unicodedata.category("\x07") == "Cc"


@pytest.mark.parametrize(("document", "page", "key", "want"), [("My Doc!", 3, "A b", "my-doc.p0003.a-b"), ("--", 1, "k", None), ("é", 1, "k", None), ("a_b", 12, "X--Y-", "a_b.p0012.x--y")])
def test_stable_ids(spark, document, page, key, want):
    df = spark.createDataFrame([(document, page, key)], "d string, p int, k string")
    assert df.select(t.stable_id(F.col("d"), F.col("p"), F.col("k"))).collect()[0][0] == want


def test_small_text_functions(spark):
    assert values(spark, t.folded, ["Straße", "ẞ", "ABC"]) == ["strasse", "ss", "abc"]
    assert values(spark, t.squeezed, ["a\u00a0b \tc"]) == ["abc"]
    assert values(spark, t.version_numbers, ["1.2.3", "01.2.3", "1.2", "1.2.3-a"]) == [[1, 2, 3], None, None, None]
    assert values(spark, t.is_safe_path, ["a/b.c", "/a", "a/../b", "a\\b", "a//b", "c:/x", "", "./a"]) == [True] + [False] * 7
    assert values(spark, t.is_generic_note, ["Looks good!", "OK", "p003: every label was compared with its source"]) == [True, True, False]
    df = spark.createDataFrame([(1.5,), (-0.0,), (2.0,), (0.1234567,)], "x double")
    assert [r[0] for r in df.select(t.pdf_number(F.col("x"))).collect()] == ["1.5", "0", "2", "0.123457"]
    df = spark.createDataFrame([("aaaa", "aa"), ("abc", ""), ("xyx", "x")], "a string, b string")
    assert [r[0] for r in df.select(t.count_of(F.col("a"), F.col("b"))).collect()] == [2, 0, 2]


def test_geometry_against_a_plain_model(spark):
    rng = random.Random(9)
    box = lambda: (lambda a, b, c, d: (min(a, b), min(c, d), max(a, b), max(c, d)))(*[rng.randint(0, 20) / 2 for _ in range(4)])
    rows = [(i, box(), box()) for i in range(200)]
    df = spark.createDataFrame(rows, f"i int, a {g.BOX}, b {g.BOX}")
    got = df.select("i", g.shared_area(F.col("a"), F.col("b")).alias("s"), g.clearance(F.col("a"), F.col("b")).alias("c"), g.inside(F.col("a"), F.col("b"), 0.1).alias("in")).collect()
    for r in got:
        (ax, ay, bx, by), (cx, cy, dx, dy) = rows[r["i"]][1:]
        w, h = min(bx, dx) - max(ax, cx), min(by, dy) - max(ay, cy)
        assert r["s"] == max(0, w) * max(0, h)
        assert r["c"] == pytest.approx((max(0, -w) ** 2 + max(0, -h) ** 2) ** 0.5)
        assert r["in"] == (ax >= cx - 0.1 and ay >= cy - 0.1 and bx <= dx + 0.1 and by <= dy + 0.1)


def test_colours_go_both_ways(spark):
    df = spark.createDataFrame([(0x123456,), (0xFFFFFF,), (0,)], "c int")
    back = df.select("c", g.srgb(*[g.rgb(F.col("c"))[i] for i in range(3)]).alias("d")).collect()
    assert all(r["c"] == r["d"] for r in back)
    m = spark.createDataFrame([([1.0, 0.0, 0.0, 1.0, 5.0, 6.0], [2.0, 0.0, 0.0, 2.0, 1.0, 1.0])], "m array<double>, n array<double>")
    assert m.select(g.product(F.col("m"), F.col("n"))).collect()[0][0] == [2, 0, 0, 2, 11, 13]
