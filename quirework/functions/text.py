"""Text functions as Column expressions: ids, token grammars, residue, hygiene.  No Python runs per row.

Java's classes are ASCII unless (?U) asks for Unicode, which the grammars below do; code points are counted, not bytes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grammars, word lists and limits that results depend on.
TEMPERATURE = r"(?U)(?<!\w)\d+(?:\.\d+)?\s*°[CF](?!\w)"
MODEL_OR_CODE = r"(?U)\b(?:PM\d+(?:\.\d+)?|[A-Z]{2,}[A-Z0-9._/-]*\d[A-Z0-9._/-]*)\b"
MEASUREMENT = r"(?U)(?<!\w)\d+(?:\.\d+)?\s*(?:kW|W|V|Hz|Pa|mm|cm|kg|%)(?!\w)"
NUMBER = r"(?U)(?<![A-Za-z0-9])\d+(?:\.\d+)?(?![A-Za-z0-9])"
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")
LINK_OR_MAIL = r"(?iU)(?:https?://|www\.)\S+|[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ENGLISH = r"[A-Za-z][A-Za-z0-9'./:+_-]*"
ENGLISH_REBUILT = r"[A-Za-z][A-Za-z0-9._/-]+"
MODEL = r"(?U)\b(?=[A-Z0-9._/-]{4,}\b)(?=[A-Z0-9._/-]*[A-Z])(?=[A-Z0-9._/-]*\d)[A-Z0-9][A-Z0-9._/-]{2,}\b"
VALUE_UNIT = r"(?U)(?<![\w.])[+-]?\d+(?:[.,]\d+)?\s*(?:°[CF]|%|V|A|W|kW|kWh|Hz|mm|cm|m|kg|g|Pa|kPa|MPa|psi|BTU(?:/h)?|RPM|rpm|dB|L|mL)(?![A-Za-z0-9_])"
PLACEHOLDERS = (r"\{\{[^{}]{0,200}\}\}", r"(?iU)\{v\d+\}", r"(?i)\[(?:TRANSLATE|TRANSLATION|TODO|TBD)\]", r"(?i)__(?:TRANSLATE|TRANSLATION|TODO|TBD)__", "�")
GENERIC_NOTES = ("ok", "pass", "passed", "looks good", "no issue", "no issues", "checked", "reviewed", "已檢查", "已確認", "通過", "無異常", "沒有問題", "版面正常")
PRIVATE_PATH = r"(?i)(?:[A-Z]:[\\/]Users[\\/]|/(?:home|Users)/[^/]+/)"
SECRET = r"(?i)(?:api[_-]?key|access[_-]?token|client[_-]?secret|password)\s*[:=]\s*[\"'][^\"']{8,}[\"']"
MARKDOWN_LINK = r"\[[^\]]+\]\((?!https?://|mailto:|#)([^)]+)\)"
FORBIDDEN_SUFFIXES = (".pdf", ".docx", ".xlsx", ".pptx", ".zip", ".pkl", ".pickle", ".gguf", ".safetensors", ".pyc")
FORBIDDEN_DIRECTORIES = ("__pycache__", ".pytest_cache", "artifacts", "outputs", "reports")
STRIPPED = "'./:+_-"
MOST_OF_A_FINDING = 120


def slug(text: Column) -> Column:
    """Lower case; runs of anything but a-z, 0-9, _ and - become one dash; dashes at the ends go."""
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9_-]+", "-"), F.lit("-"))


def stable_id(document: Column, page: Column, key: Column) -> Column:
    """``doc.p0007.key``; null where a part has nothing left."""
    d, k = slug(document), slug(key)
    return F.when((d != "") & (k != ""), F.concat(d, F.lit(".p"), F.lpad(page.cast("string"), 4, "0"), F.lit("."), k))


def occurrences(text: Column, pattern: str) -> Column:
    """array<struct<begin,stop,token>> of all matches, by code point.

    What stands between matches has known lengths, so positions are running sums; patterns never match empty.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,stop:int,token:string>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        stop = begin + F.length(x["token"])
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(F.struct(begin.alias("begin"), stop.alias("stop"), x["token"].alias("token")))).alias("out"))

    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda t, g: F.struct(g.alias("gap"), t.alias("token")))
    return F.when(F.size(found) == 0, F.array().cast("array<struct<begin:int,stop:int,token:string>>")).otherwise(F.aggregate(pairs, start, step, lambda s: s["out"]))


def overlaps(spans: Column, x: Column) -> Column:
    return F.exists(spans, lambda y: (x["begin"] < y["stop"]) & (x["stop"] > y["begin"]))


KINDS = (("temperature", TEMPERATURE), ("model_or_code", MODEL_OR_CODE), ("measurement", MEASUREMENT), ("number", NUMBER), ("number_word", r"(?iU)\b(?:" + "|".join(NUMBER_WORDS) + r")\b"))
_TYPED = "array<struct<begin:int,stop:int,token:string,kind:string>>"


def protected_spans(text: Column) -> Column:
    """Matches of the grammars by priority; one that overlaps a span taken earlier is dropped, not searched again."""

    def typed(kind: str):
        return lambda x: F.struct(x["begin"].alias("begin"), x["stop"].alias("stop"), x["token"].alias("token"), F.lit(kind).alias("kind"))

    def free_of(taken: Column):
        return lambda x: ~overlaps(taken, x)

    taken = F.array().cast(_TYPED)
    for kind, pattern in KINDS:
        new = F.transform(occurrences(text, pattern), typed(kind))
        taken = F.concat(taken, F.filter(new, free_of(taken)))
    return taken


def number_word_target(token: Column) -> Column:
    place = F.array_position(F.array(*[F.lit(w) for w in NUMBER_WORDS]), F.lower(token))
    return F.when(place > 0, (place - 1).cast("string"))


def english_tokens(text: Column) -> Column:
    """Latin-script tokens outside links and mail addresses, trimmed of punctuation, of two characters or more."""
    tokens = F.regexp_extract_all(F.regexp_replace(text, LINK_OR_MAIL, " "), F.lit(ENGLISH), F.lit(0))
    return F.filter(F.transform(tokens, lambda t: F.btrim(t, F.lit(STRIPPED))), lambda t: F.length(t) > 1)


def is_model_like(token: Column) -> Column:
    """Four characters or more with a digit and a letter, all capitals or with one of _ / -."""
    return (F.length(token) >= 4) & token.rlike(r"\p{Nd}") & token.rlike(r"\p{L}") & ((F.upper(token) == token) | token.rlike("[_/-]"))


def critical_tokens(text: Column) -> Column:
    """Model codes and signed values with units, white space removed; a token of both grammars counts twice."""
    both = F.concat(F.regexp_extract_all(text, F.lit(MODEL), F.lit(0)), F.regexp_extract_all(text, F.lit(VALUE_UNIT), F.lit(0)))
    return F.transform(both, squeezed)


def squeezed(text: Column) -> Column:
    """Without white space, by Unicode."""
    return F.regexp_replace(text, r"(?U)\s+", "")


def placeholder_findings(text: Column) -> Column:
    """Sorted distinct placeholders (cut to 120 characters) and control characters other than LF, CR, TAB and FF."""
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in PLACEHOLDERS])
    controls = F.transform(F.regexp_extract_all(text, F.lit(r"[\p{Cc}&&[^\n\r\t\f]]"), F.lit(0)), lambda c: F.concat(F.lit("CONTROL-U+"), F.lpad(F.hex(_code_point(c)), 4, "0")))
    return F.array_sort(F.array_distinct(F.concat(F.transform(found, lambda t: F.substring(t, 1, MOST_OF_A_FINDING)), controls)))


def _code_point(c: Column) -> Column:
    """Of a control character: its UTF-8 is one byte, or C2 and one byte."""
    raw = F.hex(F.encode(c, "UTF-8"))
    return F.conv(F.substring(raw, -2, 2), 16, 10).cast("long")


def folded(text: Column) -> Column:
    """Case folding for Latin text: lower case, and sharp s as ss."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def count_of(text: Column, token: Column) -> Column:
    """Occurrences that don't overlap; 0 for an empty token."""
    return F.when(F.length(token) == 0, F.lit(0)).otherwise(((F.length(text) - F.length(F.replace(text, token, F.lit("")))) / F.length(token)).cast("int"))


def normal_note(note: Column) -> Column:
    """Letters and digits alone, folded."""
    return folded(F.regexp_replace(note, r"(?U)[\W_]+", ""))


def is_generic_note(note: Column) -> Column:
    known = [n.replace(" ", "") for n in GENERIC_NOTES]
    return (F.length(F.trim(note)) < 20) | normal_note(note).isin(known)


def version_numbers(version: Column) -> Column:
    """SemVer triple as array<int>, null where it isn't one; arrays compare as versions do."""
    return F.when(version.rlike(r"^(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)$"), F.transform(F.split(version, r"\."), lambda x: x.cast("int")))


def loose_version(version: Column) -> Column:
    """All whole numbers before a plus sign."""
    return F.transform(F.regexp_extract_all(F.regexp_replace(version, r"(?s)\+.*$", ""), F.lit("[0-9]+"), F.lit(0)), lambda x: F.try_to_number(x, F.lit("999999999999999999")).cast("long"))


def is_safe_path(path: Column) -> Column:
    """Relative, forward slashes, no empty, dot or dot-dot part, no drive."""
    parts = F.split(path, "/")
    return (path != "") & ~path.startswith("/") & ~path.contains("\\") & ~path.contains(":") & ~F.exists(parts, lambda p: p.isin("", ".", ".."))


def package_name(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "[-_.]+", "-"))


def has_cjk(text: Column) -> Column:
    return text.rlike("[㐀-鿿]")


def pdf_number(x: Column) -> Column:
    """Six decimals without trailing zeros; minus zero is 0."""
    out = F.regexp_replace(F.regexp_replace(F.format_string("%.6f", x), r"0+$", ""), r"\.$", "")
    return F.when(out == "-0", F.lit("0")).otherwise(out)


def page_reference(page: Column) -> Column:
    return F.format_string("p%03d", page)


def forbidden_count(text: Column, token: Column) -> Column:
    """Occurrences whatever the case."""
    return count_of(F.lower(text), F.lower(token))


def required_count(text: Column, token: Column) -> Column:
    """Occurrences whatever the white space."""
    return count_of(squeezed(text), squeezed(token))


def hygiene_findings(path: Column, text: Column) -> Column:
    """Codes for what must not be in a public file."""
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    checks = [
        (suffix.isin(*FORBIDDEN_SUFFIXES), "FORBIDDEN_FILE_TYPE"),
        (F.exists(F.split(path, "/"), lambda p: p.isin(*FORBIDDEN_DIRECTORIES)), "FORBIDDEN_DIRECTORY"),
        (text.rlike(PRIVATE_PATH), "PRIVATE_ABSOLUTE_PATH"),
        (text.rlike(SECRET), "POSSIBLE_SECRET"),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(code)) for c, code in checks]), lambda x: x.isNotNull())


def local_links(text: Column) -> Column:
    """Targets of relative markdown links, without their fragments."""
    return F.transform(F.regexp_extract_all(text, F.lit(MARKDOWN_LINK), F.lit(1)), lambda t: F.regexp_replace(t, "#.*$", ""))
