"""Integrity rules as data: every rule of a table is one boolean expression, and all run in a single scan.

A rule holds a code, a severity and a Column that is true where the row violates it; null counts as no violation.
``check`` evaluates all of them in one projection and explodes the codes that apply, so a table with a hundred
rules is read once and the plan has no unions.  Rules that need another table are joins and give issue rows
themselves (see ``operators.joins``).  A rule with ``needs`` applies only where the rules so named do not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import geometry as g
from quirework.functions import text as t
from quirework.operators.aggregates import worst


@dataclass(frozen=True)
class Rule:
    code: str
    violated: Column
    severity: str = "BLOCKED"
    needs: tuple[str, ...] = ()


def check(rows: DataFrame, rules: list[Rule], keys: list[str]) -> DataFrame:
    """(keys, severity, code): one row for each rule that a row violates."""
    by = {r.code: F.coalesce(r.violated, F.lit(False)) for r in rules}
    found = []
    for r in rules:
        applies = by[r.code]
        for other in r.needs:
            applies &= ~by[other]
        found.append(F.when(applies, F.struct(F.lit(r.severity).alias("severity"), F.lit(r.code).alias("code"))))
    issues = F.filter(F.array(*found), lambda x: x.isNotNull())
    return rows.select(*keys, F.explode(issues).alias("i")).select(*keys, "i.severity", "i.code")


def verdict(rows: DataFrame, issues: DataFrame, keys: list[str]) -> DataFrame:
    """PASS, NEEDS_REVIEW or BLOCKED for each row: the worst of its issues."""
    return rows.select(*keys).distinct().join(issues.groupBy(*keys).agg(worst(F.col("severity")).alias("status")), keys, "left").select(*keys, F.coalesce("status", F.lit("PASS")).alias("status"))


# The closed sets of the manifest.
SEMANTIC_TYPES = ("heading", "paragraph", "list", "table-cell", "UI", "image-text", "caption", "warning", "footer", "protected")
STATUSES = ("EXTRACTED", "TRANSLATED", "VALIDATED", "RENDERED")
PRESERVE_ACTIONS = ("preserve", "preserve_source_visual_with_textual_guidance")
RENDER_ACTIONS = ("replace", "replace_vector_outlined_text", *PRESERVE_ACTIONS)
MASK_MODES = ("fill", "remove_text_only")
VISUAL_KINDS = ("raster_image", "vector_component")
CUE_KINDS = ("parameter", "role", "mode", "condition", "comparison", "consequence", "general")
CUE_SCOPES = ("segment", "binding_phrase")
CLARIFICATIONS = ("none", "source_derived_inline", "source_derived_note")
COMPONENT_ROLES = ("live_text", "translatable_live_text", "translatable_vector_outlined_text", "dingbat_marker", "symbol", "vector_rule", "frame", "background", "icon", "neighbor_container", "vector_outlined_text", "raster_image")
COMPONENT_POLICIES = ("replace_live_text", "replace_vector_outlined_text", "preserve", "preserve_complete_visual", "adjust_background", "adjust_vector_rule")
MAPPING_OPERATIONS = ("one_to_one", "split", "merge")
STAGES = ("extraction", "translation", "render")


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def is_sha256(c: Column) -> Column:
    return c.rlike("^[0-9A-Fa-f]{64}$")


def segment_rules(stage: str) -> list[Rule]:
    """Rules of one segment row; later stages add theirs.  A row without its fields isn't judged further."""
    c, fields = F.col, ("SEGMENT_FIELDS",)
    keep = c("action").isin(*PRESERVE_ACTIONS)
    page, box, target = c("page_bbox"), c("bbox"), c("target_bbox")
    rules = [
        Rule("SEGMENT_FIELDS", blank(c("segment_id")) | c("page").isNull() | c("semantic_type").isNull() | c("bbox").isNull() | c("status").isNull() | c("action").isNull()),
        Rule("SEMANTIC_TYPE", ~c("semantic_type").isin(*SEMANTIC_TYPES), needs=fields),
        Rule("STATUS", ~c("status").isin(*STATUSES), needs=fields),
        Rule("RENDER_ACTION", ~c("action").isin(*RENDER_ACTIONS), needs=fields),
        Rule("BBOX", (box["x1"] <= box["x0"]) | (box["y1"] <= box["y0"]), needs=fields),
        Rule("BBOX_PAGE", ~g.inside(box, page, 0.1), needs=(*fields, "BBOX")),
        Rule("TARGET_BBOX_PAGE", target.isNotNull() & ~g.inside(target, page, 0.1), needs=fields),
        Rule("SOURCE_TEXT_EMPTY", ~keep & blank(c("source_text")), needs=fields),
        Rule("PRESERVED_VISUAL_TYPE", (c("action") == PRESERVE_ACTIONS[1]) & ~c("semantic_type").isin("image-text", "UI"), needs=fields),
        Rule("PRESERVED_VISUAL_MASK_FORBIDDEN", (c("action") == PRESERVE_ACTIONS[1]) & c("mask_bbox").isNotNull(), needs=fields),
        Rule("VECTOR_TEXT_MASK_FORBIDDEN", (c("action") == "replace_vector_outlined_text") & c("mask_bbox").isNotNull(), needs=fields),
    ]
    if stage in ("translation", "render"):
        rules += [
            Rule("TRANSLATION_EMPTY", ~keep & blank(c("target_text")), needs=fields),
            Rule("TRANSLATION_STATUS", c("status") == "EXTRACTED", needs=fields),
            Rule("PROTECTED_TOKEN_LOST", F.exists("protected_tokens", lambda p: t.count_of(F.coalesce("target_text", F.lit("")), F.coalesce(p["target_token"], p["token"])) < p["source_count"]), needs=(*fields, "TRANSLATION_EMPTY")),
        ]
    if stage == "render":
        rules += [
            Rule("FONT_SIZE", ~keep & (c("font_size").isNull() | (c("font_size") <= 0)), needs=fields),
            Rule("FONT_RATIO", ~keep & (c("font_size") + 1e-6 < g.font_floor(c("source_size"))), needs=(*fields, "FONT_SIZE")),
        ]
    return rules


def visual_rules() -> list[Rule]:
    c, raster = F.col, F.col("kind") == "raster_image"
    return [
        Rule("VISUAL_ID", blank(c("visual_id"))),
        Rule("VISUAL_KIND", ~c("kind").isin(*VISUAL_KINDS) | c("kind").isNull()),
        Rule("VISUAL_BBOX", c("bbox").isNull() | (g.area(c("bbox")) <= 0)),
        Rule("VISUAL_PIXEL_SIZE", raster & (c("pixel_width").isNull() | c("pixel_height").isNull() | (c("pixel_width") <= 0) | (c("pixel_height") <= 0))),
        Rule("VISUAL_SHA256", raster & ~F.coalesce(is_sha256(c("decoded_sha256")), F.lit(False))),
        Rule("VECTOR_VISUAL_COMPONENT_GROUP", (c("kind") == "vector_component") & blank(c("group_id"))),
    ]


def binding_rules() -> list[Rule]:
    c = F.col
    clarified = c("clarification_mode") != "none"
    return [
        Rule("SEMANTIC_BINDING_ID", blank(c("binding_id"))),
        Rule("SEMANTIC_BINDING_FIELDS", blank(c("parameter")) | blank(c("role")) | blank(c("mode")) | blank(c("condition")) | blank(c("comparison")) | blank(c("consequence"))),
        Rule("SEMANTIC_SOURCE_TOKENS", c("source_tokens").isNull() | (F.size("source_tokens") == 0)),
        Rule("SEMANTIC_SOURCE_TOKEN_MISSING", F.exists("source_tokens", lambda x: ~F.contains(c("source_text"), x))),
        Rule("SEMANTIC_SOURCE_TOKEN_NOT_PROTECTED", F.size(F.array_except("source_tokens", "protected")) > 0),
        Rule("CLARIFICATION_POLICY_INVALID", ~c("clarification_mode").isin(*CLARIFICATIONS) | c("clarification_mode").isNull()),
        Rule("SEMANTIC_TARGET_CUES", c("cues").isNull() | (F.size("cues") == 0)),
        Rule("SEMANTIC_TARGET_CUE", F.exists("cues", lambda x: blank(x["text"]) | ~x["kind"].isin(*CUE_KINDS) | ~x["scope"].isin(*CUE_SCOPES))),
        Rule("CLARIFICATION_TARGET_CUES", clarified & ~F.exists("cues", lambda x: x["scope"] == "segment")),
        Rule("CROSS_PAGE_CONTEXT_NOT_CHECKED", c("context_required") & (F.size(F.coalesce("context_ref_ids", F.array().cast("array<string>"))) == 0), "NEEDS_REVIEW"),
    ]


def assertion_rules() -> list[Rule]:
    """Rows of bindings joined to assertions in full; ``b`` and ``a`` are the two sides as structs.

    Each field that the translation must carry over has its own code.
    """
    b, a, phrase = F.col("b"), F.col("a"), F.col("a.target_phrase")
    both = b.isNotNull() & a.isNotNull()
    dropped = (("parameter", "VALUE_ROLE_SWAPPED"), ("mode", "MODE_CONTEXT_DROPPED"), ("condition", "CONDITION_SCOPE_DROPPED"), ("comparison", "COMPARISON_LOGIC_DROPPED"), ("consequence", "CONSEQUENCE_DROPPED"), ("clarification_mode", "CLARIFICATION_POLICY_DROPPED"))
    rules = [Rule("SEMANTIC_BINDING_MISSING", a.isNull()), Rule("SEMANTIC_ASSERTION_UNKNOWN_BINDING", b.isNull())]
    for name, code in dropped:
        differs = ~b[name].eqNullSafe(a[name])
        rules.append(Rule(code, both & (differs | ~b["role"].eqNullSafe(a["role"]) if name == "parameter" else differs)))
    cue_codes = {"mode": "MODE_CUE_DROPPED", "condition": "CONDITION_CUE_DROPPED", "comparison": "COMPARISON_CUE_DROPPED", "consequence": "CONSEQUENCE_CUE_DROPPED", "general": "SEMANTIC_TARGET_CUE_DROPPED"}

    def lacks(kind: str):
        return lambda x: (x["kind"] == kind) & ~F.contains(F.when(x["scope"] == "segment", F.col("target_text")).otherwise(phrase), x["text"])

    rules += [Rule(code, both & F.exists(b["cues"], lacks(kind))) for kind, code in cue_codes.items()]
    rules.append(Rule("SEMANTIC_TARGET_PHRASE_NOT_FOUND", both & ~F.contains(F.col("target_text"), phrase)))
    rules.append(Rule("FOREIGN_TOKEN_IN_PHRASE", both & F.exists("foreign_tokens", lambda x: F.contains(phrase, x))))
    return rules


def member_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("COMPONENT_ID", blank(c("component_id"))),
        Rule("COMPONENT_ROLE", ~c("role").isin(*COMPONENT_ROLES) | c("role").isNull()),
        Rule("COMPONENT_POLICY", ~c("policy").isin(*COMPONENT_POLICIES) | c("policy").isNull()),
        Rule("COMPONENT_SOURCE_GEOMETRY", c("bbox").isNull() | (g.area(c("bbox")) < 0) | ~g.finite(c("bbox.x0") + c("bbox.y0") + c("bbox.x1") + c("bbox.y1"))),
        Rule("LIVE_TEXT_COMPONENT_POLICY", c("role").isin("live_text", "translatable_live_text") & (c("policy") != "replace_live_text") & (c("translatability") == "translate")),
        Rule("VECTOR_TEXT_COMPONENT_POLICY", (c("role") == "translatable_vector_outlined_text") & (c("policy") != "replace_vector_outlined_text")),
        Rule("NON_TEXT_COMPONENT_REPLACEMENT", ~c("role").isin("live_text", "translatable_live_text", "translatable_vector_outlined_text", "vector_outlined_text") & c("policy").startswith("replace")),
        Rule("BACKGROUND_ADJUSTMENT_ROLE", (c("policy") == "adjust_background") & (c("role") != "background")),
        Rule("VECTOR_RULE_ADJUSTMENT_ROLE", (c("policy") == "adjust_vector_rule") & (c("role") != "vector_rule")),
        Rule("PRESERVE_TRANSLATABLE_COMPONENT", c("policy").startswith("preserve") & (c("translatability") == "translate")),
    ]


# Reasons that plead difficulty are no reasons.
ALLOWLIST_MIN_REASON = 12


def allowlist_rules(types: tuple[str, ...], bases: tuple[str, ...], difficulty: tuple[str, ...]) -> list[Rule]:
    """Rows of allowlist entries with the document scope's pages."""
    c = F.col
    bad = lambda a: F.col(a).isNull() | (F.size(a) == 0) | (F.size(F.array_distinct(a)) != F.size(a))
    reason = F.lower(F.coalesce("reason", F.lit("")))
    excuse = F.lit(False)
    for word in difficulty:
        excuse |= reason.contains(word)
    return [
        Rule("ALLOWLIST_SCOPE", bad("scope_pages") | F.exists("scope_pages", lambda p: p <= 0)),
        Rule("ALLOWLIST_ENTRY_TYPE", blank(c("token")) | ~c("type").isin(*types) | c("type").isNull()),
        Rule("ALLOWLIST_ENTRY_REASON", (F.length(F.trim(reason)) < ALLOWLIST_MIN_REASON) | excuse),
        Rule("ALLOWLIST_ENTRY_SCOPE", bad("pages") | F.exists("pages", lambda p: p <= 0) | bad("segment_ids") | ~F.coalesce("exact", F.lit(False))),
        Rule("ALLOWLIST_ENTRY_SCOPE_OUTSIDE_DOCUMENT", F.size(F.array_except("pages", "scope_pages")) > 0, needs=("ALLOWLIST_ENTRY_SCOPE",)),
        Rule("ALLOWLIST_ENTRY_BASIS", ~c("basis_type").isin(*bases) | c("basis_type").isNull() | blank(c("basis_reference"))),
    ]


def pack_rules(core: str) -> list[Rule]:
    """Rows of packs against the running core version."""
    c, now = F.col, t.version_numbers(F.lit(core))
    version = t.version_numbers(c("version"))
    return [
        Rule("INVALID_VERSION", version.isNull()),
        Rule("INVALID_SHA256", ~F.coalesce(is_sha256(c("digest")), F.lit(False))),
        Rule("CORE_VERSION_INCOMPATIBLE", (t.version_numbers(c("min_core")) > now) | (t.version_numbers(c("max_core")) <= now)),
        Rule("PATH_TRAVERSAL", F.exists("paths", lambda p: ~t.is_safe_path(p))),
        Rule("DUPLICATE_PATH", F.size(F.array_distinct("paths")) != F.size("paths")),
        Rule("EMPTY_CONTENT", F.size("paths") == 0),
    ]


def review_rules(minimum_dpi: int = 72, maximum_dpi: int = 600) -> list[Rule]:
    """Rows of page reviews; four checks per page are PASS, FAIL, NOT_APPLICABLE or NOT_REVIEWED."""
    c = F.col
    checks = ("visual", "image_text", "geometry", "legibility")
    open_ = F.lit(False)
    failed = F.lit(False)
    known = F.lit(True)
    for k in checks:
        open_ |= c(k) == "NOT_REVIEWED"
        failed |= c(k) == "FAIL"
        known &= c(k).isin("PASS", "FAIL", "NOT_APPLICABLE", "NOT_REVIEWED")
    offset = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"
    return [
        Rule("REVIEW_STATUS_INVALID", ~known),
        Rule("REVIEW_INCOMPLETE", open_, "NEEDS_REVIEW"),
        Rule("PAGE_REVIEW_FAILED", failed),
        Rule("REVIEWER_MISSING", ~open_ & blank(c("reviewer"))),
        Rule("REVIEW_TIME_INVALID", ~open_ & ~F.coalesce(c("reviewed_at").rlike(offset), F.lit(False))),
        Rule("PAGE_REFERENCE_INVALID", ~open_ & ~c("page_reference").eqNullSafe(t.page_reference(c("page")))),
        Rule("REVIEW_DPI_INVALID", ~c("review_dpi").between(minimum_dpi, maximum_dpi)),
        Rule("REVIEW_HASH_NOT_BOUND", ~open_ & ~c("reviewed_sha256").eqNullSafe(c("compare_sha256"))),
        Rule("REVIEW_NOTE_GENERIC", ~open_ & F.coalesce(t.is_generic_note(c("notes")), F.lit(True))),
        Rule("REVIEW_NOTE_PAGE_UNBOUND", ~open_ & ~F.contains(F.lower(F.coalesce("notes", F.lit(""))), t.page_reference(c("page")))),
        Rule("UNREVIEWED_METADATA_PRESENT", open_ & ~blank(c("reviewer"))),
    ]


def preflight_rules() -> list[Rule]:
    """The patterns of unsafe files.  Rows of raw files: ``latin`` is the content decoded as ISO-8859-1."""
    c = F.col("latin")
    return [
        Rule("PDF_MAGIC_MISSING", ~F.contains(F.substring(c, 1, 1024), F.lit("%PDF-"))),
        Rule("PDF_JAVASCRIPT", c.rlike(r"(?i)/JavaScript\b|/JS\s*[\(<]")),
        Rule("PDF_LAUNCH_ACTION", c.rlike(r"(?i)/Launch\b")),
        Rule("PDF_EMBEDDED_FILE", c.rlike(r"(?i)/EmbeddedFile\b")),
        Rule("SUSPICIOUS_CMAP_PATH", c.rlike(r"(?is)(?:/CMapName|/UseCMap|CMAP_PATH).{0,256}(?:\.\.[/\\]|[A-Za-z]:[/\\]|file:)")),
        Rule("PDF_ENCRYPTED", c.rlike(r"/Encrypt\b")),
        Rule("PDF_OPEN_ACTION", c.rlike(r"(?i)/OpenAction\b|/AA\b"), "NEEDS_REVIEW"),
        Rule("PDF_EXTERNAL_REFERENCE", c.rlike(r"(?i)/GoToR\b|/SubmitForm\b|/ImportData\b"), "NEEDS_REVIEW"),
        Rule("PDF_URI", c.rlike(r"(?i)/URI\b"), "NEEDS_REVIEW"),
    ]


# How a text's colour may be chosen; blank leaves it to the source.
COLOUR_POLICIES = ("", "preserve_source_exact", "explicit_inspected", "fragment_source_exact")


def bad_colour(c: Column) -> Column:
    """Not three channels from 0 to 1."""
    return F.coalesce((F.size(c) != 3) | F.exists(c, lambda x: F.coalesce((x < 0) | (x > 1), F.lit(True))), F.lit(True))


def colour_rules() -> list[Rule]:
    """Text colours of rows that aren't preserved: several source colours need fragments or an inspected colour."""
    c = F.col
    colours = F.array_distinct(F.coalesce("source_colors", F.array().cast("array<int>")))
    fragments = F.coalesce("fragments", F.array().cast("array<struct<text_color:array<double>,text_color_basis:string>>"))
    judged = ~F.coalesce(c("action").isin(*PRESERVE_ACTIONS), F.lit(False))
    policy, n, explicit = F.trim(F.coalesce("policy", F.lit(""))), F.size(colours), c("text_color").isNotNull()
    in_parts = (n > 1) & (policy == "fragment_source_exact") & (F.size(fragments) > 0)
    inspected = (policy == "explicit_inspected") & ((n == 1) | (n > 1)) & explicit
    changed = g.srgb(*[F.try_element_at("text_color", F.lit(i)) for i in (1, 2, 3)]) != F.try_element_at(colours, F.lit(1))
    return [
        Rule("SOURCE_TEXT_COLOR", judged & F.exists(colours, lambda x: x.isNull() | (x < 0) | (x > 0xFFFFFF))),
        Rule("TEXT_COLOR_POLICY", judged & ~policy.isin(*COLOUR_POLICIES)),
        Rule("TEXT_COLOR", judged & explicit & bad_colour(c("text_color"))),
        Rule("FRAGMENT_TEXT_COLOR", judged & in_parts & F.exists(fragments, lambda x: bad_colour(x["text_color"]))),
        Rule("FRAGMENT_TEXT_COLOR_BASIS", judged & in_parts & F.exists(fragments, lambda x: blank(x["text_color_basis"]))),
        Rule("TEXT_COLOR_BASIS", judged & blank(c("text_color_basis")) & inspected),
        Rule("AMBIGUOUS_SOURCE_TEXT_COLOR", judged & (n > 1) & ~in_parts & ~inspected),
        Rule("SOURCE_TEXT_COLOR_CHANGED", judged & (n == 1) & explicit & changed & (policy != "explicit_inspected"), needs=("TEXT_COLOR",)),
        Rule("SOURCE_TEXT_COLOR_MISSING", judged & (n == 0) & (policy == "preserve_source_exact")),
    ]
