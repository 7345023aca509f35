"""One changed field, one code: mutations of rows that pass."""

import pytest

from quirework import catalogue
from quirework.plans import rules


def codes(spark, schema, row, table):
    df = spark.createDataFrame([row], schema)
    return sorted(r["code"] for r in rules.check(df, table, []).collect())


VISUAL = "visual_id string, kind string, bbox struct<x0:double,y0:double,x1:double,y1:double>, pixel_width int, pixel_height int, decoded_sha256 string, group_id string"
GOOD_VISUAL = dict(visual_id="v", kind="raster_image", bbox=(0.0, 0.0, 9.0, 9.0), pixel_width=3, pixel_height=3, decoded_sha256="A" * 64, group_id=None)
BINDING = "binding_id string, parameter string, role string, mode string, `condition` string, comparison string, consequence string, clarification_mode string, source_tokens array<string>, source_text string, protected array<string>, cues array<struct<text:string,kind:string,scope:string>>, context_required boolean, context_ref_ids array<string>"
GOOD_BINDING = dict(binding_id="b", parameter="p", role="r", mode="m", condition="c", comparison=">", consequence="x", clarification_mode="none", source_tokens=["5"], source_text="set 5", protected=["5"], cues=[("m", "mode", "segment")], context_required=False, context_ref_ids=None)
MEMBER = "component_id string, role string, policy string, translatability string, bbox struct<x0:double,y0:double,x1:double,y1:double>"
GOOD_MEMBER = dict(component_id="c", role="icon", policy="preserve", translatability="none", bbox=(0.0, 0.0, 1.0, 1.0))
ALLOW = "token string, type string, reason string, scope_pages array<int>, pages array<int>, segment_ids array<string>, exact boolean, basis_type string, basis_reference string"
GOOD_ALLOW = dict(token="USB", type="brand", reason="registered trade name", scope_pages=[1, 2], pages=[1], segment_ids=["s"], exact=True, basis_type="policy", basis_reference="r1")
COLOUR = "source_colors array<int>, policy string, text_color array<double>, text_color_basis string, action string, fragments array<struct<text_color:array<double>,text_color_basis:string>>"
GOOD_COLOUR = dict(source_colors=[0xFF0000], policy="preserve_source_exact", text_color=[1.0, 0.0, 0.0], text_color_basis=None, action="replace", fragments=None)

CASES = [
    (VISUAL, GOOD_VISUAL, lambda: rules.visual_rules(), {"visual_id": " ", "kind": "blob", "bbox": (0.0, 0.0, 0.0, 9.0), "pixel_width": 0, "decoded_sha256": "zz"}, ["VISUAL_ID", "VISUAL_KIND", "VISUAL_BBOX", "VISUAL_PIXEL_SIZE", "VISUAL_SHA256"]),
    (BINDING, GOOD_BINDING, lambda: rules.binding_rules(), {"binding_id": "", "mode": None, "source_tokens": [], "source_text": "set 6", "protected": [], "clarification_mode": "maybe", "cues": [("m", "mood", "segment")], "context_required": True}, ["SEMANTIC_BINDING_ID", "SEMANTIC_BINDING_FIELDS", "SEMANTIC_SOURCE_TOKENS", "SEMANTIC_SOURCE_TOKEN_MISSING", "SEMANTIC_SOURCE_TOKEN_NOT_PROTECTED", "CLARIFICATION_POLICY_INVALID", "SEMANTIC_TARGET_CUE", "CROSS_PAGE_CONTEXT_NOT_CHECKED"]),
    (MEMBER, GOOD_MEMBER, lambda: rules.member_rules(), {"component_id": None, "role": "ghost", "policy": "vanish", "bbox": None, "translatability": "translate"}, ["COMPONENT_ID", "COMPONENT_ROLE", "COMPONENT_POLICY", "COMPONENT_SOURCE_GEOMETRY", "PRESERVE_TRANSLATABLE_COMPONENT"]),
    (ALLOW, GOOD_ALLOW, lambda: rules.allowlist_rules(("brand",), ("policy",), ("too hard",)), {"token": "", "reason": "it is too hard to change", "scope_pages": [1, 1], "pages": [3], "segment_ids": [], "basis_reference": " "}, ["ALLOWLIST_ENTRY_TYPE", "ALLOWLIST_ENTRY_REASON", "ALLOWLIST_SCOPE", "ALLOWLIST_ENTRY_SCOPE_OUTSIDE_DOCUMENT", "ALLOWLIST_ENTRY_SCOPE", "ALLOWLIST_ENTRY_BASIS"]),
    (COLOUR, GOOD_COLOUR, lambda: rules.colour_rules(), {"policy": "any", "text_color": [1.0, 2.0, 0.0]}, ["TEXT_COLOR_POLICY", "TEXT_COLOR"]),
]


@pytest.mark.parametrize(("schema", "good", "table", "changes", "want"), CASES)
def test_each_change_gives_its_code(spark, schema, good, table, changes, want):
    table = table()
    assert codes(spark, schema, tuple(good.values()), table) == []
    for (name, value), code in zip(changes.items(), want):
        got = codes(spark, schema, tuple((good | {name: value}).values()), table)
        if name == "clarification_mode":  # a cue for it is asked for as well
            got = [c for c in got if c != "CLARIFICATION_TARGET_CUES"]
        assert got == [code] or code in got and name in ("source_tokens", "role", "policy"), (name, got)


def test_colour_changes(spark):
    wrong = tuple((GOOD_COLOUR | {"text_color": [0.0, 1.0, 0.0]}).values())
    assert codes(spark, COLOUR, wrong, rules.colour_rules()) == ["SOURCE_TEXT_COLOR_CHANGED"]
    def found(**changes):
        return codes(spark, COLOUR, tuple((GOOD_COLOUR | changes).values()), rules.colour_rules())

    several = {"source_colors": [1, 2], "text_color": None}
    assert found(**several) == ["AMBIGUOUS_SOURCE_TEXT_COLOR"]
    assert found(**several, action="preserve") == []
    assert found(**several, policy="fragment_source_exact") == ["AMBIGUOUS_SOURCE_TEXT_COLOR"]
    assert found(**several, policy="fragment_source_exact", fragments=[([0.0, 0.0, 1.0], "inspected")]) == []
    assert found(**several, policy="fragment_source_exact", fragments=[([0.0, 1.0], " ")]) == ["FRAGMENT_TEXT_COLOR", "FRAGMENT_TEXT_COLOR_BASIS"]
    assert found(source_colors=[1, 2], policy="explicit_inspected") == ["TEXT_COLOR_BASIS"]
    assert found(source_colors=[1, 2], policy="explicit_inspected", text_color_basis="seen at 300 dpi") == []
    assert found(text_color=[0.0, 1.0, 0.0], policy="explicit_inspected", text_color_basis="seen") == []
    assert found(source_colors=[], text_color=None) == ["SOURCE_TEXT_COLOR_MISSING"]
    assert found(source_colors=[], text_color=None, policy="") == []
    assert found(source_colors=[1, 1], policy=None, text_color=None) == []


def test_segment_rules_by_stage(spark):
    df = catalogue.sample_segments(spark)
    got = {r["segment_id"]: r["code"] for r in rules.check(df, rules.segment_rules("extraction"), ["segment_id"]).collect()}
    assert set(got) == {"type", "status", "action", "page", "empty", "source", "fields"}


def test_all_rules_take_one_scan(spark):
    df = rules.check(catalogue.sample_segments(spark), rules.segment_rules("render"), ["segment_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Union" not in plan
