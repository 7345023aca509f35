"""Integrity of manifests, context references, alignment contracts, visual links and plans, as issue rows.

Every function takes whole tables of many documents and gives (keys, severity, code); rules of one row are run by
``rules.check`` in one scan, those of several rows are aggregates and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import geometry as g
from quirework.plans.rules import Rule, blank, check

# Names that artefacts declare.
MANIFEST_SCHEMA = "segment-manifest/v1"
ALIGNMENT_SCHEMA = "text-alignment/v1"
PLAN_SCHEMA = "full-run-plan/v1"
REPORT_SCHEMA = "segment-validation/v1"
MEASUREMENT = "actual_candidate_text_span_bbox"


def squeezed(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"\s+", " "))


def header_issues(manifests: DataFrame, keys: list[str], schema: str = MANIFEST_SCHEMA) -> DataFrame:
    """Manifest header: declared schema, source hash in capitals, at least one segment."""
    c = F.col
    return check(
        manifests,
        [
            Rule("SCHEMA", ~c("schema").eqNullSafe(F.lit(schema))),
            Rule("SOURCE_SHA256", ~F.coalesce(c("source_sha256").rlike("^[A-F0-9]{64}$"), F.lit(False))),
            Rule("SEGMENTS_EMPTY", F.coalesce("n_segments", F.lit(0)) < 1),
        ],
        keys,
    )


def page_context_issues(packets: DataFrame, keys: list[str]) -> DataFrame:
    """Page packets: a page number and a box with an area."""
    b = F.col("page_bbox")
    return check(packets, [Rule("PAGE_CONTEXT", F.col("page").isNull() | b.isNull() | F.coalesce((b["x1"] <= b["x0"]) | (b["y1"] <= b["y0"]), F.lit(True)))], keys)


def context_ref_issues(refs: DataFrame, pages: DataFrame, sources: DataFrame, doc: str) -> DataFrame:
    """Context references (doc, ref_id, page, excerpt) against page texts (doc, page, text) and (doc, page_count).

    Of references that repeat an id the first by position is judged and the others are duplicates.  A document of
    which no page text is at hand isn't checked: that needs review.
    """
    r = refs.join(sources.select(doc, "page_count"), doc, "left")
    first = r.where(~blank(F.col("ref_id"))).groupBy(doc, "ref_id").agg(F.min_by(F.struct("page", "excerpt", "page_count"), "position").alias("x"), F.count("*").alias("_n")).select(doc, "ref_id", "x.*", "_n")
    row = check(
        first,
        [
            Rule("DUPLICATE_DOCUMENT_CONTEXT_REF", F.col("_n") > 1),
            Rule("DOCUMENT_CONTEXT_REF_PAGE", F.col("page").isNull() | (F.col("page") < 1) | (F.col("page") > F.coalesce("page_count", F.lit(0)))),
            Rule("DOCUMENT_CONTEXT_REF_SOURCE", blank(F.col("excerpt"))),
        ],
        [doc, "ref_id"],
    )
    unnamed = check(r, [Rule("DOCUMENT_CONTEXT_REF_ID", blank(F.col("ref_id")))], [doc, "ref_id"])
    at_hand = pages.select(doc).distinct().withColumn("_there", F.lit(True))
    texts = pages.select(doc, "page", squeezed(F.col("text")).alias("_text"))
    told = first.where(~blank(F.col("excerpt"))).join(texts, [doc, "page"], "left").join(at_hand, doc, "left")
    absent = told.where(F.col("_there") & ~F.coalesce(F.contains(F.col("_text"), squeezed(F.col("excerpt"))), F.lit(False)) & F.col("_text").isNotNull())
    absent = absent.select(doc, "ref_id", F.lit("BLOCKED").alias("severity"), F.lit("DOCUMENT_CONTEXT_REF_MISMATCH").alias("code"))
    unchecked = told.where("_there is null").select(doc, F.lit(None).cast("string").alias("ref_id"), F.lit("NEEDS_REVIEW").alias("severity"), F.lit("DOCUMENT_CONTEXT_SOURCE_NOT_CHECKED").alias("code")).distinct()
    return row.unionByName(unnamed).unionByName(absent).unionByName(unchecked)


def alignment_rules() -> list[Rule]:
    """Rows of segments with an alignment contract as struct ``k``, render align and target box, and the page's box."""
    k, page = F.col("k"), F.col("page_bbox")
    told = k.isNotNull()
    fields = ("schema", "alignment", "source_reference_bbox", "target_reference_bbox", "source_text_bbox", "maximum_delta_pt", "measurement_basis")
    missing = F.lit(False)
    for f in fields:
        missing |= k[f].isNull()
    outside = F.lit(False)
    for f in ("source_reference_bbox", "target_reference_bbox", "source_text_bbox"):
        outside |= ~g.inside(k[f], page, 0.1)
    needs = ("TEXT_ALIGNMENT_FIELDS",)
    return [
        Rule("TEXT_ALIGNMENT_FIELDS", told & missing),
        Rule("TEXT_ALIGNMENT_SCHEMA", told & (k["schema"] != ALIGNMENT_SCHEMA), needs=needs),
        Rule("TEXT_ALIGNMENT_MODE", told & ~k["alignment"].isin("left", "right", "center"), needs=needs),
        Rule("TEXT_ALIGNMENT_RENDER_MISMATCH", told & (F.coalesce("align", F.lit("left")) != k["alignment"]), needs=needs),
        Rule("TEXT_ALIGNMENT_MEASUREMENT", told & (k["measurement_basis"] != MEASUREMENT), needs=needs),
        Rule("TEXT_ALIGNMENT_TOLERANCE", told & (k["maximum_delta_pt"] < 0), needs=needs),
        Rule("TEXT_ALIGNMENT_BBOX_PAGE", told & page.isNotNull() & outside, needs=needs),
        Rule("TEXT_ALIGNMENT_SOURCE_CONTAINMENT", told & ~g.inside(k["source_text_bbox"], k["source_reference_bbox"], 0.001), needs=needs),
        Rule("TEXT_ALIGNMENT_TARGET_CONTAINMENT", told & ~g.inside(F.col("target_bbox"), k["target_reference_bbox"], 0.001), needs=needs),
    ]


def visual_link_issues(segments: DataFrame, visuals: DataFrame, allowed: DataFrame, doc: str, translated: bool) -> DataFrame:
    """Preserved segments against declared visuals and the scoped list of allowed texts.

    segments(doc, segment_id, action, visual_id, source_text, target_text, segment_role, group_id, guidance_ids);
    visuals(doc, visual_id, kind, group_id); allowed(doc, visual_id, source_text, target_text, guidance_ids).
    """
    kept = segments.where("action = 'preserve_source_visual_with_textual_guidance'").withColumn("visual_id", F.coalesce("visual_id", F.lit("")))
    v = visuals.select(doc, "visual_id", F.coalesce("kind", F.lit("raster_image")).alias("_kind"), F.coalesce("group_id", F.lit("")).alias("_group"), F.lit(True).alias("_known"))
    a = allowed.select(doc, "visual_id", "source_text", F.coalesce("target_text", F.lit("")).alias("_target"), F.lit(True).alias("_allowed"))
    rows = kept.join(v, [doc, "visual_id"], "left").join(a, [doc, "visual_id", "source_text"], "left")
    unknown, vector = F.col("_known").isNull(), F.col("_kind") == "vector_component"
    needs = ("UNKNOWN_VISUAL_ID",)
    rules = [
        Rule("UNKNOWN_VISUAL_ID", unknown),
        Rule("VECTOR_VISUAL_COMPLETE_COMPONENT_REQUIRED", vector & ~F.col("segment_role").eqNullSafe(F.lit("complete_visual")), needs=needs),
        Rule("VECTOR_VISUAL_GROUP_MISMATCH", vector & (F.coalesce("group_id", F.lit("")) != F.col("_group")), needs=needs),
        Rule("UI_ALLOWLIST_MISSING", F.col("_allowed").isNull(), needs=needs),
    ]
    if translated:
        rules.append(Rule("UI_ALLOWLIST_TRANSLATION", F.col("_target") != F.coalesce("target_text", F.lit("")), needs=(*needs, "UI_ALLOWLIST_MISSING")))
    found = check(rows, rules, [doc, "segment_id"])
    ids = segments.select(doc, F.col("segment_id").alias("_g")).distinct()
    guides = rows.where("_known").select(doc, "segment_id", F.explode("guidance_ids").alias("_g")).join(ids, [doc, "_g"], "left_anti").select(doc, "segment_id").distinct()
    listed = allowed.select(doc, "visual_id", F.explode("guidance_ids").alias("_g")).join(ids, [doc, "_g"], "left_anti").select(doc, F.col("visual_id").alias("segment_id")).distinct()
    told = lambda df, code: df.select(doc, "segment_id", F.lit("BLOCKED").alias("severity"), F.lit(code).alias("code"))
    return found.unionByName(told(guides, "UNKNOWN_GUIDANCE_ID")).unionByName(told(listed, "UNKNOWN_UI_GUIDANCE_ID"))


def plan_issues(plans: DataFrame, batches: DataFrame, owned: DataFrame, records: DataFrame, order: DataFrame, plan: str) -> DataFrame:
    """(plan, id, code): a plan whose body or coverage was changed.

    plans(plan, schema, declared_digest, body_digest); batches(plan, batch_id); owned(plan, batch_id, segment_id);
    records(plan, batch_id, segment_id); order(plan, segment_id) is the manifest's.
    """
    out = [
        plans.where(~F.col("schema").eqNullSafe(F.lit(PLAN_SCHEMA))).select(plan, F.lit(None).cast("string").alias("id"), F.lit("PLAN_SCHEMA").alias("code")),
        plans.where(~F.col("declared_digest").eqNullSafe(F.col("body_digest"))).select(plan, F.lit(None).cast("string").alias("id"), F.lit("PLAN_DIGEST_MISMATCH").alias("code")),
        plans.join(batches.select(plan).distinct(), plan, "left_anti").select(plan, F.lit(None).cast("string").alias("id"), F.lit("PLAN_HAS_NO_BATCHES").alias("code")),
        batches.where(blank(F.col("batch_id").cast("string"))).select(plan, F.lit(None).cast("string").alias("id"), F.lit("PLAN_BATCH_ID").alias("code")),
    ]

    def repeated(df: DataFrame, name: str, code: str) -> DataFrame:
        return df.groupBy(plan, name).count().where("count > 1").select(plan, F.col(name).cast("string").alias("id"), F.lit(code).alias("code"))

    def unequal(a: DataFrame, b: DataFrame, keys: list[str], name: str, code: str) -> DataFrame:
        x = a.select(*keys).distinct().withColumn("_a", F.lit(True)).join(b.select(*keys).distinct().withColumn("_b", F.lit(True)), keys, "full_outer")
        return x.where("_a is null or _b is null").select(plan, F.col(name).cast("string").alias("id"), F.lit(code).alias("code")).distinct()

    out += [
        repeated(batches, "batch_id", "PLAN_DUPLICATE_BATCH"),
        unequal(owned, records, [plan, "batch_id", "segment_id"], "batch_id", "PLAN_RECORDS_DIFFER"),
        repeated(owned, "segment_id", "PLAN_SEGMENT_OWNED_TWICE"),
        repeated(order, "segment_id", "PLAN_ORDER_DUPLICATE"),
        unequal(owned, order, [plan, "segment_id"], "segment_id", "PLAN_COVERAGE"),
    ]
    all_ = out[0]
    for x in out[1:]:
        all_ = all_.unionByName(x)
    return all_


def precondition_issues(manifests: DataFrame, reports: DataFrame, segments: DataFrame, contexts: DataFrame, doc: str) -> DataFrame:
    """(doc, id, code): why a manifest can't be planned.

    manifests(doc, schema, status, sha256, selected_pages); reports(doc, schema, stage, manifest_sha256, status,
    blocking, needs_review); segments(doc, segment_id, page); contexts(doc, page).
    """
    c = F.col
    r = reports.select(doc, *[F.col(x).alias(f"r_{x}") for x in ("schema", "stage", "manifest_sha256", "status", "blocking", "needs_review")])
    rows = manifests.join(r, doc, "left")
    row = check(
        rows,
        [
            Rule("MANIFEST_SCHEMA", ~c("schema").eqNullSafe(F.lit(MANIFEST_SCHEMA))),
            Rule("MANIFEST_STATUS", ~F.coalesce(c("status").isin("EXTRACTED", "VALIDATED"), F.lit(False))),
            Rule("REPORT_SCHEMA", ~c("r_schema").eqNullSafe(F.lit(REPORT_SCHEMA))),
            Rule("REPORT_STAGE", ~c("r_stage").eqNullSafe(F.lit("extraction"))),
            Rule("REPORT_STALE", ~c("r_manifest_sha256").eqNullSafe(c("sha256"))),
            Rule("REPORT_NOT_PASS", ~(c("r_status").eqNullSafe(F.lit("PASS")) & c("r_blocking").eqNullSafe(F.lit(0)) & c("r_needs_review").eqNullSafe(F.lit(0)))),
        ],
        [doc],
    ).select(doc, F.lit(None).cast("string").alias("id"), "code")
    pages = manifests.select(doc, F.explode("selected_pages").alias("page")).distinct()
    say = lambda df, name, code: df.select(doc, F.col(name).cast("string").alias("id"), F.lit(code).alias("code"))
    out = [
        say(segments.groupBy(doc, "segment_id").count().where("count > 1"), "segment_id", "DUPLICATE_SEGMENT_ID"),
        say(segments.where(blank(c("segment_id").cast("string"))).select(doc, "segment_id").distinct(), "segment_id", "SEGMENT_ID_EMPTY"),
        say(manifests.join(segments.select(doc).distinct(), doc, "left_anti"), doc, "SEGMENTS_EMPTY"),
        say(segments.join(pages, [doc, "page"], "left_anti"), "segment_id", "SEGMENT_PAGE_UNSELECTED"),
        say(contexts.groupBy(doc, "page").count().where("count > 1"), "page", "DUPLICATE_PAGE_CONTEXT"),
        say(pages.join(contexts.select(doc, "page").distinct(), [doc, "page"], "left_anti"), "page", "PAGE_CONTEXT_MISSING"),
    ]
    for x in out:
        row = row.unionByName(x)
    return row


def issue_counts(issues: DataFrame, keys: list[str]) -> DataFrame:
    """Blocking and review issues, and distinct codes, of each document."""
    return issues.groupBy(*keys).agg(F.count_if(F.col("severity") == "BLOCKED").alias("blocking"), F.count_if(F.col("severity") == "NEEDS_REVIEW").alias("needs_review"), F.countDistinct("code").alias("codes"))

# What a request and a result repeat of the plan.
REQUEST_FIELDS = ("schema", "plan_sha256", "plan_digest", "source_manifest_sha256", "batch_id", "batch_digest")
RESULT_FIELDS = ("plan_sha256", "plan_digest", "source_manifest_sha256", "batch_id", "batch_digest", "request_sha256")


def binding_issues(expected: DataFrame, found: DataFrame, fields: tuple[str, ...], key: str, prefix: str) -> DataFrame:
    """(key, id, code): fields of artefacts that differ from what the plan expects; nulls equal each other."""
    both = expected.select(key, F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias("e")).join(found.select(key, F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias("f")), key)
    wrong = F.filter(F.array(*[F.when(~F.col(f"e.{f}").eqNullSafe(F.col(f"f.{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return both.select(key, F.explode(wrong).alias("id")).select(key, "id", F.lit(f"{prefix}_BINDING_MISMATCH").alias("code"))


def result_issues(results: DataFrame, owned: DataFrame, translations: DataFrame, requirements: DataFrame, bindings: DataFrame, assertions: DataFrame, key: str) -> DataFrame:
    """(key, id, code) of batch results against what their batches own.

    results(key, status, elapsed); owned(key, segment_id, source_digest, action); translations(key, segment_id,
    source_digest, target_text); requirements(key, segment_id, token, required); bindings and assertions(key,
    segment_id, binding_id).
    """
    c = F.col
    say = lambda df, name, code: df.select(key, c(name).cast("string").alias("id"), F.lit(code).alias("code"))
    pair = [key, "segment_id"]
    done = results.select(key)
    mine, theirs = owned.join(done, key, "left_semi"), translations.join(done, key, "left_semi")
    both = mine.join(theirs.select(*pair, c("source_digest").alias("_digest"), c("target_text").alias("_text")), pair)
    text = F.coalesce("_text", F.lit(""))
    count = F.when(F.length("token") > 0, (F.length(text) - F.length(F.replace(text, c("token"), F.lit("")))) / F.length("token")).otherwise(0)
    ids = [*pair, "binding_id"]
    told = assertions.join(both.select(*pair).distinct(), pair, "left_semi")
    want = bindings.join(both.select(*pair).distinct(), pair, "left_semi")
    apart = want.select(*ids).distinct().withColumn("_w", F.lit(1)).join(told.select(*ids).distinct().withColumn("_t", F.lit(1)), ids, "full_outer")
    elapsed = c("elapsed").isNotNull() & (F.isnan(c("elapsed").cast("double")) | (c("elapsed") < 0) | (c("elapsed") == float("inf")))
    out = [
        say(results.where(~c("status").eqNullSafe(F.lit("TRANSLATED"))), key, "RESULT_STATUS"),
        say(results.where(elapsed), key, "RESULT_TIMING"),
        say(theirs.groupBy(*pair).count().where("count > 1"), "segment_id", "RESULT_DUPLICATE_SEGMENT"),
        say(mine.join(theirs, pair, "left_anti"), "segment_id", "RESULT_SEGMENT_MISSING"),
        say(theirs.join(mine, pair, "left_anti").select(*pair).distinct(), "segment_id", "RESULT_SEGMENT_UNEXPECTED"),
        say(both.where(~c("source_digest").eqNullSafe(c("_digest"))), "segment_id", "RESULT_SOURCE_STALE"),
        say(both.where(~c("action").eqNullSafe(F.lit("preserve")) & blank(c("_text"))), "segment_id", "RESULT_TRANSLATION_EMPTY"),
        say(both.join(requirements, pair).where(count < c("required")).select(*pair).distinct(), "segment_id", "RESULT_TOKEN_MISSING"),
        say(told.groupBy(*ids).count().where("count > 1").select(*pair).distinct(), "segment_id", "RESULT_DUPLICATE_ASSERTION"),
        say(apart.where("_w is null or _t is null").select(*pair).distinct(), "segment_id", "RESULT_ASSERTION_COVERAGE"),
    ]
    all_ = out[0]
    for x in out[1:]:
        all_ = all_.unionByName(x)
    return all_
