"""Nested JSON as rows: leaves by path, id leaves, key sets, and equality within a tolerance.  VARIANT, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.sources.scratch import Scratch


def leaves(rows: DataFrame, keys: list[str], json: str) -> DataFrame:
    """(keys, path, name, kind, value) of every scalar: one join with variant_explode a level, as many as there are.

    ``path`` is dotted with [i] for array members; kind is the variant's type.  Invalid JSON gives one row of kind
    INVALID; empty objects and arrays give a row each, so that they count in comparisons.
    """
    spark, s = rows.sparkSession, Scratch(rows.sparkSession, "leaves")
    parsed = rows.select(*keys, F.try_parse_json(json).alias("v"), F.lit("$").alias("path"), F.lit(None).cast("string").alias("name"))
    out, level, here = [], 0, parsed
    while True:
        here = s.cut(here.select(*keys, "path", "name", F.col("v").cast("string").alias("text"), F.schema_of_variant("v").alias("kind")), f"level-{level}")
        nested = F.coalesce(F.col("kind").startswith("OBJECT<") | F.col("kind").startswith("ARRAY<"), F.lit(False)) & ~F.coalesce(F.col("text").isin("{}", "[]"), F.lit(False))
        kind = F.when(F.col("kind").isNull(), "INVALID").otherwise(F.regexp_replace("kind", r"[<(].*$", ""))
        out.append(here.where(~nested).select(*keys, "path", "name", kind.alias("kind"), F.col("text").alias("value")))
        inner = here.where(nested).withColumn("v", F.parse_json("text"))
        if inner.isEmpty():
            break
        each = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("pos"), F.col("key"), F.col("value").alias("inside")))
        step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), F.col("key"))).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        here = each.select(*keys, F.col("inside").alias("v"), F.concat("path", step).alias("path"), F.coalesce("key", "name").alias("name"))
        level += 1
    all_ = out[0]
    for x in out[1:]:
        all_ = all_.unionByName(x)
    return all_


def id_leaves(rows: DataFrame, keys: list[str], json: str) -> DataFrame:
    """(keys, id) of string leaves under fields that end in _id or _ids."""
    return leaves(rows, keys, json).where((F.col("kind") == "STRING") & F.col("name").rlike("_ids?$")).select(*keys, F.col("value").alias("id")).distinct()


def key_issues(rows: DataFrame, keys: list[str], json: str, known: tuple[str, ...], required: tuple[str, ...] | None = None) -> DataFrame:
    """Missing and unknown keys of JSON objects."""
    own = F.json_object_keys(json)
    need = F.array(*[F.lit(x) for x in (known if required is None else required)])
    missing = F.transform(F.array_except(need, F.coalesce(own, F.array().cast("array<string>"))), lambda k: F.struct(k.alias("key"), F.lit("MISSING_KEY").alias("code")))
    extra = F.transform(F.array_except(F.coalesce(own, F.array().cast("array<string>")), F.array(*[F.lit(x) for x in known])), lambda k: F.struct(k.alias("key"), F.lit("UNKNOWN_KEY").alias("code")))
    return rows.select(*keys, F.explode(F.concat(missing, extra)).alias("i")).select(*keys, "i.key", "i.code")


NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def differing(a: DataFrame, b: DataFrame, keys: list[str], json: str, tolerance: float) -> DataFrame:
    """(keys, path) at which two JSON values differ: numbers beyond ``tolerance``, else any difference; a truth value
    never equals a number."""
    x = leaves(a, keys, json).select(*keys, "path", F.col("kind").alias("ka"), F.col("value").alias("va"))
    y = leaves(b, keys, json).select(*keys, "path", F.col("kind").alias("kb"), F.col("value").alias("vb"))
    both = x.join(y, [*keys, "path"], "full_outer")
    number = F.col("ka").isin(*NUMBERS) & F.col("kb").isin(*NUMBERS)
    near = F.abs(F.col("va").try_cast("double") - F.col("vb").try_cast("double")) <= tolerance
    same = F.when(number, near).otherwise(F.col("ka").eqNullSafe(F.col("kb")) & F.col("va").eqNullSafe(F.col("vb")))
    return both.where(~F.coalesce(same, F.lit(False))).select(*keys, "path")


def patched(base: Column, patch: Column) -> Column:
    """A map with another one's entries over it."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(patch, k)), patch)
