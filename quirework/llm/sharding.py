"""Sharding along a Hilbert curve over quantised metadata.

Size, language and source are each quantised to 2**BITS levels: size by its doublings (64 of them hold any size),
language and source by the rank of their value among the distinct ones in code-point order (null last), in runs of
equal numbers of values.  Neighbouring levels are neighbouring values, so the Hilbert index of that point (Skilling's
transform) keeps rows that are alike in all three near each other, and a file's minimum and maximum of each dimension
prune well.  Rows are in order of the index, then of a digest of their id; the order is cut into runs of equal row
counts: law ``rows``.  Equal texts with equal metadata share an index, but may fall on both sides of a cut: under this
law counts decide.

Skew: positions come from ``ranked``, which deals rows by ranges of the whole order, digests included, so neither a
curve cell with a third of all rows nor the list of cells meets in one task.  Distinct languages and sources are
numbered in the same way.

Edge cases: null languages and sources are the last level, a null text has size 1; rows that agree in everything take
adjacent slots in any order; columns that clash with the result's names are replaced; fewer rows than shards leave some
shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm._rank import digest, ranked
from quirework.sources.scratch import Scratch

BITS = 6
DIMS = 3
SHARDS = 8


def curve_steps(bits: int = BITS, dims: int = DIMS) -> list[dict[str, str]]:
    """Skilling's transform of _h0.._h{dims-1} as SQL: each step assigns columns from the step before; ends in ``hilbert``."""
    steps, q = [], 1 << (bits - 1)
    while q > 1:
        p = q - 1
        steps.append({"_h0": f"CASE WHEN (_h0 & {q}) <> 0 THEN xor(_h0, {p}) ELSE _h0 END"})
        for i in range(1, dims):
            steps.append({"_h0": f"CASE WHEN (_h{i} & {q}) <> 0 THEN xor(_h0, {p}) ELSE xor(_h0, xor(_h0, _h{i}) & {p}) END", f"_h{i}": f"CASE WHEN (_h{i} & {q}) <> 0 THEN _h{i} ELSE xor(_h{i}, xor(_h0, _h{i}) & {p}) END"})
        q >>= 1
    steps += [{f"_h{i}": f"xor(_h{i}, _h{i - 1})"} for i in range(1, dims)]
    flip = "0"
    for b in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN (_h{dims - 1} & {1 << b}) <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    steps.append({f"_h{i}": f"xor(_h{i}, {flip})" for i in range(dims)})
    places = [f"CASE WHEN (_h{i} & {1 << b}) <> 0 THEN {1 << (b * dims + dims - 1 - i)} ELSE 0 END" for b in range(bits) for i in range(dims)]
    return [*steps, {"hilbert": " + ".join(places)}]


def hilbert(df: DataFrame, bits: int = BITS) -> DataFrame:
    """Adds ``hilbert`` for _h0, _h1, _h2 and drops them.  xor() is ^ in Spark SQL."""
    for step in curve_steps(bits):
        df = df.withColumns({k: F.expr(spark_xor(v)) for k, v in step.items()})
    return df.drop(*[f"_h{i}" for i in range(DIMS)])


def spark_xor(sql: str) -> str:
    """xor(a, b) rewritten as ((a) ^ (b))."""
    while (at := sql.rfind("xor(")) >= 0:
        depth, comma, i = 0, 0, at + 4
        while depth >= 0:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            if sql[i] == "," and not depth:
                comma = i
            i += 1
        sql = f"{sql[:at]}(({sql[at + 4 : comma].strip()}) ^ ({sql[comma + 1 : i - 1].strip()})){sql[i:]}"
    return sql


def level(df: DataFrame, column: str, name: str, scratch: Scratch, bits: int = BITS) -> DataFrame:
    """``df`` with the level of a column's value among its distinct ones."""
    values = ranked(df.select(F.col(column).alias("_value")).distinct(), [F.col("_value").isNull(), F.col("_value")], "_i", scratch)
    values = scratch.cut(values, f"values-{name}")
    n = max(values.count(), 1)
    if n > 1 << bits:
        values = values.withColumn("_i", F.expr(f"(_i * {1 << bits}) div {n}"))
    return df.join(values.withColumnRenamed("_i", name), F.col(column).eqNullSafe(F.col("_value")), "left").withColumn(name, F.col(name).cast("int")).drop("_value")


def shard(docs: DataFrame, *, doc_id: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """``docs`` (with ``size``, ``lang``, ``source``) and law, hilbert, shard, slot, grown_shard."""
    scratch = Scratch(docs.sparkSession, "shard")
    docs = docs.drop("law", "hilbert", "shard", "slot", "grown_shard")
    placed = docs.withColumn("_h0", F.length(F.bin("size")) - 1)
    placed = hilbert(level(level(placed, "lang", "_h1", scratch), "source", "_h2", scratch))
    placed = ranked(placed, [F.col("hilbert"), digest(F.col(doc_id), "shard"), F.col(doc_id), F.col("size")], "_rank", scratch)
    n = max(placed.count(), 1)
    placed = placed.withColumn("shard", F.expr(f"cast(((_rank + 1) * {shards} - 1) div {n} as int)"))
    first = F.expr(f"(cast(shard as bigint) * {n}) div {shards}")
    return placed.withColumns({"law": F.lit("rows"), "slot": F.col("_rank") - first, "grown_shard": F.lit(None).cast("int")}).drop("_rank")
