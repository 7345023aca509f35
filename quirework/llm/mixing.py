"""Mixing sources to target weights by systematic sampling.

Sources are weighted in code-point order (null last); shares of the whole are filled up to ``most`` times a
source's own size and the excess is reshared by weight until none is above.  Each document of a source expects
target / source_size copies.  Documents of a source are put in order (size class, then a digest of the id), expected
copies are prefix-summed, one offset per source is added, and a document is emitted once for every integer that its
interval crosses.  The order by size class makes neighbours alike; the offset is that of ``OFFSETS`` evenly spaced ones
from a seeded start which brings the words taken nearest to the target.

Skew: positions come from ``ranked``, which deals rows by ranges of the whole order, so a source with a third of all
rows meets many tasks; sources are numbered in the same way and the level of the filling is a few sums over them, so
neither the rows nor the list of sources ever meet in one task.

Edge cases: a null or blank text has size 0 and may be emitted without adding words; a null source is a source
of its own; a source without words has target 0 and emits nothing; rows that agree in size and id are in any
order, which leaves the bag of results unchanged; an empty table gives an empty result; columns that clash with the
result's names (source_size, target, copies, taken, weight) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm._rank import digest, ranked
from quirework.sources.scratch import Scratch

MOST = 3
WEIGHTS = 3
SEED = "mix"
OFFSETS = 32
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Ordered classes, four to each doubling."""
    bits = F.length(F.bin(size))
    return bits * 8 + F.expr(f"cast(shiftright({{s}} * 4, length(bin({{s}})) - 1) as int)".format(s="size"))


def targets(sizes: DataFrame, scratch: Scratch, most: int = MOST, weights: int = WEIGHTS) -> DataFrame:
    """(source, source_size) -> with weight, target.

    The level L solves sum(min(most * size, L * weight)) = sum(size): sources above their limit are taken out and the
    rest is shared anew, until none is above; each step is one row of sums.
    """
    numbered = ranked(sizes, [F.col("source").isNull(), F.col("source")], "_i", scratch)
    w = scratch.cut(numbered.select("source", "source_size", (F.pmod("_i", F.lit(weights)) + 1).cast("long").alias("weight")), "weights")
    fill = most * F.col("source_size") / F.col("weight").cast("double")
    level = -1.0
    while True:
        below = fill < level
        left, weight = w.agg(F.sum("source_size") - F.coalesce(F.sum(F.when(below, most * F.col("source_size"))), F.lit(0)), F.sum(F.when(~below, F.col("weight")))).first()
        now = float(left) / float(weight) if weight else level
        if now <= level:  # none went above since; at the limit only rounding moves it
            break
        level = now
    target = F.when(fill < level, most * F.col("source_size").cast("double")).otherwise(F.lit(max(level, 0.0)) * F.col("weight"))
    return w.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", most: int = MOST, seed: str = SEED) -> DataFrame:
    """``docs`` (with ``source`` and ``size``) and source_size, target, copies (0 to ``most``), taken."""
    scratch = Scratch(docs.sparkSession, "mix")
    docs = docs.drop("source_size", "target", "copies", "taken", "weight")
    order = [F.col("source").isNull(), F.col("source"), size_class(F.col("size")), digest(F.col(doc_id), seed), F.col("size"), F.col(doc_id)]
    placed = ranked(docs, order, "_rank", scratch)
    totals = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("_rank").alias("_first"))
    totals = scratch.cut(totals, "totals")
    plan = targets(totals.select("source", "source_size"), scratch, most)
    plan = plan.join(totals.select(F.col("source").alias("_source"), "_first"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "weight")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = scratch.cut(plan.withColumns({"_rate": rate, "_seed": digest(F.col("source"), seed) / float(1 << 32)}), "plan")

    def crossed(offset: Column) -> Column:
        rank = F.col("_rank") - F.col("_first")
        return (F.floor(F.col("_rate") * (rank + 1) + offset) - F.floor(F.col("_rate") * rank + offset)).cast("long")

    offsets = [F.col("_seed") + i / OFFSETS for i in range(OFFSETS)]
    narrow = placed.select("source", "size", "_rank").join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    tried = narrow.groupBy("source").agg(*[F.sum(crossed(x) * F.col("size")).alias(f"t{i}") for i, x in enumerate(offsets)])
    gaps = F.array(*[F.struct(F.abs(F.col(f"t{i}") - F.col("target")).alias("gap"), F.lit(i).alias("i")) for i in range(OFFSETS)])
    chosen = plan.withColumnRenamed("source", "_source").join(tried, F.col("source").eqNullSafe(F.col("_source"))).select("_source", "source_size", "target", "_first", "_rate", (F.col("_seed") + F.array_min(gaps)["i"] / OFFSETS).alias("_offset"))
    chosen = scratch.cut(chosen, "chosen")
    placed = placed.join(chosen, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn("copies", crossed(F.col("_offset")))
    return placed.withColumn("taken", F.col("copies") * F.col("size")).drop("_rank", "_rate", "_first", "_offset", "_source")


def emitted(mixed: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_copy")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
f AS (SELECT *, 3 * source_size / CAST(weight AS DOUBLE) AS fill FROM w),
g AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS here
  FROM f WINDOW b AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT here AS level FROM g WHERE fill >= here ORDER BY fill, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR fill < level THEN CAST(3 * source_size AS DOUBLE) ELSE level * weight END AS target
  FROM g LEFT JOIN l ON true),
r AS (
  SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY
      length(bin(size)) * 8 + ((size * 4) >> (length(bin(size)) - 1)),
      CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT), size, doc_id NULLS FIRST) - 1 AS rank
  FROM d),
c AS (
  SELECT r.doc_id, r.size, r.source, t.source_size, t.target, r.rank,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5('mix:' || coalesce(r.source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS seed
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
o AS (SELECT i, i / 32.0::DOUBLE AS step FROM range(32) x(i)),
a AS (SELECT source, i, any_value(seed + step) AS off, abs(sum((floor(rate * (rank + 1) + (seed + step)) - floor(rate * rank + (seed + step))) * size) - any_value(target)) AS gap FROM c, o GROUP BY 1, 2),
b AS (SELECT source, off FROM a QUALIFY row_number() OVER (PARTITION BY source ORDER BY gap, i) = 1)
SELECT doc_id, size, source_size, target, CAST(floor(rate * (rank + 1) + off) - floor(rate * rank + off) AS BIGINT) * size AS taken FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source
"""
