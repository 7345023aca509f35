"""Positions in a total order without one task seeing more than a range of it.

A global row_number() moves all rows to one task.  Here rows are dealt to ranges of the order (Spark samples the
bounds), sorted within them, and numbered range by range; only the counts of the ranges, one for each partition, meet.
The order is total up to rows that agree in everything, so the result depends neither on how many ranges there are nor
on their bounds; a last key spreads rows that agree in everything, however many they are, over several ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.sources.scratch import Scratch

_ROWS = (1 << 33) - 1


def digest(key: Column, seed: str) -> Column:
    """The first 32 bits of md5; the same in any SQL engine.  A null key counts as an empty string."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def ranked(df: DataFrame, order: list[Column], name: str, scratch: Scratch) -> DataFrame:
    """``df`` with its 0-based position when sorted by ``order``.

    Rows that agree in ``order`` are in any order; let it name all that matters, so that the result as a bag of rows is
    the same in every run.
    """
    keys = [*order, F.col("_tie")]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    name_, n = f"{name}-{len(scratch.paths)}", 33
    # partition number above, row within it below; written, so that it is evaluated once
    placed = scratch.cut(dealt.withColumn("_at", F.monotonically_increasing_id()), f"placed-{name_}")
    part, row = F.shiftright("_at", n), F.col("_at").bitwiseAND(_ROWS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # one row for each partition
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = scratch.cut(counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start")), f"starts-{name_}")
    return placed.withColumn("_part", part).join(starts, "_part").withColumn(name, F.col("_start") + row).drop("_part", "_start", "_at")
