"""Order-dependent operators: folds, gaps, intervals, first declared instance, top-k."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import geometry as g


def numbered(df: DataFrame, group: list[str], order: list[Column | str], name: str, first: int = 1) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) + (first - 1))


def top(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; without a group, a distributed sort with a limit."""
    if not group:
        return df.orderBy(*order).limit(k)
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_r") <= k).drop("_r")


def folded(rows: DataFrame, group: str, order: str, inputs: list[str], start: Callable[[], Callable], name: str, kind: T.DataType) -> DataFrame:
    """``rows`` with a column that a state machine gives, row by row in this order, afresh for each group.

    ``start()`` makes the machine, a function of the inputs.  Rows are sorted within partitions and pass through as
    Arrow batches, so a task holds one batch and one state, never a whole group, and work is linear.
    """
    schema = T.StructType([*rows.schema, T.StructField(name, kind)])
    names = rows.columns

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target, current, machine = to_arrow_schema(schema), object(), None
        for batch in batches:
            out = []
            for key, *values in zip(*(batch.column(names.index(c)).to_pylist() for c in (group, *inputs))):
                if machine is None or key != current:
                    current, machine = key, start()
                out.append(machine(*values))
            yield pa.RecordBatch.from_arrays([*[batch.column(i).cast(target.field(i).type) for i in range(len(names))], pa.array(out, target.field(name).type)], schema=target)

    return rows.repartition(group).sortWithinPartitions(group, order).mapInArrow(run, schema)


def batching(most_pages: int, target: int) -> Callable:
    """Number of the batch that a group of these pages and segments goes to."""
    batch = pages = segments = 0

    def step(p: int, s: int) -> int:
        nonlocal batch, pages, segments
        if not batch or pages + p > most_pages or segments + s > target:
            batch, pages, segments = batch + 1, p, s
        else:
            pages, segments = pages + p, segments + s
        return batch

    return step


def first_fit(most: int) -> Callable:
    """Number of the earliest wave with room; a wave takes one high-risk batch.  Waves fill up in order, so two
    pointers find it: the first wave with room, and the first with room and no high-risk batch."""
    sizes: list[int] = []
    risky: list[bool] = []
    any_, calm = 0, 0

    def step(high: bool) -> int:
        nonlocal any_, calm
        while any_ < len(sizes) and sizes[any_] >= most:
            any_ += 1
        while calm < len(sizes) and (sizes[calm] >= most or risky[calm]):
            calm += 1
        at = calm if high else any_
        if at == len(sizes):
            sizes.append(0)
            risky.append(False)
        sizes[at] += 1
        risky[at] |= bool(high)
        return at + 1

    return step


def packed(groups: DataFrame, doc: str, ordinal: str, pages: str, segments: str, most_pages: int = 8, target: int = 80) -> DataFrame:
    """Batches of consecutive groups: a group opens a new batch when pages or segments would go over.

    A group that is over by itself stands alone and is marked.
    """
    out = folded(groups, doc, ordinal, [pages, segments], lambda: batching(most_pages, target), "batch", T.LongType())
    return out.withColumn("oversize", (F.col(pages) > most_pages) | (F.col(segments) > target))


def waves(batches: DataFrame, doc: str, batch: str, high: str, most: int = 4) -> DataFrame:
    """First-fit waves: each batch joins the earliest wave with room, and at most one high-risk batch per wave."""
    return folded(batches.select(doc, batch, high), doc, batch, [high], lambda: first_fit(most), "wave", T.IntegerType()).select(doc, batch, "wave")


def visible_intervals(subject_lo: Column, subject_hi: Column, occluders: Column) -> Column:
    """What occluders (array<struct<lo,hi>>) leave of a subject, as array<struct<lo,hi>>."""
    start = F.array(F.struct(subject_lo.cast("double").alias("lo"), subject_hi.cast("double").alias("hi")))

    def step(parts: Column, o: Column) -> Column:
        left = F.transform(parts, lambda p: F.struct(p["lo"].alias("lo"), F.least(p["hi"], o["lo"]).alias("hi")))
        right = F.transform(parts, lambda p: F.struct(F.greatest(p["lo"], o["hi"]).alias("lo"), p["hi"].alias("hi")))
        return F.filter(F.concat(left, right), lambda p: p["hi"] > p["lo"])

    return F.array_sort(F.aggregate(F.array_sort(occluders), start, step))


def against_first(instances: DataFrame, group: list[str], ordinal: str, metrics: list[str], delta: str) -> DataFrame:
    """Metrics that differ from the first declared instance's by more than the group's delta."""
    first = Window.partitionBy(*group).orderBy(ordinal).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = instances.withColumn("_base", F.first(F.struct(*metrics)).over(first))
    off = F.filter(F.array(*[F.when(F.abs(F.col(m) - F.col(f"_base.{m}")) > F.col(delta) + 1e-6, F.lit(m)) for m in metrics]), lambda x: x.isNotNull())
    return df.withColumn("mismatched", off).drop("_base").where(F.size("mismatched") > 0)


def gaps(items: DataFrame, group: list[str], ordinal: str, b: str, most: str, slack: float = 0.02) -> DataFrame:
    """Distance of each item to the one before it, and whether it lies in [-slack, most + slack]."""
    before = F.lag(F.col(f"{b}.x1")).over(Window.partitionBy(*group).orderBy(ordinal))
    gap = F.round(F.col(f"{b}.x0") - before, 6)
    return items.withColumn("gap", gap).where("gap is not null").withColumn("natural", (F.col("gap") >= -slack) & (F.col("gap") <= F.col(most) + slack))


def wrapped(widths: Column, limit: Column) -> Column:
    """Line number of each token when tokens of these widths fill lines greedily; a token wider than a line stands alone."""
    out = "array<int>"
    start = F.struct(F.lit(1).alias("line"), F.lit(0.0).alias("x"), F.array().cast(out).alias("out"))

    def step(a: Column, w: Column) -> Column:
        over = (a["x"] > 0) & (a["x"] + w > limit)
        line = F.when(over, a["line"] + 1).otherwise(a["line"])
        return F.struct(line.alias("line"), F.when(over, w).otherwise(a["x"] + w).cast("double").alias("x"), F.concat(a["out"], F.array(line)).cast(out).alias("out"))

    return F.aggregate(widths, start, step, lambda a: a["out"])


def fitted_size(widths: Column, box_width: Column, box_height: Column, source: Column, spacing: float = 1.18, step: float = 0.1) -> Column:
    """Largest size, in steps down to the floor, at which text of these widths (at size 1) fits; null if none does."""
    floor = g.font_floor(source)
    sizes = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((source - floor) / step + 1e-6), F.lit(0)).cast("int")), lambda i: F.round(source - i * step, 3))

    def fits(size: Column) -> Column:
        lines = F.array_max(wrapped(F.transform(widths, lambda w: w * size), box_width))
        return (F.coalesce(lines, F.lit(0)) * size * spacing <= box_height) & (F.coalesce(F.array_max(widths), F.lit(0.0)) * size <= box_width)

    return F.try_element_at(F.filter(sizes, fits), F.lit(1))
