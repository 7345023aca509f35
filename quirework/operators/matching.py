"""Matchings that consume their partners: these keep state from row to row, so each group runs as one Arrow call.

Groups are small by nature (drawings of a page, images of one digest), and exact agreement is settled by joins
before any group is built; what is left in a group is what tolerance leaves open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def augmented(edges: dict, order: list) -> dict:
    """A maximum matching, left -> right, by augmenting paths; iterative, so that long paths don't nest calls."""
    owner: dict = {}
    for start in order:
        seen: set = set()
        path = [(start, iter(edges.get(start, ())))]
        taken: list = []
        while path:
            left, options = path[-1]
            for right in options:
                if right in seen:
                    continue
                seen.add(right)
                taken.append(right)
                if right in owner:
                    path.append((owner[right], iter(edges.get(owner[right], ()))))
                else:
                    for (who, _), what in zip(path, taken):
                        owner[what] = who
                    path = []
                break
            else:
                path.pop()
                if taken:
                    taken.pop()
    return {left: right for right, left in owner.items()}


def maximum_matching(pairs: DataFrame, group: str, left: str, right: str) -> DataFrame:
    """(group, left, right) of a maximum one-to-one matching over the candidate pairs of each group."""

    def match(table):
        import pyarrow as pa

        edges: dict = {}
        for a, b in sorted(set(zip(table.column(left).to_pylist(), table.column(right).to_pylist()))):
            edges.setdefault(a, []).append(b)
        found = sorted(augmented(edges, list(edges)).items())
        g = table.column(group)[0].as_py()
        return pa.table({group: pa.array([g] * len(found), table.schema.field(group).type), left: pa.array([x for x, _ in found], table.schema.field(left).type), right: pa.array([y for _, y in found], table.schema.field(right).type)})

    schema = pairs.select(group, left, right).schema
    return pairs.select(group, left, right).groupBy(group).applyInArrow(match, schema)


def unmatched(rows: DataFrame, matching: DataFrame, group: str, ident: str) -> DataFrame:
    return rows.join(matching.select(group, ident), [group, ident], "left_anti")


def greedy_nearest(pairs: DataFrame, group: str, left: str, right: str, distance: str) -> DataFrame:
    """Left rows in order, each taking its nearest free right row (ties to the smaller)."""

    def match(table):
        import pyarrow as pa

        options: dict = {}
        for a, b, d in zip(*(table.column(c).to_pylist() for c in (left, right, distance))):
            options.setdefault(a, []).append((d, b))
        used: set = set()
        found = []
        for a in sorted(options):
            free = [x for x in sorted(options[a]) if x[1] not in used]
            if free:
                used.add(free[0][1])
                found.append((a, free[0][1]))
        g = table.column(group)[0].as_py()
        return pa.table({group: pa.array([g] * len(found), table.schema.field(group).type), left: pa.array([x for x, _ in found], table.schema.field(left).type), right: pa.array([y for _, y in found], table.schema.field(right).type)})

    schema = pairs.select(group, left, right).schema
    return pairs.select(group, left, right, distance).groupBy(group).applyInArrow(match, schema)


def free_text_match(lines: DataFrame, spans: DataFrame, keys: list[str], line: str, span: str, text: str, centre_x: str, centre_y: str, box: str, size: str) -> DataFrame:
    """Rendered lines in order, each to exactly one unused span of equal text centred in its box (slack max(3, .35 size)).

    A line that no span or several free ones fit has no span and a code.  Groups run in order, one task each at a time.
    """
    slack = F.greatest(F.lit(3.0), F.col(size) * 0.35)
    b = F.col(box)
    near = (F.col(centre_x) >= b["x0"] - slack) & (F.col(centre_x) <= b["x1"] + slack) & (F.col(centre_y) >= b["y0"] - slack) & (F.col(centre_y) <= b["y1"] + slack)
    pairs = lines.join(spans.withColumnRenamed(text, "_text"), [*[lines[k] == spans[k] for k in keys], F.col(text) == F.col("_text"), near], "left").select(*[lines[k] for k in keys], line, span)
    grouped = pairs.withColumn("_g", F.to_json(F.struct(*keys)))

    def match(table):
        import pyarrow as pa

        options: dict = {}
        for a, b_ in zip(table.column(line).to_pylist(), table.column(span).to_pylist()):
            options.setdefault(a, []).extend([] if b_ is None else [b_])
        used: set = set()
        out = []
        for a in sorted(options):
            free = [x for x in options[a] if x not in used]
            used |= set(free) if len(free) == 1 else set()
            out.append((a, *((free[0], None) if len(free) == 1 else (None, "CANDIDATE_TEXT_SPAN_MATCH_COUNT"))))
        g = table.column("_g")[0].as_py()
        return pa.table({"_g": pa.array([g] * len(out), pa.string()), line: pa.array([x[0] for x in out], table.schema.field(line).type), span: pa.array([x[1] for x in out], table.schema.field(span).type), "code": pa.array([x[2] for x in out], pa.string())})

    schema = grouped.select("_g", line, span, F.lit(None).cast("string").alias("code")).schema
    found = grouped.select("_g", line, span).groupBy("_g").applyInArrow(match, schema)
    return grouped.select("_g", *keys).distinct().join(found, "_g").drop("_g")
