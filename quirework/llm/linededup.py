"""Line deduplication by pairwise alignment.

A document is one distinct (id, text); documents are in order of id, then of the text's digest.  Those that overlap
are found through shared rare lines: each line of at least ``least`` characters that several documents have names its
earliest holder, and a document is paired with the holders that its ``RAREST`` rarest shared lines name.  Each pair is
aligned by patience diff: lines that are unique in both anchor the longest increasing run, extended to its neighbours
and recursed between; where no line is unique, occurrences of equal lines are counted off against each other.  Lines
are equal if their 64-bit and 32-bit hashes and their lengths agree.  Aligned common blocks that hold at least
``least`` characters are deleted from the later document.

The result is that of alignment with every earlier document that shares a run of lines with ``least`` characters: what
a round leaves is paired through such runs (see _windows; the lines of a run may each be short) with the next holder of
each run, for ROUNDS rounds, then with all others.

Skew: pairs go from each document to single holders of a line or run, so one that a third of all rows have makes one
pair for each in a round, never all pairs of its group (the last round does pair what no round before it could delete
with all holders that are left; of holders that look alike to what is left, one: see _others); minima and counts are combined before
the shuffle, and joins against one row per line or document let Spark split the hot side.

Edge cases: a null text has no lines and stays null; blank and short lines pair documents only as part of a run; equal
rows are one document and lose the same lines; rows that repeat an id with other texts are documents of their own, in
order of their digests; null ids come first; an empty table gives an empty result; columns that clash with the result's
names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm._rank import ranked
from quirework.sources.scratch import Scratch

LEAST = 20
#: Rounds that try one more holder of each run that is left, before all others are tried at once.
ROUNDS = 4
#: Holders that a document is paired with in the first round, those of its rarest lines.
RAREST = 4
#: Pairs that rare lines may make in the last round, for each line of the documents that it pairs.
PARTNERS = 8
#: The lower half of a line's second number is its length, the upper a hash.
_LENGTH = 0xFFFFFFFF


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned equal positions (i, j), both increasing."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, n = todo.pop()
        while i < k and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < n and a[k - 1] == b[n - 1]:
            k, n = k - 1, n - 1
            out.append((k, n))
        if i >= k or j >= n:
            continue
        places: dict = {}
        for x in range(i, k):
            places.setdefault(a[x], [0, 0, 0, 0])
            places[a[x]][0] += 1
            places[a[x]][1] = x
        for y in range(j, n):
            if a_ := places.get(b[y]):
                a_[2] += 1
                a_[3] = y
        anchors = increasing(sorted((p[1], p[3]) for p in places.values() if p[0] == p[2] == 1)) or counted_off(a, b, i, k, j, n)
        if not anchors:
            continue
        out += anchors
        edges = [(i - 1, j - 1), *anchors, (k, n)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(out)


def counted_off(a: list, b: list, i: int, k: int, j: int, n: int) -> list[tuple[int, int]]:
    """Anchors where no line is unique in both: the first occurrence of a line here with its first there, and so on."""
    there: dict = {}
    for y in range(n - 1, j - 1, -1):
        there.setdefault(b[y], []).append(y)
    pairs = [(x, there[a[x]].pop()) for x in range(i, k) if there.get(a[x])]
    return increasing(pairs)


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs with increasing second members, by patience sorting."""
    from bisect import bisect_left

    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for x, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back[x] = at[p - 1] if p else -1
        if p == len(tops):
            tops.append(j)
            at.append(x)
        else:
            tops[p], at[p] = j, x
    out, x = [], at[-1] if at else -1
    while x >= 0:
        out.append(pairs[x])
        x = back[x]
    return out[::-1]


def removed(later: list, earlier: list, sizes: list[int], least: int = LEAST) -> list[int]:
    """Line numbers of ``later`` in aligned common blocks that hold at least ``least`` characters."""
    out: list[int] = []
    run: list[int] = []
    before = (-2, -2)
    for i, j in [*patience(later, earlier), (-9, -9)]:
        if (i - 1, j - 1) != before:
            if sum(sizes[x] for x in run) >= least:
                out += run
            run = []
        run.append(i)
        before = (i, j)
    return out


def _aligning(least: int):
    def align(batches) -> Iterator:
        """(later, its lines, their second numbers, both of the earlier) -> (doc, lines to delete)."""
        import pyarrow as pa

        for batch in batches:
            docs, cut = batch.column(0), []
            for later, sizes, earlier, others in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4))):
                cut.append(removed(list(zip(later, sizes)), list(zip(earlier, others)), [x & _LENGTH for x in sizes], least))
            yield pa.RecordBatch.from_arrays([docs, pa.array(cut, pa.list_(pa.int32()))], ["doc", "cut"])

    return align


def _windows(least: int, leftover: bool):
    """(doc, sizes, lines[, cut]) -> (doc, line): a key for each shortest run of lines from a line on, or up to it,
    that holds ``least`` characters; with cut, only runs that hold a line outside it."""
    odd, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def powers(base: int, n: int):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])

    def windows(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            docs, sizes, lines = batch.column(0), batch.column(1), batch.column(2)
            counts = np.diff(sizes.offsets.to_numpy())
            size, line = sizes.flatten().to_numpy() & _LENGTH, lines.flatten().to_numpy().view(np.uint64)
            n = len(size)
            first = np.repeat(np.cumsum(counts) - counts, counts)
            last = first + np.repeat(counts, counts)
            at = np.arange(n)
            chars = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(line * powers(odd, n)[:n], dtype=np.uint64)])
            shift = powers(inverse, n)
            ends = np.searchsorted(chars, chars[at] + least)  # first end with enough characters from each line on
            starts = np.searchsorted(chars, chars[at + 1] - least, "right") - 1  # last start with enough up to each line
            begin = np.concatenate([at[ends <= last], starts[starts >= first]])
            end = np.concatenate([ends[ends <= last], at[starts >= first] + 1])
            if leftover:
                cuts, kept = batch.column(3), np.ones(n, np.int64)
                kept[cuts.flatten().to_numpy() + np.repeat(np.cumsum(counts) - counts, np.diff(cuts.offsets.to_numpy()))] = 0
                left = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])
                good = left[end] > left[begin]
                begin, end = begin[good], end[good]
            key = ((sums[end] - sums[begin]) * shift[begin]).view(np.int64)
            row = np.repeat(np.arange(len(counts)), counts)[begin]
            both = np.unique(np.stack([row, key]), axis=1) if len(row) else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([docs.take(pa.array(both[0])), pa.array(both[1])], ["first" if not leftover else "doc", "line"])

    return windows


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` and n_lines, n_removed, kept_text."""
    s = Scratch(docs.sparkSession, "lines")
    docs = docs.drop("n_lines", "n_removed", "kept_text")
    lines, digest = F.split(F.col(text), "\n"), F.unhex(F.md5(F.col(text).cast("binary")))
    second = lambda x: F.shiftleft(F.hash(x).cast("long"), 32).bitwiseOR(F.length(x).cast("long"))
    own = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("id"), digest.alias("v"), F.transform(lines, lambda x: F.xxhash64(F.trim(x))).alias("lines"), F.transform(lines, lambda x: second(F.trim(x))).alias("sizes"))
    placed = ranked(s.cut(own, "hashes").dropDuplicates(["id", "v"]), [F.col("id"), F.col("v")], "doc", s)
    one = s.cut(placed.select("doc", "lines", "sizes", "id", "v"), "lines")
    s.drop("hashes")
    ids, one = one.select("doc", "id", "v"), one.select("doc", "lines", "sizes")
    each = one.select("doc", F.explode(F.array_distinct(F.filter(F.arrays_zip("lines", "sizes"), lambda x: x["sizes"].bitwiseAND(_LENGTH) >= least)["lines"])).alias("line"))
    firsts = s.cut(each.groupBy("line").agg(F.min("doc").alias("first"), F.count("*").alias("df")).where("df > 1"), "firsts")
    pairs = each.join(firsts, "line").where("doc > first").groupBy("doc", "first").agg(F.min("df").alias("rarest"))
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("rarest", "first"))), 1, RAREST)  # of one document's lines
    pairs = s.cut(pairs.groupBy("doc").agg(rarest.alias("p")).select("doc", F.explode("p.first").alias("first")), "pairs")
    s.drop("firsts")

    def aligned(pairs: DataFrame) -> DataFrame:
        later = pairs.join(one, "doc")
        both = later.join(one.select(F.col("doc").alias("first"), F.col("lines").alias("first_lines"), F.col("sizes").alias("first_sizes")), "first").select("doc", "lines", "sizes", "first_lines", "first_sizes")
        return both.mapInArrow(_aligning(least), "doc long, cut array<int>").where("size(cut) > 0")

    def union(cuts: DataFrame) -> DataFrame:
        return cuts.groupBy("doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"))

    cuts, done, bound = s.cut(union(aligned(pairs)), "first_cuts"), pairs, None
    holders = s.cut(_holders(s, one, cuts, least), "holders")
    later = s.cut(one.join(s.cut(_shared_left(s, one, cuts, holders, least), "open"), "doc"), "later")
    for k in range(ROUNDS + 1):
        left = s.cut(_left(later, cuts, least), f"left{k}")
        if k < ROUNDS:  # the next holder of each run
            some = holders if bound is None else holders.join(bound, "line").where("first > bound")
            bound = s.cut(some.groupBy("line").agg(F.min("first").alias("bound")), f"bound{k}")
            some = bound.withColumnRenamed("bound", "first")
            more = left.join(some, "line").where("doc > first").select("doc", "first")
        else:  # all others
            more = _others(s, one, left, holders.join(bound, "line").where("first > bound").select("first", "line"))
        more = s.cut(more.distinct().join(done, ["doc", "first"], "left_anti"), f"further{k}")
        done = done.unionByName(more)
        cuts = s.cut(union(cuts.unionByName(aligned(more))), f"cuts{k}")
    cuts = s.cut(cuts.join(ids, "doc").select(F.col("id").alias("_id"), F.col("v").alias("_v"), F.col("cut").alias("_cut")), "cuts")
    out = docs.join(cuts.hint("merge"), F.col(doc_id).eqNullSafe(F.col("_id")) & (digest == F.col("_v")), "left")  # shuffled at any size
    gone = F.coalesce("_cut", F.array().cast("array<int>"))
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")
    return out.withColumns({"n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"), "n_removed": F.size(gone).cast("long"), "kept_text": F.when(F.size(gone) == 0, F.col(text)).otherwise(kept)}).drop("_id", "_v", "_cut")


def _left(later: DataFrame, cuts: DataFrame, least: int) -> DataFrame:
    """(doc, line): the runs of later documents that hold lines outside the cuts."""
    x = later.join(cuts, "doc", "left").select("doc", "sizes", "lines", F.coalesce("cut", F.array().cast("array<int>")).alias("cut"))
    return x.mapInArrow(_windows(least, True), "doc long, line long")


def _holders(s: Scratch, one: DataFrame, cuts: DataFrame, least: int) -> DataFrame:
    """(first, line): the documents that hold a run which the cuts leave over in a later one.

    A line is in an aligned block with an earlier document only if one of the runs of _windows() that hold the line
    stands in both.  Of documents with equal lines only the earliest is needed.
    """
    alike = one.groupBy(F.xxhash64("lines").alias("x"), F.xxhash64("sizes").alias("y")).agg(F.min("doc").alias("doc"))
    holders = one.join(alike.select("doc"), "doc").select("doc", "sizes", "lines").mapInArrow(_windows(least, False), "first long, line long")
    left = s.cut(_left(one, cuts, least), "left")
    shared = left.groupBy("line").agg(F.max("doc").alias("last"))
    return holders.join(shared, "line").where("first < last").select("first", "line")


def _shared_left(s: Scratch, one: DataFrame, cuts: DataFrame, holders: DataFrame, least: int) -> DataFrame:
    """(doc): documents of which a run that the cuts leave over has an earlier holder."""
    left = s.spark.read.parquet(s.paths["left"])
    out = left.join(holders.groupBy("line").agg(F.min("first").alias("first")), "line").where("doc > first").select("doc").distinct()
    return out


def _others(s: Scratch, one: DataFrame, left: DataFrame, holders: DataFrame) -> DataFrame:
    """(doc, first): pairs that stand for all of documents with runs left and earlier holders of these runs.

    Of a holder, only lines of the later document can be aligned; what stands between them is a gap that matches
    nothing, whatever it holds, so holders with the same such lines and gaps are aligned in the same way.  A document
    is paired with all holders with which it shares a rare line, and of holders that look alike when only common lines
    of its own count, with the earliest; if that is one of these, then with the earliest that is not, of each look that
    they have when all common lines count.  Lines are rare up to that number of holders at which rare lines
    make PARTNERS pairs for each line of the later documents.
    """
    left = s.cut(left.join(holders.groupBy("line").agg(F.min("first").alias("low")), "line").where("doc > low").select("doc", "line"), "runs")
    own = s.cut(one.join(left.select("doc").distinct(), "doc").select("doc", F.explode(F.array_distinct("lines")).alias("x")), "own")
    known = own.groupBy("x").agg(F.max("doc").alias("last"), F.count("*").alias("docs"))
    held = one.withColumnRenamed("doc", "first").join(holders.select("first").distinct(), "first")
    held = held.select("first", F.size("lines").alias("n"), F.posexplode("lines").alias("at", "x"))
    at = s.cut(held.join(known, "x").where("first < last").select("first", "n", "at", "x", "docs"), "held")

    kinds = s.cut(at.select("first", "x", "docs").distinct().groupBy("x", "docs").agg(F.count("*").alias("firsts")), "kinds")
    level = F.length(F.bin("firsts"))
    made, rare, room = kinds.groupBy(level.alias("level")).agg(F.sum(F.col("docs") * F.col("firsts")).alias("n")), 0, PARTNERS * own.count()
    for r in sorted(made.collect()):  # one row for each power of two
        room -= r["n"]
        if room < 0:
            break
        rare = r["level"]
    partners = own.join(kinds.where(level <= rare).select("x"), "x").join(at.select("first", "x"), "x").where("doc > first").select("doc", "first").distinct()
    partners = s.cut(partners, "partners")

    common = kinds.where(level > rare).select("x")
    at = at.join(common, "x").groupBy("first", "n").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("a"))
    gap = F.lit(None).cast("long")
    gone = lambda p, i: F.when(i == 0, p["at"] > 0).otherwise(p["at"] - F.get("a", i - 1)["at"] > 1)
    seq = F.flatten(F.transform("a", lambda p, i: F.when(gone(p, i), F.array(gap, p["x"])).otherwise(F.array(p["x"]))))
    seq = F.when(F.element_at("a", -1)["at"] < F.col("n") - 1, F.concat(seq, F.array(gap))).otherwise(seq)
    name = lambda x: F.sha2(F.array_join(F.col(x).cast("array<string>"), ",", "-").cast("binary"), 256)
    looks = s.cut(at.select("first", seq.alias("seq")).withColumn("look", name("seq")), "looks")
    kins = own.join(common, "x").groupBy("doc").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    kins = s.cut(kins.withColumn("kin", name("xs")), "kins")  # later documents with the same common lines

    near = left.join(kins, "doc").select("kin", "line").distinct()
    near = near.join(holders.join(looks, "first").select("line", "look").distinct(), "line").select("kin", "look").distinct()
    near = near.join(kins.groupBy("kin").agg(F.first("xs").alias("xs")), "kin")
    near = near.join(looks.groupBy("look").agg(F.first("seq").alias("seq"), F.min("first").alias("low")), "look")
    near = near.withColumn("seq", F.transform("seq", lambda x: F.when(F.array_contains("xs", x), x)))
    near = near.withColumn("seq", F.filter("seq", lambda x, i: x.isNotNull() | (i == 0) | F.get("seq", i - 1).isNotNull()))
    near = s.cut(near.select("kin", "look", "low", name("seq").alias("view")), "near")  # as these documents see the look
    seen = kins.select("doc", "kin").join(near.groupBy("kin", "view").agg(F.min("low").alias("first")), "kin").where("doc > first")
    seen = s.cut(seen, "seen")
    alike = seen.join(partners, ["doc", "first"], "left_semi").join(near, ["kin", "view"]).where("doc > low").select("doc", "look")
    alike = s.cut(alike, "alike")

    taken = s.cut(partners.join(looks, "first").join(alike, ["doc", "look"]).select("doc", "look", "first"), "taken")
    most = 1 + (taken.groupBy("doc", "look").count().agg(F.max("count")).first()[0] or 0)
    places = looks.withColumn("place", F.row_number().over(Window.partitionBy("look").orderBy("first"))).where(F.col("place") <= most)
    places = s.cut(places, "places")
    full = taken.join(places, ["look", "first"]).groupBy("doc", "look").agg(F.collect_set("place").alias("full"))
    free = F.array_min(F.array_except(F.sequence(F.lit(1), F.size("full") + 1), "full"))
    next_ = alike.join(full, ["doc", "look"], "left").select("doc", "look", F.coalesce(free, F.lit(1)).alias("place"))
    next_ = next_.join(places, ["look", "place"]).where("doc > first").select("doc", "first")
    return partners.unionByName(seen.select("doc", "first")).unionByName(next_)
