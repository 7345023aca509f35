"""Exact self-join of documents on the Jaccard similarity of their word n-grams, down to connected components.

Two documents link when 100 * |A n B| >= 75 * |A u B| for their sets of distinct 5-word shingles.  Steps:

1. Each text becomes its sorted set of 64-bit shingle hashes; equal sets (a 128-bit digest) form one class, with
   its smallest id as representative.  Copies are never paired with each other.
2. Shingles are ordered rare first.  Rarity comes from counts over all documents, summed into a fixed number of
   hashed counters (the one thing that is broadcast, 2 MB at any input); any total order keeps the filter exact,
   so a shared counter costs speed and never a link.
3. Only the prefix, n - ceil(.75 n) + 1 rarest shingles, is indexed.  Postings (shingle, digest, position) travel as
   packed arrays by hash bucket; those of shingles that one class alone has end there, so what goes on is the small
   part of prefixes that other texts share.  A shingle that is frequent within a batch sends one marker to its
   bucket, so a bucket holds at most one entry of it for each batch.
4. A group of near copies would give all its pairs.  Hub rounds come first: each document samples a few of its shared
   prefix shingles (those of the smallest hashes, on which near copies agree) and is verified against one hub, the
   holder with most shared prefix shingles; links are closed to components.
   Rounds go on while they link a share of what was linked before.
5. Then components meet: postings are counted by (shingle, component), and components that share a prefix shingle and
   pass the length and positional filter (what can follow the shared shingle in both must reach the required overlap)
   are tried by one pair each.
6. Last, what is left: components that still meet are expanded to pairs of their documents, so that no link between
   components is lost.  No two documents of one component are ever paired.
   Each pair passes the suffix filter (bitmaps of parities in hash ranges bound from below how many shingles only one
   of the two has) and is verified once on the whole sets.

Edge cases: a null or wordless text has an empty set and is linked with nothing (its component is its own id); a text
of one to four words is one shingle; rows that repeat an id are one node, linked by all of their texts; a null id takes
the component of its text's class; ids are integers (others raise at the cast); extra columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm import _text as tx
from quirework.operators.graph import merged
from quirework.sources.scratch import Scratch

K = 5
#: The similarity 3/4 as a fraction.
OVER, UNDER = 3, 4
SKETCH_BITS = 20
PART_BITS = 14
ENTRIES_A_BUCKET = 200_000
#: Postings that a task gathers before it sends them on.
FLUSH = 400_000
#: Shared prefix shingles that a document takes to a hub round.
SAMPLED = 8
#: Shingles for which a bitmap has 64 parities, or more.
RANGES = 48
#: Hubs are tried again if a round has linked one pair for so many links before.
WORTH = 20
#: Bits of shingle and digest hashes in postings; equal bits of different shingles cost a comparison, never a link.
POSTING_BITS = 48
_MARK = np.uint32(1 << 31)
_LOW = np.uint64((1 << POSTING_BITS) - 1)
_ONE, _TWO = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def shingles(data, offsets, first: int, last: int, k: int = K):
    """Sorted distinct shingle hashes of rows first..last-1: (hash, row, count by row)."""
    w = tx.words_of(data, offsets, first, last, tx.BLACK)
    h, row = tx.shingle_hashes(tx.word_hashes(w), w.row, w.count, k)
    return tx.distinct_in_rows(h, row, last - first)


def digest(h: np.ndarray, starts: np.ndarray, salt: np.uint64) -> np.ndarray:
    """64-bit digest of each set; ``starts`` are where non-empty sets begin."""
    return np.add.reduceat(tx.mixed(h ^ salt), starts)


def bitmaps(h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, whether the number of its shingles in each of 64 * words hash ranges is odd: (words, their offsets).

    A row has the power of two of words next to its size / RANGES; ranges are remainders, so of two sizes the larger
    bitmap folds to the smaller by exclusive or of its halves.
    """
    words = np.where(count > 0, 1 << np.ceil(np.log2(np.maximum(count / RANGES, 1))).astype(np.int64), 0)
    offsets = np.concatenate(([0], np.cumsum(words)))
    wide = np.repeat(64 * words, count).astype(np.uint64)
    at = np.repeat(64 * offsets[:-1], count) + ((h >> np.uint64(20)) % np.maximum(wide, np.uint64(1))).astype(np.int64)
    odd = np.bincount(at, minlength=64 * int(offsets[-1])) & 1
    return np.packbits(odd.astype(bool)).view(np.int64), offsets


def _reading(k: int):
    """(doc_id, text) -> a row (n, d1, d2) for each document, and this task's counters in parts."""

    def read(batches) -> Iterator:
        import pyarrow as pa

        counters, shift = np.zeros(1 << SKETCH_BITS, np.uint32), np.uint64(64 - SKETCH_BITS)
        names = ["doc_id", "n", "d1", "d2", "part", "counts", "bits"]
        held: list[np.ndarray] = []

        def count_held():
            if held:
                np.add(counters, np.bincount(np.concatenate(held), minlength=len(counters)).astype(np.uint32), out=counters)
                held.clear()

        for batch in batches:
            data, offsets = tx.flat(batch.column(1))
            rows = batch.num_rows
            n, d1, d2 = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            bits, ends = [], [np.zeros(1, np.int64)]
            for first, last in tx.chunks(offsets):
                h, row, count = shingles(data, offsets, first, last, k)
                n[first:last] = count
                words, at = bitmaps(h, count)
                bits.append(words)
                ends.append(at[1:] + ends[-1][-1])
                if len(h):
                    held.append((h >> shift).astype(np.int32))
                    if len(held) >= 32:
                        count_held()
                    some = np.flatnonzero(count)
                    at = (np.cumsum(count) - count)[some]
                    d1[first + some], d2[first + some] = digest(h, at, _ONE), digest(h, at, _TWO)
            none = pa.nulls(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), none.cast(pa.int32()), none.cast(pa.binary()), pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64)))], names)
        count_held()
        parts = counters.reshape(-1, 1 << PART_BITS)
        some = [i for i in range(len(parts)) if parts[i].any()]
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary()), pa.nulls(len(some), pa.list_(pa.int64()))], names)

    return tx.tidy(read)


def _summing(batches) -> Iterator:
    """Streams the partial counters of the parts that this task holds."""
    import pyarrow as pa

    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = sums.setdefault(part, np.zeros(1 << PART_BITS, np.uint64))
            own += np.frombuffer(counts.as_buffer(), np.uint32)
    ranks = [np.minimum(4095, np.round(64 * np.log2(x + 1.0))).astype(np.uint16).tobytes() for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())], ["part", "ranks"])


def keyed(h: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Sort keys: 12 bits of rarity, then 52 bits of the hash."""
    return (ranks[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(52)) | (h & np.uint64((1 << 52) - 1))


def _indexing(ranks, buckets: int, k: int):
    """(text) -> (bucket, packed prefix postings)."""

    def packed(found: list, turn: int):
        import pyarrow as pa

        token, node, pos = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(token)
        token, node, pos = token[order], node[order], pos[order]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        shared = ~(np.append(new[1:], True) & new)  # in at least two classes of this batch
        out = [(-1 - turn % buckets, pack(token[shared], node[shared], pos[shared]))] if shared.any() else []
        token, node, pos = token[new], node[new], np.where(shared[new], pos[new] | _MARK, pos[new])
        cuts = np.searchsorted(token.astype(float) * (buckets / float(1 << POSTING_BITS)), np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[b], cuts[b + 1])
            out.append((b, pack(token[own], node[own], pos[own])))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["bucket", "postings"])

    def index(batches) -> Iterator:
        from pyspark import TaskContext

        table, turn = ranks.value, TaskContext.get().partitionId()
        found, held, known = [], 0, set()
        for batch in batches:
            data, offsets = tx.flat(batch.column(0))
            for first, last in tx.chunks(offsets):
                h, row, count = shingles(data, offsets, first, last, k)
                if not len(h):
                    continue
                some = np.flatnonzero(count)
                d1 = np.zeros(last - first, np.uint64)
                d1[some] = digest(h, (np.cumsum(count) - count)[some], _ONE)
                once = np.zeros(last - first, bool)  # copies count once
                for i, d in zip(some.tolist(), d1[some].tolist()):
                    once[i] = d not in known
                    known.add(d)
                own = once[row]
                key, row, count = tx.distinct_in_rows(keyed(h[own], table), row[own], last - first)
                pos = np.arange(len(key)) - np.repeat(np.cumsum(count) - count, count)
                n = count[row]
                keep = pos < n - (OVER * n + UNDER - 1) // UNDER + 1
                found.append((key[keep] & _LOW, d1[row[keep]] & _LOW, pos[keep].astype(np.uint32)))
                held += len(found[-1][0])
                if held >= FLUSH:
                    yield packed(found, turn)
                    found, held, known, turn = [], 0, set(), turn + 1
        if held:
            yield packed(found, turn)

    return tx.tidy(index)


def pack(token: np.ndarray, node: np.ndarray, pos: np.ndarray) -> bytes:
    """6 + 6 + 4 bytes a posting, the bytes of positions apart, so that the high ones compress."""
    low = lambda x: x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return low(token) + low(node) + pos.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(raw) -> tuple[np.ndarray, ...]:
    m = len(raw) // 16
    bytes_ = np.frombuffer(raw, np.uint8, 16 * m)
    wide = np.zeros((2, m, 8), np.uint8)
    wide[:, :, :6] = bytes_[: 12 * m].reshape(2, m, 6)
    token, node = wide.view("<u8")[:, :, 0]
    return token, node, np.ascontiguousarray(bytes_[12 * m :].reshape(4, m).T).view("<u4")[:, 0]


def _unpacked(blobs) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(x) for x in zip(*(unpack(blob.as_buffer()) for blob in blobs)))


def _shared(table):
    """One bucket -> postings of the shingles that at least two classes have."""
    import pyarrow as pa

    key, node, pos = _unpacked(table.column("postings").combine_chunks())
    if table.column("bucket")[0].as_py() >= 0:
        order = np.lexsort((pos & _MARK, node, key))  # of copies the marked ones come last
        key, node, pos = key[order], node[order], pos[order]
        last = np.ones(len(key), bool)
        last[:-1] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, pos = key[last], node[last], pos[last]
        marked = pos >= _MARK
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        group = np.cumsum(first) - 1
        weight = np.bincount(group, weights=1.0 + marked)
        keep = (weight[group] >= 2) & ~marked
        key, node, pos = key[keep], node[keep], pos[keep]
    return pa.table({"token": pa.array(key.view(np.int64)), "node": pa.array(node.view(np.int64)), "pos": pa.array(pos.astype(np.int32))})


def _sets(k: int):
    """(doc_id, text) -> (doc, two digests, shingle set), in batches of about a chunk of text."""

    def sets(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, offsets = tx.flat(batch.column(1))
            for first, last in tx.chunks(offsets):
                h, row, count = shingles(data, offsets, first, last, k)
                at = np.concatenate(([0], np.cumsum(count)))
                d, some = np.zeros((2, last - first), np.uint64), np.flatnonzero(count)
                if len(some):
                    d[0, some], d[1, some] = digest(h, at[:-1][some], _ONE), digest(h, at[:-1][some], _TWO)
                whole = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(d[0].view(np.int64)), pa.array(d[1].view(np.int64)), whole], ["doc", "d1", "d2", "set"])

    return tx.tidy(sets)


def required(n: Column, m: Column) -> Column:
    """Least overlap of linked sets of these sizes: ceil(t / (1 + t) * (n + m))."""
    return F.ceil((n + m) * OVER / F.lit(float(OVER + UNDER)) - 1e-9)


def compatible(n: Column, p: Column, m: Column, q: Column) -> Column:
    """Length and positional filter for a shingle at position p of n and q of m."""
    return (UNDER * n >= OVER * m) & (UNDER * m >= OVER * n) & (F.least(n - p, m - q) >= required(n, m))


def shared_prefix(n: Column, m: Column) -> Column:
    """Least number of shingles that the prefixes of a linked pair of these sizes share.

    Of the p rarest of n, at most n minus the required overlap aren't common; the common ones in either prefix are the
    first of one ordered list, so both prefixes hold the shorter of the two beginnings.
    """
    prefix = lambda x: x - F.ceil(x * OVER / F.lit(float(UNDER))) + 1
    least = F.least(prefix(n) - n + required(n, m), prefix(m) - m + required(n, m))
    return F.greatest(least, F.lit(1))


def close(a: str, b: str) -> Column:
    """Suffix filter: ranges whose parities differ are a lower bound of the shingles that only one of the two has."""
    x, y = F.col(f"bits_{a}"), F.col(f"bits_{b}")

    def folded(p: Column, q: Column) -> Column:  # sizes of linked sets differ by a third at most, widths by one fold
        half = F.size(q)
        return F.when(F.size(p) > half, F.zip_with(F.slice(p, F.lit(1), half), F.slice(p, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(p)

    differ = F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, n: s + n)
    n, m = F.col(f"n_{a}"), F.col(f"n_{b}")
    return (UNDER * n >= OVER * m) & (UNDER * m >= OVER * n) & (differ <= n + m - 2 * required(n, m))


def ends(pairs: DataFrame) -> DataFrame:
    """(doc_id) of either side, each side's repeats gone before they meet."""
    side = lambda c: pairs.groupBy(F.col(c).alias("doc_id")).agg(F.lit(1).alias("_"))
    return side("a").union(side("b")).select("doc_id").distinct()


class Verifier:
    """Pairs are measured on whole sets, once each; what was measured stays known."""

    def __init__(self, docs: DataFrame, own: DataFrame, scratch: Scratch, k: int, repeats: bool):
        self.docs, self.own, self.scratch, self.k, self.repeats = docs, own, scratch, k, repeats
        self.found: DataFrame | None = None

    def near(self, pairs: DataFrame, tag: str) -> DataFrame:
        """Pairs (a < b, and other columns) that pass the suffix filter."""
        s = self.scratch
        pairs = s.cut(pairs, f"near-{tag}")
        ids = s.cut(ends(pairs), f"near-ids-{tag}")
        bits = self.own.join(ids, "doc_id", "left_semi")
        if self.repeats:
            bits = bits.dropDuplicates(["doc_id", "d1", "d2"])
        side = lambda x: bits.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
        out = pairs.join(side("a"), "a").join(side("b"), "b").where(close("a", "b")).select(*pairs.columns)
        return out.dropDuplicates(["a", "b"]) if self.repeats else out

    def new(self, pairs: DataFrame) -> DataFrame:
        """Pairs that weren't measured."""
        return pairs if self.found is None else pairs.join(self.found.select("a", "b"), ["a", "b"], "left_anti")

    def measure(self, pairs: DataFrame, tag: str) -> DataFrame:
        """Verify distinct pairs (a, b): (a, b) of those that are linked."""
        s = self.scratch
        pairs = s.cut(pairs.select("a", "b"), f"pairs-{tag}")
        ids = s.cut(ends(pairs), f"ids-{tag}")
        sets = self.docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets(self.k), "doc long, d1 long, d2 long, set array<long>")
        sets = s.cut(sets.dropDuplicates(["doc", "d1", "d2"]) if self.repeats else sets, f"sets-{tag}")
        x, y = (sets.select(F.col("doc").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
        both = pairs.join(x, "a").join(y, "b").select("a", "b", F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("overlap"), (F.size("set_a") + F.size("set_b")).alias("sum"))
        now = s.cut(both.select("a", "b", (100 * F.col("overlap") >= 75 * (F.col("sum") - F.col("overlap"))).alias("linked")), f"measured-{tag}")
        s.drop(f"pairs-{tag}", f"ids-{tag}", f"sets-{tag}")
        self.found = now if self.found is None else self.found.union(now)
        return now.where("linked").select("a", "b")


def hub_pairs(shared: DataFrame, of: DataFrame | None, r: int, scratch: Scratch) -> DataFrame:
    """(a, b): each document with the one hub that most of its sampled shingles name; hubs of other components only.

    Only documents that share as many prefix shingles as a link with an equally long text takes are sampled: what is
    left out here is left to the last step.  In the first round the holder with most shared prefix shingles is the hub
    (of near copies, one next to their origin), later any holder.
    """
    some = F.slice(F.array_sort(F.transform("e", lambda p: F.struct(F.xxhash64(p["token"]).alias("h"), p["token"].alias("token"), p["pos"].alias("pos")))), 1, SAMPLED)
    docs = placed(shared.where(F.size("e") >= shared_prefix(F.col("n"), F.col("n"))), of).select("doc", "n", "comp", F.size("e").alias("w"), F.explode(some).alias("p"))
    each = scratch.cut(docs.select("doc", "n", "comp", "w", "p.token", "p.pos"), f"sample-{r}")
    order = F.struct(*([-F.col("w")] if not r else []), F.xxhash64("doc", F.lit(r)))
    hubs = each.groupBy("token").agg(F.min(F.struct(order.alias("o"), "doc", "n", "pos", "comp")).alias("h"))
    near = each.join(hubs, "token").where((F.col("comp") != F.col("h.comp")) & compatible(F.col("n"), F.col("pos"), F.col("h.n"), F.col("h.pos")))
    near = near.groupBy("doc", F.col("h.doc").alias("hub")).count()
    best = near.groupBy("doc").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    return best.select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b")).distinct()


def placed(shared: DataFrame, of: DataFrame | None) -> DataFrame:
    """With each document's component so far, and whether it is alone in it."""
    if of is None:
        return shared.withColumns({"comp": F.col("doc"), "alone": F.lit(True)})
    out = shared.join(of, F.col("doc") == F.col("node"), "left")
    return out.withColumns({"comp": F.coalesce("component", "doc"), "alone": F.col("component").isNull()}).drop("node", "component")


def meetings(entries: DataFrame, of: DataFrame | None, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(postings of shingles that two components share; (token, comp_a, comp_b, one_a, one_b) where these meet).

    ``one`` is a posting of the component at the shingle: its only one if the component is one document.  Components meet where the length and positional filter lets any of their documents through.
    """
    flat = placed(entries, of)
    open_ = flat.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    open_ = scratch.cut(open_, "open")  # apart from the join, so that a hot shingle's postings can be split there
    flat = scratch.cut(flat.join(open_, "token", "left_semi").select("doc", "n", "token", "pos", "comp", "alone"), "entries")
    one = F.min(F.struct(F.xxhash64("doc").alias("o"), "doc", "n", "pos", "alone"))
    groups = flat.groupBy("token", "comp").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("pos")).alias("room"), F.count("*").alias("docs"), one.alias("one"))
    x, y = (groups.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("comp", "lo", "hi", "room", "docs", "one")]) for side in "ab")
    reach = (UNDER * F.col("hi_a") >= OVER * F.col("lo_b")) & (UNDER * F.col("hi_b") >= OVER * F.col("lo_a")) & (F.least("room_a", "room_b") >= required(F.col("lo_a"), F.col("lo_b")))
    met = x.join(y, "token").where((F.col("comp_a") < F.col("comp_b")) & reach).select("token", "comp_a", "comp_b", "one_a", "one_b", "docs_a", "docs_b")
    return flat, scratch.cut(met, "met")


def pair_of(x: Column, y: Column) -> list[Column]:
    return [F.least(x["doc"], y["doc"]).alias("a"), F.greatest(x["doc"], y["doc"]).alias("b")]


def first_pairs(met: DataFrame) -> DataFrame:
    """(a, b): one pair of each two components, that with most shared shingles among the postings chosen."""
    x, y = F.col("one_a"), F.col("one_b")
    each = met.where(compatible(x["n"], x["pos"], y["n"], y["pos"])).select("comp_a", "comp_b", *pair_of(x, y)).groupBy("comp_a", "comp_b", "a", "b").count()
    return each.groupBy("comp_a", "comp_b").agg(F.max_by(F.struct("a", "b"), F.struct("count", "a", "b")).alias("p")).select("p.*")


def all_pairs(met: DataFrame, flat: DataFrame) -> DataFrame:
    """(a, b): every pair of documents of components that met; those of two single documents were first pairs.

    The single document, or the component with fewer documents at the shingle, is expanded first, and the other one only
    to what passes the filters against it.
    """
    met = met.where(~(F.col("one_a.alone") & F.col("one_b.alone")))
    few = F.col("one_a.alone") | (~F.col("one_b.alone") & (F.col("docs_a") <= F.col("docs_b")))
    met = met.select("token", F.when(few, F.col("comp_a")).otherwise(F.col("comp_b")).alias("few"), F.when(few, F.col("comp_b")).otherwise(F.col("comp_a")).alias("many"))
    x = flat.select(F.col("token").alias("t_x"), F.col("comp").alias("c_x"), F.col("doc").alias("x"), F.col("n").alias("n_x"), F.col("pos").alias("p_x"))
    y = flat.where("not alone").select(F.col("token").alias("t_y"), F.col("comp").alias("c_y"), F.col("doc").alias("y"), F.col("n").alias("n_y"), F.col("pos").alias("p_y"))
    out = met.join(x, (F.col("token") == F.col("t_x")) & (F.col("few") == F.col("c_x")))
    out = out.join(y, (F.col("token") == F.col("t_y")) & (F.col("many") == F.col("c_y")) & compatible(F.col("n_x"), F.col("p_x"), F.col("n_y"), F.col("p_y")))
    return out.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def neardup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``."""
    spark = docs.sparkSession
    s = Scratch(spark, "neardup")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    seen = s.cut(docs.mapInArrow(_reading(k), "doc_id long, n long, d1 long, d2 long, part int, counts binary, bits array<long>"), "seen")
    own = seen.where("part is null").select("doc_id", "n", "d1", "d2", "bits")
    parts = seen.where("part is not null").select("part", "counts").repartition(1 << (SKETCH_BITS - PART_BITS), "part").mapInArrow(tx.tidy(_summing), "part int, ranks binary")
    ranks = np.zeros(1 << SKETCH_BITS, np.uint16)
    for part, blob in parts.collect():  # 2**SKETCH_BITS numbers at any input
        ranks[part << PART_BITS : (part + 1) << PART_BITS] = np.frombuffer(blob, np.uint16)
    classes = s.cut(own.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    member = s.cut(own.select("doc_id", "n", "d1", "d2").join(classes.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "member")
    # ids with several rows; their texts are one node
    ids = member.groupBy("doc_id").agg(F.count("*").alias("rows"), F.min(F.when(F.col("n") > 0, F.col("rep"))).alias("a"))
    ids = s.cut(ids.where("rows > 1 and a is not null"), "repeated")
    repeats = bool(ids.head(1))
    joined = member.where("n > 0").join(ids.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).where("a <> b").distinct() if repeats else None

    total = member.agg(F.sum("n")).first()[0] or 0
    buckets = max(16, int(total * (1 - OVER / UNDER)) // ENTRIES_A_BUCKET)
    packed = docs.select("text").mapInArrow(_indexing(spark.sparkContext.broadcast(ranks), buckets, k), "bucket int, postings binary")
    entries = packed.groupBy("bucket").applyInArrow(_shared, "token long, node long, pos int")
    shared = entries.groupBy("node").agg(F.collect_list(F.struct("token", "pos")).alias("e"))  # of one text each
    shared = shared.join(classes.where("rep is not null"), F.col("node") == F.col("d1").bitwiseAND(int(_LOW))).select(F.col("rep").alias("doc"), "n", "e")
    shared = s.cut(shared, "shared")
    s.drop("classes")
    v = Verifier(docs, own.where("n > 0"), s, k, repeats)

    of, r, before, linked = merged(None, joined, s, "of-ids") if repeats else None, 0, 0, 1
    while linked and linked * WORTH >= before:
        before += linked * bool(r)
        links = v.measure(v.near(v.new(hub_pairs(shared, of, r, s)), f"hub{r}"), f"hub{r}")
        linked = links.count()
        of = merged(of, links, s, f"of-{r}") if linked else of
        s.drop(f"sample-{r}", f"near-hub{r}", f"near-ids-hub{r}")
        r += 1
    flat, met = meetings(shared.select("doc", "n", F.inline("e")), of, s)
    links = v.measure(v.near(v.new(first_pairs(met)), "first"), "first")
    if not links.isEmpty():
        of = merged(of, links, s, "of-first")
    if of is not None:  # components that have come together since
        side = lambda x: of.select(F.col("node").alias(f"comp_{x}"), F.col("component").alias(f"now_{x}"))
        met = met.join(side("a"), "comp_a", "left").join(side("b"), "comp_b", "left").where(F.coalesce("now_a", "comp_a") != F.coalesce("now_b", "comp_b")).drop("now_a", "now_b")
    links = v.measure(v.near(v.new(all_pairs(met, flat)), "rest"), "rest")
    of = of if links.isEmpty() else merged(of, links, s, "of-rest")
    s.drop("shared", "seen")
    if of is None:
        return member.select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("component_id"))
    return member.join(of, member.rep == of.node, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
