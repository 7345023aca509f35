"""Benchmark decontamination by a prefix-filtered containment join over item-sized windows.

An item is cut into windows of ``window`` consecutive words (an item of fewer words is one window).  A window
lies in a document only if all its shingles do, so for full containment the necessary prefix is one shingle: the
window's rarest one, by counts over all documents.  Documents are probed with those prefix shingles alone; the
shingle's offset in the window gives the only possible start (positional bound), which has to leave room for the
whole window inside the document (length bound); what is left is compared word for word.

Skew: a document is read, probed and judged within one task and nothing is shuffled, so frequent passages and
copies cost as much as any other row.  The benchmark goes out in blocks of about ``block_bytes`` of text (4 MB), each
broadcast by itself; every Arrow batch of documents is held against one block after another, of which a task has one in
memory.  So documents are read twice whatever the benchmark's size, and no worker holds all of it.  Items longer than a
quarter of a block go out in pieces that overlap by a window less one word.

Edge cases: a null or wordless text has no words, no hits and is clean; a null or wordless item occurs nowhere;
repeated rows are judged one by one; equal item ids count once; of columns that clash with the result's names,
the result's replace the input's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.llm import _text as tx
from quirework.sources.scratch import Scratch

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 4 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_SPAN = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", _SPAN), T.StructField("items", T.ArrayType(T.StringType()))])


class Block:
    """Windows of some items, and their shingles."""

    def __init__(self, rows: list[tuple], window: int):
        self.window = window
        ids, texts = [str(r[0]) for r in rows], [(r[1] or "").encode() for r in rows]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        w = tx.words_of(np.frombuffer(b"".join(texts), np.uint8), offsets, 0, len(rows), tx.ALNUM)
        self.hashes, bytes_ = tx.word_hashes(w), w.data.tobytes()
        self.words = [bytes_[a:b] for a, b in zip(w.begin.tolist(), w.stop.tolist())]
        starts, lengths, items, at = [], [], [], 0
        for item, n in enumerate(w.count.tolist()):
            if n:
                size = min(window, n)
                starts += range(at, at + n - size + 1)
                lengths += [size] * (n - size + 1)
                items += [item] * (n - size + 1)
            at += n
        self.start, self.length, self.item, self.ids = np.array(starts, np.int64), np.array(lengths, np.int64), np.array(items, np.int64), ids
        self.k = np.minimum(self.length, SHINGLE)
        self.shingles = {}
        for k in sorted(set(self.k.tolist())):
            grams, of = gram(self.hashes, k), self.k == k
            n = len(grams) + 1  # of windows, more begin than have ended where a shingle is in one
            edges = np.bincount(self.start[of], minlength=n) - np.bincount((self.start + self.length - k + 1)[of], minlength=n)
            self.shingles[k] = np.unique(grams[np.cumsum(edges)[:-1] > 0])
        self.tables: dict[int, tuple] = {}

    def order(self, counts: dict[int, np.ndarray]) -> None:
        """Choose each window's rarest shingle as its prefix; ties go to the smaller hash."""
        for k, known in self.shingles.items():
            grams, which = gram(self.hashes, k), np.flatnonzero(self.k == k)
            token, offset = np.empty(len(which), np.uint64), np.empty(len(which), np.int64)
            for i, w in enumerate(which.tolist()):
                own = grams[self.start[w] : self.start[w] + self.length[w] - k + 1]
                best = np.lexsort((own, counts[k][np.searchsorted(known, own)]))[0]
                token[i], offset[i] = own[best], best
            by = np.argsort(token, kind="stable")
            keys, first = np.unique(token[by], return_index=True)
            self.tables[k] = (keys, np.append(first, len(by)), which[by], offset[by])


def gram(hashes: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for j in range(k):
        out += hashes[j : j + len(out)] * tx._MULTIPLIERS[j]
    return tx.mixed(out)


def sieve(keys: np.ndarray) -> np.ndarray:
    held = np.zeros(1 << 16, bool)
    held[keys >> np.uint64(48)] = True
    return held


def found(keys: np.ndarray, held: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``probe`` of members of the sorted ``keys``, and their positions in ``keys``."""
    at = np.flatnonzero(held[probe >> np.uint64(48)])
    key = np.minimum(np.searchsorted(keys, probe[at]), len(keys) - 1)
    same = keys[key] == probe[at]
    return at[same], key[same]


def each_block(blocks: list) -> Iterator[tuple[int, Block]]:
    """One block after another; of several, only the current one stays in the worker's memory."""
    for i, shared in enumerate(blocks):
        yield i, shared.value
        if len(blocks) > 1:
            vars(shared).pop("_value", None)  # read again from the executor's disk at the next batch


def _counting(blocks: list):
    def count(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, offsets = tx.flat(batch.column(0))
            for block, b in each_block(blocks):
                held = {k: sieve(v) for k, v in b.shingles.items()}
                sums = {k: np.zeros(len(v), np.int64) for k, v in b.shingles.items()}
                for first, last in tx.chunks(offsets):
                    w = tx.words_of(data, offsets, first, last, tx.ALNUM)
                    h = tx.word_hashes(w)
                    for k, keys in b.shingles.items():
                        at, key = found(keys, held[k], gram(h, k))
                        sums[k] += np.bincount(key[w.row[at] == w.row[at + k - 1]], minlength=len(keys))
                for k, n in sums.items():
                    some = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), block, np.int32)), pa.array(np.full(len(some), k, np.int32)), pa.array(some), pa.array(n[some])], ["block", "k", "i", "n"])

    return tx.tidy(count)


def _probing(blocks: list, text_at: int, kept: list[int], schema):
    def probe(batches) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            data, offsets = tx.flat(batch.column(text_at))
            n_words, spans, items = np.zeros(batch.num_rows, np.int64), [[] for _ in range(batch.num_rows)], [set() for _ in range(batch.num_rows)]
            for _, b in each_block(blocks):
                held = {k: sieve(t[0]) for k, t in b.tables.items()}
                for first, last in tx.chunks(offsets):
                    w = tx.words_of(data, offsets, first, last, tx.ALNUM)
                    n_words[first:last] = w.count
                    for row, begin, stop, item in hits(w, b, held):
                        spans[first + row].append((begin, stop))
                        items[first + row].add(item)
            own = [pa.array(n_words), pa.array([[{"begin": x, "stop": y} for x, y in merged(s)] for s in spans], target.field("spans").type), pa.array([sorted(x) for x in items], target.field("items").type)]
            yield from tx.pieces(pa.RecordBatch.from_arrays([*[batch.column(i).cast(target.field(j).type) for j, i in enumerate(kept)], *own], schema=target), offsets)

    return tx.tidy(probe)


def hits(w: tx.Words, b: Block, held: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int, str]]:
    """(row, first word, end, item) of each window that occurs in a chunk's rows."""
    ends, h = np.cumsum(w.count), tx.word_hashes(w)
    for k, (keys, bounds, windows, shifts) in b.tables.items():
        if len(h) < k:
            continue
        at, key = found(keys, held[k], gram(h, k))
        many = bounds[key + 1] - bounds[key]
        entry = np.repeat(bounds[key], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(at, many)
        win = windows[entry]
        row, start, size = w.row[at], at - shifts[entry], b.length[win]
        fits = (start >= (ends - w.count)[row]) & (start + size <= ends[row])
        row, start, size, win = row[fits], start[fits], size[fits], win[fits]
        equal = np.ones(len(row), bool)
        for j in range(int(size.max(initial=0))):
            on = equal & (size > j)
            equal[on] = h[start[on] + j] == b.hashes[b.start[win[on]] + j]
        raw = w.data
        for r, s, n, x in zip(row[equal].tolist(), start[equal].tolist(), size[equal].tolist(), win[equal].tolist()):
            own = b.start[x]
            if all(raw[w.begin[s + j] : w.stop[s + j]].tobytes() == b.words[own + j] for j in range(n)):
                base = int(ends[r] - w.count[r])
                yield r, s - base, s - base + n, b.ids[b.item[x]]


def _cutting(window: int, most: int):
    """(item, text) -> the same in pieces of at most ``most`` bytes that overlap by a window less one word."""

    def cut(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(text.encode()) <= most:
                    yield pa.RecordBatch.from_arrays([pa.array([item]), pa.array([text])], ["i", "t"])
                    continue
                words, first = [x.group() for x in WORD.finditer(text)], 0
                while first < len(words):
                    last, size = first, 0
                    while last < len(words) and (size < most or last - first < 2 * window):
                        size += len(words[last].encode()) + 1
                        last += 1
                    yield pa.RecordBatch.from_arrays([pa.array([item]), pa.array([" ".join(words[first:last])])], ["i", "t"])
                    if last == len(words):
                        break
                    first = last - window + 1

    return tx.tidy(cut)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges with the same union."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, all by default) with n_words, spans (word ranges hit, disjoint) and items (ids)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULT.names]
    items = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    items = scratch.cut(items.mapInArrow(_cutting(window, block_bytes // 4), "i string, t string"), "items")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    items = items.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    fields = [f for f in docs.select(*dict.fromkeys([*keep, text])).schema if f.name not in RESULT.names]
    schema = T.StructType([*fields, *RESULT])
    share = spark.sparkContext.broadcast
    # the driver holds one block's windows at a time
    blocks = [share(Block([(r["i"], r["t"]) for r in items.where(F.col("block") == k).collect()], window)) for k in range(n)]
    counted = docs.select(text).mapInArrow(_counting(blocks), "block int, k int, i long, n long").groupBy("block", "k", "i").agg(F.sum("n").alias("n"))
    counted = scratch.cut(counted, "counted")
    ordered = []
    for k, shared in enumerate(blocks):
        block = shared.value
        counts = {s: np.zeros(len(v), np.int64) for s, v in block.shingles.items()}
        for _, s, i, c in counted.where(F.col("block") == k).collect():  # one row for each shingle of the block at most
            counts[s][i] = c
        block.order(counts)
        ordered.append(share(block))
        vars(shared).pop("_value", None)
    names = [f.name for f in fields]
    out = docs.select(*names).mapInArrow(_probing(ordered, names.index(text), list(range(len(names))), schema), schema)
    return out.select(*keep, *RESULT.names)


def judged(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Digest columns of the result: n_hit, n_items, items_sha256, contaminated."""
    out = decontaminate(docs, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["begin"])
    return out.withColumns({"n_hit": hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256), "contaminated": F.size("spans") > 0})
