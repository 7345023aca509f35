"""Media payloads as content-defined chunks: cut, deduplicated, and rebuilt from ordered chunk lists.

A payload is the UTF-8 text, padded with bytes 255 to a positive multiple of ``FRAME`` (8-bit samples).  A rolling
gear hash over the last 16 bytes cuts it where its top bits are zero, within least and largest chunk sizes, so equal
runs of bytes give equal chunks wherever they stand.  A medium's stored form is a head (magic, length, and the
SHA-256 and length of every chunk in order) and those chunks; the store keeps each distinct chunk once.

1. Digests alone are counted by a join key of 64 bits; those of at least two chunks set bits in a filter of fixed
   size (1 MB), the one thing that is broadcast.
2. Each document is written as its head and the chunks that the filter rules out as shared; chunks that may be
   shared go to the store, deduplicated by their full digest.  A filled filter sends more chunks through the store
   and changes no result.
3. Reading back, lists of shared chunks are joined with the store by digest (skewed digests are split), gathered
   by document, and put in order with the document's own chunks; every chunk's digest is verified.

Edge cases: null and empty texts are one frame of padding; rows that repeat an id are told apart by payload, and
rows that agree in both give equal results once each; long texts are bounded by one row's memory.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm import _text as tx
from quirework.sources.scratch import Scratch

FRAME = 576
LEAST, LARGEST, TOP_BITS = 256, 8192, 10
FILTER_BITS, SEGMENTS = 23, 16
MAGIC = b"QCDC\x01"
GEAR = np.random.default_rng(576).integers(0, 1 << 16, 256, np.uint16)
READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def payload_of(text: bytes) -> bytes:
    """Padded to a positive multiple of FRAME."""
    return text + b"\xff" * (max(1, -(-len(text) // FRAME)) * FRAME - len(text))


def cut_marks(data: np.ndarray) -> np.ndarray:
    """Positions after which the gear hash of the last 16 bytes asks for a cut."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):  # twice the window each time
        h[step:] += h[:-step].copy() << np.uint16(step)
    return np.flatnonzero(h >> np.uint16(16 - TOP_BITS) == 0) + 1


def chunk_ends(payload: bytes) -> list[int]:
    """Where the chunks of a payload end."""
    marks, ends, start, size = cut_marks(np.frombuffer(payload, np.uint8)), [], 0, len(payload)
    while start < size:
        i = int(np.searchsorted(marks, start + LEAST))
        end = min(int(marks[i]) if i < len(marks) else size, start + LARGEST, size)
        ends.append(end)
        start = end
    return ends


def head_of(n_bytes: int, digests: list[bytes], lengths: list[int]) -> bytes:
    return MAGIC + struct.pack("<QI", n_bytes, len(digests)) + b"".join(d + struct.pack("<I", n) for d, n in zip(digests, lengths))


def parse_head(head: bytes) -> tuple[int, list[tuple[bytes, int]]]:
    if head[: len(MAGIC)] != MAGIC:
        raise ValueError("not a stored medium")
    n_bytes, many = struct.unpack_from("<QI", head, len(MAGIC))
    at = len(MAGIC) + 12
    return n_bytes, [(head[at + 36 * i : at + 36 * i + 32], struct.unpack_from("<I", head, at + 36 * i + 32)[0]) for i in range(many)]


def chunked(text: bytes) -> tuple[bytes, list[bytes], list[int]]:
    payload = payload_of(text)
    ends = chunk_ends(payload)
    return payload, [hashlib.sha256(payload[a:b]).digest() for a, b in zip([0, *ends], ends)], ends


def feature_of(samples: np.ndarray) -> str:
    """Frames, mean and mean square in hundredths, and crossings of the mid level, as whole numbers."""
    x = samples.astype(np.int64) - 128
    return f"frames={len(x) // FRAME};mean={int(x.sum()) * 100 // len(x)};power={int((x * x).sum()) * 100 // len(x)};crossings={int(np.count_nonzero((x[1:] >= 0) != (x[:-1] >= 0)))}"


def _texts(column) -> Iterator[bytes]:
    data, offsets = tx.flat(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[a:b].tobytes()


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _counting(batches) -> Iterator:
    """text -> (short digest, times in this batch)."""
    import pyarrow as pa

    for batch in batches:
        short = [_short(d) for text in _texts(batch.column(0)) for d in chunked(text)[1]]
        keys, n = np.unique(np.array(short, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["short", "n"])


def _setting(batches) -> Iterator:
    """Short digests -> this task's filter, in segments."""
    import pyarrow as pa

    held = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        held[batch.column(0).to_numpy() & ((1 << FILTER_BITS) - 1)] = True
    bits = np.packbits(held).reshape(SEGMENTS, -1)
    some = [i for i in range(SEGMENTS) if bits[i].any()]
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([bits[i].tobytes() for i in some], pa.binary())], ["segment", "bits"])


def _uniting(batches) -> Iterator:
    import pyarrow as pa

    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, bits in zip(batch.column(0).to_pylist(), batch.column(1)):
            bits = np.frombuffer(bits.as_buffer(), np.uint8)
            held[segment] = held[segment] | bits if segment in held else bits.copy()
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["segment", "bits"])


DOCUMENTS = "doc_id long, payload_key binary, head binary, own binary, refs array<struct<place:int,digest:binary>>"
STORED = f"shared boolean, {DOCUMENTS}, digest binary, chunk binary"


def _storing(bits):
    """(doc_id, text) -> documents with their own chunks, and chunks that may be shared."""

    def store(batches) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("shared", pa.bool_()), ("doc_id", pa.int64()), ("payload_key", pa.binary()), ("head", pa.binary()), ("own", pa.binary()), ("refs", pa.list_(pa.struct([("place", pa.int32()), ("digest", pa.binary())]))), ("digest", pa.binary()), ("chunk", pa.binary())])
        held, mask = bits.value, (1 << FILTER_BITS) - 1
        for batch in batches:
            rows, chunks, size = [], {}, 0
            ids = batch.column(0).to_pylist()
            for i, text in enumerate(_texts(batch.column(1))):
                payload, digests, ends = chunked(text)
                own, refs = [], []
                for place, (d, a, b) in enumerate(zip(digests, [0, *ends], ends)):
                    if held[_short(d) & mask]:
                        refs.append({"place": place, "digest": d})
                        chunks[d] = payload[a:b]
                    else:
                        own.append(payload[a:b])
                head = head_of(len(text), digests, [b - a for a, b in zip([0, *ends], ends)])
                rows.append((False, ids[i], hashlib.sha256(payload).digest()[:16], head, b"".join(own), refs, None, None))
                size += len(payload)
                if size >= 4 << 20 or i + 1 == len(ids):
                    rows += [(True, None, None, None, None, None, d, c) for d, c in chunks.items()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, chunks, size = [], {}, 0

    return store


def _reading(batches) -> Iterator:
    """(doc_id, head, own, got) -> features of the verified payload."""
    import pyarrow as pa

    for batch in batches:
        out = []
        for doc, head, own, got in zip(*(batch.column(i).to_pylist() for i in range(4))):
            n_bytes, listed = parse_head(head)
            shared, at, pieces = {x["place"]: x["chunk"] for x in got or ()}, 0, []
            for place, (digest, length) in enumerate(listed):
                if place in shared:
                    piece = shared[place]
                else:
                    piece = own[at : at + length]
                    at += length
                if len(piece) != length or hashlib.sha256(piece).digest() != digest:
                    raise ValueError(f"chunk {place} of document {doc} differs from its digest")
                pieces.append(piece)
            payload = b"".join(pieces)
            media = hashlib.sha256(head)
            media.update(payload)
            out.append((doc, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(head) + len(payload), media.hexdigest(), feature_of(np.frombuffer(payload, np.uint8))))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = [x.split()[0] for x in READ.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)


def written(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, payload_key, head, own, refs; store: digest, chunk), both in the shared folder."""
    spark = docs.sparkSession
    s = Scratch(spark, "media")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text)
    shared = docs.select(text).mapInArrow(_counting, "short long, n long").groupBy("short").agg(F.sum("n").alias("n")).where("n > 1").select("short")
    united = shared.mapInArrow(_setting, "segment int, bits binary").repartition(SEGMENTS, "segment").mapInArrow(_uniting, "segment int, bits binary")
    bits = np.zeros((SEGMENTS, (1 << FILTER_BITS) // 8 // SEGMENTS), np.uint8)
    for segment, blob in united.collect():  # 2**FILTER_BITS bits at any input
        bits[segment] = np.frombuffer(blob, np.uint8)
    held = spark.sparkContext.broadcast(np.unpackbits(bits.reshape(-1)).astype(bool))
    raw = docs.mapInArrow(_storing(held), STORED)
    parts = s.part(raw, "raw", "shared", {"false": DOCUMENTS, "true": "digest binary, chunk binary"}, **{"parquet.page.size.row.check.min": 10})
    store = s.cut(parts["true"].groupBy("digest").agg(F.first("chunk").alias("chunk")), "store")
    s.drop("raw/true")
    return parts["false"], store


def read(documents: DataFrame, store: DataFrame) -> DataFrame:
    """Rebuild every payload, verify it, and compute its digests and feature."""
    alone = documents.where("size(refs) = 0").select("doc_id", "head", "own", F.lit(None).cast("array<struct<place:int,chunk:binary>>").alias("got"))
    some = documents.where("size(refs) > 0").select("doc_id", "payload_key", "head", "own", "refs")
    refs = some.select("doc_id", "payload_key", F.explode("refs").alias("r")).select("doc_id", "payload_key", "r.place", "r.digest").distinct()
    got = refs.join(store, "digest").groupBy("doc_id", "payload_key").agg(F.collect_list(F.struct("place", "chunk")).alias("got"))
    back = some.select(F.col("doc_id").alias("i"), F.col("payload_key").alias("k"), "head", "own").join(got, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("payload_key"))).select("doc_id", "head", "own", "got")
    return alone.unionByName(back).mapInArrow(_reading, READ)
