"""Exact round trips of chunked media and of WARC packages."""

import base64
import contextlib
import hashlib
import io
import random
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from quirework.llm import media, warczip


def test_media_round_trip(spark):
    base = " ".join(f"word{i}" for i in range(3000))
    rows = [(1, "short"), (2, None), (3, ""), (4, base), (5, base), (6, "front " + base), (4, base), (4, "other"), (7, "é" * 700)]
    stored, store = media.written(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(tuple(r)[:5] for r in media.read(stored, store).collect())
    want = []
    for doc, text in rows:
        p = media.payload_of((text or "").encode())
        want.append((doc, len((text or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])))
    assert got == sorted(want)
    assert store.count() == store.select("digest").distinct().count()
    values = {r["payload_sha256"]: r for r in media.read(stored, store).collect()}
    assert len({(r["media_sha256"], r["feature"]) for r in values.values()}) == len(values)


def test_chunks_follow_content():
    text = " ".join(str(i * i) for i in range(5000)).encode()
    a, b = set(media.chunked(text)[1]), set(media.chunked(b"inserted " + text)[1])
    assert len(a & b) > 0.9 * len(a)
    ends = media.chunk_ends(media.payload_of(text))
    assert ends[-1] == len(media.payload_of(text)) and max(y - x for x, y in zip([0, *ends], ends)) <= media.LARGEST


def test_media_of_an_empty_table(spark):
    assert media.read(*media.written(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_package_is_read_by_range(zip64):
    rows = [(i, warczip.record(i, f"http://h/{i}", f"<p>{i}</p>\r\n\r\n".encode() * i, None)) for i in range(5)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") if not zip64 else contextlib.nullcontext() as z:
        if z:  # as another writer makes it
            at = [sum(len(r) for _, r in rows[:i]) for i in range(5)]
            z.writestr(warczip.INDEX, "\n".join(f'{k} {{"length": {len(r)}, "offset": {a}}}' for (k, r), a in zip(rows, at)))
            z.writestr(warczip.DATA, b"".join(r for _, r in rows))
            z.writestr("note.txt", "x" * 99, zipfile.ZIP_DEFLATED)
    if zip64:
        archive = warczip.Archive(out)
        for k, r in rows:
            archive.add(str(k), r)
        archive.close()
        assert b"\x01\x00\x10\x00" in out.getvalue()[:200]  # the extra field of 64-bit sizes
    raw = out.getvalue()
    asked = []

    def read_at(at, n):
        asked.append(n)
        return raw[at : at + n]

    got = list(warczip.records(read_at, len(raw)))
    assert [g[0] for g in got] == list(range(5)) and [g[2] for g in got] == [f"<p>{i}</p>\r\n\r\n".encode() * i for i in range(5)]
    assert warczip.directory(read_at, len(raw)).keys() == {warczip.DATA, warczip.INDEX}
    few = []
    far = warczip.ahead(lambda at, n: few.append(n) or raw[at : at + n], len(raw), 1 << 16)
    assert [g[2] for g in warczip.records(far, len(raw))] == [g[2] for g in got] and len(few) < len(asked)


def test_archives_are_files_read_by_range_only(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://h/{i}", f"page {i} " * 400) for i in range(200)]
    listing = warczip.written(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), archive_bytes=200_000)
    paths = [r["path"] for r in listing.collect()]
    assert 3 <= len(paths) <= 5
    found = []
    for path in paths:
        fs, inside = warczip.file_system(path)
        with fs.open_input_file(inside) as f:
            size = f.size()
            with zipfile.ZipFile(io.BytesIO(f.read())) as z:
                assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
            asked = []
            rows_ = list(warczip.records(lambda at, n: asked.append((at, n)) or f.read_at(n, at), size))
            assert max(n for _, n in asked) < size  # never the whole archive
            found += [(r[0], r[2].decode()) for r in rows_]
    assert sorted(found) == [(i, html) for i, _, html in rows]


def test_zip64_directory_with_overflowing_fields():
    body, name = b"stored bytes", b"m"
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, zlib.crc32(body), len(body), len(body), 1, 0) + name + body
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    central = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, zlib.crc32(body), 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    far = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(local) + len(central), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    raw = local + central + far + locator + end
    at, n = warczip.directory(lambda a, k: raw[a : a + k], len(raw))["m"]
    assert raw[at : at + n] == body


def test_warc_revisits(spark):
    rows = [(5, "http://a/", "same"), (3, "http://b/", "same"), (9, "http://c/\r\nX: y", "other"), (1, None, None), (2, "u", ""), (3, "http://b/", "same"), (8, "z", "x" * 300_000)]
    got = warczip.read(warczip.written(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()

    def digest(x):
        return base64.b32encode(hashlib.sha1(x.encode()).digest()).decode()

    want = [(5, 4, digest("same"), "revisit", 3), (3, 4, digest("same"), "response", None), (3, 4, digest("same"), "response", None), (9, 5, digest("other"), "response", None), (1, 0, digest(""), "response", None), (2, 0, digest(""), "revisit", 1), (8, 300_000, digest("x" * 300_000), "response", None)]
    key = lambda r: (r[0], r[1])
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(want, key=key)
    assert warczip.read(warczip.written(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def plain_media(text):
    """The stored form byte by byte: (n_bytes, payload, media)."""
    raw = (text or "").encode()
    payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
    cuts, start = [], 0
    for end in range(1, len(payload) + 1):
        rolling = sum(int(media.GEAR[payload[end - 1 - k]]) << k for k in range(min(16, end))) & 0xFFFF
        if end - start >= 256 and (rolling >> 6 == 0 or end - start == 8192) or end == len(payload):
            cuts.append((start, end))
            start = end
    head = b"QCDC\x01" + struct.pack("<QI", len(raw), len(cuts))
    for a, b in cuts:
        head += hashlib.sha256(payload[a:b]).digest() + struct.pack("<I", b - a)
    return len(raw), payload, head + payload


def test_media_equals_a_plain_version(spark):
    rng = random.Random(12)
    base = "".join(rng.choice("abcdefgh \né") for _ in range(9000))
    rows = [(1, base), (2, "x" + base), (3, base), (3, base), (4, None), (5, "z" * 20_000), (6, "q" * 576), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("media_bytes", F.lit("clash")).withColumn("head", F.lit(1))
    got = sorted((tuple(r) for r in media.read(*media.written(docs)).collect()))
    want = []
    for doc, text in rows:
        n, payload, stored = plain_media(text)
        x = [b - 128 for b in payload]
        crossings = sum((a >= 0) != (b >= 0) for a, b in zip(x, x[1:]))
        feature = f"frames={len(x) // 576};mean={sum(x) * 100 // len(x)};power={sum(v * v for v in x) * 100 // len(x)};crossings={crossings}"
        want.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature))
    assert got == sorted(want)
