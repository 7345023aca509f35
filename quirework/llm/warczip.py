"""WARC records in ZIP archives: writing them, and reading records by range without extraction.

An archive is a .zip file in the shared folder with stored members: ``archive/data.warc`` and ``indexes/index.cdxj``,
whose lines give each record's offset and length inside the WARC member.  Records are streamed into it.  The reader
asks the file system for byte ranges only: it finds the end record, follows the ZIP64 locator where sizes or offsets
overflow, parses the central directory, checks the local headers of stored members, reads the index and then single
records, neighbouring ones of up to ``AHEAD`` bytes in one request.

Records with equal payloads of at least ``least`` bytes are one response, that with the smallest page id, and
revisits that refer to it; smaller payloads are all responses.

Skew: payload digests are grouped with map-side minima; the joined side is one row per digest and is either small
enough to broadcast or shuffled with skewed digests split.  An archive takes about ``archive_bytes``; a task holds one
record and one index while it writes, and AHEAD bytes and one record while it reads.  Files are named by random ids and
listed by the rows of the tasks that end well, so a task that runs twice leaves a file that nobody reads.

Edge cases: a null html is an empty payload, a null url an empty one; rows that repeat the smallest id of their
payload are all responses; null ids are never referred to, and a payload that only rows without an id have is a
response each time; ids are integers (others raise at the cast); other columns are ignored, whatever their names; an
empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.sources.scratch import Scratch

ARCHIVE_BYTES = 32 << 20
AHEAD = 1 << 20
#: Tasks that read archives; with more archives a task reads several, one after another.
MOST_TASKS = 20_000
LEAST = 0
DATA, INDEX = "archive/data.warc", "indexes/index.cdxj"
READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which leaves its payload out but tells its length and digest."""
    safe = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {safe}", f"WARC-Payload-Digest: sha1:{base32(hashlib.sha1(payload).digest())}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Archive:
    """Streams records into a ZIP archive of stored members; the data member has 64-bit sizes from the start."""

    def __init__(self, out):
        self.zip, self.lines, self.at = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED), [], 0
        self.data = self.zip.open(zipfile.ZipInfo(DATA, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True)

    def add(self, key: str, raw: bytes) -> None:
        self.lines.append(f"{key} " + json.dumps({"offset": self.at, "length": len(raw)}))
        self.data.write(raw)
        self.at += len(raw)

    def close(self) -> None:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX, (1980, 1, 1, 0, 0, 0)), "\n".join(self.lines))
        self.zip.close()


def file_system(path: str):
    """(file system, path in it) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def ahead(read_at: Callable[[int, int], bytes], size: int, block: int = AHEAD) -> Callable[[int, int], bytes]:
    """Answers small reads from the last ``block`` bytes asked for."""
    held = (0, b"")

    def read(at: int, n: int) -> bytes:
        nonlocal held
        first, data = held
        if at < first or at + n > first + len(data):
            held = first, data = at, read_at(at, max(n, min(block, size - at)))
        return data[at - first : at - first + n]

    return read


def directory(read_at: Callable[[int, int], bytes], size: int) -> dict[str, tuple[int, int]]:
    """Stored members by name: (offset of the first byte, length)."""
    tail_at = max(0, size - 65557)
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0 or len(tail) - end < 22:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack_from("<H2I", tail, end + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        signature, _, at, _ = struct.unpack("<4sIQI", read_at(tail_at + end - 20, 20))
        if signature != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        far = read_at(at, 56)
        if far[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, start = struct.unpack_from("<QQQ", far, 32)
    listing, at, out = read_at(start, length), 0, {}
    for _ in range(entries):
        if listing[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", listing, at + 8)
        packed, full, n, m, k = struct.unpack_from("<IIHHH", listing, at + 20)
        (local,) = struct.unpack_from("<I", listing, at + 42)
        name, extra = listing[at + 46 : at + 46 + n], listing[at + 46 + n : at + 46 + n + m]
        while len(extra) >= 4:
            kind, own = struct.unpack_from("<HH", extra)
            if kind == 1:  # 64-bit values for those fields that overflow, in this order
                values = [v for (v,) in struct.iter_unpack("<Q", extra[4 : 4 + own // 8 * 8])]
                full = values.pop(0) if full == 0xFFFFFFFF else full
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                local = values.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + own :]
        if method == 0 and packed == full and not flags & 1:  # sizes may follow the data, those here hold
            head = read_at(local, 30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError("broken local header")
            a, b = struct.unpack_from("<HH", head, 26)
            out[name.decode("utf-8" if flags & 0x800 else "cp437")] = (local + 30 + a + b, full)
        at += 46 + n + m + k
    return out


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("record is cut short")
    return fields, block


def records(read_at: Callable[[int, int], bytes], size: int) -> Iterator[tuple]:
    """Rows of READ from one archive."""
    members = directory(read_at, size)
    (data, _), (index, length) = members[DATA], members[INDEX]
    listing = read_at(index, length).decode() if length else ""
    for line in listing.split("\n") if listing else ():
        where = json.loads(line.partition(" ")[2])
        fields, block = parse(read_at(data + where["offset"], where["length"]))
        http, _, payload = block.partition(b"\r\n\r\n")
        n = int(http.rpartition(b"Content-Length: ")[2])
        digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
        if kind == "response" and (len(payload) != n or base32(hashlib.sha1(payload).digest()) != digest):
            raise ValueError("payload differs from its digest")
        page, to = (fields.get(k, "").removeprefix("<urn:page:").removesuffix(">") for k in ("warc-record-id", "warc-refers-to"))
        yield int(page) if page else None, fields["warc-target-uri"], payload if kind == "response" else None, n, digest, kind, int(to) if to else None


def _writing(folder: str, archive_bytes: int):
    def write(batches) -> Iterator:
        import pyarrow as pa

        fs, top = file_system(folder)
        fs.create_dir(top, recursive=True)
        archive = out = name = None

        def ended():
            archive.close()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["path"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, to = (batch.column(c)[i].as_py() for c in range(4))
                if archive is None:
                    name = f"{uuid.uuid4().hex}.zip"
                    out = fs.open_output_stream(f"{top}/{name}")
                    archive = Archive(out)
                archive.add(str(page_id), record(page_id, url or "", (html or "").encode(), to))
                if archive.at >= archive_bytes:
                    yield ended()
                    archive = None
        if archive is not None:
            yield ended()

    return write


def _reading(with_payload: bool, rows_at_once: int = 256):
    def read(batches) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [x.split()[0] for x in READ.split(", ")]

        def batch_of(rows: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(c if with_payload or i != 2 else [None] * len(rows), k) for i, (c, k) in enumerate(zip(map(list, zip(*rows)), kinds))], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inside = file_system(path)
                with fs.open_input_file(inside) as f:
                    size, held = f.size(), []
                    for row in records(ahead(lambda at, n: f.read_at(n, at), size), size):
                        held.append(row)
                        if len(held) == rows_at_once:
                            yield batch_of(held)
                            held = []
                    if held:
                        yield batch_of(held)

    return read


def written(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(path) of the archives that hold these pages, in the shared folder."""
    s = Scratch(pages.sparkSession, "warc")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"))
    digest = F.when(F.octet_length("html") >= least, F.unhex(F.sha1("html")))
    rows = rows.withColumn("digest", digest)
    firsts = s.cut(rows.select("page_id", "digest").where("digest is not null and page_id is not null").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "firsts")
    rows = rows.join(firsts, "digest", "left").select("page_id", "url", "html", F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first")).alias("refers_to"))
    return s.cut(rows.mapInArrow(_writing(f"{s.top}/archives", archive_bytes), "path string"), "listing")


def read(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives at these paths (column ``path``), each read by range in one task."""
    paths = archives.select("path")
    tasks = min(max(paths.count(), 1), MOST_TASKS)  # a stated number, since Spark merges small partitions else
    return paths.repartition(tasks).mapInArrow(_reading(with_payload), READ)
