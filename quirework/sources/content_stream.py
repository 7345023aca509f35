"""PDF content streams as tables: a tokenizer and a graphics-state machine, run set-wise by mapInArrow.

One row per path: its operators with coordinates, the matrix and style in force, clip and paint, and the range
of operations that made it.  Anything malformed gives one issue row for the stream instead of paths.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

PATHS = "doc_id string, page int, xref int, path_index int, first_op int, last_op int, ctm array<double>, style string, clip string, paint string, ops array<struct<op:string,coords:array<double>>>, code string"

# The operators of the format and how many operands each takes.
CONSTRUCTION = {"m": 2, "l": 2, "c": 6, "v": 4, "y": 4, "h": 0, "re": 4}
PAINT = ("S", "s", "f", "F", "f*", "B", "B*", "b", "b*", "n")
CLIP = ("W", "W*")
STATE = {"w": 1, "J": 1, "j": 1, "M": 1, "d": 2, "ri": 1, "i": 1, "gs": 1, "g": 1, "G": 1, "rg": 3, "RG": 3, "k": 4, "K": 4, "cs": 1, "CS": 1}
ANY_STATE = ("sc", "SC", "scn", "SCN")

_TOKEN = re.compile(rb"%[^\r\n]*|[\x00\t\n\f\r ]+|\[|\]|<<|>>|<[0-9A-Fa-f\s]*>|/[^\x00\t\n\f\r ()<>\[\]{}/%]*|[+-]?(?:\d+\.?\d*|\.\d+)(?=[\x00\t\n\f\r ()<>\[\]{}/%]|$)|[^\x00\t\n\f\r ()<>\[\]{}/%]+")


class Malformed(Exception):
    """Holds the issue code."""


def tokens(raw: bytes) -> Iterator:
    """Numbers as float, names and operators as text, strings and dictionaries as opaque marks, arrays as lists."""
    at, stack = 0, []
    while at < len(raw):
        if raw[at : at + 1] == b"(":
            depth, end = 1, at + 1
            while end < len(raw) and depth:
                c = raw[end]
                if c == 92:
                    end += 1
                depth += (c == 40) - (c == 41)
                end += 1
            if depth:
                raise Malformed("CONTENT_STREAM_PARSE_FAILED")
            at, item = end, ("string",)
        else:
            m = _TOKEN.match(raw, at)
            if not m:
                raise Malformed("CONTENT_STREAM_PARSE_FAILED")
            at, word = m.end(), m[0]
            if word[:1] in b"%\x00\t\n\f\r ":
                continue
            if word in (b"[", b"<<"):
                stack.append((word, []))
                continue
            if word in (b"]", b">>"):
                if not stack or (stack[-1][0] == b"[") != (word == b"]"):
                    raise Malformed("CONTENT_STREAM_PARSE_FAILED")
                kind, inner = stack.pop()
                item = inner if kind == b"[" else ("dictionary",)
            elif word[:1] == b"<":
                item = ("string",)
            elif word[:1] in b"+-.0123456789":
                try:
                    item = float(word)
                except ValueError:
                    item = word.decode("latin-1")
            else:
                item = word.decode("latin-1")
            if item == "ID" and not stack:  # inline image: its bytes run to EI between white space
                end = re.compile(rb"[\x00\t\n\f\r ]EI(?=[\x00\t\n\f\r ]|$)").search(raw, at)
                if not end:
                    raise Malformed("CONTENT_STREAM_PARSE_FAILED")
                at, item = end.end(), "EI"
        if stack:
            stack[-1][1].append(item)
        else:
            yield item
    if stack:
        raise Malformed("CONTENT_STREAM_PARSE_FAILED")


def operations(raw: bytes) -> Iterator[tuple[str, list]]:
    operands: list = []
    for item in tokens(raw):
        if isinstance(item, str) and not item.startswith("/") and item not in ("true", "false", "null"):
            yield item, operands
            operands = []
        else:
            operands.append(item)
    if operands:
        raise Malformed("CONTENT_OPERATOR_MALFORMED")


def numbers(operands: list, n: int, code: str) -> list[float]:
    if len(operands) != n or not all(isinstance(x, float) for x in operands):
        raise Malformed(code)
    return operands


def product(m: list[float], n: list[float]) -> list[float]:
    """m, then n; six decimals."""
    out = [m[0] * n[0] + m[1] * n[2], m[0] * n[1] + m[1] * n[3], m[2] * n[0] + m[3] * n[2], m[2] * n[1] + m[3] * n[3], m[4] * n[0] + m[5] * n[2] + n[4], m[4] * n[1] + m[5] * n[3] + n[5]]
    return [round(x, 6) + 0.0 for x in out]


def paths(raw: bytes) -> list[tuple]:
    """(path_index, first_op, last_op, ctm, style, clip, paint, ops) of every painted path."""
    ctm, style, saved, out = [1.0, 0.0, 0.0, 1.0, 0.0, 0.0], {}, [], []
    ops: list[tuple] = []
    first, clip = -1, None
    for i, (op, operands) in enumerate(operations(raw)):
        if op in CONSTRUCTION:
            coords = numbers(operands, CONSTRUCTION[op], "CONTENT_PATH_OPERATOR_MALFORMED")
            if not ops:
                first = i
            ops.append((op, coords))
        elif ops and op in CLIP:
            if operands or clip:
                raise Malformed("CONTENT_PATH_CLIP_MALFORMED")
            clip = op
        elif ops and op in PAINT:
            if operands:
                raise Malformed("CONTENT_PATH_PAINT_MALFORMED")
            out.append((len(out), first, i, list(ctm), json.dumps(style, sort_keys=True), clip, op, ops))
            ops, first, clip = [], -1, None
        elif ops:
            raise Malformed("CONTENT_PATH_INTERWOVEN_OPERATOR")
        elif op in CLIP or op in PAINT:
            continue  # there is no path that it could act on
        elif op == "q":
            if operands:
                raise Malformed("GRAPHICS_STATE_OPERATOR_MALFORMED")
            saved.append((list(ctm), dict(style)))
        elif op == "Q":
            if operands or not saved:
                raise Malformed("GRAPHICS_STATE_STACK_MALFORMED")
            ctm, style = saved.pop()
        elif op == "cm":
            ctm = product(numbers(operands, 6, "CONTENT_CTM_MALFORMED"), ctm)
        elif op in STATE or op in ANY_STATE:
            if op in STATE and len(operands) != STATE[op]:
                raise Malformed("GRAPHICS_STATE_OPERATOR_MALFORMED")
            style = {**style, op: [x if isinstance(x, (float, str)) else repr(x) for x in operands]}
    if ops:
        raise Malformed("CONTENT_PATH_UNTERMINATED")
    if saved:
        raise Malformed("GRAPHICS_STATE_STACK_MALFORMED")
    return out


def content_paths(streams: DataFrame) -> DataFrame:
    """(doc_id, page, xref, content) -> PATHS; a malformed stream gives one row with its code."""

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(PATHS))

    def parse(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc, page, xref, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                try:
                    for k, a, b, ctm, style, clip, paint, ops in paths(raw or b""):
                        rows.append((doc, page, xref, k, a, b, ctm, style, clip, paint, [{"op": o, "coords": c} for o, c in ops], None))
                except Malformed as e:
                    rows.append((doc, page, xref, None, None, None, None, None, None, None, None, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return streams.select("doc_id", "page", "xref", "content").mapInArrow(parse, PATHS)
