"""Byte-level text kernels on Arrow buffers, shared by the operators of this subpackage.

A string column already is one run of UTF-8 bytes with offsets, so words are found and hashed for many rows at
once with a few array passes.  Rows are taken in chunks of about CHUNK bytes, which bounds the temporaries; a
row that is longer forms a chunk of its own.

Python workers outlive their tasks, beside an executor's JVM that needs the rest of its memory: kernels are tidy(), so
that what a task has freed goes back to the system at its end, and batches that carry texts leave in pieces(), because
the JVM holds a batch from Python outside its heap as one block.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps
from typing import NamedTuple

import numpy as np

CHUNK = 1 << 18
#: Bytes of text in a batch that leaves a worker.
PIECE = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.random.default_rng(20240229).integers(1 << 40, 1 << 63, 64, np.uint64) | np.uint64(1)
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)

#: ASCII letters become lower case; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that are letters, digits or any non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True

#: Bytes of words that are parted by ASCII white space.
BLACK = np.ones(256, bool)
BLACK[[9, 10, 11, 12, 13, 32]] = False


class Words(NamedTuple):
    row: np.ndarray  # index of the row within the chunk
    begin: np.ndarray  # byte offsets within the chunk
    stop: np.ndarray
    count: np.ndarray  # words of each row
    data: np.ndarray  # the chunk's bytes, lower-cased


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; null rows are empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def chunks(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def pieces(batch, offsets: np.ndarray) -> Iterator:
    """The batch's rows in batches of about PIECE bytes of the text with these offsets."""
    for first, last in chunks(offsets, PIECE):
        yield batch.slice(first, last - first)


def release() -> None:
    """Give memory that is free in this process back to the system, where the allocators can."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def tidy(kernel: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The kernel of a mapInArrow, with a release() at the end of each task."""

    @wraps(kernel)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from kernel(batches)
        finally:
            release()

    return run


def words_of(data: np.ndarray, offsets: np.ndarray, first: int, last: int, inside: np.ndarray) -> Words:
    """Words of the rows first..last-1; words never cross rows."""
    at = offsets[first : last + 1] - offsets[first]
    data = LOWER[data[offsets[first] : offsets[last]]]
    n, rows = len(data), last - first
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(rows, np.int64), data)
    is_in = inside[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = is_in[:-1], is_in[1:]
    before[at[:-1][at[:-1] < n]] = False
    after[at[1:][at[1:] > 0] - 1] = False
    begin, stop = np.flatnonzero(is_in & ~before), np.flatnonzero(is_in & ~after) + 1
    row = np.searchsorted(at[1:], begin, "right")
    return Words(row, begin, stop, np.bincount(row, minlength=rows), data)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    forth, back = np.full(n, _P), np.full(n, np.uint64(pow(int(_P), -1, 1 << 64)))
    forth[0] = back[0] = 1
    return np.cumprod(forth), np.cumprod(back)


def running(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial of the chunk's bytes, and what brings differences to a common exponent."""
    n = len(w.data)
    forth, back = _powers(1 << max(19, n.bit_length()))
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[w.data] * forth[:n], out=run[1:])
    return run, back


def word_hashes(w: Words, run: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """64-bit hash of each word."""
    if not len(w.begin):
        return np.zeros(0, np.uint64)
    run, back = run or running(w)
    return mixed((run[w.stop] - run[w.begin]) * back[w.begin])


def hash_word(word: str) -> int:
    """The hash that word_hashes() gives this word."""
    data = LOWER[np.frombuffer(word.encode(), np.uint8)]
    zero = np.zeros(1, np.int64)
    return int(word_hashes(Words(zero, zero, zero + len(data), zero + 1, data))[0])


def shingle_hashes(hashes: np.ndarray, row: np.ndarray, count: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of k words; a row with fewer words, but not none, is one run."""
    n = len(hashes)
    whole = max(0, n - k + 1)
    full = np.zeros(whole, np.uint64)
    for j in range(k):
        full += hashes[j : j + whole] * _MULTIPLIERS[j]
    keep = row[:whole] == row[k - 1 : k - 1 + whole] if whole else np.zeros(0, bool)
    out, rows = [mixed(full[keep])], [row[:whole][keep]]
    starts = np.concatenate(([0], np.cumsum(count)[:-1])) if len(count) else count
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        at, c = starts[short], count[short]
        part = c.astype(np.uint64) * _MULTIPLIERS[63]
        for j in range(k - 1):
            there = c > j
            part[there] += hashes[at[there] + j] * _MULTIPLIERS[j]
        out.append(mixed(part))
        rows.append(short)
    h, r = np.concatenate(out), np.concatenate(rows)
    if len(short) and len(h):
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    return h, r


def distinct_in_rows(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of each row: (values, row, count by row)."""
    h = h.copy()
    at = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows))))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a > 1:
            h[a:b].sort()
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[keep], row[keep]
    return h, row, np.bincount(row, minlength=rows)
