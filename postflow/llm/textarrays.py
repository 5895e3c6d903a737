"""Whole texts of Arrow batches as numpy arrays: words, word hashes, shingles.

A string column is handled as one UTF-8 byte buffer with document offsets. Buffers are cut, between
documents, into blocks of about ``BLOCK_BYTES`` so that temporary arrays stay small; a document is
never cut, however long. Nulls are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _byte_set(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low:high + 1] = True
    return table


#: Bytes of a word: letters, digits and anything beyond ASCII (after lower-casing A-Z).
ALNUM = _byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes of a word: anything but ASCII white space.
NONSPACE = ~_byte_set((0x20, 0x20), (0x09, 0x0D))


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)``: ``offsets`` has one entry more than rows."""
    pa.set_memory_pool(pa.system_memory_pool())  # frees what a worker no longer uses
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, rows + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(off, off[first] + limit, "right")) - 1
        end = min(rows, max(first + 1, end))
        yield first, end, raw[off[first]:off[end]], off[first:end + 1] - off[first]
        first = end


def word_spans(raw: np.ndarray, off: np.ndarray, table: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and per document the index of its first word
    (one entry more than documents)."""
    inside = table[raw]
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    cuts = off[(off > 0) & (off < len(raw))]
    before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
    np.logical_not(inside[:-1], out=before[1:])
    np.logical_not(inside[1:], out=after[:-1])
    before[cuts] = True
    after[cuts - 1] = True
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, off)


class _Powers:
    """Powers of the base and of its inverse, computed as needed; they do not travel to workers."""

    def __init__(self):
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __reduce__(self):
        return type(self), ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < n:
            for i, factor in enumerate((_BASE, _BASE_INV)):
                table = np.full(n + n // 8, np.uint64(factor))
                table[0] = 1
                self.tables[i] = np.cumprod(table, dtype=np.uint64)
        return self.tables[0][:n], self.tables[1][:n]


_power_tables = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span; A-Z as a-z if ``lower``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    code = _BYTE_CODE[LOWER] if lower else _BYTE_CODE
    up, down = _power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(code[raw] * up[:len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each document, and each document's first shingle
    (one entry more than documents). A document of 1 to k-1 words has one shingle, all its words."""
    counts = np.diff(first)
    acc = words.copy()
    for j in range(1, min(k, len(words))):
        acc[:len(words) - j] = acc[:len(words) - j] * _STEP + words[j:]
    long = counts >= k
    n_out = np.where(long, counts - k + 1, np.minimum(counts, 1))
    at = np.concatenate(([0], np.cumsum(n_out)))
    keep = np.zeros(len(words) + 1, np.int32)
    np.add.at(keep, first[:-1][long], 1)
    np.add.at(keep, first[1:][long] - k + 1, -1)
    keep = np.cumsum(keep[:-1]).astype(bool)
    short = np.flatnonzero((counts > 0) & ~long)
    keep[first[short]] = True
    for d in short:
        value = np.uint64(int(counts[d]) * 0x2545F4914F6CDD1D % 2**64)
        for w in words[first[d]:first[d + 1]].tolist():
            value = np.uint64((int(value) * int(_STEP) + w) % 2**64)
        acc[first[d]] = value
    return mix(acc[keep]), at
