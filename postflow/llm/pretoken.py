"""Pre-tokens of whole texts, by character classes over code-point arrays.

Both splits below are regular expressions over four character classes (letter, number, white space,
other), so their matches follow from class changes and a few local rules. ``tests/llm`` compares
them with the expressions themselves.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa

from postflow.llm import textarrays as ta

OTHER, LETTER, NUMBER, SPACE = range(4)

#: The code points with Unicode's White_Space property.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
         0x205F, 0x3000)


def _class(c: int) -> int:
    if c in WHITE:
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)


class Classes:
    """Class of each code point: a table for the basic plane, others looked up as they occur."""

    def __init__(self):
        self.table = np.fromiter(map(_class, range(1 << 16)), np.uint8, 1 << 16)

    def of(self, points: np.ndarray) -> np.ndarray:
        out = self.table[np.minimum(points, 0xFFFF)]
        for i in np.flatnonzero(points > 0xFFFF).tolist():
            out[i] = _class(int(points[i]))
        return out


def _starts(points: np.ndarray, kinds: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of class runs that begin, and of characters whose successor is in the same document."""
    n = len(points)
    begin, joined = np.ones(n, bool), np.ones(n, bool)
    begin[1:] = kinds[1:] != kinds[:-1]
    edges = docs[(docs > 0) & (docs <= n)]
    begin[edges[edges < n]] = True
    joined[edges - 1] = False
    joined[-1:] = False
    return begin, joined


def _contractions(points: np.ndarray, kinds: np.ndarray, begin: np.ndarray, joined: np.ndarray) -> None:
    """An apostrophe at a token's start takes s, t, m, d, re, ve or ll that follows it."""
    n = len(points)
    at = np.flatnonzero(begin & (points == 0x27) & joined)
    for i in at.tolist():
        one = chr(points[i + 1])
        size = 0
        if one in "stmd":
            size = 1
        elif joined[i + 1] and one + chr(points[i + 2]) in ("re", "ve", "ll"):
            size = 2
        if size:
            begin[i + 1] = False
            after = i + 1 + size
            if after < n and joined[after - 1] and kinds[after] == LETTER:
                begin[after] = True


def byte_level_starts(points: np.ndarray, kinds: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Token starts of ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^ LN]+|white+(?!\\S)|white+``: a run
    of white space gives its last character up to what follows; a plain space joins it."""
    begin, joined = _starts(points, kinds, docs)
    last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & joined[:-1])
    begin[last] = True
    begin[last[points[last] == 0x20] + 1] = False
    _contractions(points, kinds, begin, joined)
    return np.flatnonzero(begin)


def word_starts(points: np.ndarray, kinds: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Token starts of ``'s|'t|'re|'ve|'m|'ll|'d|L+|N|[^ LN]+`` and of white-space runs."""
    begin, joined = _starts(points, kinds, docs)
    begin[kinds == NUMBER] = True
    _contractions(points, kinds, begin, joined)
    return np.flatnonzero(begin)


def distinct_tokens(raw: np.ndarray, off: np.ndarray, classes: Classes, split, drop_space: bool
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a block of texts as numbers of its distinct tokens.

    Returns ``codes`` (one per token), ``first`` (each document's first token, one entry more than
    documents), and bytes, offsets and 64-bit hashes of the distinct tokens."""
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    if not len(points):
        return (np.zeros(0, np.int64), np.zeros(len(off), np.int64), np.zeros(0, np.uint8),
                np.zeros(1, np.int64), np.zeros(0, np.uint64))
    place = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    docs = np.searchsorted(place, off)
    kinds = classes.of(points)
    starts = split(points, kinds, docs)
    ends = np.append(starts[1:], len(points))
    if drop_space:
        keep = kinds[starts] != SPACE
        starts, ends = starts[keep], ends[keep]
    first = np.searchsorted(starts, docs)
    a, b = place[starts], place[ends]
    seen = pa.array(ta.span_hashes(raw, a, b, lower=False).view(np.int64)).dictionary_encode()
    codes = seen.indices.to_numpy(zero_copy_only=False)
    uniques = seen.dictionary.to_numpy(zero_copy_only=False).view(np.uint64)
    where = np.empty(len(uniques), np.int64)
    where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    sizes = (b - a)[where]
    at = np.concatenate(([0], np.cumsum(sizes)))
    pick = np.repeat(a[where] - at[:-1], sizes) + np.arange(at[-1])
    return codes, first, raw[pick], at, uniques


def expand(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``values[offsets[c]:offsets[c + 1]]`` of all ``codes``, end to end, and where each
    of them begins (one entry more than codes)."""
    sizes = np.diff(offsets)[codes]
    at = np.concatenate(([0], np.cumsum(sizes)))
    return values[np.repeat(offsets[codes] - at[:-1], sizes) + np.arange(at[-1])], at
