"""Fuzzy search for short licence notices (operator 2).

Exact places: a phrase's words stand consecutively among the words of a text. Fuzzy places: a
notice of ``m`` characters with at most ``k`` edits, cut into ``k + 1`` pieces, holds one piece
unchanged (pigeonhole). The pieces are found by plain substring search over the whole text; around
each hit, the ``regex`` library's bounded-error matching verifies the notice and counts its edits,
the closest places first. All such places are reported as spans. A label and a score come from spans that are
made of whole words: a span is widened to the words it begins and ends in, and the edits are counted again, so
that "mit licenses" is one edit from the notice, and "submit license" is none of it. In a notice of up to
``NAME_WORDS`` words, those of up to ``SHORT`` letters must be there as they are: an edit would make them another
word ("it license").

One narrow pass: nothing is shuffled, and only the phrase list goes to the tasks.

Edge cases: a null text is an empty text (0 words, no labels, score 0); repeated rows and equal
keys give one row each; a null key is kept; other columns of the input are ignored, so their names
cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from postflow.llm import textarrays as ta
from postflow.llm.tables import table, two_columns

#: The phrases whose exact places are counted, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Notices searched with errors: text, label, edits allowed.
NOTICES = (
    ("gnu general public license", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("apache license", "apache", 1),
    ("mit license", "mit", 1),
    ("creative commons attribution", "cc-by", 3),
    ("mozilla public license", "mpl", 2),
    ("bsd 3-clause license", "bsd", 2),
    ("bsd 2-clause license", "bsd", 2),
)

NAME_WORDS, SHORT = 4, 3

#: Sentences of licence headers, searched with errors as well.
HEADERS = (
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit", 6),
    ("licensed under the apache license, version 2.0", "apache", 4),
    ("redistribution and use in source and binary forms, with or without modification", "bsd", 6),
    ("you can redistribute it and/or modify it under the terms of the gnu general public license", "gpl", 6),
    ("you can redistribute it and/or modify it under the terms of the gnu lesser general public license", "lgpl", 6),
    ("subject to the terms of the mozilla public license", "mpl", 4),
    ("licensed under a creative commons attribution 4.0 international license", "cc-by", 5),
)

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double, "
          "spans array<struct<label:string,start:long,end:long,edits:int,whole:int>>")


class Notice:
    """A notice with its pigeonhole pieces and its bounded-error pattern."""

    def __init__(self, text: str, label: str, edits: int):
        raw = text.encode()
        self.raw, self.label, self.edits, self.size = raw, label, edits, len(raw)
        words = _words(raw)
        self.fixed = {w for w in words if len(w) <= SHORT} if len(words) <= NAME_WORDS else set()
        cuts = [i * len(raw) // (edits + 1) for i in range(edits + 2)]
        self.pieces = [(raw[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.patterns = [regex.compile(rb"(?:" + regex.escape(raw) + rb"){e<=%d}" % e)
                         for e in range(edits + 1)]

    def places(self, text: bytes, hits: dict[bytes, list[int]], off: np.ndarray
               ) -> Iterator[tuple[int, int, int, int]]:
        """``(document, start, end, edits)`` of verified places; windows that overlap are one. Places
        with fewer edits are taken first, then the gaps they leave are searched with one edit more,
        so a place is left out only where it overlaps one at least as good."""
        windows = []
        for piece, at in self.pieces:
            for hit in hits[piece]:
                doc = int(np.searchsorted(off, hit, "right")) - 1
                low = max(int(off[doc]), hit - at - self.edits)
                high = min(int(off[doc + 1]), hit - at + self.size + self.edits)
                windows.append((doc, low, high))
        windows.sort()
        merged: list[list[int]] = []
        for doc, low, high in windows:
            if merged and merged[-1][0] == doc and low <= merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], high)
            else:
                merged.append([doc, low, high])
        gaps = [tuple(window) for window in merged]
        for pattern in self.patterns:
            left = []
            for doc, low, high in gaps:
                while high - low >= self.size - self.edits and (found := pattern.search(text, low, high)):
                    yield doc, found.start(), found.end(), sum(found.fuzzy_counts)
                    left.append((doc, low, found.start()))
                    low = max(found.end(), found.start() + 1)
                left.append((doc, low, high))
            gaps = left


    def whole_words(self, text: bytes, start: int, end: int, low: int, high: int) -> int | None:
        """Edits of the notice to the whole words around a place, None if there are more than allowed."""
        near = self.edits + 1  # a word that goes on further adds more edits than that
        first, last = start, end
        while first > max(low, start - near) and ta.ALNUM[text[first - 1]] and ta.ALNUM[text[first]]:
            first -= 1
        while last < min(high, end + near) and ta.ALNUM[text[last - 1]] and ta.ALNUM[text[last]]:
            last += 1
        found = distance(self.raw, text[first:last], self.edits)
        return found if found <= self.edits and self.fixed <= set(_words(text[first:last])) else None


def _words(text: bytes) -> list[bytes]:
    return bytes(b if ta.ALNUM[b] else 32 for b in text).split()


def distance(a: bytes, b: bytes, most: int) -> int:
    """Edits from ``a`` to ``b``; ``most + 1`` stands for any number beyond ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def _find_all(text: bytes, piece: bytes) -> list[int]:
    hits, at = [], text.find(piece)
    while at >= 0:
        hits.append(at)
        at = text.find(piece, at + 1)
    return hits


def scan_block(raw: np.ndarray, off: np.ndarray, phrases, notices: list[Notice]) -> list[tuple]:
    """One result row (without the key) per document of a block."""
    starts, ends, first = ta.word_spans(raw, off, ta.ALNUM)
    hashes = ta.span_hashes(raw, starts, ends)
    docs = len(off) - 1
    n_words = np.diff(first)
    n_base = np.zeros(docs, np.int64)
    low = np.full(docs, len(hashes), np.int64)
    high = np.full(docs, -1, np.int64)
    base: list[set] = [set() for _ in range(docs)]
    for words, label in phrases:
        match = np.ones(max(0, len(hashes) - len(words) + 1), bool)
        for j, word in enumerate(words):
            match &= hashes[j:j + len(match)] == word
        at = np.flatnonzero(match)
        doc = np.searchsorted(first, at, "right") - 1
        inside = at + len(words) <= first[doc + 1]
        at, doc = at[inside], doc[inside]
        np.add.at(n_base, doc, 1)
        np.minimum.at(low, doc, at - first[doc])
        np.maximum.at(high, doc, at - first[doc])
        for d in np.unique(doc).tolist():
            base[d].add(label)
    text = ta.LOWER[raw].tobytes()
    hits = {piece: _find_all(text, piece) for n in notices for piece, _ in n.pieces}
    spans: list[list[dict]] = [[] for _ in range(docs)]
    best = np.where(n_base > 0, 1.0, 0.0)
    for notice in notices:
        for doc, a, b, edits in notice.places(text, hits, off):
            whole = notice.whole_words(text, a, b, int(off[doc]), int(off[doc + 1]))
            spans[doc].append({"label": notice.label, "start": int(a - off[doc]),
                               "end": int(b - off[doc]), "edits": edits, "whole": whole})
            if whole is not None:
                best[doc] = max(best[doc], 1 - whole / notice.size)
    return [(int(n_words[d]), int(n_base[d]), int(low[d]) if n_base[d] else None,
             int(high[d]) if n_base[d] else None, ",".join(sorted(base[d])),
             ",".join(sorted(base[d] | {s["label"] for s in spans[d] if s["whole"] is not None})), float(best[d]),
             sorted(spans[d], key=lambda s: (s["start"], s["label"])))
            for d in range(docs)]


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text",
                  phrases: Sequence[tuple[str, str]] = PHRASES,
                  notices: Sequence[tuple[str, str, int]] = NOTICES + HEADERS) -> DataFrame:
    """Per row: word count, exact phrase places, labels, a score and the fuzzy spans (byte offsets
    in the text; ``start``..``end``, ``edits``, and ``whole``, the edits to the whole words there, null for
    more than allowed). ``score`` is 1 for an exact phrase or notice, else 1 - whole / length of the
    closest notice, else 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [Notice(*n) for n in notices]
        hashed = []
        for phrase, label in phrases:
            raw = np.frombuffer(phrase.encode(), np.uint8)
            s, e, _ = ta.word_spans(raw, np.array([0, len(raw)]), ta.ALNUM)
            hashed.append((ta.span_hashes(raw, s, e), label))
        for batch in batches:
            for lo, hi, raw, off in ta.blocks(batch.column(1)):
                columns = list(zip(*scan_block(raw, off, hashed, compiled)))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo).cast(pa.int64())]
                                      + [pa.array(c, t) for c, t in zip(columns, TYPES)], NAMES)

    return two_columns(df, key, text).mapInArrow(run, SCHEMA)


NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
         "spans"]
TYPES = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct(
    [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()),
     ("whole", pa.int32())]))]


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
