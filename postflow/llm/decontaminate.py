"""Benchmark decontamination (operator 10): short test items found inside long documents.

Every item becomes the set of its ``k``-word shingles. Items are partitioned by set size (powers of
two); the partition's upper bound ``u`` fixes the length of the MinHash sketch of its items: the
``floor((1 - threshold) * u) + 1`` smallest shingle hashes. A document that holds at least
``threshold`` of an item's shingles misses fewer than that, so it holds at least one shingle of the
sketch: the search loses nothing, however long the document is. Documents are probed by whole text
against all sketches, and each candidate pair is verified on the full shingle sets.

The documents are never shuffled. Items are sent to the tasks in blocks of at most ``block_items``
items of at most ``block_shingles`` shingles; more items mean more passes.

Edge cases: null or empty texts and items match nothing; an item of fewer than ``k`` words is
matched as its whole word sequence; repeated items and documents give a row each; null keys are
kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import textarrays as ta
from postflow.llm.tables import table, two_columns

SCHEMA = "doc_id long, item_id long, n_item long, n_shared long, containment double"
_FILTER_BITS = 22


def _sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(row, words per shingle, sorted distinct shingles)`` of each item."""
    for lo, hi, raw, off in ta.blocks(texts):
        starts, ends, first = ta.word_spans(raw, off, ta.ALNUM)
        words = ta.span_hashes(raw, starts, ends)
        for d in range(hi - lo):
            n = int(first[d + 1] - first[d])
            size = min(k, n)
            if n:
                hashes, _ = ta.shingles(words[first[d]:first[d + 1]], np.array([0, n]), size)
                yield lo + d, size, np.unique(hashes)


class Sketches:
    """A block of items: full shingle sets and size-partitioned sketches, by words per shingle."""

    def __init__(self, item_ids: list, texts: list, k: int, percent: int):
        self.percent = percent
        self.items: dict[int, list[tuple[object, np.ndarray]]] = {}
        for row, size, hashes in _sets(pa.array(texts, pa.string()), k):
            self.items.setdefault(size, []).append((item_ids[row], hashes))
        self.index = {}
        for size, items in self.items.items():
            keys, owners = [], []
            for i, (_, hashes) in enumerate(items):
                upper = 1 << max(0, int(len(hashes) - 1).bit_length())
                sketch = hashes[:upper * (100 - percent) // 100 + 1]
                keys.append(sketch)
                owners.append(np.full(len(sketch), i))
            keys, owners = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[keys & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.index[size] = keys[order], owners[order], seen

    def search(self, raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, object, int, int]]:
        """``(document of the block, item, item shingles, shared shingles)`` at the threshold."""
        starts, ends, first = ta.word_spans(raw, off, ta.ALNUM)
        words = ta.span_hashes(raw, starts, ends)
        for size, (keys, owners, seen) in self.index.items():
            hashes, at = ta.shingles(words, first, size)
            maybe = np.flatnonzero(seen[hashes & np.uint64((1 << _FILTER_BITS) - 1)])
            left = np.searchsorted(keys, hashes[maybe], "left")
            right = np.searchsorted(keys, hashes[maybe], "right")
            doc = np.searchsorted(at, maybe, "right") - 1
            pairs = {(int(d), int(o)) for d, a, b in zip(doc, left, right) if a < b
                     for o in owners[a:b]}
            own, last = None, -1
            for d, o in sorted(pairs):
                if d != last:
                    own, last = np.unique(hashes[at[d]:at[d + 1]]), d
                item, wanted = self.items[size][o]
                shared = len(np.intersect1d(own, wanted, assume_unique=True))
                if 100 * shared >= self.percent * len(wanted):
                    yield d, item, len(wanted), shared


def _item_blocks(items: DataFrame, block_items: int, block_bytes: int) -> Iterator[tuple[list, list]]:
    """The items in blocks of bounded size; one block at a time is on the driver."""
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n = max(1, -(-size["n"] // block_items), -(-(size["b"] or 0) // block_bytes))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
    for i in range(n):
        rows = items.filter(part == i).collect()
        if rows:
            yield [r["doc_id"] for r in rows], [r["text"] for r in rows]


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", k: int = 5, percent: int = 80,
               block_items: int = 20_000, block_bytes: int = 16 << 20) -> DataFrame:
    """Pairs (document, item) where the document holds at least ``percent`` % of the item's
    distinct ``k``-word shingles."""
    docs = two_columns(docs, key, text)
    found = docs.sparkSession.createDataFrame([], SCHEMA)
    for ids, texts in _item_blocks(two_columns(items, item_key, item_text), block_items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sketches = Sketches(*shared.value, k, percent)
            for batch in batches:
                keys = batch.column(0).cast(pa.int64())
                rows = [(keys[lo + d].as_py(), item, n, both, both / n)
                        for lo, _, raw, off in ta.blocks(batch.column(1))
                        for d, item, n, both in sketches.search(raw, off)]
                if rows:
                    columns = list(zip(*rows))
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, TYPES)], NAMES)

        found = found.unionByName(docs.mapInArrow(run, SCHEMA))
    return found


NAMES = ["doc_id", "item_id", "n_item", "n_shared", "containment"]
TYPES = [pa.int64()] * 4 + [pa.float64()]


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
               item_text: str = "text", k: int = 5, percent: int = 80, block_items: int = 20_000,
               block_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs`` without those that hold an item, all their columns untouched. The same
    search as ``find_leaks``; rows are filtered where they are read."""
    at = docs.columns.index(text)
    for ids, texts in _item_blocks(two_columns(items, item_key, item_text), block_items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sketches = Sketches(*shared.value, k, percent)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, _, raw, off in ta.blocks(batch.column(at)):
                    for d, *_ in sketches.search(raw, off):
                        keep[lo + d] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP10_SQL = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, least(5, len(w)) AS k,
             unnest([w[p:p + least(5, len(w)) - 1] FOR p IN range(1, len(w) - least(5, len(w)) + 2)]) AS sh
      FROM i WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT DISTINCT doc_id, k,
             unnest([w[p:p + k - 1] FOR p IN range(1, len(w) - k + 2)]) AS sh
      FROM d, (SELECT DISTINCT k FROM s) WHERE len(w) >= k),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM t JOIN s USING (k, sh) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""
