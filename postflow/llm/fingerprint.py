"""Document fingerprints: threshold-scaled sketches of word shingles (operator 11).

A fingerprint holds the hash of every distinct ``k``-word shingle that lies below a fixed ``FRACTION`` of
the hash range; where none does, the smallest hash alone. Which hashes are kept does not depend on the
size of the text, so that

* the sketch of a union is the union of the sketches (``merged``: hashes below the limit, or the smallest),
* the share of a sketch that another one holds estimates how much of the text the other contains, however
  unequal the two are (``likeness``: the share of the smaller sketch that the larger one holds).

As text, a fingerprint is its hashes in ascending order, 16 hexadecimal digits each.

``compared_with_next`` puts every document beside the next one in descending order of the key. Ranges of the
order are cut at existing keys, found on keys alone; each range is one partition that is read as a sorted
stream, and the first document of a range is also sent to the range before it. Texts are exchanged once,
and a task holds one Arrow batch and one text more.

Edge cases: null and empty texts, and texts without words, have an empty fingerprint; two empty ones have a
likeness of 1, an empty and another one of 0; a text of fewer than ``k`` words is one shingle; null keys come
last, as the least ones; rows of equal key are ordered by a hash of the text, then by the text (equal rows are
interchangeable, and stay in one stream); an only document is its own next one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import textarrays as ta
from postflow.llm.tables import staged, table, two_columns

FRACTION = 1 / 8
WORDS = 5
RANGE_BYTES = 64 << 20  # text of a range, as long as there are no more than MOST_RANGES
MOST_RANGES = 100_000
DIGITS = 16


def sketches(texts: pa.Array, k: int = WORDS, fraction: float = FRACTION) -> list[np.ndarray]:
    """Per text, the ascending hashes of its sketch."""
    limit = np.uint64(min(int(fraction * 2.0**64), 2**64 - 1))
    out = []
    for _, _, raw, off in ta.blocks(texts):
        starts, ends, first = ta.word_spans(raw, off, ta.NONSPACE)
        hashes, at = ta.shingles(ta.span_hashes(raw, starts, ends), first, k)
        low = hashes < limit
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            own = hashes[a:b][low[a:b]]
            out.append(np.unique(own) if len(own) or a == b else hashes[a:b].min(keepdims=True))
    return out


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller sketch that the larger one holds."""
    least = min(len(a), len(b))
    if not least:
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / least


def hashes_of(fingerprint: Column) -> Column:
    """The hashes of a fingerprint column, as an array of strings."""
    count = F.length(fingerprint) / F.lit(DIGITS)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), (count - 1).cast("int")), lambda i: F.substr(
        fingerprint, i * DIGITS + 1, F.lit(DIGITS)))).otherwise(F.array().cast("array<string>"))


def likeness_of(a: Column, b: Column) -> Column:
    """``likeness`` of two fingerprint columns."""
    least = F.least(F.length(a), F.length(b)) / F.lit(DIGITS)
    return F.when(least > 0, F.size(F.array_intersect(hashes_of(a), hashes_of(b))) / least) \
        .otherwise((F.length(a) == F.length(b)).cast("double"))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS,
                 fraction: float = FRACTION) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([as_text(s) for s in sketches(batch.column(1), k, fraction)], pa.string())
            yield pa.record_batch([batch.column(0), own], ["doc_id", "fingerprint"])

    docs = two_columns(df, key, text)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def merged(df: DataFrame, by: list[str], fraction: float = FRACTION) -> DataFrame:
    """Sketches of whole groups of documents, ``(by…, hash)`` with a row per hash: that of the texts of a
    group taken together. A group is never in one task: its hashes are rows."""
    limit = f"{min(int(fraction * 2.0**64), 2**64 - 1):016x}"
    rows = df.select(*by, F.explode(hashes_of(F.col("fingerprint"))).alias("hash")).distinct()
    below = rows.filter(F.col("hash") < limit)
    least = rows.groupBy(*by).agg(F.min("hash").alias("hash")).filter(F.col("hash") >= limit)
    return below.unionByName(least)


def _cuts(keys: DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The first key of each range, ascending: at most one row per range comes to the driver."""
    dealt = keys.repartitionByRange(ranges, "down", "h").groupBy(F.spark_partition_id()).agg(
        F.min(F.struct("down", "h")).alias("first")).select("first.*").distinct()
    first = sorted((r.down, r.h) for r in dealt.collect())
    return np.array([d for d, _ in first], np.int64), np.array([h for _, h in first], np.int64)


def _range_of(down: Column, h: Column, cuts: tuple[np.ndarray, np.ndarray]) -> Column:
    """Number of the range of a key: the last cut that is not after it, by halving steps."""
    downs, hs = F.lit(cuts[0]), F.lit(cuts[1])
    steps = F.array(*[F.lit(1 << b) for b in range(len(cuts[0]).bit_length(), -1, -1)])

    def further(i: Column, step: Column) -> Column:
        at = F.get(downs, i + step)
        return F.when((at < down) | ((at == down) & (F.get(hs, i + step) <= h)), i + step).otherwise(i)

    return F.aggregate(steps, F.lit(0), further)


def in_descending_order(df: DataFrame, key: str = "doc_id", text: str = "text",
                        range_bytes: int = RANGE_BYTES) -> DataFrame | None:
    """``(part, peek, doc_id, text)``: partitions of rows in descending order of the key, each followed by
    the first row of the next partition (``peek``), the last one by the first of all. None if empty."""
    docs = two_columns(df, key, text).withColumn("text", F.coalesce("text", F.lit("")))
    lowest = F.lit(-(1 << 63)).cast("long")
    docs = docs.withColumn("down", F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), lowest))) \
        .withColumn("h", F.xxhash64("text"))
    keys = staged(docs.select("down", "h", F.octet_length("text").cast("long").alias("size")), "fingerprint-keys")
    size = keys.agg(F.sum("size")).first()[0]
    if size is None:
        return None
    cuts = _cuts(keys, max(1, min(MOST_RANGES, -(-size // range_bytes))))
    ranges = len(cuts[0])
    part = _range_of(F.col("down"), F.col("h"), cuts)
    first = (F.get(F.lit(cuts[0]), F.col("part")) == F.col("down")) & (F.get(F.lit(cuts[1]), F.col("part")) == F.col("h"))
    places = F.array_compact(F.array(
        F.struct(F.col("part"), F.lit(0).alias("peek")),
        F.when(first, F.struct(((F.col("part") + ranges - 1) % ranges).alias("part"), F.lit(1).alias("peek")))))
    dealt = docs.withColumn("part", part).select("doc_id", "text", "down", "h", F.explode(places).alias("place"))
    return dealt.select("place.*", "down", "h", "doc_id", "text").repartitionById(ranges, "part") \
        .sortWithinPartitions("part", "peek", "down", "h", "text").select("part", "peek", "doc_id", "text")


def compared_with_next(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS,
                       fraction: float = FRACTION, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The edited text has the first code points of the next document in place of its own last third."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
             "near_edited double, near_next double"
    dealt = in_descending_order(df, key, text, range_bytes)
    if dealt is None:
        return df.sparkSession.createDataFrame([], schema)
    names = [part.split()[0] for part in schema.split(", ")]

    def finished(rows: list[tuple]) -> pa.RecordBatch:
        """Results of all of ``(doc_id, text, sketch)`` but the last, each beside its follower."""
        edited = [t[:len(t) - len(t) // 3] + after[:len(t) // 3] for (_, t, _), (_, after, _) in zip(rows, rows[1:])]
        drawn = sketches(pa.array(edited, pa.string()), k, fraction)
        out = [(d, len(t), hashlib.sha256(e.encode()).hexdigest(), as_text(s), as_text(es), likeness(s, es),
                likeness(s, after)) for (d, t, s), e, es, (_, _, after) in zip(rows, edited, drawn, rows[1:])]
        types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        columns = list(zip(*out)) or [()] * len(types)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, closed = None, [], False
        for batch in batches:
            parts, peeks, ids, texts = (batch.column(i).to_pylist() for i in range(4))
            for p, peek, *row in zip(parts, peeks, ids, texts, sketches(batch.column(3), k, fraction)):
                if p != part:
                    if len(waiting) > 1:
                        yield finished(waiting)
                    part, waiting, closed = p, [], False
                if not closed:
                    waiting.append(tuple(row))
                    closed = bool(peek)
            if len(waiting) > 1:
                yield finished(waiting)
                waiting = waiting[-1:]

    return dealt.mapInArrow(run, schema)


def op11_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_with_next(table(spark, sf_dir, "documents"))
