"""Byte-level BPE, encoding and decoding, with Spark higher-order functions (operator 8).

Texts are cut into blocks of whole documents. Each block becomes one row: its distinct pre-tokens
as byte arrays, and per document the numbers of its pre-tokens. On that row, ``transform`` encodes
every distinct pre-token once: a fold (``aggregate``) over its bytes merges, step by step, the
leftmost pair of lowest rank, looked up in a literal rank map. The ids are then put in place per
document. Decoding maps ids to their pieces and concatenates them. No text is shuffled.

Frequent pre-tokens would be encoded once in every block. At most ``memo_words`` of them (the most
frequent of about ``memo_docs`` whole documents) are encoded beforehand
by the same fold and sent to the tasks; the blocks' rows hold the others. The memo is of bounded
size and only saves time: every pre-token has the same ids with or without it.

A step of the fold looks at all tokens of its word, so it takes time with the square of a word's length. Words of
more than ``LONG`` bytes (unspaced scripts, encoded data) are merged in the task that cuts the text, by the same
ranks in the same order from a heap, in n log n.

The literal rank map: pair (a, b) of token ids is at slot ``base[a] + b`` of two arrays, the owner
``a`` and the merged id, laid out so that rows of different ``a`` share the arrays without clashes.
One state element is ``rank << 16 | id``: the rank of merging this token with the next (or NONE).

Edge cases: null and empty texts have no ids (an empty array); repeated rows and keys give a row
each; null keys are kept; a document is never cut, however long; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import pretoken
from postflow.llm import textarrays as ta
from postflow.llm.tables import staged, table, two_columns

CHUNK_BYTES = 1 << 20
LONG = 400
NONE = 65535


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def rank_map(path: str) -> dict[str, list]:
    """The vocabulary as plain lists: ``base``, ``owner``, ``merged``, ``single`` (id of each byte)
    and ``pieces`` (hexadecimal, by id). Ids must be below 65535."""
    ranks = read_ranks(path)
    size = max(ranks.values()) + 1
    if size >= NONE:
        raise ValueError("ids must be below 65535")
    rows: dict[int, dict[int, int]] = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if a is not None and b is not None:
                rows.setdefault(a, {})[b] = rank
    rng = np.random.default_rng(8)
    span = 1 << 16
    while True:
        base = _placed(rows, size, span, rng)
        if base is not None:
            break
        span *= 2
    owner, merged = np.full(span + size, -1), np.zeros(span + size, np.int64)
    for a, row in rows.items():
        for b, rank in row.items():
            owner[base[a] + b], merged[base[a] + b] = a, rank
    pieces = [""] * size
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    return {"base": base.tolist(), "owner": owner.tolist(), "merged": merged.tolist(),
            "single": [ranks[bytes([i])] for i in range(256)], "pieces": pieces}


def _placed(rows: dict[int, dict[int, int]], size: int, span: int, rng) -> np.ndarray | None:
    """A start for every row so that no slot is used twice, largest rows first; None if not found."""
    base, used = np.zeros(size, np.int64), np.zeros(span + size, bool)
    for a, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        slots = np.fromiter(row, np.int64)
        for start in rng.integers(0, span, 4000):
            if not used[start + slots].any():
                break
        else:
            return None
        base[a] = start
        used[start + slots] = True
    return base


def _rank_literal(spark: SparkSession, ranks: str) -> Column:
    """The rank map as one value, a struct of arrays. It is a one-row subquery, which Spark evaluates
    once and puts into the plan as a literal, rather than a literal from the start: plans and their
    descriptions would repeat all its numbers as text in the driver's memory."""
    found = rank_map(ranks)
    names = ("base", "owner", "merged", "single")
    one = pa.table({n: pa.array([found[n]], pa.list_(pa.int32())) for n in names})
    return spark.createDataFrame(one).select(F.struct(*names).alias("ranks")).scalar()


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _state(maps: Column, a: Column, b: Column) -> Column:
    """State element of token ``a`` before token ``b``."""
    slot = F.get(maps["base"], a) + b
    rank = F.when(F.get(maps["owner"], slot) == a, F.get(maps["merged"], slot)).otherwise(NONE)
    return rank.cast("bigint") * 65536 + a


def _merge_once(maps: Column, state: Column) -> Column:
    """One step: the leftmost pair of lowest rank becomes one token (its id is the rank)."""
    low, none = F.lit(65535), F.lit(NONE << 16)
    no_head = F.array().cast("array<bigint>")

    def merged(least: Column) -> Column:
        token = F.shiftright(least, 16).cast("int")
        return _let(F.array_position(state, least).cast("int"), lambda p: F.concat(
            F.when(p > 1, F.concat(
                F.slice(state, F.lit(1), p - 2),
                F.array(_state(maps, F.get(state, p - 2).bitwiseAND(low).cast("int"), token))))
            .otherwise(no_head),
            F.array(F.when(p + 1 < F.size(state), _state(
                maps, token, F.get(state, p + 1).bitwiseAND(low).cast("int"))).otherwise(none + token)),
            F.slice(state, p + 2, F.size(state))))

    return _let(F.array_min(state), lambda least: F.when(least >= none, state).otherwise(merged(least)))


def encode_word(maps: Column, word: Column) -> Column:
    """Ids of a byte array (``array<tinyint>``)."""
    none = F.lit(NONE << 16)
    singles = F.transform(word, lambda x: F.get(maps["single"], x.cast("int").bitwiseAND(255)))
    start = _let(singles, lambda ids: F.transform(ids, lambda a, i: F.when(
        i + 1 < F.size(ids), _state(maps, a, F.get(ids, i + 1))).otherwise(none + a)))
    return F.transform(F.aggregate(word, start, lambda state, _: _merge_once(maps, state)),
                       lambda x: x.bitwiseAND(F.lit(65535)).cast("int"))


class HeapMerge:
    """Ranked merges of one long word: always the leftmost pair of lowest rank, from a heap."""

    def __init__(self, ranks: str):
        found = rank_map(ranks)
        self.single, self.arrays = found["single"], [np.array(found[n], np.int32) for n in ("base", "owner", "merged")]

    def __call__(self, word: bytes) -> list[int]:
        base, owner, merged = self.arrays
        ids: list[int] = [self.single[b] for b in word]
        end = len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))

        def rank(i: int) -> int:
            j = after[i]
            if j == end:
                return NONE
            slot = base[ids[i]] + ids[j]
            return int(merged[slot]) if owner[slot] == ids[i] else NONE

        heap = [(r, i) for i in range(end) if (r := rank(i)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue  # one of the two is another token by now
            gone = after[i]
            ids[i], ids[gone], after[i] = r, -1, after[gone]
            if after[i] < end:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (new := rank(k)) != NONE:
                    heapq.heappush(heap, (new, k))
        return [t for t in ids if t >= 0]


def _memo(docs: DataFrame, maps: Column, memo_words: int, memo_docs: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of frequent pre-tokens, their ids end to end, and where each one's begin."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = pretoken.Classes()
        for batch in batches:
            for _, _, raw, off in ta.blocks(batch.column(0), CHUNK_BYTES):
                codes, _, data, at, _ = pretoken.distinct_tokens(
                    raw, off, classes, pretoken.byte_level_starts, drop_space=False)
                yield pa.record_batch(
                    [pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)),
                                                                      pa.py_buffer(data.tobytes())]),
                     pa.array(np.bincount(codes, minlength=len(at) - 1).astype(np.int64))], ["word", "n"])

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets, data = batch.column(0).buffers()
            at = np.frombuffer(offsets, np.int32, batch.num_rows + 1, batch.column(0).offset * 4)
            raw = np.frombuffer(data, np.uint8)
            bytes_ = pa.ListArray.from_arrays(pa.array(at - at[0]), pa.array(raw[at[0]:at[-1]].view(np.int8)))
            hashes = ta.span_hashes(raw, at[:-1].astype(np.int64), at[1:].astype(np.int64), lower=False)
            yield pa.record_batch([pa.array(hashes.view(np.int64)), bytes_], ["hash", "word"])

    count = docs.count()
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20))
    some = docs.filter(part < (1 << 20) * memo_docs // max(1, count)) if count > memo_docs else docs
    counted = some.select("text").mapInArrow(words, "word binary, n long").filter(F.length("word") <= LONG) \
        .groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")
    counted = staged(counted, "bpe-words")
    # A threshold instead of a sort: the words that pass are at most memo_words.
    least = (counted.groupBy("n").agg(F.count("*").alias("words")).collect())  # few different counts
    total, bound = 0, 1 << 62
    for r in sorted(least, reverse=True):
        total += r["words"]
        if total > memo_words:
            break
        bound = r["n"]
    chosen = counted.filter(F.col("n") >= bound).select("word").mapInArrow(
        numbers, "hash long, word array<tinyint>")
    found = chosen.withColumn("ranks", maps).select("hash", _let(
        F.col("ranks"), lambda m: encode_word(m, F.col("word"))).alias("ids")).toArrow()
    hashes = found.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    ids = found.column("ids").combine_chunks().take(pa.array(order)) if len(order) else None
    sizes = ids.value_lengths().to_numpy(zero_copy_only=False) if ids is not None else []
    values = ids.flatten().to_numpy(zero_copy_only=False) if ids is not None else np.zeros(0, np.int32)
    return hashes[order], values.astype(np.uint16), np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)


def plain_ids(keys: pa.Array, ids: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """``(doc_id, ids)``."""
    return pa.record_batch([keys, pa.ListArray.from_arrays(pa.array(at, pa.int32()),
                                                              pa.array(ids.astype(np.int32)))],
                           ["doc_id", "ids"])


def encode(df: DataFrame, ranks: str, key: str = "doc_id", text: str = "text",
           memo_words: int = 600_000, memo_docs: int = 150_000, finish=plain_ids,
           schema: str = "doc_id long, ids array<int>") -> DataFrame:
    """The ids of every row, by the ranks file at the path ``ranks``: ``(doc_id, ids array<int>)``,
    or what ``finish(keys, ids, at)`` makes of a block of them (document ``i`` has the ids
    ``ids[at[i]:at[i + 1]]``)."""
    maps = _rank_literal(df.sparkSession, ranks)
    docs = two_columns(df, key, text)
    hashes, values, offsets = _memo(docs, maps, memo_words, memo_docs)
    context = docs.sparkSession.sparkContext
    memo, memo_ids = context.broadcast(hashes), context.broadcast((values, offsets))
    merge = context.broadcast(HeapMerge(ranks))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = pretoken.Classes()
        known = memo.value
        for batch in batches:
            for lo, hi, raw, off in ta.blocks(batch.column(1), CHUNK_BYTES):
                codes, first, data, at, hashes = pretoken.distinct_tokens(
                    raw, off, classes, pretoken.byte_level_starts, drop_space=False)
                place = np.searchsorted(known, hashes)
                old = np.zeros(len(hashes), bool)
                old[place < len(known)] = known[place[place < len(known)]] == hashes[place < len(known)]
                long = ~old & (np.diff(at) > LONG)
                new = ~old & ~long
                number = np.where(old, place, len(known) + np.cumsum(new) - 1)
                number[long] = len(known) + new.sum() + np.arange(long.sum())
                merged = [merge.value(data[a:b].tobytes()) for a, b in zip(at[:-1][long].tolist(), at[1:][long].tolist())]
                sizes = np.diff(at)[new]
                cuts = np.concatenate(([0], np.cumsum(sizes)))
                pick = np.repeat(at[:-1][new] - cuts[:-1], sizes) + np.arange(cuts[-1])
                words = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(data[pick].view(np.int8)))
                keys = batch.column(0).slice(lo, hi - lo).cast(pa.int64())
                yield pa.record_batch(
                    [pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                     pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                     pa.array([first.astype(np.int64).tobytes()], pa.binary()),
                     pa.array([(number[codes] if len(codes) else codes).astype(np.int32).tobytes()], pa.binary()),
                     pa.array([merged], pa.list_(pa.list_(pa.int32())))],
                    ["words", "keys", "first", "codes", "long"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, offsets = memo_ids.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids, keys, long = batch.column(0)[i].values, batch.column(1)[i].values, batch.column(4)[i].values
                first = np.frombuffer(batch.column(2)[i].as_py(), np.int64)
                codes = np.frombuffer(batch.column(3)[i].as_py(), np.int32)
                sizes = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in (ids, long)])
                own = [x.flatten().to_numpy(zero_copy_only=False).astype(np.uint16) if len(x) else values[:0] for x in (ids, long)]
                flat, at = pretoken.expand(np.concatenate((values, *own)),
                                           np.concatenate((offsets, offsets[-1] + np.cumsum(sizes))), codes)
                yield finish(keys, flat, at[first])

    chunks = docs.mapInArrow(
        split, "words array<array<tinyint>>, keys array<long>, first binary, codes binary, long array<array<int>>")
    encoded = chunks.withColumn("ranks", maps).select(
        _let(F.col("ranks"), lambda m: F.transform("words", lambda w: encode_word(m, w))).alias("ids"),
        "keys", "first", "codes", "long")
    return encoded.mapInArrow(assemble, schema)


class Pieces:
    """The pieces of a ranks file by id, for decoding."""

    def __init__(self, ranks: str):
        pieces = [bytes.fromhex(p) for p in rank_map(ranks)["pieces"]]
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.at = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of id lists ``ids[at[i]:at[i + 1]]``, end to end, and where each one's begin:
        the pieces of the ids, concatenated."""
        data, begin = pretoken.expand(self.data, self.at, ids)
        return data, begin[at]


def decode(df: DataFrame, ranks: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, data binary)``: the bytes of every row's ids (null ids: null)."""
    pieces = Pieces(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, at = pieces.decode(lists.flatten().to_numpy(zero_copy_only=False),
                                     np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))
            data = data.tobytes()
            out = [data[a:b] if ok else None for a, b, ok in zip(
                at.tolist(), at[1:].tolist(), lists.is_valid().to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "data"])

    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                     F.col(f"`{ids}`").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, data binary")


def digests(ranks: str, with_ids: bool = False):
    """A ``finish`` for ``encode`` and its schema: per document the number of ids, the SHA-256 of the
    decimal ids joined by commas, and that of the bytes they decode to."""
    pieces = Pieces(ranks)
    decimal = [str(i) for i in range(len(pieces.at) - 1)]

    def finish(keys: pa.Array, ids: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        data, begin = pieces.decode(ids, at)
        data, plain = data.tobytes(), ids.tolist()
        texts = [",".join(map(decimal.__getitem__, plain[a:b])) for a, b in zip(at.tolist(), at[1:].tolist())]
        columns = {
            "doc_id": keys, "n_tokens": pa.array(np.diff(at).astype(np.int64)),
            "ids_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(data[a:b]).hexdigest()
                                        for a, b in zip(begin.tolist(), begin[1:].tolist())], pa.string())}
        if with_ids:
            columns["ids"] = plain_ids(keys, ids, at).column(1)
        return pa.record_batch(list(columns.values()), list(columns))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return finish, schema + (", ids array<int>" if with_ids else "")


def op8_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    if ranks is None:
        import public_tokenizers
        ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    finish, schema = digests(ranks)
    return encode(table(spark, sf_dir, "documents"), ranks, finish=finish, schema=schema)
