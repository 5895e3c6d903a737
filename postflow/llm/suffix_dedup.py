"""Removal of repeated byte strings by a distributed suffix merge sort (operator 5).

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too.

1. Anchors. Of every ``length - GRAM + 1`` consecutive ``GRAM``-grams of a text, those with the
   smallest hash are anchors, so every string of ``length`` bytes holds an anchor, and equal strings
   hold it at the same place. Only suffixes that start at anchors are sorted, about 1 in 85 of all.
   Anchors whose gram occurs once are dropped (a count per gram hash).
2. Runs. Each task takes the suffixes of its documents at the anchors left: ``length`` bytes to the
   right, and to the left as many as a string through the anchor can reach. Equal contexts within an
   Arrow batch prove each other repeated; one of them goes on as their witness, so a text that a third
   of all rows share is one suffix per batch. Suffixes are sorted, front-coded (common prefix with the
   one before, and the rest) and exchanged in one sorted run per bucket of gram hashes.
3. Merge. A loser tree over a bucket's runs keeps for every loser its common prefix with the winner
   that beat it: candidates are ordered by these lengths, and bytes are compared only from there on.
   The merge yields the common prefix of neighbours, so for two suffixes of one gram the common
   right part is a running minimum; the common left part is one exclusive-or. Strings of ``length``
   bytes through both are then known exactly: offsets ``length - right .. left``. The strings through
   one anchor all cover it, so their union is one interval, given by the least and greatest offset.
4. Of two suffixes that share a string of ``length`` bytes, the common part to the right or that to
   the left is at least half as long. So the suffixes of a gram with more than ``heavy`` anchors in
   all are dealt twice, by a hash of the right half-length and of the left one, and the group is
   split without losing a pair: the right half answers for strings at offsets up to ``length - half``,
   the left one for the others. Suffixes per half are counted first; a half that more than
   ``bucket_suffixes`` share (the ends of a passage in very many rows) is gathered by no task: the
   strings that it answers for are counted by their hashes, over all tasks.
5. A group of many different contexts is not compared pair by pair. Sorted once from the anchor to
   the right and once to the left, neighbours have the longest common parts: they bound the offsets
   at which a suffix can share a string at all, and mostly reach the bounds themselves. Suffixes that
   stay open are compared with the whole group; where that would be more than ``most_pairs``
   comparisons, the strings at the possible offsets are counted by their hashes instead, which is
   spread over all tasks.

The rows are written once, bucketed by row id, so that texts are exchanged once for both joins.

Everything is exact up to collisions of 64-bit hashes (in 4 and 5; elsewhere bytes are compared). Text,
anchors and intervals meet by row id in shuffles; nothing of them passes the driver.

Edge cases: null and empty texts have no bytes; texts shorter than ``length`` lose nothing; repeated
rows and equal keys are different documents (equal texts of at least ``length`` bytes remove each
other); overlaps inside one document count; null keys are kept; an empty table gives an empty
result; other columns are ignored (``remove_repeats`` carries them untouched).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.llm import textarrays as ta
from postflow.llm.tables import merged, staged, table
from postflow.session import scratch, scratch_table

LENGTH = 200
GRAM = 32
BUCKET_SUFFIXES = 100_000
MOST_PAIRS = 20_000_000
FEW_CONTEXTS = 16
HEAVY = 20_000

_code = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all ``size``-byte strings of a buffer."""
    n = len(raw) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = ta._power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_code[raw] * up[:len(raw)], out=total[1:])
    return ta.mix((total[size:] - total[:n]) * down[:n])


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` consecutive values."""
    out, have = values, 1
    while 2 * have <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[:len(out) - (width - have)], out[width - have:]) if width > have else out


def anchors(raw: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM
            ) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a block, and gram hashes, of the anchors of its documents."""
    width = length - gram + 1
    hashes = gram_hashes(raw, gram)
    if len(hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = _slide(high, width, np.minimum)
    whole = np.zeros(len(least) + 1, np.int32)  # strings that lie in one document
    long = np.flatnonzero(np.diff(off) >= length)
    np.add.at(whole, off[long], 1)
    np.add.at(whole, off[long + 1] - length + 1, -1)
    whole = np.cumsum(whole[:-1]) > 0
    least = np.where(whole, least, 0)
    pad = np.zeros(width - 1, np.uint32)
    best = _slide(np.concatenate((pad, least, pad)), width, np.maximum)
    at = np.flatnonzero((best == high) & (high > 0))
    return at, hashes[at]


def _common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which ``known`` bytes are equal."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 8:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    while a[low] == b[low]:
        low += 1
    return low


def pack_run(items: list[tuple]) -> bytes:
    """A sorted run of ``(right, left, rid, pos, weight)``, its right parts front-coded."""
    numbers, parts, last = [], [], b""
    for right, left, rid, pos, weight in items:
        lcp = _common_prefix(last, right, 0)
        numbers.append((lcp, len(right) - lcp, len(left), rid, pos, weight))
        parts.append(right[lcp:])
        parts.append(left)
        last = right
    body = np.array(numbers, "<i8").T.tobytes() + b"".join(parts)
    return len(items).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def unpack_run(data: bytes) -> Iterator[tuple]:
    """``(common prefix with the one before, right, left, rid, pos, weight)`` in order."""
    n = int.from_bytes(data[:8], "little")
    body = zstandard.ZstdDecompressor().decompress(data[8:])
    numbers = np.frombuffer(body, "<i8", 6 * n).reshape(6, n).T.tolist()
    at, last = 48 * n, b""
    for lcp, rest, size, rid, pos, weight in numbers:
        last = last[:lcp] + body[at:at + rest]
        at += rest
        yield lcp, last, body[at:at + size], rid, pos, weight
        at += size


def merge_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """The items of sorted runs in order, each with its common prefix with the item before.

    ``key[i]`` is run ``i``'s next item and ``lcp[i]`` its common prefix with the last winner of the
    path it waits on. Of two candidates the one with the longer prefix is smaller; only where the
    prefixes are equal are bytes compared, from that length on, and the loser takes the result."""
    size = 1
    while size < len(runs):
        size *= 2
    key: list = [next(runs[i], None) if i < len(runs) else None for i in range(size)]
    lcp = [0] * size
    tree = [0] * size  # loser at each inner node, from 1

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two candidates."""
        x, y = key[a], key[b]
        if x is None:
            return b, a
        if y is None or lcp[a] > lcp[b]:
            return a, b
        if lcp[a] < lcp[b]:
            return b, a
        p, q = x[1], y[1]
        same = _common_prefix(p, q, lcp[a])
        if p[same:same + 1] <= q[same:same + 1]:
            lcp[b] = same
            return a, b
        lcp[a] = same
        return b, a

    winners = list(range(size))
    level = size
    while level > 1:
        half = []
        for i in range(0, len(winners), 2):
            won, lost = play(winners[i], winners[i + 1])
            tree[(level + i) // 2] = lost
            half.append(won)
        winners = half
        level //= 2
    top = winners[0]
    while key[top] is not None:
        yield (lcp[top], *key[top][1:])
        key[top] = next(runs[top], None)
        lcp[top] = key[top][0] if key[top] is not None else 0
        node, won = (size + top) // 2, top
        while node:
            won, tree[node] = play(won, tree[node])
            node //= 2
        top = won


def _span(pos: int, right: int, left: int, length: int) -> tuple[int, int] | None:
    """Bytes covered by strings through an anchor, if ``right`` bytes from it and ``left`` before
    it are repeated."""
    least = max(0, length - right)
    return (pos - left, pos - least + length) if least <= left else None


def _strings(item: tuple, length: int) -> dict:
    """Hashes of the strings of ``length`` bytes through an anchor at the offsets ``low`` to ``high``,
    from the greatest on. The offset is part of the hash: one string may hold several anchors, and
    equal strings hold them at equal offsets."""
    right, left, rid, pos, weight, low, high = item
    data = (left[len(left) - high:] + right)[:high - low + length]
    hashes = gram_hashes(np.frombuffer(data, np.uint8), length)
    hashes = ta.mix(hashes + np.arange(high, high - len(hashes), -1).astype(np.uint64))
    return {"rid": rid, "pos": pos, "weight": weight, "reach": high, "hashes": hashes.astype(np.int64)}


def _rows_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of a matrix, and their lengths."""
    sizes = np.array([len(p) for p in parts])
    rows = np.zeros((len(parts), int(sizes.max()) + 1), np.uint8)
    for i, part in enumerate(parts):
        rows[i, :len(part)] = np.frombuffer(part, np.uint8)
    return rows, sizes


def _common(rows: np.ndarray, sizes: np.ndarray, a, b) -> np.ndarray:
    """Lengths of the common prefixes of rows ``a`` and ``b``."""
    differ = rows[a] != rows[b]
    first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[a], sizes[b]))


def _few_spans(classes: list[list], length: int) -> tuple[list[int], list[int]]:
    n = len(classes)
    low, high = [length] * n, [-1] * n
    numbers = [int.from_bytes(c[2], "little") << 8 * (1024 - len(c[2])) for c in classes]
    for i in range(n):
        common = len(classes[i][1])
        for j in range(i + 1, n):
            common = min(common, classes[j][0])
            least = max(0, length - common)
            differ = (numbers[i] ^ numbers[j]).bit_length()
            left = min(1024 - (differ + 7) // 8, len(classes[i][2]), len(classes[j][2]))
            if least <= left:
                for c in (i, j):
                    low[c], high[c] = min(low[c], least), max(high[c], left)
    return low, high


def class_spans(classes: list[list], length: int, most_pairs: int
                ) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
    """Least and greatest offset of the strings that each of the sorted contexts ``[common prefix
    with the one before, right, left, ...]`` shares with any other (greatest -1 if none), and
    ``(context, lowest, highest possible offset)`` of what must be counted instead."""
    n = len(classes)
    if n <= FEW_CONTEXTS:
        return *_few_spans(classes, length), []
    rights, right_sizes = _rows_of([c[1] for c in classes])
    backward = [c[2][::-1] for c in classes]
    lefts, left_sizes = _rows_of(backward)
    low, high = np.full(n, length), np.full(n, -1)
    most = []
    for key, measure in ((lambda i: (classes[i][1], backward[i]), 0), (lambda i: (backward[i], classes[i][1]), 1)):
        order = np.array(sorted(range(n), key=key))
        a, b = order[:-1], order[1:]
        both = _common(rights, right_sizes, a, b), _common(lefts, left_sizes, a, b)
        longest = np.zeros(n, np.int64)
        least, left = np.maximum(0, length - both[0]), both[1]
        good = least <= left
        for side in (a, b):  # a context is at most once on either side
            longest[side] = np.maximum(longest[side], both[measure])
            low[side[good]] = np.minimum(low[side[good]], least[good])
            high[side[good]] = np.maximum(high[side[good]], left[good])
        most.append(longest)
    lowest, highest = np.maximum(0, length - most[0]), most[1]
    possible = lowest <= highest
    unsettled = np.flatnonzero(possible & ((low > lowest) | (high < highest)))
    if len(unsettled) * n > most_pairs:
        return low.tolist(), high.tolist(), [(i, int(lowest[i]), int(highest[i]))
                                             for i in np.flatnonzero(possible).tolist()]
    for i in unsettled.tolist():
        others = np.flatnonzero(possible)
        others = others[others != i]
        right = _common(rights, right_sizes, np.full(len(others), i), others)
        left = _common(lefts, left_sizes, np.full(len(others), i), others)
        least = np.maximum(0, length - right)
        good = least <= left
        if good.any():
            low[i], high[i] = min(low[i], least[good].min()), max(high[i], left[good].max())
    return low.tolist(), high.tolist(), []


def compare_group(group: list[tuple], length: int, most: int) -> tuple[list[tuple], list[tuple]]:
    """Of the suffixes ``(common prefix, right, left, rid, pos, weight)`` of one gram, in order: the
    repeated intervals ``(rid, start, end)``, and the suffixes whose strings must be counted."""
    classes: list[list] = []  # [common prefix with the class before, right, left, members]
    seen: dict[bytes, list] = {}
    previous = b""
    for lcp, right, left, rid, pos, weight in group:
        if not classes or not (lcp == len(right) == len(previous)):
            seen = {}
        previous = right
        if left in seen:
            seen[left][3].append((rid, pos, weight))
        else:
            seen[left] = [lcp, right, left, [(rid, pos, weight)]]
            classes.append(seen[left])
    intervals, pending = [], []
    for _, right, left, members in classes:
        if len(members) > 1 or members[0][2] > 1:
            span = _span(0, len(right), len(left), length)
            if span:
                intervals += [(rid, pos + span[0], pos + span[1]) for rid, pos, _ in members]
    low, high, uncounted = class_spans(classes, length, most)
    for i, lowest, highest in uncounted:
        _, right, left, members = classes[i]
        pending.append((right, left, *members[0][:2], min(2, sum(m[2] for m in members)), lowest, highest))
    for c, (_, _, _, members) in enumerate(classes):
        if high[c] >= low[c]:
            intervals += [(rid, pos - high[c], pos - low[c] + length) for rid, pos, _ in members]
    return intervals, pending


_OUT = T.StructType([
    T.StructField("kind", T.IntegerType()),  # 0: interval, 1: run, 2: strings to count
    T.StructField("rid", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("weight", T.LongType()),
    T.StructField("bucket", T.LongType()), T.StructField("run", T.BinaryType()),
    T.StructField("hashes", T.ArrayType(T.LongType()))])
_ARROW = pa.schema([("kind", pa.int32()), ("rid", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                    ("weight", pa.int64()), ("bucket", pa.int64()), ("run", pa.binary()),
                    ("hashes", pa.list_(pa.int64()))])


def _out(intervals=(), runs=(), pending=(), length: int = LENGTH, buckets: int = 1
         ) -> Iterator[pa.RecordBatch]:
    """Result rows in batches of bounded size. All have a bucket: what is settled goes through the
    same exchange as the runs and is passed on there. Intervals of a row that touch are one."""
    joined: list[list[int]] = []
    for rid, start, end in sorted(intervals):
        if joined and joined[-1][0] == rid and start <= joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], end)
        else:
            joined.append([rid, start, end])
    rows = [(0, r, a, b, None, r % buckets, None, None) for r, a, b in joined]
    rows += [(1, None, None, None, None, k, data, None) for k, data in runs]
    for lo in range(0, len(rows), 20_000):
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[lo:lo + 20_000]), _ARROW)],
                              schema=_ARROW)
    for lo in range(0, len(pending), 4096):
        found = [_strings(item, length) for item in pending[lo:lo + 4096]]
        found = [s for s in found if len(s["hashes"])]
        if found:
            rows = [(2, s["rid"], s["pos"], s["reach"], s["weight"], s["rid"] % buckets, None,
                     s["hashes"]) for s in found]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _anchor_rows(rows: DataFrame, at: int, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, _, raw, off in ta.blocks(batch.column(0).field(at)):
                place, hashes = anchors(raw, off, length, gram)
                doc = np.searchsorted(off, place, "right") - 1
                yield pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(ids[lo + doc]),
                                       pa.array(place - off[doc])], ["gram", "rid", "pos"])

    return rows.mapInArrow(run, "gram long, rid long, pos long")


def _contexts(batch: pa.RecordBatch, length: int, reach: int) -> tuple[dict[tuple, list], list[tuple]]:
    """``{(right, left): [rid, pos, weight, gram, heavy]}`` of a batch of texts and places, and the
    intervals that equal contexts prove."""
    contexts: dict[tuple, list] = {}
    intervals = []
    for text, rid, places in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(),
                                 batch.column(2).to_pylist()):
        data = text.as_py()
        for place in places:
            pos = place["pos"]
            context = data[pos:pos + length], data[max(0, pos - reach):pos]
            found = contexts.get(context)
            if found is None:
                contexts[context] = [rid, pos, 1, place["gram"], place["heavy"]]
                continue
            span = _span(0, len(context[0]), len(context[1]), length)
            if span:
                if found[2] == 1:
                    intervals.append((found[0], found[1] + span[0], found[1] + span[1]))
                intervals.append((rid, pos + span[0], pos + span[1]))
            found[2] = 2
    return contexts, intervals


def _halves(right: bytes, left: bytes, half: int) -> Iterator[tuple[int, int]]:
    """``(side, hash of the half)``: side 1 is the right, side 2 the left."""
    for side, part in ((1, right[:half]), (2, left[-half:])):
        if len(part) == half:
            data = bytes([side]) + part
            yield side, int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little") >> 1


def _answered(side: int, lowest: int, highest: int, length: int) -> tuple[int, int]:
    """The offsets from ``lowest`` to ``highest`` that a side of a heavy gram answers for (0: any)."""
    cut = length - length // 2
    return (max(lowest, cut + 1) if side == 2 else lowest), (min(highest, cut) if side == 1 else highest)


def _crowded(texts: DataFrame, length: int, gram: int, most: int) -> frozenset[int]:
    """Halves of heavy grams that more than ``most`` suffixes share; there is at most one for every
    ``most / 2`` suffixes of heavy grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, int] = {}
            for (right, left), (*_, heavy) in _contexts(batch, length, length - gram)[0].items():
                for _, key in _halves(right, left, length // 2) if heavy else ():
                    counts[key] = counts.get(key, 0) + 1
            yield pa.record_batch([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                  ["half", "c"])

    halves = texts.mapInArrow(run, "half long, c long").groupBy("half").agg(F.sum("c").alias("c"))
    return frozenset(r["half"] for r in halves.filter(F.col("c") > most).select("half").collect())


def _runs(texts: DataFrame, buckets: int, length: int, gram: int, crowded: frozenset[int]) -> DataFrame:
    """From ``(text, rid, places array<struct<pos, gram, heavy>>)``: intervals, runs, and the strings
    that crowded halves answer for. Buckets from 0 on hold grams, and halves to the right of heavy
    ones; from ``buckets`` on, halves to the left. Weights of heavy suffixes hold the side, too."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contexts, intervals = _contexts(batch, length, length - gram)
            sorted_runs: dict[int, list] = {}
            pending = []
            for (right, left), (rid, pos, weight, key, heavy) in contexts.items():
                if not heavy:
                    sorted_runs.setdefault(key % buckets, []).append((right, left, rid, pos, weight))
                    continue
                for side, key in _halves(right, left, half):
                    if key not in crowded:
                        bucket = key % buckets + (buckets if side == 2 else 0)
                        sorted_runs.setdefault(bucket, []).append((right, left, rid, pos, weight + 4 * side))
                        continue
                    lowest, highest = _answered(side, max(0, length - len(right)), len(left), length)
                    if lowest <= highest:
                        pending.append((right, left, rid, pos, weight, lowest, highest))
            yield from _out(intervals, ((k, pack_run(sorted(items))) for k, items in sorted_runs.items()),
                            pending, length, buckets)

    return texts.mapInArrow(run, _OUT)


def _merged(runs: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """Intervals and strings of all buckets."""

    def merge(part: pa.Table) -> pa.Table:
        intervals, pending, group = [], [], []
        side = 0

        def close() -> None:
            if len(group) > 1:
                found = compare_group(group, length, most)
                intervals.extend(found[0])
                for *item, lowest, highest in found[1]:
                    lowest, highest = _answered(side, lowest, highest, length)
                    if lowest <= highest:
                        pending.append((*item, lowest, highest))
            group.clear()

        is_run = np.array(part.column("kind").to_numpy() == 1)
        for item in merge_runs([unpack_run(r.as_py()) for r in part.column("run").filter(pa.array(is_run))]):
            if item[0] < gram:
                close()
            side = item[5] >> 2
            group.append((*item[:5], item[5] & 3))
        close()
        settled = part.filter(pa.array(~is_run)).select(_ARROW.names).cast(_ARROW)
        return pa.concat_tables([settled, pa.Table.from_batches(
            list(_out(intervals, (), pending, length)), schema=_ARROW)])

    return runs.groupBy("bucket").applyInArrow(merge, _OUT)


def _dealt(rows: DataFrame, at: int, length: int, gram: int, heavy: int, bucket_suffixes: int
           ) -> tuple[DataFrame, DataFrame | None]:
    """Of the rows ``(row, rid)``: runs and intervals, and the strings of crowded halves (``_OUT``)."""
    text = rows.schema["row"].dataType[at].name
    found = staged(_anchor_rows(rows, at, length, gram), "repeat-anchors")
    # Written first: a join of plain scans is one whose hot grams adaptive execution can split.
    counts = staged(found.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1"), "repeat-grams")
    places = found.join(merged(counts), "gram").groupBy("rid").agg(F.collect_list(F.struct(
        "pos", "gram", (F.col("c") > heavy).alias("heavy"))).alias("places"))
    places = staged(places, "repeat-places")
    kept = places.agg(F.sum(F.size("places")).alias("n"),
                      F.max(F.exists("places", lambda p: p["heavy"])).alias("heavy")).first()
    texts = rows.select("rid", F.col("row").getField(text).alias("text")).join(merged(places), "rid") \
        .select("text", "rid", "places")
    crowded = _crowded(texts, length, gram, bucket_suffixes) if kept["heavy"] else frozenset()
    runs = _runs(texts, max(1, -(-(kept["n"] or 0) // bucket_suffixes)), length, gram, crowded)
    if not crowded:
        return runs, None
    runs = staged(runs, "repeat-runs")  # the strings do not go through the buckets
    return runs.filter("kind < 2"), runs.filter("kind = 2")


def repeated_spans(rows: DataFrame, at: int, length: int = LENGTH, gram: int = GRAM,
                   most_pairs: int = MOST_PAIRS, heavy: int = HEAVY,
                   bucket_suffixes: int = BUCKET_SUFFIXES) -> DataFrame:
    """``(rid, spans array<struct<start, end>>)`` of the rows ``(row, rid)`` with repeats; field
    ``at`` of ``row`` is the text. Spans may overlap."""
    runs, early = _dealt(rows, at, length, gram, heavy, bucket_suffixes)
    both = staged(_merged(runs, length, gram, most_pairs), "repeat-merged")
    late = both.filter("kind = 2")
    strings = (late if early is None else late.unionByName(early)).select(
        "rid", F.col("start").alias("pos"), "weight", "end", F.posexplode("hashes").alias("i", "hash")) \
        .select("rid", "pos", "weight", (F.col("end") - F.col("i")).alias("offset"), "hash")
    # Written, so that adaptive execution can split the strings of a hot hash.
    repeated = staged(strings.groupBy("hash").agg(F.sum("weight").alias("c")).filter("c > 1").select("hash"),
                      "repeat-strings")
    counted = strings.join(merged(repeated), "hash").groupBy("rid", "pos").agg(
        (F.col("pos") - F.max("offset")).alias("start"),
        (F.col("pos") - F.min("offset") + length).alias("end"))
    spans = both.filter("kind = 0").select("rid", "start", "end") \
        .unionByName(counted.select("rid", "start", "end"))
    return spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def kept_bytes(data: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal removed runs."""
    if not spans:
        return data, 0
    parts, runs, at = [], 0, 0
    reached = -1
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if start > reached:
            runs += 1
            parts.append(data[at:start])
        reached = max(reached, end)
        at = reached
    parts.append(data[at:])
    return b"".join(parts), runs


def _numbered(df: DataFrame) -> DataFrame:
    """Every row as one struct with a row id, written once so that the ids stay, as an external
    table in the shared folder that is bucketed by the id."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.monotonically_increasing_id().alias("rid"))
    path = scratch(spark, "repeat-rows")
    name = "postflow_" + path.rsplit("/", 1)[1].replace("-", "_")
    (rows.repartition(n, "rid").write.bucketBy(n, "rid").format("parquet").option("path", path)
     .option("compression", "zstd").saveAsTable(name))
    scratch_table(name)
    return spark.table(name)


def measure_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    rows = _numbered(df.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                               F.col(f"`{text}`").cast("string").alias("text")))
    spans = repeated_spans(rows, 1, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, found in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
                data = value.as_py() or b""
                kept, n = kept_bytes(data, found.as_py())
                out.append((len(data), len(data) - len(kept), n, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.record_batch([batch.column(0)] + [pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return (rows.join(merged(spans), "rid", "left").select("row.doc_id", "row.text", "spans")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def remove_repeats(df: DataFrame, text: str = "text", size: str | None = None, **options) -> DataFrame:
    """All rows and columns, with the repeated bytes cut out of ``text`` (parts of a character left
    at a cut go too); ``size``, if given, is set to the new number of characters."""
    rows = _numbered(df)
    names = df.columns
    at = names.index(text)
    spans = repeated_spans(rows, at, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out, sizes = batch.column(0), [], []
            for value, found in zip(row.field(at), batch.column(1)):
                value, found = value.as_py(), found.as_py()
                if found:
                    value = kept_bytes(value.encode(), found)[0].decode(errors="ignore")
                out.append(value)
                sizes.append(None if value is None else len(value))
            columns = [row.field(i) for i in range(len(names))]
            columns[at] = pa.array(out, columns[at].type)
            if size is not None:
                i = names.index(size)
                columns[i] = pa.array(sizes).cast(columns[i].type)
            yield pa.record_batch(columns, names)

    return rows.join(merged(spans), "rid", "left").select("row", "spans").mapInArrow(run, df.schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_repeats(table(spark, sf_dir, "documents"))
