"""Quality classifier: a generalised additive model with pairwise interactions (operator 4).

Every text gets a fixed list of numeric features, computed from the whole text in one narrow pass.
The model is a lookup table per feature and per chosen pair of features, learned by cyclic boosting:
in every round each feature in turn fits a shallow tree (a few leaves over its bins) to the current
logistic gradients, damped by a learning rate, and adds it to its table. Pairs are ranked by the
loss that one four-leaf tree over both features would still remove, and the best are boosted the
same way. Scoring is a search of bin edges and additions of table entries, on arrays.

Training uses at most ``train_rows`` labelled rows (those with the smallest hashes of their key);
the tables are of fixed size. Everything else runs over all rows.

Edge cases: null and empty texts have all-zero features and are scored; repeated rows and keys give
a row each; a null key is kept and is not held out; labels that are null do not train; without
labels of both kinds, every score is the smoothed share of label 1 (0.5 without any). An empty
table gives an empty result; other columns are ignored (``keep_quality`` carries them untouched).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import textarrays as ta
from postflow.llm.tables import table, two_columns

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "punctuation", "digits", "line_words", "stops",
    "commas", "shouts", "symbols", "distinct_words", "distinct_triples", "distinct_lines", "top_word",
    "long_words", "short_words", "wide", "symbol_words", "longest_word", "triple_runs")

_UPPER = ta._byte_set((65, 90))
_LETTER = ta._byte_set((65, 90), (97, 122), (128, 255))
_DIGIT = ta._byte_set((48, 57))
_PUNCT = ta._byte_set((33, 47), (58, 64), (91, 96), (123, 126))
_SYMBOL = ta._byte_set((35, 38), (42, 43), (47, 47), (60, 62), (64, 64), (92, 96), (123, 126))
_WIDE = ta._byte_set((128, 255))


def _one(byte: str) -> np.ndarray:
    return ta._byte_set((ord(byte), ord(byte)))


def block_features(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` per document of a block."""
    docs = len(off) - 1
    out = np.zeros((docs, len(FEATURES)))
    starts, ends, first = ta.word_spans(raw, off, ta.NONSPACE)
    words = ta.span_hashes(raw, starts, ends)
    triples, third = ta.shingles(words, first, 3)
    line_start, line_end, line = ta.word_spans(raw, off, ~_one("\n"))
    lines = ta.span_hashes(raw, line_start, line_end)
    size, n_words = np.diff(off).astype(float), np.diff(first).astype(float)
    length = (ends - starts).astype(float)

    def total(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values, dtype=float)))
        return sums[at[1:]] - sums[at[:-1]]

    def bytes_of(flags: np.ndarray) -> np.ndarray:
        return total(flags[raw], off)

    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(n_words, 1)
    letters = np.maximum(bytes_of(_LETTER), 1)
    symbol_sums = np.concatenate(([0], np.cumsum(_SYMBOL[raw])))
    has_symbol = symbol_sums[ends] > symbol_sums[starts]
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(n_words)
    out[:, 2] = total(length, first) * per_word
    out[:, 3] = bytes_of(_UPPER) / letters
    out[:, 4] = bytes_of(_PUNCT) * per_byte
    out[:, 5] = bytes_of(_DIGIT) * per_byte
    out[:, 6] = n_words / np.maximum(np.diff(line), 1)
    out[:, 7] = bytes_of(_one(".")) * per_word
    out[:, 8] = bytes_of(_one(",")) * per_word
    out[:, 9] = bytes_of(_one("!")) * per_word
    out[:, 10] = bytes_of(_SYMBOL) * per_byte
    out[:, 15] = total(length >= 14, first) * per_word
    out[:, 16] = total(length <= 3, first) * per_word
    out[:, 17] = bytes_of(_WIDE) * per_byte
    out[:, 18] = total(has_symbol, first) * per_word
    full = np.flatnonzero(n_words > 0)
    if len(full):
        out[full, 19] = np.log1p(np.maximum.reduceat(length, first[full]))
    for d in full.tolist():
        own, counts = np.unique(words[first[d]:first[d + 1]], return_counts=True)
        out[d, 11] = len(own) * per_word[d]
        out[d, 14] = counts.max() * per_word[d]
        own, counts = np.unique(triples[third[d]:third[d + 1]], return_counts=True)
        out[d, 12] = len(own) / (third[d + 1] - third[d])
        out[d, 20] = np.log1p(counts.max())
        out[d, 13] = len(np.unique(lines[line[d]:line[d + 1]])) / max(1, line[d + 1] - line[d])
    return out


def features_of(column: pa.Array) -> np.ndarray:
    parts = [block_features(raw, off) for _, _, raw, off in ta.blocks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Gam:
    """Tables of an additive model with pairs: log-odds are ``base`` plus one entry per table."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.int64)
        for j, edges in enumerate(self.edges):
            out[:, j] = np.searchsorted(edges, x[:, j], "right")
        return out

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        if not self.tables:
            return score
        bins = self.bins(x)
        for j, table_ in enumerate(self.tables):
            score += table_[bins[:, j]]
        for i, j, table_ in self.pairs:
            score += table_[bins[:, i], bins[:, j]]
        return score

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def _leaves(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int, least: int, l2: float) -> np.ndarray:
    """Newton steps of a shallow tree over ordered bins, grown by best splits."""
    cg, ch, cn = (np.concatenate(([0.0], np.cumsum(v))) for v in (g, h, n))

    def best(a: int, b: int) -> tuple[float, int]:
        cut = np.arange(a + 1, b)
        if not len(cut):
            return 0.0, -1
        lg, lh, ln = cg[cut] - cg[a], ch[cut] - ch[a], cn[cut] - cn[a]
        rg, rh, rn = cg[b] - cg[cut], ch[b] - ch[cut], cn[b] - cn[cut]
        gain = lg**2 / (lh + l2) + rg**2 / (rh + l2) - (cg[b] - cg[a])**2 / (ch[b] - ch[a] + l2)
        gain[(ln < least) | (rn < least)] = 0
        i = int(np.argmax(gain))
        return float(gain[i]), int(cut[i])

    parts = [(0, len(g), *best(0, len(g)))]
    while len(parts) < leaves:
        i = max(range(len(parts)), key=lambda k: parts[k][2])
        a, b, gain, cut = parts[i]
        if gain <= 1e-9:
            break
        parts[i:i + 1] = [(a, cut, *best(a, cut)), (cut, b, *best(cut, b))]
    out = np.zeros(len(g))
    for a, b, _, _ in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + l2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Gain and Newton steps of the best four-leaf tree (one cut in each of two features)."""
    cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
    rows, cols = np.arange(1, g.shape[0]), np.arange(1, g.shape[1])
    if not len(rows) or not len(cols):
        return 0.0, np.zeros_like(g)
    a, b = np.ix_(rows, cols)

    def four(c: np.ndarray) -> list[np.ndarray]:
        top, left, all_ = c[a, -1], c[-1, b], c[-1, -1]
        return [c[a, b], top - c[a, b], left - c[a, b], all_ - top - left + c[a, b]]

    gs, hs = four(cg), four(ch)
    gain = sum(x**2 / (y + l2) for x, y in zip(gs, hs))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(g)
    r, c = rows[i], cols[j]
    steps = [x[i, j] / (y[i, j] + l2) for x, y in zip(gs, hs)]
    out[:r, :c], out[:r, c:], out[r:, :c], out[r:, c:] = steps
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 200, pair_rounds: int = 60, pairs: int = 8,
        rate: float = 0.1, max_bins: int = 64, leaves: int = 4, least: int = 5, l2: float = 1.0) -> Gam:
    """The model of rows ``x`` with labels ``y`` (0 or 1)."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    for j in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, max_bins + 1)[1:-1], method="inverted_cdf"))
        model.edges.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
    bins = model.bins(x)
    count = [np.bincount(bins[:, j], minlength=len(t)).astype(float) for j, t in enumerate(model.tables)]
    score = np.full(len(y), model.base)
    for _ in range(rounds):
        for j, table_ in enumerate(model.tables):
            p = 1 / (1 + np.exp(-score))
            g = np.bincount(bins[:, j], y - p, len(table_))
            h = np.bincount(bins[:, j], p * (1 - p), len(table_))
            step = rate * _leaves(g, h, count[j], leaves, least, l2)
            table_ += step
            score += step[bins[:, j]]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[int, int]]:
        shape = len(model.tables[i]), len(model.tables[j])
        cell = bins[:, i] * shape[1] + bins[:, j]
        p = 1 / (1 + np.exp(-score))
        size = shape[0] * shape[1]
        return (np.bincount(cell, y - p, size).reshape(shape),
                np.bincount(cell, p * (1 - p), size).reshape(shape), cell, shape)

    ranked = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            g, h, _, _ = grids(i, j)
            ranked.append((_quadrants(g, h, l2)[0], i, j))
    ranked.sort(key=lambda r: (-r[0], r[1:]))
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for _, i, j in ranked[:pairs]]
    for _ in range(pair_rounds):
        for i, j, table_ in model.pairs:
            g, h, cell, _ = grids(i, j)
            step = rate * _quadrants(g, h, l2)[1]
            table_ += step
            score += step.ravel()[cell]
    return model


def held_out(key: str | Column = "doc_id") -> Column:
    """True where crc32 of the key as text leaves 2 when divided by 4."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label_key: str = "doc_id", label: str = "quality", train_rows: int = 20_000) -> Gam:
    """The model learned from at most ``train_rows`` labelled rows that are not held out."""
    chosen = labels.select(F.col(f"`{label_key}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
    chosen = (chosen.filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(train_rows))
    # At most train_rows keys: small by definition.
    marked = two_columns(docs, key, text).join(F.broadcast(chosen), "doc_id").select("text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features_of(batch.column(0))
            yield pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary()),
                                   batch.column(1).cast(pa.int32())], ["x", "y"])

    # A key that many rows carry must not widen the sample.
    rows = marked.mapInArrow(run, "x binary, y int").limit(train_rows).collect()
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(len(rows), len(FEATURES))
    order = np.lexsort(x.T[::-1]) if len(rows) else []
    return fit(x[order], np.array([r["y"] for r in rows], float)[order])


def score_quality(docs: DataFrame, model: Gam, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0).cast(pa.int64()),
                                   pa.array(model.probability(features_of(batch.column(1))))],
                                  ["doc_id", "score"])

    return two_columns(docs, key, text).mapInArrow(run, "doc_id long, score double")


def keep_quality(docs: DataFrame, model: Gam, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows that score at least ``threshold``, all columns untouched."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.probability(features_of(batch.column(at))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))
