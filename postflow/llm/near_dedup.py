"""MinHash near-duplicates by a signature-coordinate inverted join (operator 9).

1. One pass over the whole texts: set of ``k``-word shingles (64-bit hashes), its size and digest,
   and a MinHash signature of ``n`` coordinates, each a token (coordinate, value). Texts with equal
   sets are one class; only classes go on, so exact copies are never paired.
2. Classes are posted under their tokens. Two classes over the similarity threshold agree in at
   least ``t`` of ``n`` tokens (``t`` is the largest count whose binomial tail at the threshold is
   at most ``MISS``). Tokens that only one class holds are dropped; a class left with fewer than
   ``t`` is done. Ordered by frequency, rarest first, two classes with ``t`` common tokens share
   one of their first ``n - t + 1`` (the prefix); only these are posted. The postings build
   clusters only; collisions are not counted by merging them.
3. Classes that share a posting, directly or through others, form a cluster (components of the
   stars posting list - smallest class, linear in the postings). In a large table single tokens chain
   most classes to one cluster. A cluster of more than one part is therefore cut up again, by sets of
   ``r`` tokens: the coordinates are dealt into so few groups that ``t`` equal ones put ``r`` into one
   group, so two classes with ``t`` common tokens share a set and stay together. Members are posted
   under the sets, at most ``MOST_SETS`` each, a larger ``r`` for clusters that remain large; a
   member that shares no set is done. A cluster's members are dealt by
   hash into parts of about ``part_bytes`` of shingle sets, and every two parts meet in one task: each set
   is exchanged once per part of its cluster, ``B * B / part_bytes`` for a cluster of ``B`` bytes. The
   task compares the tokens of every two members, retains pairs with ``t`` or more, and confirms them on the full sets.
   Only links that join two groups of the task are returned, at most one less than its members, so
   neither pairs nor links of a large group are listed.
4. Components by alternating stars; every row gets the smallest key of its component.

Edge cases: null and empty texts, or texts without words, have an empty set and are linked with
nothing; a text of fewer than ``k`` words is one shingle, its whole word sequence; repeated rows
are one class; a null key does not count as smallest unless the component has no other (then the
component id is null); an empty table gives an empty result; other columns are carried untouched.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.llm import textarrays as ta
from postflow.llm.components import components
from postflow.llm.tables import merged, staged, table

N = 32
#: Chance that a pair exactly at the threshold agrees in fewer than ``t`` tokens.
MISS = 1e-5
PART_BYTES = 2 << 20
#: Token sets under which a member of a large cluster is posted.
MOST_SETS = 300

_seeds = np.random.default_rng(9).integers(1, 2**63, (64, 2), dtype=np.uint64) | np.uint64(1)


def least_matches(n: int, percent: int, miss: float = MISS) -> int:
    """The largest ``t`` with P(Binomial(n, percent / 100) < t) <= miss."""
    p, tail, t = percent / 100, 0.0, 0
    while t < n:
        tail += math.comb(n, t) * p**t * (1 - p)**(n - t)
        if tail > miss:
            break
        t += 1
    return max(1, t)


def token_sets(n: int, t: int, r: int) -> np.ndarray:
    """Coordinates of sets of ``r`` tokens, ``(sets, r)``; any ``t`` of ``n`` coordinates hold one of
    them (``2 <= r <= t``): the groups are so few that ``r - 1`` from each are less than ``t``."""
    groups = np.array_split(np.arange(n), (t - 1) // (r - 1))
    return np.array([c for g in groups for c in itertools.combinations(g.tolist(), r)]).reshape(-1, r)


def _refining(n: int, t: int) -> list[np.ndarray]:
    """Token sets for large clusters: a first cut, and the largest sets that are few enough."""
    fit = [r for r in range(2, t + 1) if sum(math.comb(len(g), r) for g in np.array_split(
        np.arange(n), (t - 1) // (r - 1))) <= MOST_SETS]
    return [token_sets(n, t, r) for r in sorted({min(3, max(fit)), max(fit)})] if fit else []


def _shingle_sets(column: pa.Array, k: int, table_: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per block of whole texts: shingle hashes and document offsets into them."""
    for _, _, raw, off in ta.blocks(column):
        starts, ends, first = ta.word_spans(raw, off, table_)
        yield ta.shingles(ta.span_hashes(raw, starts, ends), first, k)


def signatures(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Tokens ``coordinate << 32 | minimum`` of each document with shingles, as rows."""
    begin = at[:-1][np.diff(at) > 0]
    out = np.empty((len(begin), n), np.int64)
    if len(begin):
        for j in range(n):
            values = ((hashes ^ _seeds[j, 0]) * _seeds[j, 1]) >> np.uint64(32)
            out[:, j] = np.minimum.reduceat(values, begin).astype(np.int64) | (j << 32)
    return out


def _signed(df: DataFrame, text: str, k: int, words: np.ndarray, n: int) -> DataFrame:
    """``row`` (all columns), ``rid``, ``n_shingles``, ``digest`` and ``tokens`` of every row."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.monotonically_increasing_id().alias("rid"))
    at = df.columns.index(text)
    schema = T.StructType([
        rows.schema["row"], rows.schema["rid"], T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("tokens", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, tokens = [], [], []
            for hashes, first in _shingle_sets(batch.column(0).field(at), k, words):
                signed = iter(signatures(hashes, first, n))
                for a, b in zip(first[:-1], first[1:]):
                    own = np.unique(hashes[a:b])
                    sizes.append(len(own))
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    tokens.append(next(signed) if b > a else None)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
                ["row", "rid", "n_shingles", "digest", "tokens"])

    return rows.mapInArrow(run, schema)


def _shingled(signed: DataFrame, wanted: DataFrame, text: str, k: int, words: np.ndarray) -> DataFrame:
    """Full shingle sets of the wanted rows, ``(rid, set)``."""
    texts = signed.select("rid", F.col("row").getField(text).alias("text")).join(merged(wanted), "rid", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.unique(hashes[a:b]).tobytes()
                   for hashes, first in _shingle_sets(batch.column(1), k, words)
                   for a, b in zip(first[:-1], first[1:])]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["rid", "set"])

    return texts.mapInArrow(run, "rid long, set binary")


def forest_links(rids: list[int], parts: np.ndarray, tokens: np.ndarray, sets: list[np.ndarray],
                 t: int, percent: int) -> list[tuple[int, int]]:
    """Links that join all members of one part, or of two, that the confirmed pairs connect. With
    two parts, pairs inside one are left to the task that has this part alone."""
    parent = list(range(len(rids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    begin = np.concatenate(([0], np.cumsum(sizes)))
    known, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = [codes[i:j] for i, j in zip(begin[:-1], begin[1:])]
    mark = np.zeros(len(known), np.int32)
    two = len(np.unique(parts)) > 1
    links = []
    for a in range(len(rids) - 1):
        hits = (tokens[a + 1:] == tokens[a]).sum(1) >= t
        if two:
            hits &= parts[a + 1:] != parts[a]
        near = [b for b in (np.flatnonzero(hits) + a + 1).tolist() if root(b) != root(a)]
        if not near:
            continue
        mark[codes[a]] = 1
        at = np.concatenate(([0], np.cumsum(sizes[near])[:-1]))
        both = np.add.reduceat(mark[np.concatenate([codes[b] for b in near])], at)
        mark[codes[a]] = 0
        for i in np.flatnonzero(100 * both >= percent * (sizes[a] + sizes[near] - both)).tolist():
            x, y = root(a), root(near[i])
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((rids[a], rids[near[i]]))
    return links


def _cluster_links(members: DataFrame, t: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` among ``(pair, part, rid, tokens, set)``; ``pair`` names a cluster and two of
    its parts. It is one column, so that rows dealt by cluster are dealt anew."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        tokens = group.column("tokens").combine_chunks()
        links = forest_links(
            group.column("rid").to_pylist(), group.column("part").to_numpy(),
            tokens.flatten().to_numpy(zero_copy_only=False).reshape(len(tokens), -1),
            [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("set")], t, percent)
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return members.groupBy("pair").applyInArrow(run, "a long, b long")


def _keyed(members: DataFrame, subsets: np.ndarray) -> DataFrame:
    """``(rid, key)``: a hash of the cluster and the tokens of every subset of ``(rid, cluster, tokens)``.
    Equal hashes of other tokens only keep members together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column(0).to_numpy()
            tokens = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(rids), -1).view(np.uint64)
            keys = np.repeat(batch.column(1).to_numpy().view(np.uint64)[:, None], len(subsets), 1)
            for i in range(subsets.shape[1]):
                keys = (keys ^ tokens[:, subsets[:, i]]) * _seeds[i, 1]
                keys ^= keys >> np.uint64(32)
            yield pa.record_batch([pa.array(np.repeat(rids, len(subsets))), pa.array(keys.ravel().view(np.int64))],
                                  ["rid", "key"])

    return members.select("rid", "cluster", "tokens").mapInArrow(run, "rid long, key long")


def _parts(sized: DataFrame, part_bytes: int) -> DataFrame:
    """``(cluster, parts)``; written, so that adaptive execution can split a join with a large cluster."""
    return staged(sized.groupBy("cluster").agg(
        F.ceil(F.sum("n_shingles") * 8 / part_bytes).alias("parts")), "near-parts")


def sized_clusters(clusters: DataFrame, classes: DataFrame, n: int, t: int, part_bytes: int
                   ) -> tuple[DataFrame, DataFrame]:
    """``(rid, cluster, n_shingles)`` and ``(cluster, parts)`` for the clusters ``(rid, cluster)``, those
    of more than one part cut up by token sets. Members with ``t`` common tokens stay together."""
    sized = staged(clusters.join(merged(classes.select("rid", "n_shingles")), "rid")
                   .select("rid", "cluster", "n_shingles"), "near-sized")
    parts = _parts(sized, part_bytes)
    for subsets in _refining(n, t):
        large = parts.filter("parts > 1").select("cluster")
        if large.isEmpty():
            break
        members = staged(sized.join(merged(large), "cluster", "left_semi")
                         .join(merged(classes.select("rid", "tokens")), "rid"), "near-large")
        keys = _keyed(members, subsets)
        heads = staged(keys.groupBy("key").agg(F.min("rid").alias("head"), F.count("*").alias("c"))
                       .filter("c > 1").select("key", "head"), "near-heads")
        stars = keys.join(merged(heads), "key").select(F.col("rid").alias("a"), F.col("head").alias("b"))
        cut = components(stars, "near-cut").select(F.col("node").alias("rid"), F.col("component").alias("cluster"))
        sized = staged(sized.join(merged(large), "cluster", "left_anti").select("rid", "cluster", "n_shingles")
                       .unionByName(cut.join(merged(members.select("rid", "n_shingles")), "rid")), "near-sized")
        parts = _parts(sized, part_bytes)
    return sized, parts


def linked_rows(df: DataFrame, key: str, text: str, k: int, percent: int, words: np.ndarray,
                n: int = N, part_bytes: int = PART_BYTES) -> tuple[DataFrame, DataFrame]:
    """``signed`` rows (see ``_signed``) and ``(digest, component_id, keeper)`` per class, where
    ``component_id`` is the smallest key of the component and ``keeper`` the row id of one row
    with that key."""
    t = least_matches(n, percent)
    signed = staged(_signed(df, text, k, words, n), "near-signed")
    ordered = F.struct(F.col("row").getField(key).isNull().alias("none"),
                       F.col("row").getField(key).alias("key"), F.col("rid").alias("rid"))
    classes = staged(signed.groupBy("digest", "n_shingles").agg(
        F.min("rid").alias("rid"), F.min(ordered).alias("least"),
        F.first("tokens").alias("tokens")), "near-classes")
    posts = classes.filter("n_shingles > 0").select("rid", F.explode("tokens").alias("token"))
    shared = posts.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1")
    own = F.sort_array(F.collect_list(F.struct("c", "token")))  # at most n elements
    posted = (posts.join(merged(shared), "token").groupBy("rid").agg(own.alias("own"))
              .filter(F.size("own") >= t)
              .select("rid", F.slice("own.token", F.lit(1), F.size("own") - (t - 1)).alias("prefix")))
    posted = staged(posted, "near-posted")
    lists = posted.select("rid", F.explode("prefix").alias("token"))
    heads = lists.groupBy("token").agg(F.min("rid").alias("head"))
    stars = lists.join(merged(heads), "token").select(F.col("rid").alias("a"), F.col("head").alias("b"))
    clusters = components(stars, "near-clusters").select(F.col("node").alias("rid"),
                                                         F.col("component").alias("cluster"))
    # Parts are settled on sizes alone, so that the sets are exchanged by row id and by pair only.
    sized, parts = sized_clusters(clusters, classes, n, t, part_bytes)
    sets = staged(_shingled(signed, sized.select("rid"), text, k, words), "near-sets")
    dealt = (sized.join(merged(parts), "cluster")
             .withColumn("part", F.pmod(F.xxhash64("rid"), "parts"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .select(F.concat_ws("-", "cluster", F.least("part", "other"), F.greatest("part", "other")).alias("pair"),
                     "part", "rid")
             .join(merged(sets), "rid").join(merged(classes.select("rid", "tokens")), "rid")
             .select("pair", "part", "rid", "tokens", "set"))
    links = staged(_cluster_links(dealt, t, percent), "near-links")
    comps = components(links, "near-comp")
    classes = (classes.join(merged(comps), F.col("rid") == F.col("node"), "left")
               .select("digest", "n_shingles", "rid", "least", F.coalesce("component", "rid").alias("comp")))
    least = classes.groupBy("comp").agg(F.min("least").alias("least_of_comp"))
    out = classes.join(merged(least), "comp").select("digest", F.col("least_of_comp.key").alias("component_id"),
                                             F.col("least_of_comp.rid").alias("keeper"))
    return signed, out


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5,
                    percent: int = 80, words: np.ndarray = ta.NONSPACE, n: int = N) -> DataFrame:
    """One row per input row: key, set size, smallest key of its component, and whether it is that
    key's row. Rows of the empty set are components of their own."""
    signed, classes = linked_rows(df, key, text, k, percent, words, n)
    some = signed.select(F.col("row").getField(key).alias("doc_id"), "n_shingles", "digest")
    empty = some.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return (some.filter("n_shingles > 0").join(merged(classes), "digest")
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
            .unionByName(empty))


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5,
                         percent: int = 80, words: np.ndarray = ta.NONSPACE, n: int = N) -> DataFrame:
    """One row of each component (the smallest key; of repeated rows, one), all columns untouched;
    rows without words stay."""
    signed, classes = linked_rows(df, key, text, k, percent, words, n)
    kept = signed.join(merged(classes.select(F.col("keeper").alias("rid")).distinct()), "rid", "left_semi") \
        .filter("n_shingles > 0")
    return kept.unionByName(signed.filter("n_shingles = 0")).select("row.*")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)
