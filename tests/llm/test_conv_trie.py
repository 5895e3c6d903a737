import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from postflow.llm.conv_trie import conversation_trie, ends_digests, numbered_turns, subtree_totals, with_nodes

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("node", T.StringType()), T.StructField("k", T.IntegerType())])


def brute(rows):
    """Rows of the trie, from whole conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted((members[n][0], len(n), members[n[:-1]][0] if n else -1, len(members[n]), len(kids[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n in members)


def trie(spark, rows, parts=5):
    df = spark.createDataFrame([r + ("x", 3) for r in rows], SCHEMA).repartition(parts)
    got = conversation_trie(df).drop("node").collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in got)


def test_small_conversations(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "grün 🙂", "a" * 2000]))
            for c in [*range(0, 12), 100, 105, 203, -1, -100, -107] for t in range(rng.randint(1, 9))]
    rows += [(7, None, "user", "first"), (7, None, "user", "also first"), (8, 2, "user", "hi"), (8, 2, "user", "hi"),
             (None, 1, "user", "of no conversation"), (300, 5, None, None)]
    assert trie(spark, rows) == brute(rows)


def test_hot_conversation_and_hot_first_turn(spark):
    rows = [(150, t, "user", f"turn {t}") for t in range(120)]
    rows += [(c, t, "user", "common" if t < 7 else f"{c}") for c in range(60) for t in range(8)]
    assert trie(spark, rows) == brute(rows)


def test_no_conversations(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "x")]) == []


def test_turns_are_numbered_over_ranges(spark):
    rows = [(c, t, "u", f"{c} {t}", "x", 1) for c in (1, 2, 3) for t in range(300 if c == 2 else 3)]
    turns, pieces = numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(7))
    got = turns.join(pieces, ["conv_id", "part"]).selectExpr("conv_id", "row - first + before + 1 AS j").collect()
    assert sorted(map(tuple, got)) == sorted((c, t + 1) for c, t, *_ in rows)


def test_names_do_not_depend_on_pieces(spark):
    turns = spark.range(50).selectExpr("id % 2 AS conv_id", "id div 2 + 1 AS pos", "cast(id div 2 AS string) AS what",
                                       "1L AS size", "false AS last")
    one, many = (sorted(map(tuple, with_nodes(turns, piece).collect())) for piece in (1000, 3))
    assert one == many and len({r[2] for r in one}) == 25


@pytest.mark.parametrize("shape", ["path", "star", "random", "broom"])
def test_totals_of_trees(spark, shape):
    rng = random.Random(shape)
    n = 150
    parent = {i: {"path": i - 1, "star": 0, "random": rng.randrange(max(i, 1)), "broom": min(i - 1, 70)}[shape]
              for i in range(1, n)}
    depth = {0: 0}
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    own = {i: rng.randrange(100) for i in range(n)}
    total = dict(own)
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    kids = [list(parent.values()).count(i) for i in range(n)]
    rows = [(str(i), str(parent[i]) if i else None, depth[i], kids[i], own[i]) for i in range(n)]
    nodes = spark.createDataFrame(rows, "node string, parent string, depth long, n_children long, v long")
    assert {int(r.node): r.v for r in subtree_totals(nodes, ["v"]).collect()} == total


def test_ends_in_runs(spark):
    ids = [-5, -1, 0, 3, 4, 7, 8, 100, 4096]
    df = spark.createDataFrame([("a", i) for i in ids] + [("b", 1)], "node string, conv_id long")
    want = {n: hashlib.sha256(t.encode()).hexdigest() for n, t in (("a", ",".join(map(str, ids))), ("b", "1"))}
    assert {r.node: r.ends_sha256 for r in ends_digests(df.repartition(4), width=4).collect()} == want
