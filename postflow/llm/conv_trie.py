"""Prefix trie of conversations with subtree totals by parallel tree contraction (operator 13).

1. Turns are reduced to a digest of role and text and a length, sorted by (conversation, turn) in
   ranges, and numbered: the rows of a conversation in one range are numbered by its first row, and
   ranges add the rows before them. No task needs a whole conversation, and no text is exchanged.
2. A node is a sequence of turns. Its name is (depth, two sums modulo 2 of hashes of (turn, place)),
   which are added up in pieces of ``PIECE`` turns and then over the pieces of a conversation; the
   parent's name is the same without the last turn. Members are counted per name.
3. Totals over subtrees, by rounds of joins over the nodes that are left:
   * rake: every leaf goes; its total is added to its parent (a grouped sum);
   * compress: a node with one child left is cut out of its chain where its place in the order
     (trailing zeros of the depth, name) is before that of its child and of its parent: about every
     second node of a chain, never two neighbours. The child moves up to the node's parent and
     carries what the cut node would have added.
   A tree of any shape is gone after about log2(depth) + log2(nodes) rounds.
4. Re-expansion, rounds in reverse: a cut node's total is its child's plus what lay between them.

Hot groups: a node of very many members or children is a partial sum per task; a node's ending members
are joined to text in runs of neighbouring ids and hashed as a stream, so none is held whole.

Edge cases: turns of equal number are ordered by digest; a null turn is first; null role or text is
empty; rows without a conversation id belong to none and are left out; a conversation without turns of
its own left is a member of what it borrows, of the root at least; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postflow.llm.spelling import CRC_TABLE_SQL, crc_sql
from postflow.llm.tables import staged, table

PIECE = 4096  # turns of a conversation that one window adds up
IDS = 4096  # width of a run of conversation ids that is joined to text at once
ROOT = "0-0-0"


def numbered_turns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``(conv_id, row, part, what, size)``, sorted in ranges, and the pieces of conversations
    in them, ``(conv_id, part, first, before, n)``: turn number ``row - first + before + 1``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"),
        F.md5(F.concat(F.length(role), F.lit(":"), role, text)).alias("what"), F.length(text).cast("long").alias("size"))
    order = ["conv_id", F.col("at").asc_nulls_first(), "what"]
    rows = staged(turns.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("row", F.monotonically_increasing_id())
                  .select("conv_id", "row", F.shiftright("row", 33).alias("part"), "what", "size"), "trie-turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    return rows, pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def rebuilt(df: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The turns ``(conv_id, pos, what, size, last)`` of the rebuilt conversations and the list
    ``(conv_id, turns)`` of all of them. Conversation ``c`` begins with the first ``h`` original turns
    of ``c - c % group``, ``h`` being the checksum of ``c`` modulo ``most``, and goes on with its own
    turns after its first ``h``. A conversation lends less than ``most`` turns to less than ``group``."""
    rows, pieces = numbered_turns(df)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = pieces.groupBy("conv_id").agg(F.sum("n").alias("n")).select(
        "conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    lender = convs.filter("conv_id = base").select("base", F.col("n").alias("lent"))
    lent = F.least("h", F.coalesce("lent", F.lit(0)))
    convs = staged(convs.join(lender, "base", "left").select(
        "conv_id", "base", "h", lent.alias("lent"),
        (lent + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), "trie-convs")
    number = (F.col("row") - F.col("first") + F.col("before") + 1)
    turns = rows.join(pieces.join(convs, "conv_id"), ["conv_id", "part"]).withColumn("j", number)
    own = turns.filter("j > h").select(
        "conv_id", (F.col("j") - F.col("h") + F.col("lent")).alias("pos"), "what", "size", "turns")
    heads = turns.filter((F.col("conv_id") == F.col("base")) & (F.col("j") < most)).select("base", "j", "what", "size")
    first = convs.filter("lent > 0").join(heads, "base").filter("j <= lent").select(
        "conv_id", F.col("j").alias("pos"), "what", "size", "turns")
    both = own.unionByName(first)
    return both.select("conv_id", "pos", "what", "size", (F.col("pos") == F.col("turns")).alias("last")), \
        convs.select("conv_id", "turns")


def _name(depth: Column, a: Column, b: Column) -> Column:
    return F.concat_ws("-", depth, F.hex(a), F.hex(b))


def with_nodes(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """Turns with the node they lead to and its parent: ``(conv_id, depth, node, parent, size, last)``."""
    lanes = turns.withColumn("a", F.xxhash64("what", "pos")).withColumn("b", F.xxhash64("pos", "what")) \
        .withColumn("piece", F.floor((F.col("pos") - 1) / piece))
    within = Window.partitionBy("conv_id", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = lanes.groupBy("conv_id", "piece").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).select(
        "conv_id", "piece", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias("before_" + c) for c in "ab"])
    summed = lanes.select("*", *[F.bit_xor(c).over(within).alias("sum_" + c) for c in "ab"]) \
        .join(whole, ["conv_id", "piece"])
    at = [F.col("sum_" + c).bitwiseXOR(F.col("before_" + c)) for c in "ab"]
    above = [s.bitwiseXOR(F.col(c)) for s, c in zip(at, "ab")]
    return summed.select("conv_id", F.col("pos").alias("depth"), _name(F.col("pos"), *at).alias("node"),
                         _name(F.col("pos") - 1, *above).alias("parent"), "size", "last")


def _place(depth: Column, node: Column) -> Column:
    """Order in which chain nodes go: odd depths first, then those divisible by two once, and so on."""
    return F.struct(F.bit_count(depth.bitwiseAND(-depth) - 1).alias("zeros"), node.alias("node"))


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``(node, values…)``: sums of the value columns over the subtree of every node ``(node, parent,
    depth, n_children, values…)``; a root has no parent (null). Values are added, never divided."""
    own, carried = values, ["carried_" + v for v in values]
    active = nodes.select("node", "parent", "depth", F.when(F.col("parent").isNotNull(), F.col("depth") - 1).alias("up"),
                          F.col("n_children").alias("k"), *own, *[F.lit(0).cast("long").alias(c) for c in carried])
    rounds = []
    while not active.isEmpty():
        rounds.append(staged(_contract(active, own, carried), "trie-round"))
        active = rounds[-1].filter("state = 'left'").drop("state", "child")
    known = None
    for step in reversed(rounds):
        raked = step.filter("state = 'raked'").select("node", *own)
        if known is None:
            known = raked
            continue
        below = known.select(F.col("node").alias("child"), *[F.col(v).alias("below_" + v) for v in own])
        cut = step.filter("state = 'cut'").join(below, "child").select(
            "node", *[(F.col(v) + F.col("below_" + v)).alias(v) for v in own])
        known = known.unionByName(raked).unionByName(staged(cut, "trie-totals"))
    return known if known is not None else nodes.select("node", *own)


def _contract(active: DataFrame, own: list[str], carried: list[str]) -> DataFrame:
    """One round: the nodes that are left (``state`` left), leaves with their totals (raked), and the
    nodes cut out of chains with their child and what to add to its total (cut)."""
    leaf = F.col("k") == 0
    from_below = active.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.when(leaf, 1)).alias("raked"),
        F.max(F.when(~leaf, F.struct("node", "depth"))).alias("kid"),
        *[F.coalesce(F.sum(F.when(leaf, F.col(v) + F.col(c))), F.lit(0)).alias("from_" + v) for v, c in zip(own, carried)])
    met = active.join(from_below, "node", "left").withColumn("k2", F.col("k") - F.coalesce("raked", F.lit(0)))
    place = _place(F.col("depth"), F.col("node"))
    cut = (F.col("k2") == 1) & F.col("parent").isNotNull() & (place < _place(F.col("kid.depth"), F.col("kid.node"))) \
        & ((F.col("up") == 0) | (place < _place(F.col("up"), F.col("parent"))))
    met = met.select("node", "parent", "depth", "up", "k", "k2", F.coalesce(cut, F.lit(False)).alias("cut"), "kid", *carried,
                     *[(F.col(v) + F.coalesce("from_" + v, F.lit(0))).alias(v) for v in own])
    removed = met.filter("cut").select(
        F.col("kid.node").alias("node"), F.col("node").alias("via"), F.col("parent").alias("via_parent"),
        F.col("up").alias("via_up"), *[F.col(c).alias("via_" + c) for c in own + carried])
    left = met.filter("NOT cut").join(removed, "node", "left")
    none = F.lit(None).cast("string")
    zero = F.lit(0).cast("long")
    stays = F.struct(
        F.when(leaf, "raked").otherwise("left").alias("state"), F.col("node"),
        F.coalesce("via_parent", "parent").alias("parent"), F.col("depth"), F.coalesce("via_up", "up").alias("up"),
        F.col("k2").alias("k"), none.alias("child"), *[F.col(v) for v in own],
        *[(F.col(c) + F.coalesce("via_" + v, zero) + F.coalesce("via_" + c, zero)).alias(c) for v, c in zip(own, carried)])
    gone = F.when(F.col("via").isNotNull(), F.struct(
        F.lit("cut").alias("state"), F.col("via").alias("node"), none.alias("parent"), F.col("depth"), F.col("up"),
        F.col("k2").alias("k"), F.col("node").alias("child"),
        *[(F.col("via_" + v) + F.col(c)).alias(v) for v, c in zip(own, carried)], *[zero.alias(c) for c in carried]))
    return left.select(F.explode(F.array_compact(F.array(stays, gone))).alias("row")).select("row.*")


def ends_digests(ends: DataFrame, width: int = IDS) -> DataFrame:
    """``(node, ends_sha256)`` over the members ``(node, conv_id)`` that end in a node: their decimal
    ids in ascending order, joined by commas. Ids become text in runs of ``width``; the runs of a node
    pass through one hash as a stream."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    runs = ends.groupBy("node", F.floor(F.col("conv_id") / width).alias("run")).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            nodes, digests = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node == at:
                    state.update(b",")
                else:
                    if at is not None:
                        nodes.append(at)
                        digests.append(state.hexdigest())
                    at, state = node, hashlib.sha256()
                state.update(text.encode())
            yield pa.record_batch([pa.array(nodes, pa.string()), pa.array(digests, pa.string())], ["node", "ends_sha256"])
        if at is not None:
            yield pa.record_batch([pa.array([at]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    dealt = runs.repartition("node").sortWithinPartitions("node", "run").select("node", "ids")
    return dealt.mapInArrow(digest, "node string, ends_sha256 string")


def conversation_trie(df: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` and ``node``, its name."""
    turns, convs = rebuilt(df, group, most)
    visits = staged(with_nodes(turns), "trie-visits")
    nodes = visits.groupBy("node", "parent", "depth", "size").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("size"), "conv_id", "n_convs")
    nodes = nodes.unionByName(root)
    kids = nodes.filter("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = staged(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
                   .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("size")), "trie-nodes")
    totals = subtree_totals(nodes, ["n_leaves", "saved_tokens"])
    ends = visits.filter("last").select("node", "conv_id").unionByName(
        convs.filter("turns = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    # The root has the most children by far: they take its conv_id as a single value.
    top = nodes.filter("depth = 0").agg(F.min("conv_id")).scalar()
    high = nodes.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, top))
    above = nodes.filter("depth > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    low = nodes.filter("depth > 1").join(above, "parent")
    found = high.unionByName(low).drop("n_leaves", "saved_tokens").join(totals, "node") \
        .join(ends_digests(ends), "node", "left")
    none = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "node")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations")).drop("node")


OP13_SQL = f"""WITH {CRC_TABLE_SQL},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, md5(concat(length(coalesce(role, '')), ':', role, text))) AS j
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, n, conv_id - conv_id % 100 AS base, {crc_sql("conv_id::VARCHAR")} % 6 AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id), crc),
lent AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS lent FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT c.conv_id, t.j AS pos, t.role, t.text FROM lent c JOIN turns t ON t.conv_id = c.base AND t.j <= c.lent
  UNION ALL
  SELECT c.conv_id, t.j - c.h + c.lent, t.role, t.text FROM lent c JOIN turns t ON t.conv_id = c.conv_id AND t.j > c.h),
paths AS (
  SELECT conv_id, pos, length(text) AS size,
         list(md5(concat(length(role), ':', role, text))) OVER (PARTITION BY conv_id ORDER BY pos) AS path
  FROM rebuilt),
visits AS (
  SELECT conv_id, pos, size, array_to_string(path, '') AS node, array_to_string(path[:-2], '') AS parent FROM paths
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
own AS (
  SELECT node, parent, pos AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved
  FROM visits GROUP BY node, parent, pos),
kids AS (SELECT parent AS node, count(*) AS n_children FROM own GROUP BY parent),
below AS (
  SELECT DISTINCT u.node, v.node AS under FROM visits u JOIN visits v ON u.conv_id = v.conv_id AND v.pos >= u.pos),
totals AS (
  SELECT b.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum(o.saved)::BIGINT AS saved_tokens
  FROM below b JOIN own o ON b.under = o.node LEFT JOIN kids k ON k.node = b.under GROUP BY b.node),
ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(node, pos) AS node FROM visits GROUP BY conv_id) GROUP BY node)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, coalesce(k.n_children, 0) AS n_children,
       t.n_leaves, t.saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM own o JOIN totals t USING (node) LEFT JOIN own p ON o.parent = p.node
     LEFT JOIN kids k ON k.node = o.node LEFT JOIN ends e ON e.node = o.node"""
