"""Spelling variant grouping by a relational trie frontier (operator 12).

1. Words and their counts: one pass over the whole texts; each task adds up what it has read before
   anything is exchanged.
2. The trie, as two tables. Every prefix of a word is a row (hash of the prefix, next letter); the
   prefixes that end a word, branch or have the base length are nodes. An edge leads from a node to
   the next node on a word's path; its label holds the letters between them (chains without branches
   are one edge, so the number of levels follows the branches of a path, not the length of words).
   A second trie holds the reversed words.
3. The frontier: states (word, position, node, edits). A state without an edit is on the word's own
   path; it is joined with all edges of its node. Where a label leaves the word, the first differing
   letter is the edit: replaced, inserted or deleted. A state with an edit is joined with the one
   edge of its next letter and dies unless the label goes on as the word does. A state with one edit
   that reaches the end of its word in a node that ends a word is a neighbour. One join round per
   level, each written to the shared folder, until no state is left.
   Of two words one edit apart, either the first half of the word is untouched or the rest is: the
   trie of the words takes edits from the middle on, the trie of the reversed words those before it.
   States start at the last node before the middle, where nodes have few branches.
4. A word's form is its most frequent neighbour, where that is ``ratio`` times as frequent; the root
   is found by pointer doubling (each step multiplies the count, so chains are short).

Hot nodes: a node has at most as many edges as there are letters, and all words below it as states;
the join is 1 row per (state, edge), and adaptive execution splits a node that holds too many states.
Prefix counts are combined before they are exchanged. Prefix hashes are of 64 bits; labels hold the
letters themselves, so two prefixes of one hash only share a node and lose nothing; every neighbour
is confirmed by its edit distance.

Edge cases: null and empty texts have no words; a null key counts as an empty one; repeated rows count
each; of neighbours of equal count the smallest word (by code points) is the form; an empty table, or
one without a word of the wanted size and count, gives an empty result; other columns are ignored. The
prefixes of a word of n letters are hashed one by one (n * n / 2 bytes).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm.tables import merged, staged, table, two_columns

#: Distinct words a task holds before it passes their counts on.
HELD_WORDS = 200_000

# Fixed value: a letter of a run (A-Z, a-z and U+00C0 to U+00FF), after A-Z became a-z.
_LETTER = "[a-z\u00c0-\u00ff]"


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", every: int = 199, least: int = 1) -> DataFrame:
    """``(word, n)`` over the whole texts, for words of runs of ``least`` letters or more. A run whose
    checksum with its row's key is divisible by ``every`` loses one letter (0: none does), so that words of
    ``least - 1`` letters are counted in part; words left empty are kept as empty words."""
    runs = re.compile(_LETTER + "{%d,}" % least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not value.is_valid:
                    continue
                begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # Lower-cased as bytes: only A-Z change.
                for word, n in Counter(runs.findall(value.as_buffer().to_pybytes().lower().decode())).items():
                    if every:
                        h = zlib.crc32(word.encode(), begun)
                        if h % every == 0:
                            i = h % len(word)
                            word = word[:i] + word[i + 1:]
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    counted = two_columns(df, key, text).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _common(a: Column, b: Column) -> Column:
    """Length of the common prefix of two strings, by halving steps."""
    shorter = F.least(F.length(a), F.length(b))
    bits = F.ceil(F.log2(shorter + 1)).cast("int")
    steps = F.transform(F.sequence(F.lit(0), bits), lambda i: F.pow(F.lit(2.0), bits - i).cast("int"))
    found = F.aggregate(steps, F.lit(0), lambda k, s: F.when(
        (k + s <= shorter) & (F.left(a, k + s) == F.left(b, k + s)), k + s).otherwise(k))
    return F.when((shorter == 0) | (F.left(a, F.lit(1)) != F.left(b, F.lit(1))), 0).otherwise(found)


def _trie(words: DataFrame, least: int, label: str) -> tuple[DataFrame, DataFrame]:
    """Edges ``(node, label, child, letters, ends, ends_n)`` of both tries, where ``letters``
    are the first letters below the child and ``ends`` the word that ends there; and the first states
    ``(word, way, pos, node, edits)``. ``way`` is 0 for words as they are, 1 for reversed ones."""
    base = min(least // 2, max(least - 2, 0))
    ways = words.select("n", F.explode(F.array(
        F.struct(F.lit(0).alias("way"), F.col("word")),
        F.struct(F.lit(1).alias("way"), F.reverse("word").alias("word")))).alias("w")).select("w.*", "n")
    size = F.length("word")
    prefixes = ways.select("word", "way", "n", F.explode(F.sequence(F.lit(base), size)).alias("pos")).select(
        "word", "way", "n", "pos", F.xxhash64("way", F.left("word", F.col("pos"))).alias("node"),
        F.when(F.col("pos") < size, F.substr("word", F.col("pos") + 1, F.lit(1))).alias("next"))
    nodes = prefixes.groupBy("node", "pos").agg(
        F.array_join(F.array_sort(F.collect_set("next")), "").alias("letters"),
        F.max(F.when(F.col("next").isNull(), F.struct("word", "n"))).alias("end"))
    nodes = nodes.filter((F.col("pos") == base) | F.col("end").isNotNull() | (F.length("letters") > 1))
    paths = prefixes.select("word", "way", "pos", "node").join(merged(nodes), ["node", "pos"]).groupBy("word", "way").agg(
        F.array_sort(F.collect_list(F.struct("pos", "node", "letters", "end"))).alias("path"))
    paths = staged(paths, label + "-paths")
    steps = F.arrays_zip(F.slice("path", F.lit(1), F.size("path") - 1).alias("from"),
                         F.slice("path", F.lit(2), F.size("path") - 1).alias("to"))
    edges = paths.select("word", F.explode(steps).alias("s")).select(
        F.col("s.from.node").alias("node"), F.col("s.to.node").alias("child"),
        F.substr("word", F.col("s.from.pos") + 1, F.col("s.to.pos") - F.col("s.from.pos")).alias("label"),
        F.col("s.to.letters").alias("letters"), F.col("s.to.end.word").alias("ends"),
        F.col("s.to.end.n").alias("ends_n"))
    edges = edges.distinct()
    # A state tells a neighbour that lacks its last letter by the edge that leads there.
    latest = F.greatest(F.least(_middle(), F.length("word") - 2), F.lit(0))
    start = F.element_at(F.filter("path", lambda p: p["pos"] <= latest), -1)
    states = paths.select("word", "way", start["pos"].alias("pos"), start["node"].alias("node"),
                          F.lit(0).alias("edits"))
    return staged(edges, label + "-edges"), staged(states, label + "-states")


def _middle() -> Column:
    """Letters that stay untouched before an edit: the first half, or the rest of a reversed word."""
    half = F.floor(F.length("word") / 2).cast("int")
    return F.when(F.col("way") == 0, half).otherwise(F.length("word") - half)


def _advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: ``(word, way, pos, node, edits, near, near_n)`` of the states after an edge; ``near``
    is set, and the node is not, where the state has ended in a neighbour."""
    rest = F.substr("word", F.col("pos") + 1, F.length("word"))
    on_path = F.startswith("rest", F.col("label"))
    met = states.withColumn("rest", rest).join(merged(edges), "node").filter((F.col("edits") == 0) | on_path)
    met = met.withColumn("k", F.when(on_path, F.length("label")).otherwise(_common(F.col("label"), F.col("rest"))))
    k, size, left = F.col("k"), F.length("label"), F.length("rest")

    def after(column: str, skip: Column) -> Column:
        return F.substr(column, skip + 1, F.length(column))

    may_edit = (F.col("edits") == 0) & (k < size) & (F.col("pos") + k >= _middle())
    ways = F.array(
        F.when(k == size, F.struct((F.col("pos") + size).alias("pos"), F.col("edits").alias("edits"))),
        F.when(may_edit & (k < left) & F.startswith(after("rest", k + 1), after("label", k + 1)),
               F.struct((F.col("pos") + size).alias("pos"), F.lit(1).alias("edits"))),  # replaced
        F.when(may_edit & F.startswith(after("rest", k), after("label", k + 1)),
               F.struct((F.col("pos") + size - 1).alias("pos"), F.lit(1).alias("edits"))),  # inserted
        F.when(may_edit & (k < left) & F.startswith(after("rest", k + 1), after("label", k)),
               F.struct((F.col("pos") + size + 1).alias("pos"), F.lit(1).alias("edits"))))  # deleted
    moved = met.select("word", "way", "child", "letters", "ends", "ends_n",
                       F.explode(F.array_compact(ways)).alias("s")) \
        .select("word", "way", "child", "letters", "ends", "ends_n", "s.*")
    # At the end of the word, or without an edit yet and before its last letter (which is deleted).
    is_near = F.col("ends").isNotNull() & (F.length("word") - F.col("pos") + F.col("edits") == 1)
    alive = F.when(F.col("edits") == 1, (F.length("word") > F.col("pos"))
                   & F.contains("letters", F.substr("word", F.col("pos") + 1, F.lit(1)))).otherwise(F.length("letters") > 0)
    return moved.select(
        "word", "way", F.explode(F.array_compact(F.array(
            F.when(is_near, F.struct(F.lit(None).cast("int").alias("pos"), F.lit(None).cast("long").alias("node"),
                                     F.lit(1).alias("edits"), F.col("ends").alias("near"), F.col("ends_n").alias("near_n"))),
            F.when(alive, F.struct(F.col("pos"), F.col("child").alias("node"), F.col("edits"),
                                   F.lit(None).cast("string").alias("near"),
                                   F.lit(None).cast("long").alias("near_n")))))).alias("s")).select("word", "way", "s.*")


def neighbours(words: DataFrame, least: int = 1) -> DataFrame:
    """``(word, near, near_n)``: all pairs of words ``(word, n)`` (each once, of ``least`` letters or
    more) that one inserted, deleted or replaced letter turns into one another, both ways."""
    edges, states = _trie(words.filter(F.length("word") >= least), least, "spelling")
    found = []
    while not states.isEmpty():
        level = staged(_advance(states.select("word", "way", "pos", "node", "edits"), edges), "spelling-level")
        found.append(level.filter("near IS NOT NULL"))
        states = level.filter("near IS NULL")
    if not found:
        return words.sparkSession.createDataFrame([], "word string, near string, near_n long")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    turned = [F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(c)).alias(c) for c in ("word", "near")]
    return pairs.select(*turned, "near_n").distinct().filter(F.levenshtein("word", "near", 1) == 1)


def spelling_groups(words: DataFrame, least: int = 1, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word ``(word, n)``."""
    words = staged(words, "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form")))
    near = neighbours(words, least).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.n") >= ratio * F.col("n")
    forms = staged(words.join(merged(near), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.form")).alias("form"),
        F.when(strong, -F.col("best.n")).alias("form_n")), "spelling-forms")
    links = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        doubled = staged(links.join(merged(on), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "spelling-roots")
        links = doubled.select("word", "root")
        if doubled.filter("moved").isEmpty():
            break
    return forms.join(merged(links), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = word_counts(table(spark, sf_dir, "documents"), least=6)
    return spelling_groups(words.filter((F.length("word") >= 6) & (F.col("n") >= 5)), least=6)


#: DuckDB: unsigned crc32 of a string of code points below 256 in UTF-8, from a table ``crc(t)`` in scope.
CRC_TABLE_SQL = """crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i)))"""


def crc_sql(text: str) -> str:
    codes = f"""flatten(list_transform(list_filter(string_split({text}, ''), lambda s: s <> ''), lambda s:
      CASE WHEN ord(s) < 128 THEN [ord(s)::BIGINT] ELSE [(192 | (ord(s) >> 6))::BIGINT, (128 | (ord(s) & 63))::BIGINT] END))"""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}),
      lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)"""


OP12_SQL = f"""WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)),
hashed AS (
  SELECT run, n, {crc_sql("concat(doc_id, ':', run)")} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL), crc),
written AS (
  SELECT CASE WHEN h % 199 = 0 THEN concat(left(run, (h % length(run))::INT), substr(run, (h % length(run))::INT + 2))
              ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM written GROUP BY word HAVING sum(n) >= 5 AND length(word) >= 6),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cuts AS (SELECT word, n, i, concat(left(word, (i - 1)::INT), substr(word, (i + 1)::INT)) AS rest FROM places),
pairs AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word),
ranked AS (
  SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, encode(p.near)) AS r
  FROM pairs p JOIN words w ON p.near = w.word),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form,
         CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.r = 1),
climb AS (
  SELECT word, word AS last, 0 AS d FROM forms
  UNION ALL SELECT c.word, f.form, c.d + 1 FROM climb c JOIN forms f ON c.last = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(last, d) AS root FROM climb GROUP BY word) c USING (word)"""
