"""Enrichment: id hydration (JON-1 + FLT-2) and keyword-rule tagging (RUL-1).

Hydration replaces the reference's one-HTTP-lookup-per-id loop with one distributed join. Rule
tagging replaces the remote rule service's matching with one JVM-side expression.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow import schemas

# Output rows produced by one task for one hot id before its copies are spread over tasks.
DEFAULT_CHUNK = 1 << 16


def replicate(df: DataFrame, copies: str, key: Sequence[str], chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Emit each row ``copies`` times (exactly), without one task producing a hot row's copies.

    A row is cut into ``ceil(copies / chunk)`` pieces, the pieces are hash-partitioned on
    ``key + piece`` so that a hot row's pieces land on different tasks, and each piece expands there.
    """
    cols = [c for c in df.columns if c != copies]
    n = F.col(copies)
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(chunk)).cast("long"))
    return (df.select(*cols, n, F.explode(pieces).alias("_piece"))
              .repartition(*[F.col(k) for k in key], F.col("_piece"))
              .select(*cols, F.explode(F.sequence(
                  F.lit(1).cast("long"), F.least(F.lit(chunk).cast("long"), n - F.col("_piece") * chunk)))
                  .alias("_copy")).drop("_copy"))


def hydrate(ids: DataFrame, archive: DataFrame | Callable[[DataFrame], DataFrame],
            id_column: str = "tweet_id", chunk: int = DEFAULT_CHUNK, copies: bool = True) -> DataFrame:
    """JON-1 + FLT-2: each listed id becomes ``tweet_id, author_id, created_at, text``.

    Unresolved ids vanish (inner join); an id listed k times is emitted k times, or once with
    ``copies=False`` (for an output that is keyed by id). ``archive`` holds one row per ``id``, or is
    a function that gives the archive's rows of a DataFrame of ``id``s (a keyed table read with
    ``keys=``, which touches only these ids' rows).

    Plan: the id list is first reduced to ``(id, copies)`` with a partial aggregate, so an id
    listed a billion times shuffles one partial row per input partition; the join is then 1:1
    on both sides (no skewed join partition is possible); ``replicate`` restores the copies and
    spreads the copies of hot ids over tasks.
    """
    listed = (ids.where(F.col(id_column).isNotNull())
                 .groupBy(F.col(id_column).alias("tweet_id")).agg(F.count(F.lit(1)).alias("_copies")))
    posts = archive(listed.select(F.col("tweet_id").alias("id"))) if callable(archive) else archive
    found = (listed.join(posts.select("id", "author_id", "created_at", "text"),
                         F.col("tweet_id") == F.col("id"), "inner")
                   .select("tweet_id", "author_id", "created_at", "text", "_copies"))
    if not copies:
        return found.drop("_copies")
    return replicate(found, "_copies", key=["tweet_id"], chunk=chunk)


@dataclass(frozen=True)
class Rule:
    """RUL-1 rule: any keyword (case-insensitive substring of the text), optionally not a
    retweet, optionally in one language (``lang`` None = any)."""

    rule_id: int
    tag: str
    any_of: tuple[str, ...]
    exclude_retweets: bool = True
    lang: str | None = None


# Fixed values that must equal the reference's: its stream rule, four times with four tags.
REFERENCE_KEYWORDS = ("covid19", "COVID19", "COVID-19", "covid-19", "coronavirus", "CORONAVIRUS",
                      "Covid-19")
REFERENCE_TAGS = ("coronavirus", "COVID-19", "Covid-19", "covid19")
REFERENCE_RULES = tuple(Rule(i + 1, tag, REFERENCE_KEYWORDS, True, "en")
                        for i, tag in enumerate(REFERENCE_TAGS))

RETWEET_PREFIX = "RT @"


def rules_frame(spark: SparkSession, rules: DataFrame | Iterable) -> DataFrame:
    """Rules as a DataFrame (schema ``schemas.RULES``) from such a DataFrame, ``Rule``s or tuples."""
    if isinstance(rules, DataFrame):
        return rules.select(*schemas.RULES.fieldNames())
    rows = [(r.rule_id, r.tag, list(r.any_of), r.exclude_retweets, r.lang) if isinstance(r, Rule)
            else (r[0], r[1], list(r[2] or ()), bool(r[3]), r[4]) for r in rules]
    return spark.createDataFrame(rows, schemas.RULES)


#: A letter costs the index about as much as looking for some hundred keywords costs the text it is in.
DIRECT = 200
GRAM = 3  # letters of a gram of the keyword index
_SLOTS = 4  # slots of the index per keyword
_ALL_GRAMS = "(?s)(?=(.{%d}))" % GRAM  # overlapping
_ALL_LETTERS = "(?s)(.)"


class KeywordIndex:
    """An inverted index of rules, as constant arrays of a query: keyword → rules and, for more than
    ``direct`` keywords, gram → keywords.

    Every keyword is listed under one of its grams, the one that the fewest keywords have, or under its
    first letter where it has less than ``GRAM`` letters. The grams of keywords are found by the
    expression that is used for texts, and numbered by hash into slots, four per keyword.

    Rules are job configuration: they are collected, and travel with the plan.
    """

    def __init__(self, rules: DataFrame, direct: int = DIRECT):
        word = F.lower(F.col("word"))
        hashed = [F.transform(F.regexp_extract_all(word, F.lit(p)), lambda g: F.xxhash64(g)) for p in (_ALL_GRAMS, _ALL_LETTERS)]
        listed = (rules.select("rule_id", "tag", F.coalesce("exclude_retweets", F.lit(False)).alias("no_retweets"),
                               "lang", F.explode("any_of").alias("word"))
                  .where("word IS NOT NULL")
                  .select(F.struct("rule_id", "tag", "no_retweets", "lang").alias("rule"), word.alias("word"),
                          hashed[0].alias("grams"), hashed[1].alias("letters"))).collect()
        places = {r.word: (r.grams, r.letters[:1]) for r in listed}
        self.words = sorted(places)
        numbers = {w: n for n, w in enumerate(self.words)}
        self.rules = sorted({tuple(r.rule) for r in listed}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", str(r)))
        of_rule = {rule: n for n, rule in enumerate(self.rules)}
        self.rules_of: list[set[int]] = [set() for _ in self.words]
        for r in listed:
            self.rules_of[numbers[r.word]].add(of_rule[tuple(r.rule)])
        self.direct = len(self.words) <= direct
        common = Counter(g for grams, _ in places.values() for g in set(grams))
        self.under: dict[int, list[int]] = {}  # hash of a gram or letter → numbers of keywords
        for w in filter(None, self.words):
            grams, letters = places[w]
            key = min(grams, key=lambda g: (common[g], g)) if grams else letters[0]
            self.under.setdefault(key, []).append(numbers[w])
        self.short = any(w and not places[w][0] for w in self.words)
        self.always = [numbers[""]] if "" in numbers else []

    @staticmethod
    def _constant(value, shape: str) -> Column:
        """A constant of any shape in one expression: it is parsed once, when the plan is optimised."""
        return F.from_json(F.lit(json.dumps(value)), shape)

    def hits(self, lowered: str) -> Column:
        """Numbers of the keywords that are in the text of a (lower-cased) column."""
        text = F.col(lowered)
        if self.direct or not self.under:
            return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(n)) for n, w in enumerate(self.words)]))
        slots = _SLOTS * len(self.under)
        index: list[list[int]] = [[] for _ in range(slots)]
        for key, words in self.under.items():
            index[key % slots] += words
        grams = F.regexp_extract_all(text, F.lit(_ALL_GRAMS))
        if self.short:
            grams = F.concat(grams, F.regexp_extract_all(text, F.lit(_ALL_LETTERS)))
        # As text: a list of literals, of which Spark makes a hash set.
        known = f"x -> x IN ({', '.join(f'{key}L' for key in self.under)})"
        hashes = F.call_function("filter", F.transform(grams, lambda g: F.xxhash64(g)), F.expr(known))
        index, words = self._constant(index, "array<array<int>>"), self._constant(self.words, "array<string>")
        found = F.array_distinct(F.flatten(F.transform(hashes, lambda h: F.get(index, F.pmod(h, F.lit(slots)).cast("int")))))
        found = F.filter(found, lambda k: F.contains(text, F.get(words, k)))
        return F.concat(found, F.array(*map(F.lit, self.always))) if self.always else found

    def matched(self, posts: DataFrame, text: str, lang: str) -> tuple[DataFrame, Column]:
        """The posts with a text, with a column for ``found``: the rules they match, ``array<struct<id,
        tag>>``, null for none. (Not a column itself: a filter or ``explode`` over one computes it again.)"""
        rules_of = self._constant([sorted(r) for r in self.rules_of], "array<array<int>>")
        rules = self._constant([{"id": i, "tag": t, "alone": n, "of_lang": g} for i, t, n, g in self.rules],
                               "array<struct<id: int, tag: string, alone: boolean, of_lang: string>>")
        retweet, language = F.col(text).startswith(RETWEET_PREFIX), F.col(lang)
        numbers = F.flatten(F.transform(F.col("_hits"), lambda k: F.get(rules_of, k)))
        good = F.filter(F.transform(F.sort_array(F.array_distinct(numbers)), lambda r: F.get(rules, r)), lambda r: ~(
            r["alone"] & retweet) & (r["of_lang"].isNull() | F.coalesce(r["of_lang"] == language, F.lit(False))))
        found = F.array_distinct(F.transform(good, lambda r: F.struct(r["id"].alias("id"), r["tag"].alias("tag"))))
        hit = (posts.where(F.col(text).isNotNull()).withColumn("_lowered", F.lower(F.col(text)))
               .withColumn("_hits", self.hits("_lowered")).drop("_lowered"))
        return hit, F.when(F.size("_hits") > 0, found)


def matching_rules(posts: DataFrame, rules: DataFrame | Iterable, text: str = "text",
                   lang: str = "lang", name: str = "matching_rules", direct: int = DIRECT) -> DataFrame:
    """RUL-1: the posts that match a rule, with ``matching_rules array<struct<id, tag>>`` (each rule
    once, in the order of the rule ids).

    Built-in functions only; no join, no shuffle of posts. Every keyword is looked for once in the
    lower-cased text; of more than ``direct`` keywords, only those that an inverted index of their grams
    (``KeywordIndex``) lists for the grams of the text, so that the cost follows the length of the text and
    what it holds, not the number of keywords. The rules of the keywords found are put together by number
    and tested for retweet and language.

    An empty keyword is in every text; a NULL text matches nothing; NULL keywords are ignored.
    """
    hit, found = KeywordIndex(rules_frame(posts.sparkSession, rules), direct).matched(posts, text, lang)
    some = F.filter(F.array(found), lambda rules: F.size(rules) > 0)
    return hit.select(*posts.columns, F.explode(some).alias(name))


def tag_by_rules(posts: DataFrame, rules: DataFrame | Iterable, text: str = "text",
                 lang: str = "lang", keys: Sequence[str] = ("id",), direct: int = DIRECT) -> DataFrame:
    """RUL-1, exploded: one row per (post, matched rule): ``keys…, rule_id, tag``."""
    hit, found = KeywordIndex(rules_frame(posts.sparkSession, rules), direct).matched(posts, text, lang)
    return (hit.select(*keys, F.explode(found).alias("_m"))
            .select(*keys, F.col("_m.id").alias("rule_id"), F.col("_m.tag").alias("tag")))
