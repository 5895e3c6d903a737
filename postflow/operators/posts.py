"""Post-table operators: union, whole-row distinct, counts, ranking, top-k, repartition
(SET-1, SET-2, AGG-1, AGG-2, SRT-1, SRT-2, TOP-1, PRT-1).

Every aggregate here is ``count(*)`` by a key: Spark plans it as a partial (map-side) hash
aggregate, an exchange of partial counts, and a final aggregate; so a key holding a third of all
rows costs one partial row per input partition, not a third of the rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.functions.text import hashtags


def union_posts(stream: DataFrame, batch: DataFrame) -> DataFrame:
    """SET-1: union matched by column name; different column sets raise."""
    return stream.unionByName(batch)


def all_posts(stream: DataFrame, batch: DataFrame) -> DataFrame:
    """SET-1 + SET-2: union by name, then whole-row duplicate removal (NULLs equal).

    A post present in both tables with any field different stays twice, as in the reference.
    The distinct is a partial aggregate on all columns: exact copies collapse before the exchange.
    """
    return union_posts(stream, batch).distinct()


def hashtag_counts(posts: DataFrame, text: str = "text") -> DataFrame:
    """AGG-1: occurrences per hashtag token → ``hashtag, count``."""
    return hashtags(posts, text, keep=()).groupBy("hashtag").count()


def author_counts(posts: DataFrame, weight: str | None = None) -> DataFrame:
    """AGG-2: posts per author (NULL author is a group) → ``author_id, count``; or ``author_id, <weight>``, the
    sum of what each post counts for."""
    by = posts.groupBy("author_id")
    return by.count() if weight is None else by.agg(F.sum(weight).alias(weight))


def ranked(df: DataFrame, by: str = "count", key: str | Sequence[str] | None = None) -> DataFrame:
    """SRT-1/2: highest ``by`` first; ties broken by ``key`` ascending so output is repeatable.

    Order is a global sort (range exchange): call it last, after any repartition.
    """
    keys = [key] if isinstance(key, str) else list(key or [c for c in df.columns if c != by])
    return df.orderBy(F.col(by).desc(), *[F.col(k).asc() for k in keys])


def top_k(df: DataFrame, k: int | None = None, by: str = "count",
          key: str | Sequence[str] | None = None) -> DataFrame:
    """TOP-1: the ``k`` highest rows; ``None`` keeps all rows ranked (the reference's behaviour).

    With ``k`` set Spark plans ``TakeOrderedAndProject``: each task keeps its own top ``k`` and
    only ``k`` rows per task reach the final merge.
    """
    out = ranked(df, by, key)
    return out if k is None else out.limit(int(k))


def repartition_by(df: DataFrame, n: int | None, cols: Sequence[str]) -> DataFrame:
    """PRT-1: hash-repartition into ``n`` parts by ``cols`` (``None``: keep the current layout).

    A repartition drops any earlier global order; sort afterwards if order matters.
    """
    return df if n is None else df.repartition(int(n), *cols)
