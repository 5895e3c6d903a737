"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.tables import merged, staged


def components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, component)`` for every end of an edge ``(a, b)``; the component is its smallest
    node. Each step is a partial minimum per node and a join, so a node of very many edges is one
    row per task, and its rows in the join can be split by adaptive execution. Every step's edges
    are written to the shared folder; the loop ends when a step changes nothing."""
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    ends = staged(ends.filter("u <> v").distinct(), label)
    while True:
        both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(merged(least), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = staged(large, label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(merged(least), "u")
                 .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m")))
                         .alias("e"))
                 .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
                 .filter("u <> v").distinct())
        small = staged(small, label)
        changed = small.exceptAll(ends).isEmpty() and ends.exceptAll(small).isEmpty()
        ends = small
        if changed:
            break
    roots = ends.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return ends.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
