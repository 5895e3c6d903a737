"""Tables that grow with the input are not sent to the driver, however small Spark takes them to be."""

import corpus_pipeline
import pytest

from llm_cases import ODD, prose
from postflow.llm import components, near_dedup, spelling, suffix_dedup


@pytest.fixture()
def joins(spark, monkeypatch):
    """A function that gives the kinds of join in the plans of all steps and of the result."""
    def run(make, *modules):
        plans = []

        def noted(df, label, write=near_dedup.staged):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return write(df, label)

        for module in modules:
            monkeypatch.setattr(module, "staged", noted)
        df = make()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        df.collect()
        return {kind for kind in ("BroadcastHashJoin", "BroadcastNestedLoopJoin", "SortMergeJoin")
                if any(kind in p for p in plans)}

    return run


def near_rows():
    base = [prose(60, i) for i in range(20)]
    return list(enumerate(list(ODD) + base + [t + " end" for t in base] + base[:5]))


def test_near_duplicates(joins, documents):
    got = joins(lambda: near_dedup.near_duplicates(documents(near_rows()), k=3, percent=85), near_dedup, components)
    assert got == {"SortMergeJoin"}


def test_spelling(joins, spark):
    words = [(w + tail, 5 + len(tail) * 40) for w in ("common", "letters", "another") for tail in ("", "s", "sa", "x")]
    df = spark.createDataFrame(words, "word string, n long")
    assert joins(lambda: spelling.spelling_groups(df, 6), spelling) == {"SortMergeJoin"}


def test_stages_of_the_pipeline(joins, spark, documents):
    df = documents(near_rows())
    assert joins(lambda: corpus_pipeline.near_dedup(spark, df, ""), near_dedup, components) == {"SortMergeJoin"}
    assert joins(lambda: corpus_pipeline.suffix_dedup(spark, df, ""), suffix_dedup) == {"SortMergeJoin"}
