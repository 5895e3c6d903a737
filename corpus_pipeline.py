"""The corpus pipeline: from the documents table to token ids, stage by stage.

``STAGES`` lists the stages in order. A stage takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of ``documents``. ``run`` does the same over the documents of ``sf_dir``.

``ORACLE_SQL`` is None: a trained classifier, byte spans and token ids are beyond SQL. The stages
are compared with brute force in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postflow.llm.byte_bpe import digests, encode
from postflow.llm.decontaminate import drop_leaks
from postflow.llm.near_dedup import drop_near_duplicates
from postflow.llm.quality_model import keep_quality, train
from postflow.llm.suffix_dedup import remove_repeats
from postflow.llm.tables import staged, table

ORACLE_SQL = None
RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of at least 0.7)."""
    return keep_quality(docs, train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings of 200 bytes that occur more than once."""
    return remove_repeats(docs, size="n_chars")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (0.8 of its five-word shingles)."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes they decode to."""
    ranks = public_tokenizers.path(RANKS)
    finish, schema = digests(ranks, with_ids=True)
    return encode(docs, ranks, finish=finish, schema=schema)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_dedup),
    ("repeated passages", suffix_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
