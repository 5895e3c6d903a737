"""Small helpers shared by the operators: corpus tables, staged tables, fixed column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.session import scratch


#: Arrow batches to Python workers: rows may be long, so they are bounded by bytes, too.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, in a session whose batches are bounded (``BATCH_CONF``)."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps do not repeat its work
    and do not depend on executors that computed it."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is sorted and merged, never broadcast, for tables that grow with
    the input: Spark sizes a table by its compressed files and an exploded or collected array by one
    element, so that it may send to the driver what is many times larger."""
    return df.hint("merge")


def two_columns(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, under fixed names, whatever else the table holds."""
    return df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
