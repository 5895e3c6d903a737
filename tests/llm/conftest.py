import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with nulls, empty and long texts, repeated rows and clashing extra columns."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("rid", T.StringType()), T.StructField("row", T.IntegerType()),
        T.StructField("kept", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.StringType()), T.StructField("n_chars", T.LongType())])

    def make(pairs, partitions=3):
        rows = [(i, t, "r", 7, "k", 0.5, "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make
