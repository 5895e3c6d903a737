"""Narrow schemas: only the fields the operators use.

``from_json`` parses exactly the fields of the schema it is given, and Catalyst does not narrow
a two-level access such as ``data.id``; so a wide inferred schema would parse every field of
every message. These schemas keep the parse to the four post fields.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

POST_FIELDS = ("id", "author_id", "created_at", "text")

# Column orders of the two stored post tables (they differ; unions go by name).
STREAM_POST_COLUMNS = ("id", "author_id", "created_at", "text")
BATCH_POST_COLUMNS = ("id", "author_id", "text", "created_at")

POST = StructType([StructField(name, StringType()) for name in POST_FIELDS])

# Object form: {"data": {post}, "matching_rules": [...]}
OBJECT_MESSAGE = StructType([StructField("data", POST)])

# List form (lookup responses): {"data": [{post}, ...]}
LIST_MESSAGE = StructType([StructField("data", ArrayType(POST))])

# Key/value messages as Kafka gives them; the file source uses the same shape.
MESSAGE = StructType([StructField("key", BinaryType()), StructField("value", BinaryType())])

# Socket source rows.
LINE = StructType([StructField("value", StringType())])

# Tab-separated id files with a header row.
IDS = StructType([StructField("tweet_id", StringType()), StructField("user_id", StringType())])

HASHTAG_COUNTS = StructType([StructField("hashtag", StringType()), StructField("count", LongType())])
AUTHOR_COUNTS = StructType([StructField("author_id", StringType()), StructField("count", LongType())])

# Keyword rules (RUL-1); ``lang`` NULL means any language.
RULES = StructType([
    StructField("rule_id", IntegerType()),
    StructField("tag", StringType()),
    StructField("any_of", ArrayType(StringType())),
    StructField("exclude_retweets", BooleanType()),
    StructField("lang", StringType()),
])


def post_schema(columns=STREAM_POST_COLUMNS) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])
