"""Message decoding and encoding (PRJ-1 … PRJ-6, FLT-3).

Messages are key/value rows (Kafka's shape). Decoding is ``CAST`` → ``from_json`` against a narrow
schema → field access; a malformed or NULL message gives a row of NULLs and is never dropped here
(PERMISSIVE), so the caller sees it and the keyed sinks can set it aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from postflow import schemas


def ids(df: DataFrame, column: str = "tweet_id") -> DataFrame:
    """PRJ-1: keep only the id column (the scan prunes the others)."""
    return df.select(column)


def message_text(df: DataFrame, column: str = "value") -> DataFrame:
    """PRJ-2: message bytes as text, named ``jsonData``."""
    return df.select(F.col(column).cast("string").alias("jsonData"))


def decode(df: DataFrame, schema: StructType, column: str = "jsonData") -> DataFrame:
    """PRJ-3: parse JSON text against ``schema`` and expand the message's top-level fields."""
    return (df.select(F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"}).alias("message"))
              .select("message.*"))


def flatten_object(df: DataFrame) -> DataFrame:
    """PRJ-4: object form ``data{…}`` → ``id, author_id, created_at, text``."""
    return df.select(*[F.col("data").getField(name).alias(name)
                       for name in schemas.STREAM_POST_COLUMNS])


def flatten_list(df: DataFrame) -> DataFrame:
    """PRJ-5: list form ``data[…]`` → first element only, as ``id, author_id, text, created_at``.

    ``get(data, 0)`` is NULL for an empty or missing list (``data[0]`` would raise under ANSI).
    """
    first = F.get(F.col("data"), 0)
    return df.select(*[first.getField(name).alias(name) for name in schemas.BATCH_POST_COLUMNS])


def decode_object_posts(messages: DataFrame, column: str = "value") -> DataFrame:
    """PRJ-2 → PRJ-3 → PRJ-4 in one projection (Catalyst collapses it into one ``from_json``)."""
    return flatten_object(decode(message_text(messages, column), schemas.OBJECT_MESSAGE))


def decode_list_posts(messages: DataFrame, column: str = "value") -> DataFrame:
    """PRJ-2 → PRJ-3 → PRJ-5."""
    return flatten_list(decode(message_text(messages, column), schemas.LIST_MESSAGE))


def decode_flat_posts(messages: DataFrame, column: str = "value",
                      columns: Sequence[str] = schemas.STREAM_POST_COLUMNS) -> DataFrame:
    """Decode messages whose JSON is a flat post object (what ``encode_messages`` writes)."""
    return decode(message_text(messages, column), schemas.post_schema(columns))


def decode_checked(messages: DataFrame, form: str = "object", column: str = "value",
                   keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-3/4/5 with the message kept where it holds no post: the four post columns (in the order of
    ``form``, ``object`` or ``list``), ``raw`` and ``reason``, and the ``keep`` columns of the message.

    ``raw`` is the text of a message without a post id, NULL otherwise; ``reason`` is ``empty``,
    ``malformed`` (no JSON, by the parser's corrupt-record column) or ``no post``.
    """
    schema = schemas.OBJECT_MESSAGE if form == "object" else schemas.LIST_MESSAGE
    columns = schemas.STREAM_POST_COLUMNS if form == "object" else schemas.BATCH_POST_COLUMNS
    corrupt = "_malformed"
    parsed = F.from_json(F.col("raw"), StructType([*schema.fields, StructField(corrupt, StringType())]),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    read = messages.select(*keep, F.col(column).cast("string").alias("raw")).withColumn("m", parsed)
    post = F.col("m.data") if form == "object" else F.get(F.col("m.data"), 0)
    no_post = post.getField("id").isNull()
    reason = F.when(F.coalesce(F.length("raw"), F.lit(0)) == 0, "empty") \
        .when(F.col("m").getField(corrupt).isNotNull(), "malformed").otherwise("no post")
    return read.select(*[post.getField(c).alias(c) for c in columns], F.when(no_post, F.col("raw")).alias("raw"),
                       F.when(no_post, reason).alias("reason"), *keep)


def non_empty(df: DataFrame, column: str = "value") -> DataFrame:
    """FLT-3: drop empty (keep-alive) and NULL messages."""
    return df.where(F.length(F.col(column)) > 0)


def encode_messages(df: DataFrame, key: str | None = None,
                    cols: Sequence[str] | None = None, as_json: bool = True) -> DataFrame:
    """PRJ-6: rows → ``key, value`` messages (BINARY, UTF-8), ready for a Kafka or file sink.

    ``as_json``: value is ``to_json(struct(cols))`` (NULL fields are left out of the object);
    otherwise the single column in ``cols`` is sent unchanged, as the line forwarder does.
    """
    cols = list(cols or df.columns)
    if as_json:
        value: Column = F.to_json(F.struct(*[F.col(c) for c in cols]))
    else:
        if len(cols) != 1:
            raise ValueError("a raw message carries exactly one column")
        value = F.col(cols[0]).cast("string")
    key_col = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(key_col.cast("binary").alias("key"), value.cast("binary").alias("value"))


def encode_lookup_messages(posts: DataFrame, key: str | None = "id") -> DataFrame:
    """Posts → lookup-response messages in list form, ``{"data": [{post}]}`` (what the hydration
    step publishes and ``decode_list_posts`` reads back)."""
    item = F.struct(*[F.col(c) for c in ("author_id", "created_at", "id", "text")])
    value = F.to_json(F.struct(F.array(item).alias("data")))
    key_col = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return posts.select(key_col.cast("binary").alias("key"), value.cast("binary").alias("value"))
