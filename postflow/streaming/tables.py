"""Streams into the catalog tables of ``sinks.tables``: posts with their bad messages, the latest version
of each post, running counts by changed bucket, and the running top of the hashtags.

Every stream writes through ``foreachBatch``; the number of its batches is the micro-batch's own time, which
Spark keeps in the checkpoint, so a replayed micro-batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postflow.functions import messages as msg
from postflow.operators.posts import top_k
from postflow.sinks import tables as tb
from postflow.sinks.keyed import ORDER
from postflow.sinks.outputs import stream_writer
from postflow.streaming.queries import running_hashtag_counts

#: Name of the counts a posts stream reports per micro-batch (``query.lastProgress``).
OBSERVED = "messages"
TOP_HASHTAGS = tb.PostTable("stream_hashtags_top", tb.HASHTAG_COUNTS.schema, "hashtag", buckets=1)


def stamped(df: DataFrame) -> DataFrame:
    """Rows of a stream with the time of their micro-batch, in microseconds."""
    return df.withColumn(tb.AT, F.unix_micros(F.current_timestamp()))


def _start(df: DataFrame, write, checkpoint: str, mode: str, trigger: dict | None) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


def checked_posts(messages: DataFrame, form: str = "object") -> DataFrame:
    """Posts with ``raw`` and ``reason`` of messages without one, numbered by the message's offset where the
    source has one; each micro-batch reports how many messages it read, and how many held no post."""
    offset = ["offset"] if "offset" in messages.columns else []
    posts = msg.decode_checked(messages, form, keep=offset)
    if offset:
        posts = posts.withColumnRenamed("offset", ORDER)
    return posts.observe(OBSERVED, F.count(F.lit(1)).alias("messages"), F.count("reason").alias("rejected"),
                         F.count(F.when(F.col("reason") == "malformed", 1)).alias("malformed"))


def start_posts(messages: DataFrame, *, namespace: str, checkpoint: str, trigger: dict | None = None,
                form: str = "object", table: tb.PostTable = tb.STREAM_POSTS) -> StreamingQuery:
    """STM-1 into a catalog table: posts are upserted, messages without a post are kept as they came."""

    def write(batch: DataFrame, _: int) -> None:
        tb.upsert(batch, namespace, table, stream_writer(batch.sparkSession, checkpoint))

    return _start(stamped(checked_posts(messages, form)), write, checkpoint, "append", trigger)


def latest_posts(messages: DataFrame, form: str = "object") -> DataFrame:
    """SNK-3 as streaming state: the latest version of each post, in update mode. The state (RocksDB) holds
    one row per post and a digest per version; a micro-batch gives only posts whose row it changes. The
    latest is the one of the greatest ``(created_at, text, author_id)``, so a message that comes again
    changes nothing, in whatever order messages come."""
    posts = msg.decode_checked(messages, form).where("id IS NOT NULL")
    columns = [c for c in posts.columns if c not in ("id", "raw", "reason")]
    # By digest: the state of versions seen needs no texts.
    posts = posts.withColumn("digest", F.sha2(F.to_json(F.struct("id", *sorted(columns))), 256)).dropDuplicates(["digest"])
    # A version arrives once; the latest one is new where it arrived with this micro-batch.
    posts = posts.withColumn("arrived", F.current_timestamp())
    best = posts.groupBy("id").agg(F.max(F.struct("created_at", "text", "author_id", "arrived")).alias("best"))
    return best.where(F.col("best.arrived") == F.current_timestamp()) \
        .select("id", *[F.col("best").getField(c).alias(c) for c in columns])


def start_latest_posts(messages: DataFrame, *, namespace: str, checkpoint: str, trigger: dict | None = None,
                       form: str = "object", table: tb.PostTable = tb.STREAM_POSTS) -> StreamingQuery:
    """The latest version of each post into a catalog table: a batch holds the posts it changed."""

    def write(batch: DataFrame, _: int) -> None:
        tb.upsert(batch, namespace, table, stream_writer(batch.sparkSession, checkpoint))

    return _start(stamped(latest_posts(messages, form)), write, checkpoint, "update", trigger)


def start_hashtags(messages: DataFrame, *, namespace: str, checkpoint: str, trigger: dict | None = None,
                   payload: str = "json", table: tb.PostTable = tb.HASHTAG_COUNTS) -> StreamingQuery:
    """STM-2 with the content of complete mode at the cost of update mode: a micro-batch rewrites the buckets
    of the hashtags whose counts it changed (``sinks.tables.merge_buckets``)."""

    def write(batch: DataFrame, _: int) -> None:
        tb.merge_buckets(batch, namespace, table)

    return _start(running_hashtag_counts(messages, payload), write, checkpoint, "update", trigger)


def merge_top(old: DataFrame, changed: DataFrame, k: int, by: str = "count", key: str = "hashtag") -> DataFrame:
    """TOP-1, incremental: counts only grow, so the new top ``k`` lies in the old one and the rows that
    changed; of a key in both, the greater count is the new one."""
    both = old.select(key, by).unionByName(changed.select(key, by))
    return top_k(both.groupBy(key).agg(F.max(by).alias(by)), k, by, key)


def start_top_hashtags(messages: DataFrame, k: int, *, namespace: str, checkpoint: str, trigger: dict | None = None,
                       payload: str = "json", table: tb.PostTable = TOP_HASHTAGS) -> StreamingQuery:
    """SRT-1 / TOP-1 on the stream: after every micro-batch, the ``k`` most frequent hashtags so far. A
    micro-batch reads the ``k`` rows of the last one and the counts it changed, never all counts."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        writer = stream_writer(spark, checkpoint)
        batch.persist()
        try:
            some = batch.select(tb.AT).first()
            if some is not None:
                old = tb.last_batch(spark, namespace, table, writer)
                tb.upsert(merge_top(old, batch, k), namespace, table, writer, some[0])
                tb.drop_earlier(spark, namespace, table, writer)
        finally:
            batch.unpersist()

    return _start(stamped(running_hashtag_counts(messages, payload)), write, checkpoint, "update", trigger)


def top_hashtags(spark, namespace: str, checkpoint: str, table: tb.PostTable = TOP_HASHTAGS) -> DataFrame:
    """What ``start_top_hashtags`` last found."""
    return tb.last_batch(spark, namespace, table, stream_writer(spark, checkpoint))
