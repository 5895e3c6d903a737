"""Streaming queries (STM-1 … STM-7): posts in append mode, running hashtag counts in complete
mode, and stream-static hydration.

Each query takes its own streaming read of the source (the reference reads twice, because the
two queries have different output modes) and writes through ``sinks.outputs.write_stream``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postflow import fs, schemas
from postflow.functions import messages as msg
from postflow.operators.enrich import hydrate
from postflow.operators.posts import hashtag_counts, ranked as ranked_rows, repartition_by
from postflow.sinks import keyed as kt
from postflow.sinks.outputs import write_stream


def posts_of(messages: DataFrame, payload: str = "json") -> DataFrame:
    """STM-1's projection: messages → ``id, author_id, created_at, text``.

    ``payload="text"`` treats each message as the post text itself (the text-only line feed of
    PRJ-7), so a socket feed of lines can be counted too; the other fields are NULL then.
    """
    if payload == "text":
        return messages.select(F.lit(None).cast("string").alias("id"),
                               F.lit(None).cast("string").alias("author_id"),
                               F.lit(None).cast("string").alias("created_at"),
                               F.col("value").cast("string").alias("text"))
    return msg.decode_object_posts(messages)


def running_hashtag_counts(messages: DataFrame, payload: str = "json",
                           partitions: int | None = None, ranked: bool = False) -> DataFrame:
    """STM-2's plan: tokens → hashtags → ``count`` per hashtag (stateful, never evicted).

    ``partitions`` is PRT-1 (the reference repartitions into 4 by hashtag); ``None`` keeps the
    aggregation's own partitioning, which scales with ``spark.sql.shuffle.partitions``.
    ``ranked`` is SRT-1: highest count first, after any repartition (complete mode only).
    """
    counts = hashtag_counts(posts_of(messages, payload).select("text"))
    counts = repartition_by(counts, partitions, ["hashtag"])
    return ranked_rows(counts, "count", "hashtag") if ranked else counts


def start_posts(messages: DataFrame, *, kind: str = "keyed", base: str | None = None,
                checkpoint: str | None = None, output_mode: str = "append",
                trigger: dict | None = None, payload: str = "json",
                table: kt.KeyedTable = kt.STREAM_POSTS) -> StreamingQuery:
    """STM-1 + STM-6: flattened posts, appended (upserted by id) to the stream post table."""
    posts = posts_of(messages, payload)
    if kind == "keyed" and "offset" in messages.columns and payload == "json":
        # Within a micro-batch, the last message of a post wins.
        parsed = F.from_json(F.col("value").cast("string"), schemas.OBJECT_MESSAGE)["data"]
        posts = messages.select(parsed.alias("post"), F.col("offset").alias(kt.ORDER)) \
            .select("post.*", kt.ORDER)
    return write_stream(posts, kind, checkpoint=checkpoint,
                        output_mode=output_mode, trigger=trigger, table=table, base=base,
                        query_name=None)


def start_hashtags(messages: DataFrame, *, kind: str = "keyed", base: str | None = None,
                   checkpoint: str | None = None, output_mode: str = "complete",
                   trigger: dict | None = None, payload: str = "json",
                   partitions: int | None = None, table: kt.KeyedTable | None = None,
                   ranked: bool | None = None, **sink) -> StreamingQuery:
    """STM-2 + STM-6: running hashtag counts.

    ``complete`` (the reference's mode): each trigger replaces the whole count table.
    ``update``: each trigger upserts only the hashtags it changed (into
    ``HASHTAG_COUNT_UPDATES``), so the write per trigger grows with the new posts rather than
    with the number of hashtags ever seen. ``ranked`` sorts each result, highest count first; by
    default where the order is seen and allowed (complete mode, not a keyed table). ``sink``: more
    arguments of ``write_stream``.
    """
    if ranked is None:
        ranked = output_mode == "complete" and kind != "keyed"
    if table is None:
        table = kt.HASHTAG_COUNTS if output_mode == "complete" else kt.HASHTAG_COUNT_UPDATES
    return write_stream(running_hashtag_counts(messages, payload, partitions, ranked), kind,
                        checkpoint=checkpoint, output_mode=output_mode, trigger=trigger,
                        table=table, base=base, **sink)


def start_hydrate(ids: DataFrame, archive: DataFrame | Callable[[DataFrame], DataFrame], *, base: str,
                  checkpoint: str, trigger: dict | None = None,
                  name: str = "hydrated") -> StreamingQuery:
    """JON-1 on a stream of id files: each micro-batch is hydrated against the archive with the
    skew-safe batch join, and written as one batch of an append-only Parquet folder
    (``<base>/<name>/batch_id=N``; a replayed micro-batch replaces its own folder).

    ``archive`` may be a function that gives the archive's rows of a DataFrame of ids: it is then
    called per micro-batch, so a growing keyed table is read as it is at that micro-batch, and
    only the rows of the micro-batch's ids (a DataFrame keeps the file listing it was created
    with)."""
    out = f"{base.rstrip('/')}/{name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (hydrate(batch, archive).withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(out))

    writer = ids.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_all(starters: Sequence[Callable[[], StreamingQuery]], spark: SparkSession,
            timeout: float | None = None) -> list[StreamingQuery]:
    """STM-3: start every query, then wait until any one of them ends (or ``timeout`` s).

    When one has failed, or the time is up, the others are stopped: a job with half its queries is
    not left running. When one has ended well (a bounded trigger), the others may end too.
    """
    spark.streams.resetTerminated()
    started: list[StreamingQuery] = []
    try:
        for start in starters:
            started.append(start())
        ended = True
        if timeout is None:
            spark.streams.awaitAnyTermination()
        else:
            ended = spark.streams.awaitAnyTermination(timeout)
    except BaseException:
        _stop(started)
        raise
    if not ended:
        _stop(started)
    return started


def _stop(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def reset_checkpoint(spark: SparkSession, checkpoint: str, base: str) -> bool:
    """STM-5: delete a query's checkpoint before it starts (it then begins from the source's
    start position). Refuses any path outside the job's ``base`` folder."""
    cp = fs.qualify(spark, checkpoint).rstrip("/")
    root = fs.qualify(spark, base).rstrip("/")
    if cp == root or not cp.startswith(root + "/"):
        raise ValueError(f"refusing to delete {cp}: not inside {root}")
    return fs.delete(spark, cp)
