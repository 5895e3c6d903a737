"""JOB-2, JOB-3 and JOB-5 over the catalog tables of ``sinks.tables``: each run costs what is new.

* ``ingest``: stores only posts that differ from what is stored, so a run over the same topic stores nothing.
* ``authors``: keeps the counts per author up to date by the difference that new batches make.
* ``hydrate``: reads only the buckets of the archive that hold the ids of the micro-batch.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from postflow.functions import messages as msg
from postflow.operators.enrich import hydrate as hydrate_ids
from postflow.operators.posts import all_posts, author_counts
from postflow.sinks import tables as tb
from postflow.sinks.keyed import ORDER
from postflow.sinks.outputs import stream_writer
from postflow.sources.messages import read_id_files
from postflow.streaming.tables import stamped

#: What the author counts include: one row per finished run, with the last batch of every writer of each
#: post table. It is written after the counts, so a run that failed halfway is done again from the counts before.
PROGRESS = tb.PostTable("author_progress", StructType([StructField("run", StringType()), StructField("seen", StringType())]),
                        "run", buckets=1)
AUTHORS = "authors"  # writer of the counts and of their progress
POST_TABLES = (tb.STREAM_POSTS, tb.BATCH_POSTS)


def ingest(messages: DataFrame, namespace: str, writer: str = "ingest") -> None:
    """JOB-2: the first post of each lookup message, upserted. Of several messages of one post the last
    offset wins, where the source has offsets; messages without a post are kept as they came."""
    offset = ["offset"] if "offset" in messages.columns else []
    posts = msg.decode_checked(messages, "list", keep=offset)
    if offset:
        posts = posts.withColumnRenamed("offset", ORDER)
    tb.upsert(posts, namespace, tb.BATCH_POSTS, writer, only_changes=True)


def hydrate(spark: SparkSession, *, path: str, namespace: str, checkpoint: str, trigger: dict | None = None,
            limit: int | None = None) -> StreamingQuery:
    """JOB-5: id files as they arrive, ``limit`` files at a time, looked up in the stream post table and
    upserted into the batch post table."""

    def write(batch: DataFrame, _: int) -> None:
        some = batch.select(tb.AT).first()
        if some is None:
            return
        found = hydrate_ids(batch, lambda ids: tb.current(spark, namespace, tb.STREAM_POSTS, keys=ids), copies=False)
        tb.upsert(found.withColumnRenamed("tweet_id", "id"), namespace, tb.BATCH_POSTS,
                  stream_writer(spark, checkpoint), some[0])

    writer = stamped(read_id_files(spark, path, limit=limit)).writeStream \
        .option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _posts(spark: SparkSession, namespace: str, seen: dict) -> DataFrame:
    """Distinct posts of both tables as they were after the batches ``seen``."""
    return all_posts(*[tb.current(spark, namespace, t, seen=seen.get(t.name, {})) for t in POST_TABLES])


def _progress(spark: SparkSession, namespace: str) -> tuple[int, dict] | None:
    last = tb.last_batch(spark, namespace, PROGRESS, AUTHORS).first()
    return (int(last.run), json.loads(last.seen)) if last else None


def changed_ids(spark: SparkSession, namespace: str, seen: dict, marks: dict) -> DataFrame:
    """Ids in batches after ``seen``: a filter on partition columns, other batches are not read. They stay in the
    buckets of the tables, so neither their distinct nor a join of a table with them needs an exchange."""
    ids = [tb.versions(spark, namespace, t, seen=marks[t.name], unseen=seen.get(t.name, {})).select(tb.key_of(t))
           for t in POST_TABLES]
    return ids[0].unionByName(ids[1]).distinct()


def author_deltas(spark: SparkSession, namespace: str, seen: dict, marks: dict) -> DataFrame:
    """``author_id, change``: by how much the posts per author differ between two states of the tables,
    from the posts in batches after ``seen`` alone: what they count for now, less what they counted for."""
    ids = changed_ids(spark, namespace, seen, marks)
    states = [tb.fold_change(tb.for_keys(tb.versions(spark, namespace, t, seen=marks[t.name]), t, ids), t, seen.get(t.name, {}))
              for t in POST_TABLES]
    # Distinct with the state in the row: distinct posts of each state.
    return author_counts(all_posts(*states), tb.CHANGE).where(F.col(tb.CHANGE) != 0).where("author_id IS NOT NULL")


def authors(spark: SparkSession, namespace: str) -> DataFrame:
    """JOB-3: bring the stored posts per author up to date and return them (``author_id, count``). Posts
    without an author are counted for none. When a writer's batches are gone (compaction), all are counted."""
    for t in POST_TABLES:
        tb.create_table(spark, namespace, t)
    marks = {t.name: tb.marks(spark, namespace, t) for t in POST_TABLES}
    done = _progress(spark, namespace)
    gone = done is not None and any(w not in marks[t] for t, ws in done[1].items() for w in ws)
    if done is None or marks != done[1]:
        run = tb.now()
        # One row per author; used more than once below, so kept for the run rather than counted again. By bucket, so
        # that a write makes one file per bucket, however many parts the counts came in.
        kept = lambda df: df.repartition(tb.AUTHOR_COUNTS.buckets, "author_id").persist()
        if done is None or gone:
            counts = kept(author_counts(_posts(spark, namespace, marks)).where("author_id IS NOT NULL"))
            stored = _counts(spark, namespace, done)
            lost = stored.join(counts, "author_id", "left_anti").select("author_id", F.lit(0).cast("long").alias("count"))
            new = counts.unionByName(lost)
        else:
            counts = kept(author_deltas(spark, namespace, done[1], marks))
            stored = _counts(spark, namespace, done, counts)
            new = counts.join(stored, "author_id", "left").select(
                "author_id", (F.coalesce("count", F.lit(0)) + F.col("change")).alias("count"))
        try:
            tb.upsert(new, namespace, tb.AUTHOR_COUNTS, AUTHORS, run)
        finally:
            counts.unpersist()
        row = spark.createDataFrame([(str(run), json.dumps(marks))], PROGRESS.schema)
        tb.upsert(row, namespace, PROGRESS, AUTHORS, run)
        done = (run, marks)
    return _counts(spark, namespace, done).where("count > 0")


def _counts(spark: SparkSession, namespace: str, done: tuple[int, dict] | None, keys: DataFrame | None = None) -> DataFrame:
    """Stored counts after the last finished run."""
    written = {**tb.marks(spark, namespace, tb.AUTHOR_COUNTS), AUTHORS: done[0] if done else -1}
    return tb.current(spark, namespace, tb.AUTHOR_COUNTS, keys, written)
