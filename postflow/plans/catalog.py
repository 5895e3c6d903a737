"""

Every query reads the whole ``events`` table of ``sf_dir`` (through ``plans.fixtures``). The
streaming ones first write their input with Spark into a fresh folder under the session's
shared work folder, run the stream to the end of its input (``availableNow``), and return the
read of what the stream wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.functions import messages as msg
from postflow.functions.text import hashtags, text_lines
from postflow.operators import enrich, posts as ops
from postflow.plans import fixtures as fx, jobs, table_jobs as tj
from postflow.session import scratch, scratch_namespace
from postflow.sinks import keyed as kt
from postflow.sinks import tables as tb
from postflow.sources.messages import read_id_files, read_messages
from postflow.streaming import queries as sq
from postflow.streaming import tables as st

TOP_K = 10
AVAILABLE_NOW = {"availableNow": True}


# -- hashtags ------------------------------------------------------------------------------

def hashtag_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashtags(fx.posts(spark, sf_dir), keep=("id",))


def hashtag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.hashtag_counts(fx.posts(spark, sf_dir))


def top_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_k(ops.hashtag_counts(fx.posts(spark, sf_dir)), TOP_K, "count", "hashtag")


# -- messages ------------------------------------------------------------------------------

def decode_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.decode_object_posts(fx.object_messages(spark, sf_dir))


def decode_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.decode_list_posts(fx.list_messages(spark, sf_dir))


def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.decode_flat_posts(msg.non_empty(fx.roundtrip_messages(spark, sf_dir)))


def text_line_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(fx.posts(spark, sf_dir))


# -- post tables ---------------------------------------------------------------------------

def union_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.union_posts(fx.stream_posts(spark, sf_dir), fx.batch_posts(spark, sf_dir))


def distinct_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.all_posts(fx.stream_posts(spark, sf_dir), fx.batch_posts(spark, sf_dir))


def author_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.author_counts(distinct_posts(spark, sf_dir))


def top_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_k(author_counts(spark, sf_dir), TOP_K, "count", "author_id")


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream posts as batch 0, then batch posts (other column order) as batch 1, read by key."""
    base = scratch(spark, "keyed_upsert")
    kt.write_keyed(fx.stream_posts(spark, sf_dir), kt.STREAM_POSTS, base, 0)
    kt.write_keyed(fx.batch_posts(spark, sf_dir), kt.STREAM_POSTS, base, 1)
    return kt.read_table(spark, kt.STREAM_POSTS, base)


def keyed_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers of one table: A writes the stream posts, B the batch posts, A's batch is replayed
    (it keeps its place before B), then A writes the posts of every tenth event again."""
    base, table = scratch(spark, "keyed_two_writers"), kt.BATCH_POSTS
    kt.write_keyed(fx.stream_posts(spark, sf_dir), table, base, 0, writer="A")
    kt.write_keyed(fx.batch_posts(spark, sf_dir), table, base, 0, writer="B")
    kt.write_keyed(fx.stream_posts(spark, sf_dir), table, base, 0, writer="A")
    again = fx.base(spark, sf_dir).where(F.col("event_id") % 10 == 5) \
        .withColumn("text", F.concat("text", F.lit(" (again)")))
    kt.write_keyed(again, table, base, 1, writer="A")
    return kt.read_table(spark, table, base)


def top_authors_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-3 with ``k``, run twice: over the stream posts, then over both tables."""
    base = scratch(spark, "top_authors_replaced")
    kt.write_keyed(fx.stream_posts(spark, sf_dir), kt.STREAM_POSTS, base, 0)
    jobs.authors(spark, output="keyed", base=base, k=TOP_K)
    kt.write_keyed(fx.batch_posts(spark, sf_dir), kt.BATCH_POSTS, base, 0)
    jobs.authors(spark, output="keyed", base=base, k=TOP_K)
    return kt.read_table(spark, kt.TOP_AUTHORS, base)


# -- real texts ----------------------------------------------------------------------------

def document_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.hashtag_counts(fx.documents(spark, sf_dir))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(fx.documents(spark, sf_dir)).groupBy("line").count()


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(fx.conversations(spark, sf_dir)).groupBy("line").count()


def document_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.tag_by_rules(fx.documents(spark, sf_dir), fx.DOCUMENT_RULES)


# -- enrichment ----------------------------------------------------------------------------

def hydrate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.hydrate(fx.ids(spark, sf_dir), fx.posts(spark, sf_dir))


def hydrate_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids against a keyed archive of several batches: only the ids' rows are folded."""
    base, table = scratch(spark, "hydrate_keyed"), kt.STREAM_POSTS
    kt.write_keyed(fx.stream_posts(spark, sf_dir), table, base, 0)
    kt.write_keyed(fx.batch_posts(spark, sf_dir), table, base, 1)
    return enrich.hydrate(fx.ids(spark, sf_dir), lambda ids: kt.read_table(spark, table, base, keys=ids))


def rule_matches_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.tag_by_rules(fx.with_lang(spark, sf_dir), fx.many_rules(spark))


def rule_matches_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10,000 keywords: what a post costs follows its length, not their number."""
    return enrich.tag_by_rules(fx.with_lang(spark, sf_dir), fx.keyword_rules(spark))


def rule_tagged_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = enrich.matching_rules(fx.with_lang(spark, sf_dir), fx.rules(spark))
    return tagged.select("id", F.to_json("matching_rules").alias("matching_rules"))


def rule_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.tag_by_rules(fx.with_lang(spark, sf_dir), fx.rules(spark))


# -- streaming -----------------------------------------------------------------------------

def _write_id_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    (fx.ids(spark, sf_dir).write.mode("overwrite")
       .option("sep", "\t").option("header", True).csv(path))


def id_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 + PRJ-1: id files arrive in a folder; the stream keeps ``tweet_id`` (file sink)."""
    base = scratch(spark, "id_stream")
    _write_id_files(spark, sf_dir, f"{base}/in")
    stream = msg.ids(read_id_files(spark, f"{base}/in"))
    query = (stream.writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").outputMode("append")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _write_messages(df: DataFrame, path: str) -> None:
    df.select("key", "value").write.mode("append").parquet(path)


def stream_posts_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark, "stream_posts")
    _write_messages(fx.object_messages(spark, sf_dir), f"{base}/in")
    source = read_messages(spark, "files", path=f"{base}/in")
    sq.start_posts(source, base=base, checkpoint=f"{base}/checkpoint/posts",
                   trigger=AVAILABLE_NOW).awaitTermination()
    return kt.read_table(spark, kt.STREAM_POSTS, base)


def stream_hashtags_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark, "stream_hashtags")
    _write_messages(fx.object_messages(spark, sf_dir), f"{base}/in")
    source = read_messages(spark, "files", path=f"{base}/in")
    sq.start_hashtags(source, base=base, checkpoint=f"{base}/checkpoint/hashtags",
                      trigger=AVAILABLE_NOW).awaitTermination()
    return kt.read_table(spark, kt.HASHTAG_COUNTS, base)


def stream_hashtags_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-6 with ``update`` mode: messages arrive in two parts; the second run upserts only
    the counts its part changes."""
    base = scratch(spark, "stream_hashtags_update")
    messages = fx.object_messages(spark, sf_dir, keep_event_id=True)
    for part in (0, 1):
        _write_messages(messages.where(F.col("event_id") % 2 == part), f"{base}/in")
        source = read_messages(spark, "files", path=f"{base}/in")
        sq.start_hashtags(source, base=base, checkpoint=f"{base}/checkpoint/hashtags",
                          output_mode="update", trigger=AVAILABLE_NOW).awaitTermination()
    return kt.read_table(spark, kt.HASHTAG_COUNT_UPDATES, base)


def stream_line_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The socket path: the text-only line feed (PRJ-7) arrives as lines of text files and the
    hashtag stream counts them with ``payload="text"`` (each line is post text)."""
    base = scratch(spark, "stream_line_feed")
    text_lines(fx.posts(spark, sf_dir)).write.mode("append").text(f"{base}/in")
    source = read_messages(spark, "files", path=f"{base}/in", file_format="text")
    sq.start_hashtags(source, base=base, checkpoint=f"{base}/checkpoint/hashtags",
                      payload="text", trigger=AVAILABLE_NOW).awaitTermination()
    return kt.read_table(spark, kt.HASHTAG_COUNTS, base)


def stream_hydrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark, "stream_hydrate")
    _write_id_files(spark, sf_dir, f"{base}/in")
    sq.start_hydrate(read_id_files(spark, f"{base}/in"), fx.posts(spark, sf_dir), base=base,
                     checkpoint=f"{base}/checkpoint/hydrate",
                     trigger=AVAILABLE_NOW).awaitTermination()
    return spark.read.parquet(f"{base}/hydrated").drop("batch_id")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-4: the hashtag stream runs, stops, new files arrive, it runs again on the same
    checkpoint; the table then counts both parts once each."""
    base = scratch(spark, "stream_restart")
    messages = fx.object_messages(spark, sf_dir, keep_event_id=True)
    checkpoint = f"{base}/checkpoint/hashtags"
    for part in (0, 1):
        _write_messages(messages.where(F.col("event_id") % 2 == part), f"{base}/in")
        source = read_messages(spark, "files", path=f"{base}/in")
        sq.start_hashtags(source, base=base, checkpoint=checkpoint,
                          trigger=AVAILABLE_NOW).awaitTermination()
    return kt.read_table(spark, kt.HASHTAG_COUNTS, base)


# -- catalog tables ------------------------------------------------------------------------

def hydrate_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-1 against a catalog table of two batches: the ids prune the buckets that are read."""
    ns = scratch_namespace(spark, "hydrate_pruned")
    tb.upsert(fx.stream_posts(spark, sf_dir), ns, tb.STREAM_POSTS, "stream")
    tb.upsert(fx.batch_posts(spark, sf_dir), ns, tb.STREAM_POSTS, "batch")
    return enrich.hydrate(fx.ids(spark, sf_dir), lambda ids: tb.current(spark, ns, tb.STREAM_POSTS, keys=ids))


def author_counts_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-3 over two tables bucketed by id: fold, union and distinct without an exchange."""
    ns = scratch_namespace(spark, "author_counts_bucketed")
    tb.upsert(fx.stream_posts(spark, sf_dir), ns, tb.STREAM_POSTS, "stream")
    tb.upsert(fx.batch_posts(spark, sf_dir), ns, tb.BATCH_POSTS, "batch")
    return ops.author_counts(ops.all_posts(tb.current(spark, ns, tb.STREAM_POSTS), tb.current(spark, ns, tb.BATCH_POSTS)))


def authors_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-3 run three times: over the stream posts, after the batch posts came, after posts were edited
    and given to another author. The second and third run read only what the new batches touch."""
    ns = scratch_namespace(spark, "authors_incremental")
    tb.upsert(fx.stream_posts(spark, sf_dir), ns, tb.STREAM_POSTS, "stream")
    tj.authors(spark, ns)
    tb.upsert(fx.batch_posts(spark, sf_dir), ns, tb.BATCH_POSTS, "batch")
    tj.authors(spark, ns)
    tb.upsert(fx.moved_posts(spark, sf_dir), ns, tb.STREAM_POSTS, "stream")
    return tj.authors(spark, ns)


def ingest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-2 on a topic in which posts come again, edited, at later offsets: the last offset wins. The
    second run of the same topic stores nothing, so the result also counts what is stored."""
    ns = scratch_namespace(spark, "ingest_offsets")
    for _ in range(2):
        tj.ingest(fx.list_messages_again(spark, sf_dir), ns)
    stored = tb.versions(spark, ns, tb.BATCH_POSTS).groupBy("id").agg(F.count("*").alias("versions"))
    return tb.current(spark, ns, tb.BATCH_POSTS).join(stored, "id")


def _message_folder(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Object messages as files of a fresh folder."""
    path = f"{scratch(spark, label)}/in"
    _write_messages(fx.object_messages(spark, sf_dir), path)
    return path


def stream_posts_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 as streaming state: all messages arrive twice; the second time nothing is stored. The result
    counts the stored versions of each post."""
    ns = scratch_namespace(spark, "stream_posts_latest")
    base = scratch(spark, "latest")
    for _ in range(2):
        _write_messages(fx.object_messages(spark, sf_dir), f"{base}/in")
        st.start_latest_posts(read_messages(spark, "files", path=f"{base}/in"), namespace=ns,
                              checkpoint=f"{base}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    stored = tb.versions(spark, ns, tb.STREAM_POSTS).groupBy("id").agg(F.count("*").alias("versions"))
    return tb.current(spark, ns, tb.STREAM_POSTS).join(stored, "id")


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-3: the messages without a post, as they came, and why."""
    ns = scratch_namespace(spark, "rejected_messages")
    folder = _message_folder(spark, sf_dir, "rejected")
    st.start_posts(read_messages(spark, "files", path=folder), namespace=ns, checkpoint=f"{folder[:-3]}/checkpoint",
                   trigger=AVAILABLE_NOW).awaitTermination()
    return tb.rejected(spark, ns, tb.STREAM_POSTS).select("raw", "reason")


def stream_hashtags_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-2 by changed buckets, over messages that arrive in two parts."""
    ns = scratch_namespace(spark, "stream_hashtags_buckets")
    base = scratch(spark, "buckets")
    messages = fx.object_messages(spark, sf_dir, keep_event_id=True)
    for part in (0, 1):
        _write_messages(messages.where(F.col("event_id") % 2 == part), f"{base}/in")
        st.start_hashtags(read_messages(spark, "files", path=f"{base}/in"), namespace=ns,
                          checkpoint=f"{base}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    return spark.table(f"{ns}.{tb.HASHTAG_COUNTS.name}").select(*tb.HASHTAG_COUNTS.columns)


def stream_top_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-1 / TOP-1 on the stream: the top after each of three parts of the messages."""
    ns = scratch_namespace(spark, "stream_top_hashtags")
    base = scratch(spark, "top")
    messages = fx.object_messages(spark, sf_dir, keep_event_id=True)
    found = []
    for part in range(3):
        _write_messages(messages.where(F.col("event_id") % 3 == part), f"{base}/in")
        st.start_top_hashtags(read_messages(spark, "files", path=f"{base}/in"), 5, namespace=ns,
                              checkpoint=f"{base}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
        # Its five rows now: the next part replaces them.
        top = st.top_hashtags(spark, ns, f"{base}/checkpoint").withColumn("part", F.lit(part))
        path = f"{base}/after-{part}"
        top.write.parquet(path)
        found.append(spark.read.parquet(path))
    return found[0].unionByName(found[1]).unionByName(found[2])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hashtag_tokens": hashtag_tokens,
    "hashtag_counts": hashtag_counts,
    "top_hashtags": top_hashtags,
    "decode_object": decode_object,
    "decode_list": decode_list,
    "message_roundtrip": message_roundtrip,
    "text_lines": text_line_feed,
    "union_posts": union_posts,
    "distinct_posts": distinct_posts,
    "author_counts": author_counts,
    "top_authors": top_authors,
    "keyed_upsert": keyed_upsert,
    "keyed_two_writers": keyed_two_writers,
    "top_authors_replaced": top_authors_replaced,
    "hydrate_ids": hydrate_ids,
    "hydrate_keyed": hydrate_keyed,
    "rule_matches": rule_matches,
    "rule_matches_many": rule_matches_many,
    "rule_matches_keywords": rule_matches_keywords,
    "rule_tagged_posts": rule_tagged_posts,
    "document_hashtags": document_hashtags,
    "document_lines": document_lines,
    "document_rules": document_rules,
    "conversation_lines": conversation_lines,
    "id_stream": id_stream,
    "stream_posts_append": stream_posts_append,
    "stream_hashtags_complete": stream_hashtags_complete,
    "stream_hashtags_update": stream_hashtags_update,
    "stream_line_feed": stream_line_feed,
    "stream_hydrate": stream_hydrate,
    "stream_restart": stream_restart,
    "hydrate_pruned": hydrate_pruned,
    "author_counts_bucketed": author_counts_bucketed,
    "authors_incremental": authors_incremental,
    "ingest_offsets": ingest_offsets,
    "stream_posts_latest": stream_posts_latest,
    "rejected_messages": rejected_messages,
    "stream_hashtags_buckets": stream_hashtags_buckets,
    "stream_top_hashtags": stream_top_hashtags,
}
