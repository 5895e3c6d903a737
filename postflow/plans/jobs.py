"""The reference's five jobs as functions, plus a small command line (JOB-1 … JOB-5).

    python -m postflow.plans.jobs stream  --source files --path IN --output keyed --base OUT
    python -m postflow.plans.jobs ingest  --source files --path IN --output keyed --base OUT
    python -m postflow.plans.jobs authors --output console --base OUT --k 10
    python -m postflow.plans.jobs ids     --path IDS --output console
    python -m postflow.plans.jobs hydrate --path IDS --base OUT --output keyed

The session comes from ``spark-submit`` (or ``SparkSession.builder`` defaults); the job never
sets a master. ``--base`` is the folder of the keyed tables (the reference's keyspace). With
``--namespace NAME`` the tables of ``stream``, ``ingest``, ``authors`` and ``hydrate`` are catalog tables of
the database NAME, at ``--base`` (``sinks.tables``), and are read by name through ``spark.sql``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from postflow.functions import messages as msg
from postflow.operators.enrich import hydrate as hydrate_ids
from postflow.operators.posts import all_posts, author_counts, ranked, top_k
from postflow.plans import table_jobs
from postflow.sinks import keyed as kt
from postflow.sinks import tables as tb
from postflow.sinks.outputs import stream_writer, write, write_stream
from postflow.sources.messages import read_id_files, read_messages
from postflow.streaming import queries as sq
from postflow.streaming import tables as st


def _checkpoint(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/_checkpoints/{name}"


def stream(spark: SparkSession, *, source: str = "socket", output: str = "console",
           base: str | None = None, reset: bool = False, trigger: dict | None = None,
           payload: str = "json", partitions: int | None = None, wait: bool = True,
           timeout: float | None = None, hashtag_mode: str = "complete",
           servers: str = "localhost:9092", **source_options):
    """JOB-1: live posts (append) and running hashtag counts (complete), two queries over two
    reads of the source; returns when any query ends (or after ``timeout`` seconds)."""
    if output in ("keyed", "kafka") and not base:
        raise ValueError(f"output {output!r} needs base= (tables and checkpoints)")
    cp_posts = _checkpoint(base, kt.STREAM_POSTS.name) if base else None
    tags_table = kt.HASHTAG_COUNTS if hashtag_mode == "complete" else kt.HASHTAG_COUNT_UPDATES
    cp_tags = _checkpoint(base, tags_table.name) if base else None
    if reset and base:
        for cp in (cp_posts, cp_tags):
            sq.reset_checkpoint(spark, cp, base)
    source_options["servers"] = servers

    def posts_query():
        src = read_messages(spark, source, **source_options)
        if output == "kafka":
            return write_stream(msg.encode_messages(sq.posts_of(src, payload), key="id"), "kafka",
                                checkpoint=cp_posts, output_mode="append", trigger=trigger,
                                topic=kt.STREAM_POSTS.name, servers=servers)
        return sq.start_posts(src, kind=output, base=base, checkpoint=cp_posts, trigger=trigger,
                              payload=payload)

    def hashtags_query():
        src = read_messages(spark, source, **source_options)
        if output == "kafka":
            counts = sq.running_hashtag_counts(src, payload, partitions)
            return write_stream(msg.encode_messages(counts, key="hashtag"), "kafka",
                                checkpoint=cp_tags, output_mode=hashtag_mode, trigger=trigger,
                                topic=tags_table.name, servers=servers)
        return sq.start_hashtags(src, kind=output, base=base, checkpoint=cp_tags,
                                 output_mode=hashtag_mode, trigger=trigger, payload=payload,
                                 partitions=partitions, table=tags_table)

    if not wait:
        return [posts_query(), hashtags_query()]
    return sq.run_all([posts_query, hashtags_query], spark, timeout)


def ingest(spark: SparkSession, *, source: str = "kafka", output: str = "console",
           base: str | None = None, topic: str = "getTweets", preview: bool = False,
           incremental: bool = False, **source_options) -> DataFrame:
    """JOB-2: bounded read of all lookup messages → first post of each → batch post table.

    The read takes the whole topic each run (as the reference does) and writes what differs from the
    table; of messages of one post the last offset wins. Returns the decoded posts (lazy).

    ``incremental=True`` (keyed output): the same plan runs as a stream with an
    ``availableNow`` trigger and a checkpoint under ``base``, so each run reads only the
    messages that arrived since the previous run; returns the batch post table.
    """
    if incremental:
        if output != "keyed" or not base:
            raise ValueError("incremental ingest writes the keyed batch table: output='keyed', base=")
        if source == "kafka":
            opts = dict(source_options.pop("options", None) or {})
            opts.setdefault("startingOffsets", "earliest")
            source_options["options"] = opts
        stream_in = read_messages(spark, source, streaming=True, topic=topic, **source_options)
        write_stream(_looked_up(stream_in), "keyed",
                     checkpoint=_checkpoint(base, "ingest"), output_mode="append",
                     trigger={"availableNow": True}, table=kt.BATCH_POSTS,
                     base=base).awaitTermination()
        return kt.read_table(spark, kt.BATCH_POSTS, base)
    posts = _looked_up(read_messages(spark, source, streaming=False, topic=topic, **source_options))
    write(posts if output == "keyed" else posts.drop(kt.ORDER), output, table=kt.BATCH_POSTS, base=base, preview=preview, only_changes=True)
    return posts.drop(kt.ORDER)


def _looked_up(messages: DataFrame) -> DataFrame:
    """Posts of lookup messages, numbered by the message's offset where the source has one."""
    if "offset" not in messages.columns:
        return msg.decode_list_posts(messages)
    posts = msg.decode_checked(messages, "list", keep=["offset"]).drop("raw", "reason")
    return posts.withColumnRenamed("offset", kt.ORDER)


def authors(spark: SparkSession, *, output: str = "console", base: str, k: int | None = None,
            preview: bool = False) -> DataFrame:
    """JOB-3: distinct posts of both tables → posts per author → highest first (top ``k``).

    Keyed output: all counts are upserted into the author table; the top ``k`` replace the table of
    the top, so an author who is no longer among them goes."""
    if k is not None and k < 1:
        raise ValueError(f"k must be 1 or more, not {k}")
    posts = all_posts(kt.read_table(spark, kt.STREAM_POSTS, base),
                      kt.read_table(spark, kt.BATCH_POSTS, base))
    counts = author_counts(posts)
    if k is not None:
        result = top_k(counts, k, "count", "author_id")
    elif output == "console":
        result = ranked(counts, "count", "author_id")
    else:
        result = counts  # a keyed table has no order: skip the global sort
    write(result, output, table=kt.AUTHOR_COUNTS if k is None else kt.TOP_AUTHORS, base=base,
          preview=preview, only_changes=k is None)
    return result


def ids(spark: SparkSession, *, path: str, output: str = "console", base: str | None = None,
        topic: str = "tweetId", trigger: dict | None = None, wait: bool = True,
        servers: str = "localhost:9092", limit: int | None = None):
    """JOB-4: id files as they arrive → ``tweet_id`` → console or Kafka topic ``tweetId``; ``limit`` files
    per micro-batch at most."""
    tweet_ids = msg.ids(read_id_files(spark, path, limit=limit))
    if output == "kafka":
        if not base:
            raise ValueError("output 'kafka' needs base= for the checkpoint")
        query = write_stream(msg.encode_messages(tweet_ids, cols=["tweet_id"], as_json=False),
                             "kafka", checkpoint=_checkpoint(base, "ids"), output_mode="append",
                             trigger=trigger, topic=topic, servers=servers)
    else:
        query = write_stream(tweet_ids, "console", output_mode="append", trigger=trigger,
                             checkpoint=_checkpoint(base, "ids") if base else None)
    if wait:
        query.awaitTermination()
    return query


def hydrate(spark: SparkSession, *, path: str, base: str, output: str = "keyed",
            archive: DataFrame | None = None, topic: str = "getTweets",
            trigger: dict | None = None, wait: bool = True, servers: str = "localhost:9092",
            limit: int | None = None):
    """JOB-5: id files → posts by a join against the archive (default: the stream post table).

    ``output``: ``keyed`` upserts the found posts into the batch post table; ``kafka`` publishes
    them as lookup messages (list form) for ``ingest``; ``console`` prints them. ``limit``: files per
    micro-batch at most.
    """
    def rows_of(ids: DataFrame) -> DataFrame:
        # Read per micro-batch: new posts are seen as they come, and only the listed ids' rows.
        return kt.read_table(spark, kt.STREAM_POSTS, base, keys=ids)

    stream_ids = read_id_files(spark, path, limit=limit)
    cp = _checkpoint(base, "hydrate")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # A table keyed by id holds each post once, however often its id was listed.
        found = hydrate_ids(batch, rows_of if archive is None else archive, copies=output != "keyed")
        if output == "kafka":
            write(msg.encode_lookup_messages(found.withColumnRenamed("tweet_id", "id")), "kafka",
                  topic=topic, servers=servers)
        elif output == "keyed":
            kt.write_keyed(found.withColumnRenamed("tweet_id", "id"), kt.BATCH_POSTS, base,
                           batch_id, stream_writer(spark, cp))
        else:
            write(found, "console")

    writer = stream_ids.writeStream.option("checkpointLocation", cp).foreachBatch(write_batch)
    if trigger:
        writer = writer.trigger(**trigger)
    query = writer.start()
    if wait:
        query.awaitTermination()
    return query


def table_job(spark: SparkSession, job: str, namespace: str, base: str, *, source: str = "files",
              k: int | None = None, payload: str = "json", path: str | None = None, trigger: dict | None = None,
              timeout: float | None = None, **source_options) -> None:
    """One of the jobs over the catalog tables of a database at ``base``, which is created if absent."""
    tb.create_namespace(spark, namespace, base)
    if job == "stream":
        def source_of() -> DataFrame:
            return read_messages(spark, source, path=path, **source_options)

        sq.run_all([
            lambda: st.start_posts(source_of(), namespace=namespace, checkpoint=_checkpoint(base, f"{namespace}-posts"), trigger=trigger),
            lambda: st.start_hashtags(source_of(), namespace=namespace, checkpoint=_checkpoint(base, f"{namespace}-hashtags"),
                                      trigger=trigger, payload=payload)], spark, timeout)
    elif job == "ingest":
        table_jobs.ingest(read_messages(spark, source, streaming=False, path=path, **source_options), namespace)
    elif job == "authors":
        top_k(table_jobs.authors(spark, namespace), k, "count", "author_id").show(k or 20)
    elif job == "hydrate":
        table_jobs.hydrate(spark, path=path, namespace=namespace, checkpoint=_checkpoint(base, f"{namespace}-hydrate"),
                           trigger=trigger, limit=source_options.get("limit")).awaitTermination()
    else:
        raise ValueError(f"{job} keeps no tables")


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="postflow")
    sub = parser.add_subparsers(dest="job", required=True)

    p = sub.add_parser("stream", help="live posts + running hashtag counts")
    p.add_argument("--source", choices=["kafka", "socket", "files"], default="socket")
    p.add_argument("--output", choices=["kafka", "console", "keyed", "cassandra"], default="console")
    p.add_argument("--del_checkpoint", choices=["true", "false"], default="false")
    p.add_argument("--payload", choices=["json", "text"], default="json")
    p.add_argument("--partitions", type=int, default=None)
    p.add_argument("--hashtag_mode", choices=["complete", "update"], default="complete")
    p.add_argument("--available_now", action="store_true")

    p = sub.add_parser("ingest", help="batch ingest of looked-up posts")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--incremental", action="store_true",
                   help="read only messages new since the last run (keyed output)")
    p.add_argument("--output", choices=["console", "keyed", "cassandra"], default="console")

    p = sub.add_parser("authors", help="posts per author, highest first")
    p.add_argument("--output", choices=["console", "keyed", "cassandra"], default="console")
    p.add_argument("--k", type=int, default=None,
                   help="keep only the k authors with most posts; without it all are ranked")

    p = sub.add_parser("ids", help="stream of id files")
    p.add_argument("--output", choices=["kafka", "console"], default="console")
    p.add_argument("--available_now", action="store_true")

    p = sub.add_parser("hydrate", help="id files → posts")
    p.add_argument("--output", choices=["kafka", "console", "keyed", "cassandra"], default="keyed")
    p.add_argument("--available_now", action="store_true")

    for name, sp in sub.choices.items():
        sp.add_argument("--base", default=None, help="folder of the keyed tables")
        sp.add_argument("--namespace", default=None,
                        help="keep the tables in this database of the catalog, at --base")
        sp.add_argument("--path", default=None, help="input folder (files source, id files)")
        sp.add_argument("--servers", default="localhost:9092")
        sp.add_argument("--topic", default=None)
        sp.add_argument("--limit", type=int, default=None,
                        help="files (Kafka: offsets) a micro-batch takes at most")
        sp.add_argument("--file_format", default="parquet",
                        help="files source: parquet | json (key/value columns) | text (lines)")

    args = parser.parse_args(argv)
    if getattr(args, "output", None) == "cassandra":
        # The reference's key-value store; here its tables are the keyed Parquet tables.
        args.output = "keyed"
    if args.namespace and args.job == "ids":
        parser.error("ids keeps no tables: --namespace is of no use")
    needs_base = args.job in ("authors", "hydrate") or args.output in ("keyed", "kafka") or args.namespace
    if needs_base and not args.base:
        parser.error(f"{args.job} with output {args.output} needs --base (the folder of the keyed tables)")
    if args.job in ("ids", "hydrate") and not args.path:
        parser.error(f"{args.job} needs --path (the folder of the id files)")
    if getattr(args, "k", None) is not None and args.k < 1:
        parser.error("--k must be 1 or more")
    if args.limit is not None and args.limit < 1:
        parser.error("--limit must be 1 or more")
    spark = SparkSession.builder.appName(f"postflow-{args.job}").getOrCreate()
    opts = {"servers": args.servers, "path": args.path, "file_format": args.file_format}
    if args.topic:
        opts["topic"] = args.topic
    trigger = {"availableNow": True} if getattr(args, "available_now", False) else None
    if args.job == "stream" or (args.job == "ingest" and args.incremental):
        opts["limit"] = args.limit
    if args.namespace:
        defaults = {"ingest": "getTweets"}
        table_job(spark, args.job, args.namespace, args.base, source=getattr(args, "source", "files"),
                  k=getattr(args, "k", None), payload=getattr(args, "payload", "json"), trigger=trigger,
                  **{"topic": defaults.get(args.job, "covid19"), **opts, "limit": args.limit})
        return
    if args.job == "stream":
        stream(spark, source=args.source, output=args.output, base=args.base,
               reset=args.del_checkpoint == "true", trigger=trigger, payload=args.payload,
               partitions=args.partitions, hashtag_mode=args.hashtag_mode, **opts)
    elif args.job == "ingest":
        ingest(spark, source=args.source, output=args.output, base=args.base,
               incremental=args.incremental, **opts)
    elif args.job == "authors":
        authors(spark, output=args.output, base=args.base, k=args.k)
    elif args.job == "ids":
        ids(spark, path=args.path, output=args.output, base=args.base, trigger=trigger,
            topic=args.topic or "tweetId", servers=args.servers, limit=args.limit)
    elif args.job == "hydrate":
        hydrate(spark, path=args.path, base=args.base, output=args.output,
                topic=args.topic or "getTweets", trigger=trigger, servers=args.servers, limit=args.limit)


if __name__ == "__main__":
    main()
