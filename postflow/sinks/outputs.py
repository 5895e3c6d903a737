"""Output selection by name for batch and streaming results (SNK-1, SNK-2, SNK-5, SNK-6, SNK-8).

Kinds: ``console`` (print), ``keyed`` (upsert or replace keyed table, see ``sinks.keyed``),
``kafka`` (``key``/``value`` messages, see ``functions.messages.encode_messages``), and
``format`` (any Spark data source by name, e.g. a connector the cluster provides).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from postflow import fs
from postflow.sinks import keyed as kt
from postflow.sources.messages import kafka_sink_options

SINK_KINDS = ("console", "keyed", "kafka", "format")


def write(df: DataFrame, kind: str = "console", *, table: kt.KeyedTable | None = None,
          base: str | None = None, batch_id: int = 0, writer: str | None = None, topic: str | None = None,
          servers: str = "localhost:9092", format: str | None = None,
          options: dict | None = None, preview: bool = False, only_changes: bool = False) -> None:
    """SNK-1/3/4/8: write a batch result.

    A keyed write is batch ``batch_id`` of ``writer``; without a writer it is a writer of its own, so
    it adds to what others wrote, or with ``only_changes`` what differs from it. ``preview`` (SNK-6) shows 20 rows of what was written, read back from the sink rather than
    by running the query a second time.
    """
    if kind == "console":
        df.write.format("console").mode("append").options(**(options or {})).save()
        return
    if kind == "keyed":
        if table is None or base is None:
            raise ValueError("kind='keyed' needs table= and base=")
        spark = df.sparkSession
        if table.mode == "replace":
            kt.replace_keyed(df, table, base)
        else:
            rows = kt.changes(df, table, base) if only_changes else df
            kt.write_keyed(rows, table, base, batch_id, writer or f"run-{uuid.uuid4().hex[:16]}")
        if preview:
            kt.read_table(spark, table, base).show(20)
        return
    if kind == "kafka":
        if topic is None:
            raise ValueError("kind='kafka' needs topic=")
        (df.write.format("kafka").options(**kafka_sink_options(servers))
           .option("topic", topic).options(**(options or {})).save())
        return
    if kind == "format":
        if not format:
            raise ValueError("kind='format' needs format=")
        df.write.format(format).mode("append").options(**(options or {})).save()
        return
    raise ValueError(f"unknown output {kind!r}; expected one of {SINK_KINDS}")


def write_stream(df: DataFrame, kind: str = "console", *, checkpoint: str | None = None,
                 output_mode: str = "complete", trigger: dict | None = None,
                 table: kt.KeyedTable | None = None, base: str | None = None,
                 topic: str | None = None, servers: str = "localhost:9092",
                 format: str | None = None, path: str | None = None,
                 options: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """SNK-2/3/4/5/8 + STM-4/6/7: start a streaming query writing ``df``.

    ``trigger``: keyword arguments of ``DataStreamWriter.trigger`` (``None`` = micro-batches as
    fast as possible, as in the reference). ``checkpoint`` is required for every sink but the
    console, so a restarted query resumes where it stopped.
    """
    writer = df.writeStream.outputMode(output_mode)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    elif kind != "console":
        raise ValueError(f"a {kind} stream needs checkpoint=")
    if kind == "console":
        return writer.format("console").option("truncate", "true").options(**(options or {})).start()
    if kind == "keyed":
        if table is None or base is None:
            raise ValueError("kind='keyed' needs table= and base=")
        if table.mode == "replace" and output_mode != "complete":
            raise ValueError(f"{table.name} is replaced on every write: it needs complete mode")
        return writer.foreachBatch(keyed_batch_writer(table, base, checkpoint)).start()
    if kind == "kafka":
        if topic is None:
            raise ValueError("kind='kafka' needs topic=")
        return (writer.format("kafka").options(**kafka_sink_options(servers))
                .option("topic", topic).options(**(options or {})).start())
    if kind == "format":
        if not format:
            raise ValueError("kind='format' needs format=")
        if path:
            writer = writer.option("path", path)
        return writer.format(format).options(**(options or {})).start()
    raise ValueError(f"unknown output {kind!r}; expected one of {SINK_KINDS}")


def stream_writer(spark, checkpoint: str) -> str:
    """Writer name of the stream with this checkpoint: the id Spark keeps in the checkpoint. A
    restart has the same id, so it replays its own batches; after a reset (STM-5) the id is new,
    so the first batches of the new run replace nothing."""
    text = fs.read_text(spark, f"{checkpoint.rstrip('/')}/metadata")
    if not text:
        raise RuntimeError(f"no query id in {checkpoint}")
    return f"stream-{json.loads(text)['id']}"


def keyed_batch_writer(table: kt.KeyedTable, base: str, checkpoint: str):
    """``foreachBatch`` function: micro-batch ``b`` becomes batch ``b`` of the stream's writer
    (upsert) or the next snapshot (replace; a replayed micro-batch has the same content)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if table.mode == "replace":
            kt.replace_keyed(batch, table, base)
        else:
            kt.write_keyed(batch, table, base, batch_id, stream_writer(batch.sparkSession, checkpoint))

    return write_batch
