"""Keyed tables over Parquet (SNK-3, SNK-4, SNK-7, SRC-6).

The reference keeps its tables in a key-value store where writing a key again replaces the row.
Here a keyed table is a directory of Parquet files written only by Spark jobs:

* **upsert** tables (append = upsert): each write is a batch of one writer, stored under
  ``<base>/<name>/writer=W/batch_id=N/seq=S/rejected=false|true/``. Writing batch ``N`` of writer
  ``W`` again replaces exactly that batch (dynamic partition overwrite), so a replayed micro-batch
  is idempotent and no writer can touch another's rows. ``S`` orders batches of all writers: it is the
  time of the batch's first write, and kept on replay; two writers that take
  the same number at the same time are ordered by name. Reads keep, per key, the row of the highest
  ``(seq, writer)``, then the highest position in the batch, where the writer gave one (column
  ``ORDER``, for example the Kafka offset), then the highest tie-break columns (NULL lowest). Rows
  with a NULL key cannot be stored by key; they land in ``rejected=true`` instead of being lost.
* **replace** tables (complete = truncate and replace): each write is a full snapshot in a
  fresh folder ``<base>/<name>/v<N>-<token>/``; a commit file ``_commits/<N>`` then names it.
  Files are only created, never overwritten, so a reader sees either the old or the new
  snapshot, never half of one. A snapshot is deleted once its successor is older than
  ``RETAIN_SECONDS``, so a reader has that long to finish.

The first use of a table writes its declaration (columns, types, key, mode) to ``_declared`` in its
folder; every later use is checked against it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from postflow import fs, schemas

COMMITS = "_commits"
DECLARED = "_declared"
#: How long a replaced snapshot stays readable.
RETAIN_SECONDS = 24 * 3600
ORDER = "_order"  # optional column of a written batch: later rows have greater numbers
BATCH = "batch"  # writer of batches that no stream or job owns


@dataclass(frozen=True)
class KeyedTable:
    """Declared columns (in table order), primary key, and write mode."""

    name: str
    schema: StructType
    keys: tuple[str, ...]
    mode: str = "upsert"  # or "replace"
    # Tie-break after the batch number, highest wins (NULL lowest); other columns follow.
    order: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.schema.fieldNames())

    def path(self, base: str) -> str:
        return f"{base.rstrip('/')}/{self.name}"


# The reference's four tables; the names are fixed values that must equal its table names.
STREAM_POSTS = KeyedTable("stream_blob_tweets", schemas.post_schema(schemas.STREAM_POST_COLUMNS),
                          ("id",), "upsert", ("created_at", "text", "author_id"))
BATCH_POSTS = KeyedTable("batch_tweets", schemas.post_schema(schemas.BATCH_POST_COLUMNS),
                         ("id",), "upsert", ("created_at", "text", "author_id"))
HASHTAG_COUNTS = KeyedTable("stream_hashtags", schemas.HASHTAG_COUNTS, ("hashtag",), "replace")
# Running counts written in update mode: only the hashtags a micro-batch changed are written,
# and the latest batch of a hashtag holds its current count.
HASHTAG_COUNT_UPDATES = KeyedTable("stream_hashtags_updates", schemas.HASHTAG_COUNTS,
                                   ("hashtag",), "upsert", ("count",))
AUTHOR_COUNTS = KeyedTable("topK_authors", schemas.AUTHOR_COUNTS, ("author_id",), "upsert",
                           ("count",))


# The top k only: replaced as a whole, so that authors who leave the top do not stay.
TOP_AUTHORS = KeyedTable("topK_authors_top", schemas.AUTHOR_COUNTS, ("author_id",), "replace")


def _stored_schema(table: KeyedTable) -> StructType:
    return StructType(list(table.schema.fields) + [
        StructField("position", LongType()), StructField("writer", StringType()), StructField("batch_id", LongType()),
        StructField("seq", LongType()), StructField("rejected", BooleanType())])


def _key_present(keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _shape(df: DataFrame, table: KeyedTable) -> DataFrame:
    """Columns by name, in table order and type (the two post tables order columns differently)."""
    return df.select(*_columns(table))


def _columns(table: KeyedTable) -> list:
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]


def ensure_table(spark: SparkSession, table: KeyedTable, base: str) -> str:
    """SNK-7: declare the table when absent, check the declaration when present; returns its path."""
    path = table.path(base)
    if not fs.exists(spark, path):
        fs.mkdirs(spark, path)
    own = {"columns": {f.name: f.dataType.simpleString() for f in table.schema.fields},
           "keys": list(table.keys), "mode": table.mode}
    fs.create_text(spark, f"{path}/{DECLARED}", json.dumps(own))
    found = declaration(spark, table.name, base)
    if found != own:
        raise ValueError(f"table {table.name} is declared as {found}, not as {own}")
    return path


def declaration(spark: SparkSession, name: str, base: str) -> dict | None:
    """Columns, key and mode of a table as declared in its folder; ``None`` if it has none."""
    text = fs.read_text(spark, f"{base.rstrip('/')}/{name}/{DECLARED}")
    return json.loads(text) if text else None


def _sequence(spark: SparkSession, root: str, writer: str, batch_id: int) -> int:
    """The number of this batch: the one it has, or the present time in microseconds, as in stores where
    the last write wins by its time stamp. Only the batch's own folder is looked into."""
    for name in fs.list_names(spark, f"{root}/writer={writer}/batch_id={batch_id}"):
        if name.startswith("seq="):
            return int(name.split("=", 1)[1])
    return time.time_ns() // 1000


def changes(df: DataFrame, table: KeyedTable, base: str) -> DataFrame:
    """Of the latest row per key of ``df``, those that differ from the table's current row, and of its rows
    without a key those that are not stored yet: what a job that is run again has to write."""
    spark = df.sparkSession
    position = F.col(ORDER).cast("long") if ORDER in df.columns else F.lit(None).cast("long")
    rows = df.select(*_columns(table), position.alias("position"), F.lit("").alias("writer"), F.lit(0).alias("seq"))
    news = latest_by_key(rows.where(_key_present(table.keys)), table)
    bad = rows.where(~_key_present(table.keys)).select(*table.columns)
    keyed = [F.col(f"n.{k}") == F.col(f"s.{k}") for k in table.keys]
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in table.columns if c not in table.keys]
    every = [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in table.columns]
    news = news.alias("n").join(read_table(spark, table, base).alias("s"), reduce(lambda a, b: a & b, keyed + same), "left_anti")
    bad = bad.alias("n").join(read_rejected(spark, table, base).alias("s"), reduce(lambda a, b: a & b, every), "left_anti")
    return news.unionByName(bad)


def write_keyed(df: DataFrame, table: KeyedTable, base: str, batch_id: int,
                writer: str = BATCH) -> None:
    """SNK-3: write ``df`` as batch ``batch_id`` of ``writer`` (replacing that batch only).

    One pass over ``df``: keyed and rejected rows go to sibling partitions of the same write.
    ``writer`` is a folder name: letters, digits, ``-`` and ``_``.
    """
    if table.mode != "upsert":
        raise ValueError(f"{table.name} is a {table.mode} table")
    if not writer or not all(c.isalnum() or c in "-_" for c in writer):
        raise ValueError(f"writer {writer!r}: letters, digits, - and _ only")
    spark = df.sparkSession
    root = ensure_table(spark, table, base)
    seq = _sequence(spark, root, writer, int(batch_id))
    position = F.col(ORDER).cast("long") if ORDER in df.columns else F.lit(None).cast("long")
    out = df.select(*_columns(table), position.alias("position")).select(
        "*", F.lit(writer).alias("writer"), F.lit(int(batch_id)).cast("long").alias("batch_id"),
        F.lit(seq).cast("long").alias("seq"), (~_key_present(table.keys)).alias("rejected"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("writer", "batch_id", "seq", "rejected").parquet(root))


def replace_keyed(df: DataFrame, table: KeyedTable, base: str, version: int | None = None) -> int:
    """SNK-4: write ``df`` as the full content of a replace table; returns the version written.

    The rows go to a folder no reader knows yet (``v<version>-<token>``); then a commit file
    ``_commits/<version>`` naming that folder is created. Without ``version`` the next free one is
    taken; one that is already committed is left as it is.
    """
    if table.mode != "replace":
        raise ValueError(f"{table.name} is a {table.mode} table")
    spark = df.sparkSession
    root = ensure_table(spark, table, base)
    own = version is not None
    number = int(version) if own else max(_versions(spark, root), default=-1) + 1
    if own and fs.exists(spark, f"{root}/{COMMITS}/{number}"):
        return number
    folder = f"v{number}-{uuid.uuid4().hex[:12]}"
    out = _shape(df, table).select("*", (~_key_present(table.keys)).alias("rejected"))
    out.write.mode("overwrite").partitionBy("rejected").parquet(f"{root}/{folder}")
    # Another writer may have taken the number meanwhile.
    while not fs.create_text(spark, f"{root}/{COMMITS}/{number}", folder) and not own:
        number += 1
    _drop_old_snapshots(spark, root)
    return number


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions of a replace table."""
    return sorted(int(n) for n in fs.list_names(spark, f"{root}/{COMMITS}") if n.isdigit())


def _current_snapshot(spark: SparkSession, root: str) -> str | None:
    versions = _versions(spark, root)
    if not versions:
        return None
    folder = fs.read_text(spark, f"{root}/{COMMITS}/{versions[-1]}")
    return f"{root}/{folder.strip()}" if folder else None


def _drop_old_snapshots(spark: SparkSession, root: str) -> None:
    """Delete versions whose successor was committed more than ``RETAIN_SECONDS`` ago."""
    versions = _versions(spark, root)
    limit = time.time() - RETAIN_SECONDS
    for old, successor in zip(versions, versions[1:]):
        if fs.modified(spark, f"{root}/{COMMITS}/{successor}") > limit:
            break
        folder = (fs.read_text(spark, f"{root}/{COMMITS}/{old}") or "").strip()
        if folder:
            fs.delete(spark, f"{root}/{folder}")
        fs.delete(spark, f"{root}/{COMMITS}/{old}")


def read_rejected(spark: SparkSession, table: KeyedTable, base: str) -> DataFrame:
    """Rows that had a NULL key: every batch of an upsert table (with ``batch_id``), or the
    current version of a replace table."""
    root = ensure_table(spark, table, base)
    if table.mode == "replace":
        current = _current_snapshot(spark, root)
        if current is None:
            return spark.createDataFrame([], table.schema)
        snap = spark.read.schema(_snapshot_schema(table)).parquet(current)
        return snap.where(F.col("rejected")).select(*table.columns)
    stored = spark.read.schema(_stored_schema(table)).parquet(root)
    return stored.where(F.col("rejected")).drop("rejected", "position")


def _snapshot_schema(table: KeyedTable) -> StructType:
    return StructType(list(table.schema.fields) + [StructField("rejected", BooleanType())])


def read_table(spark: SparkSession, table: KeyedTable, base: str,
               keys: DataFrame | None = None) -> DataFrame:
    """SRC-6: the current content of a keyed table, one row per key, in table column order.

    ``keys`` (a DataFrame with the key columns) limits the read to these keys. The stored rows are
    semi-joined with them before the latest row of each key is found, so what is aggregated and
    exchanged grows with the keys asked for, not with the table.
    """
    root = ensure_table(spark, table, base)
    if table.mode == "replace":
        current = _current_snapshot(spark, root)
        if current is None:
            return spark.createDataFrame([], table.schema)
        snap = spark.read.schema(_snapshot_schema(table)).parquet(current)
        rows = snap.where(~F.col("rejected")).select(*table.columns)
        return rows if keys is None else rows.join(keys, list(table.keys), "left_semi")
    stored = spark.read.schema(_stored_schema(table)).parquet(root).where(~F.col("rejected"))
    if keys is not None:
        stored = stored.join(keys, list(table.keys), "left_semi")
    return latest_by_key(stored, table)


def latest_by_key(stored: DataFrame, table: KeyedTable) -> DataFrame:
    """Per key, the row with the highest ``(seq, writer, position, order…, other columns…)``.

    Written as ``max(struct(...))`` grouped by key rather than a ``row_number`` window: the
    aggregate combines map-side, so a key written in every batch (a hot key) shuffles one row
    per input partition instead of all its versions to a single task.
    """
    rest = [c for c in table.columns if c not in table.keys]
    tie = ["seq", "writer", "position"] + [c for c in table.order if c in rest] + [c for c in rest
                                                                 if c not in table.order]
    latest = (stored.groupBy(*table.keys)
                    .agg(F.max(F.struct(*[F.col(c) for c in tie])).alias("_latest")))
    return latest.select(*[F.col(c) if c in table.keys else F.col("_latest").getField(c).alias(c)
                           for c in table.columns])


ALL_TABLES = (STREAM_POSTS, BATCH_POSTS, HASHTAG_COUNTS, HASHTAG_COUNT_UPDATES, AUTHOR_COUNTS,
              TOP_AUTHORS)


def register_views(spark: SparkSession, base: str,
                   tables: tuple[KeyedTable, ...] = ALL_TABLES) -> list[str]:
    """Name each table's current content as a temporary view, so it can be queried with
    ``spark.sql`` under the reference's table names (e.g. ``SELECT * FROM stream_hashtags``).
    A view shows the table as of this call (snapshot choice, batch listing); call again to see
    later writes. Returns the view names."""
    names = []
    for table in tables:
        read_table(spark, table, base).createOrReplaceTempView(table.name)
        names.append(table.name)
    return names
