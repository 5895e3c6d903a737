"""Post tables in the catalog (SNK-3, SNK-7, SRC-6): partitioned by bucket, bucketed by key.

A namespace is a database; a table in it is an external Parquet table

    PARTITIONED BY (seq, writer, bucket) CLUSTERED BY (key) INTO n BUCKETS

* ``bucket`` is the number Spark's own bucketing gives the key, as a partition column: a read for some
  keys prunes partitions by the buckets of these keys (dynamic partition pruning), and a read of the
  whole table needs no exchange to put the versions of a key together, nor do a union with a table
  bucketed alike, a distinct over it, or a join by key.
* A write is one batch: the latest row per key (combined before it is exchanged), under the number
  ``seq`` and the writer's name. Writing the same ``(seq, writer)`` again replaces the batch. ``seq`` is a
  time in microseconds, as in stores where the last write wins by its time stamp: a stream takes that
  of the micro-batch, which Spark keeps in the checkpoint, so that a replay has the same one.
  Nothing is listed to find it, so a write takes as long after 10,000 batches as after one.
* Reads keep, per key, the row of the highest ``(seq, writer)``.
* Rows without a key cannot be stored by key: they are in bucket ``REJECTED`` with their raw message, each.

``upsert(..., only_changes=True)`` leaves out rows that equal what is stored, so that a job that is run
again over the same input stores nothing. ``compact`` writes the current rows as one batch and drops
what it replaces.
"""

from __future__ import annotations

import re
import time
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from postflow import fs, schemas
from postflow.sinks.keyed import ORDER

REJECTED = -1  # bucket of rows without a key
RAW, REASON = "raw", "reason"  # of a rejected row: its message, and what was wrong with it
CHANGE = "change"  # of a row of ``fold_change``: 1 in the later content, -1 in the earlier one
AT = "_at"  # optional column of a batch: its number, the same in every row


@dataclass(frozen=True)
class PostTable:
    """Columns, key and number of buckets of a table. All tables that are joined or united without an
    exchange need the same number; a large archive has thousands."""

    name: str
    schema: StructType
    key: str
    buckets: int = 8

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.schema.fieldNames())

    @property
    def stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField(RAW, StringType()), StructField(REASON, StringType())])

    def bucket_of(self, key: Column | str) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))


# Table names and column orders of the two post tables and the author counts.
STREAM_POSTS = PostTable("stream_blob_tweets", schemas.post_schema(schemas.STREAM_POST_COLUMNS), "id")
BATCH_POSTS = PostTable("batch_tweets", schemas.post_schema(schemas.BATCH_POST_COLUMNS), "id")
AUTHOR_COUNTS = PostTable("topK_authors", schemas.AUTHOR_COUNTS, "author_id")
HASHTAG_COUNTS = PostTable("stream_hashtags", schemas.HASHTAG_COUNTS, "hashtag")


def create_namespace(spark: SparkSession, name: str, location: str) -> None:
    """A database for the tables, at a folder all of the cluster can reach."""
    _checked(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{fs.qualify(spark, location)}'")


def _checked(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_]\w*", name):
        raise ValueError(f"{name!r}: a name has letters, digits and _ only")
    return name


def create_table(spark: SparkSession, namespace: str, table: PostTable) -> str:
    """SNK-7: declare the table when the catalog has none; refuse one that is declared otherwise. The
    partitions of an existing folder are found again. Returns the full name."""
    name = f"{_checked(namespace)}.{_checked(table.name)}"
    parts = "seq BIGINT, writer STRING, bucket INT"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored.fields)
    if not spark.catalog.tableExists(name):
        root = f"{spark.catalog.getDatabase(namespace).locationUri.rstrip('/')}/{table.name}"
        known = fs.exists(spark, root)
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} ({columns}, {parts}) USING parquet
            OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (seq, writer, bucket)
            CLUSTERED BY (`{table.key}`) INTO {table.buckets} BUCKETS LOCATION '{root}'""")
        if known:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    elif (name, table) in _agreed:
        return name
    declared = spark.catalog.listColumns(name)
    found, key = [(c.name, c.dataType) for c in declared], [c.name for c in declared if c.isBucket]
    wanted = [(f.name, f.dataType.simpleString()) for f in table.stored.fields] + [
        ("seq", "bigint"), ("writer", "string"), ("bucket", "int")]
    if found != wanted or key != [table.key]:
        raise ValueError(f"table {name} is declared with {found} by {key}, not as {wanted} by [{table.key!r}]")
    _agreed.append((name, table))
    return name


_agreed: list[tuple[str, PostTable]] = []  # declarations this process has checked


def now() -> int:
    return time.time_ns() // 1000


def latest(df: DataFrame, table: PostTable) -> DataFrame:
    """Rows of one batch, one per key: the last by ``ORDER`` where the rows have one, then the greatest.
    Rows without a key stay apart, each."""
    rest = [c for c in table.columns if c != table.key]
    extra = [c if c in df.columns else F.lit(None).cast("string").alias(c) for c in (RAW, REASON)]
    order = [F.col(ORDER).cast("long").alias(ORDER) if ORDER in df.columns else F.lit(None).cast("long").alias(ORDER)]
    preferred = ["created_at", "text"] if {"created_at", "text"} <= set(rest) else []
    order += [F.col(AT)] if AT in df.columns else []
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields], *extra, *order)
    alone = F.when(F.col(table.key).isNull(), F.monotonically_increasing_id())
    value = F.struct(ORDER, *preferred, *[c for c in rest if c not in preferred], RAW, REASON)
    at = [F.max(AT).alias(AT)] if AT in df.columns else []
    best = rows.groupBy(table.key, alone.alias("_alone")).agg(F.max(value).alias("_best"), *at)
    return best.select(*[F.col(c) if c == table.key else F.col("_best").getField(c).alias(c)
                         for c in (*table.columns, RAW, REASON)], *[AT for _ in at])


def upsert(df: DataFrame, namespace: str, table: PostTable, writer: str, seq: int | None = None,
           only_changes: bool = False) -> int:
    """SNK-3: ``df`` as batch ``(seq, writer)`` (replacing that batch only); returns ``seq``, by default
    the present time (rows with a column ``AT`` bring their own). ``only_changes`` stores no row that is
    already the current one of its key, and no rejected message that is already stored."""
    spark = df.sparkSession
    name = create_table(spark, namespace, table)
    if not re.fullmatch(r"[\w-]+", writer):
        raise ValueError(f"writer {writer!r}: letters, digits, - and _ only")
    seq = now() if seq is None else int(seq)
    rows = latest(df, table)
    if only_changes:
        rest = [c for c in table.columns if c != table.key]
        news = _not_in(rows.where(F.col(table.key).isNotNull()), current(spark, namespace, table), table.key, rest)
        bad = rejected(spark, namespace, table)
        rows = news.unionByName(_not_in(rows.where(F.col(table.key).isNull()), bad, RAW, [*rest, RAW]))
    bucket = F.when(F.col(table.key).isNull(), REJECTED).otherwise(table.bucket_of(table.key))
    at = F.col(AT) if AT in rows.columns else F.lit(seq).cast("long")
    rows.select(*table.columns, RAW, REASON, at.alias("seq"), F.lit(writer).alias("writer"),
                bucket.alias("bucket")).write.mode("overwrite").insertInto(name)
    return seq


def _not_in(rows: DataFrame, stored: DataFrame, key: str, others: list[str]) -> DataFrame:
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in others]
    on = reduce(lambda a, b: a & b, same, F.col(f"n.{key}") == F.col(f"s.{key}"))
    return rows.alias("n").join(stored.alias("s"), on, "left_anti")


def versions(spark: SparkSession, namespace: str, table: PostTable, seen: Mapping[str, int] | None = None,
             unseen: Mapping[str, int] | None = None) -> DataFrame:
    """Stored rows with a key, as written: all, those of batches up to ``seen`` (last ``seq`` per writer), or
    those of later ones than ``unseen``. Both are filters on partition columns: other batches are not read."""
    rows = spark.table(create_table(spark, namespace, table)).where("bucket >= 0")
    if seen is not None:
        rows = rows.where(_within(seen))
    if unseen is not None:
        rows = rows.where(~_within(unseen))
    return rows.drop(RAW, REASON)


def _within(marks: Mapping[str, int]) -> Column:
    """Whether a stored row is of a batch up to ``marks`` (last ``seq`` per writer)."""
    each = [(F.col("writer") == w) & (F.col("seq") <= s) for w, s in marks.items()] or [F.lit(False)]
    return reduce(lambda a, b: a | b, each)


def key_of(table: PostTable) -> Column:
    """The key of stored rows, for a union that keeps their buckets. Under a name of its own: a union compares
    the partitionings of its sides by their whole attributes, and those of a table carry the table's name."""
    return F.col(table.key).alias(table.key, metadata={"key": True})


def for_keys(rows: DataFrame, table: PostTable, keys: DataFrame) -> DataFrame:
    """The stored rows of some keys. The bucket numbers of the keys, at most one row per bucket of the
    table, are broadcast and prune the partitions that are read; the join by key then needs an exchange
    of the keys only."""
    return for_keys_buckets(rows, table, keys).join(keys.select(table.key), table.key, "left_semi")


def for_keys_buckets(rows: DataFrame, table: PostTable, keys: DataFrame) -> DataFrame:
    """The stored rows in the buckets of some keys."""
    # The condition is always true; it tells the optimiser that the list is worth pruning by.
    buckets = keys.select(table.bucket_of(table.key).alias("bucket")).where("bucket >= 0").distinct()
    return rows.join(F.broadcast(buckets), "bucket", "left_semi")


def fold(rows: DataFrame, table: PostTable) -> DataFrame:
    """One row per key, that of the highest ``(seq, writer)``."""
    rest = [c for c in table.columns if c != table.key]
    best = rows.groupBy(table.key).agg(F.max(F.struct("seq", "writer", *rest)).alias("_best"))
    return best.select(*[key_of(table) if c == table.key else F.col("_best").getField(c).alias(c) for c in table.columns])


def fold_change(rows: DataFrame, table: PostTable, then: Mapping[str, int]) -> DataFrame:
    """``fold`` of all rows, with ``CHANGE`` 1, and of those of the batches up to ``then``, with ``CHANGE`` -1: two
    contents of a table from one read of it."""
    rest = [c for c in table.columns if c != table.key]
    value = F.struct("seq", "writer", *rest)
    best = rows.groupBy(table.key).agg(F.max(value).alias("_now"), F.max(F.when(_within(then), value)).alias("_then"))
    states = F.array(*[F.struct(F.lit(n).alias(CHANGE), F.col(c).alias("_best")) for n, c in ((1, "_now"), (-1, "_then"))])
    each = best.select(table.key, F.explode(states).alias("_state")).where("_state._best IS NOT NULL")
    return each.select(*[key_of(table) if c == table.key else F.col("_state._best").getField(c).alias(c)
                         for c in table.columns], F.col("_state").getField(CHANGE).alias(CHANGE))


def current(spark: SparkSession, namespace: str, table: PostTable, keys: DataFrame | None = None,
            seen: Mapping[str, int] | None = None) -> DataFrame:
    """SRC-6: the content of a table, one row per key: all, or that of some ``keys`` (a DataFrame with the
    key column), as it is or as it was after the batches ``seen``."""
    rows = versions(spark, namespace, table, seen=seen)
    return fold(rows if keys is None else for_keys(rows, table, keys), table)


def rejected(spark: SparkSession, namespace: str, table: PostTable) -> DataFrame:
    """Rows without a key, each with its raw message, the reason, and its batch."""
    rows = spark.table(create_table(spark, namespace, table)).where(F.col("bucket") == REJECTED)
    return rows.drop(table.key, "bucket")


def batches(spark: SparkSession, namespace: str, table: PostTable) -> DataFrame:
    """Partitions of a table, ``seq, writer, bucket``, from the catalog: no file is opened."""
    spec = spark.sql(f"SHOW PARTITIONS {create_table(spark, namespace, table)}")
    pattern = "seq=([0-9]+)/writer=([^/]+)/bucket=(-?[0-9]+)"
    return spec.select(F.regexp_extract("partition", pattern, 1).cast("long").alias("seq"),
                       F.regexp_extract("partition", pattern, 2).alias("writer"),
                       F.regexp_extract("partition", pattern, 3).cast("int").alias("bucket"))


def marks(spark: SparkSession, namespace: str, table: PostTable) -> dict[str, int]:
    """The last batch of every writer (one row per writer comes to the driver)."""
    last = batches(spark, namespace, table).where("bucket >= 0").groupBy("writer").agg(F.max("seq").alias("seq"))
    return {r.writer: r.seq for r in last.collect()}


def compact(spark: SparkSession, namespace: str, table: PostTable, writer: str = "compacted") -> None:
    """Write the rows of all batches up to now as one batch, then drop these batches. A reader sees the same
    rows before, meanwhile and after; rejected rows stay. Marks of ``versions`` taken before do not hold after."""
    old = batches(spark, namespace, table).where("bucket >= 0").collect()
    if not old:
        return
    name = create_table(spark, namespace, table)
    last: dict[str, int] = {}
    for p in old:
        last[p.writer] = max(p.seq, last.get(p.writer, p.seq))
    seq = upsert(current(spark, namespace, table, seen=last), namespace, table, writer, max(last.values()) + 1)
    _drop(spark, namespace, table, [p for p in old if (p.seq, p.writer) != (seq, writer)])


def _drop(spark: SparkSession, namespace: str, table: PostTable, partitions: list) -> None:
    root = f"{spark.catalog.getDatabase(namespace).locationUri.rstrip('/')}/{table.name}"
    for p in partitions:
        spark.sql(f"ALTER TABLE {namespace}.{table.name} DROP IF EXISTS PARTITION "
                  f"(seq={p.seq}, writer='{p.writer}', bucket={p.bucket})")
        fs.delete(spark, f"{root}/seq={p.seq}/writer={p.writer}/bucket={p.bucket}")


def last_batch(spark: SparkSession, namespace: str, table: PostTable, writer: str) -> DataFrame:
    """The rows of a writer's last batch, for results that are replaced as a whole."""
    last = marks(spark, namespace, table).get(writer, -1)
    rows = spark.table(create_table(spark, namespace, table))
    return rows.where((F.col("seq") == last) & (F.col("writer") == writer) & (F.col("bucket") >= 0)).select(*table.columns)


def drop_earlier(spark: SparkSession, namespace: str, table: PostTable, writer: str) -> None:
    """Drop a writer's batches before its last one but one (which a reader may still be using)."""
    own = batches(spark, namespace, table).where(F.col("writer") == writer).collect()
    kept = sorted({p.seq for p in own})[-2:]
    _drop(spark, namespace, table, [p for p in own if p.seq not in kept])


def merge_buckets(changes: DataFrame, namespace: str, table: PostTable) -> None:
    """SNK-4: put the new rows of changed keys (one per key) into a table that holds one row per key, by
    rewriting the buckets of these keys and no others: what a write costs follows the changes.
    The table is ``PARTITIONED BY (bucket)``; a repeated merge changes nothing."""
    spark = changes.sparkSession
    name = create_merged(spark, namespace, table)
    changes = changes.where(F.col(table.key).isNotNull()).select(*table.columns).persist()
    try:
        kept = for_keys_buckets(spark.table(name), table, changes).join(changes.select(table.key), table.key, "left_anti")
        both = changes.withColumn("bucket", table.bucket_of(table.key)).unionByName(kept)
        both.select(*table.columns, "bucket").repartition(table.buckets, "bucket").write.mode("overwrite").insertInto(name)
    finally:
        changes.unpersist()


def create_merged(spark: SparkSession, namespace: str, table: PostTable) -> str:
    """Declare a table of one row per key, partitioned by bucket only (``merge_buckets``)."""
    name = f"{_checked(namespace)}.{_checked(table.name)}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    if not spark.catalog.tableExists(name):
        root = f"{spark.catalog.getDatabase(namespace).locationUri.rstrip('/')}/{table.name}"
        known = fs.exists(spark, root)
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} ({columns}, bucket INT) USING parquet
            OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (bucket) LOCATION '{root}'""")
        if known:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    if [c.name for c in spark.catalog.listColumns(name)] != [*table.columns, "bucket"]:
        raise ValueError(f"table {name} is declared otherwise")
    return name
