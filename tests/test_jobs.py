"""The five jobs end to end on files (JOB-1 … JOB-5), inputs derived from ``events``."""

import pytest
from pyspark.sql import functions as F

from postflow.functions.messages import encode_lookup_messages
from postflow.plans import fixtures as fx
from postflow.plans import jobs
from postflow.sinks import keyed as kt

NOW = {"availableNow": True}


def test_jobs_chain(spark, sf_dir, tmp_base):
    base = f"{tmp_base}/tables"
    # JOB-1: live posts and hashtag counts from object-form messages.
    fx.object_messages(spark, sf_dir).write.parquet(f"{tmp_base}/live")
    queries = jobs.stream(spark, source="files", output="keyed", base=base, trigger=NOW,
                          path=f"{tmp_base}/live", wait=False)
    for q in queries:
        q.awaitTermination()
    posts = fx.posts(spark, sf_dir)
    well_formed = fx.base(spark, sf_dir).where(~(F.col("event_id") % 50).isin(1, 2, 3))
    assert kt.read_table(spark, kt.STREAM_POSTS, base).count() == well_formed.count()
    assert kt.read_table(spark, kt.HASHTAG_COUNTS, base).count() == 17

    # JOB-4 + JOB-5: id files → hydrated posts into the batch table.
    ids = fx.ids(spark, sf_dir)
    ids.write.option("sep", "\t").option("header", True).csv(f"{tmp_base}/ids")
    jobs.ids(spark, path=f"{tmp_base}/ids", output="console", trigger=NOW)
    jobs.hydrate(spark, path=f"{tmp_base}/ids", base=base, output="keyed", trigger=NOW)
    resolved = ids.join(kt.read_table(spark, kt.STREAM_POSTS, base),
                        F.col("tweet_id") == F.col("id")).select("tweet_id").distinct().count()
    assert kt.read_table(spark, kt.BATCH_POSTS, base).count() == resolved

    # JOB-2: lookup messages (list form) ingested into the same batch table (upsert by id).
    encode_lookup_messages(posts).write.parquet(f"{tmp_base}/lookups")
    jobs.ingest(spark, source="files", output="keyed", base=base, path=f"{tmp_base}/lookups")
    assert kt.read_table(spark, kt.BATCH_POSTS, base).count() == posts.count()

    # JOB-3: authors over both tables, top 5 and full ranking into the author table.
    top = jobs.authors(spark, output="console", base=base, k=5).collect()
    assert len(top) == 5 and top[0]["count"] >= top[-1]["count"]
    for k in (0, -1):
        with pytest.raises(ValueError, match="k must be"):
            jobs.authors(spark, output="keyed", base=base, k=k)
    jobs.authors(spark, output="keyed", base=base)
    stored = kt.read_table(spark, kt.AUTHOR_COUNTS, base)
    assert stored.count() == posts.select("author_id").where("author_id IS NOT NULL") \
        .distinct().count()
    assert kt.read_rejected(spark, kt.AUTHOR_COUNTS, base).count() == 1  # the NULL author



def test_incremental_ingest_reads_only_new_messages(spark, sf_dir, tmp_base):
    base = f"{tmp_base}/tables"
    posts = fx.posts(spark, sf_dir)
    first = posts.where(F.col("id").cast("long") % 2 == 0)
    second = posts.where(F.col("id").cast("long") % 2 == 1)
    encode_lookup_messages(first).write.mode("append").parquet(f"{tmp_base}/lookups")
    got = jobs.ingest(spark, source="files", output="keyed", base=base,
                      path=f"{tmp_base}/lookups", incremental=True)
    assert got.count() == first.count()
    encode_lookup_messages(second).write.mode("append").parquet(f"{tmp_base}/lookups")
    got = jobs.ingest(spark, source="files", output="keyed", base=base,
                      path=f"{tmp_base}/lookups", incremental=True)
    assert got.count() == posts.count()
    last = [q for q in spark.streams.active]
    assert not last
    stored = spark.read.parquet(kt.BATCH_POSTS.path(base)).where("NOT rejected")
    assert stored.count() == posts.count()  # every message was read once, not re-read


def _id_file(spark, ids, folder):
    spark.createDataFrame([(i, "u") for i in ids], "tweet_id string, user_id string").coalesce(1) \
        .write.mode("append").option("sep", "\t").option("header", True).csv(folder)


def test_hydrate_ingest_hydrate_keeps_every_row(spark, tmp_base):
    """Two writers of one table in turns: neither replaces the other's batches."""
    base = f"{tmp_base}/tables"
    columns = "id string, author_id string, created_at string, text string"
    live = spark.createDataFrame([(str(i), "a", "t", f"live {i}") for i in range(4)], columns)
    kt.write_keyed(live, kt.STREAM_POSTS, base, 0)
    _id_file(spark, ["0", "1"] + ["1"] * 500, f"{tmp_base}/ids")
    jobs.hydrate(spark, path=f"{tmp_base}/ids", base=base, trigger=NOW)
    looked_up = spark.createDataFrame([(i, "b", "t", "looked up") for i in ("100", "101")], columns)
    encode_lookup_messages(looked_up).write.parquet(f"{tmp_base}/lookups")
    jobs.ingest(spark, source="files", output="keyed", base=base, path=f"{tmp_base}/lookups")
    _id_file(spark, ["2", "3"], f"{tmp_base}/ids")
    jobs.hydrate(spark, path=f"{tmp_base}/ids", base=base, trigger=NOW)
    jobs.ingest(spark, source="files", output="keyed", base=base, path=f"{tmp_base}/lookups", incremental=True)
    got = sorted(r.id for r in kt.read_table(spark, kt.BATCH_POSTS, base).collect())
    assert got == ["0", "1", "100", "101", "2", "3"]
    stored = spark.read.parquet(kt.BATCH_POSTS.path(base))
    assert stored.where("id = '1'").count() == 1  # a hot id is stored once


def test_top_authors_replace_the_table(spark, tmp_base):
    columns = "id string, author_id string, created_at string, text string"
    kt.write_keyed(spark.createDataFrame([("1", "a", "t", "x"), ("2", "a", "t", "y"), ("3", "b", "t", "z")], columns),
                   kt.STREAM_POSTS, tmp_base, 0)
    jobs.authors(spark, output="keyed", base=tmp_base, k=1)
    kt.write_keyed(spark.createDataFrame([(str(i), "b", "t", "w") for i in range(10, 13)], columns),
                   kt.STREAM_POSTS, tmp_base, 1)
    jobs.authors(spark, output="keyed", base=tmp_base, k=1)
    assert [tuple(r) for r in kt.read_table(spark, kt.TOP_AUTHORS, tmp_base).collect()] == [("b", 4)]


def test_ingest_takes_the_last_offset_and_stores_no_second_copy(spark, tmp_base, monkeypatch):
    columns = "id string, author_id string, created_at string, text string, offset long"
    posts = spark.createDataFrame([("1", "a", "t", "zz first", 1), ("1", "a", "t", "aa last", 9), ("2", "b", "t", "x", 4)], columns)
    value = F.to_json(F.struct(F.array(F.struct("id", "author_id", "created_at", "text")).alias("data"))).cast("binary")
    messages = posts.select(F.col("id").cast("binary").alias("key"), value.alias("value"), "offset")
    monkeypatch.setattr(jobs, "read_messages", lambda *_, **__: messages)
    for _ in range(3):
        got = jobs.ingest(spark, source="kafka", output="keyed", base=tmp_base)
    assert got.columns == ["id", "author_id", "text", "created_at"]
    assert {r.id: r.text for r in kt.read_table(spark, kt.BATCH_POSTS, tmp_base).collect()} == {"1": "aa last", "2": "x"}
    assert spark.read.parquet(kt.BATCH_POSTS.path(tmp_base)).count() == 2
