"""Streams into catalog tables: raw bad messages, latest per post, changed buckets, running top, bounded intake."""

import os

import pytest
from pyspark.sql import functions as F

from postflow import fs
from postflow.functions.messages import decode_checked
from postflow.plans import fixtures as fx
from postflow.plans import jobs, table_jobs as tj
from postflow.session import scratch_namespace
from postflow.sinks import tables as tb
from postflow.sources.messages import intake_options, read_messages
from postflow.streaming import tables as st

NOW = {"availableNow": True}


@pytest.fixture()
def ns(spark):
    return scratch_namespace(spark, "streams")


def _drop(spark, values, folder, offsets=None):
    rows = [(None if v is None else v.encode(), o) for v, o in zip(values, offsets or range(len(values)))]
    df = spark.createDataFrame(rows, "value binary, offset long").select(F.lit(None).cast("binary").alias("key"), "*").coalesce(1)
    (df if offsets else df.drop("offset")).write.mode("append").parquet(folder)


def _post(i, text, author="a", created="t"):
    return f'{{"data":{{"id":"{i}","author_id":"{author}","created_at":"{created}","text":"{text}"}}}}'


def test_messages_without_a_post_are_kept_as_they_came(spark, ns, tmp_base):
    values = [_post(1, "x"), "not json", '{"errors":[1]}', "", None, '{"data":{"text":"no id"}}', "not json", '{"data":[]}', '{"data"']
    _drop(spark, values, f"{tmp_base}/in")
    query = st.start_posts(read_messages(spark, "files", path=f"{tmp_base}/in"), namespace=ns, checkpoint=f"{tmp_base}/cp", trigger=NOW)
    query.awaitTermination()
    got = sorted(((r.raw, r.reason) for r in tb.rejected(spark, ns, tb.STREAM_POSTS).collect()), key=repr)
    want = [("not json", "malformed")] * 2 + [('{"errors":[1]}', "no post"), ("", "empty"), (None, "empty"),
                                             ('{"data":{"text":"no id"}}', "no post"), ('{"data":[]}', "malformed"),
                                             ('{"data"', "malformed")]
    assert got == sorted(want, key=repr)
    seen = [p["observedMetrics"][st.OBSERVED] for p in query.recentProgress if p["numInputRows"]]
    assert [(s["messages"], s["rejected"], s["malformed"]) for s in seen] == [(9, 8, 4)]
    assert tb.current(spark, ns, tb.STREAM_POSTS).count() == 1


def test_list_form_keeps_raw_messages_and_the_column_order(spark):
    df = spark.createDataFrame([('{"data":[{"id":"1","text":"x"},{"id":"2"}]}',), ('{"data":[]}',), ("oops",)], "value string")
    got = [tuple(r) for r in decode_checked(df, "list").collect()]
    assert got == [("1", None, "x", None, None, None), (None, None, None, None, '{"data":[]}', "no post"),
                   (None, None, None, None, "oops", "malformed")]


def test_the_last_offset_wins_and_a_restart_replaces_nothing(spark, ns, tmp_base):
    _drop(spark, [_post(1, "zz"), _post(1, "aa"), _post(2, "only")], f"{tmp_base}/in", [5, 7, 6])
    src = spark.readStream.schema("key binary, value binary, offset long").parquet(f"{tmp_base}/in")
    for _ in range(2):
        st.start_posts(src, namespace=ns, checkpoint=f"{tmp_base}/cp", trigger=NOW).awaitTermination()
        assert {r.id: r.text for r in tb.current(spark, ns, tb.STREAM_POSTS).collect()} == {"1": "aa", "2": "only"}
    _drop(spark, [_post(2, "new")], f"{tmp_base}/in", [9])
    st.start_posts(src, namespace=ns, checkpoint=f"{tmp_base}/cp", trigger=NOW).awaitTermination()
    assert {r.id: r.text for r in tb.current(spark, ns, tb.STREAM_POSTS).collect()} == {"1": "aa", "2": "new"}


def test_a_replayed_micro_batch_has_the_number_it_had(spark, ns, tmp_base):
    _drop(spark, [_post(1, "x")], f"{tmp_base}/in")

    def run():
        st.start_posts(read_messages(spark, "files", path=f"{tmp_base}/in"), namespace=ns, checkpoint=f"{tmp_base}/cp",
                       trigger=NOW).awaitTermination()
        return {(r.seq, r.writer) for r in tb.batches(spark, ns, tb.STREAM_POSTS).collect()}

    first = run()
    fs.delete(spark, f"{tmp_base}/cp/commits/0")  # as if it had been lost before the commit
    fs.delete(spark, f"{tmp_base}/cp/commits/.0.crc")
    assert run() == first and spark.table(f"{ns}.stream_blob_tweets").count() == 1


def test_latest_posts_store_changes_only(spark, ns, tmp_base):
    def run():
        st.start_latest_posts(read_messages(spark, "files", path=f"{tmp_base}/in"), namespace=ns,
                              checkpoint=f"{tmp_base}/cp", trigger=NOW).awaitTermination()
        return spark.table(f"{ns}.stream_blob_tweets").count()

    _drop(spark, [_post(i, "x") for i in range(20)] + ["junk"], f"{tmp_base}/in")
    assert run() == 20
    _drop(spark, [_post(i, "x") for i in range(20)], f"{tmp_base}/in")
    assert run() == 20  # the same messages again: nothing is stored
    _drop(spark, [_post(3, "y", created="u"), _post(4, "a", created="s"), _post(5, "x")], f"{tmp_base}/in")
    assert run() == 21  # one newer version; an older one and a repeated one change nothing
    assert {r.id: r.text for r in tb.current(spark, ns, tb.STREAM_POSTS).collect()} == {str(i): "y" if i == 3 else "x" for i in range(20)}


def test_top_of_the_stream_reads_its_last_top_only(spark, ns, tmp_base):
    parts = [["#a #a #b", "#c"], ["#c #c #d"], ["#b #b #b #b"], []]
    want = [[("#a", 2), ("#b", 1)], [("#c", 3), ("#a", 2)], [("#b", 5), ("#c", 3)], [("#b", 5), ("#c", 3)]]
    for texts, top in zip(parts, want):
        _drop(spark, [_post(i, t) for i, t in enumerate(texts)], f"{tmp_base}/in")
        st.start_top_hashtags(read_messages(spark, "files", path=f"{tmp_base}/in"), 2, namespace=ns,
                              checkpoint=f"{tmp_base}/cp", trigger=NOW).awaitTermination()
        got = st.top_hashtags(spark, ns, f"{tmp_base}/cp").collect()
        assert sorted(tuple(r) for r in got) == sorted(top)
    assert spark.table(f"{ns}.{st.TOP_HASHTAGS.name}").count() == 4  # of three tops, the last two are kept


def test_intake_is_bounded(spark, ns, tmp_base):
    for i in range(10):
        _drop(spark, [_post(i, f"#t{i % 3}")], f"{tmp_base}/in")
    query = st.start_hashtags(read_messages(spark, "files", path=f"{tmp_base}/in", limit=2), namespace=ns,
                              checkpoint=f"{tmp_base}/cp", trigger=NOW)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2] * 5
    got = {r.hashtag: r["count"] for r in spark.table(f"{ns}.{tb.HASHTAG_COUNTS.name}").collect()}
    assert got == {"#t0": 4, "#t1": 3, "#t2": 3}


def test_files_that_were_read_are_cleaned_away(spark, ns, tmp_base):
    def run():
        src = read_messages(spark, "files", path=f"{tmp_base}/in", limit=1, clean="archive", archive=f"{tmp_base}/done")
        st.start_posts(src, namespace=ns, checkpoint=f"{tmp_base}/cp", trigger=NOW).awaitTermination()

    for i in range(3):
        _drop(spark, [_post(i, "x")], f"{tmp_base}/in")
    run()
    _drop(spark, [_post(9, "x")], f"{tmp_base}/in")
    run()
    moved = [f for _, _, files in os.walk(f"{tmp_base}/done") for f in files if f.endswith(".parquet")]
    assert moved and tb.current(spark, ns, tb.STREAM_POSTS).count() == 4


def test_intake_options():
    assert intake_options("kafka", 100) == {"maxOffsetsPerTrigger": "100"}
    assert intake_options("files", 2, "delete") == {"maxFilesPerTrigger": "2", "cleanSource": "delete"}
    for bad in (("files", 0), ("files", 1, "burn"), ("files", 1, "archive"), ("socket", 1), ("kafka", 1, "delete")):
        with pytest.raises(ValueError):
            intake_options(*bad)


def test_hydrate_job_limits_and_prunes(spark, ns, sf_dir, tmp_base):
    tb.upsert(fx.stream_posts(spark, sf_dir), ns, tb.STREAM_POSTS, "s")
    os.makedirs(f"{tmp_base}/ids")
    for n in range(4):
        with open(f"{tmp_base}/ids/{n}.tsv", "w") as f:
            f.write("tweet_id\tuser_id\n" + "".join(f"{i}\tu\n" for i in (n, n + 10, 1, "none")))
    query = tj.hydrate(spark, path=f"{tmp_base}/ids", namespace=ns, checkpoint=f"{tmp_base}/cp", trigger=NOW, limit=2)
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 2
    wanted = [str(i) for i in (0, 1, 2, 3, 10, 11, 12, 13)]
    known = {r.id for r in fx.stream_posts(spark, sf_dir).where(F.col("id").isin(wanted)).collect()}
    assert {r.id for r in tb.current(spark, ns, tb.BATCH_POSTS).collect()} == known and known


def test_bounded_id_job_on_the_command_line(spark, tmp_base, capsys):
    os.makedirs(f"{tmp_base}/ids")
    with open(f"{tmp_base}/ids/a.tsv", "w") as f:
        f.write("tweet_id\tuser_id\n42\tu\n")
    jobs.main(["ids", "--path", f"{tmp_base}/ids", "--available_now", "--limit", "1"])  # ends by itself
    with pytest.raises(SystemExit):
        jobs.main(["ids", "--path", f"{tmp_base}/ids", "--limit", "0"])
    assert "--limit" in capsys.readouterr().err


def test_jobs_over_a_namespace_on_the_command_line(spark, tmp_base, capsys):
    ns, base = "cli_" + os.path.basename(tmp_base).replace("-", "_"), f"{tmp_base}/tables"
    _drop(spark, [_post(1, "#a #b", "ann"), _post(2, "#a", "bob"), _post(3, "#c", "ann"), "junk"], f"{tmp_base}/live")
    value = '{"data":[{"id":"%s","author_id":"%s","created_at":"t","text":"%s"}]}'
    _drop(spark, [value % (9, "bob", "x"), value % (1, "ann", "#a #b")], f"{tmp_base}/lookups")
    os.makedirs(f"{tmp_base}/ids")
    with open(f"{tmp_base}/ids/a.tsv", "w") as f:
        f.write("tweet_id\tuser_id\n2\tu\n")
    own = ["--namespace", ns, "--base", base]
    jobs.main(["stream", "--source", "files", "--path", f"{tmp_base}/live", "--available_now", *own])
    for query in spark.streams.active:
        query.awaitTermination()
    for _ in range(2):
        jobs.main(["ingest", "--source", "files", "--path", f"{tmp_base}/lookups", *own])
    jobs.main(["hydrate", "--path", f"{tmp_base}/ids", "--available_now", "--limit", "1", *own])
    jobs.main(["authors", "--k", "1", *own])
    sql = spark.newSession().sql
    assert {r.id for r in sql(f"SELECT id FROM {ns}.stream_blob_tweets WHERE bucket >= 0").collect()} == {"1", "2", "3"}
    assert [r.raw for r in sql(f"SELECT raw FROM {ns}.stream_blob_tweets WHERE bucket < 0").collect()] == ["junk"]
    assert sorted(r.id for r in sql(f"SELECT id FROM {ns}.batch_tweets").collect()) == ["1", "2", "9"]
    assert {r.hashtag: r["count"] for r in sql(f"SELECT * FROM {ns}.stream_hashtags").collect()} == {"#a": 2, "#b": 1, "#c": 1}
    assert {r.author_id: r["count"] for r in sql(f"SELECT author_id, count FROM {ns}.topK_authors").collect()} == {"ann": 2, "bob": 2}
    with pytest.raises(SystemExit):
        jobs.main(["ids", "--path", "x", "--namespace", ns])
    assert "ann" in capsys.readouterr().out
    sql(f"DROP DATABASE {ns} CASCADE")
