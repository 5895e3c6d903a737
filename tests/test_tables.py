"""Catalog tables (SNK-3, SNK-4, SNK-7, SRC-6): pruned and exchange-free reads, replays, changes only."""

import re

import pytest
from pyspark.sql import functions as F

from postflow import fs
from postflow.operators.enrich import hydrate
from postflow.operators.posts import all_posts, author_counts
from postflow.plans import fixtures as fx
from postflow.plans import table_jobs as tj
from postflow.session import scratch_namespace
from postflow.sinks import tables as tb

COLS = "id string, author_id string, created_at string, text string"


@pytest.fixture()
def ns(spark):
    return scratch_namespace(spark, "tables")


def _posts(spark, rows, extra=""):
    return spark.createDataFrame(rows, COLS + extra)


def _read(spark, ns, table=tb.STREAM_POSTS, **how):
    return sorted(tuple(r) for r in tb.current(spark, ns, table, **how).collect())


def _plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _scans(df):
    """Files and bytes each scan of the executed plan has read."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan).collectLeaves()
    found = []
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numFiles"):
            found.append(metrics.apply("numFiles").value())
    return found


def test_last_write_wins_and_a_replay_keeps_its_place(spark, ns):
    t = tb.STREAM_POSTS
    a = tb.upsert(_posts(spark, [("1", "a", "t", "A"), ("2", "a", "t", "A")]), ns, t, "A")
    b = tb.upsert(_posts(spark, [("2", "b", "t", "B"), ("3", "b", "t", "B")]), ns, t, "B")
    assert b > a
    tb.upsert(_posts(spark, [("1", "a", "t", "A"), ("2", "a", "t", "A")]), ns, t, "A", a)
    want = [("1", "a", "t", "A"), ("2", "b", "t", "B"), ("3", "b", "t", "B")]
    assert _read(spark, ns) == want
    assert spark.table(f"{ns}.{t.name}").count() == 4
    assert _read(spark, ns, seen={"A": a}) == [("1", "a", "t", "A"), ("2", "a", "t", "A")]
    tb.upsert(_posts(spark, [("3", None, None, None)]), ns, t, "A")
    assert _read(spark, ns) == want[:2] + [("3", None, None, None)]


def test_one_row_per_key_and_batch_and_all_rejected_rows(spark, ns):
    rows = [("1", "a", "t9", "first", 10), ("1", "a", "t0", "last", 12), ("1", "a", "t5", "mid", 11)]
    bad = [(None, "x", None, None, 1)] * 3
    tb.upsert(_posts(spark, rows + bad, f", {tb.ORDER} long").withColumn("raw", F.when(F.col("id").isNull(), "junk")),
              ns, tb.STREAM_POSTS, "w")
    assert _read(spark, ns) == [("1", "a", "t0", "last")]
    assert [(r.raw, r.author_id) for r in tb.rejected(spark, ns, tb.STREAM_POSTS).collect()] == [("junk", "x")] * 3


def test_only_changes_are_stored(spark, ns):
    rows = [("1", "a", "t", "x"), ("2", None, "t", "y"), ("3", "c", None, None), (None, "z", "t", "bad")]
    posts = _posts(spark, rows).withColumn("raw", F.when(F.col("id").isNull(), "bad"))
    for _ in range(3):
        tb.upsert(posts, ns, tb.STREAM_POSTS, "w", only_changes=True)
    assert spark.table(f"{ns}.stream_blob_tweets").count() == 4
    tb.upsert(_posts(spark, [("1", "a", "t", "new"), *rows[1:3]]), ns, tb.STREAM_POSTS, "w", only_changes=True)
    assert spark.table(f"{ns}.stream_blob_tweets").count() == 5
    assert _read(spark, ns)[0] == ("1", "a", "t", "new")


def test_declared_once_and_read_by_name_in_another_session(spark, ns):
    tb.upsert(_posts(spark, [("1", "a", "t", "x")]), ns, tb.STREAM_POSTS, "w")
    other = spark.newSession()
    assert [r.text for r in other.sql(f"SELECT text FROM {ns}.stream_blob_tweets").collect()] == ["x"]
    wrong = tb.PostTable("stream_blob_tweets", tb.AUTHOR_COUNTS.schema, "author_id")
    for use in (lambda: tb.current(other, ns, wrong), lambda: tb.upsert(other.createDataFrame([("a", 1)], wrong.schema), ns, wrong, "w")):
        with pytest.raises(ValueError, match="declared"):
            use()
    with pytest.raises(ValueError, match="letters"):
        tb.create_namespace(spark, "a b", "/tmp")
    with pytest.raises(ValueError, match="writer"):
        tb.upsert(_posts(spark, []), ns, tb.STREAM_POSTS, "a/b")


def test_a_new_catalog_finds_the_partitions_again(spark, ns):
    tb.upsert(_posts(spark, [("1", "a", "t", "x")]), ns, tb.STREAM_POSTS, "w")
    tb.merge_buckets(spark.createDataFrame([("#a", 1)], tb.HASHTAG_COUNTS.schema), ns, tb.HASHTAG_COUNTS)
    for table in (tb.STREAM_POSTS, tb.HASHTAG_COUNTS):  # as in a session whose catalog knows nothing of them
        spark.sql(f"DROP TABLE {ns}.{table.name}")
    assert _read(spark, ns) == [("1", "a", "t", "x")]
    assert spark.table(tb.create_merged(spark, ns, tb.HASHTAG_COUNTS)).count() == 1


def test_few_ids_read_few_files(spark, ns):
    for batch in range(3):
        tb.upsert(_posts(spark, [(str(i), "a", "t", f"{i}-{batch}") for i in range(300)]), ns, tb.STREAM_POSTS, "w")
    ids = spark.createDataFrame([("3", "u"), ("3", "u"), ("none", "u")], "tweet_id string, user_id string")
    found = hydrate(ids, lambda keys: tb.current(spark, ns, tb.STREAM_POSTS, keys=keys), copies=False)
    plan = _plan(found)
    assert re.search(r"PartitionFilters: .*dynamicpruning", plan)
    assert [tuple(r) for r in found.collect()] == [("3", "a", "t", "3-2")]
    whole = tb.current(spark, ns, tb.STREAM_POSTS)
    whole.collect()
    assert 0 < sum(_scans(found)) <= 2 * 3 < sum(_scans(whole)) == 3 * tb.STREAM_POSTS.buckets


def test_fold_union_and_distinct_need_no_exchange(spark, ns, sf_dir):
    tb.upsert(fx.stream_posts(spark, sf_dir), ns, tb.STREAM_POSTS, "w")
    tb.upsert(fx.batch_posts(spark, sf_dir), ns, tb.BATCH_POSTS, "w")
    posts = all_posts(tb.current(spark, ns, tb.STREAM_POSTS), tb.current(spark, ns, tb.BATCH_POSTS))
    for df, exchanges in ((tb.current(spark, ns, tb.STREAM_POSTS), 0), (posts, 0), (author_counts(posts), 1)):
        tree = _plan(df).split("\n\n")[0]
        assert len(re.findall(r"\bExchange\b", tree)) == exchanges, tree


def test_compaction_changes_no_row(spark, ns):
    t = tb.STREAM_POSTS
    for batch in range(4):
        tb.upsert(_posts(spark, [(str(i), "a", "t", f"{i}-{batch}") for i in range(batch, 40)] + [(None, "x", "t", "bad")]), ns, t, f"w{batch % 2}")
    before = _read(spark, ns)
    tb.compact(spark, ns, t)
    assert _read(spark, ns) == before and spark.table(f"{ns}.{t.name}").where("bucket >= 0").count() == 40
    assert tb.rejected(spark, ns, t).count() == 4
    tb.upsert(_posts(spark, [("5", "z", "t", "after")]), ns, t, "w0")
    assert ("5", "z", "t", "after") in _read(spark, ns)


def test_merging_rewrites_the_changed_buckets_only(spark, ns):
    t = tb.HASHTAG_COUNTS
    counts = spark.createDataFrame([(f"#{i}", i) for i in range(100)], t.schema)
    tb.merge_buckets(counts, ns, t)
    root = f"{spark.catalog.getDatabase(ns).locationUri}/{t.name}"
    before = {b: sorted(fs.list_names(spark, f"{root}/{b}")) for b in fs.list_names(spark, root) if b.startswith("bucket=")}
    assert len(before) == t.buckets
    for _ in range(2):
        tb.merge_buckets(spark.createDataFrame([("#7", 700), ("#7x", 1), (None, 5)], t.schema), ns, t)
    after = {b: sorted(fs.list_names(spark, f"{root}/{b}")) for b in before}
    assert 1 <= sum(before[b] != after[b] for b in before) <= 2
    want = {f"#{i}": i for i in range(100)} | {"#7": 700, "#7x": 1}
    assert {r.hashtag: r["count"] for r in spark.table(f"{ns}.{t.name}").collect()} == want


def _recount(spark, ns):
    posts = all_posts(tb.current(spark, ns, tb.STREAM_POSTS), tb.current(spark, ns, tb.BATCH_POSTS))
    return sorted(tuple(r) for r in author_counts(posts).where("author_id IS NOT NULL").collect())


def test_author_counts_follow_the_changes(spark, ns, monkeypatch):
    def run():
        return sorted(tuple(r) for r in tj.authors(spark, ns).collect())

    assert run() == []
    tb.upsert(_posts(spark, [(str(i), f"a{i % 5}", "t", "x") for i in range(50)] + [("n", None, "t", "x")]), ns, tb.STREAM_POSTS, "s")
    assert run() == _recount(spark, ns)
    tb.upsert(_posts(spark, [("1", "a9", "t", "x"), ("2", "a2", "t", "edited"), ("n", "a0", "t", "x")]), ns, tb.STREAM_POSTS, "s")
    tb.upsert(_posts(spark, [("3", "a3", "t", "x"), ("4", "a4", "t", "other"), ("60", "b", "t", "x")]), ns, tb.BATCH_POSTS, "b")
    assert run() == _recount(spark, ns)
    assert run() == _recount(spark, ns)  # nothing new
    # A run that fails after its counts were written is done again from the counts before it.
    tb.upsert(_posts(spark, [(str(i), "c", "t", "x") for i in range(10)]), ns, tb.STREAM_POSTS, "s2")
    upsert = tb.upsert

    def fails(df, namespace, table, *rest, **how):
        if table is tj.PROGRESS:
            raise RuntimeError("lost")
        return upsert(df, namespace, table, *rest, **how)

    monkeypatch.setattr(tb, "upsert", fails)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.undo()
    assert run() == _recount(spark, ns)
    tb.upsert(_posts(spark, [("0", "a1", "t", "x")]), ns, tb.STREAM_POSTS, "s2")
    tb.compact(spark, ns, tb.STREAM_POSTS)
    assert run() == _recount(spark, ns)


def test_unchanged_posts_are_not_read(spark, ns):
    first = tb.upsert(_posts(spark, [(str(i), "a", "t", "x") for i in range(200)]), ns, tb.STREAM_POSTS, "s")
    second = tb.upsert(_posts(spark, [("7", "b", "t", "x")]), ns, tb.STREAM_POSTS, "s")
    tb.create_table(spark, ns, tb.BATCH_POSTS)
    name = tb.STREAM_POSTS.name
    ids = tj.changed_ids(spark, ns, {name: {"s": first}}, {name: {"s": second}, tb.BATCH_POSTS.name: {}})
    assert [r.id for r in ids.collect()] == ["7"] and sum(_scans(ids)) == 1
    assert re.search(r"PartitionFilters: \[[^\n]*seq#", _plan(ids))
    deltas = tj.author_deltas(spark, ns, {name: {"s": first}}, {name: {"s": second}, tb.BATCH_POSTS.name: {}})
    assert "dynamicpruning" in _plan(deltas)
    assert {(r.author_id, r.change) for r in deltas.collect()} == {("a", -1), ("b", 1)}
    assert sum(_scans(deltas)) <= 8 < 200


def test_author_changes_need_no_exchange_of_posts(spark, ns, sf_dir):
    seen = {tb.STREAM_POSTS.name: {"w": tb.upsert(fx.stream_posts(spark, sf_dir), ns, tb.STREAM_POSTS, "w")}, tb.BATCH_POSTS.name: {}}
    marks = {**seen, tb.BATCH_POSTS.name: {"w": tb.upsert(fx.batch_posts(spark, sf_dir), ns, tb.BATCH_POSTS, "w")}}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many new ids
    try:
        tree = _plan(tj.author_deltas(spark, ns, seen, marks)).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Partial sums per author, and bucket numbers for each of the two tables.
    assert len(re.findall(r"\bExchange\b", tree)) == 3, tree
    assert len(re.findall(r"\bSortMergeJoin\b", tree)) == 2, tree


def test_a_run_counts_authors_once(spark, ns, monkeypatch):
    upsert, leaves = tb.upsert, []

    def noted(df, namespace, table, *rest, **how):
        if table is tb.AUTHOR_COUNTS:
            found = df._jdf.queryExecution().optimizedPlan().collectLeaves()
            found = [found.apply(i) for i in range(found.size())]
            leaves.append([x.toString() for x in found if x.nodeName() != "InMemoryRelation"])
        return upsert(df, namespace, table, *rest, **how)

    monkeypatch.setattr(tb, "upsert", noted)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    for author in ("a", "b"):
        upsert(_posts(spark, [("1", author, "t", "x"), ("2", "c", "t", author)]), ns, tb.STREAM_POSTS, "s")
        tj.authors(spark, ns)
    assert len(leaves) == 2 and not [x for run in leaves for x in run if tb.STREAM_POSTS.name in x]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    assert {r.author_id: r["count"] for r in tj.authors(spark, ns).collect()} == {"b": 1, "c": 1}


def test_writes_do_not_list_batches(spark, ns, monkeypatch):
    monkeypatch.setattr(fs, "list_names", lambda *_: pytest.fail("listed"))
    monkeypatch.setattr(fs, "glob_paths", lambda *_: pytest.fail("listed"))
    for i in range(3):
        tb.upsert(_posts(spark, [(str(i), "a", "t", "x")]), ns, tb.STREAM_POSTS, "w")
    assert len(_read(spark, ns)) == 3
