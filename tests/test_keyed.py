"""Keyed tables (SNK-3, SNK-4, SNK-7, SRC-6): upsert, replay, NULL keys, snapshots, compaction."""

import pytest
from pyspark.sql import Row

from postflow import fs
from postflow.sinks import keyed as kt
from postflow.sinks.outputs import write

COLS = "id string, author_id string, created_at string, text string"


def _posts(spark, rows):
    return spark.createDataFrame([Row(id=a, author_id=b, created_at=c, text=d)
                                  for a, b, c, d in rows], COLS)


def _read(spark, table, base):
    return sorted(tuple(r) for r in kt.read_table(spark, table, base).collect())


def test_upsert_last_batch_wins(spark, tmp_base):
    t = kt.STREAM_POSTS
    kt.write_keyed(_posts(spark, [("1", "a", "t1", "x"), ("2", "b", "t1", "y")]), t, tmp_base, 0)
    kt.write_keyed(_posts(spark, [("1", "a", "t0", "edited")]), t, tmp_base, 1)
    assert _read(spark, t, tmp_base) == [("1", "a", "t0", "edited"), ("2", "b", "t1", "y")]


def test_same_key_twice_in_one_batch_is_settled_by_order(spark, tmp_base):
    t = kt.STREAM_POSTS
    kt.write_keyed(_posts(spark, [("1", "a", "t1", "x"), ("1", "a", "t2", "w"),
                                  ("1", "a", None, "z")]), t, tmp_base, 0)
    assert _read(spark, t, tmp_base) == [("1", "a", "t2", "w")]


def test_the_last_position_of_a_batch_wins(spark, tmp_base):
    t = kt.STREAM_POSTS
    rows = spark.createDataFrame([("1", "a", "t9", "first", 10), ("1", "a", "t0", "last", 12), ("1", "a", "t5", "mid", 11)],
                                 f"{COLS}, {kt.ORDER} long")
    kt.write_keyed(rows, t, tmp_base, 0)
    assert _read(spark, t, tmp_base) == [("1", "a", "t0", "last")]


def test_replayed_batch_replaces_itself_only(spark, tmp_base):
    t = kt.STREAM_POSTS
    kt.write_keyed(_posts(spark, [("1", "a", "t", "old")]), t, tmp_base, 0)
    kt.write_keyed(_posts(spark, [("2", "a", "t", "b1")]), t, tmp_base, 1)
    kt.write_keyed(_posts(spark, [("2", "a", "t", "b1")]), t, tmp_base, 1)
    kt.write_keyed(_posts(spark, [("1", "a", "t", "new")]), t, tmp_base, 0)
    assert _read(spark, t, tmp_base) == [("1", "a", "t", "new"), ("2", "a", "t", "b1")]


def test_null_keys_are_rejected_not_lost(spark, tmp_base):
    t = kt.STREAM_POSTS
    kt.write_keyed(_posts(spark, [(None, "a", "t", "bad"), ("1", "a", "t", "ok")]), t,
                   tmp_base, 3)
    assert _read(spark, t, tmp_base) == [("1", "a", "t", "ok")]
    rejected = kt.read_rejected(spark, t, tmp_base).collect()
    assert [(r.text, r.writer, r.batch_id) for r in rejected] == [("bad", kt.BATCH, 3)]


def test_columns_go_by_name(spark, tmp_base):
    batch = spark.createDataFrame([Row(id="1", author_id="a", text="x", created_at="t")],
                                  "id string, author_id string, text string, created_at string")
    kt.write_keyed(batch, kt.STREAM_POSTS, tmp_base, 0)
    got = kt.read_table(spark, kt.STREAM_POSTS, tmp_base)
    assert got.columns == ["id", "author_id", "created_at", "text"]
    assert tuple(got.first()) == ("1", "a", "t", "x")


def test_empty_table_reads_empty(spark, tmp_base):
    assert kt.read_table(spark, kt.BATCH_POSTS, tmp_base).count() == 0
    assert kt.read_table(spark, kt.HASHTAG_COUNTS, tmp_base).count() == 0


def test_replace_table_switches_snapshots(spark, tmp_base, monkeypatch):
    t = kt.HASHTAG_COUNTS
    first = spark.createDataFrame([("#a", 1), ("#b", 2)], "hashtag string, count bigint")
    second = spark.createDataFrame([("#a", 5)], "hashtag string, count bigint")
    kt.replace_keyed(first, t, tmp_base, 0)
    assert _read(spark, t, tmp_base) == [("#a", 1), ("#b", 2)]
    kt.replace_keyed(second, t, tmp_base, 1)
    kt.replace_keyed(second, t, tmp_base, 2)
    assert _read(spark, t, tmp_base) == [("#a", 5)]
    # a replayed, already committed version changes nothing
    kt.replace_keyed(first, t, tmp_base, 2)
    assert _read(spark, t, tmp_base) == [("#a", 5)]
    # without a number the next one is taken; a replaced version stays readable for its time
    assert kt.replace_keyed(first, t, tmp_base) == 3
    root = t.path(tmp_base)
    assert sorted(fs.list_names(spark, f"{root}/_commits")) == ["0", "1", "2", "3"]
    monkeypatch.setattr(kt, "RETAIN_SECONDS", -10)
    assert kt.replace_keyed(second, t, tmp_base) == 4
    assert fs.list_names(spark, f"{root}/_commits") == ["4"]
    folders = [n for n in fs.list_names(spark, root) if n.startswith("v")]
    assert [f.split("-")[0] for f in folders] == ["v4"]
    assert _read(spark, t, tmp_base) == [("#a", 5)]


def test_replace_table_rejects_null_keys(spark, tmp_base):
    t = kt.HASHTAG_COUNTS
    df = spark.createDataFrame([("#a", 1), (None, 2)], "hashtag string, count bigint")
    kt.replace_keyed(df, t, tmp_base, 0)
    assert _read(spark, t, tmp_base) == [("#a", 1)]
    assert [tuple(r) for r in kt.read_rejected(spark, t, tmp_base).collect()] == [(None, 2)]


def test_every_run_adds_to_the_table(spark, tmp_base):
    t = kt.BATCH_POSTS
    for text in ("v1", "v2", "v3"):
        write(_posts(spark, [("1", "a", "t", text), ("2", "b", "t", text)]), "keyed",
              table=t, base=tmp_base)
    write(_posts(spark, [(None, "a", "t", "bad")]), "keyed", table=t, base=tmp_base)
    assert _read(spark, t, tmp_base) == [("1", "a", "v3", "t"), ("2", "b", "v3", "t")]
    assert kt.read_rejected(spark, t, tmp_base).count() == 1


def test_writers_never_touch_each_other(spark, tmp_base):
    t = kt.STREAM_POSTS
    kt.write_keyed(_posts(spark, [("1", "a", "t", "A0"), ("2", "a", "t", "A0")]), t, tmp_base, 0, "A")
    kt.write_keyed(_posts(spark, [("2", "b", "t", "B0"), ("3", "b", "t", "B0")]), t, tmp_base, 0, "B")
    kt.write_keyed(_posts(spark, [("1", "a", "t", "A0"), ("2", "a", "t", "A0 replayed")]), t, tmp_base, 0, "A")
    expected = [("1", "a", "t", "A0"), ("2", "b", "t", "B0"), ("3", "b", "t", "B0")]
    assert _read(spark, t, tmp_base) == expected  # the replay kept its place before B
    kt.write_keyed(_posts(spark, [("3", "a", "t", "A1")]), t, tmp_base, 1, "A")
    assert _read(spark, t, tmp_base) == expected[:2] + [("3", "a", "t", "A1")]
    with pytest.raises(ValueError, match="writer"):
        kt.write_keyed(_posts(spark, []), t, tmp_base, 0, "a/b")


def test_read_by_keys_filters_before_the_aggregate(spark, tmp_base, capsys):
    t = kt.STREAM_POSTS
    for batch in range(3):
        kt.write_keyed(_posts(spark, [(str(i), "a", "t", f"{i}-{batch}") for i in range(20)]), t, tmp_base, batch)
    keys = spark.createDataFrame([("3",), ("7",), ("none",)], "id string")
    df = kt.read_table(spark, t, tmp_base, keys=keys)
    assert sorted(tuple(r) for r in df.collect()) == [("3", "a", "t", "3-2"), ("7", "a", "t", "7-2")]
    df.explain()
    plan = capsys.readouterr().out
    assert "LeftSemi" in plan and plan.index("partial_max") < plan.index("LeftSemi")  # the join is below


def test_declaration_is_kept_and_checked(spark, tmp_base):
    kt.write_keyed(_posts(spark, [("1", "a", "t", "x")]), kt.STREAM_POSTS, tmp_base, 0)
    other = spark.newSession()
    found = kt.declaration(other, "stream_blob_tweets", tmp_base)
    assert found == {"columns": {c: "string" for c in ("id", "author_id", "created_at", "text")},
                     "keys": ["id"], "mode": "upsert"}
    wrong = kt.KeyedTable("stream_blob_tweets", kt.AUTHOR_COUNTS.schema, ("author_id",))
    with pytest.raises(ValueError, match="declared"):
        kt.write_keyed(other.createDataFrame([("a", 1)], kt.AUTHOR_COUNTS.schema), wrong, tmp_base, 1)
    with pytest.raises(ValueError, match="declared"):
        kt.read_table(other, wrong, tmp_base)
    assert kt.declaration(other, "nothing", tmp_base) is None


def test_register_views(spark, tmp_base):
    kt.write_keyed(_posts(spark, [("1", "a", "t", "x"), ("1", "a", "t", "y")]), kt.STREAM_POSTS,
                   tmp_base, 0)
    kt.replace_keyed(spark.createDataFrame([("#a", 3)], "hashtag string, count bigint"),
                     kt.HASHTAG_COUNTS, tmp_base, 0)
    names = kt.register_views(spark, tmp_base)
    assert "stream_blob_tweets" in names and "topK_authors" in names
    assert spark.sql("SELECT text FROM stream_blob_tweets").collect()[0].text == "y"
    assert spark.sql("SELECT count FROM stream_hashtags WHERE hashtag = '#a'").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM batch_tweets").first()[0] == 0


def test_equal_ingests_store_one_copy(spark, tmp_base):
    t = kt.BATCH_POSTS
    rows = [("1", "a", "t", "x"), ("2", None, "t", "y"), (None, "z", "t", "bad"), (None, None, None, None)]
    for _ in range(3):
        write(_posts(spark, rows), "keyed", table=t, base=tmp_base, only_changes=True)
    stored = spark.read.parquet(t.path(tmp_base))
    assert stored.count() == 4 and kt.read_rejected(spark, t, tmp_base).count() == 2
    write(_posts(spark, [("1", "a", "t", "new"), ("1", "a", "t", "anew"), ("2", None, "t", "y")]), "keyed",
          table=t, base=tmp_base, only_changes=True)
    assert _read(spark, t, tmp_base) == [("1", "a", "new", "t"), ("2", None, "y", "t")]
    assert spark.read.parquet(t.path(tmp_base)).count() == 5


def test_a_write_looks_into_its_own_batch_only(spark, tmp_base, monkeypatch):
    looked = []
    listing = fs.list_names
    monkeypatch.setattr(fs, "list_names", lambda spark, path: looked.append(path) or listing(spark, path))
    monkeypatch.setattr(fs, "glob_paths", lambda *_: pytest.fail("listed"))
    for batch in range(3):
        kt.write_keyed(_posts(spark, [("1", "a", "t", f"v{batch}")]), kt.STREAM_POSTS, tmp_base, batch, "A")
    assert [p.rsplit("/", 2)[1:] for p in looked] == [["writer=A", f"batch_id={b}"] for b in range(3)]
    assert _read(spark, kt.STREAM_POSTS, tmp_base) == [("1", "a", "t", "v2")]
