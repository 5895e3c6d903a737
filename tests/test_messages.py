"""Decoding and encoding (PRJ-1 … PRJ-6, FLT-3)."""

import json

from pyspark.sql import Row

from postflow.functions import messages as msg


def _values(spark, values):
    return spark.createDataFrame([Row(value=None if v is None else v.encode()) for v in values],
                                 "value binary")


def test_object_decode_keeps_bad_rows_as_nulls(spark):
    good = json.dumps({"data": {"id": "7", "author_id": "a", "created_at": "t", "text": "x",
                                "lang": "en"}, "matching_rules": [{"id": "1", "tag": "t"}]})
    df = msg.decode_object_posts(_values(spark, [good, "plain text", "", None, '{"errors":[]}']))
    rows = df.collect()
    assert df.columns == ["id", "author_id", "created_at", "text"]
    assert rows[0] == Row(id="7", author_id="a", created_at="t", text="x")
    assert all(r == Row(id=None, author_id=None, created_at=None, text=None) for r in rows[1:])


def test_numeric_id_becomes_text(spark):
    df = msg.decode_object_posts(_values(spark, ['{"data":{"id":123,"text":"x"}}']))
    assert df.first().id == "123"


def test_list_decode_takes_first_element(spark):
    two = json.dumps({"data": [{"id": "1", "author_id": "a", "created_at": "t", "text": "x"},
                               {"id": "-1", "author_id": "b", "created_at": "u", "text": "y"}]})
    df = msg.decode_list_posts(_values(spark, [two, '{"data":[]}', "{}", "nope",
                                               '{"data":{"id":"1"}}', None]))
    rows = df.collect()
    assert df.columns == ["id", "author_id", "text", "created_at"]
    assert rows[0] == Row(id="1", author_id="a", text="x", created_at="t")
    assert [r.id for r in rows[1:]] == [None] * 5


def test_roundtrip_and_empty_messages(spark):
    posts = spark.createDataFrame(
        [Row(id="1", author_id=None, created_at="t", text="a\nb"),
         Row(id="2", author_id="u", created_at=None, text='q"uote')],
        "id string, author_id string, created_at string, text string")
    encoded = msg.encode_messages(posts, key="id")
    assert encoded.schema.simpleString() == "struct<key:binary,value:binary>"
    empty = spark.createDataFrame([Row(key=None, value=b""), Row(key=None, value=None)],
                                  "key binary, value binary")
    back = msg.decode_flat_posts(msg.non_empty(encoded.unionByName(empty)))
    assert sorted(back.collect()) == sorted(posts.collect())


def test_raw_message_and_lookup_message(spark):
    df = spark.createDataFrame([Row(tweet_id="9", user_id="u")], "tweet_id string, user_id string")
    raw = msg.encode_messages(msg.ids(df), cols=["tweet_id"], as_json=False).first()
    assert raw.key is None and bytes(raw.value) == b"9"
    posts = spark.createDataFrame([Row(id="1", author_id="a", created_at="t", text="x")],
                                  "id string, author_id string, created_at string, text string")
    looked_up = msg.decode_list_posts(msg.encode_lookup_messages(posts)).first()
    assert looked_up == Row(id="1", author_id="a", text="x", created_at="t")
