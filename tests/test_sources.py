"""Sources (SRC-1 … SRC-5, SRC-7) and output selection errors (SNK-8)."""

import json
import os

import pytest

from postflow.sources.messages import (infer_json_schema, kafka_options, kafka_sink_options,
                                       read_id_files, read_messages)
from postflow.sinks.outputs import write, write_stream


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_id_files_header_blank_short_and_long_rows(spark, tmp_base):
    folder = os.path.join(tmp_base, "ids")
    os.makedirs(folder)
    _write(os.path.join(folder, "a.tsv"), "tweet_id\tuser_id\n1\tu1\n\n2\n")
    _write(os.path.join(folder, "b.tsv"), "tweet_id\tuser_id\n3\tu3\textra\n")
    rows = sorted(read_id_files(spark, folder, streaming=False).collect())
    assert [tuple(r) for r in rows] == [("1", "u1"), ("2", None), ("3", "u3")]


def test_id_files_as_a_stream(spark, tmp_base):
    folder = os.path.join(tmp_base, "ids")
    os.makedirs(folder)
    _write(os.path.join(folder, "a.tsv"), "tweet_id\tuser_id\n1\tu1\n")
    df = read_id_files(spark, folder)
    assert df.isStreaming and df.columns == ["tweet_id", "user_id"]


def test_kafka_options_map_like_the_reference():
    assert kafka_options("covid19") == {"kafka.bootstrap.servers": "localhost:9092",
                                        "subscribe": "covid19"}
    opts = kafka_options("t", "h:1", startingOffsets="earliest")
    assert opts["startingOffsets"] == "earliest" and opts["subscribe"] == "t"
    assert kafka_sink_options("h:1") == {"kafka.bootstrap.servers": "h:1"}


def test_kafka_without_the_connector_fails_clearly(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_messages(spark, "kafka", streaming=False).schema


def test_socket_source_shape_without_connecting(spark):
    df = read_messages(spark, "socket", host="localhost", port=9)
    assert df.isStreaming and df.columns == ["value"]
    with pytest.raises(ValueError):
        read_messages(spark, "socket", streaming=False)


def test_files_source_and_unknown_kinds(spark, tmp_base):
    df = read_messages(spark, "files", path=tmp_base)
    assert df.isStreaming and df.columns == ["key", "value"]
    with pytest.raises(ValueError):
        read_messages(spark, "pigeon")
    with pytest.raises(ValueError):
        write(spark.range(1), "pigeon")
    with pytest.raises(ValueError):
        write_stream(df, "keyed", checkpoint=None)


def test_schema_by_sample(spark, tmp_base):
    path = os.path.join(tmp_base, "sample.json")
    _write(path, json.dumps({"data": [{"id": "1", "text": "x", "author_id": "a",
                                       "created_at": "t"}]}) + "\n")
    schema = infer_json_schema(spark, path)
    assert schema.simpleString() == \
        "struct<data:array<struct<author_id:string,created_at:string,id:string,text:string>>>"
