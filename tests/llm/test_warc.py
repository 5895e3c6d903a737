import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from postflow.llm.warc import page_records, read_pages, register

LONG = "<p>é" * 60_000


def rows():
    return [(5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, None, "same"), (1, "http://b/1", None),
            (2, "http://b/2", ""), (4, "http://c/4", LONG), (7, "http://c/7\nx", "own\r\n\r\nWARC/1.1"),
            (8, "http://d/8", "twice"), (8, "http://d/8", "twice"), (None, "http://e", "nokey"),
            (None, "http://e", "nokey"), (None, "http://f", "same")]


def pages(spark, data):
    return spark.createDataFrame([(*r, "x", 1) for r in data],
                                 "page_id long, url string, html string, payload string, size int")


def expected(data, least=0):
    out = []
    for key, _, text in data:
        payload = (text or "").encode()
        same = [k for k, _, t in data if (t or "").encode() == payload and k is not None]
        first = min(same, default=None) if len(payload) >= least else None
        again = first is not None and key != first
        out.append((repr(key), len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if again else "response", repr(first if again else None)))
    return sorted(out)


def write(spark, data, path, least=0, **options):
    register(spark)
    page_records(pages(spark, data), least_bytes=least).write.format("warc").options(**options).mode("append").save(path)


@pytest.mark.parametrize("options", [{}, {"file_bytes": "400"}, {"compression": "none"}])
@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, options, least):
    path = f"file://{tmp_path}/w"
    write(spark, rows(), path, least, **options)
    got = read_pages(spark, path).collect()
    assert sorted((repr(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, repr(r.refers_to))
                  for r in got) == expected(rows(), least)


def test_pushdown_and_skipped_payloads(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    write(spark, rows(), path)
    read = spark.read.format("warc")
    one = read.load(path).filter(F.col("record_type") == "revisit").select("record_id", "refers_to", "payload")
    assert "Filter" not in one._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")
    found = {(r.record_id, r.refers_to) for r in one.collect()}
    assert found == {("<urn:x-page:5>", "<urn:x-page:3>"), ("<urn:x-page:9>", "<urn:x-page:3>"),
                     ("<urn:x-page:none>", "<urn:x-page:3>"), ("<urn:x-page:2>", "<urn:x-page:1>")}
    several = read.load(path).filter(F.col("target_uri").isin("http://c/4", "http://b/1"))
    assert {bytes(r.payload) for r in several.collect()} == {LONG.encode(), b""}
    heads = read.option("payload", "false").load(path)
    assert heads.count() == len(rows()) and heads.filter("payload IS NOT NULL").count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_foreign_archive_without_offsets(spark, tmp_path, packed):
    def record(kind, uri, block, content):
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Type: {content}\r\n"
                f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    parts = [record("warcinfo", "", b"software: x\r\n", "application/warc-fields"),
             record("response", "http://a", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + b"z" * 500_000, "application/http"),
             record("resource", "http://b", b"plain \r\n\r\n text", "text/plain")]
    data = b"".join(gzip.compress(p) for p in parts) if packed else b"".join(parts)
    (tmp_path / ("x.warc.gz" if packed else "x.warc")).write_bytes(data)
    register(spark)
    df = spark.read.format("warc").load(f"file://{tmp_path}")
    got = {r.record_type: bytes(r.payload) for r in df.collect()}
    assert got == {"warcinfo": b"software: x\r\n", "response": b"z" * 500_000, "resource": b"plain \r\n\r\n text"}
    only = df.filter("record_type = 'resource'").collect()
    assert [bytes(r.payload) for r in only] == [b"plain \r\n\r\n text"] and only[0].record_id is None


@pytest.mark.parametrize("keep,fields", [(-3, "*"), (-3, "record_type"), (40, "*"), (200, "*")])
def test_a_record_that_is_cut_short_is_refused(spark, tmp_path, keep, fields):
    block = b"z" * 5000
    record = (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: http://a\r\nContent-Type: text/plain\r\n"
              f"Content-Length: {len(block)}\r\n\r\n").encode() + block
    (tmp_path / "x.warc").write_bytes(record[:keep])
    register(spark)
    with pytest.raises(Exception, match="cut short"):
        spark.read.format("warc").load(f"file://{tmp_path}").select(fields).collect()


def test_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    register(spark)
    page_records(pages(spark, rows()).filter("page_id = 0")).write.format("warc").mode("append").save(path)
    assert read_pages(spark, path).collect() == []
