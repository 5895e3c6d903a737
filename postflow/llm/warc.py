"""WARC archives as a Spark data source (operator 3).

``spark.read.format("warc").load(path)`` plans partitions of whole files (small files together, up
to ``partition_bytes``). Equality and IN filters on header columns are pushed down: a reader parses
a record's header block first and goes on to the next record where the header is not wanted, or
where the payload is not asked for (``option("payload", "false")``), without decoding the payload.
With the offset file that the writer leaves beside each archive that is a jump to the next record;
without it, compressed payloads are inflated in pieces and thrown away.

``df.write.format("warc")`` streams each task's rows into archives of at most about ``file_bytes``,
a gzip member per record. Attempts write under names of their own; committing writes the list of
files of the attempts that succeeded, and readers of a folder with such lists open only those.

Columns, read and written: see ``SCHEMA``. ``payload`` is the HTTP entity of response records, and
the block of records of other content types; revisit records have none.

Edge cases: null payloads are written as empty; records without a field give null; empty folders
give no rows; extra columns of a written table are an error (select the schema's columns first).
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe,
                                    EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage)

from postflow.llm.files import attempt_name, located
from postflow.llm.tables import staged, table
from postflow.session import scratch

SCHEMA = ("record_id string, record_type string, target_uri string, date string, content_type string, "
          "payload_digest string, refers_to string, payload_length long, payload binary")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_ARROW = pa.schema([(n, pa.int64() if n == "payload_length" else pa.binary() if n == "payload"
                     else pa.string()) for n in NAMES])

#: Fixed values of the WARC 1.1 format; the last field is this writer's extension.
FIELDS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
          "date": "WARC-Date", "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest",
          "refers_to": "WARC-Refers-To", "payload_length": "X-Payload-Length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RESPONSE = "application/http; msgtype=response"


def _header(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "replace").split("\r\n")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        if line[:1] not in (" ", "\t") and name:
            out[name.strip().lower()] = value.strip()
    return out


def record_bytes(row: dict) -> bytes:
    """One record, uncompressed."""
    payload = row["payload"] or b""
    block = payload
    if (row["content_type"] or "").startswith("application/http"):
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " \
               f"{row['payload_length'] or 0}\r\n\r\n".encode()
        block = head if row["record_type"] == "revisit" else head + payload
    lines = ["WARC/1.1"]
    for name in NAMES[:-1]:
        if row[name] is not None:
            lines.append(f"{FIELDS[name]}: " + " ".join(str(row[name]).split()))
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Stream:
    """Bytes of one archive from a position on, inflated as needed."""

    def __init__(self, file, start: int, packed: bool):
        self.file, self.at, self.packed = file, start, packed
        self.member, self.rest, self.data = None, b"", bytearray()

    def more(self) -> bool:
        raw = self.rest
        if not raw:
            raw = self.file.read_at(1 << 16, self.at) if self.at < self.file.size() else b""
            self.at += len(raw)
        self.rest = b""
        if not raw:
            return False
        if not self.packed:
            self.data += raw
            return True
        if self.member is None:
            self.member = zlib.decompressobj(31)
        self.data += self.member.decompress(raw, 1 << 18)
        self.rest = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
        if self.member.eof:
            self.member = None
        return True

    def take(self, n: int) -> bytes:
        while len(self.data) < n and self.more():
            pass
        if len(self.data) < n:
            raise ValueError(f"archive cut short: {n - len(self.data)} bytes of a record are missing")
        out = bytes(self.data[:n])
        del self.data[:n]
        return out

    def skip(self, n: int) -> None:
        while n > 0:
            part = min(n, len(self.data))
            del self.data[:part]
            n -= part
            if n and not self.more():
                raise ValueError(f"archive cut short: {n} bytes of a record are missing")

    def head(self) -> bytes | None:
        """The next record's header block, or None at the end."""
        while True:
            while self.data[:2] == b"\r\n":
                del self.data[:2]
            end = self.data.find(b"\r\n\r\n")
            if end >= 0:
                out = bytes(self.data[:end])
                del self.data[:end + 4]
                return out
            if not self.more():
                if self.data.strip(b"\r\n\0 "):
                    raise ValueError("archive cut short: the header of a record has no end")
                return None


def records(file, packed: bool, offsets: np.ndarray | None, wanted, payload: bool) -> Iterator[tuple]:
    """Rows of one archive whose header columns pass ``wanted``."""
    stream = _Stream(file, 0, packed)
    number = 0
    while True:
        if offsets is not None:
            if number == len(offsets):
                return
            stream = _Stream(file, int(offsets[number]), packed)
            number += 1
        head = stream.head()
        if head is None:
            return
        fields = _header(head)
        size = int(fields.get("content-length", "0"))
        row = {n: fields.get(FIELDS[n].lower()) for n in NAMES[:-1]}
        if row["payload_length"] is not None:
            row["payload_length"] = int(row["payload_length"])
        data = None
        if wanted(row):
            if payload and row["record_type"] != "revisit":
                data = stream.take(size)
                if (row["content_type"] or "").startswith("application/http"):
                    data = data.partition(b"\r\n\r\n")[2]
            elif offsets is None:
                stream.skip(size)
            yield (*row.values(), data)
        elif offsets is None:
            stream.skip(size)


@dataclass
class Files(InputPartition):
    names: tuple


@dataclass
class Written(WriterCommitMessage):
    names: tuple


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partition_bytes", 32 << 20))
        self.conditions: list[tuple[str, frozenset | None]] = []  # None: any value

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in NAMES[:-1] and isinstance(f, (EqualTo, EqualNullSafe)):
                self.conditions.append((name, frozenset([f.value])))
            elif name in NAMES[:-1] and isinstance(f, In):
                self.conditions.append((name, frozenset(f.value)))
            elif name in NAMES[:-1] and isinstance(f, IsNotNull):
                self.conditions.append((name, None))
            else:
                yield f

    def partitions(self):
        store, root = located(self.path)
        found = {i.path: i.size for i in store.get_file_info(fs.FileSelector(root)) if i.is_file}
        lists = [p for p in found if p.rsplit("/", 1)[1].startswith("_committed-")]
        if lists:
            names = []
            for p in lists:
                with store.open_input_stream(p, compression=None) as inp:
                    names += [f"{root}/{n}" for n in json.loads(inp.read())]
        else:
            names = [p for p in found if p.endswith((".warc", ".warc.gz"))]
        out, group, total = [], [], 0
        for p in sorted(names):
            if group and total + found[p] > self.partition_bytes:
                out.append(Files(tuple(group)))
                group, total = [], 0
            group.append(p)
            total += found[p]
        return out + [Files(tuple(group))]

    def read(self, partition):
        store, _ = located(self.path)

        def wanted(row: dict) -> bool:
            return all(row[name] is not None if values is None else row[name] in values
                       for name, values in self.conditions)

        for name in partition.names:
            offsets = None
            if store.get_file_info(f"{name}.idx").is_file:
                with store.open_input_stream(f"{name}.idx", compression=None) as inp:
                    offsets = np.frombuffer(inp.read(), "<i8")
            rows, held = [], 0
            for row in records(store.open_input_file(name), name.endswith(".gz"), offsets, wanted, self.payload):
                rows.append(row)
                held += len(row[-1] or b"")
                if len(rows) == 2000 or held > 8 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.file_bytes = int(options.get("file_bytes", 256 << 20))
        self.packed = options.get("compression", "gzip") == "gzip"

    def write(self, iterator):
        store, root = located(self.path)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        names, out, offsets, at = [], None, [], 0

        def close() -> None:
            out.close()
            with store.open_output_stream(f"{root}/{names[-1]}.idx", compression=None) as index:
                index.write(np.array(offsets, "<i8").tobytes())

        for batch in iterator:
            for lo in range(0, batch.num_rows, 256):
                for row in batch.slice(lo, 256).to_pylist():
                    data = record_bytes(row)
                    if self.packed:
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        data = packer.compress(data) + packer.flush()
                    if out is not None and at + len(data) > self.file_bytes:
                        close()
                        out = None
                    if out is None:
                        names.append(attempt_name("pages", partition, ".warc.gz" if self.packed else ".warc"))
                        out = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                        offsets, at = [], 0
                    offsets.append(at)
                    out.write(data)
                    at += len(data)
        if out is not None:
            close()
        return Written(tuple(names))

    def commit(self, messages):
        store, root = located(self.path)
        store.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        with store.open_output_stream(f"{root}/_committed-{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps(names).encode())


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only added to: use mode append")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
                 least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A record per page. Of pages with equal payloads of at least ``least_bytes`` bytes, that with
    the smallest key is the response and pages with other keys revisit it; repeated rows of that
    key, and pages of a group that has no key at all, are responses too."""
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("uri"),
                        F.coalesce(F.col(f"`{page}`").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")) \
        .withColumn("sha1", F.sha1("payload"))
    # Copies only: written first, so that its size is known when the join is planned.
    groups = (rows.filter(F.col("size") >= least_bytes).groupBy("sha1", "size")
              .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    groups = staged(groups, "warc-copies")

    def digest(column: pa.Array) -> pa.Array:
        return pa.array(["sha1:" + base64.b32encode(bytes.fromhex(h)).decode() for h in column.to_pylist()])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            columns = [batch.column(i) for i in range(batch.num_columns)]
            at = names.index("payload_digest")
            columns[at] = digest(columns[at])
            yield pa.record_batch(columns, names)

    def record(column: str):
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(column).cast("string"), F.lit("none")), F.lit(">"))

    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    out = rows.join(groups, ["sha1", "size"], "left").select(
        record("id").alias("record_id"), kind.alias("record_type"), F.col("uri").alias("target_uri"),
        F.lit(date).alias("date"), F.lit(HTTP_RESPONSE).alias("content_type"),
        F.col("sha1").alias("payload_digest"), F.when(again, record("first")).alias("refers_to"),
        F.col("size").alias("payload_length"),
        F.when(again, F.lit(None).cast("binary")).otherwise(F.col("payload")).alias("payload"))
    return out.mapInArrow(finish, SCHEMA)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Digest columns of the archives under ``path``: of responses from the payload itself, of
    revisits (which have no payload) from the header."""
    register(spark)
    rows = spark.read.format("warc").load(path)

    def page(column: str):
        return F.regexp_extract(column, r"^<urn:x-page:(-?\d+)>$", 1)

    def number(column: str):
        return F.when(page(column) != "", page(column).cast("long"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = batch.column(3).to_pylist(), [d[5:] for d in batch.column(4).to_pylist()]
            for i, payload in enumerate(batch.column(5)):
                if payload.is_valid:
                    data = payload.as_buffer()
                    own = base64.b32encode(hashlib.sha1(data).digest()).decode()
                    if own != digests[i] or data.size != sizes[i]:
                        raise ValueError(f"record {batch.column(0)[i]} is damaged")
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                                   batch.column(1), batch.column(2)],
                                  ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return rows.select(number("record_id").alias("page_id"), "record_type", number("refers_to").alias("refers_to"),
                       "payload_length", "payload_digest", "payload").mapInArrow(
        check, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    register(spark)
    page_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    return read_pages(spark, path)



#: Base 32 of a SHA-1: 32 digits of 5 bits, each from the hexadecimal digits around it.
OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT *, array_to_string([lpad(bin(instr('0123456789abcdef', x[i]) - 1), 4, '0')
                                 FOR i IN range(1, 41)], '') AS bits FROM d)
SELECT page_id, n AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(
           [CAST(bits[5 * i + j] AS INT) * (16 >> (j - 1)) FOR j IN range(1, 6)]) AS INT), 1)
           FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b
"""
