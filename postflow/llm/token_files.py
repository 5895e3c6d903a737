"""Token ids in binary files, one zstandard frame per document with a shared dictionary (operator 6).

Writing: rows are dealt out by ranges of the key (adaptive execution may join neighbouring ranges)
and sorted within them; each task encodes its whole texts and streams one file:

    8 bytes  magic
    4 bytes  length of the header, then the header (JSON: version, id type, dictionary hash)
    frames   one per document: its ids, little-endian, compressed with the dictionary
    index    per document: key, 1 if the key is null, offset, compressed bytes, ids (5 x int64)
    16 bytes offset of the index, number of documents

The dictionary is trained once on the serialized ids of about ``sample_docs`` documents of at most
``sample_chars`` characters (chosen by their hashes) and stored beside the files;
its SHA-256 is in each header and checked on reading. A document can be read alone: one index entry
and one range of the file. Task attempts write under names of their own; only the names that
finished tasks return are in the file list, which also gives each file's first global position.

Encoding: the tokenizers library encodes each distinct pre-token of a block of texts once;
``tests/llm`` compares whole texts. Special tokens' strings in a text are ordinary text.

Edge cases: null and empty texts are documents of the end id only; null keys come first; rows with
equal keys are ordered by a hash of their text, and each is a document; an empty table gives no
documents; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import pretoken
from postflow.llm import textarrays as ta
from postflow.llm.files import attempt_name, located
from postflow.llm.tables import table, two_columns
from postflow.session import scratch

MAGIC = b"PFTOKID1"
END_ID = 1
CHUNK_BYTES = 2 << 20
KNOWN_WORDS = 500_000


class WordTokenizer:
    """Ids of whole texts by a tokenizers definition (JSON) whose pre-tokens are ``word_starts``' matches on
    normalised text (NFC, lower case, white space dropped). The ids of up to ``KNOWN_WORDS``
    pre-tokens are kept from block to block."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.inner = Tokenizer.from_str(definition)
        self.inner.encode_special_tokens = True
        self.inner.normalizer = None
        self.inner.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.classes = pretoken.Classes()
        self._forget()

    def _forget(self) -> None:
        """Known pre-tokens: sorted hashes, the number of each, and the ids of all numbers."""
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.values, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def normal(text: str) -> bytes:
        # Character by character: a capital sigma has one lower-case form wherever it stands.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower().encode()

    def encode_block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, end to end, and where each document begins (one entry more than documents)."""
        parts = [self.normal(t) if t else b"" for t in texts]
        off = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
        raw = np.frombuffer(b"".join(parts), np.uint8)
        codes, first, data, at, hashes = pretoken.distinct_tokens(
            raw, off, self.classes, pretoken.word_starts, drop_space=True)
        if len(self.hashes) > KNOWN_WORDS:
            self._forget()
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        old = self.hashes[place] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        number = np.empty(len(hashes), np.int64)
        number[old] = self.numbers[place[old]]
        new = np.flatnonzero(~old)
        number[new] = len(self.offsets) - 1 + np.arange(len(new))
        packed = data.tobytes()
        words = [packed[a:b].decode() for a, b in zip(at[new].tolist(), at[new + 1].tolist())]
        found = [e.ids for e in self.inner.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(sizes)))
        self.values = np.concatenate((self.values, np.fromiter(
            (i for f in found for i in f), np.int32, int(sizes.sum()))))
        self.hashes = np.concatenate((self.hashes, hashes[new]))
        self.numbers = np.concatenate((self.numbers, number[new]))
        order = np.argsort(self.hashes)
        self.hashes, self.numbers = self.hashes[order], self.numbers[order]
        flat, begin = pretoken.expand(self.values, self.offsets, number[codes] if len(codes) else codes)
        return flat, begin[first]


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary, or empty bytes where the samples are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_token_files(df: DataFrame, path: str, tokenizer: str, key: str = "doc_id",
                      text: str = "text", end_id: int = END_ID, sample_docs: int = 1000,
                      sample_chars: int = 20_000, dictionary_bytes: int = 32 << 10) -> DataFrame:
    """Write all rows under ``path``; returns the file list ``(file, start, n_docs, n_tokens)``,
    also kept as ``<path>/files``, in ascending key order."""
    spark = df.sparkSession
    docs = two_columns(df, key, text)
    # About sample_docs rows, chosen by their hashes where they are read.
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    bound = (1 << 30) * sample_docs // max(sample_docs, docs.count())
    sample = (docs.filter(part < bound).select(F.substring("text", 1, sample_chars).alias("text"))
              .limit(2 * sample_docs).collect())
    width = np.dtype("<u2")
    with open(tokenizer, encoding="utf-8") as inp:
        definition = inp.read()
    flat, first = WordTokenizer(definition).encode_block([r["text"] for r in sample])
    trained = train_dictionary([flat[a:b].astype(width).tobytes() for a, b in zip(first, first[1:])],
                               dictionary_bytes)
    header = json.dumps({"version": 1, "ids": width.str, "dictionary": hashlib.sha256(trained).hexdigest()})
    store, root = located(path)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/dictionary") as out:
        out.write(trained)
    shared = spark.sparkContext.broadcast((trained, definition))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        trained, definition = shared.value
        encoder = WordTokenizer(definition)
        packer = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(trained))
        store, root = located(path)
        name, out, index, at, total = "", None, [], 0, 0
        for batch in batches:
            for lo, hi, _, _ in ta.blocks(batch.column(1), CHUNK_BYTES):
                flat, first = encoder.encode_block(batch.column(1).slice(lo, hi - lo).to_pylist())
                if len(flat) and flat.max() > np.iinfo(width).max:
                    raise ValueError("an id does not fit the id type")
                keys = batch.column(0).slice(lo, hi - lo).to_pylist()
                frames = []
                for doc, a, b in zip(keys, first.tolist(), first[1:].tolist()):
                    frame = packer.compress(np.append(flat[a:b], end_id).astype(width).tobytes())
                    index.append((doc or 0, doc is None, at, len(frame), b - a + 1))
                    at += len(frame)
                    total += b - a + 1
                    frames.append(frame)
                if out is None:
                    name = attempt_name("tokens", partition, ".bin")
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    head = header.encode()
                    out.write(MAGIC + struct.pack("<I", len(head)) + head)
                out.write(b"".join(frames))
        if out is not None:
            place = len(MAGIC) + 4 + len(header.encode()) + at
            out.write(np.array(index, "<i8").tobytes() + struct.pack("<qq", place, len(index)))
            out.close()
            yield pa.record_batch([pa.array([partition], pa.int64()), pa.array([name]),
                                   pa.array([len(index)], pa.int64()), pa.array([total], pa.int64())],
                                  ["part", "file", "n_docs", "n_tokens"])

    tied = F.xxhash64("text")
    files = (docs.repartitionByRange("doc_id", tied).sortWithinPartitions("doc_id", tied)
             .mapInArrow(run, "part long, file string, n_docs long, n_tokens long"))
    rows, start = [], 0
    for r in sorted(files.collect()):  # one row per file
        rows.append((r["file"], start, r["n_docs"], r["n_tokens"]))
        start += r["n_tokens"]
    listed = spark.createDataFrame(rows, "file string, start long, n_docs long, n_tokens long")
    listed.repartition(max(1, len(rows))).write.mode("overwrite").parquet(f"{path}/files")
    return listed


class TokenFile:
    """One file: its index, and documents by position."""

    def __init__(self, path: str, name: str):
        self.store, root = located(path)
        with self.store.open_input_stream(f"{root}/dictionary", compression=None) as inp:
            trained = inp.read()
        self.file = self.store.open_input_file(f"{root}/{name}")
        place, docs = struct.unpack("<qq", self.file.read_at(16, self.file.size() - 16))
        start = self.file.read_at(len(MAGIC) + 4, 0)
        if start[:len(MAGIC)] != MAGIC:
            raise ValueError(f"{name} is not a token file")
        size = struct.unpack("<I", start[len(MAGIC):])[0]
        header = json.loads(self.file.read_at(size, len(MAGIC) + 4))
        if header["dictionary"] != hashlib.sha256(trained).hexdigest():
            raise ValueError(f"{name} was written with another dictionary")
        self.begin, self.type = len(MAGIC) + 4 + size, np.dtype(header["ids"])
        self.index = np.frombuffer(self.file.read_at(40 * docs, place), "<i8").reshape(docs, 5)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(trained))

    def document(self, position: int) -> np.ndarray:
        """The ids of one document: a single range read."""
        _, _, at, size, _ = self.index[position].tolist()
        return np.frombuffer(self.unpacker.decompress(self.file.read_at(size, self.begin + at)), self.type)

    def documents(self, block: int = 8 << 20) -> Iterator[tuple[int | None, np.ndarray]]:
        """``(key, ids)`` in order, read in ranges of about ``block`` bytes."""
        at = self.index[:, 2]
        first = 0
        while first < len(self.index):
            end = max(first + 1, int(np.searchsorted(at, at[first] + block)))
            stop = int(at[end - 1] + self.index[end - 1, 3])
            data = self.file.read_at(stop - int(at[first]), self.begin + int(at[first]))
            for doc, null, place, size, _ in self.index[first:end].tolist():
                place -= int(at[first])
                yield (None if null else doc), np.frombuffer(
                    self.unpacker.decompress(data[place:place + size]), self.type)
            first = end


def read_token_files(files: DataFrame, path: str, column: str, kind: pa.DataType, value) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``column``, which is ``value(ids)``, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for doc, ids in TokenFile(path, name).documents():
                    rows.append((doc, start, len(ids), value(ids)))
                    start += len(ids)
                    if len(rows) == 4096:
                        yield _batch(rows, column, kind)
                        rows = []
                if rows:
                    yield _batch(rows, column, kind)

    sql = {pa.int64(): "long", pa.list_(pa.int64()): "array<long>"}[kind]
    return files.select("file", "start").repartition("file").mapInArrow(
        run, f"doc_id long, start long, n_tokens long, {column} {sql}")


def _batch(rows: list[tuple], column: str, kind: pa.DataType) -> pa.RecordBatch:
    doc, start, size, values = zip(*rows)
    return pa.record_batch([pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
                            pa.array(size, pa.int64()), pa.array(values, kind)],
                           ["doc_id", "start", "n_tokens", column])


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def op6_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = scratch(spark, "tokens")
    files = write_token_files(table(spark, sf_dir, "documents"), path, tokenizer)
    return read_token_files(files, path, "ids_crc32", pa.int64(), _crc)
