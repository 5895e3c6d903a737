"""A few file-system calls through the Hadoop ``FileSystem`` of the session.

Paths may be local, HDFS or object-store URIs: whatever the cluster's Hadoop configuration
resolves. Used for the keyed-table snapshot pointer (SNK-4) and checkpoint reset (STM-5).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` recursively; ``False`` if it was not there."""
    fs, p = _resolve(spark, path)
    return bool(fs.delete(p, True))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty if absent)."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return []
    return [status.getPath().getName() for status in fs.listStatus(p)]


def qualify(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, made absolute."""
    fs, p = _resolve(spark, path)
    return str(fs.makeQualified(p).toString())


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a glob pattern (empty if none)."""
    fs, p = _resolve(spark, pattern)
    found = fs.globStatus(p)
    return [status.getPath().toString() for status in found] if found is not None else []


def modified(spark: SparkSession, path: str) -> float:
    """Time of the last change of ``path``, in seconds since the epoch."""
    fs, p = _resolve(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file; ``False`` if it is already there. Files are never overwritten:
    the text is written to a file of its own name and then renamed, so that a reader sees the
    whole text or no file."""
    fs, p = _resolve(spark, path)
    if fs.exists(p):
        return False
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file, or ``None`` if it does not exist."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()
