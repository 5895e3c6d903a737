"""Sources: message streams (Kafka, socket, files), id files, schema by sample
(SRC-1 … SRC-5, SRC-7).

``read_messages`` always returns Kafka-shaped rows with a ``value`` column (BINARY for Kafka and
files, STRING for the socket), so the decoders do not care where messages come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from postflow import schemas

SOURCE_KINDS = ("kafka", "socket", "files")


def intake_options(kind: str = "files", limit: int | None = None, clean: str | None = None,
                   archive: str | None = None) -> dict[str, str]:
    """STM-7: how much a micro-batch takes, and what becomes of files that were read.

    ``limit``: files (``maxFilesPerTrigger``) or Kafka offsets (``maxOffsetsPerTrigger``) per micro-batch,
    also of an ``availableNow`` run; None takes all there is. ``clean`` is ``off``, ``delete`` or
    ``archive`` (into the folder ``archive``), for file sources.
    """
    if limit is not None and limit < 1:
        raise ValueError(f"a micro-batch takes 1 or more, not {limit}")
    if clean not in (None, "off", "delete", "archive") or (clean == "archive") != (archive is not None):
        raise ValueError(f"cleaning of files: off, delete, or archive with a folder, not {clean!r}, {archive!r}")
    if kind not in ("files", "kafka") or (kind == "kafka" and clean):
        raise ValueError(f"the {kind} source has no such option")
    name = "maxOffsetsPerTrigger" if kind == "kafka" else "maxFilesPerTrigger"
    options = {name: str(limit)} if limit is not None else {}
    if clean:
        options["cleanSource"] = clean
    if archive:
        options["sourceArchiveDir"] = archive
    return options


def kafka_options(topic: str, servers: str = "localhost:9092", streaming: bool = True,
                  **extra) -> dict[str, str]:
    """Options for Spark's Kafka source. No offsets are set, as in the reference: a stream starts
    at ``latest``; a batch read takes the whole topic (``earliest`` → ``latest``)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_sink_options(servers: str = "localhost:9092", **extra) -> dict[str, str]:
    """Options for Spark's Kafka sink (the topic is passed separately)."""
    opts = {"kafka.bootstrap.servers": servers}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_messages(spark: SparkSession, kind: str = "socket", streaming: bool = True, *,
                  topic: str = "covid19", servers: str = "localhost:9092",
                  host: str = "localhost", port: int = 9009,
                  path: str | None = None, file_format: str = "parquet",
                  options: dict | None = None, limit: int | None = None,
                  clean: str | None = None, archive: str | None = None) -> DataFrame:
    """SRC-2/3/4/7: messages from ``kind`` = ``kafka`` | ``socket`` | ``files``. ``limit``, ``clean`` and
    ``archive`` bound what a micro-batch takes (``intake_options``); a batch read takes all.

    * ``kafka``: Spark's Kafka source (needs the spark-sql-kafka package on the classpath).
    * ``socket``: text lines from ``host:port`` (streaming only; for tests and demos).
    * ``files``: a directory of Parquet/JSON files with ``key``/``value`` columns, or with
      ``file_format="text"`` of text files holding one message per line; new files are picked
      up once each. Use a directory (``pathGlobFilter`` to select files), not a file.
    """
    options = dict(options or {})
    if streaming and (limit is not None or clean):
        options |= intake_options(kind, limit, clean, archive)
    if kind == "kafka":
        reader = spark.readStream if streaming else spark.read
        return (reader.format("kafka")
                .options(**kafka_options(topic, servers, streaming, **options)).load())
    if kind == "socket":
        if not streaming:
            raise ValueError("the socket source is streaming only")
        return (spark.readStream.format("socket")
                .option("host", host).option("port", int(port)).options(**options).load())
    if kind == "files":
        if path is None:
            raise ValueError("kind='files' needs path=")
        reader = spark.readStream if streaming else spark.read
        if file_format == "text":
            # one message per line (JSON-lines files): ``value string``, as the socket gives
            return reader.format("text").options(**options).load(path)
        return reader.format(file_format).schema(schemas.MESSAGE).options(**options).load(path)
    raise ValueError(f"unknown source {kind!r}; expected one of {SOURCE_KINDS}")


def read_id_files(spark: SparkSession, path: str, streaming: bool = True,
                  options: dict | None = None, limit: int | None = None,
                  clean: str | None = None, archive: str | None = None) -> DataFrame:
    """SRC-1: tab-separated id files with a header row → ``tweet_id, user_id`` (strings). ``limit``,
    ``clean`` and ``archive`` bound what a micro-batch takes (``intake_options``).

    Each new file in the directory is read once. Short rows are NULL-padded, extra fields
    dropped, blank lines skipped (Spark's CSV reader with a fixed schema).
    """
    reader = spark.readStream if streaming else spark.read
    options = dict(options or {})
    if streaming and (limit is not None or clean):
        options |= intake_options("files", limit, clean, archive)
    return (reader.option("sep", "\t").option("header", True).options(**options)
            .schema(schemas.IDS).csv(path))


def infer_json_schema(spark: SparkSession, path: str) -> StructType:
    """SRC-5: the schema Spark infers from a sample JSON file (one Spark job on the sample).

    Prefer the narrow schemas of ``postflow.schemas`` for parsing: this one parses every field.
    """
    return spark.read.json(path).schema
