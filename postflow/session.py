"""Session helpers: a tuned local session for tests and tools, and the shared work folder.

Library code never picks a master; only ``local_session`` (tests, bench, CLI defaults) does.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from postflow import fs

# Settings every job of this package wants, whatever the cluster size.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Keyed tables replace one batch directory at a time (SNK-3).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming aggregation state (STM-2) grows with the number of hashtags; keep it off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit a micro-batch by writing its changes, not by uploading a state snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: int | None = None, app: str = "postflow",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A ``local[cores]`` session with the UI off, for tests, the bench and the CLI."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("POSTFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.default.parallelism", str(cores))
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not _shared_folder(spark):  # one machine: any folder of it is shared by all tasks
        spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), "postflow"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def work_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors, as ``spark.checkpoint.dir`` names it."""
    base = _shared_folder(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return base.rstrip("/")


_made: list[str] = []
_declared: list[str] = []  # statements that take out of the catalog what was declared for one run


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the work folder for one run of one job."""
    path = f"{work_dir(spark)}/postflow/{label}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def scratch_namespace(spark: SparkSession, label: str) -> str:
    """A fresh database over a scratch folder, for one run of one job."""
    from postflow.sinks.tables import create_namespace

    path = scratch(spark, label)
    name = "postflow_" + path.rsplit("/", 1)[1].replace("-", "_")
    create_namespace(spark, name, path)
    _declared.append(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return name


def scratch_table(name: str) -> None:
    """Note a table that was declared over a scratch folder, to be taken out of the catalog with it."""
    _declared.append(f"DROP TABLE IF EXISTS {name}")


def drop_scratch(spark: SparkSession) -> None:
    """Delete the folders, databases and tables that were given out in this process, once their results
    have been used (results are read from them lazily)."""
    while _declared:
        spark.sql(_declared.pop())
    while _made:
        fs.delete(spark, _made.pop())
