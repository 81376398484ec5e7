"""Session settings the library relies on.

All times are UTC (naive ISO strings are read as UTC). AQE stays on: the
library leaves broadcast decisions to AQE's runtime size check instead of
hard-coding ``broadcast()`` on sides whose size grows with the data.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    rocksdb_state: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local or cluster session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Readings carry UTC times; the session must interpret them so."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    This is ``spark.checkpoint.dir``: a shared file system that survives
    executor loss. Without it a local session (tests) gets a temporary folder;
    any other session is refused, since each machine would see its own files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(local)
    # setCheckpointDir may add a sub-folder; return what Spark will use.
    return (sc.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint root for one job's files."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
