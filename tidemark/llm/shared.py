"""Intermediate tables of the operators, in the shared folder of the session.

Tables live as long as the ``scratch`` scope that they are written in; what an
operator returns is written into the scope around it (or for good, where there is none).
"""

from __future__ import annotations

import ctypes
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path

_scopes: ContextVar[tuple[str, ...]] = ContextVar("scratch_scopes", default=())


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A folder for intermediate tables, deleted at the end of the block."""
    path = scratch_path(spark, f"llm-{name}")
    token = _scopes.set((*_scopes.get(), path))
    try:
        yield
    finally:
        _scopes.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _held(spark: SparkSession, key: str, value: str):
    """A session setting, for the length of the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def brief_shuffles(spark: SparkSession):
    """In the block a query's shuffle files go when the query ends. Otherwise they stay until the driver's JVM happens to
    collect its garbage: a loop of queries holds the files of all its rounds."""
    return _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession, rows: int = 1024):
    """In the block a Python worker gets at most ``rows`` rows at a time: a batch of whole texts or sets is held by the
    JVM, by the worker, and once more where it is cast."""
    return _held(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stash(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a table under ``spark.checkpoint.dir`` and read it back.

    It cuts the lineage: a lost executor costs the running tasks only, since
    the files are on shared storage. With ``keep`` it outlives the current scope.
    """
    spark = df.sparkSession
    scopes = _scopes.get()[: -1 if keep else None]
    path = scratch_path(spark, f"llm-{name}")
    if scopes:
        path = f"{scopes[-1]}/{path.rpartition('/')[2]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back():
    """The memory that a Python worker freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def lean(work):
    """``work`` for mapInArrow, which gives the memory that it freed back to the system at its end: Python workers
    outlive a task, so what they hold is added to the next stage's."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def sf_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc32_sql(text: str) -> str:
    """DuckDB expression: crc32 of a text's UTF-8 bytes, half a byte at a time."""
    steps = []
    for x in range(16):
        for _ in range(4):
            x = (x >> 1) ^ 0xEDB88320 if x & 1 else x >> 1
        steps.append(x)
    digits = f"hex(encode({text}))"
    # the low half of a byte comes first
    halves = f"list_transform(range(length({digits})), lambda i: strpos('123456789ABCDEF', substr({digits}, (i + 2 - 2 * (i % 2))::INT, 1)))"
    table = f"{steps}::BIGINT[]"
    return f"xor(list_reduce({halves}, lambda c, x: xor(({table})[(xor(c, x) & 15) + 1], c >> 4), 4294967295::BIGINT), 4294967295::BIGINT)"
