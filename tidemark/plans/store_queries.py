"""Registered queries over the stored table's life: batches, compaction, purge, arrival.

The updates are the 1-day means of each of ``BATCHES`` interleaved parts of the
accepted readings, so most keys are written several times and every
batch corrects days that earlier ones closed. Each batch is stored with its own
arrival time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import queries
from tidemark.operators.table import TABLE_COLUMNS, conform_table, split_dead_letters
from tidemark.operators.windows import window_mean
from tidemark.plans import derived as P
from tidemark.session import scratch_path
from tidemark.sources.store import compact_table, purge_in_place, read_table, vacuum_table, write_table

BATCHES = 4
CLOSE_FIRST, CLOSE_NEXT = "2024-01-12", "2024-01-20"  # days before these are closed
READ_COLUMNS = ["sensor_id", "timestamp", "temperature", "humidity", "created_at"]


def arrival_time(batch: int) -> str:
    return str(dt.datetime.fromisoformat(P.TABLE_AS_OF) + dt.timedelta(minutes=batch))


def update_batch(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Table rows of one batch: means of every ``BATCHES``-th accepted reading."""
    part = P.accepted(spark, sf_dir).where(F.col("event_id") % BATCHES == batch)
    rows, _ = split_dead_letters(conform_table(window_mean(part, "1 day"), arrival_time(batch)))
    return rows.select(*TABLE_COLUMNS, F.lit(batch).cast("long").alias("batch_id"))


_READ_ONLY: dict[tuple, str] = {}


def shared_store(spark: SparkSession, sf_dir: str, policy: str = "last") -> str:
    """One :func:`compacted_store` per application, for queries that only read it."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), policy)
    if key not in _READ_ONLY:
        _READ_ONLY[key] = compacted_store(spark, sf_dir, policy)
    return _READ_ONLY[key]


def compacted_store(spark: SparkSession, sf_dir: str, policy: str = "last") -> str:
    """A table that is closed between its batches; returns its path.

    Two batches, the first days closed; a third batch with corrections and new keys of those
    days, and a replay of the second; more days closed (only what is new is folded
    in), superseded days removed; a fourth batch on top."""
    path = scratch_path(spark, "compacted")
    batches = [update_batch(spark, sf_dir, b) for b in range(BATCHES)]
    for batch in batches[:2]:
        write_table(batch, path)
    compact_table(spark, path, CLOSE_FIRST, policy)
    for batch in (batches[2], batches[1]):
        write_table(batch, path)
    compact_table(spark, path, CLOSE_NEXT, policy)
    vacuum_table(spark, path, policy, folded=True)
    write_table(batches[3], path)
    return path


def compacted_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, shared_store(spark, sf_dir), policy="last").select(*READ_COLUMNS)


def compacted_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, as a plain insert into a keyed table keeps it."""
    return read_table(spark, shared_store(spark, sf_dir, "first"), policy="first").select(*READ_COLUMNS)


def purged_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P28 on the stored table, closed days and open batches alike."""
    path = compacted_store(spark, sf_dir)
    purge_in_place(spark, path, P.PURGED)
    return read_table(spark, path, policy="last").select(*READ_COLUMNS)


def recent_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 over several arrival times: the rows stored last, whatever their own time."""
    stored = read_table(spark, shared_store(spark, sf_dir), policy="last")
    return queries.recent(stored, 25).select(*READ_COLUMNS)


STORE_QUERIES = {
    "compacted_readback": compacted_readback,
    "compacted_first": compacted_first,
    "purged_store": purged_store,
    "recent_arrivals": recent_arrivals,
}
