"""Maintained overview (A2, Q1): per sensor and day the first and latest window and the number of keys.

Each batch adds one row per (day, sensor) that it has new keys for: keys that no earlier batch
stored. The overview is then the min, max and sum over these rows, and no query has to read the table.
Corrections of stored keys add nothing.

Layout as for the table: rows by ``date`` and ``batch_id``, finished days folded into one row per
sensor under a mark (``upto``). ``summarize_batch`` runs *before* its batch is stored, so a batch that was stored has its
summaries. A replayed batch is compared with the batches before it only and
replaces its own rows by the same ones; a day that already has the batch folded in is left alone.
Batches have to come in order, as a stream's do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.store import _by_value, _Layout, _on, closed_path, dated

SUMMARY = ["date", "sensor_id", "first_ts", "latest_ts", "reading_count"]
KEY = ["sensor_id", "timestamp"]


def _layout(spark: SparkSession, path: str, policy: str = "last") -> _Layout | None:
    try:
        return _Layout(spark, path, policy)
    except FileNotFoundError:
        return None  # nothing stored yet


def _rows(layout: _Layout | None, days: set[str] | None, columns: list[str]) -> DataFrame | None:
    """Closed and newer rows of the days (None: all)."""
    if layout is None:
        return None
    days = set(layout.marks) | set(layout.batches) if days is None else days
    parts = [p.select(*columns) for p in (layout.closed_rows(days), layout.update_rows(days)) if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def summarize_batch(rows: DataFrame, batch_id: int, table_path: str, path: str, policy: str = "last") -> None:
    """Write the summaries of one batch of table rows that is about to be stored under ``table_path``.

    Only stored rows of the batch's own days and time span are read, two columns of them: files of older
    batches of a day fall outside the span and are skipped.
    """
    spark = rows.sparkSession
    keys = dated(rows.select(*KEY)).distinct()
    table, summaries = _layout(spark, table_path, policy), _layout(spark, path)
    folded = {d for lay in (table, summaries) if lay for d, mark in lay.marks.items() if mark >= batch_id}
    keys = keys.where(~_on(folded)) if folded else keys
    if table is not None:
        span = keys.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.min("date").alias("d0"), F.max("date").alias("d1")).first()
        if span["lo"] is None:
            return
        days = {d for d in set(table.marks) | set(table.batches) if str(span["d0"]) <= d <= str(span["d1"])}
        stored = _rows(table, days, [*KEY, "batch_id"])
        if stored is not None:
            earlier = stored.where((F.col("batch_id") < batch_id) & F.col("timestamp").between(span["lo"], span["hi"]))
            keys = keys.join(earlier.select(*KEY), KEY, "left_anti")
    new = keys.groupBy("date", "sensor_id").agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("latest_ts"), F.count(F.lit(1)).alias("reading_count")
    )
    _write(new.withColumn("batch_id", F.lit(batch_id).cast("long")), path, "batch_id")


def _write(rows: DataFrame, path: str, second: str) -> None:
    (
        rows.repartitionByRange("date", "sensor_id").sortWithinPartitions("date", "sensor_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", second).parquet(path)
    )


def _merged(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.min("first_ts").alias("first_ts"), F.max("latest_ts").alias("latest_ts"), F.sum("reading_count").alias("reading_count")
    )


def compact_summaries(spark: SparkSession, path: str, before: str) -> list[str]:
    """Fold the days before ``before`` into one row per sensor; returns the days that had something new."""
    layout = _layout(spark, path)
    days = {d for d in layout.batches if d < before} if layout else set()
    if days:
        upto = F.lit(None).cast("long")
        for mark, marked in _by_value({d: max(layout.batches[d]) for d in days}).items():
            upto = F.when(_on(marked), F.lit(mark)).otherwise(upto)
        _write(_merged(_rows(layout, days, SUMMARY), ["date", "sensor_id"]).withColumn("upto", upto), closed_path(path), "upto")
    return sorted(days)


def maintained_overview(spark: SparkSession, path: str) -> DataFrame:
    """A2 from the summaries: the columns of ``sensor_overview`` over the table."""
    rows = _rows(_layout(spark, path), None, SUMMARY)
    if rows is None:
        raise FileNotFoundError(path)
    return _merged(rows, ["sensor_id"])
