"""User queries over the analytics table.

Functions build plans and never collect. Filters are on the bare long
``timestamp`` and ``sensor_id`` columns so they reach the scan (parquet
row-group skipping / JDBC WHERE). Limits compile to TakeOrderedAndProject
(a per-partition top-n, then a merge), never a full sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.numeric import mean_of_decimal
from tidemark.functions.time import epoch_ms, ms_to_ts, to_utc_datetime

Bound = dt.datetime | str | None


def effective_limit(n: int | None, default: int, maximum: int) -> int:
    """L3: a limit outside 1..maximum falls back to the default."""
    if n is None or n < 1 or n > maximum:
        return default
    return n


def period(start: Bound, end: Bound, as_of: Bound = None) -> tuple[dt.datetime, dt.datetime]:
    """P26 defaults: end = as_of (or now), start = end - 7 days."""
    end_dt = to_utc_datetime(end) if end is not None else to_utc_datetime(as_of or dt.datetime.now(dt.timezone.utc))
    start_dt = to_utc_datetime(start) if start is not None else end_dt - dt.timedelta(days=S.DEFAULT_PERIOD_DAYS)
    return start_dt, end_dt


def for_sensor(df: DataFrame, sensor_id: str) -> DataFrame:
    """P25."""
    return df.where(F.col("sensor_id") == F.lit(sensor_id))


def in_period(df: DataFrame, start: Bound, end: Bound, as_of: Bound = None) -> DataFrame:
    """Inclusive range on epoch ms, bounds truncated to ms."""
    lo, hi = period(start, end, as_of)
    return df.where(F.col("timestamp").between(epoch_ms(lo), epoch_ms(hi)))


def _ts_lit(value: dt.datetime) -> Column:
    return F.lit(value.astimezone(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")


def sensor_overview(table: DataFrame) -> DataFrame:
    """A2: per sensor first/latest window start (ms) and row count."""
    return table.groupBy("sensor_id").agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("latest_ts"),
        F.count(F.lit(1)).alias("reading_count"),
    )


def list_sensors(table: DataFrame, limit: int | None = S.OVERVIEW_LIMIT_DEFAULT) -> DataFrame:
    """Q1: sensors by latest reading, newest first (sensor id breaks ties)."""
    return newest_sensors(sensor_overview(table), limit)


def newest_sensors(overview: DataFrame, limit: int | None = S.OVERVIEW_LIMIT_DEFAULT) -> DataFrame:
    """Q1 over an overview, computed or maintained."""
    n = effective_limit(limit, S.OVERVIEW_LIMIT_DEFAULT, S.OVERVIEW_LIMIT_MAX)
    top = overview.orderBy(F.desc("latest_ts"), F.asc("sensor_id")).limit(n)
    return top.select(
        "sensor_id",
        ms_to_ts("first_ts").alias("first_reading"),
        ms_to_ts("latest_ts").alias("latest_reading"),
        "reading_count",
    )


def sensor_series(table: DataFrame, start: Bound = None, end: Bound = None, as_of: Bound = None) -> DataFrame:
    """Q2 without the sensor filter and limit: every row in the period."""
    rows = in_period(table, start, end, as_of)
    return rows.select(
        "sensor_id",
        ms_to_ts("timestamp").alias("timestamp"),
        F.col("temperature").cast("double").alias("temperature"),
        F.col("humidity").cast("double").alias("humidity"),
    )


def sensor_data(
    table: DataFrame,
    sensor_id: str,
    start: Bound = None,
    end: Bound = None,
    limit: int | None = S.SERIES_LIMIT_DEFAULT,
    as_of: Bound = None,
) -> DataFrame:
    """Q2: one sensor's rows in the period, newest first; unknown -> empty."""
    n = effective_limit(limit, S.SERIES_LIMIT_DEFAULT, S.SERIES_LIMIT_MAX)
    rows = in_period(for_sensor(table, sensor_id), start, end, as_of)
    top = rows.orderBy(F.desc("timestamp")).limit(n)
    return top.select(
        "sensor_id",
        ms_to_ts("timestamp").alias("timestamp"),
        F.col("temperature").cast("double").alias("temperature"),
        F.col("humidity").cast("double").alias("humidity"),
    )


def all_sensor_stats(table: DataFrame, start: Bound = None, end: Bound = None, as_of: Bound = None) -> DataFrame:
    """min/max/avg of both measures and count, every sensor, one pass.

    Averages are over stored window means (X9); null maps to 0.0 (X10).
    Sensors without rows in the period are absent (the service's 404).
    """
    lo, hi = period(start, end, as_of)
    rows = in_period(table, lo, hi)
    aggs = []
    for m in ("temperature", "humidity"):
        aggs += [
            F.min(m).cast("double").alias(f"{m}_min"),
            F.max(m).cast("double").alias(f"{m}_max"),
            mean_of_decimal(m).alias(f"{m}_avg"),
        ]
    stats = rows.groupBy("sensor_id").agg(*aggs, F.count(F.lit(1)).alias("reading_count"))
    value_cols = [f"{m}_{s}" for m in ("temperature", "humidity") for s in ("min", "max", "avg")]
    return stats.select(
        "sensor_id",
        _ts_lit(lo).alias("period_start"),
        _ts_lit(hi).alias("period_end"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in value_cols],
        "reading_count",
    )


def sensor_stats(table: DataFrame, sensor_id: str, start: Bound = None, end: Bound = None, as_of: Bound = None) -> DataFrame:
    """Q3: the one-sensor slice of Q3b; the filter is pushed below the aggregate."""
    return for_sensor(all_sensor_stats(table, start, end, as_of), sensor_id)


def recent(table: DataFrame, n: int = 5) -> DataFrame:
    """Most recently stored rows (arrival, then newest window, then id)."""
    return table.orderBy(F.desc("created_at"), F.desc("timestamp"), F.asc("sensor_id")).limit(n)


def count_readings(table: DataFrame, sensor_id: str | None = None) -> DataFrame:
    """A4: one-row count, for a sensor or the whole table."""
    rows = for_sensor(table, sensor_id) if sensor_id is not None else table
    return rows.agg(F.count(F.lit(1)).alias("reading_count"))
