"""Tumbling event-time window means.

One function for batch and streaming: on a streaming DataFrame with a
watermark the same aggregate becomes the stateful incremental mean.
The shuffle is on (window, sensor): partial sums are formed per input
partition first, so a hot sensor costs one small partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import exact_mean, mean_of_parts, mean_parts, merged_parts
from tidemark.functions.time import duration_seconds, window_start_ms
from tidemark.schemas import WATERMARK_DELAY, WINDOW_DURATION

MEASURES = ("temperature", "humidity")


def _event_time(df: DataFrame, ts: str):
    """The event-time column as a UTC timestamp (timestamp_ntz is read as UTC)."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.col(ts).cast(T.TimestampType())
    return F.col(ts)


def with_watermark(df: DataFrame, delay: str = WATERMARK_DELAY, ts: str = "timestamp") -> DataFrame:
    """Event-time watermark (T1); a no-op on batch DataFrames."""
    return df.withWatermark(ts, delay)


def window_mean(
    df: DataFrame,
    duration: str = WINDOW_DURATION,
    ts: str = "timestamp",
    key: str = "sensor_id",
    measures: tuple[str, ...] = MEASURES,
    with_count: bool = False,
) -> DataFrame:
    """Mean of each measure per key and tumbling window (epoch-aligned).

    Output: key, ``timestamp`` (window start, epoch ms), measures, and
    ``readings`` (rows in the window) when ``with_count``. Rows with a null
    time belong to no window and drop out, as in Spark's ``window``.
    """
    aggs = [exact_mean(m).alias(m) for m in measures]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("readings"))
    grouped = df.groupBy(F.window(_event_time(df, ts), duration).alias("window"), F.col(key))
    out = grouped.agg(*aggs)
    cols = [F.col(key), window_start_ms("window").alias("timestamp"), *[F.col(m) for m in measures]]
    if with_count:
        cols.append(F.col("readings"))
    return out.select(*cols)


# --- means that can be merged (X9) -------------------------------------------------
# A mean of window means weighs a window with one reading like one with a thousand. The
# parts keep the exact sum and the count, so longer windows and statistics weigh by readings.


def window_parts(df: DataFrame, duration: str = WINDOW_DURATION, ts: str = "timestamp") -> DataFrame:
    """Per sensor and window: number of readings, and per measure the parts of its mean, its least and greatest value.

    A row per window, to be kept next to the table: everything longer comes from it."""
    aggs = [F.count(F.lit(1)).alias("readings")]
    for m in MEASURES:
        aggs += [mean_parts(m).alias(f"{m}_parts"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    grouped = df.groupBy(F.window(_event_time(df, ts), duration).alias("window"), "sensor_id").agg(*aggs)
    return grouped.withColumn("timestamp", window_start_ms("window")).drop("window")


def _merge(grouped) -> DataFrame:
    aggs = [F.sum("readings").alias("readings")]
    for m in MEASURES:
        aggs += [merged_parts(f"{m}_parts").alias(f"{m}_parts"), F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    return grouped.agg(*aggs)


def longer_parts(parts: DataFrame, duration: str) -> DataFrame:
    """Parts of longer windows from those of shorter ones; ``duration`` is a multiple of the short width.

    Parts of one window from several batches are merged in the same way."""
    width = duration_seconds(duration) * 1000
    start = F.col("timestamp") - F.pmod("timestamp", F.lit(width))
    return _merge(parts.withColumn("timestamp", start).groupBy("sensor_id", "timestamp"))


def means_of_parts(parts: DataFrame) -> DataFrame:
    """Window means (the columns of :func:`window_mean` with ``readings``) of stored parts."""
    return parts.select("sensor_id", "timestamp", *[mean_of_parts(f"{m}_parts").alias(m) for m in MEASURES], "readings")


def weighted_stats(parts: DataFrame) -> DataFrame:
    """Per sensor: min, max and mean over the *readings* behind the windows, and their number."""
    merged = _merge(parts.groupBy("sensor_id"))
    out = ["sensor_id"]
    for m in MEASURES:
        out += [f"{m}_min", f"{m}_max", mean_of_parts(f"{m}_parts").alias(f"{m}_avg")]
    return merged.select(*out, "readings")
