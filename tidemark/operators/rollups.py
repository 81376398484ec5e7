"""Step roll-ups of counters (M10): stored increments from which rates of any range are composed.

A roll-up row holds, per series and step of time, the first and last sample, the reset-aware
increase between them and the number of samples. Two parts of one step merge in
time order: increases add up, plus the step from one part's last sample to the next
part's first. A rate over ``(t - range, t]`` is the sum of the increases of its steps and of the
steps between neighbours, so a dashboard is refreshed from one row per series and step, and
raw samples are read once.

The roll-up step divides the range and the evaluation step. Parts of one step that
interleave in time can't be merged exactly; ``merged_rollups`` marks them (``interleaved``), and the step is to be
rolled up from samples again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import duration_seconds
from tidemark.operators.metrics import SERIES, US, ceil_div, floor_div, rates_of, usable
from tidemark.operators.series import bucket_keys, previous_in_series

ROLLUP = ["first_ts", "first_value", "last_ts", "last_value", "increase", "samples"]


def reset_aware(value: Column, before: Column) -> Column:
    """The increase from one sample to the next; a drop restarts the counter from 0."""
    return F.when(value >= before, value - before).otherwise(value)


def _exact(total: Column, like: T.DataType) -> Column:
    return total.cast(T.DecimalType(38, like.scale)) if isinstance(like, T.DecimalType) else total


def step_rollups(samples: DataFrame, step: str, series: list[str] = SERIES, start: str | None = None, end: str | None = None, tasks: int | None = None) -> DataFrame:
    """(series, step_no, first_ts, first_value, last_ts, last_value, increase, samples); step n covers ``((n-1)*step, n*step]``."""
    step_us = duration_seconds(step) * US
    rows = usable(samples, series, 0, start, end).withColumn("step_no", ceil_div(F.unix_micros("ts"), step_us))
    keys = [*series, "step_no"]
    rows = rows.repartition(tasks, *keys) if tasks else rows
    before = F.lag("value").over(Window.partitionBy(*keys).orderBy("ts", "value"))
    delta = F.when(before.isNull(), F.lit(0).cast(samples.schema["value"].dataType)).otherwise(reset_aware(F.col("value"), before))
    rolled = rows.withColumn("_delta", delta).groupBy(*keys).agg(
        F.min(F.struct("ts", "value")).alias("_first"), F.max(F.struct("ts", "value")).alias("_last"),
        F.sum("_delta").alias("increase"), F.count(F.lit(1)).alias("samples"),
    )
    return rolled.select(
        *keys, F.col("_first.ts").alias("first_ts"), F.col("_first.value").alias("first_value"), F.col("_last.ts").alias("last_ts"),
        F.col("_last.value").alias("last_value"), _exact(F.col("increase"), samples.schema["value"].dataType).alias("increase"), "samples",
    )


def merged_rollups(parts: DataFrame, series: list[str] = SERIES, tasks: int | None = None) -> DataFrame:
    """One row per series and step from parts of the same step, in time order; ``interleaved`` where parts overlap."""
    keys = [*series, "step_no"]
    parts = parts.repartition(tasks, *keys) if tasks else parts
    w = Window.partitionBy(*keys).orderBy("first_ts", "first_value", "last_ts")
    linked = parts.select("*", F.lag("last_value").over(w).alias("_value"), F.max("last_ts").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_ts"))
    between = F.when(F.col("_value").isNull(), F.lit(0).cast(parts.schema["increase"].dataType)).otherwise(reset_aware(F.col("first_value"), F.col("_value")))
    merged = linked.groupBy(*keys).agg(
        F.min(F.struct("first_ts", "first_value")).alias("_first"), F.max(F.struct("last_ts", "last_value")).alias("_last"),
        F.sum(F.col("increase") + between).alias("increase"), F.sum("samples").alias("samples"),
        F.coalesce(F.bool_or(F.col("_ts") > F.col("first_ts")), F.lit(False)).alias("interleaved"),
    )
    return merged.select(
        *keys, "_first.first_ts", "_first.first_value", "_last.last_ts", "_last.last_value",
        _exact(F.col("increase"), parts.schema["first_value"].dataType).alias("increase"), "samples", "interleaved",
    )


def coarser(rollups: DataFrame, factor: int, series: list[str] = SERIES) -> DataFrame:
    """Roll-ups of a step ``factor`` times as long, from roll-ups alone."""
    return merged_rollups(rollups.select(*series, ceil_div(F.col("step_no"), factor).alias("step_no"), *ROLLUP), series).drop("interleaved")


def rate_from_rollups(
    rollups: DataFrame,
    rollup_step: str,
    range_: str,
    step: str,
    start: str | None = None,
    end: str | None = None,
    series: list[str] = SERIES,
    bucket_seconds: int = 30 * 86400,
    tasks: int | None = None,
) -> DataFrame:
    """M1 + M10 from one row per series and step; the same rows as ``counter_rate`` over the samples."""
    unit, range_s, step_s = duration_seconds(rollup_step), duration_seconds(range_), duration_seconds(step)
    if range_s % unit or step_s % unit:
        raise ValueError("range and step have to be whole roll-up steps")
    width, pace = range_s // unit, step_s // unit
    rows = rollups
    if start:
        rows = rows.where(F.col("step_no") > floor_div(F.unix_micros(F.lit(start).cast("timestamp")), unit * US) - width)
    if end:
        rows = rows.where(F.col("step_no") <= floor_div(F.unix_micros(F.lit(end).cast("timestamp")), unit * US))
    linked = previous_in_series(rows, series, "last_ts", ("last_value", "step_no"), bucket_seconds, tiebreak=("last_value",), tasks=tasks, keep=True)
    inside = F.struct(F.col("step_no").alias("newest"), F.col("step_no").alias("oldest"), F.col("increase").alias("_delta"))
    across = F.struct(F.col("step_no").alias("newest"), F.col("prev_step_no").alias("oldest"), reset_aware(F.col("first_value"), F.col("prev_last_value")).cast(rollups.schema["increase"].dataType).alias("_delta"))
    terms = F.array_compact(F.array(F.when(F.col("samples") > 1, inside), F.when(F.col("prev_step_no").isNotNull(), across)))
    pairs = linked.select(*series, *bucket_keys(linked), F.inline(terms))
    # a term counts at every evaluation step whose range holds its oldest and its newest step
    lo, hi = ceil_div(F.col("newest"), pace), floor_div(F.col("oldest") + F.lit(width - 1), pace)
    return rates_of(pairs, lo, hi, series, range_s, step_s, start, end, rollups.schema["first_value"].dataType)
