"""Metric-sample analytics (M1-M10): counter rates, sums by label, counts of
series, pairs, top-k, latest values, shares and bands.

Samples are long format: ``metric`` + label columns + ``ts`` + ``value``
(decimal for counters, so sums do not depend on order). Evaluation times
are a grid ``k * step`` (epoch aligned). Each sample is fanned out only to
the grid points it can affect -- at most ``range/step`` of them -- with a
bounded ``explode(sequence(...))``; there is no join against a time table.
Every result is a grouped aggregate with map-side partial aggregation.

Null and NaN samples are no samples. An absent (null) label equals the empty
string. Samples of one time are ordered by value. With ``start``/``end`` only
the samples that can matter are read: the bound is a plain filter on ``ts``.

Rate definition: increase over the trailing range ``(t - range, t]``, reset
aware (a drop restarts the counter from 0), divided by the range in seconds,
defined when the range holds at least two samples. No extrapolation to the
range edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import duration_seconds
from tidemark.operators.series import bucket_keys, previous_in_series

SERIES = ["metric", "namespace", "pod", "container"]
US = 1_000_000


def floor_div(a: Column, b: int) -> Column:
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def ceil_div(a: Column, b: int) -> Column:
    return -floor_div(-a, b)


def _grid(step_s: int, start: str | None, end: str | None) -> tuple[Column | None, Column | None]:
    step_us = step_s * US
    lo = ceil_div(F.unix_micros(F.lit(start).cast("timestamp")), step_us) if start else None
    hi = floor_div(F.unix_micros(F.lit(end).cast("timestamp")), step_us) if end else None
    return lo, hi


def usable(samples: DataFrame, series: list[str], reach_s: int, start: str | None, end: str | None) -> DataFrame:
    """Samples that can affect evaluation times in [start, end]: those of
    ``(start - reach, end]`` with a value, absent labels as empty strings."""
    value = F.col("value")
    kept = samples.where(value.isNotNull())
    if isinstance(samples.schema["value"].dataType, (T.DoubleType, T.FloatType)):
        kept = kept.where(~F.isnan(value))
    if start:
        kept = kept.where(F.col("ts") > F.lit(start).cast("timestamp") - F.expr(f"INTERVAL {reach_s} SECONDS"))
    if end:
        kept = kept.where(F.col("ts") <= F.lit(end).cast("timestamp"))
    labels = [c if c == "metric" else F.coalesce(c, F.lit("")).alias(c) for c in series]
    return kept.select(*labels, "ts", "value")


def _clip(df: DataFrame, keep: list[str], lo: Column, hi: Column, step_s: int, start, end) -> DataFrame:
    g_lo, g_hi = _grid(step_s, start, end)
    if g_lo is not None:
        lo = F.greatest(lo, g_lo)
    if g_hi is not None:
        hi = F.least(hi, g_hi)
    return df.select(*keep, lo.alias("_lo"), hi.alias("_hi")).where(F.col("_lo") <= F.col("_hi"))


def _fan_out(clipped: DataFrame) -> DataFrame:
    return clipped.select(
        *[c for c in clipped.columns if c not in ("_lo", "_hi")], F.explode(F.sequence("_lo", "_hi")).alias("_k")
    )


def _eval_time(step_s: int) -> Column:
    return F.timestamp_micros(F.col("_k") * F.lit(step_s * US)).alias("t")


def counter_rate(
    samples: DataFrame,
    range_: str = "5 minutes",
    step: str = "15 seconds",
    start: str | None = None,
    end: str | None = None,
    series: list[str] = SERIES,
    bucket_seconds: int = 86400,
    tasks: int | None = None,
) -> DataFrame:
    """M1 + M10: per series and eval time ``t``: ``increase`` and ``rate``.

    A sample with a predecessor in its series contributes its reset-aware
    delta to every ``t`` with ``ts <= t < prev_ts + range``, i.e. to the
    ranges that hold both it and its predecessor. Deltas with the same
    evaluation times are summed before they are fanned out. Decimal counters
    are summed as decimals (exact, any order); double ones as doubles. ``tasks`` fixes the number
    of tasks of the ordered work (see ``tasks_for``).
    """
    range_s, step_s = duration_seconds(range_), duration_seconds(step)
    step_us, range_us = step_s * US, range_s * US
    prev = previous_in_series(
        usable(samples, series, range_s, start, end), series, "ts", ("value",), bucket_seconds, tiebreak=("value",), tasks=tasks, keep=True
    )
    value, before = F.col("value"), F.col("prev_value")
    delta = F.when(value >= before, value - before).otherwise(value).alias("_delta")
    pairs = prev.where(F.col("prev_ts").isNotNull()).select(*series, *bucket_keys(prev), delta, "ts", "prev_ts")
    lo = ceil_div(F.unix_micros("ts"), step_us)
    hi = ceil_div(F.unix_micros("prev_ts") + F.lit(range_us), step_us) - F.lit(1)
    return rates_of(pairs, lo, hi, series, range_s, step_s, start, end, samples.schema["value"].dataType)


def rates_of(
    pairs: DataFrame, lo: Column, hi: Column, series: list[str], range_s: int, step_s: int, start: str | None, end: str | None, vtype: T.DataType
) -> DataFrame:
    """Rates from increases (``_delta``) that count at the evaluation steps ``lo`` to ``hi``.

    Increases with the same evaluation times are summed before they are fanned out; where ``pairs`` carries
    the keys by which it is dealt (``bucket_keys``), inside these, without another shuffle.
    """
    dealt = bucket_keys(pairs)
    clipped = _clip(pairs, [*series, *dealt, "_delta"], lo, hi, step_s, start, end)
    summed = clipped.groupBy(*series, *dealt, "_lo", "_hi").agg(F.sum("_delta").alias("_delta"))
    inc = _fan_out(summed).groupBy(*series, "_k").agg(F.sum("_delta").alias("increase"))
    if isinstance(vtype, T.DecimalType):
        inc = inc.withColumn("increase", F.col("increase").cast(T.DecimalType(38, vtype.scale)))
    return inc.select(
        *series,
        _eval_time(step_s),
        "increase",
        F.lit(range_s).cast("long").alias("range_seconds"),
        (F.col("increase").cast("double") / F.lit(float(range_s))).alias("rate"),
    )


def instant_value(
    samples: DataFrame,
    step: str = "15 seconds",
    lookback: str = "5 minutes",
    start: str | None = None,
    end: str | None = None,
    series: list[str] = SERIES,
) -> DataFrame:
    """Gauge at each eval time: the newest sample in ``(t - lookback, t]``.

    Samples are reduced to the newest per step first, since an older one in
    the same step is never the answer.
    """
    step_s, look_s = duration_seconds(step), duration_seconds(lookback)
    step_us, look_us = step_s * US, look_s * US
    lo = ceil_div(F.unix_micros("ts"), step_us)
    newest = F.max(F.struct("ts", "value")).alias("_new")
    reduced = usable(samples, series, look_s, start, end).groupBy(*series, lo.alias("_first")).agg(newest)
    hi = ceil_div(F.unix_micros("_new.ts") + F.lit(look_us), step_us) - F.lit(1)
    clipped = _clip(reduced, [*series, "_new"], F.col("_first"), hi, step_s, start, end)
    inst = _fan_out(clipped).groupBy(*series, "_k").agg(F.max("_new").alias("_new"))
    return inst.select(*series, _eval_time(step_s), F.col("_new.value").alias("value"))


def sum_by(df: DataFrame, by: list[str] | None = None, time: str = "t") -> DataFrame:
    """M2/M3: ``sum(x) by (labels)`` per eval time.

    Rate frames are summed on their exact ``increase`` and the rate is
    derived once at the end; gauge frames sum ``value``.
    """
    keys = [time, *(by or [])]
    if "increase" in df.columns:
        agg = df.groupBy(*keys).agg(
            F.sum("increase").alias("increase"), F.max("range_seconds").alias("range_seconds")
        )
        return agg.select(
            *keys,
            "increase",
            "range_seconds",
            (F.col("increase").cast("double") / F.col("range_seconds").cast("double")).alias("rate"),
        )
    return df.groupBy(*keys).agg(F.sum("value").alias("value"))


def series_count(instants: DataFrame, keys: list[str], time: str = "t") -> DataFrame:
    """M4: ``count(count by (keys) (x))``: distinct key values per time."""
    distinct = instants.groupBy(time, *keys).agg(F.count(F.lit(1)).alias("_n"))
    return distinct.groupBy(time).agg(F.count(F.lit(1)).alias("series"))


def add_series(rates: DataFrame, metric_a: str, metric_b: str, series: list[str] = SERIES, time: str = "t") -> DataFrame:
    """M5: ``rate(a) + rate(b)`` matched one-to-one on all other labels.

    One scan and one shuffle: both metrics' increases are pivoted in the
    same aggregation; label sets present on one side only drop out.
    """
    labels = [c for c in series if c != "metric"]
    metric = F.col("metric")
    both = rates.where(metric.isin(metric_a, metric_b)).groupBy(time, *labels).agg(
        F.sum(F.when(metric == metric_a, F.col("increase"))).alias("_a"),
        F.sum(F.when(metric == metric_b, F.col("increase"))).alias("_b"),
        F.max("range_seconds").alias("range_seconds"),
    )
    paired = both.where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    return paired.select(
        time,
        *labels,
        (F.col("_a") + F.col("_b")).alias("increase"),
        "range_seconds",
        ((F.col("_a") + F.col("_b")).cast("double") / F.col("range_seconds").cast("double")).alias("rate"),
    )


def topk(df: DataFrame, k: int, by: str, partition: list[str] | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """M6/L4: top-k rows by ``by`` per partition (per eval time by default).

    ``row_number() <= k`` is planned with a partial group limit before the
    shuffle, so each task ships at most k rows per time value.
    """
    partition = partition if partition is not None else ["t"]
    order = [F.desc(by), *[F.asc(c) for c in (tiebreak or [])]]
    if not partition:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*partition).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return ranked.withColumn("rank", F.col("_rn").cast("long")).drop("_rn")


def last_not_null(samples: DataFrame, series: list[str] = SERIES) -> DataFrame:
    """M7: newest non-null value of every series (``lastNotNull``)."""
    newest = usable(samples, series, 0, None, None).groupBy(*series).agg(F.max(F.struct("ts", "value")).alias("_new"))
    return newest.select(*series, "_new.ts", "_new.value")


def share_of_total(df: DataFrame, value: str, partition: list[str] | None = None) -> DataFrame:
    """M8: each row's share of its partition's total (null when total is 0),
    and the same as ``percent`` (the donut's value and percent).

    The rows are already summed, so the total is a window over one small
    group per eval time. With an empty partition the total of all rows is a
    scalar subquery over the same aggregate, whose shuffle is reused.
    """
    partition = partition if partition is not None else ["t"]
    if partition:
        summed = df.withColumn("_total", F.sum(value).over(Window.partitionBy(*partition)).cast("double"))
    else:
        summed = df.withColumn("_total", df.agg(F.sum(value).cast("double")).scalar())
    share = F.when(F.col("_total") == 0, F.lit(None).cast("double")).otherwise(F.col(value).cast("double") / F.col("_total"))
    return summed.withColumn("share", share).drop("_total").withColumn("percent", F.col("share") * F.lit(100.0))
