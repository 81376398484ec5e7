"""Counter rates on live samples (S8 + M1): keyed state, increments per trigger.

Per series the state holds its newest sample. A trigger's samples of a series are ordered in
one vectorised step; each sample and the one before it give a reset-aware increase that counts at the
evaluation steps ``lo`` to ``hi``, as in the batch rate. Increases with the same steps are summed, and
the sums of a trigger are stored under its ``batch_id``, so a replayed trigger replaces its
own. ``live_rates`` adds them up: rates are there after every trigger, from the
increments alone.

A sample that is older than its series' newest one can't be placed any more: it is left out and
counted in ``late`` of the trigger. Rows of one series in one trigger are bounded by the source's intake
limit, as is the state: one row per series.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.time import duration_seconds
from tidemark.operators.metrics import SERIES, US, rates_of, usable
from tidemark.schemas import TRIGGER_INTERVAL
from tidemark.sources.store import write_batch_partition
from tidemark.streaming.wiring import _start_update


def _increments(range_us: int, step_us: int, scale: int):
    """The state function: one series' samples of one trigger -> increments."""

    unit = Decimal(1).scaleb(-scale)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        # numpy throughout: most series have few samples per trigger, so the cost is what a call takes
        parts = [(f["us"].to_numpy(np.int64), f["value"].to_numpy(object)) for f in frames]
        at, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(at, kind="stable")
        if (np.diff(at[order]) == 0).any():
            order = sorted(range(len(at)), key=lambda i: (at[i], value[i]))
        at, value = at[order], value[order]
        late = 0
        if state.exists:
            last_us, last = state.get
            last = Decimal(last)
            fresh = (at > last_us) | ((at == last_us) & (value >= last))
            late = int((~fresh).sum())
            at, value = np.concatenate([[last_us], at[fresh]]), np.concatenate([np.array([last], object), value[fresh]])
        if len(at):
            state.update((int(at[-1]), str(value[-1])))
        now, before = value[1:], value[:-1]
        lo, hi = -(-at[1:] // step_us), -(-(at[:-1] + range_us) // step_us) - 1
        delta = np.where(now >= before, now - before, now) if len(now) else np.zeros(0, object)
        counts = lo <= hi
        lo, hi, delta = lo[counts], hi[counts], delta[counts]
        if not len(lo) and not late:
            return
        # both ends grow with time: equal ones are neighbours
        head = np.flatnonzero(np.append(True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))[: len(lo)])
        total = np.add.reduceat(delta, head) if len(head) else delta
        none = [None] * (late > 0)
        out = {name: [label] * (len(head) + len(none)) for name, label in zip(SERIES, key, strict=True)}
        out["lo"], out["hi"] = (pd.array([*x[head].tolist(), *none], "Int64") if none else x[head] for x in (lo, hi))
        out["delta"] = [*(x.quantize(unit) for x in total), *none]
        out["late"] = np.array([0] * len(head) + [late] * len(none), np.int64)
        yield pd.DataFrame(out)

    return update


def rate_increments(samples: DataFrame, range_: str, step: str) -> DataFrame:
    """Increments (series, lo, hi, delta, late) of a stream of samples with decimal values."""
    vtype = samples.schema["value"].dataType
    if not isinstance(vtype, T.DecimalType):
        raise TypeError("live rates add up decimal counters")
    range_us, step_us = duration_seconds(range_) * US, duration_seconds(step) * US
    rows = usable(samples, SERIES, 0, None, None).select(*SERIES, F.unix_micros("ts").alias("us"), "value")
    labels = ", ".join(f"{c} string" for c in SERIES)
    return rows.groupBy(*SERIES).applyInPandasWithState(
        _increments(range_us, step_us, vtype.scale), f"{labels}, lo long, hi long, delta {vtype.simpleString()}, late long", "last_us long, last_value string", "update", "NoTimeout"
    )


def start_rate_sink(
    samples: DataFrame, path: str, checkpoint: str, range_: str, step: str, trigger: str | None = TRIGGER_INTERVAL, available_now: bool = False, state_partitions: int | None = None
) -> StreamingQuery:
    """Store the increments of every trigger under its ``batch_id``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_partition(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), path)

    return _start_update(rate_increments(samples, range_, step), write, checkpoint, trigger, available_now, state_partitions=state_partitions)


def live_rates(spark: SparkSession, path: str, range_: str, step: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The rates so far, from the stored increments; the same columns as ``counter_rate``."""
    stored = spark.read.parquet(path).where(F.col("lo").isNotNull())
    vtype = stored.schema["delta"].dataType
    pairs = stored.withColumnRenamed("delta", "_delta")
    return rates_of(pairs, F.col("lo"), F.col("hi"), SERIES, duration_seconds(range_), duration_seconds(step), start, end, vtype)
