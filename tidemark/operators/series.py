"""Per-series ordered operations that stay safe when one series is huge.

A window partitioned by series alone puts a hot series (say a third of all
rows) into one task. Both helpers here split each series into time
buckets, do the ordered work inside (series, bucket), and carry the
bucket-boundary state through a small table with one row per bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bucket_of(ts: str | Column, bucket_seconds: int) -> Column:
    """Epoch-aligned time bucket number of a timestamp."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(col) / F.lit(bucket_seconds * 1_000_000)).cast("long")


ROWS_PER_TASK = 150_000  # of ordered work; a row's sort, window and sums take about 2 KB


def tasks_for(rows: int) -> int | None:
    """Tasks for ordered work on so many rows: in proportion to them. Few rows are left to AQE.

    AQE joins small shuffle partitions by their compressed size, so a task's memory would follow how well rows compress."""
    return -(-rows // ROWS_PER_TASK) if rows > 4 * ROWS_PER_TASK else None


def _no_nulls(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    """Key columns without nulls that tell null from any value; a plain equality on them needs no shuffle of its own."""
    out = {}
    for i, c in enumerate(columns):
        if not df.schema[c].nullable:
            out[f"_key{i}"] = F.col(c)
            continue
        text = isinstance(df.schema[c].dataType, T.StringType)
        out[f"_key{i}"] = F.coalesce(F.col(c) if text else F.col(c).cast("string"), F.lit(""))
        out[f"_null{i}"] = F.col(c).isNull()
    return out


def previous_in_series(
    df: DataFrame,
    series: list[str],
    ts: str = "ts",
    carry: tuple[str, ...] = ("value",),
    bucket_seconds: int = 86400,
    tiebreak: tuple[str, ...] = (),
    tasks: int | None = None,
    keep: bool = False,
) -> DataFrame:
    """Add ``prev_<ts>`` and ``prev_<c>`` (previous sample of the same series).

    Inside a bucket ``lag`` does the work; the first sample of a bucket gets
    the last sample (the one without a successor) of the nearest earlier
    non-empty bucket of its series, from a table with one row per bucket.
    Both sides share one shuffle, into ``tasks`` parts if given. Null labels are values like any other:
    keys without nulls stand for them. ``tiebreak`` orders samples of one time. With ``keep`` the rows keep
    these keys (``bucket_keys``), by which they are dealt.
    """
    order = [F.col(ts), *[F.col(c) for c in tiebreak]]
    keyed = df.withColumn("_bucket", bucket_of(ts, bucket_seconds))
    made = _no_nulls(keyed, [*series, "_bucket"])
    keyed, keys = keyed.withColumns(made), list(made)
    labels = [k for k in keys if k not in (f"_key{len(series)}", f"_null{len(series)}")]
    keyed = keyed.repartition(tasks, *keys) if tasks else keyed.repartition(*keys)
    # the labels themselves are named too, so that a filter on them still reaches the scan
    w = Window.partitionBy(*keys, *series, "_bucket").orderBy(*order)
    inner = keyed.select(
        "*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in (ts, *carry)], F.lead(ts).over(w).isNull().alias("_final")
    )
    last = inner.where("_final").select(*keys, "_bucket", F.struct(ts, *carry).alias("_last"))
    wb = Window.partitionBy(*labels).orderBy("_bucket")
    boundary = last.select(*[F.col(c).alias(f"_b{c}") for c in keys], F.lag("_last").over(wb).alias("_carry"))
    same = reduce(lambda x, y: x & y, (F.col(c) == F.col(f"_b{c}") for c in keys))
    joined = inner.join(boundary, same, "left")
    first = F.col(f"prev_{ts}").isNull()  # first sample of its bucket
    previous = {c: F.when(first, F.col(f"_carry.{c}")).otherwise(F.col(f"prev_{c}")) for c in (ts, *carry)}
    return joined.select(*df.columns, *(keys if keep else []), *[v.alias(f"prev_{c}") for c, v in previous.items()])


def bucket_keys(df: DataFrame) -> list[str]:
    """The key columns that :func:`previous_in_series` left with ``keep``."""
    return [c for c in df.columns if c.startswith(("_key", "_null")) and c.lstrip("_kenyul").isdigit()]


def running_total(
    df: DataFrame,
    partition: list[str],
    order: list[str],
    values: dict[str, str | Column],
    split: str | None = None,
) -> DataFrame:
    """Add running sums ``out = sum(value)`` per partition in ``order``.

    With ``split`` (a column monotone in ``order``, e.g. the hour), each
    (partition, split) chunk is summed on its own and the totals of earlier
    chunks are added: a two-level prefix sum, so no task holds more than
    one chunk of a hot partition.
    """
    vals = {k: (F.col(v) if isinstance(v, str) else v) for k, v in values.items()}
    frame = (Window.unboundedPreceding, Window.currentRow)
    if split is None:
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(*frame)
        return df.select("*", *[F.sum(v).over(w).alias(k) for k, v in vals.items()])
    staged = df.select("*", *[v.alias(f"_v_{k}") for k, v in vals.items()])
    chunk = staged.groupBy(*partition, split).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in vals])
    wc = Window.partitionBy(*partition).orderBy(split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunk.select(
        *partition, split, *[F.coalesce(F.sum(f"_t_{k}").over(wc), F.lit(0)).alias(f"_o_{k}") for k in vals]
    )
    w = Window.partitionBy(*partition, split).orderBy(*order).rowsBetween(*frame)
    inner = staged.select(*df.columns, *[F.sum(f"_v_{k}").over(w).alias(f"_i_{k}") for k in vals])
    keys = [*partition, split]
    offsets = offsets.withColumnsRenamed({c: f"_p_{c}" for c in keys})
    joined = inner.join(offsets, reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in keys)))
    return joined.select(*df.columns, *[(F.col(f"_i_{k}") + F.col(f"_o_{k}")).alias(k) for k in vals])
