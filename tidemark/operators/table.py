"""Table conformance (P8), dead letters (S5), key collapse (A6), purge.

The table is ``analytics_data``: sensor_id varchar(50) not null, timestamp
bigint not null, temperature/humidity decimal(5,2), created_at not null,
key (sensor_id, timestamp). Rows that cannot be stored go to dead letters
with a reason instead of failing the job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.checks import label
from tidemark.functions.numeric import to_table_decimal
from tidemark.functions.time import as_timestamp_literal
from tidemark.operators.windows import MEASURES

TABLE_COLUMNS = ["sensor_id", "timestamp", "temperature", "humidity", "created_at"]
KEY = ["sensor_id", "timestamp"]


def conform_table(df: DataFrame, as_of: dt.datetime | str | Column, carry: list[str] | None = None) -> DataFrame:
    """Cast window means to table types and label what cannot be stored.

    Output: table columns, ``reason``, ``storable``, ``raw_value`` (the
    input row as JSON, the dead-letter context) and any ``carry`` columns.
    """
    sid = F.col("sensor_id")
    checks = [
        (sid.isNull(), S.D_NULL_KEY + "sensor_id"),
        (F.length(sid) > S.TABLE_SENSOR_ID_MAX_LEN, S.D_SENSOR_ID_TOO_LONG),
        (F.col("timestamp").isNull(), S.D_NULL_KEY + "timestamp"),
    ]
    for m in MEASURES:
        checks.append((F.col(m).isNull(), S.D_NULL_MEASURE + m))
        checks.append((F.col(m).isNotNull() & to_table_decimal(m).isNull(), S.D_DECIMAL_OVERFLOW + m))
    reason, storable = label(checks)
    source_cols = [c for c in df.columns if c not in (carry or [])]
    out = df.select(
        *(carry or []),
        sid.alias("sensor_id"),
        F.col("timestamp").cast("long").alias("timestamp"),
        to_table_decimal("temperature").alias("temperature"),
        to_table_decimal("humidity").alias("humidity"),
        as_timestamp_literal(as_of).alias("created_at"),
        F.to_json(F.struct(*source_cols)).alias("raw_value"),
        reason.alias("reason"),
        storable.alias("storable"),
    )
    return out


def split_dead_letters(labelled: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``keep`` columns, dead letters with reason and context).

    Both come from the same labelled plan; persist it when writing both so
    the input is read once (the streaming sink does this per micro-batch).
    """
    keep = keep or TABLE_COLUMNS
    good = labelled.where(F.col("storable")).select(*keep)
    dead_cols = [c for c in labelled.columns if c != "storable"]
    dead = labelled.where(~F.col("storable")).select(*dead_cols)
    return good, dead


def collapse_updates(changelog: DataFrame, policy: str = "last", order: str = "batch_id") -> DataFrame:
    """One row per key from repeated window updates.

    ``last``: the newest update (correct final mean, upsert semantics).
    ``first``: the first update (plain insert into a keyed table). A grouped
    ``max_by``/``min_by`` keeps partial aggregation; no ranking window.
    """
    pick = {"last": F.max_by, "first": F.min_by}[policy]
    extreme = {"last": F.max, "first": F.min}[policy]
    others = [c for c in changelog.columns if c not in KEY]
    # One row per key and order value, so picking column by column gives
    # one consistent row; plain-typed max_by keeps a hash aggregate.
    aggs = [(extreme(c) if c == order else pick(c, F.col(order))).alias(c) for c in others]
    return changelog.groupBy(*KEY).agg(*aggs).select(*KEY, *others)


def duplicate_updates(changelog: DataFrame, order: str = "batch_id") -> DataFrame:
    """Updates refused by a plain insert because the key exists (policy first).

    One key has at most one row per batch, so the ranking window per key
    is bounded by the number of triggers in one window's life.
    """
    w = Window.partitionBy(*KEY).orderBy(order)
    ranked = changelog.withColumn("_rank", F.row_number().over(w))
    return ranked.where(F.col("_rank") > 1).drop("_rank").withColumn("reason", F.lit(S.D_DUPLICATE_KEY))


def purge_sensors(df: DataFrame, ids: list[str] | DataFrame, column: str = "sensor_id") -> DataFrame:
    """Remove the rows of given sensors.

    A Python list becomes an ``IN`` filter pushed into the scan; a DataFrame
    of ids becomes a left-anti join whose strategy AQE picks from the
    measured size of the id side.
    """
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), on=column, how="left_anti")
    return df.where(~F.col(column).isin(list(ids)))
