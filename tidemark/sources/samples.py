"""Metric samples (S8): read long-format samples, or derive them from events.

Derived counters (FIXTURES F8): per user and UTC day, ordered by
(ts, event_id), ``events_value_total`` is the running sum of ``value`` and
``events_count_total`` the running count; both restart at midnight.
Labels: ``namespace`` = event type of the user's first event, ``pod`` =
user id, ``container`` = 'sensor'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import labels_to_columns
from tidemark.functions.time import to_timestamp_utc
from tidemark.operators.series import running_total
from tidemark.schemas import METRIC_SAMPLE

VALUE_TYPE = METRIC_SAMPLE["value"].dataType
LABELS = ["namespace", "pod", "container"]


def read_samples(spark: SparkSession, path: str, streaming: bool = False, schema=None, labels: list[str] = LABELS) -> DataFrame:
    """Parquet samples as they are stored, decimal or double values alike.

    A ``labels`` map becomes flat label columns. A stream needs ``schema``
    (METRIC_SAMPLE unless given).
    """
    if streaming:
        df = spark.readStream.schema(schema or METRIC_SAMPLE).parquet(path)
    else:
        df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return labels_to_columns(df, labels) if "labels" in df.columns else df


def samples_from_events(events: DataFrame) -> DataFrame:
    """Two counters per user from the events table, as long-format samples.

    The running sums are two-level (per hour chunk, then chunk offsets per
    user-day), so a user with a huge share of events is still split.
    The first-event label is a grouped ``min_by`` joined back on user (null-safe).
    As in real scrapes, some series lack the ``container`` label (users with
    ``user_id % 7 = 3``) and some samples have no value (``event_id % 13 = 5``).
    """
    base = events.select(
        "user_id",
        "event_id",
        "event_type",
        to_timestamp_utc("ts").alias("ts"),
        F.col("value").try_cast(VALUE_TYPE).alias("_amount"),
    )
    base = base.withColumn("_day", F.to_date("ts")).withColumn("_hour", F.hour("ts"))
    counted = running_total(
        base,
        partition=["user_id", "_day"],
        order=["ts", "event_id"],
        values={"_sum": "_amount", "_cnt": F.lit(1).cast("long")},
        split="_hour",
    )
    first = events.groupBy("user_id").agg(
        F.min_by("event_type", F.struct(to_timestamp_utc("ts"), F.col("event_id"))).alias("namespace")
    )
    first = first.withColumnRenamed("user_id", "_user")
    labelled = counted.join(first, F.col("user_id").eqNullSafe(F.col("_user")), "left")
    has_value = F.pmod("event_id", F.lit(13)) != 5
    metrics = F.explode(
        F.array(
            F.struct(F.lit("events_value_total").alias("metric"), F.when(has_value, F.col("_sum").cast(VALUE_TYPE)).alias("value")),
            F.struct(F.lit("events_count_total").alias("metric"), F.when(has_value, F.col("_cnt").cast(VALUE_TYPE)).alias("value")),
        )
    ).alias("_m")
    container = F.when(F.coalesce(F.pmod("user_id", F.lit(7)), F.lit(0)) != 3, F.lit("sensor")).alias("container")
    exploded = labelled.select("namespace", F.col("user_id").cast("string").alias("pod"), container, "ts", metrics)
    return exploded.select(
        F.col("_m.metric").alias("metric"),
        "namespace",
        "pod",
        "container",
        "ts",
        F.col("_m.value").alias("value"),
    )
