"""Ingest validation (P20-P24), encode (S3), ingest (Q4) and accounting (A5).

Validation is a set of column predicates evaluated in one projection; a
row is never dropped here, it is labelled: ``reason`` (every failed rule,
joined by ``;``; empty when none) and ``accepted``.
Input columns may be strings (lax client input) or typed; strings are
converted with ``try_cast`` so ANSI mode never raises on junk.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.checks import label
from tidemark.functions.time import as_timestamp_literal, interval, iso_string, parse_timestamp

AsOf = dt.datetime | str | Column
NUMBER = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|NaN|Infinity)$"  # the last two fail the range checks


def _typed(df: DataFrame, name: str, target: T.DataType) -> Column:
    col = F.col(name)
    source = df.schema[name].dataType
    if isinstance(source, type(target)):
        return col
    if isinstance(target, T.TimestampType):
        if isinstance(source, T.TimestampNTZType):
            return col.cast(T.TimestampType())
        return parse_timestamp(col.cast("string"))
    if isinstance(source, T.StringType):
        # a cast alone also takes Java literals such as 22.5d or 0x1p3
        return F.when(F.trim(col).rlike(NUMBER), col.try_cast(target))
    return col.try_cast(target)


def validate(df: DataFrame, as_of: AsOf) -> DataFrame:
    """Label each candidate reading with its reject reasons.

    ``as_of`` is the receipt time: a literal for one request batch, or a
    Column (per-row receipt time). Output replaces the four fields by typed
    columns and adds ``reason`` and ``accepted``.
    """
    raw = {c: F.col(c) for c in ("sensor_id", "timestamp", "temperature", "humidity")}
    sid = raw["sensor_id"].cast("string")
    ts = _typed(df, "timestamp", T.TimestampType())
    temp = _typed(df, "temperature", T.DoubleType())
    hum = _typed(df, "humidity", T.DoubleType())
    now = as_timestamp_literal(as_of)

    checks = [(raw[c].isNull(), S.R_MISSING + c) for c in raw]
    checks += [
        (sid.isNotNull() & ~F.length(sid).between(S.SENSOR_ID_MIN_LEN, S.SENSOR_ID_MAX_LEN), S.R_SENSOR_ID_LENGTH),
        (raw["timestamp"].isNotNull() & ts.isNull(), S.R_TS_UNPARSEABLE),
        (ts > now + interval(S.REJECT_FUTURE), S.R_TS_FUTURE),
        (ts < now - interval(S.REJECT_PAST), S.R_TS_PAST),
        (raw["temperature"].isNotNull() & temp.isNull(), S.R_TEMPERATURE_INVALID),
        # between() fails NaN and infinities (NaN sorts above every number).
        (temp.isNotNull() & ~temp.between(S.TEMPERATURE_MIN, S.TEMPERATURE_MAX), S.R_TEMPERATURE_RANGE),
        (raw["humidity"].isNotNull() & hum.isNull(), S.R_HUMIDITY_INVALID),
        (hum.isNotNull() & ~hum.between(S.HUMIDITY_MIN, S.HUMIDITY_MAX), S.R_HUMIDITY_RANGE),
    ]
    reason, accepted = label(checks)
    others = [c for c in df.columns if c not in raw]
    return df.select(
        *others,
        sid.alias("sensor_id"),
        ts.alias("timestamp"),
        temp.alias("temperature"),
        hum.alias("humidity"),
        reason.alias("reason"),
        accepted.alias("accepted"),
    )


def flag_suspicious(validated: DataFrame, as_of: AsOf) -> DataFrame:
    """Accepted-but-odd times (P24): > 5 min ahead or > 10 h behind.

    Adds ``suspicious`` ('future' | 'past' | null) and ``lead_seconds``
    (reading time minus receipt time). No row is dropped.
    """
    now = as_timestamp_literal(as_of)
    ts = F.col("timestamp")
    lead = (F.unix_micros(ts) - F.unix_micros(now)) / F.lit(1_000_000.0)
    kind = (
        F.when(ts > now + interval(S.SUSPICIOUS_FUTURE), F.lit("future"))
        .when(ts < now - interval(S.SUSPICIOUS_PAST), F.lit("past"))
        .otherwise(F.lit(None).cast("string"))
    )
    return validated.withColumn("suspicious", kind).withColumn("lead_seconds", lead)


def encode_messages(df: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Keyed raw-topic messages (S3): key = sensor id, value = JSON.

    The time is written as ISO-8601 text with microseconds; the key gives
    per-sensor partition order on the topic.
    """
    value = F.to_json(
        F.struct(
            F.col("sensor_id"),
            iso_string("timestamp").alias("timestamp"),
            F.col("temperature"),
            F.col("humidity"),
        )
    )
    return df.select(
        *(carry or []),
        F.col("sensor_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


def ingest(df: DataFrame, as_of: AsOf, carry: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Q4: validate, then (messages for the raw topic, rejects with reasons).

    Both outputs come from one validated plan; persist ``df`` upstream when
    both are written, so the source is scanned once.
    """
    checked = validate(df, as_of)
    messages = encode_messages(checked.where("accepted"), carry)
    rejects = checked.where(~F.col("accepted")).drop("accepted")
    return messages, rejects


def ingest_stats(validated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A5: attempted, accepted, rejected, span and accepted rate per second.

    The span is max - min of the parseable reading times in seconds; the
    rate is 0 when the span is 0 (one instant), as a client counter would.
    """
    ts = F.col("timestamp")
    span = (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(1_000_000.0)
    aggs = [
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("accepted")).alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"),
        F.coalesce(span, F.lit(0.0)).alias("span_seconds"),
    ]
    grouped = validated.groupBy(*(by or [])).agg(*aggs)
    rate = F.when(F.col("span_seconds") > 0, F.col("accepted") / F.col("span_seconds")).otherwise(F.lit(0.0))
    return grouped.withColumn("rate_per_second", rate)
