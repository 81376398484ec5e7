"""Ingest validation (FIXTURES F1), accounting, message encoding."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators.codec import decode_readings
from tidemark.operators.ingest import encode_messages, flag_suspicious, ingest, ingest_stats, validate
from tidemark.schemas import INGEST_MESSAGE

AS_OF = "2025-11-15 12:00:00"
BASE = {"sensor_id": "s1", "timestamp": "2025-11-15T12:00:00Z", "temperature": "22.5", "humidity": "55.0"}


def check(spark, **changes):
    row = {**BASE, **changes}
    df = spark.createDataFrame([tuple(row[f.name] for f in INGEST_MESSAGE.fields)], INGEST_MESSAGE)
    out = validate(df, AS_OF).collect()[0]
    return out


@pytest.mark.parametrize(
    "changes,reason",
    [
        ({}, ""),
        ({"temperature": None}, "missing:temperature"),
        ({"humidity": "150.0"}, "humidity_out_of_range"),
        ({"temperature": "-273.15"}, ""),
        ({"temperature": "200.0"}, ""),
        ({"temperature": "200.01"}, "temperature_out_of_range"),
        ({"humidity": "0"}, ""),
        ({"humidity": "100"}, ""),
        ({"temperature": "NaN"}, "temperature_out_of_range"),
        ({"temperature": "Infinity"}, "temperature_out_of_range"),
        ({"sensor_id": ""}, "sensor_id_length"),
        ({"sensor_id": "x" * 101}, "sensor_id_length"),
        ({"sensor_id": "x" * 100}, ""),
        ({"sensor_id": "x" * 51}, ""),
        ({"timestamp": "2025-11-16T12:00:00Z"}, ""),
        ({"timestamp": "2025-11-14T12:00:00Z"}, ""),
        ({"timestamp": "2025-11-16T12:00:01Z"}, "timestamp_future"),
        ({"timestamp": "2025-11-14T11:59:59Z"}, "timestamp_past"),
        ({"timestamp": "2025-11-15T14:00:00+02:00"}, ""),
        ({"timestamp": "2025-11-15T12:00:00"}, ""),
        ({"timestamp": "junk"}, "timestamp_unparseable"),
        ({"timestamp": "1763208000000"}, "timestamp_unparseable"),
        ({"temperature": "abc"}, "temperature_invalid"),
        ({"temperature": None, "humidity": None}, "missing:temperature;missing:humidity"),
    ],
)
def test_validation_cases(spark, changes, reason):
    out = check(spark, **changes)
    assert out["reason"] == reason
    assert out["accepted"] == (reason == "")


def test_offset_time_equals_utc(spark):
    a = check(spark, timestamp="2025-11-15T14:00:00+02:00")["timestamp"]
    b = check(spark, timestamp="2025-11-15T12:00:00Z")["timestamp"]
    assert a == b


def test_numeric_string_is_accepted_and_typed(spark):
    out = check(spark, temperature="22.5")
    assert out["temperature"] == 22.5 and out["accepted"]


def test_suspicious_flags(spark):
    rows = [
        ("a", "2025-11-15T12:05:01Z", "20", "50"),
        ("b", "2025-11-15T01:59:59Z", "20", "50"),
        ("c", "2025-11-15T12:04:59Z", "20", "50"),
    ]
    df = spark.createDataFrame(rows, INGEST_MESSAGE)
    out = {r["sensor_id"]: r for r in flag_suspicious(validate(df, AS_OF), AS_OF).collect()}
    assert out["a"]["suspicious"] == "future" and out["a"]["lead_seconds"] == 301.0
    assert out["b"]["suspicious"] == "past" and out["b"]["lead_seconds"] == -36001.0
    assert out["c"]["suspicious"] is None
    assert all(r["accepted"] for r in out.values())


def test_ingest_splits_and_round_trips(spark):
    rows = [
        ("s1", "2025-11-15T12:00:00.123456Z", "22.5", "55"),
        ("s2", "2025-11-15T12:00:00Z", "22.5", "150"),
    ]
    df = spark.createDataFrame(rows, INGEST_MESSAGE)
    messages, rejects = ingest(df, AS_OF)
    assert [r["reason"] for r in rejects.collect()] == ["humidity_out_of_range"]
    decoded = decode_readings(messages, carry=["key"]).collect()
    assert len(decoded) == 1
    r = decoded[0]
    assert bytes(r["key"]) == b"s1" and r["sensor_id"] == "s1"
    assert r["timestamp"].microsecond == 123456 and r["temperature"] == 22.5 and r["humidity"] == 55.0


def test_iso_text_like_python(spark):
    df = spark.createDataFrame([("s", "2025-11-15T12:00:00Z", "1", "2")], INGEST_MESSAGE)
    value = encode_messages(validate(df, AS_OF)).select(F.col("value").cast("string")).first()[0]
    assert '"timestamp":"2025-11-15T12:00:00+00:00"' in value


def test_ingest_stats(spark):
    rows = [
        ("a", "2025-11-15T12:00:00Z", "1", "1"),
        ("a", "2025-11-15T12:00:10Z", "1", "1"),
        ("b", "2025-11-15T12:00:05Z", "999", "1"),
    ]
    df = validate(spark.createDataFrame(rows, INGEST_MESSAGE), AS_OF)
    total = ingest_stats(df).first()
    assert (total["attempted"], total["accepted"], total["rejected"]) == (3, 2, 1)
    assert total["span_seconds"] == 10.0 and math.isclose(total["rate_per_second"], 0.2)
    per = {r["sensor_id"]: r for r in ingest_stats(df, ["sensor_id"]).collect()}
    assert per["b"]["rate_per_second"] == 0.0  # one instant: span 0
