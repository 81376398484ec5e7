"""Raw parse (F2), envelope (F3), table conformance (F4), collapse, purge."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tidemark.operators.codec import decode_envelope, decode_readings, encode_envelope
from tidemark.operators.table import (
    collapse_updates,
    conform_table,
    duplicate_updates,
    purge_sensors,
    split_dead_letters,
)
from tidemark.schemas import WINDOW_MEAN


def test_raw_parse_cases(spark):
    values = [
        '{"sensor_id":"a","timestamp":"2025-11-15T10:30:00.123456+00:00","temperature":22.5,"humidity":1}',
        "not json",
        "",
        None,
        '{"schema":{},"payload":{"sensor_id":"x"}}',
        '{"sensor_id":"b","timestamp":1763202600000,"temperature":1.0,"humidity":2.0}',
        '{"sensor_id":"b","timestamp":"2025-11-15T10:30:00Z","temperature":"22.5","humidity":"x"}',
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    out = {r["i"]: r for r in decode_readings(df, carry=["i"]).collect()}
    assert out[0]["sensor_id"] == "a" and out[0]["timestamp"] == dt.datetime(2025, 11, 15, 10, 30, 0, 123456)
    assert out[0]["humidity"] == 1.0
    for i in (1, 2, 3, 4):
        assert (out[i]["sensor_id"], out[i]["timestamp"], out[i]["temperature"]) == (None, None, None)
    assert out[5]["sensor_id"] == "b" and out[5]["timestamp"] is None
    assert out[6]["temperature"] is None and out[6]["humidity"] is None


def test_envelope_round_trip_and_defects(spark):
    means = spark.createDataFrame([("s1", 1700000000000, 22.5, 55.0)], WINDOW_MEAN)
    good = encode_envelope(means).select("value")
    bad = spark.createDataFrame(
        [
            ('{"schema":{"type":"struct"},"payload":{"sensor_id":"s1","timestamp":1,"temperature":1.0}}',),
            ('{"payload":{"sensor_id":"s1","timestamp":1,"temperature":1.0,"humidity":2.0}}',),
            ('{"schema":{"type":"struct"},"payload":{"sensor_id":"s1","timestamp":"2025-01-01","temperature":1.0,"humidity":2.0}}',),
            ("not json",),
        ],
        "value string",
    )
    out = decode_envelope(good.unionByName(bad)).collect()
    reasons = sorted(r["reason"] for r in out)
    assert reasons == sorted(
        ["", "payload_missing:humidity", "schema_missing", "payload_missing:timestamp", "envelope_malformed"]
    )
    ok = [r for r in out if r["reason"] == ""][0]
    assert (ok["sensor_id"], ok["timestamp"], ok["temperature"], ok["humidity"]) == ("s1", 1700000000000, 22.5, 55.0)
    assert ok["schema_name"] == "analytics_data"
    text = good.first()["value"]
    assert '"fields":[{"field":"sensor_id","type":"string","optional":false}' in text
    assert '{"field":"timestamp","type":"int64","optional":false}' in text


def test_table_rounding_and_dead_letters(spark):
    rows = [
        ("a", 1, 2.345, 2.675),
        ("b", 2, -2.345, 1.005),
        ("c", 3, 1234.5, 1.0),
        ("d" * 51, 4, 1.0, 1.0),
        ("e", 5, None, 1.0),
        (None, 6, 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "sensor_id string, timestamp long, temperature double, humidity double")
    good, dead = split_dead_letters(conform_table(df, "2025-01-01 00:00:00"))
    g = {r["sensor_id"]: r for r in good.collect()}
    assert g["a"]["temperature"] == Decimal("2.35") and g["a"]["humidity"] == Decimal("2.68")
    assert g["b"]["temperature"] == Decimal("-2.35") and g["b"]["humidity"] == Decimal("1.01")
    assert g["a"]["created_at"] == dt.datetime(2025, 1, 1)
    d = {r["timestamp"]: r["reason"] for r in dead.collect()}
    assert d == {
        3: "decimal_overflow:temperature",
        4: "sensor_id_too_long",
        5: "null_measure:temperature",
        6: "null_key:sensor_id",
    }
    assert all(r["raw_value"] for r in dead.collect())


def test_collapse_and_duplicates(spark):
    log = spark.createDataFrame(
        [("a", 0, 0, 10.0, 1.0), ("a", 0, 1, 15.0, 1.0), ("a", 0, 3, 43.0, 1.0), ("b", 0, 2, 1.0, 1.0)],
        "sensor_id string, timestamp long, batch_id long, temperature double, humidity double",
    )
    last = {r["sensor_id"]: r["temperature"] for r in collapse_updates(log, "last").collect()}
    first = {r["sensor_id"]: r["temperature"] for r in collapse_updates(log, "first").collect()}
    assert last == {"a": 43.0, "b": 1.0} and first == {"a": 10.0, "b": 1.0}
    dups = sorted(r["batch_id"] for r in duplicate_updates(log).collect())
    assert dups == [1, 3]


def test_purge_by_list_and_frame(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "sensor_id string, timestamp long")
    assert sorted(r[0] for r in purge_sensors(df, ["a", "c"]).collect()) == ["b"]
    ids = spark.createDataFrame([("b",), ("b",)], "id string")
    assert sorted(r[0] for r in purge_sensors(df, ids).collect()) == ["a", "c"]


def test_exact_mean_is_exact_and_order_free(spark):
    from fractions import Fraction

    from tidemark.functions.numeric import exact_mean

    values = [6.55, -3.000001, 199.99, -273.15, 1e12, 0.000001, -0.000001, 42.5]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)] + [(1, None)], "g int, x double")
    want = float(sum(Fraction(str(v)) for v in values) / len(values))
    for parts in (1, 3, 7):
        got = df.repartition(parts).agg(exact_mean("x").alias("m")).first()["m"]
        assert got == want
    per = {r["g"]: r["m"] for r in df.groupBy("g").agg(exact_mean("x").alias("m")).collect()}
    assert per[0] == float(sum(Fraction(str(v)) for v in values[0::3]) / 3)


def test_exact_mean_leaves_no_value_out(spark):
    import math

    from tidemark.functions.numeric import exact_mean

    rows = [("big", 1e13), ("big", 0.0), ("nan", float("nan")), ("nan", 2.0), ("small", 4e-7), ("small", 4e-7), ("inf", float("inf")), ("inf", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["m"] for r in df.groupBy("g").agg(exact_mean("x").alias("m")).collect()}
    assert got["big"] == 5e12 and math.isnan(got["nan"]) and got["small"] == 4e-7 and got["inf"] == float("inf")


def test_envelope_dead_letters_keep_source_coordinates(spark):
    from tidemark.operators.codec import decode_envelope

    raw = spark.createDataFrame(
        [
            ("analytics-data", 0, 41, b'{"payload":{"sensor_id":"s1","timestamp":1,"temperature":1.0,"humidity":2.0}}'),
            ("analytics-data", 0, 42, b"not json"),
        ],
        "topic string, partition int, offset long, value binary",
    )
    out = decode_envelope(raw, carry=["topic", "partition", "offset"])
    dead = {r["offset"]: (r["topic"], r["reason"], r["raw_value"]) for r in out.where("NOT decoded").collect()}
    assert dead[41][:2] == ("analytics-data", "schema_missing") and dead[41][2].startswith('{"payload"')
    assert dead[42] == ("analytics-data", "envelope_malformed", "not json")
