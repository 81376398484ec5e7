"""Inputs that the derived fixtures rarely hold: null labels and samples, large
values, equal times, bounded reads, malformed raw messages, missing shared folder."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.time import parse_timestamp
from tidemark.operators import metrics
from tidemark.operators.codec import label_messages
from tidemark.operators.ingest import validate
from tidemark.session import checkpoint_root
from tidemark.sources.samples import read_samples
from tidemark.sources.store import compact_table, purge_table, read_table, write_table
from tidemark.streaming.wiring import raw_rejects, window_stream

T0 = dt.datetime(2025, 11, 15, 23, 59, 0)
KIND = "metric string, namespace string, pod string, container string, ts timestamp, value {}"


def samples(spark, points, kind="decimal(38,6)", container="c"):
    rows = [("m", "n", "p", container, T0 + dt.timedelta(seconds=s), v) for s, v in points]
    return spark.createDataFrame(rows, KIND.format(kind))


def increase(df, **kw):
    got = metrics.counter_rate(df, "10 minutes", "10 minutes", **kw).collect()
    return {r["t"]: r["increase"] for r in got}


@pytest.mark.parametrize("container", ["c", "", None])
def test_rate_across_midnight_with_null_label(spark, container):
    points = [(s, Decimal(100 + s)) for s in (0, 30, 90, 120)]
    got = metrics.counter_rate(samples(spark, points, container=container), "20 minutes", "10 minutes").collect()
    by_time = {r["t"].strftime("%H:%M"): r["increase"] for r in got}
    assert by_time == {"00:00": Decimal(30), "00:10": Decimal(120), "00:20": Decimal(30)}  # the pair over midnight counts


def test_null_and_nan_samples_are_no_reset(spark):
    points = [(0, Decimal(1000)), (15, Decimal(1010)), (30, None), (45, Decimal(1030))]
    assert set(increase(samples(spark, points)).values()) == {Decimal(30)}
    points = [(0, 1000.0), (15, float("nan")), (30, 1030.0)]
    assert set(increase(samples(spark, points, "double")).values()) == {30.0}


def test_large_deltas_and_equal_times(spark):
    points = [(0, Decimal(0)), (15, Decimal(2 * 10**13)), (30, Decimal(10**30))]
    assert set(increase(samples(spark, points)).values()) == {Decimal(10**30)}
    tied = [(0, Decimal(1)), (15, Decimal(5)), (15, Decimal(3)), (30, Decimal(9))]
    assert {tuple(increase(samples(spark, tied).repartition(n)).values()) for n in (1, 3)} == {(Decimal(8),)}
    newest = metrics.last_not_null(samples(spark, tied[:3])).first()
    assert newest["value"] == Decimal(5)


def test_bounded_rate_equals_unbounded_and_reads_its_range(spark, scratch):
    df = samples(spark, [(s, Decimal(s * s)) for s in range(0, 7200, 20)])
    df.write.parquet(f"{scratch}/samples")
    stored = read_samples(spark, f"{scratch}/samples")
    start, end = "2025-11-16 00:30:00", "2025-11-16 01:00:00"
    key = lambda r: (r["t"], r["increase"])
    bounded = metrics.counter_rate(stored, "5 minutes", "1 minute", start, end)
    everything = metrics.counter_rate(stored, "5 minutes", "1 minute").where(F.col("t").between(start, end))
    assert sorted(map(key, bounded.collect())) == sorted(map(key, everything.collect()))
    for plan in (bounded, metrics.instant_value(stored, "1 minute", "5 minutes", start, end)):
        text = plan._jdf.queryExecution().toString()
        pushed = [x for x in text.splitlines() if "PushedFilters" in x]
        assert pushed and all("GreaterThan(ts," in x and "LessThanOrEqual(ts," in x for x in pushed)


def test_share_without_partition_has_no_cross_join(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "namespace string, value double")
    out = metrics.share_of_total(df, "value", partition=[])
    assert sorted((r["namespace"], r["share"]) for r in out.collect()) == [("a", 0.25), ("b", 0.75)]
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_samples_with_label_map_and_double_value(spark, scratch):
    rows = [("m", {"namespace": "n", "pod": "p"}, T0, 1.5)]
    spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp, value double").write.parquet(f"{scratch}/s")
    got = read_samples(spark, f"{scratch}/s").first()
    assert (got["namespace"], got["pod"], got["container"], got["value"]) == ("n", "p", None, 1.5)


@pytest.mark.parametrize(
    ("text", "ok"),
    [
        ("2025-11-15T12:30:00Z", True), ("2025-11-15 12:30:00.123+02:00", True), ("2025-11-15T12:30", True),
        ("12:30", False), ("T12:30:00", False), ("2025-11-15", False), ("2025", False), ("junk", False), (None, False),
    ],
)
def test_reading_times_need_a_date_and_a_time(spark, text, ok):
    got = spark.createDataFrame([(text,)], "t string").select(parse_timestamp("t").alias("t")).first()["t"]
    assert (got is not None) == ok


@pytest.mark.parametrize(("text", "ok"), [("22.5", True), ("-1e1", True), (".5", True), ("22.5d", False), ("22.5f", False), ("0x1p3", False), ("NaN", False)])
def test_numbers_in_text(spark, text, ok):
    df = spark.createDataFrame([("s", "2025-11-15T12:00:00Z", text, "50")], "sensor_id string, timestamp string, temperature string, humidity string")
    assert validate(df, "2025-11-15 12:00:00").first()["accepted"] == ok


RAW = [
    b'{"sensor_id":"s","timestamp":"2025-11-15T10:00:00Z","temperature":1.0,"humidity":2.0}',
    b"not json",
    b"",
    None,
    b'{"timestamp":"2025-11-15T10:00:00Z","temperature":1.0,"humidity":2.0}',
    b'{"sensor_id":"s","timestamp":"10:00","temperature":1.0,"humidity":2.0}',
    b'{"sensor_id":"s","temperature":1.0,"humidity":2.0}',
    b'{"sensor_id":"s","timestamp":"2025-11-15T10:00:01Z","temperature":"x","humidity":2.0}',
]


def test_raw_messages_are_accepted_or_rejected(spark):
    raw = spark.createDataFrame([("sensor-data", 0, i, v) for i, v in enumerate(RAW)], "topic string, partition int, offset long, value binary")
    assert label_messages(raw).count() == len(RAW)
    rejects = {r["offset"]: r["reason"] for r in raw_rejects(raw).collect()}
    assert rejects == {
        1: "message_malformed", 2: "message_malformed", 3: "message_malformed",
        4: "missing:sensor_id", 5: "timestamp_unparseable", 6: "missing:timestamp",
    }
    assert [(r["temperature"], r["humidity"]) for r in window_stream(raw).collect()] == [(1.0, 2.0)]


def test_purge_rewrites_the_stored_table(spark, scratch):
    df = spark.createDataFrame([("a", 1, 0), ("b", 2, 0), ("a", 3, 1)], "sensor_id string, timestamp long, batch_id long")
    write_table(df, f"{scratch}/t")
    purge_table(spark, f"{scratch}/t", f"{scratch}/u", ["a"])
    assert [(r["sensor_id"], r["batch_id"]) for r in spark.read.parquet(f"{scratch}/u").collect()] == [("b", 0)]


def test_compacted_days_read_back_once(spark, scratch):
    day = 86_400_000
    kind = "sensor_id string, timestamp long, batch_id long, temperature double, humidity double, created_at timestamp"
    row = lambda t, b, v: ("a", t, b, v, v, T0)
    batches = [[row(0, 0, 1.0), row(day, 0, 1.0)], [row(0, 1, 2.0), row(day, 1, 2.0), row(2 * day, 1, 1.0)]]
    path = f"{scratch}/table"
    for b in batches:
        write_table(spark.createDataFrame(b, kind), path)
    read = lambda **kw: sorted((r["timestamp"] // day, r["temperature"]) for r in read_table(spark, path, **kw).collect())
    want = [(0, 2.0), (1, 2.0), (2, 1.0)]
    assert read() == want
    compact_table(spark, path, "1970-01-02")
    assert read() == want and read(dates=("1970-01-02", "1970-01-03")) == want[1:]
    write_table(spark.createDataFrame(batches[1], kind), path)  # a replay after compaction
    assert read() == want
    compact_table(spark, path, "1970-01-03")
    assert read() == want and read(dates=("1970-01-01", "1970-01-01")) == want[:1]


def test_shared_folder_is_required_off_local(spark):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())
