"""Window means batch = stream, late data (F6), idempotent table sink."""

from __future__ import annotations

import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.operators.windows import window_mean
from tidemark.schemas import RAW_RECORD
from tidemark.sources.store import read_table
from tidemark.sources.topic import read_raw_files
from tidemark.streaming.wiring import dropped_by_watermark, table_batch_writer, window_stream

DAY = dt.date(2025, 11, 15)


def _raw_file(path: str, rows: list[tuple[str, float]], offset0: int, mtime: float) -> None:
    """One raw-topic file: (time 'HH:MM:SS', temperature) for sensor a."""
    records = []
    for i, (clock, temp) in enumerate(rows):
        value = {"sensor_id": "a", "timestamp": f"{DAY}T{clock}+00:00", "temperature": temp, "humidity": 50.0}
        records.append(
            {
                "key": b"a",
                "value": json.dumps(value).encode(),
                "topic": "sensor-data",
                "partition": 0,
                "offset": offset0 + i,
                "timestamp": dt.datetime(2025, 11, 15, 12, 0, 0),
            }
        )
    schema = pa.schema(
        [("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
         ("offset", pa.int64()), ("timestamp", pa.timestamp("us"))]
    )
    pq.write_table(pa.Table.from_pylist(records, schema=schema), path)
    os.utime(path, (mtime, mtime))


def _run(spark, folder, batches, output_mode="update"):
    os.makedirs(f"{folder}/raw")
    for i, rows in enumerate(batches):
        _raw_file(f"{folder}/raw/part-{i:03d}.parquet", rows, i * 10, 1_700_000_000 + i * 10)
    means = window_stream(read_raw_files(spark, f"{folder}/raw", max_files_per_trigger=1), "30 seconds", "1 minute")
    emitted: dict[int, list] = {}

    def collect(df, batch_id):
        emitted[batch_id] = sorted((r["timestamp"], r["temperature"]) for r in df.collect())

    q = (
        means.writeStream.outputMode(output_mode)
        .foreachBatch(collect)
        .option("checkpointLocation", f"{folder}/ckpt")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return emitted, q


def at(clock: str) -> int:
    t = dt.datetime.combine(DAY, dt.time.fromisoformat(clock), tzinfo=dt.timezone.utc)
    return int(t.timestamp() * 1000)


def test_late_data_one_batch_lag(spark, scratch):
    batches = [
        [("10:00:01", 10.0)],
        [("10:00:02", 20.0)],
        [("10:05:00", 1.0)],
        [("10:00:03", 99.0), ("10:04:10", 7.0), ("10:03:50", 8.0)],
    ]
    emitted, _ = _run(spark, scratch, batches)
    got = [emitted[b] for b in sorted(emitted) if emitted[b]]
    assert got == [
        [(at("10:00:00"), 10.0)],
        [(at("10:00:00"), 15.0)],
        [(at("10:05:00"), 1.0)],
        [(at("10:00:00"), 43.0), (at("10:03:30"), 8.0), (at("10:04:00"), 7.0)],
    ]


def test_late_rows_dropped_after_watermark_moves(spark, scratch):
    batches = [
        [("10:00:01", 10.0)],
        [("10:00:02", 20.0)],
        [("10:05:00", 1.0)],
        [("10:05:01", 3.0)],
        [("10:00:03", 99.0), ("10:04:10", 7.0), ("10:03:50", 8.0), ("10:03:10", 9.0)],
    ]
    emitted, q = _run(spark, scratch, batches)
    got = [emitted[b] for b in sorted(emitted) if emitted[b]]
    assert got[3] == [(at("10:05:00"), 2.0)]
    assert got[4] == [(at("10:04:00"), 7.0)]
    # Three late rows counted as dropped (FIXTURES F6: 10:00:03, 10:03:50, 10:03:10).
    assert dropped_by_watermark(q) == 3


def test_batch_equals_stream(spark, scratch):
    batches = [[("10:00:01", 10.0), ("10:00:40", 4.0)], [("10:00:02", 20.0), ("10:01:05", 6.0)]]
    emitted, _ = _run(spark, scratch, batches)
    final: dict = {}
    for b in sorted(emitted):
        for ts, temp in emitted[b]:
            final[ts] = temp
    raw = spark.read.schema(RAW_RECORD).parquet(f"{scratch}/raw")
    from tidemark.operators.codec import decode_readings

    batch = {r["timestamp"]: r["temperature"] for r in window_mean(decode_readings(raw), "30 seconds").collect()}
    assert batch == final


def test_table_sink_replay_is_idempotent(spark, scratch):
    writer = table_batch_writer(f"{scratch}/table", f"{scratch}/dead", as_of="2025-01-01 00:00:00")
    df = spark.createDataFrame(
        [("a", 1, 1.234, 2.0), ("b", 1, None, 2.0)],
        "sensor_id string, timestamp long, temperature double, humidity double",
    )
    writer(df, 0)
    writer(df, 0)  # replay of the same batch after a failure
    later = spark.createDataFrame([("a", 1, 5.0, 2.0)], "sensor_id string, timestamp long, temperature double, humidity double")
    writer(later, 1)
    last = read_table(spark, f"{scratch}/table", policy="last").collect()
    first = read_table(spark, f"{scratch}/table", policy="first").collect()
    assert [(r["sensor_id"], float(r["temperature"])) for r in last] == [("a", 5.0)]
    assert [(r["sensor_id"], float(r["temperature"])) for r in first] == [("a", 1.23)]
    dead = spark.read.parquet(f"{scratch}/dead").collect()
    assert len(dead) == 1 and dead[0]["reason"] == "null_measure:temperature"


def test_archive_appends_closed_windows_once(spark, scratch):
    from tidemark.streaming.wiring import start_archive

    os.makedirs(f"{scratch}/raw")
    batches = [[("10:00:01", 10.0)], [("10:00:02", 20.0)], [("10:05:00", 1.0)], [("10:05:01", 3.0)]]
    for i, rows in enumerate(batches):
        _raw_file(f"{scratch}/raw/part-{i:03d}.parquet", rows, i * 10, 1_700_000_000 + i * 10)
    means = window_stream(read_raw_files(spark, f"{scratch}/raw", max_files_per_trigger=1), "30 seconds", "1 minute")
    start_archive(means, f"{scratch}/archive", f"{scratch}/ckpt", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{scratch}/archive").collect()
    assert [(r["timestamp"], r["temperature"], str(r["date"])) for r in rows] == [(at("10:00:00"), 15.0, "2025-11-15")]


def test_failed_batch_is_replayed_once_after_restart(spark, scratch):
    """A micro-batch that dies after writing the table (before its dead
    letters) is replayed from the checkpoint; its partition is replaced, so
    the table still holds exactly one copy of every window."""
    from pyspark.errors import StreamingQueryException

    from tidemark.streaming.wiring import start_table_sink

    os.makedirs(f"{scratch}/raw")
    batches = [[("10:00:01", 10.0)], [("10:00:02", 20.0), ("10:01:00", 4.0)]]
    for i, rows in enumerate(batches):
        _raw_file(f"{scratch}/raw/part-{i:03d}.parquet", rows, i * 10, 1_700_000_000 + i * 10)

    def means():
        return window_stream(read_raw_files(spark, f"{scratch}/raw", max_files_per_trigger=1), "30 seconds", "1 minute")

    table, dead, ckpt = f"{scratch}/table", f"{scratch}/dead", f"{scratch}/ckpt"
    real = table_batch_writer(table, dead, as_of="2025-01-01 00:00:00")

    def crashing(df, batch_id):
        real(df, batch_id)  # table and dead letters written ...
        if batch_id == 1:
            raise RuntimeError("executor lost")  # ... but the batch never commits

    q = (
        means().writeStream.outputMode("update").foreachBatch(crashing)
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    )
    try:
        q.awaitTermination()
    except StreamingQueryException:
        pass
    start_table_sink(means(), table, dead, ckpt, available_now=True, as_of="2025-01-01 00:00:00").awaitTermination()
    stored = spark.read.parquet(table)
    per_key = {(r["timestamp"], r["batch_id"]): r["n"] for r in stored.groupBy("timestamp", "batch_id").count().withColumnRenamed("count", "n").collect()}
    assert per_key == {(at("10:00:00"), 0): 1, (at("10:00:00"), 1): 1, (at("10:01:00"), 1): 1}
    final = {r["timestamp"]: float(r["temperature"]) for r in read_table(spark, table).collect()}
    assert final == {at("10:00:00"): 15.0, at("10:01:00"): 4.0}


def test_window_mean_accepts_ntz_time(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2025, 11, 15, 10, 0, 1), 10.0, 1.0), ("a", dt.datetime(2025, 11, 15, 10, 0, 29), 20.0, 3.0)],
        "sensor_id string, timestamp timestamp_ntz, temperature double, humidity double",
    )
    out = window_mean(df, "30 seconds").collect()
    assert [(r["timestamp"], r["temperature"], r["humidity"]) for r in out] == [(at("10:00:00"), 15.0, 2.0)]


def test_rocksdb_state_store(spark, scratch):
    from tidemark.session import ROCKSDB_PROVIDER

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        emitted, _ = _run(spark, scratch, [[("10:00:01", 10.0)], [("10:00:02", 20.0)]])
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    got = [emitted[b] for b in sorted(emitted) if emitted[b]]
    assert got == [[(at("10:00:00"), 10.0)], [(at("10:00:00"), 15.0)]]
    suffixes = {f.rsplit(".", 1)[-1] for _, _, fs in os.walk(f"{scratch}/ckpt/state") for f in fs}
    assert "sst" in suffixes  # state kept in RocksDB files


def test_arrivals_are_dealt_in_proportion_to_their_rows(spark, scratch, monkeypatch):
    """The events lie in one split of one file; each arrival is still encoded, written and read by several tasks."""
    from tidemark.plans import derived as P
    from tidemark.plans import streaming_queries as Q

    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=i), i % 7, "view", float(i % 90), json.dumps({"k": i % 100})) for i in range(400)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.coalesce(1).write.parquet(f"{scratch}/events.parquet")
    monkeypatch.setattr(Q, "MESSAGES_PER_TASK", 25)
    paths = Q.run_stream(spark, scratch)
    raw = spark.read.parquet(paths["raw"]).select("offset", F.input_file_name().alias("file"))
    per_file = {r["file"]: r["n"] for r in raw.groupBy("file").agg(F.count("*").alias("n")).collect()}
    assert len(per_file) == 16 and max(per_file.values()) <= 50
    assert sorted(r[0] for r in raw.select("offset").collect()) == sorted(r["event_id"] for r in P.accepted(spark, scratch).collect())
    got = {tuple(r) for r in Q.stream_window_mean(spark, scratch).select("sensor_id", "timestamp").collect()}
    assert got == {tuple(r) for r in P.window_means(spark, scratch, "1 day").select("sensor_id", "timestamp").collect()}


def test_envelopes_keep_the_text_of_those_that_do_not_decode(spark):
    from tidemark.operators.codec import encode_envelope
    from tidemark.streaming.wiring import _decoded, split_envelopes

    means = spark.createDataFrame([("a", 0, 1.5, 2.5), ("b", 30000, 3.5, 4.5)], "sensor_id string, timestamp long, temperature double, humidity double")
    bad = spark.createDataFrame([("not json",)], "value string")
    stored = encode_envelope(means).union(bad).withColumn("batch_id", F.lit(0).cast("long"))
    assert [r["raw_value"] for r in _decoded(stored).orderBy("raw_value").collect()] == [None, None, "not json"]
    good, dead = split_envelopes(stored)
    assert sorted(r["sensor_id"] for r in good.collect()) == ["a", "b"]
    assert [r["raw_value"] for r in dead.collect()] == ["not json"]
