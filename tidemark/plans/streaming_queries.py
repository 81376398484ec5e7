"""Registered queries that run through the streaming and archive paths.

``stream_window_mean``: the accepted readings are written as raw-topic
files in offset order, in ``CHUNKS`` arrivals. After each arrival the
stream is (re)started from the same checkpoint with ``availableNow``, so
each arrival is one micro-batch, window state carries over restarts, and
update mode re-emits windows that span arrivals. The table sink keeps every
update per batch; reading with policy ``last`` gives one row per key.
All files live under the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.codec import encode_envelope
from tidemark.operators.ingest import encode_messages
from tidemark.operators.table import collapse_updates, duplicate_updates
from tidemark.plans import derived as P
from tidemark.session import scratch_path
from tidemark.sources.store import compact_table, read_archive, read_table, write_archive
from tidemark.sources.summaries import compact_summaries
from tidemark.sources.topic import raw_records, read_raw_files
from tidemark.streaming.wiring import (
    open_windows,
    raw_rejects,
    run_until_stopped,
    split_envelopes,
    start_accounted_sink,
    start_archive,
    start_reject_sink,
    start_table_sink,
    window_stream,
)

CHUNKS = 4
STATE_PARTITIONS = 8  # fixed by a checkpoint for its life, so no function of this machine
MESSAGES_PER_TASK = 50_000  # of one arrival; a message is encoded, written, read and decoded in about 25 microseconds


def _accepted(spark: SparkSession, sf_dir: str, chunks: int) -> DataFrame:
    """The accepted readings, each of ``chunks`` arrivals in tasks (so files of the topic) in proportion to its rows.

    An arrival is a range of offsets, so a few row groups of the table: as they lie, one task would work through it."""
    rows = P.driver_table(spark, sf_dir, "events").count()  # from the file footers
    tasks = -(-rows // (chunks * MESSAGES_PER_TASK))
    return P.accepted(spark, sf_dir, tasks if tasks > 1 else None)


def _arrivals(readings: DataFrame, chunks: int) -> list[tuple[int, int]]:
    """Offset ranges [lo, hi) of each arrival (one-row aggregate on the driver)."""
    bounds = readings.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return []
    lo, hi = int(bounds["lo"]), int(bounds["hi"]) + 1
    step = max(1, -(-(hi - lo) // chunks))
    return [(a, min(a + step, hi)) for a in range(lo, hi, step)]


def _defective(messages: DataFrame) -> DataFrame:
    """Raw messages as a real topic carries them: some are no JSON, some have no
    readable time or no sensor id, and some sensor ids are too long for the table."""
    kind = F.pmod("offset", F.lit(29))
    text = F.col("value").cast("string")
    text = (
        F.when(kind == 7, F.lit("not json"))
        .when(kind == 11, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
        .when(kind == 13, F.regexp_replace(text, '"sensor_id":"[^"]*",', ""))
        .otherwise(F.regexp_replace(text, '"sensor_id":"(Sensor-[0-9]*7)"', f'"sensor_id":"$1-{"x" * 50}"'))
    )
    return messages.withColumn("value", text.cast("binary"))


_RUNS: dict[tuple, dict[str, str]] = {}


def run_stream(spark: SparkSession, sf_dir: str, defects: bool = False) -> dict[str, str]:
    """The streaming job over all accepted readings, in ``CHUNKS`` arrivals with a
    restart after each; returns the paths of what it stored. One run per application and setting,
    as for the stored table: the queries over its tables read what one job wrote."""
    return _once(spark, sf_dir, f"stream-{defects}", lambda: _run_stream(spark, sf_dir, defects))


def _once(spark: SparkSession, sf_dir: str, name: str, run) -> dict[str, str]:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _RUNS:
        _RUNS[key] = run()
    return _RUNS[key]


def _run_stream(spark: SparkSession, sf_dir: str, defects: bool) -> dict[str, str]:
    root = scratch_path(spark, "stream")
    paths = {p: f"{root}/{p}" for p in ("raw", "envelopes", "table", "dead", "rejects", "checkpoint", "reject-checkpoint")}
    readings = _accepted(spark, sf_dir, CHUNKS)
    messages = _raw_messages(readings)
    if defects:
        messages = _defective(messages)
    for lo, hi in _arrivals(readings, CHUNKS):
        messages.where(F.col("offset").between(lo, hi - 1)).write.mode("append").parquet(paths["raw"])
        raw = read_raw_files(spark, paths["raw"])
        sinks = [
            start_table_sink(
                window_stream(raw, "1 day"), paths["table"], paths["dead"], paths["checkpoint"], available_now=True,
                as_of=P.TABLE_AS_OF, envelope_path=paths["envelopes"], state_partitions=STATE_PARTITIONS,
            )
        ]
        if defects:
            sinks.append(start_reject_sink(raw_rejects(raw), paths["rejects"], paths["reject-checkpoint"], available_now=True))
        for query in sinks:
            run_until_stopped(query)
    return paths


def run_summary_stream(spark: SparkSession, sf_dir: str, closing: tuple[str, ...]) -> dict[str, str]:
    """30-second windows in ``CHUNKS`` arrivals; the sink keeps the overview. After the second and the
    third arrival the days before the next of ``closing`` are closed in table and summaries."""
    return _once(spark, sf_dir, f"summaries-{closing}", lambda: _run_summary_stream(spark, sf_dir, closing))


def _raw_messages(readings: DataFrame) -> DataFrame:
    encoded = encode_messages(readings, carry=["event_id", "timestamp"]).withColumnRenamed("timestamp", "_ts")
    return raw_records(encoded, offset="event_id", ts="_ts")


def _run_summary_stream(spark: SparkSession, sf_dir: str, closing: tuple[str, ...]) -> dict[str, str]:
    root = scratch_path(spark, "summary-stream")
    paths = {p: f"{root}/{p}" for p in ("raw", "table", "summaries", "dead", "checkpoint")}
    readings = _accepted(spark, sf_dir, CHUNKS)
    messages = _raw_messages(readings)
    for number, (lo, hi) in enumerate(_arrivals(readings, CHUNKS)):
        messages.where(F.col("offset").between(lo, hi - 1)).write.mode("append").parquet(paths["raw"])
        query = start_table_sink(
            window_stream(read_raw_files(spark, paths["raw"])), paths["table"], paths["dead"], paths["checkpoint"], available_now=True,
            as_of=P.TABLE_AS_OF, state_partitions=STATE_PARTITIONS, summary_path=paths["summaries"],
        )
        run_until_stopped(query)
        if 1 <= number <= len(closing):
            compact_table(spark, paths["table"], closing[number - 1])
            compact_summaries(spark, paths["summaries"], closing[number - 1])
    return paths


LIMITED_FILES = 2  # files of one micro-batch
LIMITED_TRIGGER = "1 second"


def run_limited_stream(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """All messages are there at once; one run takes them in several micro-batches of ``LIMITED_FILES`` files, one per
    processing-time trigger. Files of one write come in any order, so the watermark is as wide as the data."""
    return _once(spark, sf_dir, "limited", lambda: _run_limited_stream(spark, sf_dir))


def _run_limited_stream(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    root = scratch_path(spark, "limited-stream")
    paths = {p: f"{root}/{p}" for p in ("raw", "table", "dead", "checkpoint")}
    _raw_messages(P.accepted(spark, sf_dir)).repartitionByRange(2 * CHUNKS, "offset").write.parquet(paths["raw"])
    raw = read_raw_files(spark, paths["raw"], max_files_per_trigger=LIMITED_FILES)
    query = start_table_sink(
        window_stream(raw, "1 day", watermark="60 days"), paths["table"], paths["dead"], paths["checkpoint"], trigger=LIMITED_TRIGGER,
        as_of=P.TABLE_AS_OF, state_partitions=STATE_PARTITIONS,
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return paths


def stream_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a run under an intake limit: the rows of ``stream_window_mean``."""
    paths = run_limited_stream(spark, sf_dir)
    return read_table(spark, paths["table"], policy="last").select("sensor_id", "timestamp", "temperature", "humidity")


LATE_CHUNKS = 3


def run_late_stream(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """30-second windows over messages of which some come one or two arrivals late, with an account of every message."""
    return _once(spark, sf_dir, "late", lambda: _run_late_stream(spark, sf_dir))


def _run_late_stream(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    root = scratch_path(spark, "late-stream")
    paths = {p: f"{root}/{p}" for p in ("raw", "envelopes", "table", "dead", "messages", "accounts", "checkpoint")}
    readings = _accepted(spark, sf_dir, LATE_CHUNKS)
    messages = _defective(_raw_messages(readings))
    ranges = _arrivals(readings, LATE_CHUNKS)
    if not ranges:
        return paths
    lo, step = ranges[0][0], ranges[0][1] - ranges[0][0]
    delay = F.when(F.col("offset") % 17 == 5, 1).when(F.col("offset") % 17 == 9, 2).otherwise(0)
    messages = messages.withColumn("arrival", F.floor((F.col("offset") - lo) / step) + delay)
    for arrival in range(len(ranges) + 2):
        messages.where(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(paths["raw"])
        query = start_accounted_sink(
            read_raw_files(spark, paths["raw"]), paths["table"], paths["dead"], paths["messages"], paths["accounts"], paths["checkpoint"],
            available_now=True, as_of=P.TABLE_AS_OF, envelope_path=paths["envelopes"], state_partitions=STATE_PARTITIONS,
        )
        run_until_stopped(query)
    return paths


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that the aggregate dropped as late, with their place on the topic."""
    stored = spark.read.parquet(run_late_stream(spark, sf_dir)["messages"])
    return stored.where(F.col("reason") == S.D_LATE).select("topic", "partition", "offset", "sensor_id", "event_time", "batch_id", "reason")


def stream_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of each batch: accepted, rejected and late."""
    accounts = spark.read.parquet(run_late_stream(spark, sf_dir)["accounts"])
    return accounts.select(F.col("batch_id").cast("long").alias("batch_id"), "messages", "accepted", "rejected", "late")


def late_window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that stream stored: means of all messages but the rejected and the late ones."""
    table = read_table(spark, run_late_stream(spark, sf_dir)["table"], policy="last")
    return table.select("sensor_id", "timestamp", "temperature", "humidity")


def stream_window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = run_stream(spark, sf_dir)
    return read_table(spark, paths["table"], policy="last").select("sensor_id", "timestamp", "temperature", "humidity")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages that cannot enter a window, with their place on the topic."""
    rejects = spark.read.parquet(run_stream(spark, sf_dir, defects=True)["rejects"])
    return rejects.select("topic", "partition", "offset", "reason")


def _updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All updates that the stream stored, and its dead letters."""
    paths = run_stream(spark, sf_dir, defects=True)
    return spark.read.parquet(paths["table"]), spark.read.parquet(paths["dead"])


def collapse_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = _updates(spark, sf_dir)
    return collapse_updates(stored, "last").select("sensor_id", "timestamp", "batch_id", "temperature", "humidity")


def collapse_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = _updates(spark, sf_dir)
    return collapse_updates(stored, "first").select("sensor_id", "timestamp", "batch_id", "temperature", "humidity")


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a plain-insert sink refuses: rows that the table types reject, and repeated keys."""
    stored, dead = _updates(spark, sf_dir)
    columns = ["sensor_id", "timestamp", "batch_id", "reason"]
    return dead.select(columns).union(duplicate_updates(stored).select(columns))


def _broken(envelopes: DataFrame) -> DataFrame:
    """Some envelopes lose their schema block, some a payload field, some become text."""
    kind = F.pmod(F.get_json_object("value", "$.payload.timestamp").cast("long") / F.lit(30000), F.lit(17)).cast("int")
    text = F.col("value")
    return envelopes.withColumn(
        "value",
        F.when(kind == 3, F.concat(F.lit('{"payload":'), F.get_json_object("value", "$.payload"), F.lit("}")))
        .when(kind == 5, F.regexp_replace(text, '"temperature":[-0-9.E]+,', ""))
        .when(kind == 8, F.lit("not json"))
        .when(kind == 9, F.regexp_replace(text, '"timestamp":([0-9]+)', '"timestamp":"soon"'))
        .otherwise(text),
    )


def envelope_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes that do not decode, per reason."""
    envelopes = _broken(encode_envelope(P.window_means(spark, sf_dir))).withColumn("batch_id", F.lit(0).cast("long"))
    _, dead = split_envelopes(envelopes)
    return dead.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def archive_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    write_archive(P.window_means(spark, sf_dir), path)
    return read_archive(spark, path).select("sensor_id", "timestamp", "temperature", "humidity", "date")


def run_archive_stream(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """S7 in append mode: 1-day windows in ``CHUNKS`` arrivals, a restart after each; finished windows are written once."""
    return _once(spark, sf_dir, "archive-stream", lambda: _run_archive_stream(spark, sf_dir))


def _run_archive_stream(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    root = scratch_path(spark, "archive-stream")
    paths = {p: f"{root}/{p}" for p in ("raw", "archive", "checkpoint")}
    readings = _accepted(spark, sf_dir, CHUNKS)
    messages = _raw_messages(readings)
    for lo, hi in _arrivals(readings, CHUNKS):
        messages.where(F.col("offset").between(lo, hi - 1)).write.mode("append").parquet(paths["raw"])
        means = window_stream(read_raw_files(spark, paths["raw"]), "1 day")
        run_until_stopped(start_archive(means, paths["archive"], paths["checkpoint"], available_now=True))
    return paths


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the watermark has passed."""
    archive = read_archive(spark, run_archive_stream(spark, sf_dir)["archive"])
    return archive.select("sensor_id", "timestamp", "temperature", "humidity", "date")


def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The others, from the stopped query's checkpoint."""
    return open_windows(spark, run_archive_stream(spark, sf_dir)["checkpoint"])


STREAM_QUERIES = {
    "stream_window_mean": stream_window_mean,
    "stream_rejects": stream_rejects,
    "collapse_last": collapse_last,
    "collapse_first": collapse_first,
    "dead_letters": dead_letters,
    "envelope_dead_letters": envelope_dead_letters,
    "archive_readback": archive_readback,
    "stream_limited": stream_limited,
    "stream_archive": stream_archive,
    "stream_open_windows": stream_open_windows,
    "late_rows": late_rows,
    "stream_accounts": stream_accounts,
    "late_window_mean": late_window_mean,
}
