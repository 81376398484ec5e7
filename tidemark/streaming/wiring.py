"""Streaming wiring (T1-T9, S4/S5 in foreachBatch): thin, over pure functions.

raw topic -> decode (P1/P2) -> watermark (T1) -> window mean (T2/T3) ->
update mode (T4) -> per micro-batch: envelope (P6) to the second topic's
files, read back and decoded (P7), conform (P8), split dead letters (S5),
write table rows and dead letters (S4). Raw messages that cannot enter a
window go to a reject sink of their own. The archive (S7) is a second
query in append mode: each window is written once, after the watermark
has passed its end.

The micro-batch is persisted once and released after both writes. Writes
replace the partition of their own ``batch_id``, so a batch replayed after
a failure leaves exactly one copy.

Late rows (T5) are dropped by Spark inside the aggregate. ``start_accounted_sink``
runs the windows and the raw messages as two branches of one query, so that both see the
same micro-batches: the sink knows each batch's watermark from the event
times of the batches before it, and writes the messages that the aggregate
dropped aside with the reason ``late``. Every message is then accounted for as accepted, rejected
or late.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark import schemas as S
from tidemark.operators.codec import decode_envelope, encode_envelope, label_messages
from tidemark.operators.table import TABLE_COLUMNS, conform_table, split_dead_letters
from tidemark.operators.windows import MEASURES, window_mean, with_watermark
from tidemark.functions.numeric import MEAN_STATE, mean_of_state
from tidemark.functions.time import duration_seconds, ms_to_ts, window_start_ms
from tidemark.session import ROCKSDB_PROVIDER
from tidemark.sources.store import exists, write_batch_partition, write_updates
from tidemark.sources.summaries import summarize_batch


def window_stream(
    raw: DataFrame,
    duration: str = S.WINDOW_DURATION,
    watermark: str = S.WATERMARK_DELAY,
) -> DataFrame:
    """Raw topic rows -> windowed means; same code for batch and stream.

    Messages that :func:`raw_rejects` returns take no part.
    """
    readings = label_messages(raw).where("accepted").select("sensor_id", "timestamp", "temperature", "humidity")
    return window_mean(with_watermark(readings, watermark), duration)


def raw_rejects(raw: DataFrame) -> DataFrame:
    """Raw messages that cannot enter a window: coordinates, text and reason."""
    labelled = label_messages(raw).where(~F.col("accepted"))
    return labelled.select(*[c for c in labelled.columns if c in ("topic", "partition", "offset")], "raw_value", "reason")


def start_reject_sink(
    rejects: DataFrame, path: str, checkpoint: str, trigger: str | None = S.TRIGGER_INTERVAL, available_now: bool = False
) -> StreamingQuery:
    """Append the rejects to files (exactly once by the file sink's log)."""
    writer = rejects.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def table_batch_writer(
    table_path: str,
    dead_path: str,
    as_of: dt.datetime | str | Column | None = None,
    envelope_path: str | None = None,
    summary_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function: conform, split and store one micro-batch.

    With ``envelope_path`` the means take the way of the second topic: encoded
    to envelopes, stored, read back and decoded; what does not decode is a
    dead letter. With ``summary_path`` the maintained overview is kept there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            _store_means(batch, batch_id, table_path, dead_path, as_of, envelope_path, summary_path)
        finally:
            batch.unpersist()

    return write


def _store_means(
    means: DataFrame, batch_id: int, table_path: str, dead_path: str, as_of, envelope_path: str | None, summary_path: str | None = None
) -> None:
    number = F.lit(batch_id).cast("long").alias("batch_id")
    created = as_of if as_of is not None else F.current_timestamp()
    if envelope_path is not None:
        write_batch_partition(encode_envelope(means).select("*", number), envelope_path)
        folder = f"{envelope_path.rstrip('/')}/batch_id={batch_id}"  # this batch's folder alone, however many there are
        if exists(means.sparkSession, folder):
            # decoded once: for the ranges of the rows, the rows and the dead letters
            decoded = _decoded(means.sparkSession.read.parquet(folder).select("*", number)).persist()
            try:
                _store_rows(*_split_decoded(decoded), batch_id, table_path, dead_path, created, summary_path)
            finally:
                decoded.unpersist()
            return
    _store_rows(means.select("*", number), None, batch_id, table_path, dead_path, created, summary_path)


def _store_rows(
    numbered: DataFrame, undecoded: DataFrame | None, batch_id: int, table_path: str, dead_path: str, created, summary_path: str | None
) -> None:
    labelled = conform_table(numbered, created, carry=["batch_id"])
    good, dead = split_dead_letters(labelled, keep=[*TABLE_COLUMNS, "batch_id"])
    if undecoded is not None:
        dead = dead.unionByName(undecoded, allowMissingColumns=True)
    if summary_path is not None:  # before the rows themselves: what is stored is summarized
        summarize_batch(good, batch_id, table_path, summary_path)
    write_updates(good, table_path)
    write_batch_partition(dead, dead_path)


def windows_and_messages(raw: DataFrame, duration: str = S.WINDOW_DURATION, watermark: str = S.WATERMARK_DELAY) -> DataFrame:
    """Two branches of one stream: window means (``kind`` window) and the labelled raw messages (``kind`` message)."""
    means = window_stream(raw, duration, watermark).withColumn("kind", F.lit("window"))
    messages = label_messages(raw).withColumnRenamed("timestamp", "event_time").drop("temperature", "humidity", "accepted")
    return means.unionByName(messages.withColumn("kind", F.lit("message")), allowMissingColumns=True)


def _account_before(spark, path: str, batch_id: int) -> tuple[int | None, int | None]:
    """(newest event time of all batches before, the same without the last of them), in ms."""
    folder = f"{path.rstrip('/')}/batch_id={batch_id - 1}"
    if batch_id == 0:
        return None, None
    if not exists(spark, folder):
        raise FileNotFoundError(f"{folder}: the account of the batch before is missing; restart from this checkpoint's own accounts")
    row = spark.read.parquet(folder).first()
    return row["seen_ms"], row["seen_before_ms"]


def accounted_batch_writer(
    table_path: str,
    dead_path: str,
    message_path: str,
    account_path: str,
    duration: str = S.WINDOW_DURATION,
    watermark: str = S.WATERMARK_DELAY,
    as_of: dt.datetime | str | Column | None = None,
    envelope_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function over :func:`windows_and_messages`.

    Spark drops a row whose window ends at or before the watermark of the batch
    before, which follows from the event times up to two batches back (X7). Each batch's
    account holds the newest event time so far, so a batch reads one earlier account and a
    replayed batch finds what it found the first time.
    """
    delay_ms, width_us = duration_seconds(watermark) * 1000, duration_seconds(duration) * 1_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            means = batch.where("kind = 'window'").select(*[f.name for f in S.WINDOW_MEAN.fields])
            _store_means(means, batch_id, table_path, dead_path, as_of, envelope_path)
            seen, seen_before = _account_before(spark, account_path, batch_id)
            late_ms = max(0, (seen_before or 0) - delay_ms)
            at = F.unix_micros("event_time")
            ends = at - F.pmod(at, F.lit(width_us)) + F.lit(width_us)
            coordinates = [c for c in ("topic", "partition", "offset") if c in batch.columns]
            reason = F.when(F.col("reason") != "", F.col("reason")).when(ends <= F.lit(late_ms * 1000), F.lit(S.D_LATE)).otherwise(F.lit(""))
            messages = batch.where("kind = 'message'").select(*coordinates, "sensor_id", "event_time", "raw_value", reason.alias("reason"))
            number = F.lit(batch_id).cast("long").alias("batch_id")
            write_batch_partition(messages.where("reason <> ''").select("*", number), message_path)
            entered = F.col("reason").isin("", S.D_LATE)
            account = messages.agg(
                F.count(F.lit(1)).alias("messages"),
                F.count_if(F.col("reason") == "").alias("accepted"),
                F.count_if(~entered).alias("rejected"),
                F.count_if(F.col("reason") == S.D_LATE).alias("late"),
                F.floor(F.max(F.when(entered, at)) / 1000).alias("seen_ms"),
            )
            account = account.withColumns({
                "seen_ms": F.greatest("seen_ms", F.lit(seen).cast("long")),
                "seen_before_ms": F.lit(seen).cast("long"),
                "late_before_ms": F.lit(late_ms).cast("long"),
            })
            account.coalesce(1).write.mode("overwrite").parquet(f"{account_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def start_accounted_sink(
    raw: DataFrame,
    table_path: str,
    dead_path: str,
    message_path: str,
    account_path: str,
    checkpoint: str,
    duration: str = S.WINDOW_DURATION,
    watermark: str = S.WATERMARK_DELAY,
    as_of: dt.datetime | str | Column | None = None,
    envelope_path: str | None = None,
    **start,
) -> StreamingQuery:
    """The stream into the table, with rejects, late rows and an account per batch.

    ``start`` takes the trigger, state and name arguments of :func:`start_table_sink`. The account folder
    belongs to the checkpoint: both are kept or both are removed.
    """
    write = accounted_batch_writer(table_path, dead_path, message_path, account_path, duration, watermark, as_of, envelope_path)
    return _start_update(windows_and_messages(raw, duration, watermark), write, checkpoint, **start)


def split_envelopes(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Envelopes (value, batch_id) -> (means, dead letters of those that do not decode)."""
    return _split_decoded(_decoded(stored))


def _decoded(stored: DataFrame) -> DataFrame:
    """Envelopes with their fields; the text stays of those that do not decode."""
    decoded = decode_envelope(stored, carry=["batch_id"]).drop("schema_name")
    return decoded.withColumn("raw_value", F.when(~F.col("decoded"), F.col("raw_value")))


def _split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    means = decoded.where("decoded").select(*[f.name for f in S.WINDOW_MEAN.fields], "batch_id")
    dead = decoded.where(~F.col("decoded")).select("batch_id", "sensor_id", "timestamp", "raw_value", "reason")
    return means, dead


def start_table_sink(
    means: DataFrame,
    table_path: str,
    dead_path: str,
    checkpoint: str,
    trigger: str | None = S.TRIGGER_INTERVAL,
    available_now: bool = False,
    output_mode: str = "update",
    as_of: dt.datetime | str | Column | None = None,
    name: str | None = None,
    no_data_batches: bool | None = None,
    state_partitions: int | None = None,
    envelope_path: str | None = None,
    state_store: str | None = ROCKSDB_PROVIDER,
    summary_path: str | None = None,
) -> StreamingQuery:
    """Start the stream of window means into the table.

    ``checkpoint`` must be durable shared storage; restarting with the
    same checkpoint resumes state and offsets (T7). In update mode a batch
    without input only evicts state and emits nothing, so such batches are
    skipped unless ``no_data_batches`` asks for them (state is then evicted
    with the next data batch). ``state_partitions`` fixes the number of
    state-store partitions at the first start of a checkpoint (later starts
    keep what the checkpoint recorded); by default the session's setting.
    State is kept in RocksDB (``state_store=None``: the session's provider).
    """
    write = table_batch_writer(table_path, dead_path, as_of, envelope_path, summary_path)
    return _start_update(means, write, checkpoint, trigger, available_now, output_mode, name, no_data_batches, state_partitions, state_store)


def _start_update(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = S.TRIGGER_INTERVAL,
    available_now: bool = False,
    output_mode: str = "update",
    name: str | None = None,
    no_data_batches: bool | None = None,
    state_partitions: int | None = None,
    state_store: str | None = ROCKSDB_PROVIDER,
) -> StreamingQuery:
    writer = df.writeStream.outputMode(output_mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if no_data_batches is None:
        no_data_batches = output_mode != "update"
    conf = {"spark.sql.streaming.noDataMicroBatches.enabled": str(no_data_batches).lower()}
    if state_store:
        conf["spark.sql.streaming.stateStore.providerClass"] = state_store
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    return _start_with(df, writer, conf)


def _start_with(df: DataFrame, writer, conf: dict[str, str]) -> StreamingQuery:
    """Start a query with extra SQL settings; the query keeps a copy of the
    session settings taken at start, so the caller's session is restored."""
    session = df.sparkSession
    with _STARTING:  # two starts at once must not mix their settings
        saved = {k: session.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            session.conf.set(k, v)
        try:
            return writer.start()
        finally:
            for k, v in saved.items():
                if v is None:
                    session.conf.unset(k)
                else:
                    session.conf.set(k, v)


_STARTING = threading.Lock()


def start_archive(
    means: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = S.TRIGGER_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """S7 streaming: append finished windows to the date-partitioned archive.

    Append mode writes a window only once the watermark has passed its end;
    the newest windows wait for later data. The file sink's own log makes
    the output exactly-once across restarts.
    """
    dated = means.withColumn("date", F.to_date(ms_to_ts("timestamp")))
    writer = (
        dated.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a query on :func:`window_stream` still holds, with their means so far.

    Read from the checkpoint with Spark's state reader, so the query may be stopped. In append mode these
    are the windows that are not written yet: together with the archive they are all windows.
    """
    state = spark.read.format("statestore").load(checkpoint)
    kept = [(f"{m}_{name}", kind) for m in MEASURES for name, kind in MEAN_STATE]
    found = [f.dataType.typeName() for f in state.schema["value"].dataType.fields]
    if found != [kind for _, kind in kept]:
        raise ValueError(f"{checkpoint}: state {found} is not that of window means")
    value = F.col("value").cast("struct<" + ", ".join(f"{name}: {kind}" for name, kind in kept).replace(": long", ": bigint") + ">")
    rows = state.select("key.*", value.alias("value"))
    return rows.select("sensor_id", window_start_ms("window").alias("timestamp"), *[mean_of_state(F.col("value"), m).alias(m) for m in MEASURES])


def run_until_stopped(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait; stop cleanly on interrupt or error, re-raise errors."""
    try:
        query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
    except Exception:
        query.stop()
        raise


def _dropped(progress) -> int:
    ops = progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators
    return sum(int((op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark) or 0) for op in ops)


class LateRows(StreamingQueryListener):
    """T5: late rows dropped, over all progress of all queries since
    ``spark.streams.addListener`` (Spark itself retains recent progress only)."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + _dropped(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def dropped_by_watermark(query: StreamingQuery) -> int:
    """T5: late rows dropped, over the progress that the query still retains."""
    return sum(map(_dropped, query.recentProgress))
