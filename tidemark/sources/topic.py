"""Topic source and sink (S1, S2) and the file-backed raw topic used in tests.

The Kafka connector jar is not part of a plain PySpark install; the
builders below are what a cluster with the connector runs. The option
dicts are separate functions so they can be checked without a broker.
File streams with the raw-record columns (D2) stand in for the topic in
local runs; they honour the same per-trigger intake limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas as S


def topic_source_options(
    servers: str,
    topic: str = S.RAW_TOPIC,
    starting: str = "latest",
    max_per_trigger: int | None = S.MAX_OFFSETS_PER_TRIGGER,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return opts


def read_topic(spark: SparkSession, servers: str, topic: str = S.RAW_TOPIC, streaming: bool = True, **kw) -> DataFrame:
    """Subscribe to one topic (stream), or read it once (batch)."""
    opts = topic_source_options(servers, topic, **kw)
    if not streaming:
        opts.pop("maxOffsetsPerTrigger", None)
        if opts["startingOffsets"] == "latest":
            raise ValueError("a batch read cannot start at 'latest'; pass starting='earliest' or explicit offsets")
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**opts).load()


def topic_sink_options(servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}


def write_topic(
    df: DataFrame,
    servers: str,
    topic: str = S.ANALYTICS_TOPIC,
    checkpoint: str | None = None,
    trigger: str = S.TRIGGER_INTERVAL,
    output_mode: str = "update",
) -> DataStreamWriter | DataFrameWriter:
    """``value`` (and ``key`` if present) to a topic; the caller starts
    the returned stream writer (or calls ``save()`` on the batch writer).

    For streams ``checkpoint`` must be on durable shared storage (X15).
    """
    cols = [c for c in ("key", "value") if c in df.columns]
    if not df.isStreaming:
        # Batch twin (e.g. the ingest endpoint's accepted messages): one write.
        opts = {"kafka.bootstrap.servers": servers, "topic": topic}
        return df.select(*cols).write.format("kafka").options(**opts)
    if checkpoint is None:
        raise ValueError("a durable checkpoint location is required")
    return (
        df.select(*cols)
        .writeStream.format("kafka")
        .options(**topic_sink_options(servers, topic, checkpoint))
        .outputMode(output_mode)
        .trigger(processingTime=trigger)
    )


def raw_records(messages: DataFrame, topic: str = S.RAW_TOPIC, offset: str = "event_id", ts: str | None = None) -> DataFrame:
    """Messages (key, value) -> raw-topic rows (key, value, topic, partition, offset, timestamp)."""
    stamp = F.col(ts) if ts else F.current_timestamp()
    return messages.select(
        F.col("key"),
        F.col("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(offset).cast("long").alias("offset"),
        stamp.cast("timestamp").alias("timestamp"),
    )


def read_raw_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, streaming: bool = True) -> DataFrame:
    """The raw topic as parquet files (test stand-in for S1)."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(S.RAW_RECORD)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
