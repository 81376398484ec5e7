"""Registered queries over what is kept up to date next to the table: summaries, digests, parts of means; raw client input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.operators.codec import decode_readings
from tidemark.operators.ingest import ingest
from tidemark.operators.queries import newest_sensors
from tidemark.operators.windows import longer_parts, means_of_parts, weighted_stats, window_parts
from tidemark.plans import derived as P
from tidemark.plans.store_queries import BATCHES, CLOSE_FIRST, CLOSE_NEXT, update_batch
from tidemark.plans.streaming_queries import run_summary_stream
from tidemark.session import scratch_path
from tidemark.sources.store import compact_table, write_table
from tidemark.sources.summaries import compact_summaries, maintained_overview, summarize_batch


# --- A2, Q1 --------------------------------------------------------------------
def list_sensors_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 from the summaries that the stream keeps: four arrivals, a restart after each, days closed in between."""
    return newest_sensors(maintained_overview(spark, run_summary_stream(spark, sf_dir, (CLOSE_FIRST, CLOSE_NEXT))["summaries"]))


def overview_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 from summaries of batches that mostly correct stored keys, with a replay, and days closed in between."""
    root = scratch_path(spark, "overview")
    table, summaries = f"{root}/table", f"{root}/summaries"

    def arrive(number: int) -> None:
        rows = update_batch(spark, sf_dir, number)
        summarize_batch(rows, number, table, summaries)
        write_table(rows, table)

    def close(before: str) -> None:
        compact_table(spark, table, before)
        compact_summaries(spark, summaries, before)

    arrive(0), arrive(1)
    close(CLOSE_FIRST)
    arrive(1)  # again
    arrive(2)
    close(CLOSE_NEXT)
    for number in range(3, BATCHES):
        arrive(number)
    return maintained_overview(spark, summaries)


# --- C3 ------------------------------------------------------------------------
def audit_integrity_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 by digests over the whole table; nothing differs, so no rows are joined."""
    return audit.audit_by_digest(P.window_means(spark, sf_dir), P.stored_table(spark, sf_dir))[0]


def _damaged(table: DataFrame) -> DataFrame:
    """Some rows are lost, some have another value, some another sensor."""
    kind: Column = F.floor(F.col("timestamp") / 30000) % 503
    rows = table.where(kind != 17)
    return rows.withColumns({
        "temperature": F.when(kind == 18, F.lit(None)).otherwise(F.col("temperature")),
        "humidity": F.when(kind == 19, F.lit(1.25).cast("decimal(5,2)")).otherwise(F.col("humidity")),
        "sensor_id": F.when(kind == 20, F.concat("sensor_id", F.lit("-x"))).otherwise(F.col("sensor_id")),
    })


def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 by digests against a damaged table: every row that does not match."""
    _, findings = audit.audit_by_digest(P.window_means(spark, sf_dir), _damaged(P.stored_table(spark, sf_dir)))
    return findings.select("sensor_id", "timestamp", "status")


# --- A1, X9 --------------------------------------------------------------------
_PARTS: dict[tuple, str] = {}


def stored_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-second parts of the accepted readings, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _PARTS:
        path = scratch_path(spark, "parts")
        rows = window_parts(P.accepted(spark, sf_dir))
        rows.repartitionByRange("sensor_id", "timestamp").sortWithinPartitions("sensor_id", "timestamp").write.parquet(path)
        _PARTS[key] = path
    return spark.read.parquet(_PARTS[key])


def window_mean_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-day means from the 30-second parts: equal to those over the readings."""
    return means_of_parts(longer_parts(longer_parts(stored_parts(spark, sf_dir), "1 hour"), "1 day"))


def weighted_sensor_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_stats(stored_parts(spark, sf_dir))


# --- Q4 ------------------------------------------------------------------------
def client_input(readings: DataFrame) -> DataFrame:
    """The readings as clients send them: all text, and some of it wrong."""
    kind = F.col("event_id") % 17
    plain = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    temperature, humidity = F.col("temperature").cast("string"), F.col("humidity").cast("string")
    return readings.select(
        "event_id",
        F.when(kind == 1, F.lit("")).when(kind == 2, F.repeat("sensor_id", 30)).otherwise(F.col("sensor_id")).alias("sensor_id"),
        F.when(kind == 3, F.concat(plain, F.lit("Z")))
        .when(kind == 4, F.concat(F.date_format(F.col("timestamp") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd' 'HH:mm:ss.SSSSSS"), F.lit("+02:00")))
        .when(kind == 5, F.date_format("timestamp", "HH:mm:ss"))
        .when(kind == 6, F.date_format("timestamp", "yyyy-MM-dd"))
        .otherwise(plain)
        .alias("timestamp"),
        F.when(kind == 7, F.concat(temperature, F.lit("d")))
        .when(kind == 8, F.lit("0x1p3"))
        .when(kind == 9, F.lit("Infinity"))
        .when(kind == 10, F.lit(" +1.25e1 "))
        .when(kind == 11, F.lit(""))
        .otherwise(temperature)
        .alias("temperature"),
        F.when(kind == 12, F.lit("NaN")).when(kind == 13, F.lit(None)).when(kind == 14, F.lit("45,5")).otherwise(humidity).alias("humidity"),
    )


def ingest_client_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 as it stands: text input in, messages (decoded again here) and rejects with reasons out."""
    messages, rejects = ingest(client_input(P.readings(spark, sf_dir)), P.INGEST_AS_OF, carry=["event_id"])
    values = ["sensor_id", "timestamp", "temperature", "humidity"]
    decoded = decode_readings(messages, carry=["event_id", "key"])
    taken = decoded.select("event_id", F.lit("").alias("reason"), F.col("key").cast("string").alias("key"), *values)
    nothing = [F.lit(None).cast(taken.schema[c].dataType).alias(c) for c in ("key", *values)]
    return taken.unionByName(rejects.select("event_id", "reason", *nothing))


UPKEEP_QUERIES = {
    "list_sensors_maintained": list_sensors_maintained,
    "overview_maintained": overview_maintained,
    "audit_integrity_digests": audit_integrity_digests,
    "audit_findings": audit_findings,
    "window_mean_merged": window_mean_merged,
    "weighted_sensor_stats": weighted_sensor_stats,
    "ingest_client_input": ingest_client_input,
}
