"""The pipeline's intermediate DataFrames, derived from the driver tables.

readings (events, F7) -> accepted (ingest validation; receipt time = the
reading's own time, as the simulator sends "now") -> window means (A1) ->
table (P8 conformance). Metric samples come from the same events (F8).

The service's queries read a stored table and the dashboards stored
samples. ``stored_table`` / ``stored_samples`` write the derived data once
per application as parquet under the checkpoint folder (a written table
also cuts the lineage) and read it back through S6 / S8, so the queries'
filters reach a parquet scan. Files are sorted by key and time so filters
skip row groups; the table is partitioned by date, and both are
range-partitioned, which splits a hot day or series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ingest import validate
from tidemark.operators.series import tasks_for
from tidemark.operators.table import TABLE_COLUMNS, conform_table, split_dead_letters
from tidemark.operators.windows import window_mean
from tidemark.schemas import WINDOW_DURATION
from tidemark.sources.samples import read_samples, samples_from_events
from tidemark.sources.store import read_table, write_closed
from tidemark.sources.tables import read_table as read_driver_table
from tidemark.sources.tables import readings_from_events
from tidemark.session import ensure_utc, scratch_path

# Parameters of the registered queries (fixed so answers are reproducible).
INGEST_AS_OF = "2024-01-15 12:00:00"  # receipt time of the ingest batch
TABLE_AS_OF = "2024-02-01 00:00:00"  # created_at of batch-loaded rows
SENSOR = "Sensor-7"
PERIOD = ("2024-01-10T00:00:00", "2024-01-20T00:00:00")
STATS_AS_OF = "2024-01-20T00:00:00"  # default period: 7 days ending here
FULL_PERIOD = ("1970-01-01T00:00:00", "9999-12-31T00:00:00")  # the whole table
PURGED = ["Sensor-1", "Sensor-2"]
RATE_RANGE, RATE_STEP = "2 days", "6 hours"
GAUGE_LOOKBACK = "1 day"
RATE_PERIOD = ("2024-01-18 00:00:00", "2024-01-20 12:00:00")  # a dashboard's time range
TOPK_AT = "2024-01-20 12:00:00"  # the instant of the top-k table


_TABLES: dict[tuple, DataFrame] = {}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One DataFrame per (application, session, table) for the read-only
    driver tables: the file listing and footer read happen once. Only the
    plan is kept, no data."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), name)
    if key not in _TABLES:
        _TABLES[key] = read_driver_table(spark, sf_dir, name)
    return _TABLES[key]


def readings(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """With ``tasks`` the events are dealt out evenly first: a part of the table may lie in one split of its file."""
    ensure_utc(spark)
    events = driver_table(spark, sf_dir, "events")
    return readings_from_events(events.repartition(tasks) if tasks else events)


def accepted(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Readings the ingest endpoint accepts (what reaches the raw topic)."""
    checked = validate(readings(spark, sf_dir, tasks), as_of=F.col("timestamp"))
    return checked.where("accepted").select("event_id", "sensor_id", "timestamp", "temperature", "humidity")


def window_means(spark: SparkSession, sf_dir: str, duration: str = WINDOW_DURATION) -> DataFrame:
    return window_mean(accepted(spark, sf_dir), duration)


def analytics_table(spark: SparkSession, sf_dir: str, as_of: str = TABLE_AS_OF) -> DataFrame:
    """The stored table: final 30 s means conformed to the table types."""
    good, _ = split_dead_letters(conform_table(window_means(spark, sf_dir), as_of))
    return good.select(*TABLE_COLUMNS)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return samples_from_events(driver_table(spark, sf_dir, "events"))


_STORED: dict[tuple, str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, build, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _STORED:
        path = scratch_path(spark, f"stored-{name}")
        write(build(spark, sf_dir), path)
        _STORED[key] = path
    return _STORED[key]


def _samples_layout(df: DataFrame) -> DataFrame:
    # Samples per series are not bounded in time (one per event here), so a
    # range repartition samples the keys and splits a hot series over tasks.
    order = ["metric", "namespace", "pod", "container", "ts"]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def materialize_table(spark: SparkSession, sf_dir: str) -> str:
    """Write the analytics table once per application; returns its path."""
    return _stored(spark, sf_dir, "table", analytics_table, write_closed)


def materialize_samples(spark: SparkSession, sf_dir: str) -> str:
    """Write the metric samples once per application; returns their path."""
    return _stored(spark, sf_dir, "samples", samples, lambda df, path: _samples_layout(df).write.parquet(path))


def stored_table(spark: SparkSession, sf_dir: str, dates: tuple[str, str] | None = None) -> DataFrame:
    """The analytics table as the service reads it (S6); all its days are closed."""
    ensure_utc(spark)
    return read_table(spark, materialize_table(spark, sf_dir), dates=dates)


def sample_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Tasks for ordered work on the stored samples; their number is in the file footers."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SAMPLE_TASKS:
        _SAMPLE_TASKS[key] = tasks_for(stored_samples(spark, sf_dir).count())
    return _SAMPLE_TASKS[key]


_SAMPLE_TASKS: dict[tuple, int | None] = {}


def stored_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric samples as the dashboards read them."""
    ensure_utc(spark)
    return read_samples(spark, materialize_samples(spark, sf_dir))
