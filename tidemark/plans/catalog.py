"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each one runs an operator (or a composition) over the whole driver tables
or data Spark derives from them. Matching DuckDB SQL is in ``oracle.py``;
output columns carry the same names there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import match_labels, organize
from tidemark.functions.numeric import band, scale
from tidemark.operators import audit, metrics, queries
from tidemark.operators.codec import decode_envelope, decode_readings, encode_envelope
from tidemark.operators.ingest import encode_messages, flag_suspicious, ingest_stats, validate
from tidemark.operators.table import purge_sensors
from tidemark.plans import derived as P
from tidemark.schemas import BAND_NAMESPACE_MEMORY_MIB

Query = Callable[[SparkSession, str], DataFrame]
READING_COLS = ["sensor_id", "timestamp", "temperature", "humidity"]


# --- A1 / P3 ---------------------------------------------------------------
def window_mean_30s(spark, sf_dir):
    return P.window_means(spark, sf_dir, "30 seconds")


def window_mean_1d(spark, sf_dir):
    return P.window_means(spark, sf_dir, "1 day")


# --- P20-P24, A5 -------------------------------------------------------------
def _ingest_checked(spark, sf_dir):
    return validate(P.readings(spark, sf_dir), as_of=P.INGEST_AS_OF)


def ingest_valid(spark, sf_dir):
    return _ingest_checked(spark, sf_dir).where("accepted").select("event_id", *READING_COLS)


def ingest_rejects(spark, sf_dir):
    checked = _ingest_checked(spark, sf_dir)
    return checked.where(~F.col("accepted")).select("event_id", "sensor_id", "timestamp", "reason")


def ingest_suspicious(spark, sf_dir):
    flagged = flag_suspicious(_ingest_checked(spark, sf_dir).where("accepted"), P.INGEST_AS_OF)
    return flagged.where(F.col("suspicious").isNotNull()).select(
        "event_id", "sensor_id", "timestamp", "suspicious", "lead_seconds"
    )


def ingest_totals(spark, sf_dir):
    return ingest_stats(_ingest_checked(spark, sf_dir))


def ingest_stats_by_sensor(spark, sf_dir):
    return ingest_stats(_ingest_checked(spark, sf_dir), by=["sensor_id"])


# --- S3 + P1, P6 + P7 --------------------------------------------------------
def message_roundtrip(spark, sf_dir):
    messages = encode_messages(P.readings(spark, sf_dir), carry=["event_id"])
    decoded = decode_readings(messages, carry=["event_id", "key"])
    return decoded.select("event_id", F.col("key").cast("string").alias("key"), *READING_COLS)


def envelope_roundtrip(spark, sf_dir):
    encoded = encode_envelope(P.window_means(spark, sf_dir))
    decoded = decode_envelope(encoded)
    return decoded.select(*READING_COLS, "schema_name", "reason")


# --- P8, S5, A6 -----------------------------------------------------------------
def table_rows(spark, sf_dir):
    return P.analytics_table(spark, sf_dir)


# --- Q1-Q3b, L1-L5, A4, P28 ----------------------------------------------------
def list_sensors(spark, sf_dir):
    return queries.list_sensors(P.stored_table(spark, sf_dir))


def sensor_overview(spark, sf_dir):
    return queries.sensor_overview(P.stored_table(spark, sf_dir))


def sensor_data(spark, sf_dir):
    start, end = P.PERIOD
    return queries.sensor_data(P.stored_table(spark, sf_dir, (start[:10], end[:10])), P.SENSOR, start, end)


def sensor_stats(spark, sf_dir):
    start, end = P.PERIOD
    return queries.sensor_stats(P.stored_table(spark, sf_dir, (start[:10], end[:10])), P.SENSOR, start, end)


def all_sensor_stats(spark, sf_dir):
    return queries.all_sensor_stats(P.stored_table(spark, sf_dir), as_of=P.STATS_AS_OF)


def recent_rows(spark, sf_dir):
    return queries.recent(P.stored_table(spark, sf_dir), 5)


def purged_table(spark, sf_dir):
    return purge_sensors(P.stored_table(spark, sf_dir), P.PURGED).select(*READING_COLS)


def reading_counts(spark, sf_dir):
    return queries.count_readings(P.stored_table(spark, sf_dir))


def sensor_reading_count(spark, sf_dir):
    return queries.count_readings(P.stored_table(spark, sf_dir), P.SENSOR)


# --- M1-M10, P10, P11, P27 ------------------------------------------------------
def _rates(spark, sf_dir):
    return metrics.counter_rate(P.stored_samples(spark, sf_dir), P.RATE_RANGE, P.RATE_STEP, tasks=P.sample_tasks(spark, sf_dir))


def _value_rates(spark, sf_dir):
    return _rates(spark, sf_dir).where(F.col("metric") == "events_value_total")


def counter_rate(spark, sf_dir):
    return _rates(spark, sf_dir).select("metric", "namespace", "pod", "t", "increase", "rate")


def rate_by_label(spark, sf_dir):
    summed = metrics.sum_by(_value_rates(spark, sf_dir), ["namespace"])
    return summed.select("t", "namespace", "increase", "rate", scale("rate", "MiB").alias("rate_mib"))


def rate_total(spark, sf_dir):
    return metrics.sum_by(_value_rates(spark, sf_dir)).select("t", "increase", "rate")


def _gauges(spark, sf_dir, metric):
    samples = P.stored_samples(spark, sf_dir).where(F.col("metric") == metric)
    return metrics.instant_value(samples, P.RATE_STEP, P.GAUGE_LOOKBACK)


def active_series(spark, sf_dir):
    return metrics.series_count(_gauges(spark, sf_dir, "events_count_total"), ["pod"])


def gauge_by_label(spark, sf_dir):
    return metrics.sum_by(_gauges(spark, sf_dir, "events_count_total"), ["namespace"])


def combined_rate(spark, sf_dir):
    pairs = metrics.add_series(_rates(spark, sf_dir), "events_value_total", "events_count_total")
    return metrics.sum_by(pairs, ["namespace"]).select("t", "namespace", "increase", "rate")


def topk_series(spark, sf_dir):
    summed = metrics.sum_by(_value_rates(spark, sf_dir), ["namespace", "pod"])
    top = metrics.topk(summed, 5, "rate", ["t"], ["namespace", "pod"])
    return top.select("t", "namespace", "pod", "rate", "rank")


def counter_rate_bounded(spark, sf_dir):
    """Rates of one dashboard range: only its samples are read."""
    rates = metrics.counter_rate(P.stored_samples(spark, sf_dir), P.RATE_RANGE, P.RATE_STEP, *P.RATE_PERIOD, tasks=P.sample_tasks(spark, sf_dir))
    return rates.select("metric", "namespace", "pod", "t", "increase", "rate")


def matched_rate(spark, sf_dir):
    """sum(rate(x{matchers}[range])) by (namespace): labels filtered first."""
    matched = match_labels(
        P.stored_samples(spark, sf_dir),
        [("metric", "=", "events_value_total"), ("namespace", "=~", "click|view"), ("container", "!=", ""), ("pod", "!=", "1")],
    )
    rates = metrics.counter_rate(matched, P.RATE_RANGE, P.RATE_STEP, *P.RATE_PERIOD, tasks=P.sample_tasks(spark, sf_dir))
    summed = metrics.sum_by(rates, ["namespace"])
    return summed.select("t", "namespace", "increase", "rate")


def gauge_total(spark, sf_dir):
    """sum(gauge) in bytes, MiB and GiB."""
    total = metrics.sum_by(_gauges(spark, sf_dir, "events_value_total"))
    return total.select("t", "value", scale("value", "MiB").alias("mib"), scale("value", "GiB").alias("gib"))


def _rates_at_instant(spark, sf_dir):
    samples = P.stored_samples(spark, sf_dir).where(F.col("metric") == "events_value_total")
    rates = metrics.counter_rate(samples, P.RATE_RANGE, P.RATE_STEP, P.TOPK_AT, P.TOPK_AT, tasks=P.sample_tasks(spark, sf_dir))
    return metrics.sum_by(rates, ["namespace", "pod"])


def organized_rates(spark, sf_dir):
    """Table panel: helper columns dropped, the named ones first."""
    return organize(_rates_at_instant(spark, sf_dir), ["t", "range_seconds"], ["pod", "namespace"])


def topk_instant(spark, sf_dir):
    """topk(10, sum(rate) by (namespace, pod)) at one instant (table panel)."""
    return metrics.topk(_rates_at_instant(spark, sf_dir), 10, "rate", partition=[], tiebreak=["namespace", "pod"]).select("namespace", "pod", "rate")


def last_value(spark, sf_dir):
    return metrics.last_not_null(P.stored_samples(spark, sf_dir)).select("metric", "namespace", "pod", "ts", "value")


def share_by_label(spark, sf_dir):
    summed = metrics.sum_by(_value_rates(spark, sf_dir), ["namespace"])
    return metrics.share_of_total(summed, "increase").select("t", "namespace", "increase", "share", "percent")


def share_overall(spark, sf_dir):
    """Share of the total at one instant (donut without a partition)."""
    samples = P.stored_samples(spark, sf_dir).where(F.col("metric") == "events_value_total")
    gauges = metrics.instant_value(samples, P.RATE_STEP, P.GAUGE_LOOKBACK, P.TOPK_AT, P.TOPK_AT)
    shares = metrics.share_of_total(metrics.sum_by(gauges, ["namespace"]), "value", partition=[])
    return shares.select("namespace", "value", "share", "percent")


def banded_series(spark, sf_dir):
    summed = metrics.sum_by(_gauges(spark, sf_dir, "events_value_total"), ["namespace"])
    return summed.select("t", "namespace", "value", band("value", BAND_NAMESPACE_MEMORY_MIB).alias("band"))


def matched_series(spark, sf_dir):
    matched = match_labels(
        P.stored_samples(spark, sf_dir),
        [("namespace", "=~", "click|view"), ("pod", "!=", "1"), ("container", "!=", "")],
    )
    return matched.groupBy("metric", "namespace", "pod").agg(F.count(F.lit(1)).alias("samples"))


# --- C1-C3 -----------------------------------------------------------------------
def audit_counts(spark, sf_dir):
    start, end = P.FULL_PERIOD
    return audit.audit_counts(P.stored_table(spark, sf_dir), start, end)


def audit_ranges(spark, sf_dir):
    start, end = P.FULL_PERIOD
    return audit.audit_ranges(P.stored_table(spark, sf_dir), start, end)


def audit_integrity(spark, sf_dir):
    sent = P.window_means(spark, sf_dir)
    stored = P.stored_table(spark, sf_dir)
    return audit.integrity_summary(audit.audit_integrity(sent, stored))


QUERIES: dict[str, Query] = {
    "window_mean_30s": window_mean_30s,
    "window_mean_1d": window_mean_1d,
    "ingest_valid": ingest_valid,
    "ingest_rejects": ingest_rejects,
    "ingest_suspicious": ingest_suspicious,
    "ingest_stats": ingest_totals,
    "ingest_stats_by_sensor": ingest_stats_by_sensor,
    "message_roundtrip": message_roundtrip,
    "envelope_roundtrip": envelope_roundtrip,
    "table_rows": table_rows,
    "list_sensors": list_sensors,
    "sensor_overview": sensor_overview,
    "sensor_data": sensor_data,
    "sensor_stats": sensor_stats,
    "all_sensor_stats": all_sensor_stats,
    "recent_rows": recent_rows,
    "purged_table": purged_table,
    "reading_counts": reading_counts,
    "sensor_reading_count": sensor_reading_count,
    "counter_rate": counter_rate,
    "rate_by_label": rate_by_label,
    "rate_total": rate_total,
    "active_series": active_series,
    "gauge_by_label": gauge_by_label,
    "combined_rate": combined_rate,
    "topk_series": topk_series,
    "topk_instant": topk_instant,
    "counter_rate_bounded": counter_rate_bounded,
    "matched_rate": matched_rate,
    "gauge_total": gauge_total,
    "organized_rates": organized_rates,
    "share_overall": share_overall,
    "last_value": last_value,
    "share_by_label": share_by_label,
    "banded_series": banded_series,
    "matched_series": matched_series,
    "audit_counts": audit_counts,
    "audit_ranges": audit_ranges,
    "audit_integrity": audit_integrity,
}
