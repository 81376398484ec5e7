"""DataFrame -> DataFrame operators (ingest, codecs, windows, table, queries,
metrics, per-series helpers, audits)."""

from tidemark.operators.audit import audit_counts, audit_integrity, audit_ranges, integrity_summary
from tidemark.operators.codec import decode_envelope, decode_readings, encode_envelope
from tidemark.operators.ingest import encode_messages, flag_suspicious, ingest, ingest_stats, validate
from tidemark.operators.metrics import (
    add_series,
    counter_rate,
    instant_value,
    last_not_null,
    series_count,
    share_of_total,
    sum_by,
    topk,
)
from tidemark.operators.queries import (
    all_sensor_stats,
    count_readings,
    effective_limit,
    for_sensor,
    in_period,
    list_sensors,
    recent,
    sensor_data,
    sensor_overview,
    sensor_series,
    sensor_stats,
)
from tidemark.operators.series import previous_in_series, running_total
from tidemark.operators.table import (
    collapse_updates,
    conform_table,
    duplicate_updates,
    purge_sensors,
    split_dead_letters,
)
from tidemark.operators.windows import window_mean, with_watermark

__all__ = [
    "add_series", "all_sensor_stats", "audit_counts", "audit_integrity", "audit_ranges",
    "collapse_updates", "conform_table", "count_readings", "counter_rate", "decode_envelope",
    "decode_readings", "duplicate_updates", "effective_limit", "encode_envelope", "encode_messages",
    "flag_suspicious", "for_sensor", "in_period", "ingest", "ingest_stats", 
    "instant_value", "integrity_summary", "last_not_null", "list_sensors", "previous_in_series",
    "purge_sensors", "recent", "running_total", "sensor_data", "sensor_overview", "sensor_series",
    "sensor_stats", "series_count", "share_of_total", "split_dead_letters", "sum_by", "topk",
    "validate", "window_mean", "with_watermark",
]
