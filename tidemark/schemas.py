"""Record shapes (D1-D11) and the fixed values the pipeline must agree on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must stay as they are for results to match the
# service being rebuilt (field bounds, window settings, table limits, names).
# ---------------------------------------------------------------------------
SENSOR_ID_MIN_LEN = 1
SENSOR_ID_MAX_LEN = 100
TABLE_SENSOR_ID_MAX_LEN = 50
TEMPERATURE_MIN = -273.15
TEMPERATURE_MAX = 200.0
HUMIDITY_MIN = 0.0
HUMIDITY_MAX = 100.0
REJECT_FUTURE = "INTERVAL 1 DAY"
REJECT_PAST = "INTERVAL 1 DAY"
SUSPICIOUS_FUTURE = "INTERVAL 5 MINUTES"
SUSPICIOUS_PAST = "INTERVAL 10 HOURS"
WINDOW_DURATION = "30 seconds"
WATERMARK_DELAY = "1 minute"
TRIGGER_INTERVAL = "10 seconds"
MAX_OFFSETS_PER_TRIGGER = 10000
ENVELOPE_NAME = "analytics_data"
TABLE_DECIMAL = T.DecimalType(5, 2)
OVERVIEW_LIMIT_DEFAULT, OVERVIEW_LIMIT_MAX = 50, 1000
SERIES_LIMIT_DEFAULT, SERIES_LIMIT_MAX = 100, 10000
DEFAULT_PERIOD_DAYS = 7
RAW_TOPIC = "sensor-data"
ANALYTICS_TOPIC = "analytics-data"
# Spark type -> schema-block type name used in the envelope.
ENVELOPE_TYPE_NAMES = {
    "string": "string",
    "bigint": "int64",
    "int": "int32",
    "smallint": "int16",
    "tinyint": "int8",
    "double": "double",
    "float": "float",
    "boolean": "boolean",
    "binary": "bytes",
}
# Reject reasons (ingest) and dead-letter reasons (table conformance).
R_MISSING = "missing:"  # followed by the field name
R_SENSOR_ID_LENGTH = "sensor_id_length"
R_TS_UNPARSEABLE = "timestamp_unparseable"
R_TS_FUTURE = "timestamp_future"
R_TS_PAST = "timestamp_past"
R_TEMPERATURE_INVALID = "temperature_invalid"
R_TEMPERATURE_RANGE = "temperature_out_of_range"
R_HUMIDITY_INVALID = "humidity_invalid"
R_HUMIDITY_RANGE = "humidity_out_of_range"
D_SENSOR_ID_TOO_LONG = "sensor_id_too_long"
D_NULL_KEY = "null_key:"  # followed by the field name
D_NULL_MEASURE = "null_measure:"  # followed by the field name
D_DECIMAL_OVERFLOW = "decimal_overflow:"  # followed by the field name
D_DUPLICATE_KEY = "duplicate_key"
D_MESSAGE_MALFORMED = "message_malformed"
D_LATE = "late"
D_ENVELOPE_MALFORMED = "envelope_malformed"
D_SCHEMA_MISSING = "schema_missing"
D_PAYLOAD_FIELD_MISSING = "payload_missing:"  # followed by the field name
# Dashboard threshold steps: (value where the colour starts, colour).
BAND_NAMESPACE_MEMORY_MIB = [(None, "green"), (512.0, "yellow"), (1024.0, "red")]
BAND_DISK_GIB = [(None, "green"), (1.0, "yellow"), (5.0, "red")]

# ---------------------------------------------------------------------------
# Shapes
# ---------------------------------------------------------------------------
# What a client sends (lax; validated by operators.ingest).
INGEST_MESSAGE = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("temperature", T.StringType()),
        T.StructField("humidity", T.StringType()),
    ]
)

# Raw topic record (Kafka source columns; file streams use the same).
RAW_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# D3: parsing schema of a raw message value (the streaming job's view).
READING_JSON = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
    ]
)

# Windowed mean (window start in epoch milliseconds).
WINDOW_MEAN = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
    ]
)

# envelope = schema block + payload.
ENVELOPE_FIELD = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("optional", T.BooleanType()),
    ]
)
ENVELOPE_SCHEMA_BLOCK = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("fields", T.ArrayType(ENVELOPE_FIELD)),
        T.StructField("optional", T.BooleanType()),
        T.StructField("name", T.StringType()),
    ]
)


def envelope_schema(payload: T.StructType = WINDOW_MEAN) -> T.StructType:
    return T.StructType(
        [
            T.StructField("schema", ENVELOPE_SCHEMA_BLOCK),
            T.StructField("payload", payload),
        ]
    )


# The analytics table.
ANALYTICS_TABLE = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("temperature", TABLE_DECIMAL),
        T.StructField("humidity", TABLE_DECIMAL),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

# Metric sample, long format with flat label columns.
METRIC_SAMPLE = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("pod", T.StringType()),
        T.StructField("container", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DecimalType(38, 6)),
    ]
)
