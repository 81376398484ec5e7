"""Message and envelope codecs.

Decoding never raises: malformed JSON gives an all-null struct (PERMISSIVE
``from_json``), a wrongly typed field gives null for that field. The
envelope decoder turns each such defect into a dead-letter reason.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.checks import label
from tidemark.functions.time import parse_timestamp


def decode_readings(df: DataFrame, value: str = "value", carry: list[str] | None = None) -> DataFrame:
    """Raw topic value -> sensor_id, timestamp (parsed), temperature, humidity."""
    data = F.from_json(F.col(value).cast("string"), S.READING_JSON).alias("data")
    parsed = df.select(*(carry or []), data)
    return parsed.select(
        *(carry or []),
        F.col("data.sensor_id").alias("sensor_id"),
        parse_timestamp(F.col("data.timestamp")).alias("timestamp"),
        F.col("data.temperature").alias("temperature"),
        F.col("data.humidity").alias("humidity"),
    )


def label_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Raw topic rows -> readings with ``reason`` and ``accepted``, plus the
    source coordinates and the raw text.

    A message that is no JSON object, has no sensor id, or no readable time
    cannot enter a window; it is labelled here instead of vanishing there.
    """
    carry = [c for c in ("topic", "partition", "offset") if c in raw.columns]
    text = F.col(value).cast("string")
    parsed = raw.select(*carry, text.alias("raw_value"), F.from_json(text, S.READING_JSON).alias("data"))
    parsed = parsed.withColumn("_time", parse_timestamp(F.col("data.timestamp")))
    fields = [F.col(f"data.{f.name}") for f in S.READING_JSON.fields]
    malformed = reduce(lambda a, b: a & b, (f.isNull() for f in fields))
    reason, accepted = label(
        [
            (malformed, S.D_MESSAGE_MALFORMED),
            (~malformed & F.col("data.sensor_id").isNull(), S.R_MISSING + "sensor_id"),
            (~malformed & F.col("data.timestamp").isNull(), S.R_MISSING + "timestamp"),
            (F.col("data.timestamp").isNotNull() & F.col("_time").isNull(), S.R_TS_UNPARSEABLE),
        ]
    )
    return parsed.select(
        *carry,
        "raw_value",
        F.col("data.sensor_id").alias("sensor_id"),
        F.col("_time").alias("timestamp"),
        F.col("data.temperature").alias("temperature"),
        F.col("data.humidity").alias("humidity"),
        reason.alias("reason"),
        accepted.alias("accepted"),
    )


def _type_name(dtype: T.DataType) -> str:
    return S.ENVELOPE_TYPE_NAMES.get(dtype.simpleString(), "string")


def encode_envelope(
    df: DataFrame,
    fields: list[str] | None = None,
    name: str = S.ENVELOPE_NAME,
    optional: bool = False,
    carry: list[str] | None = None,
) -> DataFrame:
    """Schema-carrying JSON (P6): ``{"schema": {...}, "payload": {...}}``.

    The schema block is derived from ``df.schema`` on the driver and enters
    the plan as constant literals (folded once by the optimizer).
    """
    fields = fields or [c for c in df.columns if c not in (carry or [])]
    block = F.struct(
        F.lit("struct").alias("type"),
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("field"),
                    F.lit(_type_name(df.schema[f].dataType)).alias("type"),
                    F.lit(optional).alias("optional"),
                )
                for f in fields
            ]
        ).alias("fields"),
        F.lit(optional).alias("optional"),
        F.lit(name).alias("name"),
    )
    payload = F.struct(*[F.col(f) for f in fields])
    envelope = F.to_json(F.struct(block.alias("schema"), payload.alias("payload")))
    return df.select(*(carry or []), envelope.alias("value"))


def decode_envelope(
    df: DataFrame,
    payload_schema: T.StructType = S.WINDOW_MEAN,
    value: str = "value",
    carry: list[str] | None = None,
) -> DataFrame:
    """Envelope JSON -> payload columns + ``reason`` and ``decoded``.

    A record without a schema block, or with a required payload field
    missing or mistyped, gets a reason and belongs to the dead letters.
    """
    env = F.from_json(F.col(value).cast("string"), S.envelope_schema(payload_schema))
    parsed = df.select(*(carry or []), F.col(value).cast("string").alias("raw_value"), env.alias("env"))
    malformed = F.col("env.schema").isNull() & F.col("env.payload").isNull()
    checks = [
        (malformed, S.D_ENVELOPE_MALFORMED),
        (~malformed & F.col("env.schema").isNull(), S.D_SCHEMA_MISSING),
    ] + [
        (~malformed & F.col(f"env.payload.{f.name}").isNull(), S.D_PAYLOAD_FIELD_MISSING + f.name)
        for f in payload_schema.fields
    ]
    reason, decoded = label(checks)
    return parsed.select(
        *(carry or []),
        *[F.col(f"env.payload.{f.name}").alias(f.name) for f in payload_schema.fields],
        F.col("env.schema.name").alias("schema_name"),
        F.col("raw_value"),
        reason.alias("reason"),
        decoded.alias("decoded"),
    )
