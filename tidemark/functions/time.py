"""Time conversions (P2-P5) as Column expressions; all UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


ISO_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?\s*(Z|[+-]\d{2}(:?\d{2})?)?$"


def parse_timestamp(c: ColumnOrName) -> Column:
    """ISO-8601 date and time -> timestamp; all else -> null (never raises under ANSI).

    Accepts ``Z`` and ``+hh:mm`` offsets, optional seconds and fractions, and
    naive strings (read as UTC with a UTC session). A time without a date, a
    date or a year alone is not a reading time: the answer would depend on
    the day of the run, or name a whole day.
    """
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(ISO_DATE_TIME), text.try_cast(T.TimestampType()))


def to_timestamp_utc(c: ColumnOrName) -> Column:
    """Timestamp or timestamp_ntz (wall time in UTC) -> timestamp."""
    return _col(c).cast(T.TimestampType())


def window_start_ms(window_col: ColumnOrName = "window") -> Column:
    """Start of a ``window()`` struct in epoch milliseconds."""
    return F.unix_millis(_col(window_col).getField("start"))


def ms_to_ts(c: ColumnOrName) -> Column:
    """Epoch milliseconds -> UTC timestamp."""
    return F.timestamp_millis(_col(c))


def iso_string(c: ColumnOrName) -> Column:
    """Timestamp -> ISO-8601 text with an explicit ``+00:00`` offset.

    Microseconds are written only when non-zero, like Python's isoformat.
    ``to_json`` alone would cut the value to milliseconds.
    """
    ts = _col(c)
    whole = F.unix_micros(ts) % F.lit(1_000_000) == 0
    return F.when(ts.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
        )
    )


def as_timestamp_literal(value: dt.datetime | str | Column) -> Column:
    """A point in time given as datetime, ISO string or Column."""
    if isinstance(value, Column):
        return to_timestamp_utc(value)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(value.isoformat(sep=" ")).cast(T.TimestampType())
    return F.lit(str(value)).cast(T.TimestampType())


def to_utc_datetime(value: dt.datetime | str) -> dt.datetime:
    """Driver-side: parse a bound into an aware UTC datetime (naive = UTC)."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return value.astimezone(dt.timezone.utc)


def epoch_ms(value: dt.datetime | str) -> int:
    """Driver-side: a bound in epoch ms, truncated like ``int(ts*1000)``."""
    return int(to_utc_datetime(value).timestamp() * 1000)


def interval(text: str) -> Column:
    """``"1 day"`` or ``"INTERVAL 1 DAY"`` -> interval literal column."""
    text = text.strip()
    if not text.upper().startswith("INTERVAL"):
        text = f"INTERVAL {text}"
    return F.expr(text)


def duration_seconds(text: str) -> int:
    """Driver-side: ``"30 seconds"``/``"5 minutes"``/``"1 day"`` -> seconds."""
    units = {
        "second": 1,
        "minute": 60,
        "hour": 3600,
        "day": 86400,
        "week": 604800,
    }
    parts = text.lower().replace("interval", "").split()
    total = 0
    for amount, unit in zip(parts[::2], parts[1::2]):
        total += int(float(amount) * units[unit.rstrip("s")])
    return total
