"""User queries (F5): limits, ordering, inclusive ranges, empty answers; audits."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from tidemark.operators import audit, queries
from tidemark.schemas import ANALYTICS_TABLE

T0 = dt.datetime(2025, 11, 15, 0, 0)


def ms(d: dt.datetime) -> int:
    return int(d.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


@pytest.fixture()
def table(spark):
    rows = []
    for sid, n, base in (("a", 3, 0), ("b", 2, 10), ("c", 2, 10)):
        for i in range(n):
            t = T0 + dt.timedelta(minutes=base + i)
            rows.append((sid, ms(t), Decimal(f"{20 + i}.50"), Decimal(f"{50 + i}.00"), T0 + dt.timedelta(hours=i)))
    rows.append(("d", ms(T0), None, None, T0))
    return spark.createDataFrame(rows, ANALYTICS_TABLE)


@pytest.mark.parametrize(
    "n,default,maximum,want",
    [(0, 50, 1000, 50), (1001, 50, 1000, 50), (5, 50, 1000, 5), (0, 100, 10000, 100), (10001, 100, 10000, 100), (10000, 100, 10000, 10000)],
)
def test_limit_rule(n, default, maximum, want):
    assert queries.effective_limit(n, default, maximum) == want


def test_list_sensors_order_and_ties(table):
    out = queries.list_sensors(table, limit=2).collect()
    # b and c share the latest reading; the id breaks the tie.
    assert [r["sensor_id"] for r in out] == ["b", "c"]
    assert out[0]["latest_reading"] == T0 + dt.timedelta(minutes=11)
    assert out[0]["reading_count"] == 2
    assert len(queries.list_sensors(table, limit=0).collect()) == 4  # 0 -> default 50


def test_sensor_data_inclusive_and_unknown(table):
    start, end = T0, T0 + dt.timedelta(minutes=1)
    out = queries.sensor_data(table, "a", start, end).collect()
    assert [r["timestamp"] for r in out] == [T0 + dt.timedelta(minutes=1), T0]
    assert out[0]["temperature"] == 21.5 and isinstance(out[0]["temperature"], float)
    assert queries.sensor_data(table, "zzz", start, end).collect() == []
    assert len(queries.sensor_data(table, "a", start, T0 + dt.timedelta(hours=1), limit=2).collect()) == 2


def test_default_period_is_seven_days_before_as_of(table):
    as_of = T0 + dt.timedelta(days=7, minutes=1)
    out = queries.sensor_data(table, "a", as_of=as_of).collect()
    assert [r["timestamp"] for r in out] == [T0 + dt.timedelta(minutes=2), T0 + dt.timedelta(minutes=1)]


def test_stats_and_null_to_zero(table):
    end = T0 + dt.timedelta(days=1)
    a = queries.sensor_stats(table, "a", T0, end).first()
    assert (a["temperature_min"], a["temperature_max"], a["temperature_avg"]) == (20.5, 22.5, 21.5)
    assert a["reading_count"] == 3 and a["period_start"] == T0 and a["period_end"] == end
    d = queries.sensor_stats(table, "d", T0, end).first()
    assert d["temperature_avg"] == 0.0 and d["humidity_max"] == 0.0
    assert queries.sensor_stats(table, "zzz", T0, end).collect() == []
    assert queries.all_sensor_stats(table, T0, end).count() == 4


def test_recent_and_counts(table):
    top = queries.recent(table, 2).collect()
    assert [r["created_at"] for r in top] == [T0 + dt.timedelta(hours=2)] + [T0 + dt.timedelta(hours=1)]
    assert queries.count_readings(table).first()["reading_count"] == 8
    assert queries.count_readings(table, "b").first()["reading_count"] == 2


def test_audits(table):
    end = T0 + dt.timedelta(days=1)
    counts = audit.audit_counts(table, T0, end).collect()
    assert all(r["ok"] for r in counts) and len(counts) == 4
    ranges = audit.audit_ranges(table, T0, end).collect()
    assert all(r["ok"] for r in ranges)
    sent = table.selectExpr("sensor_id", "timestamp", "cast(temperature as double) temperature", "cast(humidity as double) humidity")
    changed = sent.where("sensor_id <> 'c'").selectExpr(
        "sensor_id", "timestamp", "if(sensor_id = 'b', temperature + 1, temperature) temperature", "humidity"
    )
    summary = {r["status"]: r["rows"] for r in audit.integrity_summary(audit.audit_integrity(changed, table.where("sensor_id <> 'a'"))).collect()}
    assert summary == {"match": 1, "mismatch": 2, "missing": 3, "unexpected": 2}
