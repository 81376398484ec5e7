"""Series dictionary: label sets once, samples by id."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from tidemark.functions.labels import match_labels
from tidemark.operators.metrics import counter_rate, sum_by
from tidemark.sources.series import read_matched, read_series, with_labels, write_series

KIND = "metric string, namespace string, pod string, container string, ts timestamp, value decimal(18,6)"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def at(minute, metric, namespace, pod, container, value):
    return metric, namespace, pod, container, T0 + dt.timedelta(minutes=minute), Decimal(value)


def batch(first, new=False):
    rows = []
    for m in range(first, first + 5):
        for pod in ("a", "b", None) + (("late",) if new else ()):
            for ns in ("x", "y"):
                rows.append(at(m, "up", ns, pod, "c" if pod == "a" else None, m * 2 + ord(ns)))
        rows.append(at(m, "down", "x", "a", "", m))
    return rows


@pytest.fixture()
def stored(spark, scratch):
    parts = [spark.createDataFrame(batch(0), KIND), spark.createDataFrame(batch(5, new=True), KIND)]
    for n, part in enumerate(parts):
        write_series(part, n, scratch, buckets=7)
    return scratch, parts[0].union(parts[1])


def labels_of(df):
    return sorted((r.metric, r.namespace, r.pod or "", r.container or "") for r in df.collect())


def test_each_label_set_is_stored_once(spark, stored):
    path, rows = stored
    want = sorted(set(labels_of(rows)))
    assert labels_of(read_series(spark, path)) == want and len(want) == 9
    write_series(spark.createDataFrame(batch(5, new=True), KIND), 1, path, buckets=7)  # replayed
    assert labels_of(read_series(spark, path)) == want
    assert spark.read.parquet(f"{path}/samples").count() == rows.count()
    assert read_series(spark, path).select("series_id").distinct().count() == 9
    write_series(spark.createDataFrame([], KIND), 2, path, buckets=7)  # an empty batch
    assert labels_of(read_series(spark, path)) == want


def test_absent_and_empty_labels_are_one_series(spark, scratch):
    rows = [at(0, "up", "x", "", None, 1), at(1, "up", "x", None, "", 2)]
    write_series(spark.createDataFrame(rows, KIND), 0, scratch)
    assert read_series(spark, scratch).count() == 1
    assert read_matched(spark, scratch, [("pod", "=", "")]).count() == 2


@pytest.mark.parametrize(
    "matchers",
    [
        [("metric", "=", "up"), ("namespace", "=~", "x|z")],
        [("metric", "!=", "up")],
        [("metric", "=", "up"), ("pod", "!~", "a|b"), ("container", "=", "")],
        [("namespace", "=", "none")],
        [],
    ],
)
def test_rates_by_id_equal_rates_by_labels(spark, stored, matchers):
    path, rows = stored
    args = ("3 minutes", "1 minute")
    direct = sum_by(counter_rate(match_labels(rows, matchers), *args), ["namespace"])
    by_id = counter_rate(read_matched(spark, path, matchers), *args, series=["series_id"])
    by_id = sum_by(with_labels(by_id, read_series(spark, path, matchers), ["namespace"]), ["namespace"])
    cols = ["t", "namespace", "increase", "rate"]
    assert sorted(map(tuple, by_id.select(cols).collect())) == sorted(map(tuple, direct.select(cols).collect()))


def test_scan_is_pruned_at_run_time_and_reads_no_labels(spark, stored):
    path, rows = stored
    found = read_matched(spark, path, [("metric", "=", "down")])
    assert found.count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "ts#" in line)
    assert "dynamicpruning" in scan
    assert not any(c in scan.partition("ReadSchema")[2] for c in ("namespace", "pod", "container"))


def test_nothing_stored(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_series(spark, f"{scratch}/none")
