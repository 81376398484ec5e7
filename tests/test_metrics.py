"""Metric operators on hand-made samples (F8) against a brute-force reference."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.labels import match_labels
from tidemark.functions.numeric import band, scale
from tidemark.operators import metrics
from tidemark.operators.series import previous_in_series, running_total
from tidemark.schemas import METRIC_SAMPLE

T0 = dt.datetime(2025, 11, 15, 10, 0, 0)
SERIES = ["metric", "namespace", "pod", "container"]


def sample(metric, pod, seconds, value, container="app", ns="api"):
    return (metric, ns, pod, container, T0 + dt.timedelta(seconds=seconds), Decimal(str(value)))


def brute_rates(rows, range_s, step_s, t_lo, t_hi):
    """Reset-aware increase over (t - range, t] from the definition."""
    by_series = {}
    for r in rows:
        by_series.setdefault(r[:4], []).append((r[4], r[5]))
    out = {}
    epoch = dt.datetime(1970, 1, 1)
    k = -(-int((t_lo - epoch).total_seconds()) // step_s)
    while k * step_s <= (t_hi - epoch).total_seconds():
        t = epoch + dt.timedelta(seconds=k * step_s)
        for key, pts in by_series.items():
            inside = sorted(p for p in pts if t - dt.timedelta(seconds=range_s) < p[0] <= t)
            if len(inside) >= 2:
                inc = sum((b[1] - a[1]) if b[1] >= a[1] else b[1] for a, b in zip(inside, inside[1:]))
                out[(*key, t)] = inc
        k += 1
    return out


def spark_rates(spark, rows, range_, step, **kw):
    df = spark.createDataFrame(rows, METRIC_SAMPLE)
    got = metrics.counter_rate(df, range_, step, **kw).collect()
    return {(r["metric"], r["namespace"], r["pod"], r["container"], r["t"]): r["increase"] for r in got}, got


HAND = [
    # counter with a reset between 30 s and 45 s
    *[sample("rx_total", "p1", s, v) for s, v in ((0, 0), (15, 10), (30, 20), (45, 5), (60, 15))],
    *[sample("tx_total", "p1", s, v) for s, v in ((0, 1), (15, 2), (30, 3), (45, 4), (60, 5))],
    # receive without transmit
    *[sample("rx_total", "p2", s, v) for s, v in ((0, 100), (30, 160))],
    # a single sample: never a rate
    sample("rx_total", "p3", 10, 7),
    # empty container label
    *[sample("rx_total", "p4", s, v, container="") for s, v in ((0, 1), (15, 2))],
]


def test_rate_matches_definition(spark):
    want = brute_rates(HAND, 300, 15, T0 - dt.timedelta(minutes=10), T0 + dt.timedelta(minutes=10))
    got, rows = spark_rates(spark, HAND, "5 minutes", "15 seconds")
    assert got == want
    assert not any(r["pod"] == "p3" for r in rows)
    at60 = {r["pod"]: r for r in rows if r["t"] == T0 + dt.timedelta(seconds=60) and r["metric"] == "rx_total"}
    assert at60["p1"]["increase"] == Decimal("35")  # 10 + 10 + 5 (reset) + 10
    assert at60["p1"]["rate"] == 35 / 300


def test_rate_respects_eval_bounds(spark):
    got, rows = spark_rates(spark, HAND, "5 minutes", "15 seconds", start="2025-11-15 10:00:30", end="2025-11-15 10:01:00")
    assert {r["t"] for r in rows} == {T0 + dt.timedelta(seconds=s) for s in (30, 45, 60)}


def test_sum_pair_topk_share(spark):
    df = spark.createDataFrame(HAND, METRIC_SAMPLE)
    rates = metrics.counter_rate(df, "5 minutes", "15 seconds")
    t60 = F.col("t") == F.lit(T0 + dt.timedelta(seconds=60))
    total = metrics.sum_by(rates.where(F.col("metric") == "rx_total")).where(t60).first()
    assert total["increase"] == Decimal("35") + Decimal("60") + Decimal("1")
    pairs = metrics.add_series(rates, "rx_total", "tx_total").where(t60).collect()
    assert [(r["pod"], r["increase"]) for r in pairs] == [("p1", Decimal("39"))]  # p2 has no transmit
    by_pod = metrics.sum_by(rates.where(F.col("metric") == "rx_total"), ["pod"])
    top = metrics.topk(by_pod, 2, "rate", ["t"], ["pod"]).where(t60).orderBy("rank").collect()
    assert [r["pod"] for r in top] == ["p2", "p1"] and [r["rank"] for r in top] == [1, 2]
    shares = {r["pod"]: r["share"] for r in metrics.share_of_total(by_pod, "increase").where(t60).collect()}
    assert abs(sum(shares.values()) - 1.0) < 1e-12 and shares["p2"] == 60 / 96


def test_instant_count_last_and_matchers(spark):
    df = spark.createDataFrame(HAND, METRIC_SAMPLE)
    inst = metrics.instant_value(df, "15 seconds", "5 minutes")
    at0 = {r["pod"]: r["value"] for r in inst.where(F.col("t") == F.lit(T0 + dt.timedelta(seconds=15))).where("metric = 'rx_total'").collect()}
    assert at0 == {"p1": Decimal("10"), "p2": Decimal("100"), "p3": Decimal("7"), "p4": Decimal("2")}
    counts = {r["t"]: r["series"] for r in metrics.series_count(inst, ["pod"]).collect()}
    assert counts[T0 + dt.timedelta(seconds=15)] == 4
    last = {(r["metric"], r["pod"]): r["value"] for r in metrics.last_not_null(df).collect()}
    assert last[("rx_total", "p1")] == Decimal("15") and last[("rx_total", "p3")] == Decimal("7")
    kept = match_labels(df, [("container", "!=", ""), ("pod", "=~", "p[12]"), ("metric", "!~", "tx.*")])
    assert {r["pod"] for r in kept.collect()} == {"p1", "p2"}
    absent = match_labels(df.withColumn("container", F.lit(None).cast("string")), [("container", "=", "")])
    assert absent.count() == len(HAND)


def test_band_and_scale(spark):
    df = spark.createDataFrame([(None,), (0.4,), (0.5,), (0.99,), (1.0,), (3.0,)], "v double")
    steps = [(None, "green"), (0.5, "yellow"), (1.0, "red")]
    got = [r[0] for r in df.select(band("v", steps)).collect()]
    assert got == [None, "green", "yellow", "yellow", "red", "red"]
    mib = spark.createDataFrame([(3 * 1024 * 1024,)], "b long").select(scale("b", "MiB"), scale("b", "GiB")).first()
    assert mib[0] == 3.0 and mib[1] == 3 / 1024


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["p1", "p2"]), st.integers(0, 3 * 86400), st.integers(0, 50)),
        min_size=1,
        max_size=40,
        unique_by=lambda x: (x[0], x[1]),
    )
)
def test_bucketed_helpers_equal_plain_windows(spark, points):
    rows = [("m", "ns", p, "c", T0 + dt.timedelta(seconds=s), Decimal(v)) for p, s, v in points]
    df = spark.createDataFrame(rows, METRIC_SAMPLE)
    w = Window.partitionBy(*SERIES).orderBy("ts")
    plain = df.withColumn("prev_ts", F.lag("ts").over(w)).withColumn("prev_value", F.lag("value").over(w))
    bucketed = previous_in_series(df, SERIES, "ts", ("value",), bucket_seconds=3600)
    cols = [*SERIES, "ts", "value", "prev_ts", "prev_value"]
    assert sorted(map(tuple, plain.select(*cols).collect())) == sorted(map(tuple, bucketed.select(*cols).collect()))
    day = F.to_date("ts")
    a = running_total(df.withColumn("d", day), ["pod"], ["ts"], {"cum": "value"})
    b = running_total(df.withColumn("d", day).withColumn("h", F.hour("ts")), ["pod", "d"], ["ts"], {"cum": "value"}, split="h")
    c = running_total(df.withColumn("d", day), ["pod", "d"], ["ts"], {"cum": "value"})
    assert sorted(map(tuple, b.select("pod", "ts", "cum").collect())) == sorted(map(tuple, c.select("pod", "ts", "cum").collect()))
    assert a.count() == len(rows)
    want = brute_rates(rows, 86400, 6 * 3600, T0 - dt.timedelta(days=1), T0 + dt.timedelta(days=5))
    got, _ = spark_rates(spark, rows, "1 day", "6 hours")
    assert got == want


def test_map_labels_flatten_and_instant_topk(spark):
    from tidemark.functions.labels import labels_to_columns

    rows = [
        ("rx_total", {"namespace": "api", "pod": "p1", "container": "app"}, T0, Decimal("1")),
        ("rx_total", {"namespace": "api", "pod": "p1", "container": "app"}, T0 + dt.timedelta(seconds=15), Decimal("4")),
        ("rx_total", {"namespace": "api", "pod": "p2"}, T0, Decimal("1")),
        ("rx_total", {"namespace": "api", "pod": "p2"}, T0 + dt.timedelta(seconds=15), Decimal("2")),
    ]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp, value decimal(38,6)")
    flat = labels_to_columns(df, ["namespace", "pod", "container"])
    assert flat.columns == ["metric", "ts", "value", "namespace", "pod", "container"]
    assert match_labels(flat, [("container", "=", "")]).select("pod").distinct().collect()[0][0] == "p2"
    rates = metrics.counter_rate(flat, "5 minutes", "15 seconds")
    at = rates.where(F.col("t") == F.lit(T0 + dt.timedelta(seconds=15)))
    top = metrics.topk(metrics.sum_by(at, ["pod"]), 1, "rate", partition=[], tiebreak=["pod"])
    assert [(r["pod"], r["increase"]) for r in top.collect()] == [("p1", Decimal("3"))]
    plan = spark._jvm.PythonSQLUtils.explainString(top._jdf.queryExecution(), "simple")
    assert "TakeOrderedAndProject" in plan


def test_tasks_of_the_rates_follow_the_rows(spark):
    """Ordered work is dealt into the given number of parts, once; the rates stay the same."""
    from tidemark.operators.series import ROWS_PER_TASK, tasks_for

    assert tasks_for(0) is tasks_for(4 * ROWS_PER_TASK) is None and tasks_for(60 * ROWS_PER_TASK) == 60
    schema = "metric string, namespace string, pod string, container string, ts timestamp, value decimal(38,6)"
    rows = [
        (m, ns, str(i % 5), None if i % 3 else "c", dt.datetime(2024, 1, 1 + i % 9, i % 24, i % 60), Decimal(i * i % 71))
        for i in range(600) for m, ns in (("a", "x"), (None, ""), ("", None))
    ]
    samples = spark.createDataFrame(rows, schema)
    plain, dealt = (metrics.counter_rate(samples, "2 days", "6 hours", tasks=n) for n in (None, 13))
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect())) and plain.where("metric IS NULL").count() > 0
    with_join = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = metrics.counter_rate(samples, "2 days", "6 hours", tasks=13)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_join)
    shuffles = re.findall(r"Exchange hashpartitioning\((.*), (\d+)\), (\w+)", plain_plan(plan))
    # both sides of the join are dealt by number; only the rows per bucket and the sums are shuffled besides
    assert sum(n == "13" and kind == "REPARTITION_BY_NUM" for _, n, kind in shuffles) == 2
    assert not any("_lo" in keys for keys, _, _ in shuffles)


def plain_plan(plan: str) -> str:
    return plan.split("== Initial Plan ==")[-1]
