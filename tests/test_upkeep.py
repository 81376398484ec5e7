"""What is kept next to the table: overview summaries, digests, parts of means; intake limits."""

from __future__ import annotations

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F
from test_store import DAY, KIND, T0, files
from test_streaming import _raw_file

from tidemark.operators import audit
from tidemark.operators.queries import sensor_overview
from tidemark.operators.windows import longer_parts, means_of_parts, weighted_stats, window_mean, window_parts
from tidemark.sources.store import closed_path, compact_table, purge_in_place, read_archive, read_table, vacuum_table, write_table
from tidemark.sources.summaries import compact_summaries, maintained_overview, summarize_batch
from tidemark.sources.topic import read_raw_files
from tidemark.streaming.wiring import open_windows, run_until_stopped, start_archive, start_table_sink, window_stream

HOUR = 3_600_000


def rows_of(df):
    return sorted(tuple(r) for r in df.select("sensor_id", "first_ts", "latest_ts", "reading_count").collect())


def arrive(spark, root, batch, *rows):
    df = spark.createDataFrame([(s, t, batch, v, v, T0) for s, t, v in rows], KIND)
    summarize_batch(df, batch, f"{root}/table", f"{root}/summaries")
    write_table(df, f"{root}/table")


def check(spark, root):
    assert rows_of(maintained_overview(spark, f"{root}/summaries")) == rows_of(sensor_overview(read_table(spark, f"{root}/table")))


def test_overview_follows_the_table(spark, scratch):
    with pytest.raises(FileNotFoundError):
        maintained_overview(spark, f"{scratch}/summaries")
    first = [("a", HOUR, 1.0), ("a", 2 * HOUR, 1.0), ("b", DAY, 1.0)]
    second = [("a", 2 * HOUR, 5.0), ("a", DAY + HOUR, 5.0), ("c", 0, 5.0)]  # a correction and new keys
    arrive(spark, scratch, 0, *first)
    check(spark, scratch)
    arrive(spark, scratch, 1, *second)
    check(spark, scratch)
    arrive(spark, scratch, 1, *second)  # replayed
    check(spark, scratch)
    assert compact_table(spark, f"{scratch}/table", "1970-01-02") == ["1970-01-01"]
    assert compact_summaries(spark, f"{scratch}/summaries", "1970-01-02") == ["1970-01-01"]
    vacuum_table(spark, f"{scratch}/table", folded=True)
    vacuum_table(spark, f"{scratch}/summaries", folded=True)
    check(spark, scratch)
    arrive(spark, scratch, 1, *second)  # replayed after its day was closed
    check(spark, scratch)
    arrive(spark, scratch, 2, ("a", 2 * HOUR, 7.0), ("d", 3 * HOUR, 7.0))  # into the closed day
    check(spark, scratch)
    before = files(closed_path(f"{scratch}/summaries"))
    assert compact_summaries(spark, f"{scratch}/summaries", "1970-01-02") == ["1970-01-01"]
    assert compact_summaries(spark, f"{scratch}/summaries", "1970-01-02") == []
    assert before.items() <= files(closed_path(f"{scratch}/summaries")).items()
    check(spark, scratch)
    for path in ("table", "summaries"):
        purge_in_place(spark, f"{scratch}/{path}", ["a"])
    check(spark, scratch)
    assert {r[0] for r in rows_of(maintained_overview(spark, f"{scratch}/summaries"))} == {"b", "c", "d"}


def test_summaries_of_an_empty_batch(spark, scratch):
    arrive(spark, scratch, 0, ("a", HOUR, 1.0))
    arrive(spark, scratch, 1)
    check(spark, scratch)


def test_a_batch_cut_off_before_its_rows_were_stored(spark, scratch):
    arrive(spark, scratch, 0, ("a", HOUR, 1.0))
    rows = [("a", 2 * HOUR, 2.0), ("b", HOUR, 2.0)]
    df = spark.createDataFrame([(s, t, 1, v, v, T0) for s, t, v in rows], KIND)
    summarize_batch(df, 1, f"{scratch}/table", f"{scratch}/summaries")  # and then the job dies
    arrive(spark, scratch, 1, *rows)
    check(spark, scratch)


def _sides(spark, changed=None):
    sent = spark.range(600).select(
        F.concat(F.lit("s"), F.col("id") % 7).alias("sensor_id"),
        (F.col("id") * 1_800_000).alias("timestamp"),
        (F.col("id") % 31 + 0.125).alias("temperature"),
        F.when(F.col("id") % 50 != 3, F.col("id") % 29 + 0.5).alias("humidity"),
    )
    stored = sent.withColumns({m: F.col(m).cast("decimal(5,2)") for m in ("temperature", "humidity")})
    return sent, stored if changed is None else changed(stored)


def _same_as_plain(sent, stored):
    summary, findings = audit.audit_by_digest(sent, stored, buckets=4)
    plain = audit.audit_integrity(sent, stored)
    assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, audit.integrity_summary(plain).collect()))
    key = ["sensor_id", "timestamp", "status"]
    want = plain.where("status <> 'match'").select(*key).collect()
    assert sorted(map(repr, findings.select(*key).collect())) == sorted(map(repr, want))
    return summary, want


def test_equal_sides_are_not_joined(spark):
    summary, findings = _same_as_plain(*_sides(spark))
    assert findings == []
    assert "Join" not in summary._jdf.queryExecution().optimizedPlan().toString()


def test_digests_shuffle_no_rows(spark):
    plan = audit.integrity_digests(*_sides(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan  # partial sums only


@pytest.mark.parametrize(
    "change",
    [
        lambda t: t.where("timestamp <> 1800000 * 77"),
        lambda t: t.union(t.where("timestamp = 1800000 * 78").withColumn("timestamp", F.lit(5).cast("long"))),
        lambda t: t.withColumn("humidity", F.when(F.col("timestamp") != 1800000 * 79, F.col("humidity"))),
        # the values of two columns change places around a null
        lambda t: t.withColumns({
            "temperature": F.when(F.col("humidity").isNotNull(), F.col("temperature")),
            "humidity": F.coalesce("humidity", "temperature"),
        }),
        lambda t: t.withColumn("sensor_id", F.when(F.col("timestamp") != 1800000 * 80, F.col("sensor_id"))),
        lambda t: t.where("false"),
    ],
)
def test_differences_are_found_where_they_are(spark, change):
    _, findings = _same_as_plain(*_sides(spark, change))
    assert findings


def test_null_ids_on_both_sides_do_not_match(spark):
    nameless = lambda t: t.withColumn("sensor_id", F.when(F.col("timestamp") != 1800000 * 9, F.col("sensor_id")))
    sent, stored = _sides(spark)
    _, findings = _same_as_plain(nameless(sent), nameless(stored))
    assert sorted(r["status"] for r in findings) == ["missing", "unexpected"]


def test_empty_sides(spark):
    sent, stored = _sides(spark)
    summary, findings = audit.audit_by_digest(sent.where("false"), stored.where("false"))
    assert summary.collect() == [] and findings.collect() == []


def _readings(spark, values):
    at = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=7 * i)
    rows = [("a" if i % 3 else "b", at(i), v, v if i % 4 else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "sensor_id string, timestamp timestamp, temperature double, humidity double")


def test_merged_means_equal_direct_means(spark):
    readings = _readings(spark, [i / 10 for i in range(500)])
    parts = window_parts(readings, "30 seconds")
    for width in ("10 minutes", "1 day"):
        want = sorted(map(tuple, window_mean(readings, width, with_count=True).collect()))
        got = longer_parts(longer_parts(parts, "1 minute"), width)
        assert sorted(map(tuple, means_of_parts(got).collect())) == want  # to the last bit
    halves = window_parts(readings.where("second(timestamp) % 2 = 0")).union(window_parts(readings.where("second(timestamp) % 2 = 1")))
    want = sorted(map(tuple, window_mean(readings, "30 seconds", with_count=True).collect()))
    assert sorted(map(tuple, means_of_parts(longer_parts(halves, "30 seconds")).collect())) == want


def test_weighted_stats_weigh_readings(spark):
    rows = [("a", T0, 10.0, None)] * 3 + [("a", T0 + dt.timedelta(minutes=1), 20.0, None)]
    readings = spark.createDataFrame(rows, "sensor_id string, timestamp timestamp, temperature double, humidity double")
    (r,) = weighted_stats(window_parts(readings)).collect()
    assert (r["temperature_min"], r["temperature_max"], r["temperature_avg"], r["readings"]) == (10.0, 20.0, 12.5, 4)
    assert r["humidity_avg"] is None and r["humidity_min"] is None


@pytest.mark.parametrize("odd", [1e-9, 1e300, float("nan"), float("inf")])
def test_values_that_are_no_whole_units_take_part(spark, odd):
    readings = _readings(spark, [1.0, 2.0, odd, 4.0, 5.0, 6.0, 7.0])
    direct = {r["sensor_id"]: r for r in window_mean(readings, "1 day").collect()}
    merged = {r["sensor_id"]: r for r in means_of_parts(longer_parts(window_parts(readings), "1 day")).collect()}
    for sid, r in direct.items():
        for m in ("temperature", "humidity"):
            a, b = r[m], merged[sid][m]
            assert (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b)


def _raw_files(path, n):
    os.makedirs(path, exist_ok=True)
    for i in range(n):
        _raw_file(f"{path}/{i}.parquet", [(f"12:{2 * i:02}:{k}0", 20.0 + k) for k in range(3)], 3 * i, 1_700_000_000 + i)


def test_intake_limit_and_trigger_give_several_batches(spark, scratch):
    _raw_files(f"{scratch}/raw", 5)
    raw = read_raw_files(spark, f"{scratch}/raw", max_files_per_trigger=1)
    query = start_table_sink(
        window_stream(raw), f"{scratch}/table", f"{scratch}/dead", f"{scratch}/checkpoint", trigger="200 milliseconds",
        state_partitions=2, summary_path=f"{scratch}/summaries",
    )
    try:
        query.processAllAvailable()
        progress = [p["numInputRows"] if isinstance(p, dict) else p.numInputRows for p in query.recentProgress]
    finally:
        query.stop()
    assert [n for n in progress if n] == [3] * 5
    check(spark, scratch)


def test_overview_after_each_restart(spark, scratch):
    for n in (1, 2, 4):
        _raw_files(f"{scratch}/raw", n)
        query = start_table_sink(
            window_stream(read_raw_files(spark, f"{scratch}/raw")), f"{scratch}/table", f"{scratch}/dead", f"{scratch}/checkpoint",
            available_now=True, state_partitions=2, summary_path=f"{scratch}/summaries",
        )
        run_until_stopped(query)
        check(spark, scratch)


def test_archive_and_open_windows_are_all_windows(spark, scratch):
    for n in (2, 5):
        _raw_files(f"{scratch}/raw", n)
        means = window_stream(read_raw_files(spark, f"{scratch}/raw"))
        run_until_stopped(start_archive(means, f"{scratch}/archive", f"{scratch}/checkpoint", available_now=True))
        done = set(map(tuple, read_archive(spark, f"{scratch}/archive").select("sensor_id", "timestamp", "temperature", "humidity").collect()))
        held = set(map(tuple, open_windows(spark, f"{scratch}/checkpoint").collect()))
        everything = window_stream(read_raw_files(spark, f"{scratch}/raw", streaming=False))
        assert held and not done & held and done | held == set(map(tuple, everything.collect()))
    assert done


def test_state_of_another_query_is_refused(spark, scratch):
    _raw_files(f"{scratch}/raw", 1)
    counts = read_raw_files(spark, f"{scratch}/raw").groupBy("key").count()
    query = counts.writeStream.outputMode("update").foreachBatch(lambda df, i: df.write.format("noop").mode("append").save()).option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    with pytest.raises(ValueError, match="not that of window means"):
        open_windows(spark, f"{scratch}/ck")
