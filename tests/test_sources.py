"""Sources and sinks: topic options (S1/S2), archive (S7), checkpoint folder."""

from __future__ import annotations

import datetime as dt

import pytest

from tidemark.session import checkpoint_root, scratch_path
from tidemark.sources.store import read_archive, write_archive
from tidemark.sources.topic import topic_sink_options, topic_source_options, write_topic
from tidemark.schemas import WINDOW_MEAN


def test_topic_source_options_follow_the_job():
    opts = topic_source_options("broker:9092")
    assert opts == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "sensor-data",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10000",
    }
    assert "maxOffsetsPerTrigger" not in topic_source_options("b", max_per_trigger=None)


def test_topic_sink_needs_durable_checkpoint(spark):
    assert topic_sink_options("b", "analytics-data", "/shared/ckpt")["checkpointLocation"] == "/shared/ckpt"
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    batch_writer = write_topic(df, "broker:9092")  # batch twin needs no checkpoint
    assert batch_writer is not None
    stream = spark.readStream.format("rate").load().selectExpr("cast(value as string) as value")
    with pytest.raises(ValueError):
        write_topic(stream, "broker:9092", checkpoint=None)


def test_archive_partitions_by_date_and_prunes(spark, scratch):
    day1 = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [("a", day1, 1.0, 2.0), ("b", day1 + 86_400_000, 3.0, 4.0), ("a", day1 + 30_000, 5.0, 6.0)]
    write_archive(spark.createDataFrame(rows, WINDOW_MEAN), f"{scratch}/arch")
    back = read_archive(spark, f"{scratch}/arch")
    assert sorted((r["sensor_id"], str(r["date"])) for r in back.collect()) == [
        ("a", "2024-01-01"),
        ("a", "2024-01-01"),
        ("b", "2024-01-02"),
    ]
    one_day = back.where("date = DATE'2024-01-02'")
    plan = one_day.sparkSession._jvm.PythonSQLUtils.explainString(one_day._jdf.queryExecution(), "formatted")
    assert "PartitionFilters" in plan and one_day.count() == 1


def test_organize_drops_and_orders(spark):
    from tidemark.functions.labels import organize

    df = spark.createDataFrame([(1, "a", 2.0, "x")], "Time int, pod string, value double, __name__ string")
    assert organize(df, ["Time", "__name__"], ["value"]).columns == ["value", "pod"]


def test_checkpoint_root_is_stable_and_scratch_is_fresh(spark):
    root = checkpoint_root(spark)
    assert checkpoint_root(spark) == root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)
