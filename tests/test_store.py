"""The stored table: marks, corrections after closing, replays, purge in place; accounts of late rows."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from test_streaming import _raw_file

from tidemark.sources import store
from tidemark.sources.store import closed_path, compact_table, purge_in_place, purge_table, read_table, vacuum_table, write_table
from tidemark.sources.topic import read_raw_files
from tidemark.streaming.wiring import start_accounted_sink

DAY = 86_400_000
T0 = dt.datetime(2024, 1, 1)
KIND = "sensor_id string, timestamp long, batch_id long, temperature double, humidity double, created_at timestamp"


def put(spark, path, *rows):
    write_table(spark.createDataFrame([(s, d * DAY, b, v, v, T0) for s, d, b, v in rows], KIND), path)


def values(spark, path, **kw):
    return sorted((r["sensor_id"], r["timestamp"] // DAY, r["temperature"]) for r in read_table(spark, path, **kw).collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("policy", ["last", "first"])
def test_corrections_and_new_keys_of_closed_days_show(spark, scratch, policy):
    plain, closed = f"{scratch}/plain", f"{scratch}/closed"
    batches = [
        [("a", 0, 0, 1.0), ("a", 1, 0, 1.0)],
        [("a", 1, 1, 2.0), ("b", 2, 1, 2.0)],
        [("a", 0, 2, 9.0), ("new", 0, 2, 3.0)],  # day 0 is closed by then
        [("a", 0, 3, 10.0), ("c", 5, 3, 4.0)],
    ]
    for b in batches[:2]:
        put(spark, plain, *b)
        put(spark, closed, *b)
    assert compact_table(spark, closed, "1970-01-03", policy) == ["1970-01-01", "1970-01-02"]
    before = files(closed_path(closed, policy))
    for b in (batches[2], batches[1]):  # then a replay
        put(spark, plain, *b)
        put(spark, closed, *b)
    assert values(spark, closed, policy=policy) == values(spark, plain, policy=policy)
    assert compact_table(spark, closed, "1970-01-04", policy) == ["1970-01-01", "1970-01-03"]  # day 1 has nothing new
    after = files(closed_path(closed, policy))
    assert before.items() <= after.items()  # nothing closed was touched
    put(spark, plain, *batches[3])
    put(spark, closed, *batches[3])
    want = values(spark, plain, policy=policy)
    assert values(spark, closed, policy=policy) == want
    vacuum_table(spark, closed, policy, folded=True)
    assert values(spark, closed, policy=policy) == want and len(files(closed_path(closed, policy))) < len(after)
    only = {"dates": ("1970-01-01", "1970-01-01"), "policy": policy}
    assert values(spark, closed, **only) == [v for v in want if v[1] == 0]
    assert values(spark, closed, dates=("1999-01-01", "1999-01-02"), policy=policy) == []


def test_missing_and_unreadable_folders_are_errors(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{scratch}/none")
    put(spark, f"{scratch}/t", ("a", 0, 0, 1.0))
    bad = f"{scratch}/t/date=1970-01-02/batch_id=1"
    os.makedirs(bad)
    with open(f"{bad}/part-0.parquet", "wb") as f:
        f.write(b"no parquet file")
    with pytest.raises(Exception, match="(?i)parquet|footer|FAILED_READ"):
        read_table(spark, f"{scratch}/t").collect()


def filled(spark, path):
    put(spark, path, ("a", 0, 0, 1.0), ("b", 0, 0, 1.0), ("b", 1, 0, 1.0), ("a", 3, 0, 1.0))
    compact_table(spark, path, "1970-01-03")
    put(spark, path, ("b", 0, 1, 2.0), ("b", 4, 1, 2.0), ("a", 5, 1, 2.0))
    return [("b", 0, 2.0), ("b", 1, 1.0), ("b", 4, 2.0)]


@pytest.mark.parametrize("as_frame", [False, True])
def test_purge_in_place_leaves_other_files(spark, scratch, as_frame):
    path = f"{scratch}/t"
    want = filled(spark, path)
    before = files(scratch)
    ids = spark.createDataFrame([("a",), ("a",)], "id string") if as_frame else ["a"]
    done = purge_in_place(spark, path, ids)
    assert done == {path: 3, closed_path(path): 1}
    assert values(spark, path) == want
    after = files(scratch)
    kept = {f for f in before if f in after}
    assert all(before[f] == after[f] for f in kept)
    assert all("date=1970-01-02" in f or "date=1970-01-05" in f or "batch_id=1" in f for f in kept) and len(kept) == 4
    assert purge_in_place(spark, path, ["a"]) == {path: 0, closed_path(path): 0}


@pytest.mark.parametrize("where", ["_overwrite", "remove", "listed"])
def test_purge_is_finished_after_a_failure(spark, scratch, monkeypatch, where):
    path = f"{scratch}/t"
    want = filled(spark, path)
    with monkeypatch.context() as m:
        if where == "remove":  # partitions put in place, emptied ones not yet removed
            real = store.remove
            m.setattr(store, "remove", lambda s, p: (_ for _ in ()).throw(OSError("lost")) if "date=" in p else real(s, p))
        elif where == "listed":  # kept rows written, their list not yet
            m.setattr(store, "_finish_purge", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        else:
            m.setattr(store, "_overwrite", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            purge_in_place(spark, path, ["a"])
    purge_in_place(spark, path, ["a"])
    assert values(spark, path) == want


def test_purged_copy_of_a_closed_table(spark, scratch):
    put(spark, f"{scratch}/t", ("a", 0, 0, 1.0), ("b", 0, 0, 2.0))
    compact_table(spark, f"{scratch}/t", "1970-01-02")
    vacuum_table(spark, f"{scratch}/t", folded=True)
    purge_table(spark, f"{scratch}/t", f"{scratch}/u", ["a"])
    assert values(spark, f"{scratch}/u") == [("b", 0, 2.0)]


def test_late_rows_have_the_one_batch_lag(spark, scratch):
    """F6, second run: the row behind the newest watermark is merged once, the rest is late."""
    batches = [
        [("10:00:01", 10.0)], [("10:00:02", 20.0)], [("10:05:00", 1.0)], [("10:05:01", 3.0), ("10:00:04", 30.0)],
        [("10:00:03", 99.0), ("10:04:10", 7.0), ("10:03:50", 8.0), ("10:03:10", 9.0)],
    ]
    os.makedirs(f"{scratch}/raw")
    for i, rows in enumerate(batches):
        _raw_file(f"{scratch}/raw/part-{i:03d}.parquet", rows, i * 10, 1_700_000_000 + i * 10)
        raw = read_raw_files(spark, f"{scratch}/raw", max_files_per_trigger=1)
        query = start_accounted_sink(  # a restart after each batch
            raw, f"{scratch}/t", f"{scratch}/d", f"{scratch}/m", f"{scratch}/a", f"{scratch}/c", "30 seconds", "1 minute", available_now=True, state_partitions=2
        )
        query.awaitTermination()
    late = {r["offset"] for r in spark.read.parquet(f"{scratch}/m").where("reason = 'late'").collect()}
    assert late == {40, 42, 43}
    accounts = spark.read.parquet(f"{scratch}/a").orderBy("batch_id").collect()
    assert [(r["messages"], r["accepted"], r["late"]) for r in accounts] == [(1, 1, 0), (1, 1, 0), (1, 1, 0), (2, 2, 0), (4, 1, 3)]
    means = {dt.datetime.fromtimestamp(r["timestamp"] / 1000, dt.timezone.utc).strftime("%H:%M:%S"): float(r["temperature"]) for r in read_table(spark, f"{scratch}/t").collect()}
    assert means == {"10:00:00": 20.0, "10:05:00": 2.0, "10:04:00": 7.0}
