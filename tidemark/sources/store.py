"""Analytics table storage (S4, S6), purge (P28), dead letters (S5) and archive.

File layout. *Updates*: parquet by ``date`` and ``batch_id``; a batch is
written with dynamic partition overwrite, so a replayed micro-batch
replaces its own files instead of adding duplicates (idempotent under
retries and executor loss). *Closed days*: one row per key, by ``date`` and
``upto``, the last batch folded into the day (its high-water mark).

``compact_table`` folds into each finished day the batches above its mark only and
writes the day under the new mark; an older mark of a day is superseded, and
``vacuum_table`` removes it. Readers take a closed day as it is, unless
updates above its mark exist: then both are collapsed by key, so corrections of
old days and new keys always show. Marks and batches come from a listing of
the partition folders, and become partition filters.

``purge_in_place`` rewrites the partitions that hold rows of the given
sensors and no others. What it keeps is written aside first, with a list of
the partitions, so that a purge cut off at any point is finished by the next.

JDBC: plain appends (a replayed micro-batch appends again; the table's key
has to refuse it) and partitioned reads on the long ``timestamp`` column.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import ms_to_ts
from tidemark.operators.table import TABLE_COLUMNS, collapse_updates, purge_sensors


def write_batch_partition(df: DataFrame, path: str, batch_col: str = "batch_id") -> None:
    """Write rows of one or more batches, replacing those batches' partitions."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch_col)
        .parquet(path)
    )


def dated(df: DataFrame) -> DataFrame:
    """Rows with the UTC ``date`` of their window start."""
    return df.withColumn("date", F.to_date(ms_to_ts("timestamp")))


def write_updates(df: DataFrame, path: str) -> None:
    """Table rows of one or more batches, by date and batch, replacing those batches.

    A batch that is replayed with the same rows has the same dates."""
    (
        # by range: few files per day, and a hot day is still split
        dated(df).repartitionByRange("date", "sensor_id", "timestamp").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch_id")
        .parquet(path)
    )


def closed_path(path: str, policy: str = "last") -> str:
    return f"{path.rstrip('/')}_closed" + ("" if policy == "last" else f"_{policy}")


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _files(spark, path)
    return fs.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _files(spark, path)
    fs.delete(folder, True)


def _partitions(spark: SparkSession, path: str, second: str) -> dict[str, list[int]]:
    """Day -> values of the second partition column, from the folder names (no file is read)."""
    fs, folder = _files(spark, f"{path.rstrip('/')}/date=*/{second}=*")
    out = defaultdict(list)
    for status in fs.globStatus(folder) or []:
        part = status.getPath()
        out[part.getParent().getName().partition("=")[2]].append(int(part.getName().partition("=")[2]))
    return dict(out)


def _on(days) -> Column:
    return F.col("date").isin([F.lit(d).cast("date") for d in sorted(days)]) if days else F.lit(False)


def _by_value(marks: dict[str, int]) -> dict[int, list[str]]:
    out = defaultdict(list)
    for day, mark in marks.items():
        out[mark].append(day)
    return out


class _Layout:
    """What is stored: closed days with their marks, and the batches that are not folded in."""

    def __init__(self, spark: SparkSession, path: str, policy: str):
        self.spark, self.path, self.closed = spark, path, closed_path(path, policy)
        self.all_marks = _partitions(spark, self.closed, "upto")
        self.marks = {d: max(v) for d, v in self.all_marks.items()}
        batches = _partitions(spark, path, "batch_id")
        self.batches = {d: [b for b in v if b > self.marks.get(d, -(2**62))] for d, v in batches.items()}
        self.batches = {d: v for d, v in self.batches.items() if v}
        if not batches and not self.marks:
            raise FileNotFoundError(path)

    def closed_rows(self, days: set[str]) -> DataFrame | None:
        """Rows of closed days under their newest mark; ``batch_id`` is the mark."""
        days = days & set(self.marks)
        if not days:
            return None
        rows = self.spark.read.parquet(self.closed)
        if days != set(self.marks):
            rows = rows.where(_on(days))
        old = defaultdict(list)
        for day in days:
            for mark in set(self.all_marks[day]) - {self.marks[day]}:
                old[mark].append(day)
        for mark, superseded in old.items():
            rows = rows.where(~((F.col("upto") == mark) & _on(superseded)))
        return rows.withColumn("batch_id", F.col("upto").cast("long")).drop("upto")

    def update_rows(self, days: set[str]) -> DataFrame | None:
        """Updates of the days that are above their marks."""
        days = days & set(self.batches)
        if not days:
            return None
        rows = self.spark.read.parquet(self.path).where(_on(days))
        for mark, closed in _by_value({d: self.marks[d] for d in days if d in self.marks}).items():
            rows = rows.where(~(_on(closed) & (F.col("batch_id") <= mark)))
        return rows.withColumn("batch_id", F.col("batch_id").cast("long"))

    def collapsed(self, days: set[str], policy: str) -> DataFrame | None:
        """One row per key of the days' closed rows and newer updates."""
        parts = [p.select("date", *TABLE_COLUMNS, "batch_id") for p in (self.closed_rows(days), self.update_rows(days)) if p is not None]
        if not parts:
            return None
        return collapse_updates(reduce(DataFrame.unionByName, parts).drop("date"), policy, order="batch_id").select(*TABLE_COLUMNS)


def write_closed(df: DataFrame, path: str, marks: dict[str, int] | None = None, policy: str = "last") -> None:
    """Rows with one row per key, by date, sorted so that filters skip row groups.

    ``marks``: the last batch folded into each day; without it none (-1). The range
    repartition splits a day that holds a third of all rows."""
    upto = F.lit(-1)
    for mark, days in _by_value(marks or {}).items():
        upto = F.when(_on(days), F.lit(mark)).otherwise(upto)
    (
        dated(df).withColumn("upto", upto).repartitionByRange("date", "sensor_id", "timestamp")
        .sortWithinPartitions("date", "sensor_id", "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "upto")
        .parquet(closed_path(path, policy))
    )


def compact_table(spark: SparkSession, path: str, before: str, policy: str = "last") -> list[str]:
    """Fold the days before ``before`` into one row per key; returns the days that had something new.

    Only batches above a day's mark are read, with the day's closed rows, and only those days are
    written. A run that is cut off leaves whole days under old or new marks; running it again does the rest."""
    layout = _Layout(spark, path, policy)
    days = {d for d in layout.batches if d < before}
    if days:
        rows = layout.collapsed(days, policy)
        write_closed(rows, path, {d: max(layout.batches[d]) for d in days}, policy)
    return sorted(days)


def vacuum_table(spark: SparkSession, path: str, policy: str = "last", folded: bool = False) -> None:
    """Remove closed days under superseded marks; with ``folded`` also the updates that a mark covers."""
    layout = _Layout(spark, path, policy)
    for day, marks in layout.all_marks.items():
        for mark in set(marks) - {layout.marks[day]}:
            remove(spark, f"{layout.closed}/date={day}/upto={mark}")
    if folded:
        for day, batches in _partitions(spark, path, "batch_id").items():
            for batch in batches:
                if batch <= layout.marks.get(day, -(2**62)):
                    remove(spark, f"{path.rstrip('/')}/date={day}/batch_id={batch}")


def write_table(df: DataFrame, path: str | None = None, jdbc: dict[str, str] | None = None) -> None:
    """Store table rows (with ``batch_id`` for file tables)."""
    if jdbc is not None:
        opts = dict(jdbc)
        url, table = opts.pop("url"), opts.pop("dbtable", "analytics_data")
        df.select(*TABLE_COLUMNS).write.jdbc(url=url, table=table, mode="append", properties=opts)
        return
    if path is None:
        raise ValueError("path or jdbc options required")
    write_updates(df, path)


def read_table(
    spark: SparkSession,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    policy: str = "last",
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 64,
    dates: tuple[str, str] | None = None,
) -> DataFrame:
    """The table as a DataFrame, one row per key.

    ``dates`` (first and last day) prunes partitions.

    File tables keep every stored update; ``policy`` picks the row per key
    (``last`` = upsert result, ``first`` = plain insert into a keyed table).
    JDBC reads split on the ``timestamp`` column between ``bounds``.
    """
    if jdbc is not None:
        opts = dict(jdbc)
        url, table = opts.pop("url"), opts.pop("dbtable", "analytics_data")
        if bounds is None:
            raise ValueError("a JDBC read needs bounds on timestamp; without them one task reads the whole table")
        return spark.read.jdbc(
            url=url,
            table=table,
            column="timestamp",
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=num_partitions,
            properties=opts,
        )
    layout = _Layout(spark, path, policy)
    stored = set(layout.marks) | set(layout.batches)
    if dates:
        stored = {d for d in stored if dates[0] <= d <= dates[1]}
    whole = stored - set(layout.batches)  # closed, and nothing newer
    parts = [layout.closed_rows(whole), layout.collapsed(stored & set(layout.batches), policy)]
    parts = [p.select(*TABLE_COLUMNS) for p in parts if p is not None]
    if not parts:  # no such day
        kept = closed_path(path, policy) if layout.marks else path
        return spark.read.parquet(kept).where(F.lit(False)).select(*TABLE_COLUMNS)
    return reduce(DataFrame.unionByName, parts)


def _stored_parts(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(folder, second partition column) of everything stored under a table path."""
    parts = [(path.rstrip("/"), "batch_id"), *((closed_path(path, p), "upto") for p in ("last", "first"))]
    return [(folder, second) for folder, second in parts if _partitions(spark, folder, second) or exists(spark, f"{folder}_purge")]


def purge_table(spark: SparkSession, path: str, out_path: str, ids: list[str] | DataFrame) -> None:
    """A copy of the stored table without the rows of some sensors, under ``out_path``, with the same batches and marks."""
    parts = [(f, s) for f, s in _stored_parts(spark, path) if _partitions(spark, f, s)]
    if not parts:
        raise FileNotFoundError(path)
    for folder, second in parts:
        kept = purge_sensors(spark.read.parquet(folder), ids)
        target = out_path.rstrip("/") + folder[len(path.rstrip("/")) :]
        _overwrite(kept, target, second)


def _overwrite(rows: DataFrame, folder: str, second: str) -> None:
    order = ["date", second, "sensor_id", *(c for c in rows.columns if c == "timestamp")]  # summaries have no time column
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", second).parquet(folder)
    )


def _within(touched: list[tuple[str, int]], second: str) -> Column:
    by_day = defaultdict(list)
    for day, value in touched:
        by_day[day].append(value)
    groups = defaultdict(list)  # days with the same values share a condition
    for day, values in by_day.items():
        groups[tuple(sorted(values))].append(day)
    return reduce(lambda a, b: a | b, (_on(days) & F.col(second).isin(list(values)) for values, days in groups.items()))


def _finish_purge(spark: SparkSession, folder: str, second: str) -> None:
    """Put the kept rows of a purge in place: whole partitions, and none for those left empty."""
    aside, listed = f"{folder}_purge/rows", f"{folder}_purge/partitions"
    kept = _partitions(spark, aside, second)
    if kept:
        _overwrite(spark.read.parquet(aside), folder, second)
    for row in spark.read.parquet(listed).collect():
        if row[second] not in kept.get(row["date"], []):
            remove(spark, f"{folder}/date={row['date']}/{second}={row[second]}")
    remove(spark, f"{folder}_purge")


def purge_in_place(spark: SparkSession, path: str, ids: list[str] | DataFrame) -> dict[str, int]:
    """Remove the rows of some sensors from the stored table; returns the partitions rewritten per folder.

    Only partitions that hold such rows are rewritten, updates and closed days
    alike; all other files stay as they are. The list of partitions is written last, so it
    stands for a complete set of kept rows: a purge that was cut off is
    finished before anything else, and one without a list starts anew."""
    parts, done = _stored_parts(spark, path), {}
    if not parts:
        raise FileNotFoundError(path)
    for folder, second in parts:
        aside = f"{folder}_purge"
        if exists(spark, f"{aside}/partitions/_SUCCESS"):
            _finish_purge(spark, folder, second)
        remove(spark, aside)
        done[folder] = 0
        if not _partitions(spark, folder, second):
            continue
        stored = spark.read.parquet(folder)
        if isinstance(ids, DataFrame):
            hit = stored.join(ids.select(F.col(ids.columns[0]).alias("sensor_id")).distinct(), "sensor_id", "left_semi")
        else:
            hit = stored.where(F.col("sensor_id").isin(list(ids)))
        hit = hit.select(F.col("date").cast("string").alias("date"), F.col(second).cast("long").alias(second)).distinct()
        touched = [(r["date"], r[second]) for r in hit.collect()]  # partitions, not rows
        done[folder] = len(touched)
        if touched:
            kept = purge_sensors(stored.where(_within(touched, second)), ids)
            kept.write.partitionBy("date", second).parquet(f"{aside}/rows")
            spark.createDataFrame(touched, f"date string, {second} long").coalesce(1).write.parquet(f"{aside}/partitions")
            _finish_purge(spark, folder, second)
    return done


def write_archive(df: DataFrame, path: str, mode: str = "append") -> None:
    """Long-term parquet archive, partitioned by UTC date of the window.

    A range repartition on (date, sensor_id, timestamp) gives each task a
    contiguous slice: a date holding a third of all rows is split over many
    tasks (hash on date alone would send it to one), and each file comes out
    sorted, so time and sensor filters skip row groups and partitions.
    """
    (
        dated(df).repartitionByRange("date", "sensor_id", "timestamp")
        .sortWithinPartitions("date", "sensor_id", "timestamp")
        .write.mode(mode)
        .partitionBy("date")
        .parquet(path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """S7 read: filters on ``date`` prune partitions, on ``timestamp`` row groups."""
    return spark.read.parquet(path)
