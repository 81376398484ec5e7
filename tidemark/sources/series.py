"""Series dictionary (P27, S8): label sets are stored once, samples carry the id of their series.

Layout under one path: ``series`` holds a row per series (id, bucket, labels), ``samples`` the rows
(series_id, ts, value), both in a folder per batch. Samples are further split by ``bucket``, a hash of the leading
labels, so that the series of one metric and namespace lie together.

Matchers run on the dictionary alone. Samples are then read by id: the buckets of the matched series prune the
partitions of the scan at run time, and the label columns are never read. Where the matched dictionary rows are too many
to broadcast, Spark shuffles the semi-join and may filter the scan by a Bloom filter of the ids instead.

A batch adds the series that no earlier batch has, *before* its samples are written: samples never lack
their labels. A replayed batch is compared with the batches before it and replaces its own folders. Batches come in order.

Defined results: an absent (null) label and an empty one are the same label set. Two label sets never share an
id in practice: it is their 128-bit digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import Matcher, match_labels
from tidemark.operators.metrics import SERIES

BUCKETS, BUCKET_LABELS = 64, 2
ID = "series_id"


def _label(name: str) -> Column:
    return F.nullif(F.col(name), F.lit("")).alias(name)


def series_id(labels: list[str] = SERIES) -> Column:
    """128-bit digest of a label set in hexadecimal; absent and empty labels count alike."""
    return F.md5(F.to_json(F.struct(*map(_label, labels)), {"ignoreNullFields": "true"})).alias(ID)


def series_bucket(labels: list[str] = SERIES, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*map(_label, labels[:BUCKET_LABELS])), F.lit(buckets)).cast("int").alias("bucket")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def write_series(samples: DataFrame, batch_id: int, path: str, labels: list[str] = SERIES, buckets: int = BUCKETS) -> None:
    """Store one batch of labelled samples: its new series, then its samples by id."""
    spark = samples.sparkSession
    keyed = samples.select(series_id(labels), series_bucket(labels, buckets), *map(_label, labels), "ts", "value")
    new = keyed.select(ID, "bucket", *labels).dropDuplicates([ID])
    if _exists(spark, f"{path}/series"):
        known = spark.read.parquet(f"{path}/series").where(F.col("batch_id") < batch_id)
        new = new.join(known.select(ID), ID, "left_anti")
    new.write.mode("overwrite").parquet(f"{path}/series/batch_id={batch_id}")
    order = ["bucket", ID, "ts"]
    rows = keyed.select("bucket", ID, "ts", "value").repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/samples/batch_id={batch_id}")


def read_series(spark: SparkSession, path: str, matchers: list[Matcher] = ()) -> DataFrame:
    """The dictionary's rows (series_id, bucket, labels) that satisfy every matcher."""
    if not _exists(spark, f"{path}/series"):
        raise FileNotFoundError(f"no series under {path}")
    return match_labels(spark.read.parquet(f"{path}/series").drop("batch_id"), list(matchers))


def read_matched(spark: SparkSession, path: str, matchers: list[Matcher]) -> DataFrame:
    """(series_id, ts, value) of all series that satisfy every matcher."""
    wanted = read_series(spark, path, matchers).select("bucket", ID)
    stored = spark.read.parquet(f"{path}/samples")
    return stored.join(wanted, ["bucket", ID], "left_semi").select(ID, "ts", "value")


def with_labels(df: DataFrame, series: DataFrame, labels: list[str]) -> DataFrame:
    """Rows by series id with the named labels; absent ones are empty, as in the other metric answers."""
    named = series.select(ID, *(F.coalesce(c, F.lit("")).alias(c) for c in labels))
    return df.join(named, ID).drop(ID)
