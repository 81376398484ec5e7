"""Consistency checks over query results.

Each check is a DataFrame of findings, so it runs distributed and can be
asserted on (``ok`` flags) or stored. The per-sensor aggregates are all
hash-partitioned on ``sensor_id``, so joining them needs no new shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import sum_units
from tidemark.functions.time import ms_to_ts
from tidemark.operators.queries import Bound, all_sensor_stats, sensor_overview, sensor_series
from tidemark.session import scratch_path

SALTS = 16
DIGEST_BUCKETS = 64  # sensor buckets per day
BROADCAST_BUCKETS = 100_000  # (day, bucket) pairs, two numbers each: a few MB


def audit_counts(table: DataFrame, start: Bound = None, end: Bound = None, as_of: Bound = None) -> DataFrame:
    """Overview count = series row count = stats count, per sensor.

    The period should cover the table for the three to agree; sensors
    missing from one answer show up with a null count and ``ok = false``.
    """
    overview = sensor_overview(table).select("sensor_id", F.col("reading_count").alias("overview_count"))
    series = (
        sensor_series(table, start, end, as_of)
        .groupBy("sensor_id")
        .agg(F.count(F.lit(1)).alias("series_count"))
    )
    stats = all_sensor_stats(table, start, end, as_of).select(
        "sensor_id", F.col("reading_count").alias("stats_count")
    )
    joined = overview.join(series, "sensor_id", "full_outer").join(stats, "sensor_id", "full_outer")
    ok = F.coalesce(
        (F.col("overview_count") == F.col("series_count")) & (F.col("series_count") == F.col("stats_count")),
        F.lit(False),
    )
    return joined.withColumn("ok", ok)


def audit_ranges(table: DataFrame, start: Bound = None, end: Bound = None, as_of: Bound = None) -> DataFrame:
    """Every stored reading lies within its sensor's reported min/max.

    The stats side has one row per sensor. The rows are salted by time and the
    stats repeated per salt, so a sensor with a third of all rows is spread
    over ``SALTS`` join and count groups instead of one.
    """
    stats = all_sensor_stats(table, start, end, as_of).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = sensor_series(table, start, end, as_of).withColumn("_salt", F.pmod(F.xxhash64("timestamp"), F.lit(SALTS)).cast("int"))
    joined = rows.join(stats, ["sensor_id", "_salt"], "inner")
    outside = (
        (F.col("temperature") < F.col("temperature_min"))
        | (F.col("temperature") > F.col("temperature_max"))
        | (F.col("humidity") < F.col("humidity_min"))
        | (F.col("humidity") > F.col("humidity_max"))
    )
    parts = joined.groupBy("sensor_id", "_salt").agg(F.count(F.lit(1)).alias("n"), F.count_if(outside).alias("out"))
    per_sensor = parts.groupBy("sensor_id").agg(F.sum("n").alias("readings"), F.sum("out").alias("violations"))
    return per_sensor.withColumn("ok", F.col("violations") == 0)


def audit_integrity(sent: DataFrame, stored: DataFrame, decimals: int = 2) -> DataFrame:
    """Stored values equal sent values at the table's precision.

    Full outer join on (sensor_id, timestamp); each key gets a status:
    ``match``, ``mismatch``, ``missing`` (sent, not stored) or
    ``unexpected`` (stored, never sent).
    """
    dec = f"decimal({3 + decimals},{decimals})"
    s = sent.select(
        "sensor_id",
        "timestamp",
        F.col("temperature").try_cast(dec).alias("sent_temperature"),
        F.col("humidity").try_cast(dec).alias("sent_humidity"),
        F.lit(True).alias("_sent"),
    )
    t = stored.select(
        "sensor_id",
        "timestamp",
        F.col("temperature").alias("stored_temperature"),
        F.col("humidity").alias("stored_humidity"),
        F.lit(True).alias("_stored"),
    )
    j = s.join(t, ["sensor_id", "timestamp"], "full_outer")
    same = F.col("sent_temperature").eqNullSafe(F.col("stored_temperature")) & F.col("sent_humidity").eqNullSafe(
        F.col("stored_humidity")
    )
    status = (
        F.when(F.col("_stored").isNull(), F.lit("missing"))
        .when(F.col("_sent").isNull(), F.lit("unexpected"))
        .when(same, F.lit("match"))
        .otherwise(F.lit("mismatch"))
    )
    return j.withColumn("status", status).drop("_sent", "_stored")


def _digest_side(rows: DataFrame, side: str, decimals: int, buckets: int) -> DataFrame:
    dec = f"decimal({3 + decimals},{decimals})"
    values = [F.col(m).try_cast(dec) for m in ("temperature", "humidity")]
    # a hash skips nulls, so which value is null is hashed too
    parts = [F.col("sensor_id"), F.col("timestamp"), *values, *[F.isnull(v) for v in values]]
    return rows.select(
        *_bucket(buckets),
        F.lit(side).alias("side"),
        F.xxhash64(*parts).alias("h1"),
        F.xxhash64(F.lit("second"), *parts).alias("h2"),
        (F.col("sensor_id").isNull() | F.col("timestamp").isNull()).alias("no_key"),
    )


def _bucket(buckets: int) -> list:
    return [F.to_date(ms_to_ts("timestamp")).alias("date"), F.pmod(F.xxhash64("sensor_id"), F.lit(buckets)).cast("int").alias("bucket")]


def integrity_digests(sent: DataFrame, stored: DataFrame, decimals: int = 2, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Per day and sensor bucket the rows of both sides and whether their digests differ.

    A digest is the row count with two sums of 64-bit row hashes: it does not depend on the order of
    rows, and the sums are formed before the shuffle, so only digests travel. Values
    are taken at the table's precision. A bucket with a null key always differs, as no such row can match.
    """
    sides = _digest_side(sent, "sent", decimals, buckets).unionByName(_digest_side(stored, "stored", decimals, buckets))
    is_sent, is_stored = F.col("side") == "sent", F.col("side") == "stored"
    sums = {f"{s}_{h}": sum_units(F.when(of, F.col(h))) for s, of in (("sent", is_sent), ("stored", is_stored)) for h in ("h1", "h2")}
    out = sides.groupBy("date", "bucket").agg(
        F.count_if(is_sent).alias("sent_rows"),
        F.count_if(is_stored).alias("stored_rows"),
        F.count_if("no_key").alias("no_key"),
        *[total.alias(name) for name, total in sums.items()],
    )
    same = (F.col("sent_rows") == F.col("stored_rows")) & (F.col("no_key") == 0)
    same &= (F.col("sent_h1") == F.col("stored_h1")) & (F.col("sent_h2") == F.col("stored_h2"))
    return out.select("date", "bucket", "sent_rows", "stored_rows", (~F.coalesce(same, F.lit(False))).alias("differs"))


def audit_by_digest(
    sent: DataFrame, stored: DataFrame, decimals: int = 2, buckets: int = DIGEST_BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """C3 where it is needed: (rows per status, findings that are no match).

    Digests are compared first and written to the session's shared folder (a job); rows of both
    sides are joined only in the buckets that differ, and not at all if none does. Keys are unique on both
    sides, as the table's are. The list of differing buckets is broadcast up to ``BROADCAST_BUCKETS``
    entries and joined by shuffle beyond that.
    """
    spark = sent.sparkSession
    path = scratch_path(spark, "digests")
    integrity_digests(sent, stored, decimals, buckets).write.parquet(path)
    digests = spark.read.parquet(path)
    equal = digests.where(~F.col("differs")).agg(F.coalesce(F.sum("sent_rows"), F.lit(0)).alias("rows"))
    equal = equal.where("rows > 0").select(F.lit("match").alias("status"), "rows")
    differing = digests.where("differs").select(F.col("date").alias("_date"), F.col("bucket").alias("_bucket"))
    n = differing.count()
    if n == 0:
        return equal, audit_integrity(sent.where(F.lit(False)), stored.where(F.lit(False)), decimals)
    if n <= BROADCAST_BUCKETS:
        differing = F.broadcast(differing)

    def within(rows: DataFrame) -> DataFrame:
        date, bucket = _bucket(buckets)
        keyed = rows.withColumn("_date", date).withColumn("_bucket", bucket)
        on = keyed["_date"].eqNullSafe(differing["_date"]) & (keyed["_bucket"] == differing["_bucket"])
        return keyed.join(differing, on, "left_semi").drop("_date", "_bucket")

    compared = audit_integrity(within(sent), within(stored), decimals)
    summary = equal.unionByName(integrity_summary(compared)).groupBy("status").agg(F.sum("rows").alias("rows"))
    return summary, compared.where(F.col("status") != "match")


def integrity_summary(findings: DataFrame) -> DataFrame:
    """Row count per status of :func:`audit_integrity`."""
    return findings.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))
