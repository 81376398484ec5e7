"""Importance resampling of documents towards a target distribution of n-grams.

1. *Spans.* A text is lower-cased (A-Z) and its separators are collapsed to single
   spaces. One overlapped regex scan then visits every word start - the lookarounds hold
   it to word borders - and its three nested groups give the spans of the runs of one, two and
   three words. Each span's bytes are hashed by CRC-32 into one of ``BUCKETS``
   buckets. The bucket ids of a text are written once, two bytes each, so texts are scanned once.
2. *Gains.* Bucket counts of all documents and of all target texts (one sum per task and bucket
   before the shuffle) give the log ratio per bucket: a table of ``BUCKETS`` numbers.
3. *Draw.* A document's weight is the sum of its gains; a Gumbel noise fixed by
   its id is added, and the highest scores are drawn. Ranks come from range-partitioned rows,
   numbered per partition plus the rows of the partitions before: no task sorts all.

Defined results: null and empty texts, and texts without words, have no features
and weight 0; they can't be drawn, as texts with fewer than ``least_words`` words. Rows without an id get
their noise from the text ``42:``, and rank after all ids of the same score. Repeated rows are each
scored and drawn. Empty tables give no rows, or (no target texts) counts of zero. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import crc32_sql, scratch, sf_table, stash

BUCKETS, WIDTH, LEAST_WORDS, SHARE, SEED = 10000, 3, 20, 5, 42

#: Bytes as the scan sees them: A-Z lower-cased; 0-9, a-z and all above 0x7F stay; the rest separates words.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x > 127 else 32 for x in range(256))
SPANS = rb"(?<![^ ])((([^ ]++)(?: [^ ]++)?+)(?: [^ ]++)?+)(?![^ ])"


def _scanner():
    """A function from a text to the bucket ids of its runs of 1 to 3 words, and its number of words."""
    import regex

    spans, gaps, crc = regex.compile(SPANS), regex.compile(rb" ++"), zlib.crc32

    def scan(text: str | None) -> tuple[array, int]:
        ids, words = array("H"), 0
        line = gaps.sub(b" ", (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)).strip(b" ")
        add, view = ids.append, memoryview(line)
        for m in spans.finditer(line, overlapped=True):
            words += 1
            start, end = m.span(3)
            add(crc(view[start:end]) % BUCKETS)
            two = m.end(2)
            if two > end:
                add(crc(view[start:two]) % BUCKETS)
                three = m.end(1)
                if three > two:
                    add(crc(view[start:three]) % BUCKETS)
        return ids, words

    return scan


def _features(batches):
    scan = _scanner()
    for batch in batches:
        found = [scan(x.as_py()) for x in batch["text"]]
        packed = pa.array([np.frombuffer(ids, "<u2").tobytes() if len(ids) else b"" for ids, _ in found], pa.large_binary()).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([n for _, n in found], pa.int64()), packed], names=["doc_id", "n_words", "ids"])


def features(texts: DataFrame) -> DataFrame:
    """(doc_id, n_words, ids) of every row of ``texts`` (doc_id, text); ids: bucket ids of all features, two bytes each."""
    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_features, "doc_id long, n_words long, ids binary")


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bucket ids of a batch, and the number of each row."""
    raw = column.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    ids = np.frombuffer(data, "<u2", (offsets[-1] - offsets[0]) // 2, offsets[0]) if data is not None and offsets[-1] > offsets[0] else np.zeros(0, "<u2")
    return ids, np.diff(offsets) // 2


def _count(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        total += np.bincount(_ids(batch["ids"])[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])


def bucket_counts(found: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all rows of ``features``; ``BUCKETS`` numbers."""
    sums = found.select("ids").mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B)))) per bucket."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(table):
    def weigh(batches):
        gain = table.value
        for batch in batches:
            ids, count = _ids(batch["ids"])
            ends = np.cumsum(count)
            run = np.concatenate([[0], np.cumsum(gain[ids])])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_words"], pa.array(count.astype(np.int64)), pa.array((run[ends] - run[ends - count]).astype(np.int64))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return weigh


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``features``."""
    table = found.sparkSession.sparkContext.broadcast(gain)
    return found.mapInArrow(_weigh(table), "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``rows`` numbered from 1 in the given order, without bringing them into one task."""
    dealt = stash(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return dealt.withColumn(name, own).join(parts, "part").withColumn(name, F.col(name) + F.col("before")).drop("part", "before")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text).

    ``target`` (text) gives the wanted distribution. Of the N documents with at least
    ``least_words`` words the floor(share * N / 100) highest scores are ranked, the rest has a null rank.
    """
    with scratch(docs.sparkSession, "resample"):
        found = stash(features(docs), "features")
        wanted = bucket_counts(features(target.select(F.lit(None).cast("long").alias("doc_id"), "text")))
        weighed = weights(found, gains(bucket_counts(found), wanted))
        text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
        noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
        scored = stash(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "scored")
        fit = F.col("n_words") >= least_words
        drawn = scored.where(fit).count() * share // 100
        order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "n_features", "weight", "row"]
        in_order = ranked(scored.where(fit).withColumn("row", F.monotonically_increasing_id()), order)
        out = in_order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
        columns = ["doc_id", "n_features", "weight", "score", "rank"]
        rest = scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))
        return stash(out.select(columns).union(rest.select(columns)), "resample", keep=True)


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(sf_table(spark, sf_dir, "documents"), sf_table(spark, sf_dir, "benchmark"))


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _runs_sql(table: str, key: str) -> str:
    return f"""SELECT {key} AS id, unnest(list_concat(w, list_concat(
      list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]),
      list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f
    FROM (SELECT {key}, {_WORDS_SQL} AS w FROM {table})"""


OP13_SQL = f"""
WITH runs AS MATERIALIZED ({_runs_sql("documents", "doc_id")}), wanted AS MATERIALIZED ({_runs_sql("benchmark", "item_id")}),
hashed AS MATERIALIZED (SELECT f, ({crc32_sql("f")} % {BUCKETS})::INT AS bucket FROM (SELECT DISTINCT f FROM runs UNION SELECT DISTINCT f FROM wanted)),
own AS MATERIALIZED (SELECT id, bucket FROM runs JOIN hashed USING (f)),
s AS (SELECT bucket, count(*) AS s FROM own GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (f) GROUP BY 1),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM runs) + {BUCKETS})
           / ((s + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + {BUCKETS}))))::BIGINT AS g FROM s LEFT JOIN t USING (bucket)),
weighed AS (SELECT id, count(*) AS n, sum(g)::BIGINT AS weight FROM own JOIN gain USING (bucket) GROUP BY 1),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len({_WORDS_SQL}) >= {LEAST_WORDS} AS fit,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weighed ON id = doc_id),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE fit)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {SHARE} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""
