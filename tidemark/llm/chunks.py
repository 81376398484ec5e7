"""Substring dedup by content-defined chunks.

A gear rolling hash over the last ``GEAR`` bytes (each byte shifts the hash by one
bit and adds its random number) ends a chunk where its top bits are zero, so that chunk ends
depend on the bytes before them alone: after an insertion the chunks of two copies
fall into step again. Chunks have ``MIN`` to ``MAX`` bytes, about ``MIN + 2**MASK`` on average. A chunk is known by a
64-bit digest and its length.

Of equal chunks the first stays (least doc_id, then least place). The others are cut
where neighbouring repeated chunks sum up to ``least`` bytes, so that a short chunk that
two texts share by chance stays.

Jobs: chunk digests per text (Python over Arrow batches); counts per digest with
map-side sums; a join back to the chunks, split by the skew handling where one chunk is very common; the first
place per digest by a grouped minimum; spans per text.

Defined results: null and empty texts have no chunks. Rows that repeat both id and text
are one document and all get its result. Rows with a null id come before all others. Texts under one id are
told apart by their hash. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import scratch, sf_table, stash
from tidemark.llm.textkit import prefix_hash, slices, span_hash, text_bytes

GEAR, MASK, MIN, MAX, LEAST = 32, 5, 16, 512, 64
_NUMBERS = np.random.default_rng(20250101).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(buf: np.ndarray) -> np.ndarray:
    """Rolling hash of the last ``GEAR`` bytes at every place, by doubling the window."""
    h, width = _NUMBERS[buf], 1
    while width < GEAR:
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h, width = more, width * 2
    return h


def chunk_ends(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Per text the ends of its chunks, from the start of ``buf``."""
    cut = np.flatnonzero(gear(buf) >> np.uint32(32 - MASK) == 0) + 1 if len(buf) else np.zeros(0, np.int64)
    limits = np.searchsorted(cut, off, "right").tolist()
    cut, out = cut.tolist(), []
    for a, b, i, j in zip(off[:-1].tolist(), off[1:].tolist(), limits[:-1], limits[1:], strict=True):
        ends, last = [], a
        for c in cut[i:j]:
            if c - a < GEAR or c - last < MIN:  # the first hashes of a text still hold bytes of the one before
                continue
            while c - last > MAX:
                last += MAX
                ends.append(last)
            if c - last >= MIN:
                ends.append(c)
                last = c
        while b - last > MAX:
            last += MAX
            ends.append(last)
        if b > last:
            ends.append(b)
        out.append(np.array(ends, np.int64))
    return out


def _chunk_rows(batches):
    for batch in batches:
        for first, end, buf, off in slices(batch["text"]):
            per = chunk_ends(buf, off)
            ends = np.concatenate(per)
            count = np.array([len(x) for x in per], np.int64)
            # each chunk starts where the one before ends; empty texts have none, so ends are contiguous
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            digest = span_hash(prefix_hash(buf), starts, ends).view(np.int64)
            limits = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["h"], pa.ListArray.from_arrays(limits, pa.array(digest)), pa.ListArray.from_arrays(limits, pa.array((ends - starts).astype(np.int32)))],
                names=["doc_id", "h", "digests", "sizes"],
            )


SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def _spans(least: int):
    def spans(batches):
        for batch in batches:
            rows = []
            for sizes, repeats in zip(batch["sizes"].to_pylist(), batch["repeats"].to_pylist(), strict=True):
                ends = np.cumsum(sizes)
                gone = np.zeros(len(sizes) + 2, bool)
                gone[np.array(repeats or [], np.int64) + 1] = True
                step = np.diff(gone.astype(np.int8))
                a, b = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                found = [{"s": int(ends[x] - sizes[x]), "e": int(ends[y - 1])} for x, y in zip(a, b, strict=True) if ends[y - 1] - ends[x] + sizes[x] >= least]
                rows.append((len(repeats or []), sum(x["e"] - x["s"] for x in found), found))
            n, removed, found = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["h"], pa.array([int(sum(s)) for s in batch["sizes"].to_pylist()], pa.int64()), pa.array([len(s) for s in batch["sizes"].to_pylist()], pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(found, SPANS)],
                names=["doc_id", "h", "n_bytes", "n_chunks", "n_repeats", "n_removed", "spans"],
            )

    return spans


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")


def substring_dedup(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, h, n_bytes, n_chunks, n_repeats, n_removed, spans) per row of ``docs`` (doc_id, text).

    ``spans`` are the byte ranges to cut, ``h`` is a hash of the text.
    """
    with scratch(docs.sparkSession, "chunks"):
        kind = "doc_id long, h long, digests array<long>, sizes array<int>"
        chunks = stash(_documents(docs).mapInArrow(_chunk_rows, kind), "chunks")
        one = chunks.select("doc_id", "h", F.posexplode(F.arrays_zip("digests", "sizes")).alias("i", "c"))
        one = one.select("doc_id", "h", "i", F.col("c.digests").alias("d"), F.col("c.sizes").alias("n"))
        often = one.groupBy("d", "n").count().where("count > 1").select("d", "n")
        met = stash(one.join(often, ["d", "n"]), "repeated-chunks")
        first = met.groupBy("d", "n").agg(F.min(F.struct("doc_id", "h", "i")).alias("first"))
        later = met.join(first, ["d", "n"]).where(~F.struct("doc_id", "h", "i").eqNullSafe(F.col("first")))
        repeats = later.groupBy(F.col("doc_id").alias("d2"), F.col("h").alias("h2")).agg(F.collect_set("i").alias("repeats"))
        joined = chunks.select("doc_id", "h", "sizes").join(repeats, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2")), "left")
        out = "doc_id long, h long, n_bytes long, n_chunks long, n_repeats long, n_removed long, spans array<struct<s:long,e:long>>"
        return stash(joined.select("doc_id", "h", "sizes", "repeats").mapInArrow(_spans(least), out), "chunk-spans", keep=True)


def _cut(batches):
    for batch in batches:
        raw, off = text_bytes(batch["text"])
        kept = []
        for d, spans in enumerate(batch["spans"].to_pylist()):
            text, at, parts = raw[off[d] : off[d + 1]].tobytes(), 0, []
            for x in spans or []:
                parts.append(text[at : x["s"]])
                at = x["e"]
            kept.append(b"".join([*parts, text[at:]]).decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(kept, pa.string())], names=["doc_id", "text"])


def cut_text(docs: DataFrame, result: DataFrame) -> DataFrame:
    """(doc_id, text) with the spans of ``substring_dedup`` cut out; a character cut in two is dropped."""
    spans = result.where("n_removed > 0").select(F.col("doc_id").alias("d2"), F.col("h").alias("h2"), "spans").dropDuplicates(["d2", "h2"])
    joined = _documents(docs).join(spans, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, text string")


def op2_gear_chunk_dedup(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(sf_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_chunks", "n_repeats", "n_removed", F.size("spans").cast("long").alias("n_spans"), "spans")
