"""Suffix-array dedup: bytes covered by a string of ``width`` bytes that also starts elsewhere.

A suffix array of all texts holds a record per byte and does not fit the disk
of the job. Only its equal neighbours of ``width`` bytes matter, so the suffixes are
first cut into buckets that equal windows share, and most buckets hold one suffix run.

1. *Copies.* Equal texts are one class: of ``width`` bytes or more, all their bytes go.
   One text per class takes part below, so copies are never expanded.
2. *Buckets.* The bucket of a window is its least hashed ``GRAM``-gram, the leftmost
   of equal ones (the window's anchor). Equal windows have equal anchors at equal distance; all windows of
   an anchor are one run. Runs whose anchor occurs once cannot repeat and go no further.
3. *Equal runs* of an anchor are one class with a count; two or more repeat whole.
4. *Sorting, blockwise.* Different runs of one anchor are sorted, a block of
   buckets at a time. The block's cover sample - positions whose distance from
   the anchor falls in a difference cover modulo ``PERIOD`` - is ranked first,
   by strings of ``width - PERIOD + 1`` bytes. Suffixes are then sorted by the few bytes before their
   next sample position, its rank, and the few bytes behind the ranked string:
   long ties cost one comparison of ranks, and memory is bounded by the block.
5. An anchor with more than ``HOT`` different runs has no bounded bucket: its
   windows are counted as rows instead, with the same result.

Byte strings are compared by 64-bit hashes within their bucket.

Defined results: a null text is an empty one. Repeated rows are copies of each other, also when they
share an id. Texts shorter than ``width`` lose nothing. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import give_back, lean, scratch, sf_table, small_batches, stash
from tidemark.llm.textkit import mix, prefix_hash, slices, span_hash, text_bytes

WIDTH, GRAM, PERIOD, HOT, BLOCK_RUNS = 400, 24, 64, 20000, 3000
PART = 1 << 18  # some arrays of eight bytes a byte of text are held at a time
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def difference_cover(period: int) -> np.ndarray:
    """Residues such that every difference modulo ``period`` is one of two of them (greedy)."""
    cover, missing = [0, 1], set(range(2, period - 1))
    while missing:
        best = max(range(period), key=lambda x: len(missing & {d for c in cover for d in ((x - c) % period, (c - x) % period)}))
        missing -= {d for c in cover for d in ((best - c) % period, (c - best) % period)}
        cover.append(best)
    return np.array(sorted(cover))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by block-wise running minima from both sides."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(buf: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: document, anchor hash, and anchor place, first and last window start in the document."""
    empty = (np.zeros(0, np.int64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    if len(buf) < width:
        return empty
    prefix = prefix_hash(buf)
    at = np.arange(len(buf) - GRAM + 1)
    gram = span_hash(prefix, at, at + GRAM)
    least = sliding_min((gram & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64), width - GRAM + 1)
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    count = np.maximum(0, np.diff(off) - width + 1)
    doc = np.repeat(np.arange(len(count)), count)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + off[doc]
    if not len(start):
        return empty
    place = place[start]
    head = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])))
    last = np.append(head[1:], len(start)) - 1
    base = off[doc[head]]
    return doc[head], gram[place[head]], place[head] - base, start[head] - base, start[last] - base


RUNS = pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int32()), ("a", pa.int32()), ("b", pa.int32())]))


def _anchor_rows(width: int):
    def rows(batches):
        for batch in batches:
            for first, end, buf, off in slices(batch["text"], PART):
                doc, h, p, a, b = anchors(buf, off, width)
                items = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), *(pa.array(x, pa.int32()) for x in (p, a, b))], names=["h", "p", "a", "b"])
                limits = np.searchsorted(doc, np.arange(end - first + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(limits), items)
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([part["id"], part["tid"], runs], names=["id", "tid", "runs"])

    return rows


def _run_keys(width: int):
    """A row per run of a text: its anchor, a digest of its bytes, and where it stands."""

    def keys(batches):
        for batch in batches:
            ids, tids, lists = batch["id"].to_pylist(), batch["tid"].to_pylist(), batch["runs"]
            raw, off = text_bytes(batch["text"])
            for d in range(len(batch)):
                runs = lists[d].values
                if not len(runs):
                    continue
                h, p, a, b = (runs.field(c).to_numpy(zero_copy_only=False) for c in "hpab")
                prefix = prefix_hash(raw[off[d] : off[d + 1]])
                a, p = a.astype(np.int64), p.astype(np.int64)
                one = span_hash(prefix, a, b.astype(np.int64) + width)
                two = mix(span_hash(prefix, p, b.astype(np.int64) + width) + one)  # a second hash of the part from the anchor on
                n = len(h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(p - a, pa.int32()), pa.array(b - a + 1, pa.int32()), pa.array([ids[d]] * n, pa.int64()), pa.array([tids[d]] * n, pa.int64()), pa.array(p, pa.int32())],
                    names=["h", "d1", "d2", "lead", "n", "id", "tid", "p"],
                )

    return keys


def _run_bytes(width: int):
    """The bytes of wanted runs."""

    def cut(batches):
        for batch in batches:
            raw, off = text_bytes(batch["text"])
            for d, runs in enumerate(batch["wanted"].to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([r[c] for r in runs], t) for c, t in (("h", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("lead", pa.int32()), ("n", pa.int32()))),
                        pa.array([raw[off[d] + r["p"] - r["lead"] : off[d] + r["p"] - r["lead"] + r["n"] - 1 + width].tobytes() for r in runs], pa.binary()),
                    ],
                    names=["h", "d1", "d2", "lead", "n", "bytes"],
                )

    return cut


def repeated_windows(raw: list[bytes], anchor: np.ndarray, lead: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, window) of all windows that more than one of the different runs has: one block of buckets, sorted."""
    size = np.array([len(x) for x in raw], np.int64)
    base = np.cumsum(size) - size
    prefix = prefix_hash(np.frombuffer(b"".join(raw), np.uint8))
    period = min(PERIOD, width // 2)
    cover = difference_cover(period)
    ranked = width - period + 1
    # ranks of the cover sample of the block
    run = np.repeat(np.arange(len(raw)), size)
    place = np.arange(len(run)) - base[run]
    sample = np.isin((place - lead[run]) % period, cover) & (place + ranked <= size[run])
    at = np.flatnonzero(sample)
    rank = np.zeros(len(run), np.int64)
    rank[at] = np.unique(span_hash(prefix, at, at + ranked), return_inverse=True)[1]
    # the windows, up to their next sample position, from its rank on, and behind it
    step = np.array([min(x for x in (cover - r) % period) for r in range(period)])
    run = np.repeat(np.arange(len(raw)), n)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    start = base[run] + nth
    next_ = start + step[(nth - lead[run]) % period]
    bucket = mix(anchor[run].view(np.uint64) + (nth - lead[run]).astype(np.uint64))
    key = mix(bucket + span_hash(prefix, start, next_)) + mix(rank[next_].astype(np.uint64))
    key = mix(key + span_hash(prefix, next_ + ranked, start + width))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.append(same, False) | np.append(False, same)
    found = np.sort(order[twice])
    return run[found], nth[found]


def _spans(run: np.ndarray, nth: np.ndarray, lead: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows as byte spans [s, e) from the anchor."""
    head = np.append(True, (run[1:] != run[:-1]) | (nth[1:] != nth[:-1] + 1)) if len(run) else np.zeros(0, bool)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(run)) - 1 if len(run) else first
    r = run[first]
    return r, nth[first] - lead[r], nth[last] - lead[r] + width


KEY, TEXT = ["h", "d1", "d2", "lead"], ["id", "tid"]
SPANS_SQL = "h long, d1 long, d2 long, lead int, s int, e int"


def _sort_block(width: int):
    def sort(table: pa.Table) -> pa.Table:
        lead, n = table["lead"].to_numpy().astype(np.int64), table["n"].to_numpy().astype(np.int64)
        run, nth = repeated_windows(table["bytes"].to_pylist(), table["h"].to_numpy(), lead, n, width)
        r, s, e = _spans(run, nth, lead, width)
        picked = table.select(KEY).take(pa.array(r))
        del run, nth
        give_back()
        return picked.append_column("s", pa.array(s, pa.int32())).append_column("e", pa.array(e, pa.int32()))

    return sort


def _window_rows(width: int):
    def rows(batches):
        for batch in batches:
            for i in range(len(batch)):
                raw, n = np.frombuffer(batch["bytes"][i].as_buffer(), np.uint8), batch["n"][i].as_py()
                at = np.arange(n)
                w = span_hash(prefix_hash(raw), at, at + width)
                part = batch.slice(i, 1).select(KEY).take(pa.array(np.zeros(n, np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(at, pa.int32()), pa.array(w.view(np.int64))], names=[*KEY, "k", "w"])

    return rows


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _cut(keep_text: bool):
    def cut(batches):
        for batch in batches:
            raw, off = text_bytes(batch["text"])
            rows = []
            for d, spans in enumerate(batch["spans"].to_pylist()):
                text = raw[off[d] : off[d + 1]].tobytes()
                merged = merge([(x["s"], x["e"]) for x in spans])
                keep, at = [], 0
                for s, e in merged:
                    keep.append(text[at:s])
                    at = e
                kept = b"".join([*keep, text[at:]])
                row = (len(text) - len(kept), [{"s": s, "e": e} for s, e in merged], hashlib.sha256(kept).hexdigest())
                # a span may begin or end inside a character: its rest is dropped from the text
                rows.append((*row, kept.decode("utf-8", "ignore")) if keep_text else row)
            types = [pa.int64(), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])), pa.string(), pa.string()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)]
            yield pa.RecordBatch.from_arrays([batch["sha"], *cols], names=["sha", "n_removed", "spans", "kept_sha256", "kept"][: len(cols) + 1])

    return cut


def repeated_spans(docs: DataFrame, width: int = WIDTH, keep_text: bool = False, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (doc_id, sha, n_bytes, copied), and per changed text (sha, n_removed, spans, kept_sha256[, kept])."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    # a text is known by id and hash below: two numbers in place of the digest
    ident = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("sha").alias("tid")]
    with scratch(spark, "suffixes"), small_batches(spark):
        rows = stash(docs.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "texts")
        classes = rows.groupBy("sha").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"))
        one = classes.select(*ident)
        long_ = docs.where(F.octet_length("text") >= width).select(*ident, "sha", "text")
        # one row per id and text; rows that repeat both are copies, which go whole anyway
        again = stash(rows.select(*ident).groupBy(TEXT).count().where("count > 1").drop("count"), "repeated")
        if not again.isEmpty():
            long_ = long_.join(again, TEXT, "left_anti").union(long_.join(again, TEXT, "left_semi").dropDuplicates(TEXT))
        with scratch(spark, "anchors"):
            found = long_.mapInArrow(lean(_anchor_rows(width)), "id long, tid long, runs array<struct<h:long,p:int,a:int,b:int>>")
            runs = stash(found.join(one, TEXT).select(*TEXT, F.inline("runs")), "runs")
            often = runs.groupBy("h").count().where("count > 1").select("h")
            runs = runs.join(often, "h").groupBy(TEXT).agg(F.collect_list(F.struct("h", "p", "a", "b")).alias("runs"))
            texts = stash(long_.join(runs, TEXT), "candidates", keep=True)
        with scratch(spark, "runs"):
            members = stash(texts.mapInArrow(lean(_run_keys(width)), "h long, d1 long, d2 long, lead int, n int, id long, tid long, p int"), "run-keys")
            kinds = members.groupBy(*KEY, "n").agg(F.count("*").alias("times"), F.min(F.struct(*TEXT, "p")).alias("at"))
            kinds = stash(kinds, "run-kinds")
            whole = kinds.where("times > 1").select(*KEY, (-F.col("lead")).alias("s"), (F.col("n") - 1 - F.col("lead") + width).alias("e"))
            open_ = kinds.groupBy("h").agg(F.count("*").alias("many")).where("many > 1")
            wanted = kinds.join(open_, "h").groupBy("at.id", "at.tid").agg(F.collect_list(F.struct(*KEY, "n", F.col("at.p").alias("p"))).alias("wanted"))
            pieces = texts.select(*TEXT, "text").dropDuplicates(TEXT).join(wanted, TEXT)
            pieces = stash(pieces.mapInArrow(lean(_run_bytes(width)), "h long, d1 long, d2 long, lead int, n int, bytes binary"), "run-bytes")
            many = pieces.groupBy("h").count()
            blocks = max(1, -(-pieces.count() // BLOCK_RUNS))
            crowded = stash(many.where(F.col("count") > hot).select("h"), "crowded")
            block = F.pmod(F.col("h"), F.lit(blocks)).cast("int")
            calm = pieces.join(crowded, "h", "left_anti").withColumn("block", block).groupBy("block")
            sorted_ = calm.applyInArrow(_sort_block(width), SPANS_SQL)
            windows = pieces.join(crowded, "h", "left_semi").mapInArrow(lean(_window_rows(width)), "h long, d1 long, d2 long, lead int, k int, w long")
            twice = windows.groupBy("h", "w", (F.col("k") - F.col("lead")).alias("o")).count().where("count > 1").drop("count")
            counted = windows.withColumn("o", F.col("k") - F.col("lead")).join(twice, ["h", "w", "o"]).select(*KEY, F.col("o").alias("s"), (F.col("o") + width).alias("e"))
            spans = whole.union(sorted_).union(counted).groupBy(KEY).agg(F.collect_list(F.struct("s", "e")).alias("at"))
            spans = members.join(spans, KEY).select(*TEXT, "p", F.inline("at")).select(*TEXT, F.struct((F.col("p") + F.col("s")).alias("s"), (F.col("p") + F.col("e")).alias("e")).alias("x"))
            spans = stash(spans.groupBy(TEXT).agg(F.collect_list("x").alias("spans")), "text-spans", keep=True)
        kind = "sha string, n_removed long, spans array<struct<s:int,e:int>>, kept_sha256 string" + (", kept string" if keep_text else "")
        cut = texts.select(*TEXT, "sha", "text").dropDuplicates(TEXT).join(spans, TEXT).mapInArrow(lean(_cut(keep_text)), kind)
        cut = stash(cut, "cut", keep=True)
        rows = rows.join(classes.select(F.col("sha").alias("sha2"), (F.col("copies") > 1).alias("copied")), F.col("sha") == F.col("sha2")).drop("sha2")
        return stash(rows, "rows", keep=True), cut


def suffix_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row of ``docs`` (doc_id, text)."""
    rows, cut = repeated_spans(docs, width)
    out = rows.join(cut.withColumnRenamed("sha", "sha2"), F.col("sha") == F.col("sha2"), "left")
    all_ = F.col("copied") & (F.col("n_bytes") >= width)
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("n_bytes").cast("int").alias("e")))
    spans = F.when(all_, whole).otherwise(F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")))
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(all_, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(all_, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        spans.alias("spans"),
    )


def cut_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated bytes cut from the text; rows left blank by it go.

    Where a column ``n_chars`` exists, it follows the text.
    """
    _, cut = repeated_spans(docs, width, keep_text=True)
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    whole = docs.select(F.struct("*").alias("row"), sha.alias("sha"), F.coalesce(F.octet_length("text") >= width, F.lit(False)).alias("long"))
    copied = whole.groupBy("sha").agg(F.count("*").alias("copies")).where("copies > 1").select(F.col("sha").alias("sha3"))
    joined = whole.join(cut.select(F.col("sha").alias("sha2"), "kept"), F.col("sha") == F.col("sha2"), "left").join(copied, F.col("sha") == F.col("sha3"), "left")
    text = F.when(F.col("sha3").isNotNull() & F.col("long"), F.lit("")).otherwise(F.coalesce("kept", "row.text"))
    changed = F.col("kept").isNotNull() | (F.col("sha3").isNotNull() & F.col("long"))
    row = joined.withColumn("text", text).where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        new = new.withField("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")))
    return row.select(new.alias("row")).select("row.*")


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(sf_table(spark, sf_dir, "documents")).drop("spans")


# Every window of 400 bytes (two hexadecimal digits each, read from parts of the text) by its digest; repeated ones make spans, gaps are what is kept.
OP6_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS nth, doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), sized AS (
  SELECT *, length(digits) // 2 AS n_bytes FROM texts
), parts AS (
  SELECT nth, 1024 * k AS base, least(1024, n_bytes - {WIDTH - 1} - 1024 * k) AS many, substr(digits, 2048 * k + 1, 2 * (1023 + {WIDTH})) AS part
  FROM (SELECT *, unnest(range((n_bytes - {WIDTH}) // 1024 + 1)) AS k FROM sized WHERE n_bytes >= {WIDTH})
), windows AS (
  SELECT nth, base + i AS pos, md5(substr(part, 2 * i + 1, {2 * WIDTH})) AS m FROM (SELECT *, unnest(range(many)) AS i FROM parts)
), twice AS (
  SELECT nth, pos FROM windows WHERE m IN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1)
), heads AS (
  SELECT nth, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY nth ORDER BY pos) <= {WIDTH} THEN 0 ELSE 1 END AS head FROM twice
), numbered AS (
  SELECT nth, pos, sum(head) OVER (PARTITION BY nth ORDER BY pos ROWS UNBOUNDED PRECEDING) AS span FROM heads
), spans AS (
  SELECT nth, span, min(pos) AS s, max(pos) + {WIDTH} AS e FROM numbered GROUP BY nth, span
), gaps AS (
  SELECT nth, span, s, e, coalesce(lag(e) OVER (PARTITION BY nth ORDER BY span), 0) AS since FROM spans
), cut AS (
  SELECT nth, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS tail,
         string_agg(substr(digits, 2 * since + 1, 2 * (s - since)), '' ORDER BY span) AS front
  FROM gaps JOIN sized USING (nth) GROUP BY nth
)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(digits, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM sized LEFT JOIN cut USING (nth)
"""
