"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its word shingles. In one global order (rare shingles
first), documents of similarity t with sizes n share at least m of the first
``n - ceil(t*n) + m`` shingles of both, for every m. Each document picks its own
m: a longer prefix costs more postings, but a pair has to share
``min(m_a, m_b)`` of them before it is verified. The choice minimises the
estimated cost from the document's shingle frequencies.

1. *Frequencies*: counts of all shingles of all texts in 2**20 hashed slots (a fixed
   8 MB). They set the order and the cost estimates, and never a result.
2. *Sets*: per text its size, digest, prefix and a 2048-bit parity signature. Texts with
   equal sets (copies) become one class, so groups of copies are never expanded.
3. *Pivot rounds*: every class is compared with one member of each posting list,
   drawn by hash (``PIVOTS`` draws per group of lists, as many times more each round); these pairs grow in line with
   the postings. Found links join classes to components. In the next round only
   classes outside a list's largest component are compared, with new members of that component,
   until few pairs are left (in line with the postings) or the lists stop shrinking. A pivot leaves its list, and so
   does what no other member of the list can be similar to by size: most lists end after one round.
4. *Remaining pairs*: per posting list, all pairs between different components
   found so far. The list's largest component is never paired with itself, so a
   group of near copies costs its size, not its square.
5. *Verification*: the parity signatures give a lower bound of the symmetric
   difference, which drops impossible pairs; the rest compare their whole sets.

Defined results: null or empty texts, and texts without words, have no
shingles, link with nothing and are their own component. A text of fewer words than the
width has its whole word sequence as its one shingle. Rows of one id are each
kept, and several texts under one id count as linked through it. Rows with a null id
get the component of their class, or null. Shingles are 64-bit hashes.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import brief_shuffles, lean, scratch, sf_table, small_batches, stash
from tidemark.llm.textkit import mix, shingles, slices, word_hashes

SLOTS, RANGE, MAX_MATCH, VERIFY_COST = 1 << 20, 1 << 14, 8, 20.0
PIVOTS, MAX_ROUNDS, LEFT_PER_POSTING, SHRINKS, FOLDS = 8, 8, 2, 0.7, 8
FILTER_BITS, PART = 1 << 24, 1 << 18


def _slot_counts(width: int):
    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, _, buf, off in slices(batch["text"], PART):
                own = shingles(*word_hashes(buf, off), width)
                total += np.bincount((np.concatenate(own) & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        parts = total.reshape(-1, RANGE)
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([parts[i].tobytes() for i in used], pa.binary())], names=["range", "counts"]
        )

    return count


def _sum_ranges(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in table["counts"].to_pylist())
    return pa.table({"range": table["range"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def shingle_frequencies(docs: DataFrame, width: int) -> np.ndarray:
    """Counts of all shingles in ``SLOTS`` hashed slots: 8 MB whatever the input."""
    kind = "range int, counts binary"
    parts = docs.select("text").mapInArrow(lean(_slot_counts(width)), kind).groupBy("range").applyInArrow(_sum_ranges, kind)
    out = np.zeros((SLOTS // RANGE, RANGE), np.int64)
    for r in parts.collect():  # at most SLOTS / RANGE rows
        out[r["range"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def prefix(s: np.ndarray, slots: np.ndarray, floor: float, num: int, den: int) -> tuple[int, np.ndarray]:
    """The number of shared tokens a document asks for, and its prefix (rare shingles first)."""
    n = len(s)
    need = -(-num * n // den)
    seen = slots[(s & np.uint64(SLOTS - 1)).astype(np.int64)]
    top = min(n, n - need + MAX_MATCH)
    order = np.lexsort((s, seen))[:top]
    others = np.maximum(0.0, seen[order] - 1 - floor)
    match = np.arange(1, min(MAX_MATCH, need) + 1)
    length = n - need + match
    cost = length + np.cumsum(others)[length - 1] * (1 + VERIFY_COST / match)
    best = int(cost.argmin())
    return int(match[best]), s[order[: length[best]]]


SETS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("match", pa.int32()), ("sig", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))]
)
SETS_SQL = "doc_id long, n long, d1 long, d2 long, match int, sig array<long>, prefix array<long>"


def _sets(slots, width: int, num: int, den: int):
    def describe(batches):
        seen = slots.value
        floor = seen.sum() / SLOTS
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for first, end, buf, off in slices(batch["text"], PART):
                rows = []
                for i, s in zip(ids[first:end], shingles(*word_hashes(buf, off), width), strict=True):
                    if not len(s):
                        rows.append((i, 0, 0, 0, 0, [], []))
                        continue
                    match, lead = prefix(s, seen, floor, num, den)
                    digest = mix(np.array([s.sum(), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64) + np.uint64(len(s)))
                    parity = np.packbits((np.bincount((s >> np.uint64(24)).astype(np.int64) & 2047, minlength=2048) & 1).astype(np.uint8))
                    rows.append((i, len(s), *digest.view(np.int64).tolist(), match, parity.view(np.int64), lead.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SETS, strict=True)], schema=SETS)

    return describe


def id_bits(ids: DataFrame) -> np.ndarray:
    """A fixed 2 MB of bits that hold every id (a Bloom filter of one hash)."""
    bit = F.pmod(F.col("id"), F.lit(FILTER_BITS))
    words_ = ids.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(id, {FILTER_BITS}) & 63 as int))").alias("v"))
    found = words_.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["w"].to_numpy()] = found["v"].to_numpy()
    return out


def _whole_sets(bits, width: int):
    def sets(batches):
        words_ = bits.value
        for batch in batches:
            at = batch["doc_id"].fill_null(0).to_numpy() % FILTER_BITS
            batch = batch.filter(pa.array((words_[at >> 6] >> (at & 63) & 1).astype(bool)))
            ids = batch["doc_id"]
            for first, end, buf, off in slices(batch["text"], PART):
                own = [s.tobytes() for s in shingles(*word_hashes(buf, off), width)]
                yield pa.RecordBatch.from_arrays([ids.slice(first, end - first), pa.array(own, pa.binary())], names=["doc_id", "items"])

    return sets


def _verify(num: int, den: int):
    def verify(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def shared_postings(postings: DataFrame, num: int = 0, den: int = 1) -> DataFrame:
    """The rows of ``postings`` whose token another row has too, of a size ``n`` that leaves the similarity ``num / den`` open.

    By size a row's nearest neighbours of a token are the likest, so no other row has to be looked at. All are
    shuffled once, at any size; joined with the counts of their tokens they went twice wherever the counts were too
    many to broadcast.
    """
    by_size = "OVER (PARTITION BY token ORDER BY n)"
    near = F.expr(f"lag(n) {by_size} * {den} >= n * {num} OR n * {den} >= lead(n) {by_size} * {num}")
    return postings.withColumn("near", near).where("near").drop("near")


def jaccard_classes(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component) per row of ``docs`` (doc_id, text).

    Documents link when ``den * |intersection| >= num * |union|`` of their
    sets of ``width``-word shingles.
    """
    spark = docs.sparkSession
    with scratch(spark, "jaccard"), brief_shuffles(spark), small_batches(spark):
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        slots = spark.sparkContext.broadcast(shingle_frequencies(docs, width))
        same = ["d1", "d2"]
        with scratch(spark, "prefixes"):
            whole = stash(docs.mapInArrow(lean(_sets(slots, width, num, den)), SETS_SQL), "sets")
            # equal sets have equal prefixes, so any row of a class stands for it
            kinds = whole.where("n > 0").groupBy(same).agg(F.min("doc_id").alias("rep"), *(F.any_value(c).alias(c) for c in ("n", "match", "sig", "prefix")))
            kinds = stash(kinds.where("rep IS NOT NULL"), "classes")
            postings = shared_postings(kinds.select(F.explode("prefix").alias("token"), "rep", "n", "match"), num, den)
            postings = stash(postings, "postings", keep=True)
            # the prefixes, most of what was stored, go here
            classes = stash(kinds.drop("prefix"), "classes", keep=True)
            sets = stash(whole.select("doc_id", "n", *same), "sets", keep=True)
        info = classes.select("rep", "n", "match", "sig")
        size = postings.count()

        def possible(pairs: DataFrame) -> DataFrame:
            """Pairs whose sizes and signatures leave the similarity open."""
            x = info.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
            y = info.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
            bits = F.zip_with("sa", "sb", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
            apart = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
            # |difference| <= (den - num) / (den + num) * (na + nb)
            fits = (den + num) * apart <= (den - num) * (F.col("na") + F.col("nb"))
            return pairs.join(x, "a").join(y, "b").where(fits).select("a", "b")

        def verified(pairs: DataFrame, name: str) -> DataFrame:
            # whole sets are made for documents of a pair only (and a few others that the bits let through)
            ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
            bits = spark.sparkContext.broadcast(id_bits(ids))
            with scratch(spark, "verify"):
                items = stash(docs.where("doc_id IS NOT NULL").mapInArrow(lean(_whole_sets(bits, width)), "doc_id long, items binary"), "items")
                x = items.withColumnsRenamed({"doc_id": "a", "items": "x"})
                y = items.withColumnsRenamed({"doc_id": "b", "items": "y"})
                return stash(pairs.join(y, "b").join(x, "a").mapInArrow(lean(_verify(num, den)), "a long, b long").distinct(), name, keep=True)

        def with_pivots(members: DataFrame, turn: int) -> DataFrame:
            """``members`` with one member of their list's largest component, which itself goes: of its list it meets every
            class of another component, so its pairs there are settled. Lists of a group draw alike."""
            draw = F.struct(F.xxhash64("rep", F.pmod("token", F.lit(PIVOTS ** (turn + 1))), F.lit(turn)).alias("h"), "rep", "n")
            pivots = members.where("major IS NULL OR c = major").groupBy("token").agg(F.min(draw).alias("pivot"))
            return members.join(pivots, "token").where(F.col("rep") != F.col("pivot.rep"))

        def pivot_pairs(members: DataFrame) -> DataFrame:
            """Each class outside its list's largest component with the pivot of the list."""
            near = F.least("n", "pivot.n") * den >= F.greatest("n", "pivot.n") * num
            pairs = members.where(near & (F.col("major").isNull() | (F.col("c") != F.col("major"))))
            return pairs.select(F.least("rep", "pivot.rep").alias("a"), F.greatest("rep", "pivot.rep").alias("b")).distinct()

        def mixed_lists(members: DataFrame, links: DataFrame) -> DataFrame:
            """What is left of ``members``: the lists that still hold several components, with their component and the list's largest."""
            found = components(links)
            member = shared_postings(members.select(*postings.columns), num, den)
            member = member.join(found, F.col("rep") == F.col("node"), "left").select(*postings.columns, F.coalesce("component", "rep").alias("c"))
            mixed = member.groupBy("token", "c").count().groupBy("token").agg(F.max_by("c", F.struct("count", "c")).alias("major"), F.count("*").alias("k"))
            return stash(member.join(mixed.where("k > 1").drop("k"), "token"), "members")

        members, links, tried, before = postings.withColumns({"c": F.col("rep"), "major": F.lit(None).cast("long")}), None, None, None
        for turn in range(MAX_ROUNDS):
            members = stash(with_pivots(members, turn), "with-pivots")
            pairs = pivot_pairs(members)
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = stash(possible(pairs), f"pivots{turn}")
            new = verified(pairs, f"pivot-links{turn}")
            tried = pairs if tried is None else tried.union(pairs)
            none = new.isEmpty()
            links = new if links is None else links.union(new)
            members = mixed_lists(members, links)
            per_list = members.groupBy("token").agg(F.count("*").alias("n"), F.count_if(F.col("c") != F.col("major")).alias("o"))
            left = per_list.agg(F.sum(F.col("n").cast("double") * F.col("o"))).first()[0] or 0
            if none or left <= LEFT_PER_POSTING * size or (before is not None and left > SHRINKS * before):
                break
            before = left

        # the parity of 512 classes of shingles: the signature folded by exclusive or
        fold = lambda i: reduce(lambda a, b: a.bitwiseXOR(b), (F.col("sig")[i + FOLDS * j] for j in range(32 // FOLDS)))
        bits = [f"s{i}" for i in range(FOLDS)]
        signed = info.select("rep", *(fold(i).alias(x) for i, x in enumerate(bits)))
        member = stash(members.join(signed, "rep"), "signed")
        other = member.where("c <> major").select("token", *(F.col(x).alias(f"{x}2") for x in ("rep", "n", "match", "c", *bits)))
        # sizes and signatures that rule a pair out are part of the join, so such pairs are never made
        apart = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(f"{x}2"))) for x in bits), F.lit(0))
        cross = member.join(other, "token").where(
            (F.col("c") != F.col("c2"))
            & ((F.col("c") == F.col("major")) | (F.col("rep") < F.col("rep2")))
            & (F.least("n", "n2") * den >= F.greatest("n", "n2") * num)
            & ((den + num) * apart <= (den - num) * (F.col("n") + F.col("n2")))
        )
        cross = cross.groupBy(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).agg(
            F.count("*").alias("shared"), F.any_value(F.least("match", "match2")).alias("due")
        )
        left = stash(possible(cross.where("shared >= due").select("a", "b").join(tried, ["a", "b"], "left_anti")), "pairs")
        links = links.union(verified(left, "links"))
        whole = components(links)
        per = classes.select(*same, "rep").join(whole, F.col("rep") == F.col("node"), "left").select(*same, F.coalesce("component", "rep").alias("component"))
        out = sets.select("doc_id", "n", *same).join(per, same, "left")
        out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component"))
        return stash(out, "jaccard", keep=True)


def _keys(whole: DataFrame) -> DataFrame:
    """The rows of ``whole`` (row, doc_id, text); those without an id get a key that no other row has, in place of it."""
    named = whole.where("doc_id IS NOT NULL")
    # stored, so that a row keeps its number
    lone = stash(whole.where("doc_id IS NULL").withColumn("number", F.monotonically_increasing_id()), "no-id")
    if lone.isEmpty():
        return named
    top = named.agg(F.max("doc_id")).first()[0]
    if top is None or top < 1 << 62:  # behind all ids
        return named.union(lone.select("row", (F.col("number") + max(0, (top or 0) + 1)).alias("doc_id"), "text"))
    for salt in itertools.count():  # ids are all over the range: numbers are turned until they meet none
        keyed = lone.select("row", F.xxhash64(F.col("number").bitwiseXOR(F.lit(salt << 40))).alias("doc_id"), "text")
        if named.select("doc_id").join(keyed.select("doc_id"), "doc_id", "left_semi").isEmpty():
            return named.union(keyed)


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, compare_all: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, of one document per component: that of the least id.

    Of several rows with that id the one with the least text stays. Rows without an id stay; with ``compare_all``
    each of them is a document of its own, compared like the others.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    if compare_all:
        whole = _keys(whole)
    found = jaccard_classes(whole, width, num, den).where("doc_id = component").select("doc_id").distinct()
    first = F.expr("row_number() OVER (PARTITION BY doc_id ORDER BY text)")
    one = whole.where("doc_id IS NOT NULL").join(found, "doc_id", "left_semi").withColumn("nth", first).where("nth = 1")
    return one.select("row.*").union(whole.where("doc_id IS NULL").select("row.*"))


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(sf_table(spark, sf_dir, "documents"), width=3, num=90, den=100).withColumnRenamed("component", "component_id")


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (SELECT a, b FROM both_ JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 90 * (x.n + y.n - i)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(l.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least l ON w.doc_id = l.a
"""
