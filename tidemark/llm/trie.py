"""Prefix trie of conversations with subtree totals by depth-band rollup.

A conversation is its turns (role, text) in order. Every distinct sequence of
first d turns is a node of depth d; the root has depth 0. Conversations that
start with it are its members.

1. *Positions.* Turns are range-partitioned by (conversation, turn) and numbered
   per partition, plus the turns of the partitions before, so that a conversation
   with a third of all rows is still split.
2. *Keys.* Turns travel as 128-bit digests. A node's key is the running exclusive or of its
   turns' (position, digest) hashes: per band of ``height`` positions, plus one total
   of each band before. Grouping by key gives members and the smallest member; hot nodes are
   summed before the shuffle.
3. *Depth bands.* A node gives what it adds (a leaf, saved tokens) only to its
   ancestors in its own band of ``height`` depths. Then, from the deepest band up, the
   completed totals of a band's topmost nodes are summed by parent and given to the
   parent's ancestors in the band above. With D the largest depth a node
   has ``height`` such ancestors at most and there are D / height rounds; the default height is
   the root of D, which bounds both.
4. *Ends.* The ids of the members that end at a node become one SHA-256 of an ordered list. Ids are
   sorted and joined in blocks of ``BLOCK`` ids, and one reader per node hashes its blocks in
   order, in bounded memory. (A digest of one ordered list can't be split further.)

Defined results: a null role or text is empty; a null turn comes first, and turns of one
number are ordered by their digests. Rows without a conv_id take no part. Repeated rows are
turns of their own. Extra columns are ignored. An empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import crc32_sql, scratch, sf_table, stash

BLOCK, LEAST_HEIGHT = 4096, 4
KEY = ["depth", "k1", "k2"]
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, bytes): every turn with its place from 1, as digest and length of the text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"),
    )
    # equal rows of one conversation are told apart by their row, so no range is larger than its share
    order = ["conv_id", F.col("turn").asc_nulls_first(), "a", "b", "row"]
    dealt = stash(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    parts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("conv_id", "part", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("conv_id", "part").orderBy(*order[1:]))
    return dealt.withColumn("own", own).join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("own") + F.col("before")).alias("pos"), "a", "b", "bytes"
    )


def shared_head(conv_id: Column) -> Column:
    """h: how many first turns of the group's conversation a conversation takes over."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def rebuilt(numbered: DataFrame, group: int = 5) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, a, b, bytes) of the rebuilt conversations, and (conv_id, length) of each.

    Conversation c takes the first h turns of conversation c - c % ``group`` (all if it has
    fewer, none if it is absent) and then its own turns after its first h.
    """
    numbered = stash(numbered, "numbered")
    sizes = stash(numbered.groupBy("conv_id").agg(F.max("pos").alias("n")), "sizes")
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(group))
    heads = sizes.select("conv_id", "n", base.alias("base"), shared_head(F.col("conv_id")).alias("h"))
    heads = heads.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("lends")), "base", "left")
    lends = F.least(F.col("h"), F.coalesce("lends", F.lit(0)))
    heads = heads.select(F.col("conv_id").alias("c"), "h", lends.alias("lent"), (lends + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length"))
    heads = stash(heads, "heads")

    own = F.when(F.col("pos") > shared_head(F.col("conv_id")), F.struct(F.col("conv_id").alias("c"), F.lit(False).alias("borrowed")))
    takers = (F.try_add(F.col("conv_id"), F.lit(r).cast("long")) for r in range(group))
    lent = [
        F.when((F.pmod(F.col("conv_id"), F.lit(group)) == 0) & (F.col("pos") <= 8) & (F.col("pos") <= shared_head(c)), F.struct(c.alias("c"), F.lit(True).alias("borrowed")))
        for c in takers
    ]
    given = numbered.select("pos", "a", "b", "bytes", F.inline(F.array_compact(F.array(own, *lent))))
    depth = F.when(F.col("borrowed"), F.col("pos")).otherwise(F.col("pos") - F.col("h") + F.col("lent"))
    out = given.join(heads, "c").select(F.col("c").alias("conv_id"), depth.cast("long").alias("depth"), "a", "b", "bytes")
    return out, heads.select(F.col("c").alias("conv_id"), F.col("length").cast("long").alias("length"))


def keyed(sequences: DataFrame, height: int) -> DataFrame:
    """(conv_id, depth, k1, k2, bytes, above): node key of every prefix; above: the keys over it, from the node that ends the band before."""
    rows = sequences.select(
        "conv_id", "depth", F.xxhash64(F.lit(3), "depth", "a", "b").alias("a"), F.xxhash64(F.lit(4), "depth", "a", "b").alias("b"), "bytes",
        F.floor((F.col("depth") - 1) / height).alias("band"),
    )
    bands = rows.groupBy("conv_id", "band").agg(
        F.array_sort(F.collect_list(F.struct("depth", "a", "b", "bytes"))).alias("steps"), F.bit_xor("a").alias("x1"), F.bit_xor("b").alias("x2")
    )
    before = W.partitionBy("conv_id").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bands = bands.withColumns({"c1": F.coalesce(F.bit_xor("x1").over(before), zero), "c2": F.coalesce(F.bit_xor("x2").over(before), zero)})
    # running keys inside the band: at most ``height`` steps
    path = F.expr("""aggregate(steps, array(named_struct('k1', c1, 'k2', c2)),
        (path, x) -> concat(path, array(named_struct('k1', element_at(path, -1).k1 ^ x.a, 'k2', element_at(path, -1).k2 ^ x.b))))""")
    steps = bands.withColumn("path", path).select("conv_id", "path", F.posexplode("steps").alias("at", "step"))
    here = F.element_at("path", F.col("at") + 2)
    return steps.select(
        "conv_id", F.col("step.depth").alias("depth"), here["k1"].alias("k1"), here["k2"].alias("k2"), F.col("step.bytes").alias("bytes"),
        F.slice("path", 1, F.col("at") + 1).alias("above"),
    )


def _band_top(depth: Column, height: int) -> Column:
    """The depth just above the band that holds ``depth``."""
    return F.floor((depth - 1) / height) * height


def _to_ancestors(rows: DataFrame, height: int, itself: bool) -> DataFrame:
    """Each row's (leaves, saved) for its ancestors in its own band, with or without itself; rows need depth, key and above."""
    top = _band_top(F.col("depth"), height)
    # above[0] belongs to the band before; depths follow from the place in the list
    inside = F.slice("above", 2, F.greatest(F.size("above") - 1, F.lit(0)))
    path = F.concat(inside, F.array(F.struct("k1", "k2"))) if itself else inside
    spread = rows.select("leaves", "saved", top.alias("top"), F.posexplode(path).alias("at", "key"))
    spread = spread.select((F.col("top") + 1 + F.col("at")).cast("long").alias("depth"), "key.k1", "key.k2", "leaves", "saved")
    return spread.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def subtree_totals(nodes: DataFrame, height: int, depth: int) -> DataFrame:
    """(depth, k1, k2, leaves, saved) summed over the subtree of every node below the root; nodes carry what each adds itself."""
    nodes = nodes.where("depth > 0")
    partial = stash(_to_ancestors(nodes, height, itself=True), "partial")
    done, below = [], None
    for band in reversed(range(-(-depth // height))):
        low, high = band * height, (band + 1) * height
        inside = partial.where((F.col("depth") > low) & (F.col("depth") <= high))
        if below is not None:
            # what hangs under the band's lowest nodes goes to each of them and their ancestors in the band
            feet = nodes.where(F.col("depth") == high).select(*KEY, "above").join(below, KEY)
            inside = inside.union(_to_ancestors(feet, height, itself=True)).groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        inside = stash(inside, f"band{band}")
        done.append(inside)
        tops = inside.where(F.col("depth") == low + 1).join(nodes.where(F.col("depth") == low + 1).select(*KEY, "above"), KEY)
        over = F.element_at("above", 1)
        below = tops.select((F.col("depth") - 1).alias("depth"), over["k1"].alias("k1"), over["k2"].alias("k2"), "leaves", "saved")
        below = stash(below.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), f"below{band}")
    out = below if below is not None else None  # of the topmost band: the root's totals
    for part in done:
        out = part if out is None else out.unionByName(part)
    return out if out is not None else partial


def _digests(batches):
    """SHA-256 of the ids of each key; the blocks of a key follow one another."""
    key, hasher, first = None, None, True
    for batch in batches:
        out = []
        for depth, k1, k2, ids in zip(*(batch[c].to_pylist() for c in (*KEY, "ids")), strict=True):
            if (depth, k1, k2) != key:
                if key is not None:
                    out.append((*key, hasher.hexdigest()))
                key, hasher, first = (depth, k1, k2), hashlib.sha256(), True
            hasher.update(ids.encode() if first else b"," + ids.encode())
            first = False
        if out:
            yield _digest_batch(out)
    if key is not None:
        yield _digest_batch([(*key, hasher.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*KEY, "ends"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends): SHA-256 of the ids (conv_id) that end at each node, in numeric order, comma-joined."""
    blocks = ends.groupBy(*KEY, F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids")
    )
    dealt = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block")
    return dealt.select(*KEY, "ids").mapInArrow(_digests, "depth long, k1 long, k2 long, ends string")


def trie(sequences: DataFrame, lengths: DataFrame, height: int | None = None) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv_id, depth, a, b, bytes); see ``NODE``.

    ``lengths`` (conv_id, length) has every conversation, those without turns too.
    """
    spark = lengths.sparkSession
    with scratch(spark, "trie"):
        lengths = stash(lengths, "lengths")
        first, deepest, n = lengths.agg(F.min("conv_id"), F.max("length"), F.count("*")).first()
        if not n:
            return stash(spark.createDataFrame([], NODE), "nodes", keep=True)
        height = height or max(LEAST_HEIGHT, isqrt(max(0, deepest - 1)) + 1)
        prefixes = stash(keyed(sequences, height), "prefixes")
        zero = F.lit(0).cast("long")
        nodes = prefixes.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.first("above").alias("above"))
        root = spark.range(1).select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(first).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("n_convs"), zero.alias("bytes"), F.lit(None).cast("array<struct<k1:bigint,k2:bigint>>").alias("above"))
        nodes = stash(nodes.unionByName(root), "tops")
        parent = F.element_at("above", -1)
        linked = nodes.select(*KEY, "conv_id", parent["k1"].alias("p1"), parent["k2"].alias("p2"))
        children = linked.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
        nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
        leaf = (F.col("n_children") == 0).cast("long")
        nodes = stash(nodes.withColumns({"leaves": leaf, "saved": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes")
        totals = subtree_totals(nodes, height, int(deepest))
        own_end = prefixes.select(*KEY, "conv_id").join(lengths, "conv_id").where("depth = length").select(*KEY, "conv_id")
        ends = end_digests(own_end.union(lengths.where("length = 0").select(zero, zero, zero, "conv_id")))
        totals = totals.withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})
        whole = nodes.join(totals, KEY, "left").join(ends, KEY, "left")
        over = F.element_at("above", -1)
        whole = whole.withColumns({"up": F.col("depth") - 1, "p1": over["k1"], "p2": over["k2"]})
        parents = nodes.select(F.col("depth").alias("up"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
        out = whole.join(parents, ["up", "p1", "p2"], "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            F.coalesce("n_leaves", "leaves").alias("n_leaves"), F.coalesce("saved_tokens", "saved").alias("saved_tokens"),
            F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
        return stash(out, "trie", keep=True)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    with scratch(spark, "op12"):
        sequences, lengths = rebuilt(turns(sf_table(spark, sf_dir, "conversations")))
        return stash(trie(stash(sequences, "rebuilt"), lengths), "out", keep=True)


OP12_SQL = f"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, c - c % 5 AS base, {crc32_sql("c::VARCHAR")} % 9 AS h FROM own),
heads AS (SELECT ids.*, least(h, coalesce(n, 0)) AS lent FROM ids LEFT JOIN (SELECT c AS base, max(pos) AS n FROM own GROUP BY 1) USING (base)),
built AS (
  SELECT heads.c, pos AS d, role, text FROM heads JOIN own ON own.c = heads.base WHERE pos <= h
  UNION ALL
  SELECT c, pos - h + lent, role, text FROM heads JOIN own USING (c) WHERE pos > h),
chain AS (
  SELECT c, d, octet_length(encode(text)) AS bytes,
         md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY d)
             OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS k FROM built),
steps AS (
  SELECT c, d, bytes, k, coalesce(lag(k) OVER (PARTITION BY c ORDER BY d), '') AS up FROM chain
  UNION ALL SELECT c, 0, 0, '', NULL FROM ids),
ended AS (SELECT steps.*, d = max(d) OVER (PARTITION BY c) AS last FROM steps),
nodes AS (
  SELECT d, k, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
         sha256(coalesce(string_agg(CASE WHEN last THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM ended GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
own_part AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM nodes LEFT JOIN kids USING (d, k)),
under AS (  -- a node's representative passes all nodes above it
  SELECT s.d, s.k, sum((o.n_children = 0)::BIGINT) AS n_leaves, sum(o.saved) AS saved_tokens
  FROM own_part o JOIN steps s ON s.c = o.conv_id AND s.d <= o.d GROUP BY ALL)
SELECT o.conv_id, o.d::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children::BIGINT AS n_children,
       u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM own_part o JOIN under u USING (d, k) LEFT JOIN nodes p ON p.d = o.d - 1 AND p.k = o.up
"""
