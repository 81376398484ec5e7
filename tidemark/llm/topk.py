"""Exact top-k search by inner product: a KD-tree per shard of the vectors.

1. *Shards.* Rows are dealt to shards by a hash of their id (and by their
   dimension), ``shard_rows`` each on average. Every shard builds its KD-tree: the
   widest dimension is split at the median until at most ``leaf_rows`` rows
   are left, and each node keeps the tight box of its rows. The tree travels as
   one row of packed arrays.
2. *Queries* leave the shards in packed blocks of at most ``block_rows``.
3. *First pass.* Every block searches one shard, which gives each query a
   k-th score. *Second pass.* Every block searches the other shards, starting
   from that score: nodes whose box cannot reach it are never opened.
4. In a tree, a query opens leaves best box bound first and stops when the
   next bound is below its k-th score. The bound of a box is the sum over
   dimensions of the larger of ``q*lo`` and ``q*hi``. Equal bounds are opened, so
   ties are decided by id alone.
5. The k best of all shards are ranked per query.

Vectors are whole numbers, and scores are exact: float64 products while every
sum stays below 2**53, 64-bit integers beyond (a score must fit a long).

Defined results: null vectors, and vectors with null or non-finite components,
take no part; neither do rows with a null id. Rows are known by id: of several
rows with one id, the least vector counts. Vectors of different length are
never compared; an empty vector scores 0 with the other empty ones. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import scratch, sf_table, stash

SHARD_ROWS, LEAF_ROWS, BLOCK_ROWS, BLOCKS_A_TASK = 8192, 128, 512, 64

LOW = -(1 << 62)  # below every score
TREE = "dim int, shard int, n int, ids binary, rows binary, leaf_at binary, lo binary, hi binary, query_ids binary, query_rows binary"


def build_tree(rows: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows, leaf limits, and tight boxes of the leaves by median splits."""
    order, limits = np.arange(len(rows)), []
    todo = [(0, len(rows))]
    while todo:
        a, b = todo.pop()
        part = rows[order[a:b]]
        spread = part.max(0) - part.min(0) if part.shape[1] else np.zeros(0)
        if b - a <= leaf_rows or not spread.size or not spread.any():
            limits.append((a, b))
            continue
        mid = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, spread.argmax()], mid)]
        todo += [(a, a + mid), (a + mid, b)]
    at = np.array(sorted(limits), np.int64).reshape(-1, 2)
    lo = np.array([rows[order[a:b]].min(0) for a, b in at])
    hi = np.array([rows[order[a:b]].max(0) for a, b in at])
    return order, np.append(at[:, 0], len(rows)), lo, hi


def search_tree(ids, rows, leaf_at, lo, hi, query_ids, queries, kth, k):
    """Best ``k`` rows per query that score at least ``kth``: (query number, id, score)."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bound = up @ hi.T + down @ lo.T
    turn = np.argsort(-bound, axis=1, kind="stable")
    n = len(queries)
    low = LOW
    best_s, best_i = np.full((n, k), low, np.int64), np.full((n, k), np.iinfo(np.int64).max, np.int64)
    kth = kth.copy()
    live = np.arange(n)
    for step in range(bound.shape[1]):
        leaf = turn[live, step]
        open_ = bound[live, leaf] >= kth[live]
        live, leaf = live[open_], leaf[open_]
        if not len(live):
            break
        for f in np.unique(leaf):
            q = live[leaf == f]
            a, b = leaf_at[f], leaf_at[f + 1]
            score = (queries[q] @ rows[a:b].T).astype(np.int64)
            own = query_ids[q][:, None] == ids[a:b][None, :]
            score[own] = low
            s = np.concatenate([best_s[q], score], 1)
            i = np.concatenate([best_i[q], np.broadcast_to(ids[a:b], score.shape)], 1)
            keep = np.lexsort((i, -s), axis=1)[:, :k]
            best_s[q], best_i[q] = np.take_along_axis(s, keep, 1), np.take_along_axis(i, keep, 1)
        kth[live] = np.maximum(kth[live], best_s[live, k - 1].astype(kth.dtype))
    q, j = np.nonzero((best_s > low) & (best_s >= kth[:, None]))
    return q, best_i[q, j], best_s[q, j]


def _exact(*arrays: np.ndarray) -> type:
    """float64 while every inner product stays below 2**53, else int64."""
    big = [float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0 for x in arrays]
    dim = max(1, arrays[0].shape[-1])
    return np.float64 if max(big) ** 2 * dim < 2**53 else np.int64


def _builder(leaf_rows: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, shard = int(pdf["dim"].iloc[0]), int(pdf["shard"].iloc[0])
        ids = pdf["id"].to_numpy(np.int64)
        rows = np.array(pdf["v"].tolist(), np.int64).reshape(len(ids), dim)
        first = np.lexsort((*rows.T[::-1], ids))
        first = first[np.append(True, ids[first][1:] != ids[first][:-1])]
        ids, rows, asks = ids[first], rows[first], pdf["asks"].to_numpy(bool)[first]
        order, leaf_at, lo, hi = build_tree(rows, leaf_rows)
        raw = lambda x, t=np.int64: np.ascontiguousarray(x, t).tobytes()
        return pd.DataFrame(
            [[dim, shard, len(ids), raw(ids[order]), raw(rows[order]), raw(leaf_at), raw(lo), raw(hi), raw(ids[asks]), raw(rows[asks])]],
            columns=[c.split()[0] for c in TREE.split(", ")],
        )

    return build


def _searcher(k: int):
    def search(blocks: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.zeros(0, np.int64) for c in ("dim", "block", "query_id", "vec_id", "score")})]
        for t in trees.itertuples():
            ids, leaf_at = np.frombuffer(t.ids, np.int64), np.frombuffer(t.leaf_at, np.int64)
            rows, lo, hi = (np.frombuffer(x, np.int64).reshape(n, t.dim) for x, n in ((t.rows, len(ids)), (t.lo, len(leaf_at) - 1), (t.hi, len(leaf_at) - 1)))
            for r in blocks.itertuples():
                query_ids = np.frombuffer(r.block_ids, np.int64)
                queries = np.frombuffer(r.block_rows, np.int64).reshape(len(query_ids), t.dim)
                kth = np.frombuffer(r.kth, np.int64) if r.kth is not None else np.full(len(queries), LOW)
                as_ = _exact(rows, queries)
                q, i, s = search_tree(ids, rows.astype(as_), leaf_at, lo.astype(as_), hi.astype(as_), query_ids, queries.astype(as_), kth, k)
                out.append(pd.DataFrame({"dim": t.dim, "block": r.block, "query_id": query_ids[q], "vec_id": i, "score": s}))
        return pd.concat(out[1:] or out)

    return search


def _blocks(block_rows: int):
    def cut(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                ids = np.frombuffer(r.query_ids, np.int64)
                rows = np.frombuffer(r.query_rows, np.int64).reshape(len(ids), r.dim)
                out += [
                    (r.dim, r.shard, (r.shard << 24) + a // block_rows, ids[a : a + block_rows].tobytes(), rows[a : a + block_rows].tobytes())
                    for a in range(0, len(ids), block_rows)
                ]
            yield pd.DataFrame(out, columns=["dim", "home", "block", "block_ids", "block_rows"])

    return cut


def _with_kth(k: int):
    """Adds each query's k-th score of the first pass to its block, in the block's order."""

    def add(blocks: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        last = found[found["rank"] == k].set_index("query_id")["score"] if len(found) else {}
        low = LOW
        blocks["kth"] = [
            np.array([last.get(i, low) for i in np.frombuffer(b, np.int64).tolist()], np.int64).tobytes() for b in blocks["block_ids"]
        ]
        return blocks

    return add


def top_k(
    vectors: DataFrame,
    k: int = 20,
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of every asking row's ``k`` best other rows.

    ``vectors``: id long, v array<long>, asks boolean (is the row a query).
    """
    with scratch(vectors.sparkSession, "top-k"):
        vectors = vectors.select("id", "v", "asks").where("id IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))
        sizes = stash(vectors.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards")), "shards")
        dealt = vectors.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))
        trees = stash(dealt.groupBy("dim", "shard").applyInPandas(_builder(leaf_rows), TREE), "trees")
        cut = "dim int, home int, block long, block_ids binary, block_rows binary"
        blocks = stash(trees.select("dim", "shard", "query_ids", "query_rows").mapInPandas(_blocks(block_rows), cut), "blocks")
        tree = trees.drop("query_ids", "query_rows", "n")
        parts = -(-blocks.count() // BLOCKS_A_TASK) or 1
        tree = tree.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        blocks = blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
        keys = ["dim", "shard", "part"]
        search = lambda left: left.groupBy(keys).cogroup(tree.groupBy(keys)).applyInPandas(
            _searcher(k), "dim int, block long, query_id long, vec_id long, score long"
        )
        first = stash(search(blocks.withColumn("kth", F.lit(None).cast("binary")).withColumnRenamed("home", "shard")), "first")
        rank = F.expr("row_number() OVER (PARTITION BY dim, query_id ORDER BY score DESC, vec_id)")
        known = blocks.groupBy("dim", "block").cogroup(first.withColumn("rank", rank).groupBy("dim", "block")).applyInPandas(
            _with_kth(k), cut + ", part int, kth binary"
        )
        away = known.join(sizes, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where("shard <> home")
        rest = search(away)
        out = first.union(rest).withColumn("rank", rank).where(F.col("rank") <= k)
        return stash(out.select("query_id", "rank", "vec_id", "score"), "top-k", keep=True)


def scaled(embedding: str, factor: int = 64):
    """floor(factor * x) of every component as long, or null where a vector takes no part."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(embedding, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))
    return F.when(F.col(embedding).isNotNull() & ~bad, whole)


def op1_kdtree_topk(spark, sf_dir: str) -> DataFrame:
    rows = sf_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), scaled("embedding").alias("v"), (F.col("vec_id") % 20 == 0).alias("asks")
    )
    return top_k(rows, k=20).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
