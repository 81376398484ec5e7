"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

1. *Equal vectors* (same label, same components) are grouped first, so a group
   of copies, however large, is one weighted vector.
2. *Cells.* Labels with more than ``cell_rows`` different vectors get centroids by
   spherical k-means, fitted on at most ``SAMPLE_ROWS`` vectors (those of least
   hash; at most ``MAX_CELLS`` centroids in all, so the centroids are a bounded
   broadcast). Every vector has the cell of its nearest centroid as home.
3. *Border vectors.* A linked pair may have two homes. A vector also visits each
   lower-numbered cell whose border it is close to: with the angle t of the
   threshold, ``b.(c_home - c) <= sin(t) * |c_home - c|``. If a (home c) and b are
   within t, b's distance to the border plane between both cells is at most t,
   so b visits c: no link is lost, at any fit of the centroids.
4. *Blocks.* Cells are cut into blocks of ``block_rows``; one task multiplies two
   blocks. It returns link counts per vector and, in place of all pairs, one link
   per vector to the least member of its part of the block.
5. Components of those links; one representative (least id) per component.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components, and rows with a null label, link with nothing and are kept,
as their own component. Vectors of different length do not link. Rows with the
same id are each one vector with links of its own and get a row each; a null id gets a row with a
null component. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import scratch, sf_table, stash

CELL_ROWS, BLOCK_ROWS, SAMPLE_ROWS, MAX_CELLS = 2000, 1000, 20000, 512


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = np.asarray(column.flatten().cast(pa.float64())).reshape(len(column), -1)
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` unit centroids of unit rows, from evenly spaced rows as a start."""
    centroids = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = (rows @ centroids.T).argmax(1)
        total = np.zeros_like(centroids)
        np.add.at(total, home, rows)
        length = np.linalg.norm(total, axis=1)
        centroids = np.where(length[:, None] > 0, total / np.maximum(length, 1e-300)[:, None], centroids)
    return centroids


def _fit(groups: DataFrame, cell_rows: int) -> dict:
    """Centroids by (label, dim) of the large labels."""
    large = groups.groupBy("label", "dim").count().where(F.col("count") > cell_rows).orderBy(F.desc("count"), "label", "dim").limit(MAX_CELLS // 2).collect()
    if not large:
        return {}
    total = sum(r["count"] for r in large)
    cells = min(MAX_CELLS - len(large), -(-total // cell_rows))
    keys = groups.sparkSession.createDataFrame([(r["label"], r["dim"]) for r in large], groups.select("label", "dim").schema)
    taken = groups.join(F.broadcast(keys), ["label", "dim"]).orderBy(F.xxhash64("least_id", "vec"), "least_id").limit(SAMPLE_ROWS).select("label", "dim", "vec").toArrow()
    out = {}
    names = list(zip(taken["label"].to_pylist(), taken["dim"].to_pylist(), strict=True))
    for r in large:
        own = [i for i, x in enumerate(names) if x == (r["label"], r["dim"])]
        k = max(1, min(len(own) // 4, cells * r["count"] // total))
        if k > 1:
            out[r["label"], r["dim"]] = spherical_kmeans(_matrix(taken["vec"].take(own)), k)
    return out


def _assign(centroids, threshold: float):
    reach = math.sqrt(max(0.0, 1 - threshold * threshold)) + 1e-9

    def assign(batches):
        for batch in batches:
            at, cell, home = [], [], []
            names = list(zip(batch["label"].to_pylist(), batch["dim"].to_pylist(), strict=True))
            for key in dict.fromkeys(names):
                own = np.array([i for i, x in enumerate(names) if x == key])
                c = centroids.value.get(key)
                if c is None:
                    at.append(own), cell.append(np.zeros(len(own), int)), home.append(np.ones(len(own), bool))
                    continue
                x = _matrix(batch["vec"].take(pa.array(own)))
                score = x @ c.T
                near = score.argmax(1)
                apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))[near]
                visit = (score[np.arange(len(x)), near][:, None] - score <= reach * apart) & (np.arange(len(c))[None, :] < near[:, None])
                row, other = np.nonzero(visit)
                at += [own, own[row]]
                cell += [near, other]
                home += [np.ones(len(own), bool), np.zeros(len(row), bool)]
            if at:
                picked = batch.take(pa.array(np.concatenate(at)))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(np.concatenate(cell), pa.int32()), pa.array(np.concatenate(home))],
                    names=[*picked.schema.names, "cell", "home"],
                )

    return assign


def _products(threshold: float):
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def products(table: pa.Table) -> pa.Table:
        x, ids = _matrix(table["vec"]), table["rep"].to_numpy()
        weight, home = table["w"].to_numpy(), table["home"].to_numpy()
        left, right = (np.flatnonzero(table["side"].to_numpy() == s) for s in (0, 1))
        a, b = np.nonzero(x[left] @ x[right].T >= threshold)
        a, b = left[a], right[b]
        apart = ids[a] != ids[b]
        a, b = a[apart], b[apart]
        links = np.bincount(a, weight[b], len(ids))
        links += np.bincount(b, weight[a] * ~home[b], len(ids))
        root = ids.copy()
        while True:  # least id within the block's links
            was = root.copy()
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
            if (was == root).all():
                break
        some = np.unique(np.concatenate([a, b]))
        return pa.table([ids[some], links[some].astype(np.int64), root[some]], schema=schema)

    return products


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_links, component, kept) of every row of (id, label, vec array<float or double>)."""
    spark = vectors.sparkSession
    with scratch(spark, "embeddings"):
        vectors = vectors.select("id", "label", "vec")
        double = F.transform("vec", lambda x: x.cast("double"))
        fit = F.col("label").isNotNull() & F.col("id").isNotNull() & (F.size("vec") > 0)
        fit &= ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
        # a common factor keeps squares of huge or tiny components finite
        top = F.array_max(F.transform(double, F.abs))
        unit = F.when(fit, F.when((top > 1e100) | (top < 1e-100), F.transform(double, lambda x: x / top)).otherwise(double))
        rows = vectors.withColumn("vec", unit)
        groups = rows.where("vec IS NOT NULL").groupBy("label", "vec").agg(F.min("id").alias("least_id"), F.count("*").alias("w"))
        # different vectors may share an id, so a group has a number of its own (fixed by the write)
        groups = stash(groups.withColumn("dim", F.size("vec")).withColumn("rep", F.monotonically_increasing_id()), "vectors")
        centroids = spark.sparkContext.broadcast(_fit(groups, cell_rows))
        kinds = groups.schema
        out = f"label {kinds['label'].dataType.simpleString()}, vec array<double>, rep long, w long, dim int, cell int, home boolean"
        celled = stash(groups.select("label", "vec", "rep", "w", "dim").mapInArrow(_assign(centroids, threshold), out), "cells")
        key = ["label", "dim", "cell"]
        size = celled.groupBy(key).agg(F.sum(F.col("home").cast("int")).alias("m"), F.count("*").alias("n")).where("n > 1 AND m > 0")
        part = lambda n: F.ceil(F.col(n) / block_rows).cast("int")
        spread = celled.join(size, key).withColumn("nl", part("m")).withColumn("nr", part("n")).withColumn("h", F.abs(F.xxhash64("rep") % 1000003))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = spread.where("home").withColumn("lb", (F.col("h") % F.col("nl")).cast("int")).withColumn("rb", every("nr")).withColumn("side", F.lit(0))
        right = spread.withColumn("lb", every("nl")).withColumn("rb", (F.col("h") % F.col("nr")).cast("int")).withColumn("side", F.lit(1))
        cols = [*key, "lb", "rb", "side", "rep", "w", "home", "vec"]
        pairs = left.select(cols).union(right.select(cols)).groupBy(*key, "lb", "rb")
        found = stash(pairs.applyInArrow(_products(threshold), "rep long, links long, root long"), "products")
        links = found.groupBy("rep").agg(F.sum("links").alias("links"))
        numbered = components(found, "rep", "root").withColumnRenamed("component", "number")
        numbered = stash(numbered.join(groups.select(F.col("rep").alias("node"), "least_id"), "node"), "components")
        least = numbered.groupBy("number").agg(F.min("least_id").alias("component"))
        whole = numbered.drop("least_id").join(least, "number")
        per = groups.join(links, "rep", "left").join(whole, F.col("rep") == F.col("node"), "left")
        per = per.select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "least_id").alias("component"))
        # the key of the join back to the rows: a hot one is split by the join's skew handling
        per = per.withColumn("same", F.xxhash64("label", "vec")).withColumnsRenamed({"label": "l2", "vec": "v2"})
        rows = rows.withColumn("same", F.when(F.col("vec").isNotNull(), F.xxhash64("label", "vec")))
        joined = rows.join(per, (rows["same"] == per["same"]) & (F.col("label") == F.col("l2")) & (F.col("vec") == F.col("v2")), "left")
        out = joined.select(
            "id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
        return stash(out.withColumn("kept", F.col("id") == F.col("component")), "embeddings", keep=True)


def op3_embedding_neardup(spark, sf_dir: str) -> DataFrame:
    rows = sf_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))
    return near_duplicates(rows, 0.98).select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(l.b, vec_id)) AS kept
FROM embeddings LEFT JOIN least l ON vec_id = l.a LEFT JOIN degree d ON vec_id = d.a
"""
