"""Top-k search, embedding near-duplicates and the Jaccard join against brute force."""

from __future__ import annotations

import collections
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.embeddings import near_duplicates
from tidemark.llm.jaccard import jaccard_classes, keep_one, shared_postings
from tidemark.llm.topk import build_tree, scaled, top_k


def least_ids(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shard_rows", [40, 1000])
def test_topk_matches_brute_force(spark, shard_rows):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-4, 5, (300, 6))  # small range: many ties
    vectors[50:60] = vectors[5]
    rows = [(i, [int(x) for x in v], i % 20 == 0) for i, v in enumerate(vectors)]
    rows += [(1000, None, True), (None, [1] * 6, True), (1001, [7, 7], True), (1002, [1, 2], False), (3, rows[3][1], False)]
    df = spark.createDataFrame(rows, "id long, v array<long>, asks boolean")
    got = collections.defaultdict(list)
    for r in top_k(df, 5, shard_rows=shard_rows, leaf_rows=8, block_rows=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in range(0, 300, 20):
        score = vectors @ vectors[q]
        order = [i for i in np.lexsort((np.arange(300), -score)) if i != q][:5]
        assert got[q] == [(i, score[i]) for i in order]
    assert got[1001] == [(1002, 21)] and 1000 not in got


def test_topk_empty_and_bad_vectors(spark):
    rows = [(1, [0.5, float("nan")]), (2, [0.5, None]), (3, None), (20, [0.51, -0.01]), (5, [float("inf"), 0.0]), (6, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, e array<double>").select("id", scaled("e").alias("v"), (__import__("pyspark").sql.functions.col("id") % 20 == 0).alias("asks"))
    assert [(r.query_id, r.vec_id, r.score) for r in top_k(df, 5).collect()] == [(20, 6, 32 * 64 - 64)]
    assert top_k(df.where("id < 0"), 5).count() == 0


def test_tree_boxes_are_tight():
    rows = np.random.default_rng(0).integers(0, 100, (500, 3))
    order, at, lo, hi = build_tree(rows, 16)
    assert sorted(order) == list(range(500))
    for k, (a, b) in enumerate(itertools.pairwise(at)):
        assert b - a <= 16 and (rows[order[a:b]].min(0) == lo[k]).all() and (rows[order[a:b]].max(0) == hi[k]).all()


@pytest.mark.parametrize("cell_rows", [30, 5000])
def test_embedding_links(spark, cell_rows):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 8))
    x = np.concatenate([b + rng.normal(scale=s, size=(25, 8)) for b, s in zip(base, np.linspace(0.02, 0.5, 12), strict=True)])
    x[10:20] = x[3]
    x = x.astype(np.float32)
    label = [None if i % 40 == 7 else int(i % 2) for i in range(len(x))]
    rows = [(i, label[i], [float(v) for v in x[i]]) for i in range(len(x))]
    rows += [(900, 0, None), (901, 0, [0.0] * 8), (902, 0, [float("nan")] * 8), (903, 0, [None] * 8), (904, 0, []), (905, 0, [1.0]), (906, 0, [2.0]), (907, 0, [1e300] * 8), (908, 0, [2e300] * 8)]
    df = spark.createDataFrame(rows, "id long, label int, vec array<double>")
    got = {r.id: r for r in near_duplicates(df, 0.98, cell_rows=cell_rows, block_rows=16).collect()}
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    links = [(a, b) for a, b in itertools.combinations(range(len(x)), 2) if label[a] is not None and label[a] == label[b] and unit[a] @ unit[b] >= 0.98]
    links += [(905, 906), (907, 908)]
    ids = [r[0] for r in rows]
    want, count = least_ids(ids, links), collections.Counter(itertools.chain.from_iterable(links))
    assert {i: got[i].component for i in ids} == want
    assert {i: got[i].n_links for i in ids} == {i: count[i] for i in ids}
    assert all(got[i].kept == (want[i] == i) for i in ids) and len(got) == len(ids)


@pytest.mark.parametrize("cell_rows", [4, 1000])
def test_embedding_links_of_repeated_ids(spark, cell_rows):
    """Every row is a vector of its own, whatever its id, label or length."""
    rng = np.random.default_rng(9)
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [0.0, 1.0]), (2, 0, [1.0, 0.001]), (1, 1, [1.0, 0.0]), (3, 0, [1.0]), (1, 0, [1.0, 0.0]), (None, 0, [0.0, 1.0])]
    rows += [(int(rng.integers(10, 30)), 0, [float(v) for v in rng.normal(size=3)]) for _ in range(120)]
    df = spark.createDataFrame(rows, "id long, label int, vec array<double>").withColumn("rep", F.lit(1)).withColumn("w", F.lit("x"))
    got = near_duplicates(df, 0.98, cell_rows=cell_rows, block_rows=8).collect()
    live = [r for r in rows if r[0] is not None]
    linked = lambda a, b: a[1] == b[1] and len(a[2]) == len(b[2]) and np.dot(a[2], b[2]) / np.linalg.norm(a[2]) / np.linalg.norm(b[2]) >= 0.98
    links = [(a, b) for a, b in itertools.combinations(range(len(live)), 2) if linked(live[a], live[b])]
    parts = collections.defaultdict(list)
    for n, c in least_ids(range(len(live)), links).items():
        parts[c].append(n)
    component = {n: min(live[m][0] for m in group) for group in parts.values() for n in group}
    count = collections.Counter(itertools.chain.from_iterable(links))
    want = sorted((r[0], count[n], component[n], component[n] == r[0]) for n, r in enumerate(live))
    assert sorted((r.id, r.n_links, r.component, r.kept) for r in got if r.id is not None) == want
    assert len(got) == len(rows)
    assert near_duplicates(df.where("false"), 0.98).collect() == []


def sets_of(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({65 + i: 97 + i for i in range(26)}))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


@pytest.mark.parametrize(("width", "num"), [(3, 90), (5, 80)])
def test_jaccard_join(spark, width, num):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for size in (2, 8, 30, 60, 200):
        for _ in range(6):
            base = list(rng.choice(words, size))
            texts.append(" ".join(base))
            for _ in range(6):
                copy = list(base)
                for _ in range(rng.integers(0, max(2, size // 20))):
                    copy[rng.integers(size)] = str(rng.choice(words))
                texts.append("\n".join(copy).title())
    line = "all rights reserved by the owners of this common line "
    texts += [line + f"x{i}" for i in range(20)] + [line] * 10 + [None, "", " \t\n", "Wörd", "WöRD"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("rep", __import__("pyspark").sql.functions.lit(1))
    got = {r.doc_id: r for r in jaccard_classes(docs, width, num, 100).collect()}
    sets = [sets_of(t, width) for t in texts]
    links = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    want = least_ids(range(len(texts)), links)
    assert {i: (got[i].n_shingles, got[i].component) for i in want} == {i: (len(sets[i]), want[i]) for i in want}
    kept = sorted(r.doc_id for r in keep_one(docs, width, num).collect())
    assert kept == sorted(set(want.values()))


def test_jaccard_empty_nulls_and_repeated_rows(spark):
    kind = "doc_id long, text string"
    assert jaccard_classes(spark.createDataFrame([], kind)).count() == 0
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "z"), (2, None)]
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component or 0) for r in jaccard_classes(spark.createDataFrame(rows, kind)).collect())
    assert got == [(0, 1, 0), (0, 1, 1), (1, 1, 1), (1, 1, 1), (2, 0, 2)]
    assert keep_one(spark.createDataFrame(rows, kind)).count() == 4  # one of id 1, both without an id, and 2


def test_components_of_chain_and_hub(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 160))


def test_overlapping_families_and_a_common_line(spark):
    """50 families of near copies over shared passages, a line that all share, one large family with members far from most others."""
    rng = np.random.default_rng(8)
    vocabulary = [f"v{i}" for i in range(5000)]
    draw = lambda n: rng.choice(vocabulary, n).tolist()
    line, passages, rows = draw(12), [draw(60) for _ in range(10)], []
    for f in range(50):
        base = draw(40) + passages[f % 10] + draw(40) + line
        for _ in range(40 if f == 0 else 6):
            words = list(base)
            for at in rng.integers(0, len(words), int(rng.integers(0, 7))):
                words[at] = str(rng.choice(vocabulary))
            rows.append((len(rows) * 3 % 10007, " ".join(words)))
    want = {}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    want = {i: top(i) for i in ids}
    got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 5, 80, 100).collect()
    assert {r.doc_id: r.component for r in got} == want and len(set(want.values())) < len(want)


def test_postings_are_shuffled_once(spark):
    """Joined with the counts of their tokens, all postings were shuffled twice where the counts are too many to broadcast."""
    rows = [(t, r, 3, 1) for r in range(40) for t in (r, 1000 + r // 2, -7)] + [(2000, 9, 3, 1)]
    df = spark.createDataFrame(rows, "token long, rep long, n long, match int")
    mode = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = shared_postings(df)
        got, plan = sorted(map(tuple, found.collect())), found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", mode)
    assert got == sorted(r for r in rows if r[0] >= 1000 and r[0] < 2000 or r[0] == -7)
    assert len(re.findall(r"Exchange hashpartitioning", plan.split("Initial Plan")[0])) == 1


def test_postings_need_a_partner_of_like_size(spark):
    """Lists of accidental partners were kept whole, with all rows of sizes that no partner comes near."""
    df = spark.createDataFrame([(1, 1, 100, 1), (1, 2, 90, 1), (1, 3, 80, 1), (1, 4, 9, 1), (2, 5, 50, 1), (2, 6, 50, 1), (3, 7, 10, 1), (3, 8, 20, 1)], "token long, rep long, n long, match int")
    assert sorted(r.rep for r in shared_postings(df, 90, 100).collect()) == [1, 2, 5, 6]
    assert sorted(r.rep for r in shared_postings(df, 80, 100).collect()) == [1, 2, 3, 5, 6]
    assert shared_postings(df).count() == 8


def test_settled_pivots_leave_their_lists(spark, monkeypatch):
    """A list of two was carried on, and joined again, in each round after its one pair had been compared."""
    from tidemark.llm import jaccard

    sizes, kept = [], jaccard.stash

    def watched(df, name, keep=False):
        out = kept(df, name, keep)
        if name == "members":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stash", watched)
    # pairs that share half of their words, and a chain of four in which each is like the next
    texts = [" ".join([*(f"p{i // 2}x{k}" for k in range(20)), *(f"o{i}x{k}" for k in range(20))]) for i in range(200)]
    texts += [" ".join(f"c{k}" for k in range(6 * i, 60 + 6 * i)) for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component for r in jaccard_classes(docs, 3, 80, 100).collect()}
    assert found == {i: min(i, 200) for i in range(204)}
    assert sizes and max(sizes) == 0


def test_jaccard_join_leaves_no_shuffle_files_and_feeds_small_batches(spark, monkeypatch):
    """The shuffle files of all rounds lay on disk together, and workers got 10 000 whole texts at a time."""
    import time

    from tidemark.llm import jaccard

    most, kept = spark.sparkContext.accumulator(0), jaccard._whole_sets

    def watched(bits, width):
        work = kept(bits, width)

        def sets(batches):
            def seen():
                for b in batches:
                    most.add(int(len(b) > 1024))
                    yield b

            yield from work(seen())

        return sets

    monkeypatch.setattr(jaccard, "_whole_sets", watched)
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles())}
    keys = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"]
    texts = [" ".join(f"w{(i // 2) * 31 + k}" for k in range(30)) + f" end{i}" for i in range(6000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    before, modes = files(), [spark.conf.get(k) for k in keys]
    assert {r.doc_id: r.component for r in jaccard_classes(docs, 3, 90, 100).collect()} == {i: i // 2 * 2 for i in range(6000)}
    left = lambda: [f for f in files() - before if f.startswith("shuffle_")]
    for _ in range(50):
        if not left():
            break
        time.sleep(0.1)
    assert not left() and not most.value and [spark.conf.get(k) for k in keys] == modes
