"""Toxicity network: held-out accuracy, whole texts, defined results."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm.toxicity import WordNet, _parts, _pooled, best_cut, sample, toxicity, word_rows

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, toxic int"


def corpus(n=1500, seed=2):
    rnd = random.Random(seed)
    plain = {"en": [f"word{i}" for i in range(400)], "xx": [f"mot{i}é" for i in range(400)]}
    bad = {"en": ["scum", "idiot", "moron"], "xx": ["lowei", "vequ"]}
    docs, labels = [], []
    for i in range(n):
        lang, toxic = rnd.choice(["en", "xx"]), int(rnd.random() < 0.25)
        words = rnd.choices(plain[lang], k=rnd.randint(5, 120))
        for _ in range(rnd.randint(1, 3) * toxic):
            words.insert(rnd.randint(0, len(words)), rnd.choice(bad[lang]) + (f"{rnd.choice('abcdef')}{rnd.choice('uvwxyz')}" if lang == "xx" else ""))
        docs.append((i, " ".join(words).capitalize() + ".", lang))
        if rnd.random() < 0.8:
            labels.append((i, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    long = " ".join(["word1"] * 150_000)
    extra = [(9000, None, "en"), (9001, "", None), (9002, " .,!", "en"), (None, "some idiot", None), (9003, long, "en"), (9004, long + " scum", "en"), (1, docs[1][1], "xx")]
    marked = [*labels, (9001, None), (None, 1), labels[0]]
    df = spark.createDataFrame(docs + extra, DOCS).withColumns({"toxic": F.lit("x"), "hash_": F.lit(1), "score": F.lit(2.0), "id_": F.lit(3)})
    return docs, dict(labels), toxicity(df, spark.createDataFrame(marked, LABELS).withColumn("quality", F.lit(1))).collect()


def test_held_out_accuracy(scored):
    docs, labels, got = scored
    assert len(got) == len(docs) + 7
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    mine = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p for p, y in mine if y]) > 0.9 and np.mean([p for p, y in mine if not y]) < 0.05


def test_whole_texts_count_and_empty_ones_have_a_score(scored):
    by = {r.doc_id: r for r in scored[2]}
    assert by[9003].predicted == 0 and by[9004].predicted == 1  # the last of 150 000 words
    assert by[9000].score == by[9001].score == by[9002].score
    assert by[None].predicted == 1 and not by[None].held_out


def test_parts_of_long_texts_give_the_same_maxima():
    net = WordNet(["a"])
    text = " ".join(f"w{i % 997}é-{i}" for i in range(90_000)) + " " + "long" * 200_000 + " end"
    buf = np.frombuffer(text.encode(), np.uint8)
    assert np.array_equal(np.concatenate(list(_parts(buf))), buf) and len(list(_parts(buf))) > 3
    rows, doc = word_rows(buf, np.array([0, len(buf)]))
    assert np.allclose(_pooled(net, pa.array([text, "short one"]))[0], net.pooled(rows, doc, 1)[0], atol=1e-5)


def test_inflected_forms_share_rows():
    rows = lambda t: word_rows(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]
    a, b = rows("Loweischaft"), rows("lowei")
    assert a[0, 0] != b[0, 0] and (a[0, 1:] == b[0, 1:]).all()
    assert (rows("chóna")[0, 1] == rows("chónb")[0, 1]) and len(rows("don't x_y")) == 4


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    net = WordNet(["a", "b"])
    for name in ("table", "out", "out_bias", "lang", "lang_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.kernels, net.bias = [k.astype(np.float64) for k in net.kernels], [b.astype(np.float64) + 0.1 for b in net.bias]
    texts = [rng.integers(0, 50, (n, 3)).astype(np.uint16) for n in (5, 1, 9)]
    toxic, lang, weight = np.array([1, 0, 1]), np.array([0, 1, -1]), np.array([1.0, 0.5, 2.0])

    def loss():
        doc = np.repeat(np.arange(3), [len(t) for t in texts])
        f = np.maximum(net.pooled(np.concatenate(texts), doc, 3), 0).astype(np.float64)
        z, q = (f @ net.out + net.out_bias)[:, 0], f @ net.lang + net.lang_bias
        q = q - np.log(np.exp(q).sum(1, keepdims=True))
        return (weight * (np.log1p(np.exp(z)) - toxic * z)).sum() / 3 - 0.3 * (q[0, 0] + q[1, 1]) / 3

    grads, rows, moves = net._gradient(texts, toxic, lang, weight)
    for p, g in zip([*net.kernels, *net.bias, net.out, net.out_bias, net.lang, net.lang_bias], grads, strict=True):
        at = tuple(rng.integers(0, n) for n in p.shape)
        kept, step = p[at], 1e-3
        p[at] = kept + step
        up = loss()
        p[at] = kept - step
        down = loss()
        p[at] = kept
        assert (up - down) / (2 * step) == pytest.approx(g[at], abs=2e-3)
    full = np.zeros_like(net.table)
    np.add.at(full, rows, moves)
    near = 0
    for r in np.unique(np.concatenate(texts))[:40].astype(int):  # a step may move a maximum to another word, here and there
        kept, step = net.table[r, 3], 1e-4
        net.table[r, 3] = kept + step
        up = loss()
        net.table[r, 3] = kept - step
        near += abs((up - loss()) / (2 * step) - full[r, 3]) < 3e-3
        net.table[r, 3] = kept
    assert near >= 0.9 * len(np.unique(np.concatenate(texts))[:40])


def test_cut_lies_in_the_gap():
    assert best_cut(np.array([0.0, 1.0, 5.0, 6.0]), np.array([0, 0, 1, 1])) == 3.0
    assert best_cut(np.array([1.0]), np.array([1])) == 0.0


def test_no_labels_one_class_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(20)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity(docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], LABELS)
    assert {(r.score, r.predicted) for r in toxicity(docs, ones).collect()} == {(1.0, 1)}
    assert toxicity(spark.createDataFrame([], DOCS), ones).collect() == []


def test_sample_is_bounded_and_keeps_small_classes(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", (F.col("doc_id") % 40 == 0).cast("int").alias("toxic"))
    got = sample(docs.union(docs), labels.union(labels), rows=300).groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in got}
    assert n[1] == 100 and abs(n[0] - 600) < 120


def test_all_labelled_rows_train(spark, monkeypatch):
    """No bound on the rows: every labelled one is in some shard, whole, and moves the weights; repeated rows count once."""
    from tidemark.llm import toxicity as module

    monkeypatch.setattr(module, "SHARD_ROWS", 3000)
    docs = spark.range(14000).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("word "), 600), F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", (F.col("doc_id") % 40 == 0).cast("int").alias("toxic"))
    got = module.shards_of(docs.union(docs.limit(50)), labels.union(labels)).selectExpr("ids", "toxic", "transform(rows, r -> octet_length(r)) AS size").collect()
    assert len(got) == 5 and sorted(i for r in got for i in r["ids"]) == list(range(14000))
    assert {n for r in got for n in r["size"]} == {602 * 6} and sum(sum(r["toxic"]) for r in got) == 350


def test_cut_of_counted_cases():
    z, y, n = np.array([0, 1, 1, 2.0]), np.array([0, 0, 1, 1]), np.array([5.0, 1, 4, 6])
    assert best_cut(z, y, n) == best_cut(np.repeat(z, n.astype(int)), np.repeat(y, n.astype(int))) == 0.5


def test_training_leaves_no_shuffle_files(spark):
    """Each round's weights are shuffled once per shard; they went with the JVM's garbage only, so all rounds lay on disk."""
    import time

    from tidemark.llm.toxicity import train

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles())}
    docs, labels = corpus(200)
    df, marked, before, mode = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), files(), spark.conf.get(key)
    net, _ = train(df, marked)
    left = lambda: [f for f in files() - before if f.startswith("shuffle_")]
    for _ in range(50):
        if not left():
            break
        time.sleep(0.1)
    assert net is not None and not left() and spark.conf.get(key) == mode
