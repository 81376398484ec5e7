"""Language identification by a byte convolutional network, trained here in numpy.

Network: a window of ``WINDOW`` lower-cased (A-Z) bytes; ``FILTERS`` convolution
filters for each of several widths straight over the bytes (a weight per
offset and byte value); rectifier; maximum over the window; softmax over the languages.
Training runs on a bounded sample of labelled rows: at most ``ROWS_PER_LANG`` per
language and ``MAX_ROWS`` in all (those of least id hash), three snippets of each. So that each has ten rows to
learn from, at most ``MAX_ROWS // 10`` languages are learned, those with the most sampled rows.
Prediction covers the whole text: consecutive fixed-length windows, whose logits are averaged
by length.

Defined results: ``und`` with score 0 for a null text, a text without letters, or when there is no labelled row. Repeated
rows are each predicted; extra columns are ignored; the label, source and id are no inputs of a prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import lean, sf_table
from tidemark.llm.textkit import LOWER, slices

WINDOW, FILTERS, WIDTHS, SNIPPET = 192, 8, (2, 3, 4), 240
ROWS_PER_LANG, MAX_ROWS, EPOCHS, MIN_STEPS, BATCH = 1000, 12000, 5, 300, 128
SLICE_BITS = 10
KEEP_ROWS = 1024  # rows of a batch that are judged and copied at once


def windows(buf: np.ndarray, off: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts cut into rows of ``size`` bytes (0 behind the end), with document and length."""
    length = np.diff(off)
    count = -(-length // size)
    doc = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = off[doc] + nth * size
    used = np.minimum(size, off[doc + 1] - start)
    at = np.minimum(start[:, None] + np.arange(size), max(0, len(buf) - 1))
    rows = np.where(np.arange(size) < used[:, None], LOWER[buf[at]] if len(buf) else 0, 0).astype(np.uint8)
    return rows, doc, used


class ByteNet:
    """Weights of the network; ``fit`` trains, ``logits`` applies."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.weights = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)
        self.pairs = None

    def state(self) -> tuple:
        """Plain arrays, as broadcast to the workers."""
        return self.langs, self.weights, self.bias, self.out, self.out_bias

    @classmethod
    def of(cls, state: tuple) -> ByteNet:
        net = cls(state[0])
        net.langs, net.weights, net.bias, net.out, net.out_bias = state
        return net

    def parameters(self) -> list[np.ndarray]:
        return [*self.weights, *self.bias, self.out, self.out_bias]

    def fit(self, rows: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01) -> ByteNet:
        """Adam on the cross entropy; rows are shortened at random, as short texts come too."""
        rng = np.random.default_rng(11)
        params = self.parameters()
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(max(epochs, -(-MIN_STEPS * BATCH // len(rows)))):
            for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
                x = rows[part].copy()
                keep = np.where(rng.random(len(x)) < 0.5, x.shape[1], rng.integers(12, x.shape[1], len(x)))
                x[np.arange(x.shape[1]) >= keep[:, None]] = 0
                step += 1
                for p, g, m, v in zip(params, self._gradient(x, label[part]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, x: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        best, at = [], []
        for w, k, b in zip(WIDTHS, self.weights, self.bias, strict=True):
            span = x.shape[1] - w + 1
            z = sum(k[j][x[:, j : j + span]] for j in range(w)) + b
            z[x[:, :span] == 0] = -np.inf
            at.append(z.argmax(1))
            best.append(np.take_along_axis(z, at[-1][:, None], 1)[:, 0])
        raw = np.concatenate(best, 1)
        pooled = np.maximum(raw, 0)
        p = softmax(pooled @ self.out + self.out_bias)
        p[np.arange(len(x)), label] -= 1
        p /= len(x)
        back = (p @ self.out.T) * (raw > 0)
        grads, biases = [], []
        for i, (w, k) in enumerate(zip(WIDTHS, self.weights, strict=True)):
            g, own = np.zeros_like(k), back[:, i * FILTERS : (i + 1) * FILTERS]
            for j in range(w):
                np.add.at(g[j], (np.take_along_axis(x, at[i] + j, 1), np.arange(FILTERS)[None, :]), own)
            grads.append(g)
            biases.append(own.sum(0))
        return [*grads, *biases, pooled.T @ p, p.sum(0)]

    def logits(self, rows: np.ndarray) -> np.ndarray:
        """Logits of windows; sums over two offsets come from one table of byte pairs."""
        if self.pairs is None:
            self.pairs = [[(k[j][:, None] + k[j + 1][None]).reshape(-1, FILTERS) for j in range(0, len(k) - 1, 2)] for k in self.weights]
        out = np.empty((len(rows), self.out.shape[0]), np.float32)
        for a in range(0, len(rows), 1024):
            x = rows[a : a + 1024]
            pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
            for i, (w, k, tables) in enumerate(zip(WIDTHS, self.weights, self.pairs, strict=True)):
                span = x.shape[1] - w + 1
                z = tables[0].take(pair[:, :span], 0)
                for n, t in enumerate(tables[1:], 1):
                    z += t.take(pair[:, 2 * n : 2 * n + span], 0)
                if w % 2:
                    z += k[-1].take(x[:, w - 1 :], 0)
                empty = x[:, :span] == 0
                if empty.any():
                    z[empty] = -1e9
                out[a : a + 1024, i * FILTERS : (i + 1) * FILTERS] = np.maximum(z.max(1) + self.bias[i], 0)
        return out @ self.out + self.out_bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def has_letters(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    ascii_ = np.concatenate([[0], np.cumsum((LOWER[buf] >= 97) & (LOWER[buf] <= 122))])
    out = ascii_[off[1:]] > ascii_[off[:-1]]
    for i in np.flatnonzero(~out):  # rare: letters of other scripts only, or none
        out[i] = any(map(str.isalpha, buf[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace")))
    return out


def _least(hashes: DataFrame, per: int) -> DataFrame:
    """Of (lang, hash_) the rows that can be among the ``per`` least hashes of their language.

    Rows are counted per language and slice of the hash range, and only the slices up to the one in which the count
    reaches ``per`` stay; a second round does so with finer slices. So no task orders a whole language, but at most
    ``per`` rows and ``2 ** SLICE_BITS`` slices of it. Equal hashes (rows of one id) count ``per`` times at most.
    """
    some = hashes.groupBy("lang", "hash_").agg(F.count("*").alias("times"))
    before = F.expr("sum(n) OVER (PARTITION BY lang ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    for bits in (SLICE_BITS, 2 * SLICE_BITS):
        some = some.withColumn("slice", F.shiftright("hash_", 64 - bits))
        sizes = some.groupBy("lang", "slice").agg(F.sum("times").alias("n"))
        wanted = sizes.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < per).select("lang", "slice")
        some = some.join(wanted, ["lang", "slice"]).drop("slice")
    return some.select("lang", F.explode(F.array_repeat("hash_", F.least("times", F.lit(per)).cast("int"))).alias("hash_"))


def train(labelled: DataFrame) -> ByteNet:
    """Fit on a bounded sample of (doc_id, text, lang), all non-null."""
    size = F.length("text")
    snippet = F.array(*(F.substring("text", F.greatest(F.lit(1), (size * part - SNIPPET / 2).cast("int")), F.lit(SNIPPET)) for part in (0.0, 0.5, 1.0)))
    # the rows of least id hash per language: first the hash limits, then the snippets below them
    marked = labelled.withColumn("hash_", F.xxhash64("doc_id"))
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY hash_)")
    # many languages have fewer rows each, so that a rare one keeps its place
    per = max(10, min(ROWS_PER_LANG, MAX_ROWS // max(1, labelled.select("lang").distinct().count())))
    cut = _least(marked.select("lang", "hash_"), per).withColumn("rank", rank).where(F.col("rank") <= per)
    cut = cut.groupBy("lang").agg(F.max("hash_").alias("top"), F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_ROWS // 10)
    cut = cut.withColumnRenamed("lang", "lang_")
    rows = marked.join(F.broadcast(cut), (F.col("lang") == F.col("lang_")) & (F.col("hash_") <= F.col("top")))
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= per)  # rows that repeat an id share its hash
    rows = rows.orderBy("hash_", "lang").select("lang", snippet.alias("snippets")).toArrow().to_pylist()
    langs = sorted({r["lang"] for r in rows})
    net = ByteNet(langs)
    if len(langs) > 1:
        pairs = [(t, langs.index(r["lang"])) for r in rows for t in dict.fromkeys(r["snippets"]) if t and any(map(str.isalpha, t))]
        raw = [t.encode()[:WINDOW] for t, _ in pairs]
        buf = np.frombuffer(b"".join(raw), np.uint8)
        x, _, _ = windows(buf, np.concatenate([[0], np.cumsum([len(b) for b in raw])]))
        net.fit(x, np.array([y for _, y in pairs]))
    return net


def _labels(net: ByteNet, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of every text of a batch."""
    langs, scores = [], []
    for first, end, buf, off in slices(column, 1 << 18):
        pred, score = np.full(end - first, "und", object), np.zeros(end - first)
        ok = has_letters(buf, off)
        if net.langs and ok.any():
            x, doc, used = windows(buf, off)
            z = net.logits(x) * used[:, None]
            total = np.stack([np.bincount(doc, z[:, c], end - first) for c in range(len(net.langs))], 1) / np.maximum(1, np.diff(off))[:, None]
            p = softmax(total)
            pred[ok], score[ok] = np.array(net.langs, object)[p.argmax(1)][ok], p.max(1)[ok]
        langs += pred.tolist()
        scores.append(score)
    return langs, np.concatenate(scores or [np.zeros(0)])


def _predict(state):
    def predict(batches):
        net = ByteNet.of(state.value)
        for batch in batches:
            langs, scores = _labels(net, batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return predict


def predict(net: ByteNet, docs: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(net.state())), "doc_id long, lang_pred string, score double")


def _keep(state, least: float):
    def keep(batches):
        net = ByteNet.of(state.value)
        for batch in batches:
            for part in (batch.slice(a, KEEP_ROWS) for a in range(0, len(batch), KEEP_ROWS)):
                langs, scores = _labels(net, part["text"])
                yield part.filter(pa.array((np.array(langs, object) != "und") & (scores >= least), pa.bool_()))

    return keep


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with a score of ``least`` or more.

    Without any labelled row nothing can be judged: texts are then kept as they are.
    """
    net = train(_training(docs))
    if not net.langs:
        return docs
    return docs.mapInArrow(lean(_keep(docs.sparkSession.sparkContext.broadcast(net.state()), least)), docs.schema)


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())


def held_out(doc_id: str = "doc_id", modulus: int = 5, remainder: int = 0):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def language_id(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): trained on the labelled rows of ``docs`` that are not held out."""
    net = train(_training(docs))
    return predict(net, docs).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_byte_cnn_langid(spark, sf_dir: str) -> DataFrame:
    return language_id(sf_table(spark, sf_dir, "documents"))
