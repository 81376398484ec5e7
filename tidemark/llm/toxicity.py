"""Toxicity by a convolutional text classifier over hashed word embeddings, trained here in numpy.

Network: a word (a run of letters, digits and all bytes above 0x7F; A-Z lower-cased) is the sum of three rows of one
hashed table - of the word and of its first four and five characters, so that inflected forms share a
row. ``FILTERS`` convolution filters for each of the widths 1 to 3 run over the words; the maximum over the whole text,
rectified, feeds two outputs: toxicity, and the language as the text shows it.

Training runs on all labelled rows and their whole texts, in shards (by id hash, of about ``SHARD_ROWS`` rows). In each
round every shard trains on from the common weights, through all its rows once; the weights are then averaged by rows.
There are as many rounds as give ``MIN_STEPS`` steps, ``LEAST_ROUNDS`` at least. A fifth of the rows (by another hash) is kept from the fit and
calibrates the thresholds: per language the cut that separates the classes best (logits of all these rows, counted in bins of
1/``BINS``) becomes the score 0.5. Languages with fewer than ``LEAST_CASES`` rows of either class there use the
common threshold (as do languages beyond the ``MAX_LANGS`` most frequent, read as one of these). At scoring the language is the network's own; columns other than the text are no inputs.
Scoring covers whole texts: long ones are read part by part, with the last two words carried over.

Defined results: null and empty texts, and texts without words, are scored by the network's bias. Without
labels of both classes every score is the share of label 1 (0 without any). Several labels of one
document count as 1 if any is 1; null labels are none. Repeated rows are each scored, extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.langid import held_out
from tidemark.llm.shared import brief_shuffles, scratch, sf_table, stash
from tidemark.llm.textkit import mix, prefix_hash, slices, span_hash, words

BUCKETS, DIM, FILTERS, WIDTHS, PREFIXES = 1 << 16, 16, 8, (1, 2, 3), (4, 5)
ROWS, WINDOW, MAX_LANGS, LEAST_CASES = 3000, 512, 64, 20
MIN_STEPS, LEAST_ROUNDS, BATCH, PART, DROP = 400, 2, 32, 1 << 18, 0.3
SHARD_ROWS, SHARD_BYTES, LONG, BINS, RANGES = 3000, 24 << 20, 1 << 16, 256, 16

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[48:58], _FOLD[97:123], _FOLD[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_FOLD[65:91] = np.arange(97, 123)
_KINDS = mix(np.arange(1, 2 + len(PREFIXES), dtype=np.uint64))


def word_rows(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding table of all words (one column per kind), and the words' document numbers."""
    buf = _FOLD[buf]
    start, end, doc = words(buf, off)
    if not len(start):
        return np.zeros((0, len(_KINDS)), np.uint16), doc
    prefix, head = prefix_hash(buf), (buf & 0xC0) != 0x80
    chars, before = np.append(np.flatnonzero(head), len(buf)), np.concatenate([[0], np.cumsum(head)])
    ends = [end, *(np.minimum(end, chars[np.minimum(before[start] + k, len(chars) - 1)]) for k in PREFIXES)]
    return np.stack([mix(span_hash(prefix, start, e) ^ kind) % np.uint64(BUCKETS) for e, kind in zip(ends, _KINDS, strict=True)], 1).astype(np.uint16), doc


class WordNet:
    """Weights of the network; ``fit`` trains, ``pooled`` and ``logits`` apply."""

    def __init__(self, langs: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.langs, features = langs, FILTERS * len(WIDTHS)
        self.table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        # per width its offsets side by side: (DIM, width * FILTERS)
        self.kernels = [rng.normal(0, 0.4, (DIM, w * FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out, self.out_bias = rng.normal(0, 0.3, (features, 1)).astype(np.float32), np.zeros(1, np.float32)
        self.lang, self.lang_bias = rng.normal(0, 0.3, (features, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
        self.seen = np.full(BUCKETS, 1e-3, np.float32)  # squared steps of each table row
        self.moments = tuple([np.zeros_like(p) for p in self.dense()] for _ in range(2))
        self.cuts = np.zeros(len(langs) + 1, np.float32)  # threshold on the logit per language, the common one last

    def state(self) -> dict:
        """Plain arrays, as broadcast to the workers."""
        return {k: v for k, v in vars(self).items() if k not in ("seen", "moments")}

    @classmethod
    def of(cls, state: dict) -> WordNet:
        net = cls.__new__(cls)
        vars(net).update(state)
        return net

    def convolve(self, rows: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Word vectors with two zero vectors behind each document, the words' places there, filter outputs per width at the words."""
        gap = max(WIDTHS) - 1
        at = np.arange(len(rows)) + gap * doc
        x = np.zeros((int(at[-1]) + 1 + gap, DIM), np.float32)
        x[at] = self.table[rows].sum(1)
        out = []
        for w, kernel, bias in zip(WIDTHS, self.kernels, self.bias, strict=True):
            y = x @ kernel
            out.append(sum(y[at + j, j * FILTERS : (j + 1) * FILTERS] for j in range(w)) + bias)
        return x, at, out

    def pooled(self, rows: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Largest output of each filter per document; minus infinity for documents without words."""
        best = np.full((n, FILTERS * len(WIDTHS)), -np.inf, np.float32)
        if len(rows):
            have, first = np.unique(doc, return_index=True)
            best[have] = np.maximum.reduceat(np.concatenate(self.convolve(rows, doc)[2], 1), first)
        return best

    def logits(self, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit of toxicity, and language numbers (the common one without words), from ``pooled``."""
        empty = np.isneginf(best).all(1)
        features = np.maximum(best, 0)
        lang = (features @ self.lang + self.lang_bias).argmax(1) if self.langs else np.zeros(len(best), np.int64)
        return (features @ self.out + self.out_bias)[:, 0], np.where(empty | (len(self.langs) == 0), len(self.langs), lang)

    def scores(self, best: np.ndarray) -> np.ndarray:
        z, lang = self.logits(best)
        return 1 / (1 + np.exp(-np.clip((z - self.cuts[lang]).astype(np.float64), -500, 500)))

    def fit(self, texts: list[np.ndarray], toxic: np.ndarray, lang: np.ndarray, weight: np.ndarray, first_step: int = 0, rate: float = 0.01, seed: int = 17) -> WordNet:
        """One pass of Adam on both cross entropies (a language of -1 counts nothing); table rows are stepped only where touched.

        A share of ``DROP`` of the words is left out at random each time, so that no one word carries a text; the steps of table
        rows start small, so that words of many texts outrun those of one.
        """
        rng = np.random.default_rng(seed)
        dense = self.dense()
        first, second = self.moments
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
            first_step += 1
            left = [self.nearest(texts[i]) for i in part]
            left = [t[rng.random(len(t)) >= DROP] for t in left]
            left = [t if len(t) else texts[i][:LONG] for i, t in zip(part, left, strict=True)]
            grads, rows, moves = self._gradient(left, toxic[part], lang[part], weight[part].astype(np.float32))
            for p, g, m, v in zip(dense, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**first_step)) / (np.sqrt(v / (1 - 0.999**first_step)) + 1e-8)
            unique, place = np.unique(rows, return_inverse=True)
            total = np.zeros((len(unique), DIM), np.float32)
            np.add.at(total, place, moves)
            self.seen[unique] += (total * total).mean(1)
            self.table[unique] -= 0.05 * total / np.sqrt(self.seen[unique])[:, None]
        return self

    def nearest(self, rows: np.ndarray) -> np.ndarray:
        """A text, or the parts of a very long one that hold the maximum of some filter: the others have no gradient."""
        if len(rows) <= LONG:
            return rows
        step, over = LONG // 8, max(WIDTHS) - 1
        parts = [rows[a : a + step + over] for a in range(0, len(rows), step)]
        best = np.concatenate([self.pooled(p, np.zeros(len(p), np.int64), 1) for p in parts]).argmax(0)
        return np.concatenate([parts[i] for i in np.unique(best)])

    def dense(self) -> list[np.ndarray]:
        return [*self.kernels, *self.bias, self.out, self.out_bias, self.lang, self.lang_bias]

    def flat(self) -> np.ndarray:
        """All that training changes, as one vector."""
        return np.concatenate([x.ravel() for x in (self.table, self.seen, *self.dense(), *self.moments[0], *self.moments[1])])

    def load(self, flat: np.ndarray) -> WordNet:
        at = 0
        for x in (self.table, self.seen, *self.dense(), *self.moments[0], *self.moments[1]):
            x[...] = flat[at : at + x.size].reshape(x.shape)
            at += x.size
        return self

    def _gradient(self, texts: list[np.ndarray], toxic: np.ndarray, lang: np.ndarray, weight: np.ndarray):
        """Gradients of the dense weights, and table rows with theirs."""
        size = np.array([len(t) for t in texts])
        rows, doc = np.concatenate(texts), np.repeat(np.arange(len(texts)), size)
        x, at, outs = self.convolve(rows, doc)
        limit = np.concatenate([[0], np.cumsum(size)])
        raw = np.concatenate(outs, 1)
        best = np.stack([raw[a:b].argmax(0) + a for a, b in zip(limit[:-1], limit[1:], strict=True)])
        top = np.take_along_axis(raw, best, 0)
        features = np.maximum(top, 0)
        z = (features @ self.out + self.out_bias)[:, 0]
        dz = ((1 / (1 + np.exp(-np.clip(z, -60, 60))) - toxic) * weight / len(texts)).astype(np.float32)[:, None]
        back = dz @ self.out.T
        dl = np.zeros((len(texts), len(self.langs)), np.float32)
        if self.langs:
            dl = features @ self.lang + self.lang_bias
            dl = np.exp(dl - dl.max(1, keepdims=True))
            dl /= dl.sum(1, keepdims=True)
            dl[np.arange(len(texts)), np.maximum(lang, 0)] -= 1
            dl *= 0.3 * (lang >= 0)[:, None] / len(texts)
            back = back + dl @ self.lang.T
        back = back * (top > 0)
        own = np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
        place = np.full(len(x) + 1, len(rows))  # back from places to words; gaps belong to none
        place[at] = np.arange(len(rows))
        kernels, biases, touched, moves = [], [], [], []
        for i, (w, kernel) in enumerate(zip(WIDTHS, self.kernels, strict=True)):
            g, p = back[:, i * FILTERS : (i + 1) * FILTERS], at[best[:, i * FILTERS : (i + 1) * FILTERS]]
            grad = np.zeros_like(kernel)
            for j in range(w):
                cut = slice(j * FILTERS, (j + 1) * FILTERS)
                grad[:, cut] = np.einsum("nfd,nf->df", x[p + j], g)
                word = place[p + j]
                real = (word < len(rows)) & (g != 0)
                moves.append(np.repeat(np.broadcast_to(kernel[:, cut].T[None], (*g.shape, DIM))[real] * g[real][:, None], rows.shape[1], 0))
                touched.append(own[word[real]].ravel())
            kernels.append(grad)
            biases.append(g.sum(0))
        return [*kernels, *biases, features.T @ dz, dz.sum(0), features.T @ dl, dl.sum(0)], np.concatenate(touched), np.concatenate(moves)

    def calibrate(self, z: np.ndarray, lang: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> WordNet:
        """Set the thresholds from logits, shown languages, classes and times: the common one, and one per language where both classes have cases enough."""
        self.cuts[:] = best_cut(z, toxic, n)
        for k in range(len(self.langs)):
            of = lang == k
            if min(n[of & (toxic == 1)].sum(), n[of & (toxic == 0)].sum()) >= LEAST_CASES:
                self.cuts[k] = best_cut(z[of], toxic[of], n[of])
        return self


def best_cut(z: np.ndarray, toxic: np.ndarray, n: np.ndarray | None = None) -> float:
    """The cut with the largest share right of both classes together; of a gap between cases its middle. Case i counts ``n[i]`` times."""
    if toxic.min(initial=1) == toxic.max(initial=0) or not len(z):
        return 0.0
    n = np.ones(len(z)) if n is None else n
    order = np.argsort(z, kind="stable")
    z, y, n = z[order], toxic[order], n[order]
    right = np.concatenate([[0], np.cumsum(n * (y == 0))]) / n[y == 0].sum() + 1 - np.concatenate([[0], np.cumsum(n * (y == 1))]) / n[y == 1].sum()
    right[1:-1][z[1:] == z[:-1]] = -1  # no cut between equal logits
    edges = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    width = np.concatenate([[0], z[1:] - z[:-1], [0]])
    good = np.flatnonzero(right >= right.max() - 1e-12)
    return float(edges[good[width[good].argmax()]])


def _parts(buf: np.ndarray, size: int = PART) -> Iterator[np.ndarray]:
    """One text in parts of about ``size`` bytes that end at word ends."""
    at = 0
    while at < len(buf):
        end = min(len(buf), at + size)
        if end < len(buf):
            for a in range(end, len(buf), size):  # the next byte that separates words
                gap = np.flatnonzero(_FOLD[buf[a : a + size]] == 0x20)
                if len(gap):
                    end = a + int(gap[0])
                    break
            else:
                end = len(buf)
        yield buf[at:end]
        at = end


def _pooled(net: WordNet, column: pa.Array) -> np.ndarray:
    """``pooled`` of every text of a column, in bounded memory."""
    out = []
    for first, end, buf, off in slices(column, PART):
        if end - first > 1 or len(buf) <= 2 * PART:
            out.append(net.pooled(*word_rows(buf, off), end - first))
            continue
        best, tail = np.full((1, FILTERS * len(WIDTHS)), -np.inf, np.float32), np.zeros((0, len(_KINDS)), np.uint16)
        for part in _parts(buf):
            rows = np.concatenate([tail, word_rows(part, np.array([0, len(part)]))[0]])
            best = np.maximum(best, net.pooled(rows, np.zeros(len(rows), np.int64), 1))
            tail = rows[-(max(WIDTHS) - 1) :]
        out.append(best)
    return np.concatenate(out or [np.zeros((0, FILTERS * len(WIDTHS)), np.float32)])


def _packed(batches):
    for batch in batches:
        packed = []
        for text in batch["text"]:
            buf = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            packed.append(b"".join(word_rows(part, np.array([0, len(part)]))[0].tobytes() for part in _parts(buf)))
        yield pa.RecordBatch.from_arrays([batch["id_"], batch["toxic"], batch["lang"], pa.array(packed, pa.binary())], names=["id_", "toxic", "lang", "rows"])


def _marked(labels: DataFrame) -> DataFrame:
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id_"))
    return marked.agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def _texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(id_, toxic, lang, rows): one text per id of ``chosen`` (id_, toxic), as rows of the embedding table."""
    found = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("id_"), "text", "lang").join(chosen, "id_")
    one = found.groupBy("id_", "toxic").agg(F.min(F.struct("text", "lang")).alias("doc"))
    return one.select("id_", "toxic", "doc.lang", "doc.text").mapInArrow(_packed, "id_ long, toxic int, lang string, rows binary")


def sample(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """A part of the training rows, for a look at them: about ``rows`` at most of the toxic, twice as many of the rest. Training doesn't use it."""
    marked = _marked(labels).withColumn("hash_", F.xxhash64("id_"))
    n = dict(marked.groupBy("toxic").count().collect())
    # the ids of least hash: as large a part of the hash range as the wanted part of the class
    share = {c: min(1.0, rows * (2 - c) / max(1, n.get(c, 0))) for c in (0, 1)}
    top = {c: min(2**63 - 1, int(-(2**63) + share[c] * 2**64)) for c in (0, 1)}
    chosen = marked.where(F.col("hash_") <= F.when(F.col("toxic") == 1, F.lit(top[1])).otherwise(F.lit(top[0])))
    return _texts(docs, chosen.select("id_", "toxic"))


SHARD_SQL = "shard long, ids array<bigint>, toxic array<int>, langs array<string>, rows array<binary>"


def _shard(docs: pa.Table, marked: pa.Table) -> pa.Table:
    """The labelled texts of a shard with their words as table rows, one text per id (the least), by id; one row, or none."""
    label = dict(zip(marked["id_"].to_pylist(), marked["toxic"].to_pylist(), strict=True))
    mine = docs.filter(pc.and_(pc.is_in(docs["id_"], value_set=marked["id_"].combine_chunks()), pc.is_valid(docs["text"]))) if label and len(docs) else docs.slice(0, 0)
    least: dict[int, tuple] = {}
    for i, text, lang in zip(mine["id_"].to_pylist(), mine["text"].to_pylist(), mine["lang"].to_pylist(), strict=True):
        case = (text.encode(), lang is not None, (lang or "").encode(), lang)
        if i not in least or case[:3] < least[i][:3]:
            least[i] = case
    ids = sorted(least)
    rows = [b"".join(word_rows(part, np.array([0, len(part)]))[0].tobytes() for part in _parts(np.frombuffer(least[i][0], np.uint8))) for i in ids]
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.binary()))
    row = ((docs if len(docs) else marked)["shard"][0].as_py(), ids, [label[i] for i in ids], [least[i][3] for i in ids], rows)
    return pa.table([pa.array([x] if ids else [], t) for x, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in SHARD_SQL.split(", ")])


def _kept(ids: np.ndarray) -> np.ndarray:
    """The rows that are kept from the fit, to calibrate."""
    return mix(ids.astype(np.int64).view(np.uint64) ^ np.uint64(0x6B657074)) % np.uint64(5) == 0


def _cases(batches, langs: list[str]):
    """Per shard of a task: its number, texts, classes, language numbers, and which are kept; without texts that have no words."""
    number = {x: i for i, x in enumerate(langs)}
    for batch in batches:
        for shard, ids, toxic, named, rows in zip(*(batch[c] for c in ("shard", "ids", "toxic", "langs", "rows")), strict=True):
            texts = [np.frombuffer(r.as_buffer(), np.uint16).reshape(-1, len(_KINDS)) for r in rows.values]
            full = np.array([len(t) > 0 for t in texts], bool)
            lang = np.array([number.get(x, -1) for x in named.as_py()])
            yield shard.as_py(), [t for t in texts if len(t)], np.array(toxic.as_py())[full], lang[full], _kept(np.array(ids.as_py()))[full]


def _numbers(batches):
    """(kept, toxic, full, lang): how many."""
    for batch in batches:
        for ids, toxic, named, rows in zip(*(batch[c] for c in ("ids", "toxic", "langs", "rows")), strict=True):
            full = [len(r.as_buffer()) > 0 for r in rows.values]
            cases = Counter(zip(_kept(np.array(ids.as_py())).tolist(), toxic.as_py(), full, named.as_py(), strict=True))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*cases, strict=True), (pa.bool_(), pa.int32(), pa.bool_(), pa.string()), strict=True)), pa.array(cases.values(), pa.int64())], names=["kept", "toxic", "full", "lang", "n"])


def _round(state, langs: list[str], number: int, weights: tuple[float, float], apart: bool):
    """One round: the weights after a pass through a shard's rows, with their number."""

    def run(batches):
        for shard, texts, toxic, lang, kept in _cases(batches, langs):
            of = np.flatnonzero(~kept) if apart else np.arange(len(texts))
            if not len(of):
                continue
            net = WordNet(langs).load(state.value)
            net.fit([texts[i] for i in of], toxic[of], lang[of], np.where(toxic[of] == 1, weights[1], weights[0]), number * max(1, len(of) // BATCH), seed=17 + number)
            for n, part in enumerate(np.array_split(net.flat(), RANGES)):
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([n], pa.int32()), pa.array([len(of)], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["shard", "part", "n", "weights"])

    return run


def _averaged(table: pa.Table) -> pa.Table:
    order = np.argsort(table["shard"].to_numpy())
    n, total = table["n"].to_numpy(), 0.0
    for i in order.tolist():
        total = total + np.frombuffer(table["weights"][i].as_py(), np.float32) * float(n[i])
    return pa.table([table["part"][:1].combine_chunks(), pa.array([(total / n.sum()).astype(np.float32).tobytes()], pa.binary())], names=["part", "weights"])


def _logits(state, langs: list[str], apart: bool):
    """Logits (in bins of 1/``BINS``), shown languages and classes of the kept texts, and how many."""

    def run(batches):
        net = WordNet.of(state.value)
        step, over = LONG, max(WIDTHS) - 1
        for _, texts, toxic, _, kept in _cases(batches, langs):
            of = np.flatnonzero(kept) if apart else np.arange(len(texts))
            cut = lambda t: [t[a : a + step + over] for a in range(0, len(t), step)]
            best = [np.maximum.reduce([net.pooled(c, np.zeros(len(c), np.int64), 1) for c in cut(texts[i])]) for i in of]
            if best:
                z, lang = net.logits(np.concatenate(best))
                cases, n = np.unique(np.stack([np.rint(np.clip(z, -100, 100) * BINS).astype(np.int64), lang, toxic[of]]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cases), pa.array(n)], names=["bin", "shown", "toxic", "n"])

    return run


def shards_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``SHARD_SQL``: all training rows, a row per shard; ``docs`` (doc_id, text, lang), ``labels`` (doc_id, toxic), both without held-out rows."""
    marked = _marked(labels)
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id_"), "text", "lang")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-marked.count() // SHARD_ROWS), -(-size // SHARD_BYTES))
    dealt = [df.withColumn("shard", F.pmod(F.xxhash64("id_"), F.lit(shards))).groupBy("shard") for df in (texts, marked)]
    return dealt[0].cogroup(dealt[1]).applyInArrow(_shard, SHARD_SQL)


def train(docs: DataFrame, labels: DataFrame) -> tuple[WordNet | None, float]:
    """The fitted and calibrated network, and the share of label 1; no network without both classes."""
    spark = docs.sparkSession
    with scratch(spark, "toxicity"), brief_shuffles(spark):
        table = stash(shards_of(docs, labels), "shards")
        numbers = table.mapInArrow(_numbers, "kept boolean, toxic int, full boolean, lang string, n long")
        n = {(r["kept"], r["toxic"], r["full"]): r["n"] for r in numbers.groupBy("kept", "toxic", "full").agg(F.sum("n").alias("n")).collect()}
        count = lambda kept=(True, False), toxic=(0, 1), full=(True,): sum(v for k, v in n.items() if k[0] in kept and k[1] in toxic and k[2] in full)
        share = count(toxic=(1,), full=(True, False)) / max(1, sum(n.values()))
        if not count(toxic=(0,)) or not count(toxic=(1,)):
            return None, share
        named = numbers.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
        langs = sorted(r["lang"] for r in named)
        apart = all(count((k,), (c,)) for k in (True, False) for c in (0, 1))
        of = (False,) if apart else (True, False)
        rows = count(of)
        weights = tuple(0.5 * rows / count(of, (c,)) for c in (0, 1))
        rounds = max(LEAST_ROUNDS, -(-MIN_STEPS * BATCH * table.count() // rows))
        net = WordNet(langs)
        for number in range(rounds):
            state = spark.sparkContext.broadcast(net.flat())
            passed = table.mapInArrow(_round(state, langs, number, weights, apart), "shard long, part int, n long, weights binary")
            got = passed.groupBy("part").applyInArrow(_averaged, "part int, weights binary").collect()  # RANGES rows
            net.load(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(got, key=lambda r: r["part"])]))
            state.destroy()
        state = spark.sparkContext.broadcast(net.state())
        bins = table.mapInArrow(_logits(state, langs, apart), "bin long, shown long, toxic long, n long").groupBy("bin", "shown", "toxic").agg(F.sum("n").alias("n"))
        bins = bins.toArrow()  # at most 200 * BINS values per language and class
        z, lang, toxic, times = (bins[c].to_numpy() for c in ("bin", "shown", "toxic", "n"))
        return net.calibrate(z / BINS, lang, toxic, times.astype(np.float64)), share


def _predict(state, share: float):
    def predict(batches):
        net = WordNet.of(state.value) if state is not None else None
        for batch in batches:
            score = net.scores(_pooled(net, batch["text"])) if net is not None else np.full(len(batch), share)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return predict


def predict(net: WordNet | None, share: float, docs: DataFrame) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id, text)."""
    state = docs.sparkSession.sparkContext.broadcast(net.state()) if net is not None else None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_predict(state, share), "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): trained on the labelled rows that are not held out."""
    net, share = train(docs.where(~held_out()), labels.where(~held_out()))
    return predict(net, share, docs).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op11_toxicity_cnn(spark, sf_dir: str) -> DataFrame:
    return toxicity(sf_table(spark, sf_dir, "documents"), sf_table(spark, sf_dir, "labels"))
