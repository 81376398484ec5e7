"""Language-model scoring by logistic context mixing of hashed bit predictors.

A text is read as its lower-cased (A-Z) words; every word is spelled in bytes and ended by a space, and
the text by a line feed in place of a next word. Bytes are coded as bits along a Huffman tree of
the training bytes, so frequent bytes take few bits.

*Classes.* Words before a word in its text pick one of ``CLASSES`` classes, such as languages: the
likeliest by their hashed slots (a mixture of multinomials, fitted by EM over all training texts, whole;
a few texts only seed it). The class is part of every context.

*Predictors.* For a byte inside a word: its last one, two, three and four bytes (in the
word), and its whole beginning, of every word. For the first byte of a word: class and a slot of
the previous word's hash, the class, and none. Each context and tree
node has a (hashed) slot with the counts of zeros and ones seen there.

*Mixing.* The stretched predictions (log odds) are added with weights, and squashed. A
gate picks the weight set by the number of predictors that know the context (for first bytes: by how often
the narrowest was seen) and by the depth in the tree. An adaptive map by last byte (class) and prediction refines
the result. Weights and map are learned online, word batch after word batch, and every
word occurrence is predicted by the counts of the others, so that known words teach how to weigh unknown ones.

*Jobs.* (0) Slot counts per training text are stored; each EM round sums the expected counts of all of
them per class, by Spark. (1) Words of the training texts are counted over all of them, in packed rows per
hash bucket. (2) Each task adds its words to fixed-size tables; these are summed by slot
range. (3) Each task trains the mixers on its words and first bytes; the parameters are averaged.
(4) All texts are scored; workers keep a bounded cache of word scores. Counts of rare
words reach the texts by a join of packed rows per bucket; those of the commonest are broadcast.

Base score: unigram words with add-one smoothing over the training tokens.

Defined results: a null or empty text is its end token alone. Repeated rows are each scored (and each learned). A null id is
not held out. Without training rows every count is 0. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import sys
import types
from itertools import count as counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import scratch, sf_table, stash
from tidemark.llm.textkit import LOWER, mix, prefix_hash, slices, span_hash, words

ORDERS, BITS = (1, 2, 3, 4), (16, 18, 20, 21, 21)
FREQUENT, SLOTS, BUCKET_BYTES, CACHE_WORDS = 1 << 16, 1 << 10, 16 << 20, 1 << 20
CLASSES, CLASS_SLOTS, STARTS, FIRST_ROUNDS, ROUNDS = 6, 512, 8, 3, 12
SPACE, END, DEPTHS, STEPS, GROUP_BITS = 0x20, 0x0A, 12, 33, 13
FIRST_LEVELS, FIRST_PASSES = 12, 4
CLASS_BITS = np.uint64(7)  # the low bits of a word's key hold the class of its place


# ---- words of a batch


def spelled(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given spans, each followed by a space, and their offsets."""
    size = end - start + 1
    off = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(off[-1]) - np.repeat(off[:-1], size) + np.repeat(start, size)
    out = buf[np.minimum(at, max(0, len(buf) - 1))]
    out[off[1:] - 1] = SPACE
    return out, off


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each, and the number of each in a row of ``keys``."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    head = np.append(True, sorted_[1:] != sorted_[:-1]) if len(keys) else np.zeros(0, bool)
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(head) - 1
    return sorted_[head], order[head], back


def _slot_counts(batches):
    """Per piece of a batch: distinct slots per text, and slots and times of each."""
    for batch in batches:
        for _, _, buf, off in slices(batch["text"]):
            buf = LOWER[buf]
            start, end, doc = words(buf, off)
            slots = (span_hash(prefix_hash(buf), start, end) % np.uint64(CLASS_SLOTS)).astype(np.int64)
            cell, times = np.unique(doc * CLASS_SLOTS + slots, return_counts=True)
            per = np.bincount(cell // CLASS_SLOTS, minlength=len(off) - 1)
            cols = (per.astype(np.int32), (cell % CLASS_SLOTS).astype(np.uint16), times.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols], names=["per", "slots", "times"])


def _dense(per: bytes, slots: bytes, times: bytes, size: int = 2048):
    """Slot counts of a piece's texts, some texts at a time."""
    per, slots, times = np.frombuffer(per, np.int32), np.frombuffer(slots, np.uint16), np.frombuffer(times, np.int32)
    off = np.concatenate([[0], np.cumsum(per, dtype=np.int64)])
    for a in range(0, len(per), size):
        b = min(len(per), a + size)
        out = np.zeros((b - a, CLASS_SLOTS))
        out[np.repeat(np.arange(b - a), per[a:b]), slots[off[a] : off[b]]] = times[off[a] : off[b]]
        yield out


def _expect(log: np.ndarray, share: np.ndarray):
    """Of a task's texts, per start: expected slot counts and texts of each class, and the log likelihood, in parts."""

    def expect(batches):
        total, texts, likely = np.zeros(log.shape), np.zeros(share.shape), np.zeros((len(log), 1))
        some = False
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("per", "slots", "times")), strict=True):
                for counts in _dense(*row):
                    some = True
                    z = (counts @ log.reshape(-1, CLASS_SLOTS).T).reshape(-1, *share.shape) + share
                    top = z.max(2, keepdims=True)
                    member = np.exp(z - top)
                    mass = member.sum(2, keepdims=True)
                    likely += (np.log(mass) + top).sum(0)
                    member /= mass
                    texts += member.sum(0)
                    total += (member.reshape(len(counts), -1).T @ counts).reshape(total.shape)
        if some:
            flat = np.concatenate([total.ravel(), texts.ravel(), likely.ravel()]).astype(np.float32)
            for n, part in enumerate(np.array_split(flat, RANGES)):
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["part", "sums"])

    return expect


def classes_of(log: np.ndarray, keys: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Class of each token's place (words, then the end, per text): the likeliest for the words before it."""
    per = np.bincount(doc, minlength=docs)
    n = len(keys) + docs
    gain = np.zeros((n + 1, CLASSES), np.float32)
    place = np.arange(len(keys)) + doc  # each end token takes a place
    gain[place + 1] = log[:, (keys % np.uint64(CLASS_SLOTS)).astype(np.int64)].T
    np.cumsum(gain, 0, out=gain)
    first = np.concatenate([[0], np.cumsum(per + 1)[:-1]])
    return (gain[:-1] - np.repeat(gain[first], per + 1, 0)).argmax(1)


WORDS_SQL = "bucket int, keys binary, counts binary, sizes binary, bytes binary"


def _emit_words(keys, counts, text, off, buckets: int):
    """Packed rows per bucket of words given by key, count and spelling."""
    bucket = (keys >> np.uint64(40)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    limits = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(limits)):
        own = order[limits[b] : limits[b + 1]]
        piece, sub = spelled(text, off[own], off[own + 1] - 1)
        rows.append((b, keys[own].tobytes(), counts[own].astype(np.int64).tobytes(), np.diff(sub).astype(np.int32).tobytes(), piece.tobytes()))
    kinds = (pa.int32(), *(pa.binary(),) * 4)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "keys", "counts", "sizes", "bytes"]) if rows else None


def _merge_words(parts):
    """One sorted table of words from several (keys, counts, text, off)."""
    keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    text = np.concatenate([p[2] for p in parts])
    base = np.cumsum([0, *(len(p[2]) for p in parts)])
    start = np.concatenate([p[3][:-1] + b for p, b in zip(parts, base, strict=False)])
    end = np.concatenate([p[3][1:] - 1 + b for p, b in zip(parts, base, strict=False)])
    unique, first, back = distinct(keys)
    piece, off = spelled(text, start[first], end[first])
    return unique, np.bincount(back, counts, len(unique)).astype(np.int64), piece, off


def _count_words(buckets: int, classes):
    """Word counts of a task, in packed rows; and the first bytes behind each previous-word slot."""

    def count(batches):
        parts, held, ends = [], 0, 0
        starts = np.zeros(CLASSES * SLOTS * 256, np.int64)
        log = classes.value
        for batch in batches:
            for _, _, buf, off in slices(batch["text"]):
                buf = LOWER[buf]
                start, end, doc = words(buf, off)
                keys = span_hash(prefix_hash(buf), start, end)
                token, _, inside = _first_bytes(log, buf, start, doc, keys, len(off) - 1)
                starts += np.bincount(token, minlength=len(starts))
                keys = (keys & ~CLASS_BITS) | inside
                unique, first, back = distinct(keys)
                text, limit = spelled(buf, start[first], end[first])
                parts.append((unique, np.bincount(back, minlength=len(unique)), text, limit))
                held += len(unique)
                ends += len(off) - 1
                if held > 1_500_000:
                    parts = [_merge_words(parts)]
                    held = len(parts[0][0])
                    if held > 1_000_000:
                        yield _emit_words(*parts[0], buckets)
                        parts, held = [], 0
        if held:
            yield _emit_words(*_merge_words(parts), buckets)
        if ends:  # bucket -1 - n: a part of the first-byte counts
            for n, part in enumerate(starts.reshape(64, -1)):
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([-1 - n], pa.int32()), pa.array([b""], pa.binary()), pa.array([part.tobytes()], pa.binary()), pa.array([b""], pa.binary()), pa.array([b""], pa.binary())],
                        names=["bucket", "keys", "counts", "sizes", "bytes"],
                    )

    return count


def _unpack(keys, counts, sizes, raw):
    off = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int32).astype(np.int64))])
    return np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64), np.frombuffer(raw, np.uint8), off


def _sum_words(table: pa.Table) -> pa.Table:
    bucket = table["bucket"][0].as_py()
    cols = [table[c].to_pylist() for c in ("keys", "counts", "sizes", "bytes")]
    if bucket < 0:
        total = sum(np.frombuffer(c, np.int64) for c in cols[1])
        row = (b"", total.tobytes(), b"", b"")
    else:
        keys, counts, text, off = _merge_words([_unpack(*r) for r in zip(*cols, strict=True)])
        row = (keys.tobytes(), counts.tobytes(), np.diff(off).astype(np.int32).tobytes(), text.tobytes())
    return pa.table([pa.array([bucket], pa.int32()), *(pa.array([c], pa.binary()) for c in row)], names=table.schema.names)


def _first_bytes(log, buf, start, doc, keys, docs: int):
    """Per token of each text (words, then the end): (class, slot of the previous word, first byte) as one number, and its text; and the class per word."""
    kind = classes_of(log, keys, doc, docs)
    per = np.bincount(doc, minlength=docs)
    last = np.cumsum(per + 1) - 1  # place of each end token
    n = len(start) + docs
    is_end = np.zeros(n, bool)
    is_end[last] = True
    byte = np.full(n, END, np.int64)
    byte[~is_end] = buf[start]
    slot = np.zeros(n, np.int64)
    slot[~is_end] = 1 + (keys % np.uint64(SLOTS - 1)).astype(np.int64)
    before = np.concatenate([[0], slot[:-1]])
    before[np.concatenate([[0], last[:-1] + 1])] = 0  # the first token of a text
    return (kind * SLOTS + before) * 256 + byte, np.repeat(np.arange(docs), per + 1), kind[~is_end].astype(np.uint64)


# ---- the tree of bytes and the predictors


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code length, tree node per depth, and bit per depth of all 256 bytes."""
    tie = counter()
    heap = [(int(c) + 1, next(tie), [s]) for s, c in enumerate(counts)]
    codes: list[list[int]] = [[] for _ in range(256)]
    paths: list[list[int]] = [[] for _ in range(256)]
    heapq.heapify(heap)
    node = 255
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        node -= 1
        for bit, side in ((0, a), (1, b)):
            for s in side[2]:
                codes[s].append(bit)
                paths[s].append(node)
        heapq.heappush(heap, (a[0] + b[0], next(tie), a[2] + b[2]))
    depth = max(map(len, codes))
    grid = lambda rows: np.array([r[::-1] + [0] * (depth - len(r)) for r in rows], np.int64)
    return np.array([len(c) for c in codes]), grid(paths), grid(codes)


def _contexts(prefix, start, at, kind):
    """Hashes of class and last bytes in the word, by order, and of class and whole beginning."""
    kind = kind * np.uint64(0xA24BAED4963EE407)
    out = [span_hash(prefix, np.maximum(start, at - k), at) + (at - k < start).astype(np.uint64) + kind for k in ORDERS]
    return [*out, span_hash(prefix, start, at) + np.uint64(7) + kind]


def _slots(contexts, rep, node):
    turn = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return [((c[rep] ^ turn) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - b)).astype(np.int64) for c, b in zip(contexts, BITS, strict=True)]


def _bits(tree, keys, text, off, first: int = 1):
    """Every bit of the bytes behind the ``first`` of all words: word, slot per predictor, bit, depth, last byte."""
    size, paths, codes = tree
    word = np.repeat(np.arange(len(off) - 1), np.diff(off))
    at = np.arange(len(text))
    inner = at >= off[:-1][word] + first
    word, at = word[inner], at[inner]
    contexts = _contexts(prefix_hash(text), off[:-1][word], at, keys[word] & CLASS_BITS)
    length = size[text[at]]
    rep = np.repeat(np.arange(len(at)), length)
    depth = np.arange(len(rep)) - np.repeat(np.cumsum(length) - length, length)
    symbol = text[at[rep]]
    return word[rep], _slots(contexts, rep, paths[symbol, depth]), codes[symbol, depth], depth, text[at[rep] - 1]


def _chunks(keys, counts, text, off, size: int = 8192):
    for a in range(0, len(keys), size):
        b = min(len(keys), a + size)
        yield keys[a:b], counts[a:b], text[off[a] : off[b]], off[a : b + 1] - off[a]


RANGES = 64


def _add_counts(tree):
    """Sums of the bit counts of a task's words, in parts of the tables."""

    def add(batches):
        tables = [np.zeros((2, 1 << b), np.float32) for b in BITS]
        some = False
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("keys", "counts", "sizes", "bytes")), strict=True):
                for keys, counts, text, off in _chunks(*_unpack(*row)):
                    some = True
                    word, slots, bit, _, _ = _bits(tree.value, keys, text, off)
                    weight = counts[word].astype(np.float32)
                    for t, s in zip(tables, slots, strict=True):
                        np.add.at(t.reshape(-1), s + bit * t.shape[1], weight)
        if some:
            flat = np.concatenate([t.reshape(-1) for t in tables])
            for n, part in enumerate(np.array_split(flat, RANGES)):
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["part", "sums"])

    return add


def _sum_parts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.float32).astype(np.float64) for c in table["sums"].to_pylist())
    return pa.table([table["part"][:1].combine_chunks(), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["part", "sums"])


def _tables(flat: np.ndarray) -> list[np.ndarray]:
    limits = np.cumsum([2 << b for b in BITS])[:-1]
    return [t.reshape(2, -1) for t in np.split(flat, limits)]


def _stretch(n0, n1):
    return np.log((n1 + 0.3) / (n0 + 0.3)).astype(np.float32)


class Mixer:
    """Gated weights and the adaptive map."""

    def __init__(self, weights=None, refined=None, shape=((len(BITS) + 1) * DEPTHS, len(BITS) + 1)):
        self.weights = np.full(shape, 0.3) if weights is None else weights
        grid = 1 / (1 + np.exp(-np.linspace(-8, 8, STEPS)))
        self.refined = np.tile(grid, (256, 1)) if refined is None else refined

    @staticmethod
    def gates(seen, depth):
        return seen * DEPTHS + np.minimum(depth, DEPTHS - 1)

    def summed(self, mass: float) -> np.ndarray:
        """The parameters times their weight, to be added up over tasks."""
        return (np.concatenate([[1.0], self.weights.ravel(), self.refined.ravel()]) * mass).astype(np.float32)

    def average(self, total: np.ndarray) -> Mixer:
        """The mixer of a total of ``summed``."""
        total = total[1:].astype(np.float64) / total[0]
        weights, refined = np.split(total, [self.weights.size])
        return Mixer(weights.reshape(self.weights.shape), refined.reshape(self.refined.shape))

    def mix(self, x, gate):
        dot = np.clip((self.weights[gate] * x).sum(1), -8, 8)
        return dot, 1 / (1 + np.exp(-dot))

    def refine(self, dot, last):
        at = (dot + 8) * ((STEPS - 1) / 16)
        low = np.minimum(at.astype(np.int64), STEPS - 2)
        part = at - low
        return low, part, self.refined[last, low] * (1 - part) + self.refined[last, low + 1] * part

    def learn(self, x, gate, last, bit, weight, rate):
        dot, p = self.mix(x, gate)
        error = (bit - p) * weight
        total = np.bincount(gate, weight, len(self.weights))
        step = np.stack([np.bincount(gate, error * x[:, i], len(self.weights)) for i in range(x.shape[1])], 1)
        # a bound of the curvature over all inputs, which move together
        power = np.bincount(gate, weight * p * (1 - p) * (x * x).sum(1), len(self.weights))
        self.weights += rate * step / (power + 0.02 * total + 1.0)[:, None]
        low, part, _ = self.refine(dot, last)
        for near, w in ((low, weight * (1 - part)), (low + 1, weight * part)):
            cell = last.astype(np.int64) * STEPS + near
            mass = np.bincount(cell, w, self.refined.size).reshape(self.refined.shape)
            ones = np.bincount(cell, w * bit, self.refined.size).reshape(self.refined.shape)
            self.refined += rate * (ones - mass * self.refined) / (mass + 20.0)

    def log2(self, x, gate, last, bit):
        """Log2 probability of each bit."""
        dot, p = self.mix(x, gate)
        p = np.clip((p + self.refine(dot, last)[2]) / 2, 1 / 65536, 1 - 1 / 65536)
        return np.log2(np.where(bit == 1, p, 1 - p))


def _train(tree, tables):
    """A mixer trained online on the words of a task, summed with its weight."""

    def train(batches):
        t = _tables(tables.value)
        mixer, mass, step = Mixer(), 0.0, 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("keys", "counts", "sizes", "bytes")), strict=True):
                keys, counts, text, off = _unpack(*row)
                for keys, counts, text, off in _chunks(keys, counts, text, off, 2048):
                    step += 1
                    word, slots, bit, depth, last = _bits(tree.value, keys, text, off)
                    weight = counts[word].astype(np.float64)
                    x = np.empty((len(word), len(BITS) + 1), np.float32)
                    seen = np.zeros(len(word), np.int64)
                    for i, (table, s) in enumerate(zip(t, slots, strict=True)):
                        n0, n1 = table[0][s], table[1][s]
                        # without this one occurrence of the word
                        n0, n1 = np.maximum(0, n0 - (bit == 0)), np.maximum(0, n1 - (bit == 1))
                        x[:, i] = _stretch(n0, n1)
                        seen += n0 + n1 > 0
                    x[:, -1] = 0.3
                    mixer.learn(x, Mixer.gates(seen, depth), last, bit, weight, max(0.02, 1 / (1 + step) ** 0.5))
                    mass += counts.sum()
        if step:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([mixer.summed(mass).tobytes()], pa.binary())], names=["part", "sums"])

    return train


def first_mixer() -> Mixer:
    return Mixer(shape=(FIRST_LEVELS * DEPTHS, 4))


def _nodes(tree, counts: np.ndarray) -> np.ndarray:
    """Zeros and ones at each tree node (2, rows, 255) from byte counts (rows, 256)."""
    size, paths, codes = tree
    out = np.zeros((2, len(counts), 255))
    for s in range(256):
        for d in range(size[s]):
            out[codes[s, d], :, paths[s, d]] += counts[:, s]
    return out


def _node_depths(tree) -> np.ndarray:
    size, paths, _ = tree
    out = np.zeros(255, np.int64)
    for s in range(256):
        out[paths[s, : size[s]]] = np.arange(size[s])
    return out


def _first_inputs(slot, kind, every, depth):
    """Inputs and gates of first-byte predictions from the (zeros, ones) of class and slot, of the class, and of all."""
    x = np.stack([*(_stretch(*n) for n in (slot, kind, every)), np.full(len(depth), 0.3, np.float32)], 1)
    level = np.minimum(FIRST_LEVELS - 1, np.log2(slot[0] + slot[1] + 1).astype(np.int64))
    return x, Mixer.gates(level, depth)


def _train_first(tree, per_class):
    """A mixer of first-byte predictions trained on the parts (bucket -1 - n) of the first-byte counts of a task."""

    def train(batches):
        kinds = _nodes(tree.value, per_class.value)
        every, depths = kinds.sum(1), _node_depths(tree.value)
        mixer, mass, step = first_mixer(), 0.0, 0
        parts = [x for b in batches for x in zip(b["bucket"].to_pylist(), b["counts"].to_pylist(), strict=True)]
        for _ in range(FIRST_PASSES):
            for bucket, raw in sorted(parts, reverse=True):
                counts = np.frombuffer(raw, np.int64).reshape(-1, 256)
                used = np.flatnonzero(counts.any(1))
                for rows in np.array_split(used, max(1, len(used) // 8)):
                    step += 1
                    nodes = _nodes(tree.value, counts[rows])
                    bit, row, node = np.nonzero(nodes)
                    kind = ((-1 - bucket) * len(counts) + rows[row]) // SLOTS
                    # without one occurrence of the byte
                    less = lambda n: tuple(np.maximum(0, n[b] - (bit == b)) for b in (0, 1))  # noqa: E731, B023
                    x, gate = _first_inputs(less(nodes[:, row, node]), less(kinds[:, kind, node]), less(every[:, node]), depths[node])
                    mixer.learn(x, gate, kind, bit, nodes[bit, row, node], max(0.02, 1 / (1 + step) ** 0.5))
                mass += float(counts.sum())
        if mass:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([mixer.summed(mass).tobytes()], pa.binary())], names=["part", "sums"])

    return train


# ---- scoring


class Scorer:
    """Log10 probabilities of words and of first bytes; words are kept in a bounded sorted cache."""

    def __init__(self, tree, flat, params, first, starts):
        self.tree = tree
        self.x = []
        self.known = []
        for n0, n1 in _tables(flat):
            self.x.append(_stretch(n0, n1))
            self.known.append(n0 + n1 > 0)
        self.mixer = Mixer(*params)
        self.first = first_byte_table(tree, starts, Mixer(*first))
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def spell(self, keys, text, off):
        """Log10 probability of all bytes of each word but the first, the space included."""
        out = []
        for keys_, _, part, limit in _chunks(keys, keys, text, off):
            word, slots, bit, depth, last = _bits(self.tree, keys_, part, limit)
            x = np.stack([*(t[s] for t, s in zip(self.x, slots, strict=True)), np.full(len(word), 0.3, np.float32)], 1)
            seen = sum(k[s].astype(np.int64) for k, s in zip(self.known, slots, strict=True))
            out.append(np.bincount(word, self.mixer.log2(x, Mixer.gates(seen, depth), last, bit), len(limit) - 1))
        return np.concatenate(out) * np.log10(2) if out else np.zeros(0)

    def words(self, keys, buf, start, end):
        """The same for words given by key, from the cache where it has them."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        have = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out = np.empty(len(keys))
        out[have] = self.values[at[have]]
        new = np.flatnonzero(~have)
        if len(new):
            out[new] = self.spell(keys[new], *spelled(buf, start[new], end[new]))
            if len(self.keys) + len(new) <= CACHE_WORDS:
                place = np.searchsorted(self.keys, keys[new])
                self.keys, self.values = np.insert(self.keys, place, keys[new]), np.insert(self.values, place, out[new])
        return out


def first_byte_table(tree, starts: np.ndarray, mixer: Mixer) -> np.ndarray:
    """Log10 probability of a first byte (or the end) behind each class and slot of previous words.

    At each tree node the predictions by class and slot, by class, and by neither are mixed, as for the other bytes.
    """
    size, paths, codes = tree
    starts = starts.reshape(CLASSES, SLOTS, 256)
    out, depth = np.zeros((CLASSES, SLOTS, 256)), np.tile(_node_depths(tree), SLOTS)
    kinds = _nodes(tree, starts.sum(1))
    every = kinds.sum(1)
    for k, (kind, counts) in enumerate(zip(out, starts, strict=True)):
        spread = lambda n: np.tile(n, (1, SLOTS))
        x, gate = _first_inputs(_nodes(tree, counts).reshape(2, -1), spread(kinds[:, k]), spread(every), depth)
        last = np.full(len(depth), k)
        both = np.stack([mixer.log2(x, gate, last, np.full(len(depth), b)) for b in (0, 1)]).reshape(2, SLOTS, 255) * np.log10(2)
        for s in range(256):
            for d in range(size[s]):
                kind[:, s] += both[codes[s, d], :, paths[s, d]]
    return out.astype(np.float32).ravel()


SCORES_SQL = "uid long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, n_bytes long, bucket int, keys binary, uids binary"


def _score(model, tables, frequent, buckets: int):
    """Per text a row; and, packed per bucket, the words of texts that are not among the commonest."""

    def score(batches):
        log, tree, params, first_params, starts, stamp = model.value
        keys_, counts_ = frequent.value
        home = vars(sys.modules.setdefault("_word_scores_of_worker", types.ModuleType("_word_scores_of_worker")))
        if home.get("stamp") != stamp:
            home["stamp"], home["scorer"] = stamp, Scorer(tree, tables.value, params, first_params, starts)
        scorer = home["scorer"]
        uid = TaskContext.get().partitionId() << 33
        logs_ = np.log10(counts_ + 1.0)
        names = [c.split()[0] for c in SCORES_SQL.split(", ")]
        for batch in batches:
            for first, last, buf, off in slices(batch["text"]):
                n = last - first
                size = np.diff(off)
                buf = LOWER[buf]
                start, end, doc = words(buf, off)
                keys = span_hash(prefix_hash(buf), start, end)
                token, owner, inside = _first_bytes(log, buf, start, doc, keys, n)
                total = np.bincount(owner, scorer.first[token], n).astype(np.float64)
                unique, at, back = distinct((keys & ~CLASS_BITS) | inside)
                total += np.bincount(doc, scorer.words(unique, buf, start[at], end[at])[back], n)
                # counts of the commonest words and of the end are at hand
                place = np.minimum(np.searchsorted(keys_, unique >> np.uint64(3)), max(0, len(keys_) - 1))
                common = keys_[place] == unique >> np.uint64(3) if len(keys_) else np.zeros(len(unique), bool)
                known = np.bincount(doc, common[back], n)
                logs = np.bincount(doc, np.where(common, logs_[place], 0.0)[back] if len(keys_) else None, n) if len(keys_) else np.zeros(n)
                ids = uid + np.arange(n)
                uid += n
                tokens = np.bincount(doc, minlength=n) + 1
                none = lambda t: pa.nulls(n, t)  # noqa: E731, B023
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), part["doc_id"], part["held_out"], pa.array(tokens), pa.array(known.astype(np.int64)), pa.array(logs, pa.float64()), pa.array(total, pa.float64()), pa.array(size.astype(np.int64)), none(pa.int32()), none(pa.binary()), none(pa.binary())],
                    names=names,
                )
                rare = ~common[back]
                if rare.any():
                    k, d = keys[rare] >> np.uint64(3), ids[doc[rare]]
                    bucket = (k >> np.uint64(37)).astype(np.int64) % buckets
                    order = np.argsort(bucket, kind="stable")
                    limits = np.searchsorted(bucket[order], np.arange(buckets + 1))
                    full = np.flatnonzero(np.diff(limits))
                    cut = [order[limits[b] : limits[b + 1]] for b in full]
                    empty = [pa.nulls(len(full), t) for t in (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        [*empty, pa.array(full, pa.int32()), pa.array([k[c].tobytes() for c in cut], pa.binary()), pa.array([d[c].tobytes() for c in cut], pa.binary())], names=names
                    )

    return score


def _by_word(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted words and their counts, over all classes."""
    word, counts = np.frombuffer(keys, np.uint64) >> np.uint64(3), np.frombuffer(counts, np.int64)
    head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    return word[head], np.add.reduceat(counts, head)


def _look_up(table: pa.Table, counts: pa.Table) -> pa.Table:
    """Per text the rare words of a bucket that training has, and their log counts."""
    have, times = _by_word(counts["keys"][0].as_py(), counts["counts"][0].as_py()) if len(counts) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    k = np.concatenate([np.frombuffer(c, np.uint64) for c in table["keys"].to_pylist()] or [np.zeros(0, np.uint64)])
    uid = np.concatenate([np.frombuffer(c, np.int64) for c in table["uids"].to_pylist()] or [np.zeros(0, np.int64)])
    at = np.minimum(np.searchsorted(have, k), max(0, len(have) - 1))
    ok = have[at] == k if len(have) else np.zeros(len(k), bool)
    unique, back = np.unique(uid[ok], return_inverse=True)
    n = np.bincount(back, minlength=len(unique)).astype(np.int64)
    logs = np.bincount(back, np.log10(times[at[ok]] + 1.0), len(unique)).astype(np.float64)
    # packed per group of neighbouring texts: a row per (bucket, group), not per (bucket, text)
    part, first = np.unique(unique >> GROUP_BITS, return_index=True)
    cut = list(itertools.pairwise([*first.tolist(), len(unique)])) if len(part) else []
    packed = [[x[a:b].tobytes() for a, b in cut] for x in (unique, n, logs)]
    return pa.table([pa.array(part, pa.int64()), *(pa.array(c, pa.binary()) for c in packed)], names=["part", "uids", "known", "logs"])


def _sum_texts(table: pa.Table) -> pa.Table:
    uid, known, logs = (np.concatenate([np.frombuffer(c, t) for c in table[x].to_pylist()]) for x, t in (("uids", np.int64), ("known", np.int64), ("logs", np.float64)))
    unique, back = np.unique(uid, return_inverse=True)
    return pa.table([unique, np.bincount(back, known, len(unique)).astype(np.int64), np.bincount(back, logs, len(unique))], names=["u", "k2", "l2"])


def _levels(batches):
    """Words and tokens per power of two of the count, and bytes per value."""
    for batch in batches:
        for keys, counts, sizes, raw in zip(*(batch[c].to_pylist() for c in ("keys", "counts", "sizes", "bytes")), strict=True):
            _, per, text, off = _unpack(keys, counts, sizes, raw)
            counts = _by_word(keys, counts)[1]
            level = np.log2(counts).astype(np.int64)
            n, total = np.bincount(level, minlength=63), np.bincount(level, counts, 63)
            byte = np.bincount(text, np.repeat(per, np.diff(off)).astype(np.float64), 256)
            kind = np.concatenate([np.arange(63), 1000 + np.arange(256)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(np.concatenate([n, byte]).astype(np.int64)), pa.array(np.concatenate([total, byte]).astype(np.int64))], names=["kind", "n", "total"]
            )


def _common(least: int):
    def common(batches):
        for batch in batches:
            for k, c in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                keys, counts = _by_word(k, c)
                often = counts >= least
                yield pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(counts[often])], names=["key", "n"])

    return common


def _classes(docs: DataFrame) -> np.ndarray:
    """Log probabilities of word slots per class: EM over all texts, the likeliest of several starts."""
    with scratch(docs.sparkSession, "classes"):
        table = stash(docs.select("text").mapInArrow(_slot_counts, "per binary, slots binary, times binary"), "slots")

        def expected(log, share):
            flat = np.zeros(log.size + share.size + len(log))
            cut = np.cumsum([0, *(len(x) for x in np.array_split(flat, RANGES))])
            part = "part int, sums binary"
            for r in table.mapInArrow(_expect(log, share), part).groupBy("part").applyInArrow(_sum_parts, part).collect():  # RANGES rows
                flat[cut[r["part"]] : cut[r["part"] + 1]] = np.frombuffer(r["sums"], np.float32)
            total, texts, likely = np.split(flat, [log.size, log.size + share.size])
            return total.reshape(log.shape), texts.reshape(share.shape), likely

        even = lambda n: np.full((n, CLASSES), -np.log(CLASSES))
        counts = expected(np.full((1, CLASSES, CLASS_SLOTS), -np.log(CLASS_SLOTS)), even(1))[0][0].sum(0)
        prior = (counts + 1) / (counts.sum() + CLASS_SLOTS)
        # texts to begin with: any do, as each round is over all texts
        seeds = docs.where(F.octet_length("text") >= 100).orderBy(F.xxhash64("doc_id", "text")).limit(STARTS * CLASSES).select("text")
        seeds = [c for batch in seeds.toArrow().to_batches() for row in _slot_counts([batch]) for c in _dense(*(x[0].as_py() for x in row.columns))]
        seeds = np.concatenate(seeds or [np.zeros((0, CLASS_SLOTS))])
        if len(seeds) < CLASSES:
            return np.tile(np.log(prior), (CLASSES, 1))
        rng = np.random.default_rng(3)
        total = np.stack([seeds[rng.choice(len(seeds), CLASSES, replace=False)] for _ in range(STARTS)])
        share = even(STARTS)
        for n in range(FIRST_ROUNDS + ROUNDS):
            total += 50 * prior
            log = np.log(total / total.sum(2, keepdims=True))
            total, texts, likely = expected(log, share)
            share = np.log((texts + 1) / (texts + 1).sum(1, keepdims=True))
            if n == FIRST_ROUNDS - 1:  # the likeliest start goes on
                best = slice(likely.argmax(), likely.argmax() + 1)
                total, share = total[best], share[best]
        total += 50 * prior
        return np.log(total / total.sum(2, keepdims=True))[0]


def score(docs: DataFrame, learn) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text); rows where the condition ``learn`` holds train.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).
    """
    with scratch(docs.sparkSession, "lm"):
        spark = docs.sparkSession
        sc = spark.sparkContext
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~learn).alias("held_out"))
        size = docs.agg(F.sum(F.octet_length("text")), F.sum((~F.col("held_out")).cast("long"))).first()
        buckets, ends = max(8, -(-(size[0] or 0) // BUCKET_BYTES)), size[1] or 0
        classes = sc.broadcast(_classes(docs.where(~F.col("held_out") & F.col("text").isNotNull())))
        counted = docs.where(~F.col("held_out")).select("text").mapInArrow(_count_words(buckets, classes), WORDS_SQL)
        table = stash(counted.groupBy("bucket").applyInArrow(_sum_words, WORDS_SQL), "words")
        known = table.where("bucket >= 0")
        levels = {r["kind"]: (r["n"], r["total"]) for r in known.mapInArrow(_levels, "kind int, n long, total long").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
        total = sum(levels.get(i, (0, 0))[1] for i in range(63)) + ends
        vocabulary = sum(levels.get(i, (0, 0))[0] for i in range(63)) + (ends > 0)
        # the largest set of all words above a power of two that fits
        top = next((i for i in range(63) if sum(levels.get(j, (0, 0))[0] for j in range(i, 63)) <= FREQUENT), 63)
        often = known.mapInArrow(_common(1 << top), "key long, n long").toArrow()  # at most FREQUENT rows
        keys, counts = often["key"].to_numpy().view(np.uint64), often["n"].to_numpy()
        order = np.argsort(keys)
        frequent = sc.broadcast((keys[order], counts[order]))
        starts = np.zeros((64, CLASSES * SLOTS * 4), np.int64)
        for r in table.where("bucket < 0").select("bucket", "counts").collect():  # 64 rows
            starts[-1 - r["bucket"]] = np.frombuffer(r["counts"], np.int64)
        bytes_ = np.array([levels.get(1000 + s, (0, 0))[0] for s in range(256)]) + starts.reshape(-1, 256).sum(0)
        tree = sc.broadcast(huffman(bytes_))
        tasks = min(12, buckets)
        part = "part int, sums binary"
        spread = known.repartition(tasks, "bucket")
        flat = np.zeros(sum(2 << b for b in BITS), np.float32)
        cut = np.cumsum([0, *(len(x) for x in np.array_split(flat, RANGES))])
        for r in spread.mapInArrow(_add_counts(tree), part).groupBy("part").applyInArrow(_sum_parts, part).toLocalIterator():  # RANGES rows
            flat[cut[r["part"]] : cut[r["part"] + 1]] = np.frombuffer(r["sums"], np.float32)
        tables = sc.broadcast(flat)
        averaged = lambda got, mixer: next((mixer.average(np.frombuffer(r["sums"], np.float32)) for r in got.groupBy("part").applyInArrow(_sum_parts, part).collect()), mixer)  # noqa: E731  one row
        mixer = averaged(known.mapInArrow(_train(tree, tables), part), Mixer())
        per_class = sc.broadcast(starts.reshape(CLASSES, SLOTS, 256).sum(1))
        first = averaged(table.where("bucket < 0").select("bucket", "counts").mapInArrow(_train_first(tree, per_class), part), first_mixer())
        model = sc.broadcast((classes.value, tree.value, (mixer.weights, mixer.refined), (first.weights, first.refined), starts.ravel(), f"{sc.applicationId}/{id(mixer)}/{total}"))
        scored = stash(docs.mapInArrow(_score(model, tables, frequent, buckets), SCORES_SQL), "scores")
        rare = scored.where("bucket IS NOT NULL").select("bucket", "keys", "uids").groupBy("bucket")
        met = rare.cogroup(known.select("bucket", "keys", "counts").groupBy("bucket")).applyInArrow(_look_up, "part long, uids binary, known binary, logs binary")
        met = met.groupBy("part").applyInArrow(_sum_texts, "u long, k2 long, l2 double")
        out = scored.where("bucket IS NULL").join(met, F.col("uid") == F.col("u"), "left")
        zero = lambda c: F.coalesce(c, F.lit(0))
        end_log = float(np.log10(ends + 1.0))
        out = out.select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + zero("k2") + int(ends > 0)).cast("long").alias("n_known"),
            F.lit(int(total)).cast("long").alias("train_tokens"),
            (F.col("logs") + zero("l2") + end_log - F.col("n_tokens") * float(np.log10(total + vocabulary + 1.0))).alias("base_score"),
            "score",
            (-F.col("score") / float(np.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
        )
        return stash(out, "lm-scores", keep=True)


def op10_context_mixing(spark, sf_dir: str) -> DataFrame:
    docs = sf_table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return score(docs, ~held)
