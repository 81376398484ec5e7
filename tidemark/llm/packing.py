"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

1. *Tokens.* Words (runs between ASCII white space) are tokenised once per worker and
   kept by hash in a bounded cache; the ids of a text are the ids of its
   words in order, which the tokenizer's splitting at white space allows. Each document ends with an
   end id. Only documents longer than a sequence are cut, into whole sequences
   and a rest.
2. *Shards.* Pieces are dealt to shards by a hash; a shard holds ``shard_pieces`` on
   average, so no task sees more, at any input size.
3. *Packing.* A shard places its pieces, longest first, by the sum-of-squares
   rule: with N(g) open sequences of residual gap g, a piece of length s goes
   where the sum of N(g)**2 becomes smallest - into a gap g (N(g) falls by one,
   N(g - s) rises by one), or into a new sequence where no gap holds it. Pieces of one length
   are interchangeable. Full sequences are closed. Of equal
   sums the smaller gap wins.

Defined results: a null or empty text is the end id alone. Repeated rows are each
packed. Literal special tokens in a text get the ids the tokenizer gives them. An empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import sys
import types
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import give_back, lean, sf_table, stash
from tidemark.llm.textkit import prefix_hash, slices, span_hash, words

LENGTH, END_ID, SHARD_PIECES, CACHE_WORDS, ENCODE_WORDS = 4096, 1, 4096, 1_000_000, 256
PART = 1 << 18  # some arrays of eight bytes a byte of text are held at a time


def _worker_state() -> dict:
    """A dictionary that lives as long as its Python worker, over its tasks."""
    return vars(sys.modules.setdefault("_word_ids_of_worker", types.ModuleType("_word_ids_of_worker")))


class WordIds:
    """Ids of words: sorted word hashes with places in one array of ids.

    It keeps the first ``CACHE_WORDS`` words that a worker meets, frequent ones among them;
    words beyond are tokenised again in every slice.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keys = np.zeros(0, np.uint64)
        # ``held`` ids belong to kept words; those behind them are of the last slice's other words
        self.at, self.count, self.ids, self.held = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32), 0

    def look_up(self, hashes: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word its place in the ids and its number of ids, and the ids; unknown words are tokenised first."""
        if not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), self.ids
        order = np.argsort(hashes)
        sorted_ = hashes[order]
        head = np.append(True, sorted_[1:] != sorted_[:-1])
        unique, first = sorted_[head], order[head]
        back = np.empty(len(hashes), np.int64)
        back[order] = np.cumsum(head) - 1
        row = self._find(unique)
        new = np.flatnonzero(row < 0)
        at, count = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        known = row >= 0
        at[known], count[known] = self.at[row[known]], self.count[row[known]]
        if len(new):
            raw = buf.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
            # a few words at a time: an encoding takes about 1 KB until its ids are taken
            some = (texts[a : a + ENCODE_WORDS] for a in range(0, len(texts), ENCODE_WORDS))
            got = [e.ids for part in some for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            count[new] = np.fromiter(map(len, got), np.int64, len(got))
            at[new] = self.held + np.cumsum(count[new]) - count[new]
            self._append(np.fromiter(chain.from_iterable(got), np.uint32, int(count[new].sum())))
            if len(self.keys) + len(new) <= CACHE_WORDS:
                place = np.searchsorted(self.keys, unique[new])
                self.keys = np.insert(self.keys, place, unique[new])
                self.at, self.count = np.insert(self.at, place, at[new]), np.insert(self.count, place, count[new])
                self.held += int(count[new].sum())
        return at[back], count[back], self.ids

    def _append(self, ids: np.ndarray):
        """``ids`` behind those of the kept words, in place: a copy of all of them in each slice is as large as they are."""
        need = self.held + len(ids)
        if need > len(self.ids):
            kept, self.ids = self.ids, np.empty(need + (need >> 2), np.uint32)
            self.ids[: self.held] = kept[: self.held]
        self.ids[self.held : need] = ids

    def _find(self, unique: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(unique), -1)
        at = np.minimum(np.searchsorted(self.keys, unique), len(self.keys) - 1)
        return np.where(self.keys[at] == unique, at, -1)


def token_ids(known: WordIds, buf: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, each text followed by ``end_id``, and the offsets of the texts."""
    start, end, doc = words(buf, off)
    n = len(off) - 1
    at, count, source = known.look_up(span_hash(prefix_hash(buf), start, end), buf, start, end)
    per = np.bincount(doc, count, n).astype(np.int64) + 1
    limit = np.concatenate([[0], np.cumsum(per)])
    out = np.full(limit[-1], end_id, np.uint32)
    # ids of word w go to the place of its text plus the ids before it
    before = np.cumsum(count) - count + doc
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    out[np.repeat(before, count) + step] = source[np.repeat(at, count) + step]
    return out, limit


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long"
IDS_SQL = ", row_id long, ids binary"


def _pieces(path: str, length: int, end_id: int, keep_ids: bool):
    schema = PIECES.append(pa.field("row_id", pa.int64())).append(pa.field("ids", pa.binary())) if keep_ids else PIECES

    def cut(batches):
        state = _worker_state()
        if path not in state:
            state[path] = WordIds(path)
        for batch in batches:
            docs = batch["doc_id"].to_pylist()
            row_ids = batch["row_id"].to_pylist() if keep_ids else []
            for first, _, buf, off in slices(batch["text"], PART):
                ids, limit = token_ids(state[path], buf, off, end_id)
                rows = []
                for d, (a, b) in enumerate(zip(limit[:-1].tolist(), limit[1:].tolist(), strict=True)):
                    for k, x in enumerate(range(a, b, length)):
                        raw = ids[x : min(b, x + length)].astype("<u4").tobytes()
                        row = (docs[first + d], k, x - a, min(b, x + length) - x, zlib.crc32(raw))
                        rows.append((*row, row_ids[first + d], raw) if keep_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                del ids, limit, rows
            # encoding threads and arrays of many sizes leave gaps behind
            give_back()

    return cut


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, row_id, ids]) of all documents.

    With ``keep_ids`` the token ids come along (little-endian unsigned 32-bit), and a number per row of ``docs``, which
    tells copies of one row apart.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([F.monotonically_increasing_id().alias("row_id")] if keep_ids else []))
    return docs.mapInArrow(lean(_pieces(path, length, end_id, keep_ids)), PIECES_SQL + (IDS_SQL if keep_ids else ""))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece (all of 1 to ``capacity`` long)."""
    order = np.argsort(-lengths, kind="stable")
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_ = np.zeros(capacity + 1, np.int64)  # N(g); a gap of 0 is closed and never counts
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for p in order.tolist():
        s = int(lengths[p])
        gaps = np.flatnonzero(open_[s:])
        if len(gaps):
            # (N(g) - 1)**2 + (N(g - s) + 1)**2 against the squares before
            change = 2 * (open_[gaps] * (gaps > 0) - open_[gaps + s])
            change[gaps == 0] -= 1  # a filled sequence leaves the sum
            g = int(gaps[change.argmin()]) + s
            q = stacks[g].pop()
            open_[g] -= 1
        else:
            g, q = capacity, made
            made += 1
        number[p], offset[p] = q, capacity - g
        if g > s:
            stacks[g - s].append(q)
            open_[g - s] += 1
    return number, offset


def _packer(length: int):
    def pack(table: pa.Table) -> pa.Table:
        order = np.lexsort([table[c].to_numpy() for c in ("ids_crc32", "piece", "doc_id")])
        table = table.take(pa.array(order))
        number, offset = sum_of_squares(table["length"].to_numpy(), length)
        shard = table["shard"].to_numpy()
        table = table.append_column("sequence_id", pa.array((shard.astype(np.int64) << 32) + number))
        return table.append_column("offset", pa.array(offset)).drop_columns(["shard"])

    return pack


def pack(pieces: DataFrame, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32[, row_id, ids]) with sequence_id and offset.

    The ids of a shard are at most ``shard_pieces * length * 4`` bytes on average (64 MiB as set here). ``pieces`` is a written table: its rows are numbered as they are read, and a task that runs again has to read
    the same rows in the same order."""
    count = pieces.count()
    shards = max(1, -(-count // shard_pieces))
    # rows that are equal in all columns (copies of a row, null ids) differ by their number only
    place = F.xxhash64("doc_id", "piece", "length", "ids_crc32", F.monotonically_increasing_id())
    kept = [*PIECES.names, *(c for c in ("row_id", "ids") if c in pieces.columns)]
    dealt = pieces.select(*kept).withColumn("shard", F.pmod(place, F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(_packer(length), PIECES_SQL + (IDS_SQL if "ids" in kept else "") + ", sequence_id long, offset long")


def op5_sum_of_squares_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(stash(pieces(sf_table(spark, sf_dir, "documents"), path), "pieces"))
