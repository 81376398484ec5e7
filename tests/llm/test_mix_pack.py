"""Mixing, packing and the pipeline."""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import apply_mix, mix
from tidemark.llm.packing import pack, pieces, sum_of_squares
from tidemark.llm.shared import stash

SF = "/root/testdata/sf0.001"


def targets_brute(own):
    names = sorted(k for k in own if k is not None) + ([None] if None in own else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, free = 1.5 * sum(own.values()), set(names)
    while free:
        share = (total - sum(2 * own[s] for s in names if s not in free)) / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 2 * own[s]}
        if not over:
            break
        free -= over
    return {s: share * weight[s] if s in free else 2 * own[s] for s in names}


def test_mix_targets_and_copies(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 300))), ["b", "a", "ä", None, "c", "zero"][i % 5 if i % 97 else 5]) for i in range(600)]
    rows = [(i, "" if s == "zero" else t, s) for i, t, s in rows] + [(600, None, "a"), (7, rows[7][1], rows[7][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit(9))
    got = mix(docs).collect()
    assert len(got) == len(rows)
    own = collections.Counter()
    for _, t, s in rows:
        own[s] += len((t or "").split())
    want = targets_brute(dict(own))
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source], rel=1e-9) and r.source_size == own[r.source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.01 * max(t, 1)
    again = mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    out = apply_mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)


def test_mix_of_nothing(spark):
    kind = "doc_id long, text string, source string"
    assert mix(spark.createDataFrame([], kind)).count() == 0
    got = mix(spark.createDataFrame([(1, None, None), (2, "", "x")], kind)).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in got} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_sum_of_squares_packing():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 101, 2000)
    number, offset = sum_of_squares(lengths, 100)
    fill = np.bincount(number, lengths)
    assert fill.max() <= 100 and len(fill) <= np.ceil(lengths.sum() / 100) * 1.01 + 1
    for n in range(len(fill)):
        own = np.flatnonzero(number == n)
        own = own[np.argsort(offset[own])]
        assert (offset[own] == np.cumsum(lengths[own]) - lengths[own]).all()


def test_pieces_and_pack(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(-1, None), (-2, ""), (-3, "don't \x0b stop\x0c<|endoftext|>É é 12 a b　c"), (-4, "wörd " * 9000), (rows[0][0], rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash"))
    tok, want = Tokenizer.from_file(path), collections.Counter()
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), 4096)):
            want[i, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())] += 1
    out = pack(pieces(docs, path), shard_pieces=30).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    at = collections.defaultdict(list)
    for r in out:
        at[r.sequence_id].append((r.offset, r.length))
    for places in at.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= 4096
    assert pack(pieces(docs.where("doc_id = -99"), path)).count() == 0


def test_equal_pieces_are_spread_over_shards(spark):
    same = spark.range(3000).selectExpr("cast(null as long) doc_id", "0 piece", "0L start", "100L length", "7L ids_crc32")
    out = pack(stash(same, "same"), length=1000, shard_pieces=100).collect()
    assert len(out) == 3000
    shards = collections.Counter(r.sequence_id >> 32 for r in out)
    assert len(shards) == 30 and max(shards.values()) < 200  # none gets them all
    places = collections.defaultdict(list)
    for r in out:
        places[r.sequence_id].append(r.offset)
    assert all(sorted(p) == [100 * k for k in range(len(p))] for p in places.values())


def _by_rule(lengths, capacity):
    """The sum-of-squares rule, by trying every open gap."""
    gaps, where = [], {}
    for p in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        s, best = lengths[p], None
        for g in sorted({g for g in gaps if g >= s}):
            after = collections.Counter(gaps)
            after[g] -= 1
            if g > s:
                after[g - s] += 1
            after[0] = 0
            cost = sum(v * v for v in after.values())
            if best is None or cost < best[0]:
                best = (cost, g)
        if best is None:
            gaps.append(capacity)
            best = (0, capacity)
        gaps.remove(best[1])
        gaps.append(best[1] - s)
        where[p] = capacity - best[1]
    return where, sum(1 for _ in gaps)


@pytest.mark.parametrize("seed", range(6))
def test_packing_follows_the_rule(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 41, 80)
    number, offset = sum_of_squares(lengths, 40)
    where, made = _by_rule(lengths.tolist(), 40)
    assert number.max() + 1 == made and [int(x) for x in offset] == [where[i] for i in range(80)]


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "12 34", "en", "src0", 5), (10**6 + 1, None, "en", None, 0)], docs.schema)
    first = docs.union(extra)
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_duplicates", "suffix_dedup", "source_mix", "packing"]
    kept = first
    for name, stage in cp.STAGES[:3]:
        kept = cp.stash(stage(spark, kept, SF), name)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 10**6 not in ids and len(ids) >= 0.7 * docs.count()
    words = kept.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    mixed = cp.stash(cp.source_mix(spark, kept, SF), "mix")
    assert mixed.columns == docs.columns
    got = mixed.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert abs(got - 1.5 * words) <= 0.03 * words
    packed = cp.packing(spark, mixed, SF)
    assert packed.where("piece = 0").count() == mixed.count()
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_keeps_one_of_copies_without_an_id(spark):
    import corpus_pipeline as cp

    make = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    twice, named, near = make("a", 80), make("b", 80), make("c", 120)
    rows = [(None, twice)] * 3 + [(None, named), (7, named), (None, near), (None, near + " more"), (8, make("d", 80)), (None, "x y")]
    for top in (9, 2**63 - 1):  # ids with room behind them, and without
        docs = spark.createDataFrame([*rows, (top, make("e", 80))], "doc_id long, text string").repartition(3)
        kept = cp.stash(cp.near_duplicates(spark, docs, SF), "kept")
        kept = [(r.doc_id, r.text) for r in cp.suffix_dedup(spark, kept, SF).collect()]
        assert len(kept) == 6 and {t.split()[0] for _, t in kept} == {"a0", "b0", "c0", "d0", "e0", "x"}
        assert all(len(t) > 200 for _, t in kept if t != "x y")
        assert top != 9 or (7, named) in kept


def test_queries_are_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    assert [re.match(r"op\d+|pipeline", n)[0] for n in names if re.match(r"op\d+_|pipeline", n)] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


def test_sequences_are_rebuilt_from_packed_ids(spark):
    import public_tokenizers
    import zlib

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(1, "one two three " * 9, "x"), (1, "one two three " * 9, "x"), (None, "four", "y"), (3, None, None), (4, "five six " * 40, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)  # a column of a clashing name
    out = pack(stash(pieces(docs, path, length=50, keep_ids=True), "ids"), length=50, shard_pieces=4).collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in out)
    assert len({r.row_id for r in out}) == 5 and len({r.row_id for r in out if r.doc_id == 1}) == 2
    known = pieces(docs, path, length=10**6, keep_ids=True).collect()
    whole = {}
    for r in sorted(out, key=lambda r: (r.row_id, r.piece)):
        whole[r.row_id] = whole.get(r.row_id, b"") + bytes(r.ids)
    assert sorted(whole.values()) == sorted(bytes(r.ids) for r in known)
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 50


def test_new_words_are_tokenised_a_few_at_a_time(monkeypatch):
    """The same ids, and no call with more words than ``ENCODE_WORDS``."""
    import public_tokenizers

    from tidemark.llm import packing
    from tidemark.llm.textkit import slices

    import pyarrow as pa

    column = pa.array([" ".join(f"wörd{i * j}x" for j in range(30)) for i in range(20)] + ["", None])
    ((_, _, buf, off),) = slices(column)
    known = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    want = [known.tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in column.to_pylist()]
    sizes, inner = [], known.tokenizer

    class Watched:
        def encode_batch_fast(self, texts, **kw):
            sizes.append(len(texts))
            return inner.encode_batch_fast(texts, **kw)

    known.tokenizer = Watched()
    monkeypatch.setattr(packing, "ENCODE_WORDS", 16)
    ids, limit = packing.token_ids(known, buf, off, 1)
    assert max(sizes) <= 16 < sum(sizes)
    assert [ids[a:b].tolist() for a, b in zip(limit[:-1], limit[1:], strict=True)] == want


def test_word_ids_stay_in_place_and_slices_are_small(monkeypatch):
    """Each slice copied the ids of all kept words, and slices were of 1 MB with arrays of eight bytes a byte."""
    import public_tokenizers

    from tidemark.llm import packing

    import pyarrow as pa

    most, kept = [], packing.token_ids

    def watched(known, buf, off, end_id):
        most.append((len(buf), known.ids.ctypes.data, known.held))
        return kept(known, buf, off, end_id)

    monkeypatch.setattr(packing, "token_ids", watched)
    monkeypatch.setattr(packing, "_worker_state", dict)
    monkeypatch.setattr(packing, "CACHE_WORDS", 3000)
    texts = [" ".join(f"word{j}x" for j in range(i, i + 400)) for i in range(300)] + [None, ""] + ["often " * 60000]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts), "row_id": pa.array(range(len(texts)))})
    path = public_tokenizers.path("word_bpe_49k.json")
    got = pa.Table.from_batches(packing._pieces(path, 10**6, 1, True)([batch] * 2)).to_pylist()
    encode = packing.WordIds(path).tokenizer.encode
    want = [encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in got] == want * 2
    assert max(n for n, _, _ in most) <= max(packing.PART, len(texts[-1]))
    assert sum(n > packing.PART for n, _, _ in most) == 2 and len({at for _, at, _ in most}) < len(most)


def test_workers_give_memory_back_after_a_task():
    from tidemark.llm.shared import lean

    import pyarrow as pa

    work = lean(lambda batches: (b.slice(1) for b in batches))
    got = list(work([pa.record_batch({"x": [1, 2, 3]})]))
    assert [b.to_pydict() for b in got] == [{"x": [2, 3]}]
