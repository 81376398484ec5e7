"""Prefix trie of conversations against a brute-force trie."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm.trie import OP12_SQL, op12_prefix_trie, rebuilt, trie, turns

SCHEMA = "conv_id long, turn int, role string, text string"


def sequences_brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def trie_brute(seqs):
    if not seqs:
        return set()
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = own + sum(saved[k] for k in kids[node])
    out = set()
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(seqs[c]) == len(node))
        out.add((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(n=160, seed=3):
    rnd = random.Random(seed)
    texts = ["", "é", "hello", "x" * 40, None, "ab", "b"]
    rows = []
    for c in rnd.sample(range(400), n):
        for t in range(rnd.randint(0, 12)):
            rows.append((c, None if t == 0 and c % 7 == 0 else t, [None, "user", "a"][(t + c // 90) % 3], texts[rnd.randint(0, 1 if t < 6 else 6)]))
    for c in range(1000, 1080):  # one large group of copies
        rows += [(c, t, "user", f"turn {t}") for t in range(10)]
    rows += [(None, 0, "user", "lost"), (5000, 0, "user", "alone"), (-7, 0, "user", "x"), (-10, 0, "user", "y")]
    return rows


@pytest.mark.parametrize("height", [None, 1, 3, 50])
def test_trie_equals_brute_force(spark, height):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit(1), "k1": F.lit("x"), "pos": F.lit(2), "bytes": F.lit(3)})
    got = trie(*rebuilt(turns(df.repartition(5))), height=height).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == trie_brute(sequences_brute(rows))


def test_one_conversation_with_most_rows_is_split(spark):
    """A conversation of 700 turns, some repeated; few enough rounds and no deep explosion."""
    rows = [(3, t, "user", f"turn {t}") for t in range(700)] + [(c, t, "user", f"turn {t}") for c in (1, 2, 8) for t in range(c)]
    got = trie(*rebuilt(turns(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert set(map(tuple, got)) == trie_brute(sequences_brute(rows))


def test_repeated_rows_and_equal_turns_are_turns_of_their_own(spark):
    rows = [(0, 1, "user", "same")] * 30 + [(0, None, "user", "first")] * 2
    got = trie(*rebuilt(turns(spark.createDataFrame(rows, SCHEMA).repartition(6)))).collect()
    assert set(map(tuple, got)) == trie_brute(sequences_brute(rows))


def test_empty_table_and_turnless_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie(*rebuilt(turns(none))).collect() == []
    ids = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:4]
    rows = [(c, 0, "user", "taken away") for c in ids]  # their heads come from absent conversations
    got = trie(*rebuilt(turns(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert set(map(tuple, got)) == trie_brute(sequences_brute(rows)) and len(got) == 1


def test_query_equals_duckdb(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    got = op12_prefix_trie(spark, sf)
    want = con.sql(OP12_SQL)
    assert set(map(tuple, got.select(*want.columns).collect())) == set(want.fetchall())
