"""Importance resampling against a brute-force version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm.resampling import _scanner, ranked, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    own, want = Counter(), Counter()
    for _, t in docs:
        own.update(runs(t)[1])
    for t in target:
        want.update(runs(t)[1])
    s, t = sum(own.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (s + 10000) / ((own[b] + 1) * (t + 10000))))
    out = []
    for i, text in docs:
        words, ids = runs(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, ids))
        out.append([i, len(ids), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words) >= 20])
    fit = sorted((x for x in out if x[5]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    for r, x in enumerate(fit[: 5 * len(fit) // 100], 1):
        x[4] = r
    return sorted((tuple(x[:5]) for x in out), key=str)


def test_resampling_equals_brute_force(spark):
    rnd = random.Random(1)
    vocabulary = ["The", "çà", "a1", "x", "WORD", "Éa", "日本", "zz", "don't", "q"] + [f"w{i}" for i in range(300)]
    text = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice([" ", "  ", "\n", ", ", "--", "\x00", "."]) for _ in range(n))
    docs = [(i, text(rnd.randint(0, 90))) for i in range(500)]
    docs += [(None, text(40)), (None, text(50)), (600, None), (601, ""), (602, "\t .,\x7f"), (603, "one"), (7, docs[7][1]), (8, text(60))]
    target = [text(100), None, "", "The çà a1"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"rank": F.lit(1), "ids": F.lit("x"), "row": F.lit(2), "part": F.lit(0), "n_words": F.lit(5)})
    got = resample(df.repartition(7), spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target)


def test_very_long_text_and_no_target(spark):
    long = " ".join(f"w{i % 5003}," for i in range(300_000))  # about 2 MB
    docs = [(1, long), (2, "a " * 30), *((i, f"text number {i} " * 9) for i in range(3, 43))]
    got = resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, [])


def test_empty_tables(spark):
    assert resample(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([("x",)], "text string")).collect() == []


@pytest.mark.parametrize("text", ["", " ", "a", "A b", " a  b\tc-d ", "é È ß_x", "1 2 3 4 5 6", None])
def test_scan_emits_every_run_once(text):
    ids, n = _scanner()(text)
    words, want = runs(text)
    assert n == len(words) and sorted(ids) == sorted(want)


def test_ranks_of_equal_scores_over_partitions(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 3).alias("score"))
    got = ranked(rows.repartition(9), [F.desc("score"), F.col("id")]).collect()
    order = sorted(range(5000), key=lambda i: (-(i % 3), i))
    assert {r.id: r["rank"] for r in got} == {i: k for k, i in enumerate(order, 1)}
