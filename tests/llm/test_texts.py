"""Substring and suffix dedup, language ID, HTML, LM scoring against brute force or held-out rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, suffixes
from tidemark.llm.chunks import _NUMBERS, cut_text, substring_dedup
from tidemark.llm.html import extract, main_text
from tidemark.llm.langid import keep_identified, language_id
from tidemark.llm.mixture import CLASS_SLOTS, CLASSES, _classes, _first_bytes, classes_of, score
from tidemark.llm.shared import stash
from tidemark.llm.suffixes import cut_repeats, difference_cover, repeated_spans, suffix_dedup
from tidemark.llm.textkit import prefix_hash, shingles, slices, span_hash, word_hashes
from tidemark.llm.textkit import words as token_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    make = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(n))
    passage, other = make(90), make(40)
    out = [make(120) for _ in range(20)]
    out += [make(30) + " " + passage + " " + make(20), passage + make(50), make(10) + passage, make(60) + other + make(30), make(9) + other]
    out += [out[0], out[0], out[1][:300] + "X" + out[1][300:], "a" * 3000, "a" * 399, "ab" * 700, "é" * 500 + "x" * 100, "q" + "é" * 500, None, "", "  ", out[2] + " " + out[2]]
    return list(enumerate(out))


def cover_brute(rows, width):
    raw = {i: (t or "").encode() for i, t in rows}
    seen = collections.Counter(t[k : k + width] for t in raw.values() for k in range(len(t) - width + 1))
    out = {}
    for i, t in raw.items():
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - width + 1):
            if seen[t[k : k + width]] > 1:
                gone[k : k + width] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[i] = (len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("width", [100, 400])
def test_suffix_dedup(spark, texts, width):
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("sha", F.lit("x"))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(docs, width).collect()}
    assert got == cover_brute(texts, width)


def test_suffix_dedup_of_crowded_anchors(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = {r.sha: r.n_removed for r in repeated_spans(docs, 100)[1].collect()}
    assert {r.sha: r.n_removed for r in repeated_spans(docs, 100, hot=1)[1].collect()} == want


def test_suffix_dedup_takes_repeated_rows_once(spark, texts, monkeypatch):
    many = []

    def spy(df, name, keep=False):
        out = stash(df, name, keep)
        if name == "candidates":
            many.append(out.groupBy("id", "tid").count().where("count > 1").count())
        return out

    monkeypatch.setattr(suffixes, "stash", spy)
    rows = [*texts, *[(None, texts[0][1])] * 20, *[(21, texts[21][1])] * 20]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.n_removed, r.kept_sha256) for r in suffix_dedup(docs, 100).collect())
    assert many == [0]
    brute = cover_brute(list(enumerate(t for _, t in rows)), 100)
    assert got == collections.Counter((rows[i][0], n, sha) for i, (_, n, _, sha) in brute.items())


def test_cut_repeats_keeps_columns_and_clean_rows(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long")).withColumn("kept", F.lit(7))
    out = cut_repeats(docs, 100)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    for i, t in texts[3:20]:
        assert got[i].text == t and got[i].n_chars == len(t) and got[i].kept == 7
    assert 0 not in got and got[33].text is None if texts[33][1] is None else True  # all of a copy goes; a null text stays
    assert cut_repeats(docs.where("doc_id < 0"), 100).count() == 0


@pytest.mark.parametrize("period", [2, 5, 64, 200])
def test_difference_cover(period):
    d = difference_cover(period)
    assert {int((a - b) % period) for a in d for b in d} == set(range(period))


def chunk_brute(t):
    out, last, h = [], 0, 0
    for c, b in enumerate(t, 1):
        h = ((h << 1) + int(_NUMBERS[b])) & 0xFFFFFFFF
        if h >> 27 == 0 and c >= 32 and c - last >= 16:
            while c - last > 512:
                last += 512
                out.append(last)
            if c - last >= 16:
                out.append(c)
                last = c
    while len(t) - last > 512:
        last += 512
        out.append(last)
    return out + [len(t)] * (len(t) > last)


def test_gear_chunks(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    seen, want = set(), {}
    for i, t in texts:
        t = (t or "").encode()
        ends, last, spans, run = chunk_brute(t), 0, [], []
        for e in [*ends, None]:
            if e is not None and t[last:e] in seen:
                run.append((last, e))
            else:
                if run and run[-1][1] - run[0][0] >= 64:
                    spans.append((run[0][0], run[-1][1]))
                run = []
            if e is not None:
                seen.add(t[last:e])
                last = e
        want[i] = (len(t), len(ends), spans)
    got = substring_dedup(docs)
    assert {r.doc_id: (r.n_bytes, r.n_chunks, [(x.s, x.e) for x in r.spans]) for r in got.collect()} == want
    assert len(want[5][2]) == 0 and want[21][2] and want[25][2] == [(0, want[25][0])]
    text = {r.doc_id: r.text for r in cut_text(docs, got).collect()}
    for i, t in texts:
        raw = (t or "").encode()
        for s, e in reversed(want[i][2]):
            raw = raw[:s] + raw[e:]
        assert text[i] == raw.decode("utf-8", "ignore")


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "12 !! ++", "de"), (-4, "…— ¿", None)], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").union(more).withColumn("score", F.lit("clash"))
    got = language_id(both).join(both.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.doc_id >= 0]
    assert len(held) > 20 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id < 0} == {-1: "und", -2: "und", -3: "und", -4: "und"}
    kept = keep_identified(both)
    assert kept.columns == both.columns and kept.where("doc_id < 0").count() == 0 and kept.count() >= 0.98 * docs.count()
    bare = both.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id(bare).collect()} == {"und"} and keep_identified(bare).count() == both.count()


PAGES = [
    (None, ""),
    ("", ""),
    ("just &amp; text", "just & text"),
    ("<p>one<p>two", "one two"),
    ("<html><head><title>T</title></head><body><nav><a href=x>menu</a></nav><article><header><h1>Head</h1></header><p>First <b>bo</b>ld&nbsp;text.<br>More</p><p>Second\n\n para</p></article><footer>foot</footer></body></html>", "Head First bold text. More Second para"),
    ("<body><div class='sidebar'>side</div><div id=content><p>Hello world, this is a long paragraph.</p><p>And this is another one.</p><div class='share-box'>share</div></div><div id=comments><p>reader</p></div></body>", "Hello world, this is a long paragraph. And this is another one."),
    ("<article><script>if (a < b) x = '</p>';</script><style>p{}</style><p>Kept</p><form>name <input></form><div class='ad'>buy</div></article>", "Kept"),
    ("<article><p>open <i>never closed<p>next &lt;tag&gt;</article><aside>x</aside>", "open never closed next <tag>"),
]


def test_language_sample_keeps_rare_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "ROWS_PER_LANG", 40), monkeypatch.setattr(langid, "MAX_ROWS", 120)
    names = [f"l{i}" for i in range(6)]
    rows = [(1000 * k + i, f"{n} words {i}", n) for k, n in enumerate(names) for i in range(900)]
    rows += [(10**6 + i, f"rare words {i}", "rare") for i in range(12)]
    seen = []

    class Net(langid.ByteNet):
        def fit(self, x, y):
            seen.append(collections.Counter(np.array(self.langs)[y].tolist()))

    monkeypatch.setattr(langid, "ByteNet", Net)
    langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(seen[0]) == {*names, "rare"} and seen[0]["rare"] >= 12 and all(seen[0][n] >= 17 for n in names)


def test_html_extraction(spark):
    for page, want in PAGES:
        assert main_text(page) == want
    df = spark.createDataFrame([(i, "u", p) for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted((r.page_id, r.text, r.n_chars) for r in extract(df).collect()) == [(i, w, len(w)) for i, (_, w) in enumerate(PAGES)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<body><div><p class=ad>buy<p>Article one</p><p>Article two</p></div></body>", "Article one Article two"),
        ("<body><p class=notice>note<div>Article <b>one</b></div><p>Article two</body>", "Article one Article two"),
        ("<body><ul><li class=share>Share<li>Article one<li>Article two</ul></body>", "Article one Article two"),
        ("<body><ul><li class=share><a href=x>Share<li>Article one<li>Article two</ul></body>", "Article one Article two"),
        ("<body><div><div><span class=ad>buy</div><p>Article one</p></div></body>", "Article one"),
        ("<body><table><tr class=ad><td>buy<tr><td>Article one<td>Article two</table></body>", "Article one Article two"),
        ("<html><head><title>T</title><meta name=x><body><p>Article one</p></body></html>", "Article one"),
        # what stood between the tags of boilerplate stays out
        ("<body><aside><table><tr><td>buy</aside><p>Article one</p></body>", "Article one"),
        ("<body><nav><article><p>menu</nav><p>Article one</p></body>", "Article one"),
        ("<body><b><div class=ad>buy</b> now</div><p>Article one</p></body>", "Article one"),
        ("<body><div class=ad><div>buy</div> now<svg/></div><p>Article one</p><svg></svg></body>", "Article one"),
        ("<body><p>Article <button><div>share</div></button>one</p></body>", "Article one"),
    ],
)
def test_html_of_unclosed_boilerplate(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<body><div class='layout no-sidebar'><article><p>One</p><p>two</p></article></div></body>", "One two"),
        ("<body><div id='main-with-comments'><article><p>One</p></article></div></body>", "One"),
        ("<body><div class=sidebar-layout><div class='page-menu-x'><article><p>One two three</p></article></div></div><p>x</p></body>", "One two three"),
        ("<p title=it's>Hello there</p><p>don't stop</p><p>last</p>", "Hello there don't stop last"),
        ("<body><div data-class=menu data-id='comment' title='class=menu'><p>One</p></div></body>", "One"),
        ("<body><div><p title='a > b' alt=\"c > d\">One</p></div></body>", "One"),
        # what is boilerplate stays cut, however long it is
        ("<body><article><p>One</p></article><section class=comments><article>long long long comment of a reader</article></section></body>", "One"),
        ("<body><article><p>One</p></article><div class=cookie-notice><p>We use very many cookies, really many</p></div></body>", "One"),
        ("<body><article><p>One of a kind</p></article><div class=promo><article>Buy</article></div></body>", "One of a kind"),
        ("<body><div class='sidebar sidebar-collapsed'><p>links here and there</p></div><div><p>One</p></div></body>", "One"),
        ("<body><div class=sidebar-left><a href=x><article>teaser teaser teaser</article></a></div><div><p>One</p></div></body>", "One"),
    ],
)
def test_html_of_doubtful_words_and_quotes(page, want):
    assert main_text(page) == want


def test_html_of_deep_and_long_pages():
    deep = "<div>" * 20000 + "<p>One</p>" + "</div>" * 20000
    assert main_text(f"<body>{deep}</body>") == "One"
    long_ = " ".join(["word"] * 300_000)
    assert main_text(f"<body><nav>{long_}</nav><article><p>{long_}</p></article></body>") == long_
    assert main_text("<body><p>a</p>" + "<b x='" * 50_000 + "</body>") is not None


def test_html_of_repeated_rows_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>One</p>"), (1, "u", "<p>One</p>"), (None, None, "<p>Two</p>"), (2, "v", None)], "page_id long, url string, html string")
    got = extract(df.withColumn("n_chars", F.lit(7))).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "Two", 3), (1, "One", 3), (1, "One", 3), (2, "", 0)]
    assert extract(df.where("false")).collect() == []


def test_html_of_the_pages_table(spark):
    import html

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        plain = re.sub(r"<[^>]*>", lambda m: "" if re.match(r"</?b\b(?!r)", m[0]) else " ", inner)
        assert main_text(r.html) == " ".join(html.unescape(plain).split())


def test_lm_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, " \t"), (5, "the The THE unseen" + "z" * 40)], docs.schema)).withColumn("score", F.lit(1))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = score(docs, ~held).collect()
    rows = docs.collect()
    words = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({65 + i: 97 + i for i in range(26)})), None]
    is_held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    count = collections.Counter(w for r in rows if not is_held(r.doc_id) for w in words(r.text))
    n, v = sum(count.values()), len(count)
    want = sorted((r.doc_id, len(words(r.text)), sum(count[w] > 0 for w in words(r.text)), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words(r.text)), 4)) for r in rows)
    assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(r.train_tokens == n and r.held_out == is_held(r.doc_id) and r.score < 0 for r in got)
    # better than coding the bytes evenly, by far, on texts that the model has not seen
    text = {r.doc_id: r.text or "" for r in rows}
    unseen = [r for r in got if r.held_out and r.doc_id != 5]
    assert sum(-r.score for r in unseen) / math.log10(2) < 3.5 * sum(len(text[r.doc_id].encode()) for r in unseen)
    assert score(docs.where("doc_id = -99"), ~held).count() == 0
    assert {r.train_tokens for r in score(docs.limit(3), F.lit(False)).collect()} == {0}


def test_lm_classes_learn_from_whole_texts(spark):
    rng = np.random.default_rng(8)
    common = [f"c{i}" for i in range(40)]
    kinds = [[f"{k}{i}" for i in range(20)] for k in ("left", "right")]
    filler = lambda: " ".join(rng.choice(common, 1500))  # noqa: E731  over 4000 characters
    rows = [(i, filler() + " " + " ".join(rng.choice(kinds[i % 2], 400))) for i in range(80)] + [(80, ""), (81, "c1")]
    log = _classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert log.shape == (CLASSES, CLASS_SLOTS) and np.allclose(np.exp(log).sum(1), 1)

    def kind(ws):
        buf = np.frombuffer(" ".join(ws).encode(), np.uint8)
        start, end, doc = token_spans(buf, np.array([0, len(buf)]))
        return int(classes_of(log, span_hash(prefix_hash(buf), start, end), doc, 1)[-1])

    tails = [{kind(rng.choice(k, 50)) for _ in range(20)} for k in kinds]
    assert not tails[0] & tails[1]


def test_lm_tells_previous_words_apart():
    buf = np.frombuffer(" ".join(f"w{i}" for i in range(600)).encode(), np.uint8)
    start, end, doc = token_spans(buf, np.array([0, len(buf)]))
    log = np.zeros((CLASSES, CLASS_SLOTS))
    token, _, _ = _first_bytes(log, buf, start, doc, span_hash(prefix_hash(buf), start, end), 1)
    assert len(np.unique(token // 256)) > 400  # 600 words in 1023 slots: some share one


def test_lm_counts_the_beginnings_of_all_words():
    from types import SimpleNamespace

    import pyarrow as pa

    from tidemark.llm.mixture import BITS, RANGES, _add_counts, _emit_words, huffman

    words = [f"word{i}" for i in range(300)]
    text = np.frombuffer("".join(w + " " for w in words).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
    keys = span_hash(prefix_hash(text), off[:-1], off[1:] - 1)
    tree = huffman(np.bincount(text, minlength=256))
    parts = list(_add_counts(SimpleNamespace(value=tree))([_emit_words(keys, np.arange(300) + 1, text, off, 8)]))
    flat = np.concatenate([np.frombuffer(p["sums"][0].as_py(), np.float32) for p in parts])
    assert len(parts) == RANGES and isinstance(parts[0], pa.RecordBatch)
    sums = [t.sum() for t in np.split(flat, np.cumsum([2 << b for b in BITS])[:-1])]
    inner = np.ones(len(text), bool)
    inner[off[:-1]] = False
    times = np.repeat(np.arange(300) + 1, np.diff(off))
    assert set(sums) == {(tree[0][text] * times)[inner].sum()}  # every predictor counts every bit, the whole beginning too


def test_lm_first_bytes_are_mixed():
    from types import SimpleNamespace

    from tidemark.llm.mixture import SLOTS, _train_first, first_byte_table, first_mixer, huffman

    starts = np.zeros((CLASSES, SLOTS, 256), np.int64)
    for slot in range(SLOTS):  # by the slot one byte is sure, by the class alone it is not
        starts[slot % CLASSES, slot, 97 + slot % 7] = 3
    tree = huffman(starts.sum((0, 1)))
    import pyarrow as pa

    rows = [(-1 - n, part.tobytes()) for n, part in enumerate(starts.reshape(64, -1))]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "counts"])
    got = [r for r in _train_first(SimpleNamespace(value=tree), SimpleNamespace(value=starts.sum(1)))([batch])]
    mixer = first_mixer().average(np.frombuffer(got[0]["sums"][0].as_py(), np.float32))
    likely = lambda m: (first_byte_table(tree, starts, m).reshape(starts.shape) * starts).sum()
    assert np.allclose((10.0 ** first_byte_table(tree, starts, mixer)).reshape(-1, 256).sum(1), 1, atol=1e-3)
    assert likely(mixer) > likely(first_mixer())


def test_words_and_shingles():
    import pyarrow as pa

    column = pa.array(["A b\tc  d", None, "", " x ", "é\x0bÉ a b c"])
    hashes, counts = [], []
    for _, _, buf, off in slices(column, 5):
        h, c = word_hashes(buf, off)
        hashes.append(h)
        counts += c.tolist()
    assert counts == [4, 0, 0, 1, 5]
    h = np.concatenate(hashes)
    assert h[0] == h[7] and h[1] == h[8] and h[5] != h[6]  # only A-Z is lower-cased
    assert [len(s) for s in shingles(h, np.array(counts), 3)] == [2, 0, 0, 1, 3]


def test_language_sample_by_slices_is_the_least_hashes(spark):
    from tidemark.llm.langid import _least

    # languages of very different sizes; ids that repeat share their hash
    rows = [("aa", i % 700) for i in range(3000)] + [("bb", i) for i in range(5)] + [("cc", 7)] * 400 + [("dd", -i) for i in range(150)]
    df = spark.createDataFrame(rows, "lang string, doc_id long").withColumn("hash_", F.xxhash64("doc_id"))
    want, got = {}, {}
    for out, frame in ((want, df), (got, _least(df.select("lang", "hash_"), 100))):
        for r in frame.select("lang", "hash_").collect():
            out.setdefault(r.lang, []).append(r.hash_)
    assert {k: sorted(v)[:100] for k, v in want.items()} == {k: sorted(v)[:100] for k, v in got.items()}
    assert len(got["cc"]) == 100 and len(got["bb"]) == 5 and len(got["aa"]) < 3000
    assert _least(df.limit(0).select("lang", "hash_"), 100).count() == 0


def test_kept_rows_are_judged_a_part_of_a_batch_at_a_time(monkeypatch):
    """Each part is as if it were a batch of its own; no row is lost or moved."""
    from types import SimpleNamespace

    import pyarrow as pa

    from tidemark.llm import langid

    net = langid.ByteNet(["a", "b"])
    texts = [None if i % 7 == 3 else f"text {i} äö" * (i % 5) for i in range(50)]
    batch = pa.record_batch({"doc_id": pa.array(range(50), pa.int64()), "text": pa.array(texts, pa.string())})
    state = SimpleNamespace(value=net.state())
    whole = pa.Table.from_batches(langid._keep(state, 0.0)([batch])).to_pydict()
    monkeypatch.setattr(langid, "KEEP_ROWS", 8)
    parts = list(langid._keep(state, 0.0)([batch]))
    assert len(parts) == 7 and max(len(p) for p in parts) <= 8
    assert pa.Table.from_batches(parts).to_pydict() == whole and whole["doc_id"] == [i for i, t in enumerate(texts) if t]


def test_suffix_workers_get_small_batches(spark, monkeypatch):
    """Workers got 10 000 whole texts at a time."""
    most, kept = spark.sparkContext.accumulator(0), suffixes._anchor_rows

    def watched(width):
        work = kept(width)

        def rows(batches):
            def seen():
                for b in batches:
                    most.add(int(len(b) > 1024))
                    yield b

            yield from work(seen())

        return rows

    monkeypatch.setattr(suffixes, "_anchor_rows", watched)
    texts = [" ".join(f"{i // 2 * 31 + k}" for k in range(40)) + f" end{i}" for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    mode = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = suffix_dedup(docs, 100).collect()
    assert len(got) == 3000 and all(r.n_removed >= 100 for r in got)
    assert not most.value and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == mode
