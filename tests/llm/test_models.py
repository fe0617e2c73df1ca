"""Language ID, source mixing, main text of pages, LM scoring: brute force, held-out accuracy, odd inputs."""

import itertools
import math
import random
import re
import resource
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ringtrail.llm import attention_lm, common, html_text, language_id, lm_scoring, mixing
from ringtrail.staging import Staging

SMALL = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def stage(spark, tmp_path):
    common.prepare(spark)
    return Staging(spark, str(tmp_path))


# --- language ID ---------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.text("abAé ", max_size=40), st.text("abéz1 ", max_size=40), st.text("abé z", max_size=60))
def test_phrases_equal_greedy_longest_matches(first, second, text):
    coder = language_id.Parser((("x", first), ("y", second)))
    folded = language_id.letters(text)

    def slow(sample):
        # Letters outside all samples share one symbol that no sample has.
        base = "".join(map(chr, language_id.letters(sample)))
        rest, n = "".join(map(chr, folded)), 0
        while rest:
            size = max([k for k in range(1, len(rest) + 1) if rest[:k] in base], default=1)
            rest, n = rest[size:], n + 1
        return n

    got = coder.phrases([folded, folded[:0]])
    assert got[0].tolist() == ([slow(first), slow(second)] if len(folded) else [0, 0])
    assert got[1].tolist() == [0, 0]


def test_sections_begin_new_phrases():
    coder = language_id.Parser((("x", "ab" * 300),))
    text = language_id.letters("ab" * 3 * language_id.SECTION)
    assert 6 <= coder.phrases([text])[0, 0] <= 6 * language_id.SECTION // 600 + 12


def test_language_of_held_out_documents(spark, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sample = language_id.learn(docs)
    rows = docs.select("doc_id", "lang").join(language_id.identify(docs, sample), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held) > 20
    assert all(0 <= r["score"] <= 1 for r in rows)
    # A language is never read from its column, and nothing is learned from held-out documents.
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.col("lang")))
    assert language_id.learn(hidden) == sample


def test_language_odd_inputs(spark, stage):
    schema = "doc_id bigint, text string, lang string, held_out int, lang_pred string, _text int"
    rows = [
        (1, None, "de", 1, "", 1), (2, "", None, 1, "", 1), (3, "12 !?", "de", 1, "", 1), (None, "das ist gut", "de", 1, "", 1),
        (4, "das ist sehr gut und schön", "de", 1, "", 1), (5, "this is very good", "en", 1, "", 1), (5, "this is very good", "en", 1, "", 1),
        (6, "日本語", "en", 1, "", 1), (7, "this is " * 40_000, "en", 1, "", 1), (8, "das ist", None, 1, "", 1),
    ]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    sample = (("de", "das ist sehr gut und schön"), ("en", "this is very good"))
    full = spark.createDataFrame(rows, schema)
    got = language_id.identify(full, sample).collect()
    want = ["und", "und", "und", "de", "de", "en", "en", None, "en", "de"]
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got if r["doc_id"] != 6) == sorted(
        (i or 0, w) for (i, *_), w in zip(rows, want, strict=True) if w
    )
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    kept = language_id.keep_identified(full, sample)
    assert kept.schema == full.schema and kept.count() == 7
    assert {r["lang_pred"] for r in language_id.identify(docs, ()).collect()} == {"und"}
    assert language_id.learn(docs.limit(0)) == () and language_id.identify(docs.limit(0), sample).count() == 0


# --- mixing ------------------------------------------------------------------------------------------


def slow_targets(sizes, share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > limit * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = limit * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("case", ["usual", "few", "empty texts"])
def test_mixing_meets_targets(spark, stage, case):
    rng = random.Random(7)
    names = ["b", "a", None, "Z", "é", "hot", "hot", "hot"]
    rows = [(n, "w " * min(4000, int(rng.paretovariate(0.9) * 5)), rng.choice(names)) for n in range(1500)]
    rows += [(2000, None, "a"), (2001, " \t", "only empty"), (None, "x y", "b"), (3, rows[3][1], rows[3][2]), (3, "w " * 77, rows[3][2]), (2002, "w " * 60_000, "hot")]
    if case == "few":
        rows = [(1, "a b c", "s"), (2, "a", "t"), (2, "a", "t")]
    if case == "empty texts":
        rows = [(1, None, "s"), (2, "", None)]
    extra = [(*r, "x", 1) for r in rows]
    docs = spark.createDataFrame(extra, "doc_id bigint, text string, source string, size string, _row int")
    got = mixing.mix(docs, stage).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    target = slow_targets(sizes)
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
    if case == "usual":
        for s, t in target.items():
            assert taken[s] == pytest.approx(t, rel=0.02, abs=3)
        again = mixing.mix(docs.repartition(5), Staging(spark, stage.root)).collect()
        key = sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in got)
        assert key == sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in again)
        repeated = mixing.repeat_documents(docs, stage)
        assert repeated.schema == docs.schema
        times = Counter(r["doc_id"] for r in repeated.collect())
        assert all(times[r["doc_id"]] == r["copies"] for r in got if r["doc_id"] != 3 and r["size"])


def test_mixing_without_documents(spark, stage):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mix(docs, stage).count() == 0 and mixing.repeat_documents(docs, stage).count() == 0


# --- main text -----------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_cut_is_the_cheapest_labelling(data):
    n = data.draw(st.integers(1, 7))
    cost = st.integers(-12, 12).map(lambda x: x / 4)
    unary = data.draw(st.lists(cost, min_size=n, max_size=n))
    pairs = [(a, b) for a in range(n) for b in range(a)]
    edges = [(a, b, w / 4) for (a, b), w in zip(pairs, data.draw(st.lists(st.integers(0, 6), min_size=len(pairs), max_size=len(pairs))), strict=True)]

    def price(side):
        own = sum((-u if s else u) for u, s in zip(unary, side, strict=True)) / 2
        return own + sum(w for a, b, w in edges if side[a] != side[b])

    best = min(price(s) for s in itertools.product([False, True], repeat=n))
    assert price(html_text.min_cut(unary, edges)) == pytest.approx(best)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<nav><a href="/">Home</a> <a href="/x">News</a></nav><div class="cookie-banner">We use cookies. Accept</div>
<div class="wrapper"><main><article><h1>Tides &amp;
 moons</h1><p>The sea <b>rises</b> twice a day, and every harbour keeps a table of it.</p><script>var a = "<p>no</p>";</script>
<div class="ad">Buy now!</div><p>Short.</p><ul><li>One point of many</li></ul><p>caf&#233; &lt;b&gt;</p></article>
<section id="comments"><p>I think this is a very good article and have read it twice today.</p></section></main>
<aside class="sidebar"><ul><li><a href="a">Other story</a></li></ul></aside></div>
<form><input name=q><button>Search</button></form><footer>Copyright 2024 Someone</footer></body></html>"""


def test_main_text_of_a_page():
    want = "Tides & moons The sea rises twice a day, and every harbour keeps a table of it. Short. One point of many café <b>"
    assert html_text.main_text(PAGE) == want


ARTICLE = "<h1>Tides and moons</h1><p>The sea rises twice a day, and every harbour keeps a table of it.</p><p>Short.</p>"
ARTICLE_TEXT = "Tides and moons The sea rises twice a day, and every harbour keeps a table of it. Short."


@pytest.mark.parametrize(
    "page",
    [
        "<body class='single no-ads'><article>%s</article></body>",
        "<body class='newsletter-popup-enabled'><article>%s</article></body>",
        "<html class='modal-open'><body><article>%s</article></body></html>",
        "<div class='layout with-share-bar'><article>%s</article></div>",
        "<article class='post has-comments'>%s</article>",
        "<main class='overlay-open'>%s</main>",
        "<div class='page-wrapper share'><main><article>%s</article></main></div>",
    ],
)
@pytest.mark.parametrize(
    "rest",
    [
        "",
        "<div class='comments'><article class='comment'><p>I think this is very good and have read it twice.</p></article></div>",
        "<div class='ad-container'><article><p>Buy one of these today, you will never regret it, they say.</p></article></div>",
        "<aside><article><p>Another story that many people read is told on another page.</p></article></aside>",
        "<div class='share-bar'><p>Tell all your friends about it, and your family too.</p></div>",
    ],
)
def test_names_of_wrappers_are_not_names_of_what_they_hold(page, rest):
    assert html_text.main_text(page % ARTICLE + rest) == ARTICLE_TEXT


def test_ties_decide_where_no_names_tell():
    """In a page of plain divisions a short paragraph between long ones is content and a sentence among
    links is not; each block alone says the opposite."""
    long = "This is one of the sentences that an ordinary story has, and there are many more like it in every part."
    links = "".join(f"<div><a href='{k}'>Section number {k}</a></div>" for k in range(4))
    page = f"<div>{links}<div>See all of our parts here today.</div>{links}</div><div><div>{long}</div><div>Not so.</div><div>{long}</div></div>"
    blocks = html_text.blocks_of(page)
    alone = " ".join(b.text for b in blocks if html_text.evidence(b) > 0)
    assert "Not so." not in alone and "See all" in alone
    assert html_text.main_text(page) == f"{long} Not so. {long}"


def test_deep_and_broken_pages_take_linear_time():
    began = time.process_time()
    assert html_text.main_text("<div>word " * 100_000) == ""
    html_text.main_text("<div><p>word </p></x>" * 20_000 + "</p></br>" * 20_000)
    assert html_text.main_text("<article>" + "<div>" * 50_000 + "one two three four five." + "</div>" * 50_000) == "one two three four five."
    assert time.process_time() - began < 30


def test_pages_of_all_kinds(spark, stage):
    rows = [(1, "u", None), (2, None, ""), (3, "u", PAGE), (3, "u", PAGE), (None, "u", "<p>"), (4, "u", "<" * 5000 + "a<b c='"),
            (5, "u", "<div>" * 3000 + "deep text that stays" + "</div>" * 3000), (6, "u", "<article>" + "<p>word " * 50_000)]
    pages = spark.createDataFrame([(*r, "t", 0) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = {(r["page_id"], r["url"]): r for r in html_text.extract(pages).collect()}
    assert html_text.extract(pages).count() == len(rows)
    assert got[1, "u"]["text"] == got[2, None]["text"] == got[None, "u"]["text"] == ""
    assert got[6, "u"]["text"].split() == ["word"] * 50_000
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_text.extract(pages.limit(0)).count() == 0


# --- LM scoring ------------------------------------------------------------------------------------------


def test_texts_have_probabilities_that_sum_to_one():
    model = attention_lm.Model(np.array([0.0, 50.0, 25.0, 25.0]))
    texts = [t for n in range(11) for t in itertools.product([2, 3], repeat=n)]
    chunks = attention_lm.Chunks.of(np.array(list(itertools.chain.from_iterable(texts)), np.int32), np.array(list(map(len, texts))))
    logs = np.bincount(chunks.owner, model.log10(chunks), len(texts))
    assert 0.9 < (10**logs).sum() <= 1.0001


def plain_forward(model, texts):
    """log10 probability of each text by the definition, symbol by symbol, in plain loops."""
    p, chunk, width = model.p, attention_lm.CHUNK, attention_lm.WIDTH

    def soft(x):
        x = max(x, -100.0)
        return 2.0 ** math.floor(x) * (1 + x - math.floor(x))

    out = []
    for text in texts:
        inputs, targets, score = [attention_lm.BEGIN, *text], [*text, attention_lm.END], 0.0
        h = [p["embed"][s].astype(float) for s in inputs]
        qkv = [x @ p["qkv"] for x in h]
        for t, target in enumerate(targets):
            first = max(0, t // chunk * chunk - chunk)
            q = qkv[t][:width] / math.sqrt(width)
            e = [soft(float(q @ qkv[s][width : 2 * width]) + float(p["bias"][t - s])) for s in range(first, t + 1)]
            o = sum(w * qkv[s][2 * width :] for w, s in zip(e, range(first, t + 1), strict=True)) / sum(e)
            g = h[t] + o @ p["out"]
            z = g + np.maximum(g @ p["up"] + p["up_bias"], 0) @ p["down"]
            group, member = divmod(target, model.members)
            for logits, hit in ((z @ p["to_class"] + p["class_bias"], group), (z @ p["to_symbol"][group] + p["symbol_bias"][group], member)):
                shares = [soft(float(x)) for x in logits]
                score += math.log10(shares[hit] / sum(shares))
        out.append(score)
    return out


def random_model(symbols, seed):
    rng = np.random.default_rng(seed)
    model = attention_lm.Model(np.r_[0.0, 20.0, rng.integers(1, 90, symbols - 2)], seed)
    model.p = {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in model.p.items()}
    return model


def random_chunks(symbols, sizes, seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(2, symbols, n).tolist() for n in sizes]
    flat = np.array(list(itertools.chain.from_iterable(texts)), np.int32)
    return texts, attention_lm.Chunks.of(flat, np.array(sizes))


def test_model_equals_plain_loops():
    model = random_model(30, 4)
    texts, chunks = random_chunks(30, [0, 1, 15, 16, 17, 31, 32, 33, 50, 70], 5)
    for batch in (2, 512):  # also where a batch begins inside a text
        got = np.bincount(chunks.owner, model.log10(chunks, batch), len(texts))
        assert np.allclose(got, plain_forward(model, texts), rtol=2e-4, atol=2e-4)


def test_gradients_point_where_the_loss_falls():
    """Along each parameter's own gradient the loss changes as the gradient says."""
    model = random_model(30, 6)
    _, chunks = random_chunks(30, [40, 25, 3, 60], 7)
    loss, gradient = model.gradient(chunks)
    for name, g in gradient.items():
        norm = float(np.sqrt((g.astype(float) ** 2).sum()))
        assert norm > 0, name
        before, step = model.p[name], 0.01 / norm
        ends = []
        for sign in (-1, 1):
            model.p[name] = (before + sign * step * g).astype(np.float32)
            ends.append(model.gradient(chunks)[0])
        model.p[name] = before
        assert (ends[1] - ends[0]) / (2 * step) == pytest.approx(norm**2, rel=0.1), name


def test_steps_ask_for_no_new_memory():
    """Pages that are given back after each step and asked for again were a fifth of the time."""
    model = random_model(3000, 8)
    _, chunks = random_chunks(3000, [4000], 9)
    for work in (lambda: model.gradient(chunks), lambda: model.log10(chunks)):
        for _ in range(8):
            work()
        before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
        for _ in range(10):
            work()
        assert resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before < 10 * 200


ODD = ["a", "Ab", "É", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "\u3000", "\x00", "12", "'s", "日本", "😀", "<|endoftext|>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(ODD), max_size=20).map("".join), max_size=9))
def test_words_are_numbered_and_spelt_once(texts):
    """What a block stores: the words of each text by number, and the ids of each distinct word alone."""
    names, words, sizes = lm_scoring.numbered_words(pa.array(texts, pa.string()))
    names = names.to_pylist()
    want = [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    ends = np.cumsum(sizes)
    assert [[names[k] for k in words[e - n : e]] for e, n in zip(ends, sizes, strict=True)] == want
    assert len(set(names)) == len(names) == len(set(itertools.chain.from_iterable(want)))
    ids, counts = lm_scoring.encode_words(names, RANKS, P.PATTERN)
    encoder = lm_scoring._encoder(RANKS, P.PATTERN)[0]
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [encoder.encode_ordinary(" " + w) for w in names]


def test_scoring_survives_a_change_of_executors(spark, stage):
    """Files are split by the number of cores; blocks are not, however many there are in a later pass."""
    rows = [(k, f"words of {k % 50} and {k} more " * (1 + k % 7)) for k in range(400)]
    path = f"{stage.root}/docs"
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(40).write.parquet(path)
    key = "spark.sql.leafNodeDefaultParallelism"
    found = []
    try:
        for first, then in (("4", "4"), ("4", "64")):
            spark.conf.set(key, first)
            scored = lm_scoring.score(spark.read.parquet(path), stage, RANKS, P.PATTERN)
            spark.conf.set(key, then)
            found.append(sorted((r["doc_id"], r["base_score"], r["n_tokens"]) for r in scored.collect()))
    finally:
        spark.conf.unset(key)
    assert len(found[0]) == 400 and found[0] == found[1]


def test_model_beats_the_base_line_on_held_out_texts(spark, stage):
    docs = common.table(spark, "/root/testdata/sf0.1", "documents")
    held = lm_scoring.score(docs, stage, RANKS, P.PATTERN).where("held_out")
    got = held.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (got[0] - got[1]) / got[2] > 0.05


def test_scores_and_base_line(spark, stage):
    rng = random.Random(2)
    words = ["the", "The", "sea", "moon", "tide,", "é", "x y", "harbour"]
    rows = [(n, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 90)))) for n in range(300)]
    rows += [(400, None), (401, ""), (402, " \n\t"), (None, "the sea"), (5, rows[5][1]), (404, "unheard " * 30_000), (405, "日本\U0001f600\x00")]
    path = f"{stage.root}/docs"
    spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id bigint, text string, score int, held boolean").write.parquet(path)
    docs = spark.read.parquet(path)
    got = lm_scoring.score(docs, stage, RANKS, P.PATTERN).collect()

    def tokens(t):
        return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows}
    seen = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    ends = sum(not held[i] for i, _ in rows)
    n, v = sum(seen.values()) + ends, len(seen) + 1
    want = []
    for i, t in rows:
        c = [seen[w] for w in tokens(t)] + [ends]
        base = sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in c)
        want.append((-1 if i is None else i, held[i], len(c), sum(x > 0 for x in c), n, pytest.approx(base)))
    key = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    have = [(-1 if r["doc_id"] is None else r["doc_id"], *(r[k] for k in key)) for r in got]
    assert sorted(have) == sorted(want, key=lambda w: w[:5])
    assert all(math.isfinite(r["score"]) and r["score"] <= 1e-6 for r in got)


def test_lm_without_documents_and_without_training(spark, stage):
    path = f"{stage.root}/none"
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(path)
    assert lm_scoring.score(spark.read.parquet(path), stage, RANKS, P.PATTERN).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    path = f"{stage.root}/held"
    spark.createDataFrame([(only, "a b")], "doc_id bigint, text string").write.parquet(path)
    row = lm_scoring.score(spark.read.parquet(path), Staging(spark, stage.root), RANKS, P.PATTERN).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0) and math.isfinite(row["score"])
