"""Ranked search, resampling and nearest neighbours against brute force, and odd inputs."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ringtrail.llm import lexical_search, nearest, resampling
from ringtrail.staging import Staging

DOCS = "doc_id bigint, text string, _id string, _q int, score string, rank string, term int"


@pytest.fixture
def stage(spark, tmp_path):
    from ringtrail.llm.common import prepare

    prepare(spark)
    return Staging(spark, str(tmp_path))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z", 2) for i, t in rows], DOCS)


def items(spark, rows):
    return spark.createDataFrame([(i, t, 3, "w") for i, t in rows], "item_id bigint, text string, _q int, terms string")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def made_up(seed, n, words=60):
    rng = random.Random(seed)
    return [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(rng.randint(0, 40)))) for i in range(n)]


ODD = [
    (7, None), (8, ""), (9, " \t\n"), (1, "a b"), (3, "A b!"), (2, "a b"), (2, "a b"), (None, "a b"), (None, "a-b"),
    (5, "long b " * 40_000), (4, "zoë ZOË \x1fq"), (11, "日本 a"), (12, "_a_"),
]


# --- ranked lexical search -----------------------------------------------------------------


def ranked(rows, asked, top=10):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    bags = [(i, re.findall(pattern, lower(t))) for i, t in rows]
    bags = [(i, b) for i, b in bags if b]
    n_docs, all_terms = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in asked:
        terms = set(re.findall(pattern, lower(text)))
        scored = []
        for i, b in bags:
            m = 10 + 90 * len(b) * n_docs // all_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b.count(t) // (1000 * b.count(t) + 8 * m))
                for t in terms & set(b)
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(scored[:top], 1)]
    return sorted(map(repr, out))


ASKED = [(1, "a b"), (2, None), (3, ""), (4, "nothing here"), (5, "zoë q long"), (None, "B"), (5, "w1 w2 w3 w1"), (5, "w1 w2 w3 w1")]


@pytest.mark.parametrize("rows", [ODD, [], made_up(1, 900), [(i % 7, "w1 w2 same text") for i in range(500)]])
def test_search_equals_brute_force(spark, stage, monkeypatch, rows):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", 128)
    got = lexical_search.search(docs(spark, rows), items(spark, ASKED), stage)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == ranked(rows, ASKED)


def test_search_in_turns_and_without_queries(spark, stage, monkeypatch):
    monkeypatch.setattr(lexical_search, "QUERY_TERMS", 5)
    rows, asked = made_up(2, 300), [(k, f"w{k} w{k + 1} w{2 * k}") for k in range(20)]
    got = lexical_search.search(docs(spark, rows), items(spark, asked), stage)
    assert sorted(repr(tuple(r)) for r in got.collect()) == ranked(rows, asked)
    assert lexical_search.search(docs(spark, rows), items(spark, []), stage).collect() == []


def shard_of(rng, n, terms, queries):
    vocabulary = {str(t).encode(): t for t in range(terms)}
    asked = lexical_search.Asked(list(range(len(queries))), [np.array(q, np.int64) for q in queries], vocabulary)
    rows = []
    for k in range(n):  # most terms of one of the queries, and others
        held = np.unique(np.where(rng.random(8) < 0.9, queries[k % len(queries)], rng.integers(0, terms, 8)))
        rows.append((held, rng.integers(60, 100, len(held))))
    return lexical_search.Shard.build(list(range(n)), rows, asked, block=16), asked


def test_bounds_hold_and_blocks_are_skipped():
    """No document of a block scores above its bound, every document with a term is in a block, and a
    threshold at the tenth best score leaves most blocks closed without changing the result."""
    rng = np.random.default_rng(5)
    queries = [np.sort(rng.choice(120, 8, replace=False)) for _ in range(30)]
    shard, asked = shard_of(rng, 1500, 120, queries)
    shard = lexical_search.Shard.from_bytes(shard.ids, shard.to_bytes())
    weights = rng.integers(20, 50, 120)
    searcher = lexical_search.Searcher(shard, asked, weights)
    table = shard.table(120)
    opened = total = 0
    for q, terms in enumerate(asked.terms):
        scores = table[:, terms].astype(np.int64) @ weights[terms]
        blocks, bounds = searcher.bounds(q)
        held = set()
        for b, bound in zip(blocks.tolist(), bounds.tolist(), strict=True):
            members = shard.doc[(shard.doc_end[b - 1] if b else 0) : shard.doc_end[b]]
            assert scores[members].max() <= bound
            held |= set(members.tolist())
        assert held == set(np.flatnonzero((table[:, terms] > 0).any(axis=1)).tolist())
        limit = int(np.sort(scores)[-10])
        best = np.lexsort((np.arange(1500), -scores))[:10]
        got, value = searcher.search(q, limit, 10)
        assert got.tolist() == best.tolist() and value.tolist() == scores[best].tolist()
        opened += int((bounds >= limit).sum())
        total += len(bounds)
    assert opened < total / 2


# --- importance resampling -----------------------------------------------------------------


def resampled(rows, target, percent=10, least=20, longest=1):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def buckets(text):
        words = re.findall(pattern, lower(text))
        runs = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
        return [zlib.crc32(r.encode()) % 10_000 for r in runs], len(words)

    s, t = [0] * 10_000, [0] * 10_000
    for count, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for b in buckets(x)[0]:
                count[b] += 1
    whole = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (whole[0] + 1e4) / ((a + 1) * (whole[1] + 1e4)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, x in rows:
        found, words = buckets(x)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), words >= least])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): k for k, r in enumerate(order[: percent * len(order) // 100], 1)}
    return sorted(repr((*r[:4], rank.get(id(r)))) for r in out)


def long_rows(n):
    return [(i, f"{t} " + "more words " * 12) for i, t in made_up(3, n)]


@pytest.mark.parametrize(
    "rows", [ODD, [], long_rows(400), [(5, "the same row " * 9)] * 120 + long_rows(60), [(None, "no id at all " * 8)] * 40 + long_rows(30)]
)
@pytest.mark.parametrize("slack", [resampling.SLACK, 1e-9])
def test_resample_equals_brute_force(spark, stage, rows, slack):
    target = ["w1 w2 w3 w1", None, ""]
    got = resampling.resample(docs(spark, rows), items(spark, list(enumerate(target))), stage, percent=25, least_words=10, slack=slack)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.simpleString() for f in got.schema} == {"bigint"}
    assert sorted(repr(tuple(r)) for r in got.collect()) == resampled(rows, target, 25, 10)


def test_longer_runs_and_empty_target(spark, stage):
    rows = long_rows(80)
    got = resampling.resample(docs(spark, rows), items(spark, []), stage, longest=2)
    assert sorted(repr(tuple(r)) for r in got.collect()) == resampled(rows, [], longest=2)


def test_bracket_widens_until_it_holds_the_cutoff(spark):
    """The sketch is off by up to its error; the counts outside still decide."""
    scored = spark.range(5000).selectExpr("cast(floor(id / 500) as bigint) score")
    for wanted in (1, 499, 500, 501, 2500, 4999, 5000):
        low, high, above = resampling.bracket(scored, 5000, wanted, 1e-9)
        scores = sorted((r["score"] for r in scored.collect()), reverse=True)
        assert low <= scores[wanted - 1] <= high
        assert above == sum(s > high for s in scores) < wanted


# --- nearest neighbours --------------------------------------------------------------------


VECTORS = "vec_id bigint, embedding array<double>, label int, h string, q int, ids string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, "y") for i, v in rows], VECTORS)


def neighbours(rows, every, top=10):
    """Exact answers per query id; for unique ids."""
    valid = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for i, v in valid:
        if i % every == 0:
            near = sorted((float(nearest.distances(v[None], w[None])[0]), j) for j, w in valid if j != i and len(w) == len(v))
            out[i] = [(j, d) for d, j in near[:top]]
    return out


def answers(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r)
        assert r["rank"] == len(out[r["query_id"]])
    return out


def gaussian(n, width, seed=1):
    return [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, width)))]


@pytest.mark.parametrize(("n", "width", "every"), [(3000, 64, 50), (1500, 20, 20), (600, 768, 10), (2000, 3, 25)])
def test_recall_against_brute_force(spark, stage, n, width, every):
    rows = gaussian(n, width)
    got, want = answers(nearest.search(vectors(spark, rows), stage, every=every)), neighbours(rows, every)
    assert got.keys() == want.keys()
    hits = 0
    for q, near in want.items():
        exact = dict(near)
        assert len(got[q]) == 10
        for r in got[q]:
            assert exact.get(r["vec_id"], r["score"]) == r["score"]
        hits += len(exact.keys() & {r["vec_id"] for r in got[q]})
        order = [(r["score"], r["vec_id"]) for r in got[q]]
        assert order == sorted(order)
    assert hits / (10 * len(want)) >= 0.9


def test_copies_ties_and_odd_vectors(spark, stage):
    """Small tables are searched whole, so that the answers are the exact ones."""
    odd = [
        (None, [1.0, 2.0]), (1000, None), (1001, []), (1002, [0.0, 0.0]), (1003, [float("nan"), 1.0]), (1004, [None, 1.0]),
        (1005, [float("inf"), 1.0]), (1006, [1e200, 1e200]), (1007, [1e-200, 0.0]), (1010, [-0.0, 1.0]), (1011, [0.0, 1.0]),
        (1020, [1.0, 2.0, 3.0]), (1030, [1.0, 2.0, 3.5]), (1040, [5.0]),
    ]
    copies = [(i, [1.0, 1.0]) for i in range(300)] + [(300 + i, [1.0, 1.0 + i / 64]) for i in range(1, 30)]
    rows = odd + copies
    got, want = answers(nearest.search(vectors(spark, rows + copies[:20]), stage, every=10)), neighbours(rows, 10)
    for q, near in want.items():
        assert [(r["vec_id"], r["score"]) for r in got.get(q, [])] == near, q
    assert got.keys() == {q for q, near in want.items() if near}
    empty = nearest.search(vectors(spark, []), stage)
    assert empty.collect() == [] and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_large_cells_are_cut(spark, stage, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 16)
    rows = [(i, [1.0, 0.1 + i / 1e4, 0.2]) for i in range(700)] + [(i, v) for i, v in ((900, [0.0, 0.0, -1.0]), (910, [0.0, -1.0, 0.0]))]
    got, want = answers(nearest.search(vectors(spark, rows), stage, every=10)), neighbours(rows, 10)
    found = sum(len({r["vec_id"] for r in got[q]} & {j for j, _ in near}) for q, near in want.items())
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert found >= 0.9 * sum(map(len, want.values()))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(0, 2**32 - 1))
def test_rotations_keep_lengths_and_codes_are_probed_first(width, seed):
    """A vector's own bucket is the first that a query equal to it probes."""
    x = np.random.default_rng(seed).normal(size=(5, width))
    units = nearest.padded(x)
    code, axes = nearest.codes(units), nearest.second_axes(units.shape[1])
    for t in range(nearest.TABLES):
        first, most, least = nearest.thresholds(units, 1, t)
        own = code[:, t] // axes
        assert np.allclose((first**2).sum(axis=1), 2)
        assert (first[np.arange(5), own] + most >= least).all()
        assert (first.argmax(axis=1) == own).all()
