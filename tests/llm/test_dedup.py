"""Exact and near duplicates of texts and embeddings against brute force, and odd inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from ringtrail.llm import components, embedding_dedup, exact_dedup, simhash
from ringtrail.staging import Staging

DOCS = "doc_id bigint, text string, _id string, _sha int, _doc string, kept string, _place int"


@pytest.fixture
def stage(spark, tmp_path):
    from ringtrail.llm.common import prepare

    prepare(spark)
    return Staging(spark, str(tmp_path))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z", 2) for i, t in rows], DOCS)


ODD = [
    (7, None), (8, ""), (9, "  \t\n"), (1, "a b"), (2, "a  b"), (3, "a b"), (2, "a  b"), (None, "a b"),
    (5, "long " * 40_000), (4, "long " * 40_000), (None, "only"), (None, "only"), (10, "Zoë\x1fq"), (11, " a b"),
]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected_exact(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(normal(t), []).append((i is None, i if i is not None else 0, k))
    out = []
    for text, members in groups.items():
        first = min(members)
        for none, i, k in members:
            keep = None if first[0] else first[1]
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((None if none else i, keep, len(members), (none, i, k) == first, digest))
    return sorted(map(repr, out))


@pytest.mark.parametrize("rows", [ODD, [], [(i % 50, f"t{i % 37}") for i in range(900)]])
def test_exact_dedup(spark, stage, rows):
    got = exact_dedup.exact_dedup(docs(spark, rows).coalesce(1), stage).collect()
    assert sorted(repr(tuple(r)) for r in got) == expected_exact(rows)


def test_drop_copies_keeps_columns_and_one_row_each(spark, stage):
    source = stage(docs(spark, ODD), "docs")
    kept = exact_dedup.drop_copies(source, stage)
    assert kept.schema.names == source.schema.names
    got = sorted((repr(r["doc_id"]), normal(r["text"])) for r in kept.collect())
    groups = {}
    for i, t in ODD:
        groups.setdefault(normal(t), []).append((i is None, i or 0))
    assert got == sorted((repr(None if min(m)[0] else min(m)[1]), t) for t, m in groups.items())


def test_unique_texts_are_not_flagged(spark, stage):
    """Next to all texts without a copy pass the filter by."""
    rows = stage(spark.range(20_000).selectExpr("sha2(cast(id as string), 256) _sha"), "digests")
    cells, bitmaps = exact_dedup.repeat_filter(rows, stage)
    assert exact_dedup.flagged(rows, cells, bitmaps).where("_again").count() < 800
    twice = stage(rows.union(rows), "twice")
    cells, bitmaps = exact_dedup.repeat_filter(twice, stage)
    assert exact_dedup.flagged(twice, cells, bitmaps).where("_again").count() == 40_000


# --- SimHash -----------------------------------------------------------------------------------


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [find(k) for k in range(n)]


def near_texts():
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(300)) for _ in range(6)]
    rows = []
    for n in range(90):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "x"
        rows.append((n, " ".join(words) if n % 9 else words[0].upper() + "  " + words[1]))
    return [*rows, (200, None), (201, ""), (199, " \n "), (3, rows[3][1]), (202, "One"), (203, "one two"), (204, "ONE")]


def test_simhash_equals_brute_force(spark, stage):
    rows = near_texts()
    got = simhash.simhash_groups(docs(spark, rows), stage).collect()
    prints = [slow_fingerprint(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    root = classes(len(rows), linked)
    first = {}
    for (i, _), r in zip(rows, root, strict=True):
        first[r] = min(first.get(r, i), i)
    want = sorted((i, f"{p:016x}", first[r]) for (i, _), p, r in zip(rows, prints, root, strict=True))
    assert sorted(tuple(r) for r in got) == want
    assert len({w[2] for w in want}) < len(rows) - 20


def test_simhash_links_reach_exactly_two_bits(spark, stage):
    rng = random.Random(5)
    centre = [rng.getrandbits(64) for _ in range(40)]
    values = set(centre)
    for c in centre:
        for bits in (1, 2, 3):
            values.add(c ^ sum(1 << b for b in rng.sample(range(64), bits)))
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint"), 2).collect()
    number = {s[0]: k for k, s in enumerate(signed)}
    got = classes(len(values), [(number[e["a"]], number[e["b"]]) for e in edges])
    near = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 2]
    assert got == classes(len(values), near)


def test_simhash_odd_inputs(spark, stage):
    assert simhash.simhash_groups(docs(spark, []), stage).count() == 0
    source = stage(docs(spark, ODD), "docs")
    assert simhash.simhash_groups(source, stage).count() == len(ODD)
    kept = simhash.drop_near_copies(source, stage)
    assert kept.schema.names == source.schema.names
    prints = [slow_fingerprint(t) for _, t in ODD]
    root = classes(len(ODD), [(a, b) for a in range(len(ODD)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2])
    assert kept.count() == len(set(root))
    assert 7 in [r["doc_id"] for r in kept.collect()] and 8 not in [r["doc_id"] for r in kept.collect()]


def test_near_copies_do_not_depend_on_how_files_are_split(spark, stage):
    """The same documents stay where executors come or go between building the plan and running it."""
    rows = [(k % 200, f"document {k % 200} copy {k // 200} " + ("shared words " * 12 if k % 20 == 0 else f"own{k} words{k} x{k}")) for k in range(400)]
    rows += [(7, "again and again")] * 3 + [(None, "again and again")]
    source = stage(docs(spark, rows).repartition(40), "docs")
    prints = [slow_fingerprint(t) for _, t in rows]
    root = classes(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2])
    key = "spark.sql.leafNodeDefaultParallelism"
    try:
        spark.conf.set(key, "4")
        kept = simhash.drop_near_copies(source, stage)
        spark.conf.set(key, "64")
        got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    finally:
        spark.conf.unset(key)
    assert len(got) == len(set(root)) == len(set(got))
    best = {}
    for k, (i, t) in enumerate(rows):
        best[root[k]] = min(best.get(root[k], (True, 0)), (i is None, i or 0))
    assert sorted(i for i, _ in got) == sorted(i for _, i in best.values())


def test_components_of_a_chain_and_a_star(spark, stage):
    pairs = [(n, n + 1) for n in range(300)] + [(1000, n) for n in range(1001, 1400)] + [(5, 5), (1, 0)]
    rows = components.components(spark.createDataFrame(pairs, "a bigint, b bigint"), stage).collect()
    roots = {r["node"]: r["root"] for r in rows}
    assert len(roots) == 301 + 400 and len({roots[n] for n in range(301)}) == 1
    assert len({roots[n] for n in range(1000, 1400)}) == 1 and roots[0] != roots[1000]


# --- embeddings ----------------------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (1, 2):
        for centre in rng.normal(size=(25, 24)):
            for spread in (0, 0.02, 0.05, 0.08, 0.3):
                rows.append((n, (centre + spread * rng.normal(size=24)).tolist(), label))
                n += 1
    copies = [(500 + k, rows[0][1], 1) for k in range(30)]
    odd = [
        (600, None, 1), (601, [0.0] * 24, 1), (602, [float("nan")] + [1.0] * 23, 1), (603, [None] + [1.0] * 23, 1),
        (604, [float("inf")] * 24, 1), (605, rows[0][1], None), (606, [], 1), (607, [1.0, 2.0], 1), (608, [2.0, 4.0], 1),
        (609, [1e200] * 24, 2), (610, [2e200] * 24, 2), (0, rows[0][1], 1),
    ]
    return rows + copies + odd


def test_embeddings_equal_brute_force(spark, stage, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    rows = vectors()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, id string, links int")
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicates(frame, stage).collect())

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v) / max(map(abs, v))
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v, _ in rows]
    linked = [
        (a, b)
        for a in range(len(rows))
        for b in range(len(rows))
        if a != b and units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] is not None
        and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.93
    ]
    links = [0] * len(rows)
    for a, _ in linked:
        links[a] += 1
    root, first = classes(len(rows), linked), {}
    for (i, _, _), r in zip(rows, root, strict=True):
        first[r] = min(first.get(r, i), i)
    want = sorted((i, n, first[r], i == first[r]) for (i, _, _), n, r in zip(rows, links, root, strict=True))
    assert got == want
    assert embedding_dedup.near_duplicates(frame.limit(0), stage).count() == 0


def test_embedding_recall_at_the_threshold():
    """Pairs at a cosine of just 0.93 meet in a bucket in well over nine of ten cases."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.9301 * x + np.sqrt(1 - 0.9301**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    a, b = embedding_dedup.bucket_codes(x), embedding_dedup.bucket_codes(y)
    assert (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean() > 0.97


def test_hadamard_keeps_length():
    x = np.random.default_rng(1).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(embedding_dedup.rotate(x, 3), axis=1), np.linalg.norm(x, axis=1))
