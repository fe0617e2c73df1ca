"""Byte-level BPE, token files, WARC bundles: against the libraries, and exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ringtrail.llm import byte_bpe, common, token_files, warc
from ringtrail.staging import Staging

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
BPE = P.path("byte_bpe_50k.json")
PIECES = ["a", "Ab", " ", "  ", "\n", "\t", "é", "ß", "12", "#", "'s", "\x1c", " ", "　", "日本", "😀", "the", "tion", "<|endoftext|>"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=25).map("".join) | st.text(max_size=25)
ROWS = [
    (3, "the quick  brown\n fox's den"), (1, None), (2, ""), (5, "x" * 3000 + " word" * 60_000), (4, " lead and trail "),
    (3, "same id"), (6, " odd 　 spaces"), (None, "no id"), (7, "Über ßé 日本 <|endoftext|> 12345"), (7, "Über ßé 日本 <|endoftext|> 12345"),
]


@pytest.fixture
def stage(spark, tmp_path):
    common.prepare(spark)
    return Staging(spark, str(tmp_path))


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Codec(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_encoding_equals_the_library(coder, library, text):
    ids = coder.encode_many([text])[0]
    assert ids == library.encode_ordinary(text) == coder.encode(text)
    assert coder.decode(ids) == text.encode()


def test_perfect_hash_is_minimal(coder):
    table = coder.whole
    assert len(table.keys) == len(coder.ranks) and None not in table.keys
    assert all(table.get(k) == v for k, v in coder.ranks.items())
    assert table.get(b"no such token at all") == -1 and table.get(b"") == -1
    assert byte_bpe.PerfectHash({}).get(b"a") == -1


def test_round_trip_query(spark, coder, library):
    common.prepare(spark)
    schema = "doc_id bigint, text string, ids string, n_tokens int, _text string"
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in ROWS], schema)
    got = byte_bpe.round_trip(frame, RANKS, P.PATTERN).collect()
    want = []
    for i, t in ROWS:
        ids = library.encode_ordinary(t or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    listed = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(frame, RANKS, P.PATTERN).collect()}
    assert listed[4] == library.encode_ordinary(" lead and trail ")
    assert byte_bpe.round_trip(frame.limit(0), RANKS, P.PATTERN).count() == 0


def test_a_full_table_changes_nothing(library):
    table = common.ChunkTable(library.encode_ordinary_batch, limit=3)
    for text in ("a b c d e f", "a b", " x y", "a b c"):
        ids, lengths = table.encode([text])
        assert ids.tolist() == library.encode_ordinary(text) and lengths.tolist() == [len(ids)]


# --- token files -----------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT | st.from_regex(r" ?[A-Za-z]{1,9}[.,;:!?]{0,3}", fullmatch=True), max_size=8).map(" ".join))
def test_pieces_equal_the_library(text):
    tokenizer = Tokenizer.from_file(BPE)
    assert token_files._cuts_plain(tokenizer)
    ids, lengths = token_files._encoder(BPE)[0].encode([text, ""])
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids and lengths.tolist() == [len(ids), 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=60), max_size=12), st.sampled_from([6, 70_000]))
def test_grammar_round_trip(documents, base):
    docs = [d + [2] for d in documents for _ in range(9)]
    ends = np.cumsum([len(d) for d in docs]).astype(np.int64)
    ids = np.array([i for d in docs for i in d], np.int32)
    made = token_files.Shard.build(list(range(len(docs))), ids, ends, base)
    shard = token_files.Shard.from_bytes(made.to_bytes())
    assert [shard.document(k).tolist() for k in range(len(docs))] == docs
    rng = random.Random(1)
    for k in range(0, len(docs), 5):
        a, b = sorted((rng.randrange(len(docs[k])), rng.randrange(1, len(docs[k]) + 1)))
        if a < b:
            assert shard.tokens(k, a, b).tolist() == docs[k][a:b]
    if len(ids) > 2000:
        assert len(shard.symbols) < len(ids) / 2


def test_grammar_goes_on_until_no_pair_pays():
    ids = np.random.default_rng(3).zipf(1.3, 6_000) % 50
    ids = np.tile(np.append(ids, 2), 20).astype(np.int32)
    ends = np.arange(1, 21) * 6_001
    symbols, symbol_ends, rules = token_files.compress(ids, ends, 60)
    cuts = set((symbol_ends - 1).tolist())
    keys = np.array([(a << 16) | b for k, (a, b) in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True)) if k not in cuts], np.uint32)
    assert not len(token_files._frequent(keys, 10)) or len(rules) == (1 << 16) - 60
    assert token_files.rule_lengths(rules, 60).max() > 64


def test_rules_expand_to_their_lengths():
    ids = np.array([1, 2, 3, 4] * 5000 + [2], np.int32)
    shard = token_files.Shard.build([1], ids, np.array([len(ids)]), 10)
    assert len(shard.rules) >= 3 and shard.lengths.max() >= 16
    for k in range(len(shard.rules)):
        assert len(shard.expand(np.array([10 + k]))) == shard.lengths[k]


def test_files_equal_the_library(spark, stage, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_TOKENS", 50)
    frame = spark.createDataFrame([(i, t, 1, "p") for i, t in ROWS], "doc_id bigint, text string, part int, shard string")
    got = token_files.token_round_trip(frame, stage, BPE).collect()
    tokenizer = Tokenizer.from_file(BPE)
    start, want = 0, []
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_no_documents_no_files(spark, stage):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_files.token_round_trip(empty, stage, BPE).count() == 0


# --- WARC --------------------------------------------------------------------------------------------


PAGES = [
    (5, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://c/", None),
    (3, "http://d/\r\nx", ""), (4, "", "é" * 300_000), (6, "u", "WARC/1.1\r\n\r\n\r\n\r\n"), (None, "u", "<p>none</p>"),
    (7, "u", "twice"), (7, "u", "twice"),
]


def test_archives_round_trip(spark, stage, monkeypatch):
    schema = "page_id bigint, url string, html string, _sha string, frame int"
    frame = spark.createDataFrame([(*p, "x", 1) for p in PAGES], schema)
    got = warc.archive_round_trip(frame, stage).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        again = i is not None and first[h or ""] != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "revisit" if again else "response", first[h or ""] if again else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert warc.archive_round_trip(frame.limit(0), Staging(spark, stage.root)).count() == 0


def test_index_points_into_frames(spark, stage):
    pages = [(n, f"http://h/{n}", f"<p>page {n}</p>" * 500) for n in range(200)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1)
    folder = f"{stage.root}/bundles"
    index = stage(warc.write_bundles(frame, folder, stage), "index").collect()
    assert len({(r["bundle"], r["frame"]) for r in index}) > 3
    data = {r["bundle"]: common.get_file(f"{folder}/{r['bundle']}") for r in index}
    for r in index[::17]:
        fields, _, payload = warc.read_record(data[r["bundle"]], r["frame"], r["offset"])
        assert fields["WARC-Record-ID"] == warc.record_id(r["page_id"])
        assert payload.decode() == pages[r["page_id"]][2]


def test_a_part_of_the_index_reads_a_part_of_the_archive(spark, stage):
    pages = [(n, f"http://h/{n}", f"<p>page {n}</p>" * 400) for n in range(300)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    folder = f"{stage.root}/part"
    index = stage(warc.write_bundles(frame, folder, stage), "index")
    whole = warc.read_bundles(common.read_files(spark, folder, warc.SUFFIX))
    assert sorted(warc.read_indexed(index, folder).collect()) == sorted(whole.collect())
    some = warc.read_indexed(index.where("page_id % 7 = 3"), folder).collect()
    assert sorted(r["page_id"] for r in some) == [n for n in range(300) if n % 7 == 3]
    wrong = index.withColumn("page_id", index["page_id"] + 1)
    with pytest.raises(Exception, match="the index leads from page"):
        warc.read_indexed(wrong, folder).collect()


def test_damage_is_noticed(spark, stage):
    html = "<p>" + "x" * 50 + "</p>"
    record = warc.make_record(1, "u", html.encode(), hashlib.sha1(b"other").hexdigest(), None, False)
    bundle = warc.Bundle()
    import zstandard

    bundle.add(record, zstandard.ZstdCompressor())
    files = spark.createDataFrame([("p", bytearray(bundle.to_bytes()))], "path string, content binary")
    with pytest.raises(Exception, match="damaged record"):
        warc.read_bundles(files).collect()
