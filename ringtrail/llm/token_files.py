"""Token ids in binary shards, compressed by Re-Pair grammars that allow random access.

A shard holds whole documents. Rounds over its ids replace the most frequent pairs by new
symbols (no pair across two documents), until no pair pays for its rule or the symbols of 16
bits are used up. Rules, expansion lengths and the ends of every document, in symbols and in
tokens, are stored, so that a document is decoded without the rest of its shard.

File, little-endian: magic, 6 x u64 (documents, tokens, symbols, rules, first nonterminal,
bytes of a symbol), then per document id i64, id known u8, end in tokens u64, end in symbols
u64; per rule left u32, right u32, length u32; then the symbols.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.llm.common import ChunkTable, put_file, ragged, read_files
from ringtrail.staging import Staging

MAGIC = b"REPAIR01"
SUFFIX = ".repair"
END_ID = 2
SHARD_TOKENS = 2_000_000
RULES_PER_ROUND = 2048
# A rule takes 12 bytes, a use saves one symbol of 2.
MIN_USES = 8


# --- grammar -------------------------------------------------------------------------------


def _frequent(keys: np.ndarray, most: int) -> np.ndarray:
    """The most frequent keys that pay for a rule, ties by key."""
    ordered = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    uses = np.diff(np.append(first, len(ordered)))
    pays = uses >= MIN_USES
    found, uses = ordered[first[pays]], uses[pays]
    return found[np.lexsort((found, -uses))[:most]]


def _slots(keys: np.ndarray) -> np.ndarray:
    """20 bits of a multiplicative hash."""
    if keys.dtype == np.uint32:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(12)
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, their ends per document, rules as rows of left, right) of ids below `base`."""
    # A pair is one number; symbols of 16 bits leave it at 32.
    kind, half = (np.uint32, 16) if base < 1 << 16 else (np.uint64, 32)
    seq = ids.astype(kind)
    last = np.zeros(len(seq), bool)
    last[ends[np.diff(ends, prepend=0) > 0] - 1] = True
    rules: list[np.ndarray] = []
    free = max(0, (1 << 16 if base < 1 << 16 else 1 << 32) - base)
    made = 0
    while len(seq) > 1 and made < free:
        keys = (seq[:-1] << kind(half)) | seq[1:]
        inside = ~last[:-1]
        chosen = _frequent(keys[inside], min(RULES_PER_ROUND, free - made))
        if not len(chosen):
            break
        # A table of one key per slot: a pair whose slot is taken waits for the next round.
        slots = _slots(chosen)
        _, kept = np.unique(slots, return_index=True)
        chosen = chosen[np.sort(kept)]
        in_slot = np.full(1 << 20, -1, np.int32)
        in_slot[_slots(chosen)] = np.arange(len(chosen))
        at = in_slot[_slots(keys)]
        hit = np.flatnonzero((at >= 0) & inside)
        hit = hit[chosen[at[hit]] == keys[hit]]
        # Where pairs overlap, every second one from the left is replaced.
        new_run = np.concatenate([[True], np.diff(hit) > 1])
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
        seq[hit] = at[hit].astype(kind) + kind(base + made)
        last[hit] = last[hit + 1]
        stays = np.ones(len(seq), bool)
        stays[hit + 1] = False
        seq, last = seq[stays], last[stays]
        rules.append(np.stack([chosen >> kind(half), chosen & kind((1 << half) - 1)], axis=1))
        made += len(chosen)
    filled = np.diff(ends, prepend=0) > 0
    symbol_ends = np.zeros(len(ends), np.int64)
    symbol_ends[filled] = np.flatnonzero(last) + 1
    symbol_ends = np.maximum.accumulate(symbol_ends) if len(ends) else symbol_ends
    table = np.concatenate(rules).astype(np.uint32) if rules else np.zeros((0, 2), np.uint32)
    return seq, symbol_ends, table


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Tokens below each nonterminal; rules refer to earlier ones only."""
    lengths = np.zeros(len(rules), np.int64)
    for k, (left, right) in enumerate(rules.tolist()):
        lengths[k] = (lengths[left - base] if left >= base else 1) + (lengths[right - base] if right >= base else 1)
    return lengths


@dataclass
class Shard:
    """One shard in memory; `document` and `tokens` decode parts of it."""

    ids: np.ndarray
    known: np.ndarray
    token_ends: np.ndarray
    symbol_ends: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    base: int

    @classmethod
    def build(cls, doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray, base: int) -> Shard:
        symbols, symbol_ends, rules = compress(ids, ends, base)
        known = np.array([i is not None for i in doc_ids], np.uint8)
        numbers = np.array([i or 0 for i in doc_ids], np.int64)
        return cls(numbers, known, ends, symbol_ends, rules, rule_lengths(rules, base), symbols, base)

    def to_bytes(self) -> bytes:
        width = 2 if self.base + len(self.rules) <= 1 << 16 else 4
        tokens = self.token_ends[-1] if len(self.token_ends) else 0
        head = [len(self.ids), tokens, len(self.symbols), len(self.rules), self.base, width]
        parts = [
            np.array(head, "<u8"), self.ids.astype("<i8"), self.known.astype("u1"), self.token_ends.astype("<u8"),
            self.symbol_ends.astype("<u8"), self.rules.T.astype("<u4"), self.lengths.astype("<u4"),
            self.symbols.astype(f"<u{width}"),
        ]
        return MAGIC + b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        if data[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        docs, _, symbols, rules, base, width = (int(x) for x in np.frombuffer(data, "<u8", 6, 8))
        at = 56

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        ids, known = take("<i8", docs), take("u1", docs)
        token_ends, symbol_ends = take("<u8", docs).astype(np.int64), take("<u8", docs).astype(np.int64)
        table = take("<u4", 2 * rules).reshape(2, rules).T
        lengths = take("<u4", rules).astype(np.int64)
        return cls(ids, known, token_ends, symbol_ends, table, lengths, take(f"<u{width}", symbols), base)

    def _grammar(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All expansions one after another, their starts and lengths, per symbol."""
        if not hasattr(self, "_flat"):
            lengths = np.concatenate([np.ones(self.base, np.int64), self.lengths])
            start = np.cumsum(lengths) - lengths
            flat = np.zeros(int(lengths.sum()), np.uint32)
            flat[: self.base] = np.arange(self.base)
            for k, (left, right) in enumerate(self.rules.tolist(), self.base):
                a, b, n = start[left], start[right], lengths[left]
                flat[start[k] : start[k] + n] = flat[a : a + n]
                flat[start[k] + n : start[k] + lengths[k]] = flat[b : b + lengths[right]]
            self._flat = (flat, start, lengths)
        return self._flat

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, start, lengths = self._grammar()
        symbols = symbols.astype(np.int64)
        return ragged(flat, start[symbols], lengths[symbols])

    def document(self, n: int) -> np.ndarray:
        """The ids of the n-th document."""
        begin = self.symbol_ends[n - 1] if n else 0
        return self.expand(self.symbols[begin : self.symbol_ends[n]])

    def tokens(self, n: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the n-th document, from the symbols that cover them."""
        begin = self.symbol_ends[n - 1] if n else 0
        symbols = self.symbols[begin : self.symbol_ends[n]].astype(np.int64)
        ends = np.cumsum(self._grammar()[2][symbols])
        first, last = np.searchsorted(ends, [start, stop - 1], side="right")
        before = ends[first - 1] if first else 0
        return self.expand(symbols[first : last + 1])[start - before : stop - before]


# --- writing and reading --------------------------------------------------------------------


_PLAIN = re.compile(r"( ?)([A-Za-z]+)([.,;:!?]*)")


def _cuts_plain(tokenizer) -> bool:
    """Whether the library cuts a plain piece into its word, with the space, and its marks, and changes neither."""
    letters, marks = string.ascii_letters, ".,;:!?"
    cuts = tokenizer.pre_tokenizer and [x for x, _ in tokenizer.pre_tokenizer.pre_tokenize_str(f" {letters}{marks}")]
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    whole = not any(set(x) <= set(f" {letters}{marks}") for x in added)
    return tokenizer.normalizer is None and cuts == [f"Ġ{letters}", marks] and whole


@lru_cache(maxsize=2)
def _encoder(path: str) -> tuple[ChunkTable, int]:
    """The table of pieces and the size of the vocabulary; one per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, plain = tokenizer.model, _cuts_plain(tokenizer)

    @lru_cache(maxsize=4096)
    def marks_ids(marks: str) -> list[int]:
        return [t.id for t in model.tokenize(marks)] if marks else []

    def encode(texts: list[str]) -> list[list[int]]:
        """Plain words go to the library's model as the one or two pre-tokens they are, the rest to all of the library."""
        out: list[list[int] | None] = []
        for text in texts:
            m = _PLAIN.fullmatch(text) if plain else None
            word = m and ("Ġ" if m[1] else "") + m[2]
            out.append(m and [t.id for t in model.tokenize(word)] + marks_ids(m[3]))
        rest = [n for n, ids in enumerate(out) if ids is None]
        coded = tokenizer.encode_batch_fast([texts[n] for n in rest], add_special_tokens=False)
        for n, e in zip(rest, coded, strict=True):
            out[n] = e.ids
        return out

    return ChunkTable(encode), tokenizer.get_vocab_size()


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Writes the shards when evaluated; (part, shard, docs, tokens, bytes) of each.

    Documents are range-partitioned and sorted by id, null ids first, equal ids by text; shards
    are numbered in that order. A repeated task writes the same files again. Evaluate once.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), str(task.taskAttemptId())
        table, vocabulary = _encoder(tokenizer)
        base = max(vocabulary, end_id + 1)
        number = held = 0
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        sizes: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            ends = np.cumsum(np.array(sizes, np.int64))
            data = Shard.build(doc_ids, np.concatenate(parts), ends, base).to_bytes()
            put_file(f"{folder}/{part:06d}-{number:06d}{SUFFIX}", data, attempt)
            row = {"part": part, "shard": number, "docs": len(sizes), "tokens": int(ends[-1]), "bytes": len(data)}
            number += 1
            for x in (doc_ids, parts, sizes):
                x.clear()
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            numbers = batch.column(0).to_pylist()
            ids, lengths = table.encode(texts)
            begin = 0
            for doc, n in zip(numbers, lengths.tolist(), strict=True):
                doc_ids.append(doc)
                parts += [ids[begin : begin + n], np.array([end_id], ids.dtype)]
                sizes.append(n + 1)
                begin += n
                held += n + 1
                if held >= SHARD_TOKENS:
                    yield flush()
                    held = 0
        if sizes:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    placed = rows.repartitionByRange("_id").sortWithinPartitions("_id", "_text")
    return placed.mapInArrow(run, "part bigint, shard bigint, docs bigint, tokens bigint, bytes bigint")


def read_tokens(shards: DataFrame, files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, decoded from the files.

    `start` is the number of ids before the document in all shards. Only totals of parts, one row
    for each, come together for that.
    """
    totals = shards.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select(F.col("part").alias("_p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", F.coalesce(F.sum("tokens").over(within), F.lit(0)).alias("shard_start"))
    starts = starts.join(parts, F.col("part") == F.col("_p")).select(
        "part", "shard", (F.col("part_start") + F.col("shard_start")).alias("_base")
    )

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part, number = os.path.basename(path).removesuffix(SUFFIX).split("-")
                shard = Shard.from_bytes(content)
                n = len(shard.ids)
                sums = [zlib.crc32(shard.document(k).astype("<u4").tobytes()) for k in range(n)]
                begin = np.concatenate([[0], shard.token_ends[:-1]]) if n else shard.token_ends
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, int(part))),
                        pa.array(np.full(n, int(number))),
                        pa.array(shard.ids, mask=shard.known == 0),
                        pa.array(begin),
                        pa.array(shard.token_ends - begin),
                        pa.array(sums, pa.int64()),
                    ],
                    ["_part", "_shard", "_id", "_begin", "n_tokens", "ids_crc32"],
                )

    schema = "_part bigint, _shard bigint, _id bigint, _begin bigint, n_tokens bigint, ids_crc32 bigint"
    decoded = files.mapInArrow(run, schema)
    placed = decoded.join(starts, (F.col("_part") == F.col("part")) & (F.col("_shard") == F.col("shard")))
    start = (F.col("_base") + F.col("_begin")).alias("start")
    return placed.select(F.col("_id").alias(id_col), start, "n_tokens", "ids_crc32")


def token_round_trip(docs: DataFrame, stage: Staging, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"):
    """Writes all documents as shards below the staging folder and reads them back; see read_tokens.

    Null and empty texts are documents of the end id alone. Without documents there are no files.
    """
    folder = f"{stage.root}/tokens"
    shards = stage(write_tokens(docs, folder, tokenizer, id_col, text_col), "shards")
    if shards.isEmpty():
        return shards.selectExpr(f"part as {id_col}", "part as start", "part as n_tokens", "part as ids_crc32")
    return read_tokens(shards, read_files(docs.sparkSession, folder, SUFFIX), id_col)
