"""Byte-level BPE from a rank file: whole pre-tokens by a minimal perfect hash, the rest by a heap.

The vocabulary file is a parameter; a worker reads it once. Every distinct piece of text is
encoded once per worker and looked up afterwards.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.common import ChunkTable


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Minimal perfect hash of byte strings: as many slots as keys, one probe and one comparison.

    Keys fall into buckets; larger buckets first, each gets the smallest displacement that sends
    its keys to free slots. A bucket of one key names its slot directly.
    """

    def __init__(self, values: dict[bytes, int]):
        self.size = n = max(len(values), 1)
        buckets: dict[int, list[tuple[int, int, bytes]]] = {}
        for key in values:
            bucket, first, step = self._split(key)
            buckets.setdefault(bucket, []).append((first, step, key))
        self.displace = [0] * n
        self.keys: list[bytes | None] = [None] * n
        self.values = [-1] * n
        singles = []
        for bucket, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                singles.append((bucket, members[0][2]))
                continue
            d = 1
            while True:
                slots = [(first + d * step) % n for first, step, _ in members]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
                if d > 64 * n:
                    raise ValueError("two keys have the same hash")
            self.displace[bucket] = d
            for slot, (_, _, key) in zip(slots, members, strict=True):
                self.keys[slot], self.values[slot] = key, values[key]
        free = (s for s in range(n) if self.keys[s] is None)
        for (bucket, key), slot in zip(singles, free, strict=False):
            self.displace[bucket] = -slot - 1
            self.keys[slot], self.values[slot] = key, values[key]

    def _split(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return h % self.size, (h >> 32) & 0xFFFFFFFF, (h >> 64) & 0xFFFFFFFF | 1

    def get(self, key: bytes) -> int:
        """The value of a key, -1 for anything else."""
        bucket, first, step = self._split(key)
        d = self.displace[bucket]
        slot = -d - 1 if d < 0 else (first + d * step) % self.size
        return self.values[slot] if self.keys[slot] == key else -1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token that is no token: joins the pair of lowest rank, leftmost first.

    The parts form a linked list over byte positions, candidates wait in a heap; an entry is out
    of date when one of its ends has moved since.
    """
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins at a position; 0 once it is joined to the left
    before = list(range(-1, n - 1))
    heap = []
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, left, stop = heapq.heappop(heap)
        middle = end[left]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[left], end[middle] = stop, 0
        if stop < n:
            before[stop] = left
            rank = get(piece[left : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, left, end[stop]))
        if left:
            previous = before[left]
            rank = get(piece[previous:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, previous, stop))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : end[at]]])
        at = end[at]
    return out


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.whole = PerfectHash(self.ranks)
        self.split = regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.table = ChunkTable(lambda texts: [self.encode(t) for t in texts])

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for word in self.split(text):
            piece = word.encode()
            known = self.whole.get(piece)
            if known >= 0:
                out.append(known)
            else:
                out += merge(piece, self.ranks)
        return out

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        ids, lengths = self.table.encode(texts)
        ends = np.cumsum(lengths)
        flat = ids.tolist()
        return [flat[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker: it keeps its tables from task to task."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text, null like empty: none."""

    def run(batches):
        coder = codec(path, pattern)
        for batch in batches:
            ids, lengths = coder.table.encode([t or "" for t in batch.column(1).to_pylist()])
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [id_col, "ids"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the bytes decoded from them.

    Encoding and decoding happen in one pass, so the ids themselves are not moved. Null texts are empty, and
    empty texts have no ids; every row comes back, rows that repeat each, and null ids as they are.
    """

    def run(batches):
        coder = codec(path, pattern)
        for batch in batches:
            encoded = coder.encode_many([t or "" for t in batch.column(1).to_pylist()])
            text = [",".join(map(coder.decimal.__getitem__, ids)).encode() for ids in encoded]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, encoded), pa.int64()),
                    pa.array(hashlib.sha256(t).hexdigest() for t in text),
                    pa.array(hashlib.sha256(coder.decode(ids)).hexdigest() for ids in encoded),
                ],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema)
