"""Ranked lexical search with per-term geometric blocking.

Documents are indexed in shards of bounded size. In a shard the posting list of each term is
clustered by the similarity of its documents, and each cluster, a block, keeps the largest impact
of every term that is ever asked together with the list's term: a coordinatewise maximum, so that
its product with a query is an upper bound for every document in the block. The best block of each
query in each shard is scored first; the k-th best of those scores over all shards is a lower
bound for the result. A block is then skipped only where its upper bound is below that.

All scores are sums of 64-bit integers, so bounds and results are exact.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.llm.common import byte_table, get_range, put_file
from ringtrail.staging import Staging

TOP = 10
# Length normalisation in hundredths, and the scale of the saturation of term counts.
LENGTH_SHARE = 90
SATURATION = 8
# Documents of a block, before clusters come out uneven; a larger cluster than twice that is cut.
BLOCK = 64
# A shard ends at so many documents, or cells of its table of documents by terms.
SHARD_DOCS = 2048
SHARD_CELLS = 1 << 23
# Terms of queries, repeats included, that go to the tasks at once; more queries are taken in turns.
QUERY_TERMS = 400_000
# Bytes of an index file before it is closed, and shards that one task of a search reads, one after another.
FILE_BYTES = 32 << 20
TASK_SHARDS = 8
# Numbers per document that decide its cluster.
SKETCH = 32

_FOLD = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz")


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def weight_of(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def impact(tf: np.ndarray, terms: int, docs: int, all_terms: int) -> np.ndarray:
    m = 100 - LENGTH_SHARE + LENGTH_SHARE * terms * docs // all_terms
    return 1_000_000_000 * tf // (1000 * tf + SATURATION * m)


@dataclass
class Asked:
    """The queries of one turn: term numbers, each once, and what is asked together with each term."""

    names: list[int]
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]

    def __post_init__(self):
        together: list[list[np.ndarray]] = [[] for _ in self.vocabulary]
        for terms in self.terms:
            for t in terms.tolist():
                together[t].append(terms)
        self.near = [np.unique(np.concatenate([np.zeros(0, np.int64), *x])) for x in together]

    @classmethod
    def of(cls, rows) -> Asked:
        vocabulary: dict[bytes, int] = {}
        names, terms = [], []
        for row in rows:
            names.append(row["_q"])
            terms.append(np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in row["terms"]], np.int64))
        return cls(names, terms, vocabulary)


# --- a shard -------------------------------------------------------------------------------


@dataclass
class Shard:
    """Documents by ascending id, null ids last, and the blocks of all posting lists, list after list.

    `members` of block b are doc[doc_end[b - 1] : doc_end[b]]; its summary has one number per term of
    `Asked.near` of the list's term; `list_end` counts blocks up to and with each term.
    """

    ids: list
    row_end: np.ndarray
    row_term: np.ndarray
    row_impact: np.ndarray
    list_end: np.ndarray
    doc_end: np.ndarray
    doc: np.ndarray
    summary: np.ndarray

    ARRAYS = {
        "row_end": np.int64, "row_term": np.int32, "row_impact": np.int32, "list_end": np.int64,
        "doc_end": np.int64, "doc": np.int32, "summary": np.int32,
    }

    @classmethod
    def build(cls, ids: list, rows: list[tuple[np.ndarray, np.ndarray]], asked: Asked, block: int = BLOCK) -> Shard:
        """Rows hold (term numbers, impacts) of the documents."""
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))
        ids, rows = [ids[i] for i in order], [rows[i] for i in order]
        sizes = np.array([len(t) for t, _ in rows], np.int64)
        term = np.concatenate([t for t, _ in rows]) if rows else np.zeros(0, np.int64)
        value = np.concatenate([x for _, x in rows]) if rows else np.zeros(0, np.int64)
        made = cls(ids, np.cumsum(sizes), term.astype(np.int32), value.astype(np.int32), *[np.zeros(0, np.int64)] * 4)
        table = made.table(len(asked.vocabulary))
        signs = np.random.default_rng(11).choice(np.float32([-1, 1]), (len(asked.vocabulary), SKETCH))
        sketch = table.astype(np.float32) @ signs
        holder = np.repeat(np.arange(len(ids)), sizes)[np.argsort(term, kind="stable")]
        lists = np.split(holder, np.cumsum(np.bincount(term, minlength=len(asked.vocabulary)))[:-1])
        counts, docs, ends, summaries, at = [], [], [], [], 0
        for members, near in zip(lists, asked.near, strict=True):
            members, starts = cluster(members, sketch, block)
            counts.append(len(starts))
            if not len(members):
                continue
            docs.append(members)
            ends.append(at + np.append(starts[1:], len(members)))
            at += len(members)
            summaries.append(np.maximum.reduceat(table[np.ix_(members, near)], starts, axis=0).ravel())
        if docs:
            made.doc, made.doc_end = np.concatenate(docs).astype(np.int32), np.concatenate(ends)
            made.summary = np.concatenate(summaries)
        made.list_end = np.cumsum(counts, dtype=np.int64)
        return made

    def table(self, terms: int) -> np.ndarray:
        """Documents by terms, the impacts."""
        out = np.zeros((len(self.ids), terms), np.int32)
        out[np.repeat(np.arange(len(self.ids)), np.diff(self.row_end, prepend=0)), self.row_term] = self.row_impact
        return out

    def to_bytes(self) -> bytes:
        """Length and content of each array, compressed together."""
        parts = [np.asarray(getattr(self, n), kind).tobytes() for n, kind in self.ARRAYS.items()]
        sizes = np.array([len(p) for p in parts], np.int64).tobytes()
        return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(parts))

    @classmethod
    def from_bytes(cls, ids, data: bytes) -> Shard:
        data = zstandard.ZstdDecompressor().decompress(data)
        ends = 8 * len(cls.ARRAYS) + np.cumsum(np.frombuffer(data, np.int64, len(cls.ARRAYS)))
        starts = np.append(8 * len(cls.ARRAYS), ends[:-1])
        parts = zip(starts.tolist(), ends.tolist(), cls.ARRAYS.values(), strict=True)
        return cls(ids, *[np.frombuffer(data[begin:end], kind) for begin, end, kind in parts])


def cluster(members: np.ndarray, sketch: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The members of a posting list in order of their cluster, and where each block starts."""
    n = len(members)
    if n <= block:
        return members, np.zeros(min(n, 1), np.int64)
    heads = members[np.arange(0, n, block)]
    nearest = np.argmax(sketch[members] @ sketch[heads].T, axis=1)
    order = np.argsort(nearest, kind="stable")
    nearest = nearest[order]
    new = np.flatnonzero(np.append(True, nearest[1:] != nearest[:-1]))
    place = np.arange(n) - np.repeat(new, np.diff(np.append(new, n)))
    return members[order], np.flatnonzero(place % (2 * block) == 0)


class Searcher:
    """Answers the queries of a turn in one shard."""

    def __init__(self, shard: Shard, asked: Asked, weights: np.ndarray):
        self.shard, self.asked, self.weights = shard, asked, weights
        self.table = shard.table(len(asked.vocabulary))
        counts = np.diff(shard.list_end, prepend=0)
        widths = np.array([len(x) for x in asked.near], np.int64)
        self.first = shard.list_end - counts
        self.cell = np.cumsum(counts * widths) - counts * widths

    def bounds(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Block numbers of the lists of a query's terms, and their upper bounds."""
        terms = self.asked.terms[q]
        blocks, bounds = [], []
        for t in terms.tolist():
            first, last = int(self.first[t]), int(self.shard.list_end[t])
            if first == last:
                continue
            near = self.asked.near[t]
            begin = int(self.cell[t])
            summary = self.shard.summary[begin : begin + (last - first) * len(near)].reshape(last - first, len(near))
            blocks.append(np.arange(first, last))
            bounds.append(summary[:, np.searchsorted(near, terms)].astype(np.int64) @ self.weights[terms])
        empty = np.zeros(0, np.int64)
        return (np.concatenate(blocks), np.concatenate(bounds)) if blocks else (empty, empty)

    def scores(self, q: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the blocks, each once, and their scores."""
        ends = self.shard.doc_end
        docs = np.unique(np.concatenate([self.shard.doc[(ends[b - 1] if b else 0) : ends[b]] for b in blocks.tolist()]))
        terms = self.asked.terms[q]
        return docs, self.table[np.ix_(docs, terms)].astype(np.int64) @ self.weights[terms]

    def search(self, q: int, threshold: int | None, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The best documents: of the most promising block where no threshold is given, else of every
        block whose bound reaches it."""
        blocks, bounds = self.bounds(q)
        open_ = blocks[np.argmax(bounds)][None] if threshold is None and len(blocks) else blocks[bounds >= max(threshold or 0, 1)]
        if not len(open_):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, scores = self.scores(q, open_)
        best = np.lexsort((docs, -scores))[:top]
        best = best[scores[best] >= max(threshold or 0, 1)]
        return docs[best], scores[best]


# --- over all documents --------------------------------------------------------------------


def _bags(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(_id, n, term, tf) of every row with a term: its number of terms, and counts of those asked for."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, total, term, tf = [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                words = terms_of(text)
                if words:
                    held = np.array([t for t in map(vocabulary.get, words) if t is not None], np.int32)
                    ids, counts = np.unique(held, return_counts=True)
                    at.append(k)
                    total.append(len(words))
                    term.append(ids)
                    tf.append(counts)
            columns = [
                batch.column(0).take(pa.array(at, pa.int64())), pa.array(total, pa.int64()),
                pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "n", "term", "tf"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, n bigint, term array<int>, tf array<bigint>")


def build_index(bags: DataFrame, asked: Asked, folder: str, docs: int, all_terms: int) -> DataFrame:
    """Writes the shards into files when evaluated; (ids, path, offset, length) of each. Evaluate once.

    Shards are cut from the rows of a task as they come, so no text or bag is shuffled. A repeated task
    writes files of its own, and only those are named whose task is the one that counts.
    """
    width = len(asked.vocabulary)

    def run(batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt, number = task.taskAttemptId(), 0
        ids, rows, cells = [], [], 0
        held: list[bytes] = []
        named: list[tuple] = []
        id_type = pa.int64()

        def close_shard() -> None:
            nonlocal ids, rows, cells
            data = Shard.build(ids, rows, asked).to_bytes()
            path = f"{folder}/{task.partitionId():06d}-{number:06d}-{attempt}.shards"
            named.append((ids_sorted(ids), path, sum(map(len, held)), len(data)))
            held.append(data)
            ids, rows, cells = [], [], 0

        def close_file() -> pa.RecordBatch:
            nonlocal number, held, named
            put_file(named[0][1], b"".join(held), str(attempt))
            kinds = (pa.list_(id_type), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*named, strict=True), kinds, strict=True)]
            number, held, named = number + 1, [], []
            return pa.RecordBatch.from_arrays(columns, ["ids", "path", "offset", "length"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            names, totals = (c.to_pylist() for c in batch.columns[:2])
            for k in range(len(batch)):
                term = batch.column(2)[k].values.to_numpy()
                if not len(term):
                    continue
                ids.append(names[k])
                rows.append((term, impact(batch.column(3)[k].values.to_numpy(), totals[k], docs, all_terms)))
                cells += len(term)
                if len(ids) == SHARD_DOCS or len(ids) * min(width, cells) >= SHARD_CELLS:
                    close_shard()
                    if sum(map(len, held)) >= FILE_BYTES:
                        yield close_file()
        if ids:
            close_shard()
        if held:
            yield close_file()

    kind = bags.schema["_id"].dataType.simpleString()
    return bags.mapInArrow(run, f"ids array<{kind}>, path string, offset bigint, length bigint")


def ids_sorted(ids: list) -> list:
    """In the order of a shard."""
    return sorted((i for i in ids if i is not None)) + [None] * sum(i is None for i in ids)


def _search(index: DataFrame, asked: Asked, weights: np.ndarray, thresholds: dict[int, int] | None, top: int) -> DataFrame:
    """(_q, _id, score): best of every shard; without thresholds from the most promising blocks alone."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids = batch.column(0)[k].values
                path, offset, length = (c[k].as_py() for c in batch.columns[1:])
                searcher = Searcher(Shard.from_bytes(ids, get_range(path, offset, length)), asked, weights)
                name, at, score = [], [], []
                for q, known in enumerate(asked.names):
                    limit = None if thresholds is None else thresholds.get(known, 1)
                    docs, scores = searcher.search(q, limit, top)
                    name += [known] * len(docs)
                    at.append(docs)
                    score.append(scores)
                places = pa.array(np.concatenate(at) if at else [], pa.int64())
                values = pa.array(np.concatenate(score) if score else [], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), ids.take(places), values], ["_q", "_id", "score"])

    kind = index.schema["ids"].dataType.elementType.simpleString()
    return index.mapInArrow(run, f"_q bigint, _id {kind}, score bigint")


def _turn(docs: DataFrame, asked: Asked, stage: Staging, id_col: str, text_col: str, top: int) -> DataFrame:
    bags = stage(_bags(docs, id_col, text_col, asked.vocabulary), "bags")
    row = bags.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not row["docs"]:
        return bags.select(F.lit(0).cast("long").alias("_q"), "_id", F.lit(0).cast("long").alias("score")).limit(0)
    holding = {r["t"]: r["count"] for r in bags.select(F.explode("term").alias("t")).groupBy("t").count().collect()}
    weights = np.array([weight_of(row["docs"], holding.get(t, 0)) for t in range(len(asked.vocabulary))], np.int64)
    index = stage(build_index(bags, asked, f"{stage.root}/{uuid.uuid4().hex}", row["docs"], row["terms"]), "index")
    # Few rows that each stand for much work.
    index = index.repartition(max(1, math.ceil(index.count() / TASK_SHARDS)))
    best = Window.partitionBy("_q").orderBy(F.col("score").desc())
    first = _search(index, asked, weights, None, top).withColumn("place", F.row_number().over(best)).where(F.col("place") == top)
    thresholds = {r["_q"]: r["score"] for r in first.select("_q", "score").collect()}
    return stage(_search(index, asked, weights, thresholds, top), "found")


def search(
    docs: DataFrame,
    items: DataFrame,
    stage: Staging,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    query_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """(item, rank, id, score): the `top` rows of `docs` with the highest scores above zero for every
    row of `items`; equal scores by ascending id, null ids last.

    Null and empty texts have no terms: such documents count nowhere and such items get no rows.
    Every row is a document of its own, so rows that repeat take ranks of their own; every row of
    `items` is a query of its own, also where ids repeat or are null. Empty tables give no rows.
    Queries go to the tasks in turns of about QUERY_TERMS terms; an item is never cut.
    """
    def words(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["_item", "terms"])

    asked = items.select(F.col(item_col).alias("_item"), F.col(query_col).cast("binary").alias("_text"))
    kind = asked.schema["_item"].dataType.simpleString()
    asked = asked.mapInArrow(words, f"_item {kind}, terms array<binary>").where(F.size("terms") > 0)
    # The number is written with its row, so it names the same row in every later read.
    asked = stage(asked.withColumn("_q", F.monotonically_increasing_id()), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    turns = max(1, math.ceil(total / QUERY_TERMS))
    found = None
    for turn in range(turns):
        rows = asked.where(F.pmod(F.xxhash64("_q"), F.lit(turns)) == turn).select("_q", "terms").collect()
        part = _turn(docs, Asked.of(rows), stage, id_col, text_col, top)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("_q").orderBy(F.col("score").desc(), F.col("_id").isNull(), F.col("_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(asked.select("_q", "_item"), "_q").select(
        F.col("_item").alias(item_col), "rank", F.col("_id").alias(id_col), "score"
    )
