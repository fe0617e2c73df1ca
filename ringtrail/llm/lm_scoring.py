"""Scores of whole texts by a word base line and by a causal self-attention model.

Documents are first written in numbered blocks, which every later pass reads: what a block holds does
not depend on how many executors there are when. Texts are cut into words and these into subword ids of a
given vocabulary there and only there: a block holds the numbers of its distinct words, and of each of these
its ids. Words of the training documents are counted over the whole corpus, per block first. The model
reads the ids; rare ones are spelt in bytes. Its weights are fitted in rounds, in which every training document is seen once: trainers run over
their documents side by side, and their weights are averaged.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.attention_lm import BEGIN, END, Adam, Chunks, Model
from ringtrail.llm.byte_bpe import read_ranks
from ringtrail.llm.common import get_file, pieces_apart, put_file, ragged, remainder
from ringtrail.staging import Staging

FOLDS, HELD_OUT = 5, 1
SMOOTHING = 0.5
# Text of a block, whose distinct words a worker holds at once.
BLOCK_BYTES = 16 << 20
# The output vocabulary: the most frequent ids, single bytes always; the rest is spelt in bytes.
MAX_SYMBOLS = 4096
# Training documents fall into ROUNDS parts by a hash of their id; each round fits one part.
ROUNDS = 4
BLOCKS_PER_TRAINER = 8
BATCH = 256  # rows of CHUNK symbols
RATE = 6e-3
SLICES = 16
# Words that are encoded in one call.
WORDS = 2_000
FAN_IN = 64


# --- counting words over the corpus ------------------------------------------------------------


def numbered_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct lower-cased (A-Z) words between ASCII white space, the numbers of all words in these, words per text)."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    sizes = cut.value_lengths().to_numpy()
    coded = cut.flatten().dictionary_encode()
    words, names = coded.indices.to_numpy(), coded.dictionary
    # White space at either end leaves an empty piece.
    empty = names.index("").as_py()
    if empty >= 0:
        stays = words != empty
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[stays], minlength=len(sizes))
        words = words[stays]
        words = words - (words > empty)
        names = pa.concat_arrays([names.slice(0, empty), names.slice(empty + 1)])
    return names, words.astype(np.int32), sizes.astype(np.int64)


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue())


def _unpacked(path: str) -> list[pa.Array]:
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(get_file(path))) as stream:
        return [c.combine_chunks() for c in stream.read_all().columns]


def _list_array(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


@dataclass
class Lexicon:
    """The distinct words of a block, how often its training documents have them, and their subword ids."""

    names: pa.Array
    n: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray

    @classmethod
    def load(cls, path: str) -> Lexicon:
        names, n, ids = _unpacked(f"{path}.words")
        return cls(names, n.to_numpy(), ids.flatten().to_numpy(), ids.value_lengths().to_numpy().astype(np.int64))


@dataclass
class Block:
    """Some documents as numbers of the words of their lexicon, one document after another."""

    ids: pa.Array
    held: np.ndarray
    part: np.ndarray
    sizes: np.ndarray
    words: np.ndarray

    @classmethod
    def load(cls, path: str) -> Block:
        ids, held, part, words = _unpacked(path)
        sizes = words.value_lengths().to_numpy().astype(np.int64)
        return cls(ids, held.to_numpy(zero_copy_only=False), part.to_numpy(), sizes, words.flatten().to_numpy())

    def of(self, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of some documents, one after another, and how many each has."""
        begin = np.cumsum(self.sizes) - self.sizes
        return ragged(self.words, begin[documents], self.sizes[documents]), self.sizes[documents]


def write_blocks(rows: DataFrame, folder: str, vocabulary: str, pattern: str) -> DataFrame:
    """Writes the rows (_id, held, part, _text) as blocks and their lexicons; (block, path, trained) of each,
    trained being its number of training documents. Evaluate once.

    A repeated task writes files of its own, and only those of the task that counts are named.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt, number = task.taskAttemptId(), 0
        kept: list[pa.RecordBatch] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal number, kept, size
            ids, held, part, texts = (pa.concat_arrays([b.column(k) for b in kept]) for k in range(4))
            kept.clear()
            names, words, sizes = numbered_words(texts)
            train = ~held.to_numpy(zero_copy_only=False)
            n = np.bincount(words[np.repeat(train, sizes)], minlength=len(names)).astype(np.int64)
            spelt = _list_array(*encode_words(names.to_pylist(), vocabulary, pattern))
            block = (task.partitionId() << 20) + number
            path = f"{folder}/{block}-{attempt}.block"
            lexicon = pa.table({"word": names, "n": pa.array(n), "ids": spelt})
            put_file(f"{path}.words", _packed(lexicon), str(attempt))
            documents = pa.table({"id": ids, "held": held, "part": part, "words": _list_array(words, sizes)})
            put_file(path, _packed(documents), str(attempt))
            trained = int(train.sum())
            number, kept, size = number + 1, [], 0
            return pa.RecordBatch.from_pydict({"block": [block], "path": [path], "trained": [trained]})

        for batch in batches:
            begin = 0
            lengths = pc.utf8_length(batch.column(3)).fill_null(0).to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            while begin < len(batch):
                room = BLOCK_BYTES - size + (ends[begin - 1] if begin else 0)
                end = min(len(batch), int(np.searchsorted(ends, room)) + 1)
                kept.append(batch.slice(begin, end - begin))
                size += int(lengths[begin:end].sum())
                begin = end
                if size >= BLOCK_BYTES:
                    yield close()
        if kept:
            yield close()

    return rows.mapInArrow(run, "block bigint, path string, trained bigint")


def spread(blocks: DataFrame, tasks: int) -> DataFrame:
    """(block, path) in so many tasks: rows are few, and each stands for much work."""
    return blocks.select("block", "path").repartitionByRange(max(1, tasks), "block").sortWithinPartitions("block")


def _listed(batches) -> Iterator[tuple[int, str]]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def block_words(blocks: DataFrame) -> DataFrame:
    """(word, block, pos, n): the distinct words of every block and their training counts in it."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for number, path in _listed(batches):
            lexicon = Lexicon.load(path)
            for begin in range(0, len(lexicon.names), 50_000):
                part = lexicon.names.slice(begin, 50_000)
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        part,
                        pa.array(np.full(n, number)),
                        pa.array(np.arange(begin, begin + n, dtype=np.int32)),
                        pa.array(lexicon.n[begin : begin + n]),
                    ],
                    ["word", "block", "pos", "n"],
                )

    return blocks.mapInArrow(run, "word string, block bigint, pos int, n bigint")


def corpus_counts(blocks: DataFrame, stage: Staging) -> tuple[DataFrame, DataFrame]:
    """(word, c): how often all training documents have each word; and (block, pos, c) of every block's words.

    The sums are formed before they are shuffled, and a word of very many blocks is a skewed key of the
    join back, which Spark splits.
    """
    found = stage(block_words(blocks), "block-words")
    totals = stage(found.groupBy("word").agg(F.sum("n").alias("c")), "corpus-counts")
    return totals, found.select("word", "block", "pos").join(totals, "word").select("block", "pos", "c")


def write_counts(counts: DataFrame, folder: str) -> DataFrame:
    """Writes for each block the corpus counts of its words in their order; (block, words) of each. Evaluate once."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        attempt = str(TaskContext.get().taskAttemptId())
        held: list[np.ndarray] = []
        current = None

        def close() -> pa.RecordBatch:
            data = np.concatenate(held)
            held.clear()
            put_file(f"{folder}/{current}.counts", data.astype("<i8").tobytes(), attempt)
            return pa.RecordBatch.from_pydict({"block": [current], "words": [len(data)]})

        for batch in batches:
            block, c = (batch.column(k).to_numpy() for k in (0, 2))
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                if current is not None and block[begin] != current:
                    yield close()
                current = int(block[begin])
                held.append(c[begin:end].copy())
        if held:
            yield close()

    placed = counts.select("block", "pos", "c").repartition("block").sortWithinPartitions("block", "pos")
    return placed.mapInArrow(run, "block bigint, words bigint")


# --- subwords ------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str):
    import tiktoken

    ranks = read_ranks(path)
    return tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), ranks


def encode_words(words: list[str], path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of the words, each with a space in front, one after another; and how many each has."""
    encoder, ranks = _encoder(path, pattern)
    width = _id_bytes(path, pattern)
    parts, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for begin in range(0, len(words), WORDS):
        own = words[begin : begin + WORDS]
        text = " " + " ".join(own)
        if pieces_apart(text):
            # Nothing crosses from one word to the next, so that the ids of each end where its bytes do.
            ids = np.array(encoder.encode_ordinary(text), np.int32)
            ends = np.cumsum(np.fromiter((len(w.encode()) for w in own), np.int64, len(own)) + 1)
            after = np.cumsum(width[ids])
            last = np.searchsorted(after, ends)
            if len(after) and last[-1] < len(after) and (after[last] == ends).all():
                parts.append(ids)
                sizes.append(np.diff(last, prepend=-1))
                continue
        coded = [encoder.encode_ordinary(" " + w) for w in own]
        parts.append(np.fromiter(chain.from_iterable(coded), np.int32))
        sizes.append(np.fromiter(map(len, coded), np.int64, len(coded)))
    return np.concatenate(parts), np.concatenate(sizes)


@lru_cache(maxsize=1)
def _id_bytes(path: str, pattern: str) -> np.ndarray:
    """How many bytes each id stands for."""
    ranks = _encoder(path, pattern)[1]
    width = np.zeros(max(ranks.values()) + 1, np.int64)
    width[list(ranks.values())] = [len(token) for token in ranks]
    return width


def id_counts(blocks: DataFrame, path: str, pattern: str) -> list[tuple[int, int]]:
    """(id, uses) over all training words: no more rows than the vocabulary has ids."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(len(_id_bytes(path, pattern)), np.int64)
        for _, file in _listed(batches):
            lexicon = Lexicon.load(file)
            uses += np.bincount(lexicon.ids, np.repeat(lexicon.n, lexicon.sizes), len(uses)).astype(np.int64)
        ids = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(uses[ids])], ["id", "n"])

    found = blocks.mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return sorted((r["id"], r["n"]) for r in found.collect())


class Symbols:
    """Model symbols of the ids: one for each frequent id, the bytes of the others."""

    def __init__(self, uses: list[tuple[int, int]], documents: int, path: str, pattern: str):
        ranks = _encoder(path, pattern)[1]
        name = {rank: token for token, rank in ranks.items()}
        single = [ranks[bytes([b])] for b in range(256) if bytes([b]) in ranks]
        frequent = [i for i, _ in sorted(uses, key=lambda x: (-x[1], x[0]))][: MAX_SYMBOLS - 2 - len(single)]
        # In order of their bytes: classes of neighbours then share how they begin.
        chosen = sorted({*single, *frequent}, key=name.__getitem__)
        symbol = {i: k for k, i in enumerate(chosen, 2)}
        self.spelling: dict[int, list[int]] = {i: [k] for i, k in symbol.items()}
        for rank, token in name.items():
            if rank not in symbol:
                self.spelling[rank] = [symbol[ranks[bytes([b])]] for b in token]
        self.counts = np.zeros(len(chosen) + 2)
        self.counts[BEGIN], self.counts[END] = 0, documents
        for i, n in uses:
            for k in self.spelling[i]:
                self.counts[k] += n


class Speller:
    """Model symbols of the words of a lexicon."""

    def __init__(self, spelling: dict[int, list[int]]):
        self.lengths = np.zeros(max(spelling, default=0) + 1, np.int64)
        for i, symbols in spelling.items():
            self.lengths[i] = len(symbols)
        self.start = np.cumsum(self.lengths) - self.lengths
        self.symbols = np.fromiter(chain.from_iterable(spelling[i] for i in sorted(spelling)), np.int32)

    def spell(self, lexicon: Lexicon) -> Spelt:
        lengths = self.lengths[lexicon.ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(lexicon.sizes)])]
        return Spelt(ragged(self.symbols, self.start[lexicon.ids], lengths), ends[:-1], np.diff(ends))


@dataclass
class Spelt:
    """Symbols of all words one after another, where those of each begin, and how many it has."""

    symbols: np.ndarray
    start: np.ndarray
    lengths: np.ndarray

    def chunks(self, words: np.ndarray, counts: np.ndarray) -> Chunks:
        """Texts of so many of the words each."""
        lengths = self.lengths[words]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return Chunks.of(ragged(self.symbols, self.start[words], lengths), np.diff(ends))


@lru_cache(maxsize=1)
def _speller(key: tuple, path: str, pattern: str) -> Speller:
    """One per worker."""
    uses, documents = key
    return Speller(Symbols(list(uses), documents, path, pattern).spelling)


# --- fitting -------------------------------------------------------------------------------------


def fit(blocks: DataFrame, counts: np.ndarray, key: tuple, path: str, pattern: str, trainers: int, stage: Staging) -> np.ndarray:
    """Weights after all rounds; each takes other documents of the blocks, all of them one or another."""
    weights = Model(counts).vector()
    mine = spread(blocks, trainers)
    for turn in range(ROUNDS):

        def run(batches, start=weights, turn=turn) -> Iterator[pa.RecordBatch]:
            speller, model = _speller(key, path, pattern), Model(counts).load(start)
            parts = []
            for _, file in _listed(batches):
                block, spelt = Block.load(file), speller.spell(Lexicon.load(file))
                chosen = np.flatnonzero(~block.held & (block.part == turn))
                parts += [spelt.chunks(*block.of(chosen[k : k + 256])) for k in range(0, len(chosen), 256)]
            symbols = sum(c.inputs.size for c in parts)
            if not symbols:
                return
            _train(model, parts, turn)
            vector = model.vector()
            cut = np.array_split(vector, SLICES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(SLICES)),
                    pa.array(np.full(SLICES, TaskContext.get().partitionId())),
                    pa.array(np.full(SLICES, float(symbols))),
                    pa.array(cut, pa.list_(pa.float32())),
                ],
                ["slice", "trainer", "weight", "values"],
            )

        schema = "slice bigint, trainer bigint, weight double, values array<float>"
        fitted = stage(mine.mapInArrow(run, schema), f"weights-{turn}")
        weights = _average(fitted, trainers, weights)
    return weights


def _train(model: Model, parts: list[Chunks], turn: int) -> None:
    """One pass over the chunks in steps of BATCH rows."""
    steps = sum(-(-len(c.inputs) // BATCH) for c in parts)
    adam, step = Adam(model, RATE), 0
    for c in parts:
        for begin in range(0, len(c.inputs), BATCH):
            at = slice(begin, begin + BATCH)
            rows = Chunks(c.inputs[at], c.targets[at], c.follows[at].copy(), c.owner[at])
            rows.follows[:1] = False
            _, gradient = model.gradient(rows)
            # Falls to nothing over all rounds, and rises at the start of each.
            left = 1 - (turn + step / steps) / ROUNDS
            adam.update(gradient, RATE * min(1.0, (step + 1) / 40) * max(0.02, left))
            step += 1


def _average(fitted: DataFrame, trainers: int, before: np.ndarray) -> np.ndarray:
    """Mean of the trainers' weights, by their symbols; at most FAN_IN of them meet in one task at a time."""

    def meet(table: pa.Table) -> pa.Table:
        weight = table.column("weight").to_numpy()
        values = np.array(table.column("values").to_pylist(), np.float64)
        mean = (weight @ values) / weight.sum()
        trainer = table.column("trainer")[0].as_py() // FAN_IN
        return pa.table(
            {
                "slice": table.column("slice").slice(0, 1),
                "trainer": pa.array([trainer]),
                "weight": pa.array([weight.sum()]),
                "values": pa.array([mean.astype(np.float32)], pa.list_(pa.float32())),
            }
        )

    left = max(1, trainers)
    while True:
        group = F.expr(f"trainer div {FAN_IN}")
        fitted = fitted.groupBy("slice", group).applyInArrow(
            meet, "slice bigint, trainer bigint, weight double, values array<float>"
        )
        left = -(-left // FAN_IN)
        if left <= 1:
            break
    rows = fitted.orderBy("slice").collect()  # one vector of weights in SLICES pieces
    return np.concatenate([np.array(r["values"], np.float32) for r in rows]) if rows else before


# --- scoring -------------------------------------------------------------------------------------


def score(
    docs: DataFrame,
    stage: Staging,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Tokens are the lower-cased words and one end; null texts are empty and have the end alone.
    base_score sums log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, counts c, N and V being
    those of the training documents; without any of these every token has probability 1.
    score is the log10 probability that the model gives the words in order and the end.
    Rows that repeat are counted and scored each. Empty texts are scored by their end. All training
    documents are fitted, each once.
    """
    held = (remainder(id_col, FOLDS) == HELD_OUT).alias("held")
    part = F.pmod(F.xxhash64(F.lit("part"), id_col), F.lit(ROUNDS)).cast("int").alias("part")
    rows = docs.select(F.col(id_col).alias("_id"), held, part, F.col(text_col).alias("_text"))
    folder = f"{stage.root}/lm-{uuid.uuid4().hex}"
    blocks = stage(write_blocks(rows, folder, path, pattern), "blocks")
    number = blocks.count()
    each = spread(blocks, number)
    totals, placed = corpus_counts(each, stage)
    stage(write_counts(placed, folder), "count-files")
    train_docs = blocks.agg(F.sum("trained")).first()[0] or 0
    first = totals.where("c > 0").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).first()
    n_tokens = (first["n"] or 0) + train_docs
    distinct = first["v"] + (1 if train_docs else 0)
    total = n_tokens + SMOOTHING * (distinct + 1)
    uses = id_counts(each, path, pattern)
    key = (tuple(uses), train_docs)
    symbols = Symbols(uses, train_docs, path, pattern)
    weights = fit(blocks, symbols.counts, key, path, pattern, -(-number // BLOCKS_PER_TRAINER), stage)
    symbol_counts = symbols.counts

    def run(batches) -> Iterator[pa.RecordBatch]:
        speller, model = _speller(key, path, pattern), Model(symbol_counts).load(weights)
        end_base = np.log10((train_docs + SMOOTHING) / total)
        for number, file in _listed(batches):
            block, lexicon = Block.load(file), Lexicon.load(file)
            c = np.frombuffer(get_file(f"{folder}/{number}.counts"), "<i8") if len(lexicon.names) else lexicon.n
            if len(c) != len(lexicon.n) or (c < lexicon.n).any():
                raise RuntimeError(f"block {number} is not the one whose words were counted")
            # What each word adds to the base line, and whether it is known.
            base, known = np.log10((c + SMOOTHING) / total), (c > 0).astype(np.float64)
            spelt = speller.spell(lexicon)
            for begin in range(0, len(block.ids), 256):
                words, n = block.of(np.arange(begin, min(begin + 256, len(block.ids))))
                owner = np.repeat(np.arange(len(n)), n)
                chunks = spelt.chunks(words, n)
                scores = np.bincount(chunks.owner, model.log10(chunks), len(n))
                yield pa.RecordBatch.from_arrays(
                    [
                        block.ids.slice(begin, 256),
                        pa.array(block.held[begin : begin + 256]),
                        pa.array(n + 1),
                        pa.array(np.bincount(owner, known[words], len(n)).astype(np.int64) + (train_docs > 0)),
                        pa.array(np.full(len(n), n_tokens)),
                        pa.array(np.bincount(owner, base[words], len(n)) + end_base),
                        pa.array(scores),
                    ],
                    ["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    kind = rows.schema["_id"].dataType.simpleString()
    schema = (
        f"_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
        " base_score double, score double"
    )
    return each.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
