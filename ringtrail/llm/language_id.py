"""Language identification by cross-parsing entropy.

The labelled text of each language becomes a suffix automaton. A document is cut greedily into
the longest pieces that occur in that text (its cross parsing); the language that needs the
fewest phrases per character wins. Letters count, in lower case; everything else is one space.

Documents are parsed in sections of SECTION letters, all sections of a batch side by side: one
step moves every section by one character in every automaton. A section begins a new phrase.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringtrail.functions.ranking import top_k_per_group
from ringtrail.llm.common import remainder

FOLDS, HELD_OUT = 4, 2
UNDEFINED = "und"
# Bound of the labelled sample: so many documents of each language, in the order of a hash of
# their ids, a piece of each from a hashed place, and of these joined so many letters and spaces.
SAMPLE_DOCS = 48
SAMPLE_PIECE = 300
SAMPLE_CHARS = 12_000
SECTION = 2048
# Score from which a prediction overrules a label.
CERTAIN = 0.5

_TOP = 0x110000


@lru_cache(maxsize=1)
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case form of every code point that is a letter, 0 for the others; and which are letters."""
    out = np.zeros(_TOP, np.uint32)
    for code in range(_TOP):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out, out > 0


def letters(text: str) -> np.ndarray:
    """Folded code points of a text; each run of anything but letters is one 0, none at the ends."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = _folding()[0][codes]
    keep = folded > 0
    keep[1:] |= folded[:-1] > 0
    folded = folded[keep]
    return folded[:-1] if len(folded) and folded[-1] == 0 else folded


# --- suffix automata -------------------------------------------------------------------------


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the empty one."""
    move: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for s in symbols:
        state = len(move)
        move.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in move[p]:
            move[p][s] = state
            p = link[p]
        if p >= 0:
            q = move[p][s]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                clone = len(move)
                move.append(dict(move[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and move[p].get(s) == q:
                    move[p][s] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return move


class Parser:
    """The automata of all languages in one table of transitions.

    An entry is twice the row of the next state, odd where the current phrase cannot go on and
    the character begins a new one.
    """

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in texts]
        parts = [letters(text)[:SAMPLE_CHARS] for _, text in texts]
        known = np.unique(np.concatenate([*parts, np.zeros(1, np.uint32)]))
        self.width = len(known) + 1  # the last symbol stands for letters of no sample
        self.symbol = np.full(_TOP, self.width - 1, np.int32)
        self.symbol[known] = np.arange(len(known))
        tables, self.roots, begin = [], [], 0
        for part in parts:
            move = suffix_automaton(self.symbol[part].tolist())
            table = np.full((len(move), self.width), -1, np.int64)
            for state, targets in enumerate(move):
                for s, to in targets.items():
                    table[state, s] = (begin + to) * self.width * 2
            restart = np.where(table[0] >= 0, table[0], begin * self.width * 2) | 1
            table = np.where(table >= 0, table, restart)
            table[0] = restart  # nothing of a phrase is read yet: the next character begins one
            tables.append(table)
            self.roots.append(begin * self.width)
            begin += len(move)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int64)
        if len(self.table) < 1 << 30:
            self.table = self.table.astype(np.int32)  # half the cache

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text in each language; 0 for an empty text."""
        size = np.array([len(t) for t in texts], np.int64)
        out = np.zeros((len(texts), len(self.names)), np.int64)
        pieces = (size + SECTION - 1) // SECTION
        if not pieces.sum():
            return out
        flat = self.symbol[np.concatenate(texts)].astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = (np.cumsum(size) - size)[owner] + nth * SECTION
        lengths = np.minimum(size[owner] - nth * SECTION, SECTION)
        order = np.argsort(-lengths, kind="stable")
        start, lengths = start[order], lengths[order]
        state = np.tile(np.array(self.roots, np.int64), (len(order), 1))
        count = np.zeros(state.shape, np.int64)
        # How many sections are longer than t, for every t.
        active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
        for t, k in enumerate(active.tolist()):
            here = state[:k]
            here += flat[start[:k] + t, None]
            found = self.table.take(here)
            count[:k] += found & 1
            np.right_shift(found, 1, out=here)
        np.add.at(out, owner[order], count)
        return out


@lru_cache(maxsize=2)
def parser(texts: tuple[tuple[str, str], ...]) -> Parser:
    """One per worker."""
    return Parser(texts)


# --- learning and predicting -------------------------------------------------------------------


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    known = F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    return docs.where(known & (remainder(id_col, FOLDS) != HELD_OUT))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """((language, text), ...): the bounded labelled sample, at most SAMPLE_DOCS pieces of a language."""
    place = F.xxhash64(F.lit("sample"), id_col)
    begin = F.pmod(place, F.greatest(F.length(text_col) - SAMPLE_PIECE, F.lit(1))) + 1
    rows = training_rows(docs, id_col, text_col, lang_col).select(
        F.col(lang_col).alias("lang"),
        F.substring(F.col(text_col), begin.cast("int"), F.lit(SAMPLE_PIECE)).alias("piece"),
        F.col(id_col).alias("id"),
        place.alias("place"),
    )
    rows = rows.where(F.regexp_like("piece", F.lit(r"\p{L}")))
    few = top_k_per_group(rows, ["lang"], [F.col("place"), F.col("id"), F.col("piece")], SAMPLE_DOCS, "k")
    found: dict[str, list[str]] = {}
    for row in few.orderBy("lang", "k").collect():  # bounded by the constants above and the languages
        found.setdefault(row["lang"], []).append(row["piece"])
    return tuple((lang, " ".join(pieces)) for lang, pieces in sorted(found.items()))


def score_texts(coder: Parser, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, phrases per letter of the winner) of each text."""
    folded = [letters(t or "") for t in texts]
    size = np.maximum(np.array([len(f) for f in folded], float), 1.0)
    none = np.array([len(f) == 0 for f in folded], bool)
    if not coder.names:
        return [UNDEFINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    rate = coder.phrases(folded) / size[:, None]
    best = rate.argmin(axis=1)  # ties: the first name in order
    win = rate[np.arange(len(texts)), best]
    others = rate.copy()
    others[np.arange(len(texts)), best] = np.inf
    second = others.min(axis=1) if len(coder.names) > 1 else np.full(len(texts), np.inf)
    # Twice the share by which the next language needs more phrases, 1 at most.
    gap = np.where(np.isinf(second), 1.0, np.minimum(1.0, 2 * (second - win) / np.maximum(second, 1e-12)))
    score = np.where(none, 0.0, gap)
    return [UNDEFINED if n else coder.names[b] for n, b in zip(none, best, strict=True)], score, np.where(none, 0, win)


def identify(
    docs: DataFrame,
    sample: tuple[tuple[str, str], ...],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: (id, held_out, lang_pred, score, phrase_rate), from the whole text alone.

    lang_pred is `und` with score 0 where the text is null or has no letter, or where nothing was
    learned; score is in 0 to 1, larger where the second language fits worse.
    """
    added = ["held_out", "lang_pred", "score", "phrase_rate"]

    def run(batches):
        coder = parser(sample)
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            names, score, rate = score_texts(coder, batch.column(at).to_pylist())
            kept = [c for n, c in enumerate(batch.columns) if n != at]
            columns = [*kept, pa.array(names), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(columns, [*[n for n in batch.schema.names if n != "_text"], *added[1:]])

    held = (remainder(id_col, FOLDS) == HELD_OUT).alias("held_out")
    rows = docs.select(F.col(id_col), held, F.col(text_col).alias("_text"))
    schema = T.StructType([f for f in rows.schema if f.name != "_text"])
    schema = schema.add("lang_pred", "string").add("score", "double").add("phrase_rate", "double")
    return rows.mapInArrow(run, schema)


def keep_identified(
    docs: DataFrame,
    sample: tuple[tuple[str, str], ...],
    text_col: str = "text",
    lang_col: str = "lang",
    certain: float = CERTAIN,
) -> DataFrame:
    """The rows of `docs` in a language, and in that of their label, with all their columns.

    Rejected are null texts and texts without a letter, and texts that fit another language than their
    label so much better that the prediction's score is `certain` or more. A null label agrees with
    every prediction. Rows that repeat are judged each, all alike.
    """
    packed = docs.select(F.struct("*").alias("_doc"))

    def run(batches):
        coder = parser(sample)
        for batch in batches:
            rows = batch.column(0)
            names, score, _ = score_texts(coder, rows.field(text_col).to_pylist())
            labels = rows.field(lang_col).to_pylist()
            keep = [
                name != UNDEFINED and (label is None or label == name or s < certain)
                for name, label, s in zip(names, labels, score.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([rows.filter(pa.array(keep, pa.bool_()))], ["_doc"])

    return packed.mapInArrow(run, packed.schema).select("_doc.*")
