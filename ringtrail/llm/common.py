"""What several operators share: tables, staging, chunked token lookup, files in shared storage."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from itertools import chain, repeat
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail.session import ensure_scratch
from ringtrail.staging import Staging

# Rows of one Arrow batch: whole documents travel in it, some of them very long.
BATCH_ROWS = 512
# ASCII white space as the contracts have it; Python's bytes.split() cuts at the same bytes.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staging(spark: SparkSession) -> Staging:
    """Cut points below spark.checkpoint.dir, in a session prepared for long texts."""
    ensure_scratch(spark)
    prepare(spark)
    return Staging(spark, sweep=True)


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, as texts may be long, and this package for the Python workers."""
    _ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(BATCH_ROWS))


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send the package to the executors once: they need not have it, nor the driver's folders."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    # A folder of the driver alone, from which Spark hands the file to every executor.
    folder = tempfile.TemporaryDirectory(prefix=f"{package.name}-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    path = f"{folder.name}/{package.name}-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: decides the fold of a document. Null ids: of the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def byte_table(kept: bytes) -> bytes:
    """For bytes.translate: A-Z in lower case, other ASCII characters outside `kept` as a space; bytes of
    other characters stay. Splitting at white space then gives the words of a text."""
    low = bytes(range(128)).lower()
    return bytes(c if c in kept else 32 for c in low) + bytes(range(128, 256))


# --- tokens --------------------------------------------------------------------------------

# A space next to other white space or at either end; the literal first character makes the search fast.
_RISKY = re.compile(r" (?:(?=\s|\Z)|(?<=\s )|(?<=\A ))")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def pieces_apart(text: str) -> bool:
    """Whether every space stands alone between other characters: no byte-level pre-token then crosses one from the left."""
    return not _RISKY.search(text, 1 if text.startswith(" ") and not text[1:2].isspace() else 0)


def chunks_of(text: str) -> list[str]:
    """Pieces at whose borders no byte-level pre-token crosses: before single spaces between other characters.

    Every piece but the first is returned without its leading space.
    """
    if _RISKY.search(text):
        first, *rest = _CUT.split(text)
        return [first, *[x[1:] for x in rest]]
    return text.split(" ")


class ChunkTable:
    """Maps pieces of text to their token ids; encodes each new piece once, in batches.

    Holds at most `limit` pieces; a fuller table is emptied, which costs time but no result.
    """

    def __init__(self, encode_many: Callable[[list[str]], Sequence[Sequence[int]]], limit: int = 600_000):
        self.encode_many, self.limit = encode_many, limit
        self._clear()

    def _clear(self) -> None:
        # A leading piece has no space in front of it, hence a table of its own.
        self.inner: dict[str, int] = {}
        self.leading: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.used = self.count = 0

    def _add(self, names: list[str], index: dict[str, int], prefix: str) -> None:
        encoded = self.encode_many([prefix + x for x in names] if prefix else names)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), np.int32, int(lengths.sum()))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + len(names) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[self.count + 1 : self.count + 1 + len(names)] = self.used + np.cumsum(lengths)
        index.update(zip(names, range(self.count, self.count + len(names)), strict=True))
        self.used += len(flat)
        self.count += len(names)

    def _rows(self, pieces: list[str], index: dict[str, int], prefix: str) -> np.ndarray:
        rows = np.fromiter(map(index.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            at = missing.tolist()
            self._add(list(dict.fromkeys(pieces[i] for i in at)), index, prefix)
            rows[missing] = [index[pieces[i]] for i in at]
        return rows

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        if self.count > self.limit:
            self._clear()
        pieces: list[str] = []
        heads: list[str] = []
        sizes = np.zeros(len(texts), np.int64)
        for n, text in enumerate(texts):
            parts = chunks_of(text)
            heads.append(parts[0])
            pieces += parts[1:]
            sizes[n] = len(parts)
        return self._ids(heads, pieces, sizes)

    def _ids(self, heads: list[str], pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.empty(len(heads) + len(pieces), np.int64)
        first = np.cumsum(sizes) - sizes
        inner = np.ones(len(rows), bool)
        inner[first] = False
        rows[first] = self._rows(heads, self.leading, "")
        rows[inner] = self._rows(pieces, self.inner, " ")
        ids, lengths = self.expand(rows)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, ends[first + sizes] - ends[first]

    def expand(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the given pieces, and how many each piece has."""
        start = self.start[rows]
        lengths = self.start[rows + 1] - start
        return ragged(self.flat, start, lengths), lengths


def ragged(values: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[start[i] : start[i] + lengths[i]] for all i, one after another."""
    total = int(lengths.sum())
    shift = start - (np.cumsum(lengths) - lengths)
    return values[np.repeat(shift, lengths) + np.arange(total)]


# --- files ---------------------------------------------------------------------------------


def _file_system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def put_file(uri: str, data: bytes, attempt: str) -> None:
    """Write a file below shared storage at once: a repeated task replaces it whole."""
    files, path = _file_system(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{os.path.dirname(path)}/.{os.path.basename(path)}.{attempt}"
    with files.open_output_stream(draft, compression=None) as out:
        out.write(data)
    files.move(draft, path)


def get_file(uri: str) -> bytes:
    files, path = _file_system(uri)
    with files.open_input_stream(path, compression=None) as data:
        return data.read()


def open_file(uri: str):
    """A file to read parts of: has size(), seek() and read()."""
    files, path = _file_system(uri)
    return files.open_input_file(path)


def get_range(uri: str, offset: int, length: int) -> bytes:
    """Some bytes of a file, without the rest of it."""
    with open_file(uri) as data:
        data.seek(offset)
        return data.read(length)


def read_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(path, content) of the files written below a folder, one row each."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder).select("path", "content")
