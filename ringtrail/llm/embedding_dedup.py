"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

A rotation is three rounds of random signs and a fast Hadamard transform; the hash is the signed
axis nearest to the rotated vector. Two hashes make a bucket, the second nearest axes give probes.
Vectors that meet in a bucket are compared exactly. Equal vectors are compared once and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.components import components
from ringtrail.staging import Staging

THRESHOLD = 0.93
TABLES = 4
SEED = 5
# Rows of a bucket compared at once; larger buckets are cut into blocks, and all pairs of blocks compared.
BLOCK = 256
PROBES = 3
BUCKETS = TABLES * PROBES


# --- hashing -------------------------------------------------------------------------------


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, normalised; their length is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def rotate(x: np.ndarray, turn: int) -> np.ndarray:
    for k in range(3):
        signs = np.random.default_rng((SEED, turn, k)).choice([-1.0, 1.0], x.shape[1])
        x = hadamard(x * signs)
    return x


def axes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and second nearest signed axis of each row."""
    two = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :2]
    if two.shape[1] < 2:
        two = np.repeat(two, 2, axis=1)
    code = two * 2 + (np.take_along_axis(x, two, axis=1) < 0)
    return code[:, 0], code[:, 1]


def bucket_codes(vectors: np.ndarray) -> np.ndarray:
    """The buckets of each row: TABLES times the nearest one and the probes; distinct across tables."""
    width = 1 << max(0, (vectors.shape[1] - 1).bit_length())
    x = np.zeros((len(vectors), width))
    x[:, : vectors.shape[1]] = vectors
    out = []
    for t in range(TABLES):
        (a, a2), (b, b2) = axes(rotate(x, 2 * t)), axes(rotate(x, 2 * t + 1))
        for p, q in ((a, b), (a2, b), (a, b2)):
            out.append((t * 2 * width + p) * 2 * width + q)
    return np.stack(out, axis=1)


# --- comparing -----------------------------------------------------------------------------


def _met_before(left: np.ndarray, right: np.ndarray, bucket: int) -> np.ndarray:
    """Whether the bucket lists of each pair share a bucket before this one: then it was counted there."""
    met = np.zeros(len(left), bool)
    for p in range(left.shape[1]):
        low = left[:, p] < bucket
        for q in range(right.shape[1]):
            met |= low & (left[:, p] == right[:, q])
    return met


def compare_cell(ids, copies, units, lists, side, bucket: int, same_block: bool, threshold: float):
    """(id, links, root) of the rows of a cell: links not counted in an earlier bucket, and the
    smallest id of the cell reached over links."""
    n = len(ids)
    if same_block:
        first = second = np.arange(n)
    else:
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    near = units[first] @ units[second].T >= threshold
    a, b = np.nonzero(near)
    a, b = first[a], second[b]
    if same_block:
        a, b = a[a < b], b[a < b]
    links = np.zeros(n, np.int64)
    fresh = np.ones(len(a), bool)
    for begin in range(0, len(a), 1 << 18):
        part = slice(begin, begin + (1 << 18))
        fresh[part] = ~_met_before(lists[a[part]], lists[b[part]], bucket)
    np.add.at(links, a[fresh], copies[b[fresh]])
    np.add.at(links, b[fresh], copies[a[fresh]])
    root = ids.copy()
    while len(a):
        low = np.minimum(root[a], root[b])
        if (root[a] == low).all() and (root[b] == low).all():
            break
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
    return links, root


def _same_width(batches) -> Iterator[pa.RecordBatch]:
    """Batches cut where the length of the vectors changes."""
    for batch in batches:
        widths = batch.column(batch.schema.get_field_index("vector")).value_lengths().to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(widths)) + 1).tolist(), len(batch)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if end > begin:
                yield batch.slice(begin, end - begin)


class _Rows:
    """Rows in order of their cell, of which whole cells are taken out."""

    NAMES = ("label", "bucket", "i", "j", "side", "id", "copies", "vector", "lists")

    def __init__(self, batch: pa.RecordBatch):
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        for name in self.NAMES[:7]:
            setattr(self, name, columns[name].to_numpy(zero_copy_only=False))
        n = len(batch)
        self.vector = columns["vector"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
        self.lists = columns["lists"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))

    def cells(self) -> np.ndarray:
        """Starts of the cells, and the end."""
        new = np.zeros(len(self.id), bool)
        new[:1] = True
        for column in (self.label, self.bucket, self.i, self.j):
            new[1:] |= column[1:] != column[:-1]
        return np.append(np.flatnonzero(new), len(new))


def _compare(rows: _Rows, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bounds = rows.cells()
    sizes = np.diff(bounds)
    out_id, out_links, out_root = [], [], []
    for begin, size in zip(bounds[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        at = slice(begin, begin + size)
        units = rows.vector[at]
        same = rows.i[begin] == rows.j[begin]
        links, root = compare_cell(
            rows.id[at], rows.copies[at], units, rows.lists[at], rows.side[at], int(rows.bucket[begin]), same, threshold
        )
        told = (links > 0) | (root != rows.id[at])
        if told.any():
            out_id.append(rows.id[at][told])
            out_links.append(links[told])
            out_root.append(root[told])
    if not out_id:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    return np.concatenate(out_id), np.concatenate(out_links), np.concatenate(out_root)


def near_duplicates(
    vectors: DataFrame,
    stage: Staging,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: (id, n_links, component_id, kept), for vectors of equal label and length.

    n_links counts the other rows linked directly, rows with an equal vector among them;
    component_id is the smallest id reachable. A null label, and a vector that is null, empty, zero
    or holds a null or non-finite number, links with nothing. Ids are whole numbers; rows with a
    null id come out unlinked, and rows that repeat an id are rows of their own for n_links.
    """
    rows = stage(
        vectors.select(
            F.col(id_col).cast("long").alias("_id"),
            F.col(label_col).cast("string").alias("_label"),
            F.col(vector_col).cast("array<double>").alias("_vector"),
        ),
        "vectors",
    )
    bad = F.exists("_vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~bad & F.exists("_vector", lambda x: x != 0)
    valid = rows.where(usable)
    groups = stage(
        valid.groupBy("_label", "_vector").agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_copies")), "distinct"
    )
    links, edges = _links(groups, stage, threshold)
    roots = components(edges, stage).withColumnRenamed("node", "_rep")
    reps = groups.join(links, "_rep", "left").join(roots, "_rep", "left")
    n_links = F.col("_copies") - 1 + F.coalesce("links", F.lit(0))
    reps = reps.select("_label", "_vector", n_links.alias("n_links"), "_rep", F.coalesce("root", "_rep").alias("root"))
    reps = stage(reps, "representatives")
    smallest = stage(reps.groupBy("root").agg(F.min("_rep").alias("component_id")), "smallest")
    reps = stage(reps.join(smallest, "root").select("_label", "_vector", "n_links", "component_id"), "classes")
    key = (rows._label == reps._label) & (rows._vector == reps._vector)
    found = rows.join(reps, key, "left").select(rows._id, "n_links", "component_id")
    component = F.coalesce("component_id", "_id")
    return found.select(
        F.col("_id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("_id") == component).alias("kept"),
    )


def _links(groups: DataFrame, stage: Staging, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(_rep, links) and edges (a, b) of the distinct vectors."""

    def hash_all(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            lengths = columns["_vector"].value_lengths().to_numpy()
            units = np.empty(len(batch), object)
            lists = np.empty(len(batch), object)
            for width in np.unique(lengths):
                at = np.flatnonzero(lengths == width)
                x = np.array(columns["_vector"].take(pa.array(at)).to_pylist(), float)
                # Scaled first, so that squares of very large or small numbers stay in range.
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for k, unit, codes in zip(at.tolist(), x, bucket_codes(x), strict=True):
                    units[k], lists[k] = unit, np.unique(codes)
            label = [f"{n}:{a}" for n, a in zip(lengths.tolist(), columns["_label"].to_pylist(), strict=True)]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(label),
                    columns["_rep"],
                    columns["_copies"],
                    pa.array(units.tolist(), pa.list_(pa.float64())),
                    pa.array([np.pad(x, (0, BUCKETS - len(x)), constant_values=-1) for x in lists], kind),
                ],
                ["label", "id", "copies", "vector", "lists"],
            )

    hashed = stage(
        groups.mapInArrow(hash_all, "label string, id bigint, copies bigint, vector array<double>, lists array<bigint>"),
        "hashed",
    )
    spread = hashed.withColumn("bucket", F.explode(F.filter("lists", lambda b: b >= 0)))
    # Only buckets with company go on; a large one is cut into blocks.
    shared = hashed.select("label", F.explode(F.filter("lists", lambda b: b >= 0)).alias("bucket"))
    shared = shared.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(
        shared.select(
            F.col("label").alias("_l"), F.col("bucket").alias("_b"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
        ),
        "buckets",
    )
    met = spread.join(shared, (F.col("label") == F.col("_l")) & (F.col("bucket") == F.col("_b")))
    met = met.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # A row of block c meets every block: cells (c, j) and (j, c), lower block first.
    met = met.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cell = met.select(
        "label", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "copies", "vector", "lists",
    )
    keys = ["label", "bucket", "i", "j"]
    parts = cell.repartition(*keys).sortWithinPartitions(*keys, "id")

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in _same_width(batches):
            if held is not None and width(held) != width(batch):
                yield told(held)
                held = None
            whole = batch if held is None else pa.concat_batches([held, batch])
            bounds = _Rows(whole).cells()
            last = int(bounds[-2])
            # The last cell may go on in the next batch; a cell is at most two blocks.
            held = whole.slice(last)
            if last:
                yield told(whole.slice(0, last))
        if held is not None:
            yield told(held)

    def width(batch: pa.RecordBatch) -> int:
        return len(batch.column(batch.schema.get_field_index("vector"))[0])

    def told(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in _compare(_Rows(batch), threshold)], ["_rep", "links", "root"])

    found = stage(parts.mapInArrow(run, "_rep bigint, links bigint, root bigint"), "found")
    links = found.groupBy("_rep").agg(F.sum("links").alias("links"))
    edges = found.where("_rep <> root").select(F.col("_rep").alias("a"), F.col("root").alias("b"))
    return links, edges
