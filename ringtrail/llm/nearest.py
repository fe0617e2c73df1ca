"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is rounds of random signs and a fast Hadamard transform. In each of TABLES hash
tables two of them place a unit vector: its bucket is the signed axis nearest to the first rotation
and the one nearest to the second. A query probes the buckets with the largest sum of its own two
coordinates. How many it probes is measured, not set: for a bounded sample of queries the true
neighbours are found by brute force, and the probes are as many as reach RECALL of them.

Rows are sent to the cell of their first axis, queries to every cell that holds a bucket they
probe; a cell compares exactly, on the original vectors, and keeps the nearest of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.llm.embedding_dedup import rotate
from ringtrail.staging import Staging

TOP = 10
EVERY = 100
TABLES = 4
# Buckets of a table, at most; longer vectors use fewer axes of the second rotation.
BUCKETS = 1 << 14
# Queries of the sample the probes are fitted on, and the share of true neighbours they reach there.
SAMPLE = 200
RECALL = 0.96
# Rows of a cell compared in one task; larger cells are cut by a hash of the id.
BLOCK = 4096
# Pairs whose exact distances are formed at once: in a tight cluster nearly all of a cell can be needed.
PAIRS = 1 << 16
_TURN = 1000


# --- hashing -------------------------------------------------------------------------------


def second_axes(width: int) -> int:
    """Signed axes of the second rotation, for padded vectors of a width."""
    return 2 * min(width, max(1, BUCKETS // (2 * width) // 2))


def padded(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, filled up to a power of two; scaled first, so that no square leaves the range."""
    out = np.zeros((len(vectors), 1 << max(0, (vectors.shape[1] - 1).bit_length())))
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    out[:, : vectors.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def first_axis(units: np.ndarray, table: int) -> np.ndarray:
    """Coordinates on the signed axes of a table's first rotation."""
    x = rotate(units, _TURN + 2 * table)
    return np.concatenate([x, -x], axis=1)


def second_axis(units: np.ndarray, table: int) -> np.ndarray:
    x = rotate(units, _TURN + 2 * table + 1)[:, : second_axes(units.shape[1]) // 2]
    return np.concatenate([x, -x], axis=1)


def codes(units: np.ndarray) -> np.ndarray:
    """(rows, TABLES) bucket numbers."""
    axes = second_axes(units.shape[1])
    return np.stack(
        [first_axis(units, t).argmax(axis=1) * axes + second_axis(units, t).argmax(axis=1) for t in range(TABLES)], axis=1
    )


def thresholds(units: np.ndarray, probes: int | None, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First coordinates, the largest second one, and the sum that the best `probes` buckets reach (None: all)."""
    first, second = first_axis(units, table), second_axis(units, table)
    if probes is None or probes >= first.shape[1] * second.shape[1]:
        return first, second.max(axis=1), np.full(len(units), -np.inf)
    sums = (first[:, :, None] + second[:, None, :]).reshape(len(units), -1)
    return first, second.max(axis=1), np.partition(sums, -probes, axis=1)[:, -probes]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, also where squares leave the range of doubles."""
    gap = a - b
    with np.errstate(over="ignore"):
        out = np.sqrt((gap * gap).sum(axis=1))
    odd = np.flatnonzero(~np.isfinite(out) | (out < 1e-140))
    if len(odd):
        most = np.abs(gap[odd]).max(axis=1, initial=0)
        scaled = gap[odd] / np.where(most > 0, most, 1)[:, None]
        out[odd] = most * np.sqrt((scaled * scaled).sum(axis=1))
    return out


def _by_width(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) for each length among the vectors of a column."""
    lengths = column.value_lengths().to_numpy()
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        yield at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), width)


# --- comparing -----------------------------------------------------------------------------


def nearest(x: np.ndarray, q: np.ndarray, probed: np.ndarray | None, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of at least the `keep` nearest rows of each query, ties included.

    `probed` tells which pairs count. Products find them, the exact distance decides: pairs within the
    rounding error of the last one stay in.
    """
    scale = max(np.abs(x).max(initial=0), np.abs(q).max(initial=0))
    if scale > 1e100:
        close = nearest_squares(x / scale, q / scale, probed, keep)
    else:
        close = nearest_squares(x, q, probed, keep)
    a, b = np.nonzero(close)
    parts = [slice(begin, begin + PAIRS) for begin in range(0, len(a), PAIRS)]
    return a, b, np.concatenate([np.zeros(0), *[distances(x[b[part]], q[a[part]]) for part in parts]])


def nearest_squares(x: np.ndarray, q: np.ndarray, probed: np.ndarray | None, keep: int) -> np.ndarray:
    xs, qs = (x * x).sum(axis=1), (q * q).sum(axis=1)
    square = qs[:, None] + xs[None, :] - 2 * (q @ x.T)
    if probed is not None:
        square[~probed] = np.inf
    if x.shape[0] <= keep:
        return np.isfinite(square)
    last = np.partition(square, keep - 1, axis=1)[:, keep - 1] + 1e-9 * (qs + xs.max())
    return np.isfinite(square) & (square <= last[:, None])


def probed_pairs(code: np.ndarray, base: np.ndarray, second: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether each query probes the bucket of each row of its cell: rows by their second axis."""
    return (base[:, None] + second >= least[:, None])[:, code]


# --- over all vectors ----------------------------------------------------------------------


def _groups(rows: DataFrame, stage: Staging, keep: int) -> DataFrame:
    """(vec, ids): each vector once, with the smallest `keep` ids that have it."""
    again = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    again = stage(again, "repeated")
    single = rows.join(again, "h", "left_anti").select("vec", F.array("id").alias("ids"))
    several = rows.join(again, "h", "left_semi").select("vec", "id").distinct()
    order = Window.partitionBy("vec").orderBy("id")
    several = several.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    several = several.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return stage(single.unionByName(several), "vectors")


def fit_probes(groups: DataFrame, sample: list, top: int = TOP, recall: float = RECALL) -> dict[int, int]:
    """Probes per table by padded width: as many as reach `recall` of the true neighbours of the sample.

    One pass compares the sample, a bounded number of vectors, with every row.
    """
    by_width: dict[int, np.ndarray] = {}
    for vector in sample:
        by_width.setdefault(len(vector), []).append(vector)
    by_width = {n: np.array(v, float) for n, v in by_width.items()}

    def run(batches) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list] = {}
        for batch in batches:
            for _, x in _by_width(batch.column(0)):
                q = by_width.get(x.shape[1])
                if q is None:
                    continue
                for k, j, d in zip(*[v.tolist() for v in nearest(x, q, None, top + 1)], strict=True):
                    if d > 0:  # the vector itself is in the same bucket anyway
                        best.setdefault((x.shape[1], k), []).append((d, x[j].copy()))  # a view would hold its batch
                for key in [key for key, found in best.items() if len(found) > 4 * top]:
                    best[key] = sorted(best[key], key=lambda f: f[0])[:top]
        rows = [(w, k, d, v) for (w, k), found in best.items() for d, v in sorted(found, key=lambda f: f[0])[:top]]
        w, k, d, v = zip(*rows, strict=True) if rows else ((), (), (), ())
        columns = [pa.array(w, pa.int32()), pa.array(k, pa.int32()), pa.array(d, pa.float64()), pa.array(list(v), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["w", "k", "d", "v"])

    found = groups.select("vec").mapInArrow(run, "w int, k int, d double, v array<double>")
    order = Window.partitionBy("w", "k").orderBy("d")
    truth = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).collect()
    ranks: dict[int, list[int]] = {}
    for width, q in by_width.items():
        pairs = [(r["k"], r["v"]) for r in truth if r["w"] == width]
        if not pairs:
            continue
        asked, near = padded(q[[k for k, _ in pairs]]), padded(np.array([v for _, v in pairs], float))
        code, axes = codes(near), second_axes(near.shape[1])
        least = np.full(len(pairs), np.iinfo(np.int64).max)
        for t in range(TABLES):
            first, second = first_axis(asked, t), second_axis(asked, t)
            here = np.arange(len(pairs))
            own = first[here, code[:, t] // axes] + second[here, code[:, t] % axes]
            for k in here.tolist():
                least[k] = min(least[k], np.count_nonzero(first[k][:, None] + second[k][None, :] > own[k]))
        ranks.setdefault(near.shape[1], []).extend(least.tolist())
    return {w: sorted(r)[max(0, int(np.ceil(recall * len(r))) - 1)] + 1 for w, r in ranks.items()}


def _hashed(groups: DataFrame) -> DataFrame:
    """(vec, ids, width, axes, code): code has a bucket per table, axes the second axes of each first one."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _by_width(batch.column(0)):
                part = batch.take(pa.array(at))
                units = padded(x)
                code = pa.array(codes(units).tolist(), pa.list_(pa.int32()))
                width, axes = (pa.array(np.full(len(at), n, np.int32)) for n in (x.shape[1], second_axes(units.shape[1])))
                yield pa.RecordBatch.from_arrays([*part.columns, width, axes, code], ["vec", "ids", "width", "axes", "code"])

    kinds = {f.name: f.dataType.simpleString() for f in groups.schema}
    return groups.select("vec", "ids").mapInArrow(run, f"vec {kinds['vec']}, ids {kinds['ids']}, width int, axes int, code array<int>")


def _probes(asked: DataFrame, probes: dict[int, int], tables: int) -> DataFrame:
    """(h, q, vec, width, t, a, base, least): every cell that holds a bucket a query probes."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _by_width(batch.column(2)):
                # The sums of all buckets are held for a few queries at a time.
                for begin in range(0, len(at), 64):
                    part = at[begin : begin + 64]
                    units = padded(x[begin : begin + 64])
                    for t in range(tables):
                        first, most, least = thresholds(units, probes.get(units.shape[1]), t)
                        k, a = np.nonzero(first + most[:, None] >= least[:, None])
                        rows = batch.take(pa.array(part[k]))
                        numbers = [np.full(len(k), n, np.int32) for n in (x.shape[1], t)]
                        extra = [*map(pa.array, numbers), pa.array(a.astype(np.int32)), pa.array(first[k, a]), pa.array(least[k])]
                        yield pa.RecordBatch.from_arrays(
                            [*rows.columns, *extra], ["h", "q", "vec", "width", "t", "a", "base", "least"]
                        )

    kind = asked.schema["vec"].dataType.simpleString()
    shape = f"h bigint, q bigint, vec {kind}, width int, t int, a int, base double, least double"
    return asked.select("h", "q", "vec").mapInArrow(run, shape)


class _Cell:
    """Rows of one cell, then its queries, as they come in order."""

    def __init__(self, keep: int):
        self.keep, self.key, self.held, self.rows = keep, None, [], None

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Results for each run of rows with the same cell and kind."""
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
            *cell, kind = keys[begin].tolist()
            if cell != self.key:
                self.key, self.held, self.rows = cell, [], None
            part = batch.slice(begin, end - begin)
            if kind == 0:
                self.held.append(part)
            elif self.held:
                yield self.answer(part)

    def answer(self, part: pa.RecordBatch) -> pa.RecordBatch:
        width, table = self.key[0], self.key[1]
        column = dict(zip(part.schema.names, part.columns, strict=True))
        if self.rows is None:
            whole = pa.concat_batches(self.held)
            held = dict(zip(whole.schema.names, whole.columns, strict=True))
            x = held["vec"].flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
            sizes = held["ids"].value_lengths().to_numpy()
            self.rows = x, held["second"].to_numpy(zero_copy_only=False).astype(int), held["ids"].flatten().to_numpy(), sizes
        x, code, ids, sizes = self.rows
        q = column["vec"].flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
        base, least = (column[n].to_numpy(zero_copy_only=False) for n in ("base", "least"))
        second = second_axis(padded(q), table)
        a, b, d = nearest(x, q, probed_pairs(code, base, second, least), self.keep)
        # Every id of the vectors found, then the nearest of each query.
        start = np.cumsum(sizes) - sizes
        times = sizes[b]
        pick = np.repeat(start[b] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        a, d, i = np.repeat(a, times), np.repeat(d, times), ids[pick]
        order = np.lexsort((i, d, a))
        a, d, i = a[order], d[order], i[order]
        first = np.searchsorted(a, a)
        best = np.arange(len(a)) - first < self.keep
        rows = pa.array(a[best])
        columns = [column["h"].take(rows), column["q"].take(rows), pa.array(i[best], pa.int64()), pa.array(d[best], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["h", "q", "id", "score"])


def _search(hashed: DataFrame, sizes: DataFrame, asked: DataFrame, probes: dict[int, int], tables: int, keep: int) -> DataFrame:
    """(h, q, id, score): the nearest of each query among the buckets it probes, in any order, some twice."""
    axes = F.col("axes")
    rows = hashed.select("vec", "ids", "width", "axes", F.posexplode(F.slice("code", 1, tables)).alias("t", "bucket"))
    rows = rows.select("vec", "ids", "width", "t", F.floor(F.col("bucket") / axes).cast("int").alias("a"), (F.col("bucket") % axes).alias("second"))
    cells = ["width", "t", "a"]
    rows = rows.join(sizes, cells).withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0], "vec"), F.col("blocks")).cast("int"))
    sent = _probes(asked, probes, tables).join(sizes, cells).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    none = F.lit(None)
    kind = hashed.schema["ids"].dataType
    both = rows.select(*cells, "block", F.lit(0).alias("kind"), "vec", "ids", "second", none.cast("long").alias("h"), none.cast("long").alias("q"),
        none.cast("double").alias("base"), none.cast("double").alias("least"),
    ).unionByName(
        sent.select(*cells, "block", F.lit(1).alias("kind"), "vec", none.cast(kind).alias("ids"), none.cast("int").alias("second"), "h", "q", "base", "least")
    )

    def run(batches) -> Iterator[pa.RecordBatch]:
        cell = _Cell(keep)
        for batch in batches:
            if len(batch):
                yield from cell.feed(batch)

    dealt = both.repartition(*cells, "block").sortWithinPartitions(*cells, "block", "kind")
    return dealt.mapInArrow(run, "h bigint, q bigint, id bigint, score double")


def search(
    vectors: DataFrame,
    stage: Staging,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    top: int = TOP,
    every: int = EVERY,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, id, score): for every row whose id is divisible by `every`, the `top` nearest rows
    found among all others, nearest first, equal distances by the smaller id. score is the Euclidean
    distance of the original vectors in double precision.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and rows without an id,
    take no part; vectors are compared with those of their own length alone. Equal vectors are searched
    once, whatever their number, and all their ids count. Rows equal in id and vector count once; an id
    with several vectors counts with each, and a query leaves out all rows of its own id. A query that
    finds fewer than `top` in its buckets is compared with all rows of its length. Empty tables give
    no rows.
    """
    element = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = F.col("id").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0)
    # Negative zeros are zeros: equal vectors have one hash.
    rows = stage(rows.where(usable).withColumn("vec", F.transform("vec", lambda x: x + F.lit(0).cast(element))).withColumn("h", F.xxhash64("vec")), "rows")
    keep = top + 1
    groups = _groups(rows, stage, keep)
    queries = rows.where(F.col("id") % every == 0)
    asked = stage(queries.groupBy("vec", "h").agg(F.min("id").alias("q")), "asked")
    sample = [list(r["vec"]) for r in asked.orderBy("h", "q").limit(SAMPLE).select("vec").collect()]
    probes = fit_probes(groups, sample, top, recall)
    hashed = stage(_hashed(groups), "hashed")
    bucket = hashed.select("width", "axes", F.posexplode("code").alias("t", "bucket"))
    bucket = bucket.select("width", "t", F.floor(F.col("bucket") / F.col("axes")).cast("int").alias("a"))
    sizes = bucket.groupBy("width", "t", "a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sizes = stage(sizes, "cells")
    found = _nearest(_search(hashed, sizes, asked, probes, TABLES, keep), keep)
    found = stage(found, "found")
    # Queries whose buckets hold too little go over all cells of one table.
    there = rows.groupBy(F.size("vec").alias("width")).agg(F.count_distinct("id").alias("there"))
    enough = found.groupBy("h", "q").agg(F.count(F.lit(1)).alias("n"))
    short = asked.join(enough, ["h", "q"], "left").withColumn("width", F.size("vec")).join(there, "width")
    short = short.where(F.coalesce("n", F.lit(0)) < F.least(F.lit(keep), F.col("there"))).select("vec", "h", "q")
    short = stage(short, "short")
    if not short.isEmpty():
        more = _nearest(_search(hashed, sizes, short, {}, 1, keep), keep)
        found = stage(found.join(short.select("h", "q"), ["h", "q"], "left_anti").unionByName(more), "all-found")
    named = queries.select("id", "vec", "h").distinct().withColumnRenamed("id", "query_id")
    named = named.join(asked.withColumnsRenamed({"vec": "v", "h": "g"}), (F.col("h") == F.col("g")) & (F.col("vec") == F.col("v")))
    answers = named.select("query_id", "h", "q").join(found, ["h", "q"]).where("id <> query_id")
    order = Window.partitionBy("query_id", "h", "q").orderBy("score", "id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "query_id", "rank", F.col("id").alias(id_col), "score"
    )


def _nearest(found: DataFrame, keep: int) -> DataFrame:
    """What is found in several tables stands in several rows of one rank; then each once."""
    order = Window.partitionBy("h", "q").orderBy("score", "id")
    return found.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= keep).drop("place").distinct()
