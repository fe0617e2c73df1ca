"""Importance resampling towards a target distribution.

Hashed word features are counted over all documents and over the target texts; the log ratio of
the two shares is one array of gains, and a document's weight is the mean of the gains of its
features. Gumbel noise derived from the id turns "draw without replacement by weight" into "take
the highest scores". A quantile sketch brackets the cutoff, exact counts outside the bracket
confirm it or widen it, and only the bracket is sorted to find the last document drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.functions.ranking import global_rank
from ringtrail.llm.common import byte_table
from ringtrail.staging import Staging

BUCKETS = 10_000
LONGEST = 1
SEED = "2024"
PERCENT = 10
LEAST_WORDS = 20
# First half width of the bracket, as a share of the eligible documents, and the error of the sketch.
SLACK = 0.0005
SKETCH_ACCURACY = 10_000
# Words whose bucket a task remembers.
REMEMBERED = 500_000

_FOLD = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz")


class _Buckets(dict):
    """Bucket of each feature, hashed once while it is remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[feature] = bucket = zlib.crc32(feature) % self.buckets
        return bucket

    def of(self, text: bytes | None, longest: int) -> tuple[np.ndarray, int]:
        """The buckets of all features of a whole text, and its number of words."""
        words = (text or b"").translate(_FOLD).split()
        found = list(map(self.__getitem__, words))
        for size in range(2, longest + 1):
            runs = zip(*[islice(words, k, None) for k in range(size)], strict=False)
            found += [zlib.crc32(b" ".join(run)) % self.buckets for run in runs]
        return np.array(found, np.int64), len(words)


def feature_counts(texts: DataFrame, text_col: str, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts by bucket. Every task sends one number per bucket at most."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        known, counts = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts += np.bincount(known.of(text, longest)[0], minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    found = texts.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the documents)) of each bucket, one added to each count."""
    size, s, t = float(len(raw)), float(raw.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((b + 1.0) * (s + size) / ((a + 1.0) * (t + size)))) for a, b in zip(raw.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def noise(id_col: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, from the digest of seed and id; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, id_col: str, text_col: str, gains: np.ndarray, longest: int = LONGEST, seed: str = SEED) -> DataFrame:
    """(_id, n_words, n_features, weight, score) of every row."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        known = _Buckets(len(gains))
        for batch in batches:
            words, features, weights = [], [], []
            for text in batch.column(1).to_pylist():
                found, n = known.of(text, longest)
                words.append(n)
                features.append(len(found))
                weights.append(int(gains[found].sum()) // len(found) if len(found) else 0)
            numbers = [pa.array(x, pa.int64()) for x in (words, features, weights)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers], ["_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    weighed = rows.mapInArrow(run, f"_id {kind}, n_words bigint, n_features bigint, weight bigint")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("_id"), seed))


def _order() -> list[Column]:
    """Highest score first, then the smaller id; a row without an id comes after those with one."""
    return [F.col("score").desc(), F.col("_id").isNull(), F.col("_id"), F.col("n_features")]


def bracket(scored: DataFrame, total: int, wanted: int, slack: float = SLACK) -> tuple[int, int, int]:
    """(low, high, above): scores between which the `wanted`-th highest lies, and how many are above `high`.

    The sketch proposes, exact counts decide; a bracket that misses the cutoff is widened fourfold.
    """
    share = 1 - wanted / total
    while True:
        ends = [max(share - slack, 0.0), min(share + slack, 1.0)]
        low, high = scored.agg(F.approx_percentile("score", ends, SKETCH_ACCURACY)).first()[0]
        if slack >= 1:
            low, high = scored.agg(F.min("score"), F.max("score")).first()
        row = scored.agg(
            F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score") >= low).alias("reached")
        ).first()
        if row["above"] < wanted <= row["reached"]:
            return low, high, row["above"]
        slack *= 4


def resample(
    docs: DataFrame,
    target: DataFrame,
    stage: Staging,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: str = SEED,
    slack: float = SLACK,
) -> DataFrame:
    """Per row: (id, n_features, weight, score, rank), rank null for what is not drawn.

    Of the N rows with at least `least_words` words the floor(percent * N / 100) with the highest
    scores are drawn; ties go to the smaller id, null ids last, then to fewer features. Rows that
    repeat count each; between rows alike in all of that, any may be the one drawn. Null and empty
    texts have no words: weight 0 and never drawn. An empty target has a share of its own too (one
    is added to every count). Other columns of `docs` are not read.
    """
    gains = gains_of(
        feature_counts(docs, text_col, buckets, longest), feature_counts(target, target_col, buckets, longest)
    )
    scored = stage(weigh(docs, id_col, text_col, gains, longest, seed), "scored")
    eligible = scored.where(F.col("n_words") >= least_words)
    total = eligible.count()
    wanted = percent * total // 100
    out = [F.col("_id").alias(id_col), "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    low, high, above = bracket(eligible, total, wanted, slack)
    inside = eligible.where(F.col("score").between(low, high)).select("score", "_id", "n_features")
    last = global_rank(inside, _order(), "place", stage, may_repeat=True).where(F.col("place") == wanted - above).first()
    # All that is not after the last one drawn; rows that equal it may be more than are wanted.
    sooner = F.col("_id").isNotNull() if last["_id"] is None else F.col("_id") < F.lit(last["_id"])
    same = F.col("_id").eqNullSafe(F.lit(last["_id"])) & (F.col("n_features") <= last["n_features"])
    tied = (F.col("score") == last["score"]) & (F.coalesce(sooner, F.lit(False)) | same)
    reached = (F.col("n_words") >= least_words) & ((F.col("score") > last["score"]) | tied)
    drawn = global_rank(scored.where(reached), _order(), "place", stage, may_repeat=True)
    rank = F.when(F.col("place") <= wanted, F.col("place"))
    return drawn.select(*out, rank.cast("long").alias("rank")).unionByName(
        scored.where(~reached).select(*out, F.lit(None).cast("long").alias("rank"))
    )
