"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within r bits share a variant within r/2 bits of each. Every distinct
fingerprint emits all its variants within half the radius; those that meet in a variant are
verified and linked.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.llm.components import components
from ringtrail.staging import Staging

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
RADIUS = 2

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the shingles of a whole text, as a signed 64-bit number. No words: 0."""
    parts = (text or "").encode().translate(_LOWER).split()
    if not parts:
        return 0
    if len(parts) <= words:
        shingles = [b" ".join(parts)]
    else:
        shingles = list(map(b" ".join, zip(*[itertools.islice(parts, n, None) for n in range(words)], strict=False)))
    n = len(shingles)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    if n < 64:
        ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        # Count byte values, then the bits of each value: eight passes over n bytes.
        by_byte = hashes.view(np.uint8).reshape(n, 8)
        ones = np.concatenate([np.bincount(by_byte[:, b], minlength=256) @ _BYTE_BITS for b in range(8)])
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(_id, fp) of every row."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["_id", "fp"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, fp bigint")


def masks(radius: int) -> list[int]:
    """All signed 64-bit masks of up to half the radius, rounded up, of set bits."""
    out = []
    for size in range((radius + 1) // 2 + 1):
        for bits in itertools.combinations(range(BITS), size):
            value = sum(1 << b for b in bits)
            out.append(value - (1 << BITS) if value >> (BITS - 1) else value)
    return out


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints `fp`, as many as connect what is near.

    All that meet in a variant are put in order and each is linked with the next one: no pairs
    of whole groups. An even radius makes all of them near each other, so that this chain
    connects exactly what the pairs would.
    """
    if radius % 2:
        raise ValueError("the radius must be even: half of it goes to either side")
    variants = F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in masks(radius)])
    met = fps.select("fp", F.explode(variants).alias("variant"))
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = met.select(before.alias("a"), F.col("fp").alias("b")).where("a is not null").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def simhash_groups(
    docs: DataFrame,
    stage: Staging,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """Per row: (id, fingerprint as 16 hex digits, component_id).

    component_id is the smallest id reachable over links of at most `radius` differing bits; null
    ids count only in a component without others. Null and empty texts have fingerprint zero, which
    is linked like any other. Rows that repeat, and rows with equal fingerprints, share a component.
    """
    rows = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    # Equal fingerprints, copies among them, are one node.
    nodes = stage(rows.groupBy("fp").agg(F.min("_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), radius), stage).withColumnRenamed("node", "fp")
    placed = stage(
        nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "placed"
    )
    smallest = stage(placed.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = stage(placed.join(smallest, "root").select("fp", "component_id"), "named")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select(F.col("_id").alias(id_col), text.alias("fingerprint"), "component_id")


def drop_near_copies(
    docs: DataFrame,
    stage: Staging,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """One row of each component, with all columns of `docs`: that with the smallest id, null ids last.

    Rows are told apart by what they hold, id and text, and never by where they lie: a later read of
    the same table may be split otherwise. Of rows that repeat both, the one with the smallest hash of
    all its columns may stay.
    """
    text = F.col(text_col)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    groups = stage(
        simhash_groups(docs.select(key.alias("_key"), text.alias("_text")), stage, "_key", "_text", words, radius)
        .select("_key", "component_id"),
        "members",
    )
    gone = stage(groups.where("_key <> component_id").select(F.col("_key").alias("_gone")).distinct(), "dropped")
    packed = docs.select(F.struct("*").alias("_doc"), key.alias("_key"))
    left = packed.join(gone, F.col("_key").eqNullSafe(F.col("_gone")), "left_anti")
    again = groups.where("_key = component_id").groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = stage(again.select(F.col("_key").alias("_again")), "repeated")
    if again.isEmpty():
        return left.select("_doc.*")
    met = F.col("_key").eqNullSafe(F.col("_again"))
    first = Window.partitionBy("_key").orderBy(F.xxhash64("_doc"))
    one = left.join(again, met, "left_semi").withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return left.join(again, met, "left_anti").select("_doc.*").unionByName(one.select("_doc.*"))
