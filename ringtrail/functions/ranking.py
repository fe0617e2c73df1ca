"""Ranks over a whole table and within groups."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.staging import Staging

# monotonically_increasing_id packs the partition number above 33 bits of row position.
_POSITION_BITS = 33


def global_rank(
    df: DataFrame,
    order: Sequence[Column | str],
    id_col: str,
    stage: Staging,
    *,
    may_repeat: bool = False,
    start: int = 0,
) -> DataFrame:
    """Dense 1-based rank of every row under a total order, without a one-task window.

    The rows are range-partitioned and sorted once, staged with their position, and
    each partition is shifted by the number of rows before it. Only one count per
    partition reaches the driver.

    `may_repeat` adds the input position as last sort key, so that a large group of
    identical rows spreads over many ranges. The input must then be a stored table:
    reading it again yields the same positions, so a lost task repeats exactly.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    columns = df.columns
    if may_repeat:
        df = df.withColumn("_copy", F.monotonically_increasing_id())
        keys.append(F.col("_copy"))
    placed = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*columns, F.monotonically_increasing_id().alias("_place")),
        f"ranked-{id_col}",
    )
    part = F.shiftrightunsigned("_place", _POSITION_BITS).cast("int")
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    sizes = {r["_part"]: r["count"] for r in placed.groupBy(part.alias("_part")).count().collect()}
    counts = [sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)]
    before = itertools.accumulate(counts[:-1], initial=start)
    # One number per partition of the sort, as a constant of the plan.
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    return placed.select((F.element_at(offsets, part + 1) + position + 1).alias(id_col), *columns)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank_col: str
) -> DataFrame:
    """First k rows of each group. Spark cuts each map task to k rows before the shuffle,
    so a group holding most of the table costs its tasks a sort but no large exchange."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(window)).filter(F.col(rank_col) <= k)


def dominant_value(df: DataFrame, key: str, value: str, weight: Column | None = None) -> DataFrame:
    """Most frequent value per key; the smallest value wins a tie."""
    counts = df.groupBy(key, value).agg(F.sum(weight if weight is not None else F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), value)).alias(value))
