"""Rows that may have a partner, told apart before they are shuffled. All built-in, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.staging import Staging

BITMAP_BITS = 32768  # of one bitmap of Spark's bitmap functions, 4 KB
CELLS_PER_KEY = 16
# Proven bound of what is broadcast: 2^28 cells are 32 MB. Beyond 2^24 keys more rows pass in vain.
MAX_CELLS = 1 << 28


def _cell(key: Column, cells: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(cells))


def _is_set(bits: Column, cell: Column) -> Column:
    at = (cell % BITMAP_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, at.bitwiseAND(F.lit(7))) == 1


def may_occur(rows: DataFrame, keys: list[Column], known: DataFrame, key: Column, stage: Staging) -> DataFrame:
    """`rows` without most of those of which one of `keys` is no value of `key` in the stored table `known`.

    Every row that has its values there is kept, and some others: a bit field of the hashed values, of bounded
    size, answers. So a join with `known` afterwards gives the same rows, but shuffles few that it then drops.
    All rows are kept where the field would be so full that it says nothing.
    """
    values, cells = known.count(), BITMAP_BITS
    if values > MAX_CELLS:
        return rows
    while cells < min(CELLS_PER_KEY * values, MAX_CELLS):
        cells *= 2
    hit = known.select(_cell(key, cells).alias("cell"))
    bits = F.bitmap_construct_agg(F.col("cell") % BITMAP_BITS).alias("bits")
    field = stage(hit.groupBy(F.expr(f"cell div {BITMAP_BITS}").alias("block")).agg(bits), "key-cells")
    kept = rows
    for n, value in enumerate(keys):
        cell, block, found = f"_cell{n}", f"_block{n}", f"_bits{n}"
        kept = kept.withColumn(cell, _cell(value, cells))
        side = field.withColumnsRenamed({"block": block, "bits": found})
        # At most MAX_CELLS bits in all.
        kept = kept.join(F.broadcast(side), F.expr(f"{cell} div {BITMAP_BITS}") == F.col(block))
        kept = kept.filter(_is_set(F.col(found), F.col(cell))).drop(cell, block, found)
    return kept.select(*rows.columns)
