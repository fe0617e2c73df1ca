"""Exact duplicates by two-pass Bloom filtering, in DataFrame operations only.

Pass 1 counts filter cells: each text sets two cells of a bit field, and cells that were
set more than once go into a bitmap. Pass 2 probes it: a text whose two cells are not both
in the bitmap has no copy and passes straight through. Only the rest is shuffled by digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.common import SPACE
from ringtrail.staging import Staging

BITMAP_BITS = 32768  # of one bitmap of Spark's bitmap functions, 4 KB
CELLS_PER_ROW = 16
# Proven bound of what is broadcast: 2^28 cells are 32 MB. Beyond 2^24 rows the filter
# lets more unique rows through to the shuffle; the result stays exact.
MAX_CELLS = 1 << 28


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _cell(n: int, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(n), "_sha"), F.lit(cells))


def _filter(digests: DataFrame, cells: int, stage: Staging) -> DataFrame:
    """(bucket, bits): bitmaps of the cells that were set more than once."""
    hit = (
        digests.select(F.explode(F.array(_cell(1, cells), _cell(2, cells))).alias("cell"))
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    bits = F.bitmap_construct_agg(F.col("cell") % BITMAP_BITS)
    bucket = F.expr(f"cell div {BITMAP_BITS}").alias("bucket")
    return stage(hit.groupBy(bucket).agg(bits.alias("bits")), "repeat-filter")


def _set_in(bits: str, cell: Column) -> Column:
    """Whether a cell is in the bitmap of its bucket."""
    at = (cell % BITMAP_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("getbit", byte, at.bitwiseAND(F.lit(7))) == 1, F.lit(False))


def flagged(rows: DataFrame, cells: int, bitmaps: DataFrame) -> DataFrame:
    """`rows` (with `_sha`) and the flag `_again`: both cells may have been set before."""
    out, tests = rows, []
    for n in (1, 2):
        cell = _cell(n, cells)
        side = bitmaps.select(F.col("bucket").alias(f"_b{n}"), F.col("bits").alias(f"_bits{n}"))
        # At most MAX_CELLS bits in all.
        out = out.withColumn(f"_c{n}", cell).join(
            F.broadcast(side), F.expr(f"_c{n} div {BITMAP_BITS}") == F.col(f"_b{n}"), "left"
        )
        tests.append(_set_in(f"_bits{n}", F.col(f"_c{n}")))
    return out.withColumn("_again", tests[0] & tests[1]).select(*rows.columns, "_again")


def repeat_filter(digests: DataFrame, stage: Staging) -> tuple[int, DataFrame]:
    """Cells and bitmaps for the stored digests."""
    cells = BITMAP_BITS
    while cells < min(CELLS_PER_ROW * digests.count(), MAX_CELLS):
        cells *= 2
    return cells, _filter(digests, cells, stage)


def exact_dedup(docs: DataFrame, stage: Staging, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when their digests are, after each run of ASCII white space became one
    space; null counts as empty. The row with the smallest id stays, a null id counts as the
    largest, and of rows that repeat id and text one stays. An empty table gives no rows.
    """
    rows = stage(
        docs.select(
            F.col(id_col).alias("_id"),
            digest(F.col(text_col)).alias("_sha"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "digests",
    )
    cells, bitmaps = repeat_filter(rows, stage)
    probed = stage(flagged(rows, cells, bitmaps), "probed")
    again = probed.where("_again").drop("_again")
    first = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    groups = stage(
        again.groupBy("_sha").agg(F.min(first).alias("_first"), F.count(F.lit(1)).alias("_size")), "groups"
    ).withColumnRenamed("_sha", "_group")
    grouped = again.join(groups, again._sha == groups._group).select(
        F.col("_id").alias(id_col),
        F.col("_first.id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_first.row")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    alone = probed.where("not _again").select(
        F.col("_id").alias(id_col),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, stage: Staging, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all columns of `docs`: of rows with equal texts the one with the
    smallest id, and one of rows that repeat id and text. `docs` should be a stored table, as it
    is read three times; texts without a copy are not shuffled.
    """
    packed = docs.select(F.struct("*").alias("_doc"))
    doc = packed["_doc"]
    keyed = packed.select("_doc", doc[id_col].alias("_id"), digest(doc[text_col]).alias("_sha"))
    cells, bitmaps = repeat_filter(stage(keyed.select("_sha"), "digests"), stage)
    probed = flagged(keyed, cells, bitmaps)
    again = stage(probed.where("_again").drop("_again"), "suspects")
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"))
    groups = stage(again.groupBy("_sha").agg(F.min(order)["id"].alias("_keep")), "keepers")
    groups = groups.withColumnRenamed("_sha", "_group")
    stay = again.join(groups, (again._sha == groups._group) & again._id.eqNullSafe(groups._keep))
    stay = stay.dropDuplicates(["_sha", "_id"]).select("_doc")
    return probed.where("not _again").select("_doc").unionByName(stay).select("_doc.*")
