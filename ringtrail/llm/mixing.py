"""Mixing sources to target weights by entropy balancing.

Document rates r are the exponential tilt closest to "every document once" (smallest relative
entropy) whose words meet each source's target, with 0 <= r <= 2: r = min(2, exp(lambda * z)),
z the document's size over the mean of its source. The dual is convex with one variable per
source; Newton steps on sums over the data solve it. Rates are then rounded into copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.functions.ranking import global_rank
from ringtrail.llm.common import WORD
from ringtrail.staging import Staging

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2.0
TOLERANCE = 1e-6
# Sources still open after so many safeguarded steps are as near as doubles bring them.
MAX_STEPS = 60
# Documents per source, size class and direction that the last correction may change.
SPARES = 32
SALT = 9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, stage: Staging, weights=WEIGHTS, share=SHARE, limit=LIMIT) -> DataFrame:
    """(_source, source_size, target) from (_source, size, n): weighted shares, held at `limit` times the source.

    The level mu with sum(min(limit * size, weight * mu)) = share * all words; sources that stop at
    their limit leave their excess to the others, until none is above.
    """
    totals = stage(sizes.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "sources")
    order = [F.col("_source").isNull(), F.col("_source")]
    ranked = global_rank(totals, order, "place", stage)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumn("weight", weight), "weights")
    cap = F.col("source_size") * limit
    whole = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        held = F.col("weight") * level > cap
        row = ranked.agg(
            F.sum(F.when(held, cap).otherwise(0.0)).alias("held"), F.sum(F.when(~held, F.col("weight"))).alias("open")
        ).first()
        if not row["open"]:
            break
        higher = (whole - row["held"]) / row["open"]
        if higher <= level:
            break
        level = higher
    return ranked.select("_source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


def _rate(lam: Column, size: Column, mean: Column, limit: float) -> Column:
    return F.least(F.lit(limit), F.exp(F.least(lam * size / mean, F.lit(50.0))))


def tilt(sizes: DataFrame, targets: DataFrame, stage: Staging, limit=LIMIT, tolerance=TOLERANCE) -> DataFrame:
    """(_source, lam, mean, source_size, target): the solution of the dual. At the limit lam is null: all rates are."""
    counted = sizes.groupBy("_source").agg(F.sum("n").alias("docs"))
    state = stage(
        targets.join(counted.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")))
        .select(
            "_source", "source_size", "target",
            F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9)).alias("mean"),
            F.lit(0.0).alias("lam"), F.lit(-60.0).alias("low"), F.lit(60.0).alias("high"),
            (F.col("target") >= limit * F.col("source_size") * (1 - 1e-12)).alias("full"),
            F.lit(False).alias("met"),
        ),
        "dual",
    )
    for _ in range(MAX_STEPS):
        active = state.where("not full and not met")
        if active.isEmpty():
            break
        size, rate = F.col("size"), _rate(F.col("lam"), F.col("size"), F.col("mean"), limit)
        words = size * F.col("n") * rate
        curve = F.when(rate < limit, words * size / F.col("mean")).otherwise(0.0)
        joined = sizes.withColumnRenamed("_source", "_s").join(active, F.col("_s").eqNullSafe(F.col("_source")))
        sums = joined.groupBy("_s").agg(F.sum(words).alias("words"), F.sum(curve).alias("curve"))
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - F.try_divide(gap, F.col("curve"))
        middle = (F.col("low") + F.col("high")) / 2
        met = F.coalesce(F.abs(gap) <= tolerance * F.greatest(F.col("target"), F.lit(1.0)), F.lit(False))
        state = stage(
            state.join(sums, F.col("_source").eqNullSafe(F.col("_s")), "left")
            .withColumn("met", F.col("met") | met)
            .withColumn("low", F.when(gap.isNull(), F.col("low")).otherwise(low))
            .withColumn("high", F.when(gap.isNull(), F.col("high")).otherwise(high))
            # A Newton step that leaves the bracket is replaced by halving it.
            .withColumn(
                "lam",
                F.when(F.col("met") | F.col("full") | gap.isNull(), F.col("lam"))
                .when((newton > F.col("low")) & (newton < F.col("high")), newton)
                .otherwise(middle),
            )
            .select("_source", "source_size", "target", "mean", "lam", "low", "high", "full", "met"),
            "dual",
        )
    return state.select(
        "_source", "source_size", "target", "mean", F.when(~F.col("full"), F.col("lam")).alias("lam")
    )


def mix(
    docs: DataFrame,
    stage: Staging,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights=WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
) -> DataFrame:
    """Per row: (id, source, size, source_size, target, rate, copies, taken).

    Null texts have size 0, null sources are a source of their own, after all others. `taken` is
    size times a whole number of copies, 0 to `limit`; which of the two next to the rate is decided
    by a hash of the id, so reruns agree. What rounding leaves open per source is closed by a few
    documents of each size class, changed by one copy. Rows that repeat count each.
    """
    _, rated, changed = _solve(docs, stage, id_col, source_col, text_col, weights, share, limit)
    copies = F.col("copies") + F.coalesce("step", F.lit(0))
    return rated.join(changed, F.col("_row") == F.col("_changed"), "left").select(
        F.col("_id").alias(id_col),
        F.col("_source").alias(source_col),
        "size",
        "source_size",
        "target",
        "rate",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _copies(limit: float) -> tuple[Column, Column]:
    """(rate, copies) from `_id` and `size` of a row and what its source's solution holds."""
    rate = F.coalesce(_rate(F.col("lam"), F.col("size"), F.col("mean"), limit), F.lit(limit))
    chance = F.pmod(F.xxhash64(F.lit(SALT), "_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rate, (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def _solve(docs, stage, id_col, source_col, text_col, weights=WEIGHTS, share=SHARE, limit=LIMIT):
    """(solution per source, rows with rates and copies, the few rows to change by one copy)."""
    rows = stage(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("_source"),
            n_words(F.col(text_col)).alias("size"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "sizes",
    )
    sizes = stage(rows.groupBy("_source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    solved = tilt(sizes, source_targets(sizes, stage, weights, share, limit), stage, limit)
    solved = stage(solved.withColumnRenamed("_source", "_s"), "solution")
    rate, copies = _copies(limit)
    rated = stage(
        rows.join(solved, F.col("_source").eqNullSafe(F.col("_s"))).select(
            "_id", "_row", "_source", "size", "source_size", "target", rate.alias("rate"), copies.alias("copies")
        ),
        "rated",
    )
    return solved, rated, stage(_corrections(rated, limit), "corrections").withColumnRenamed("_row", "_changed")


def repeat_documents(docs: DataFrame, stage: Staging, id_col="doc_id", source_col="source", text_col="text") -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns of `docs`.

    Copies follow from id, size and the source's solution, so no text is shuffled: the solutions, and the
    few documents that close what rounding leaves open, are joined to the documents. Rows that agree in
    id, source and size are taken equally often, as often as the one taken most. Null texts and texts
    without a word have size 0 and stay as often as their rate, that of the smallest documents, says;
    null ids and null sources are values like others.
    """
    solved, rated, changed = _solve(docs, stage, id_col, source_col, text_col)
    key = ["_id", "_source", "size"]
    steps = rated.join(changed, F.col("_row") == F.col("_changed")).groupBy(*key).agg(F.max("step").alias("step"), F.count(F.lit(1)).alias("k"))
    steps = stage(steps.withColumnsRenamed({"_id": "_i", "_source": "_t", "size": "_n"}), "steps")
    same = F.col("_id").eqNullSafe(F.col("_i")) & F.col("_source").eqNullSafe(F.col("_t")) & (F.col("size") == F.col("_n"))
    # A row that only some of its like leave is taken as often as the others.
    met = rated.join(steps, same).groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.first("k").alias("k"), F.first("step").alias("step"))
    step = F.when(F.col("k") < F.col("rows"), F.greatest("step", F.lit(0))).otherwise(F.col("step"))
    steps = stage(met.select(F.col("_id").alias("_i"), F.col("_source").alias("_t"), F.col("size").alias("_n"), step.alias("step")), "steps-of-keys")
    packed = docs.select(F.struct("*").alias("_doc"))
    doc = packed["_doc"]
    packed = packed.select("_doc", doc[id_col].alias("_id"), doc[source_col].alias("_source"), n_words(doc[text_col]).alias("size"))
    taken = packed.join(solved, F.col("_source").eqNullSafe(F.col("_s"))).join(steps, same, "left")
    times = (_copies(LIMIT)[1] + F.coalesce("step", F.lit(0))).cast("int")
    return taken.select("_doc", F.explode(F.array_repeat(F.lit(0), times))).select("_doc.*")


def _corrections(rated: DataFrame, limit: float) -> DataFrame:
    """(_row, step): the documents to take once more or once less, so that each source meets its target.

    The spares, largest first, are changed where that brings the source nearer; only SPARES per
    source, size class and direction are looked at, so a group is small for any input.
    """
    gaps = rated.groupBy("_source").agg((F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("gap"))
    up = rated.where((F.col("copies") < limit) & (F.col("size") > 0)).withColumn("step", F.lit(1))
    down = rated.where((F.col("copies") > 0) & (F.col("size") > 0)).withColumn("step", F.lit(-1))
    spare = up.unionByName(down).withColumn("class", F.floor(F.log2("size")).cast("int"))
    # The rank is cut to SPARES rows per group in each map task before the shuffle.
    # Rows that agree in id and size as well may stand for each other.
    place = Window.partitionBy("_source", "class", "step").orderBy(F.xxhash64(F.lit(SALT), "_id"), "size", "_row")
    few = spare.withColumn("k", F.row_number().over(place)).where(F.col("k") <= SPARES)
    few = few.select(F.col("_source").alias("_s"), "_row", "size", "step", F.xxhash64(F.lit(SALT), "_id").alias("hash"))
    entry = F.struct("size", "hash", F.col("_row").alias("row"), "step")
    lists = few.groupBy("_s").agg(F.sort_array(F.collect_list(entry), asc=False).alias("spares"))
    start = F.struct(F.col("gap").alias("gap"), F.array().cast("array<struct<row:bigint,step:int>>").alias("done"))

    def pick(acc, x):
        signed = x["size"] * x["step"]
        used = F.exists(acc["done"], lambda y: y["row"] == x["row"])
        better = (F.abs(acc["gap"] - signed) < F.abs(acc["gap"])) & ~used
        taken = F.struct(
            (acc["gap"] - signed).alias("gap"),
            F.array_append(acc["done"], F.struct(x["row"].alias("row"), x["step"].alias("step"))).alias("done"),
        )
        return F.when(better, taken).otherwise(acc)

    chosen = lists.join(gaps, F.col("_s").eqNullSafe(F.col("_source"))).select(
        F.explode(F.aggregate("spares", start, pick)["done"]).alias("c")
    )
    return chosen.select(F.col("c.row").alias("_row"), F.col("c.step").alias("step"))
