"""How many two-hop paths run through each account, without forming one of them.

A path is a transfer into an account followed by one out of it, in the same currency, no earlier and
within the time span of a ring. Their number is a question of order alone: every departure counts the
arrivals up to its time less those before its span. Arrivals and departures are merged by time and a
running sum answers; it is taken in two steps, inside stretches of time and over the totals of the
stretches, so that the busiest account spreads over as many tasks as it has stretches.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.config import Assessment
from ringtrail.staging import Staging

# Seconds of a stretch: what one task orders is what one account does in it, rows of one time counted.
STRETCH = 3600


def _arrivals_before(events: DataFrame, key: Sequence[str], span: timedelta, stage: Staging, name: str) -> DataFrame:
    """(key, arrivals, departures, paths) from `events` (key, ts, arrives, departs), each flag 0 or 1."""
    counted = events.na.drop(subset=list(key)).groupBy(*key, "ts").agg(F.sum("arrives").alias("in"), F.sum("departs").alias("out"))
    counted = stage(counted, f"{name}-events")
    zero = F.lit(0).cast("long")
    # At one time the lower end of a span comes first, then arrivals, then departures.
    points = counted.select(
        *key,
        F.inline(
            F.array(
                F.struct((F.col("ts") - F.lit(span)).alias("ts"), F.lit(0).alias("turn"), zero.alias("adds"), (-F.col("out")).alias("asks")),
                F.struct("ts", F.lit(1).alias("turn"), F.col("in").alias("adds"), zero.alias("asks")),
                F.struct("ts", F.lit(2).alias("turn"), zero.alias("adds"), F.col("out").alias("asks")),
            )
        ),
    ).where("adds <> 0 OR asks <> 0")
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    points = points.withColumn("stretch", F.floor(F.timestamp_diff("SECOND", start, F.col("ts")) / F.lit(STRETCH)))
    # A stretch answers for what lies inside it, and says how often it asks for what came before.
    inside = Window.partitionBy(*key, "stretch").orderBy("ts", "turn").rowsBetween(Window.unboundedPreceding, 0)
    asked = F.when(F.col("ts").isNotNull(), F.col("asks")).otherwise(zero)

    def product(one: Column, other: Column) -> Column:
        return one.cast("decimal(19,0)") * other.cast("decimal(19,0)")

    stretches = points.withColumn("seen", F.sum("adds").over(inside)).groupBy(*key, "stretch").agg(
        F.sum("adds").alias("adds"),
        F.sum(asked).alias("asks"),
        F.sum(F.when(F.col("turn") == 2, F.col("asks"))).alias("departs"),
        F.sum(product(asked, F.col("seen"))).alias("paths"),
    )
    earlier = Window.partitionBy(*key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.withColumn("before", F.coalesce(F.sum("adds").over(earlier), zero))
    return stretches.groupBy(*key).agg(
        F.sum("adds").alias("arrivals"),
        F.coalesce(F.sum("departs"), zero).alias("departures"),
        F.sum((F.col("paths") + product(F.col("asks"), F.col("before"))).cast("decimal(38,0)")).alias("paths"),
    ).where("arrivals > 0 AND paths > 0")


def two_hop_path_counts(hops: DataFrame, cfg: Assessment, stage: Staging) -> DataFrame:
    """(account_key, currency, arrivals, departures, paths, returning_paths, open_paths) of every account
    that some two-hop path runs through.

    `hops` are the transfers of `circular_flow.ring_transfers`: no dust, no self-transfers. A path returns
    if it ends where it began; open paths lead to a third account and are the ones a ring could close.
    """
    span = timedelta(days=int(cfg.params["max_time_span_days"]))
    ends = [
        F.struct(F.col("dst").alias("account_key"), F.col("src").alias("other"), F.lit(1).alias("arrives"), F.lit(0).alias("departs")),
        F.struct(F.col("src").alias("account_key"), F.col("dst").alias("other"), F.lit(0).alias("arrives"), F.lit(1).alias("departs")),
    ]
    all_paths = _arrivals_before(
        hops.select("currency", "ts", F.inline(F.array(*ends))), ["account_key", "currency"], span, stage, "paths"
    )
    # Only two accounts that pay each other have a path that returns.
    first, second = F.least("src", "dst"), F.greatest("src", "dst")
    mutual = hops.groupBy("currency", first.alias("one"), second.alias("two")).agg(
        F.max(F.col("src") < F.col("dst")).alias("forth"), F.max(F.col("src") > F.col("dst")).alias("back")
    )
    mutual = stage(mutual.where("forth AND back").drop("forth", "back"), "mutual-pairs")
    turning = hops.withColumns({"one": first, "two": second}).join(mutual, ["currency", "one", "two"], "left_semi")
    returning = _arrivals_before(
        turning.select("currency", "ts", F.inline(F.array(*ends))), ["account_key", "other", "currency"], span, stage, "returning"
    )
    returning = returning.groupBy("account_key", "currency").agg(F.sum("paths").alias("returning_paths"))
    none = F.lit(0).cast("decimal(38,0)")
    back = F.coalesce(F.col("returning_paths").cast("decimal(38,0)"), none)
    return all_paths.join(returning, ["account_key", "currency"], "left").select(
        "account_key", "currency", "arrivals", "departures", "paths", back.alias("returning_paths"), (F.col("paths") - back).alias("open_paths")
    )
