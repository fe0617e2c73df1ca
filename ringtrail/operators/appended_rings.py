"""Rings that an appended load closes, without looking for the others again.

A ring is new if one of its transfers is. What earlier loads hold is known by their link summaries, which
are stored; only windows with a new transfer are opened, only links that can share a cycle with a new one
take part, and transfers are read for the cycles alone that a new link is on. Each such ring is found once,
whichever of its hops are new, and none of those found before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.config import Assessment
from ringtrail.functions.ranking import global_rank
from ringtrail.operators import circular_flow as flow
from ringtrail.staging import Staging

AT = ["currency", "w"]


def links_around(hung: DataFrame, steps: int, stage: Staging) -> DataFrame:
    """The links (with `r.fresh`) that a fresh link can reach, and be reached from, in so many steps."""
    narrow = hung.select(*AT, "src", "dst", F.col("r.fresh").alias("fresh"))
    new = narrow.filter("fresh")

    def reached(near: str, far: str) -> DataFrame:
        """Nodes up to `steps` links on from the far ends of fresh links, going from near to far ends."""
        nodes = last = stage(new.select(*AT, F.col(far).alias("node")).distinct(), "reached")
        for _ in range(steps):
            step = narrow.join(last.withColumnRenamed("node", near), [*AT, near], "left_semi")
            step = step.select(*AT, F.col(far).alias("node")).distinct()
            last = stage(step.join(nodes, [*AT, "node"], "left_anti"), "reached")
            nodes = nodes.unionByName(last)
        return nodes

    ahead, behind = reached("src", "dst"), reached("dst", "src")
    kept = narrow.join(ahead.withColumnRenamed("node", "src"), [*AT, "src"], "left_semi").join(
        behind.withColumnRenamed("node", "dst"), [*AT, "dst"], "left_semi"
    )
    kept = stage(kept.unionByName(new).select(*AT, "src", "dst").distinct(), "around")
    return hung.join(kept, [*AT, "src", "dst"], "left_semi")


def cycles_of_append(
    stored: DataFrame, old: DataFrame, new: DataFrame, after_id: int, cfg: Assessment, stage: Staging
) -> DataFrame:
    """The rings with a hop in `new`, numbered from 1 by time and ids as `circular_flow.cycles` does.

    `stored` are the link summaries of the transfers `old`; the ids of `new` are above `after_id`, those of
    `old` are not. New transfers may be earlier than old ones.
    """
    n = flow._hops(cfg)
    new_hops = flow.ring_transfers(new, cfg)
    # Each new transfer as a link of its own: pairs of accounts seldom repeat within a bucket.
    added = flow.as_links(new_hops)
    # Windows that hold a new transfer, and the buckets they are made of.
    starts = F.explode(F.array(F.col("bucket") - 1, F.col("bucket")))
    windows = stage(added.select("currency", starts.alias("w")).distinct(), "touched-windows")
    buckets = windows.select("currency", F.explode(F.array("w", F.col("w") + 1)).alias("bucket")).distinct()
    near = stage(stored.join(stage(buckets, "touched-buckets"), ["currency", "bucket"], "left_semi"), "links")
    links = near.withColumn("fresh", F.lit(False)).unionByName(added.withColumn("fresh", F.lit(True)))
    active = stage(flow.activity(links), "activity")
    hung = flow.hung_links(flow.links_of_active(links, active, stage), active, keep_busy=True).join(windows, AT, "left_semi")
    hung = stage(hung, "hung-links")
    # Links away from every new one are only worth ruling out where there are many.
    links, new_links = hung.agg(F.count(F.lit(1)), F.count_if("r.fresh")).first()
    around = hung if 2 * new_links > links else stage(links_around(hung, n - 2, stage), "links-around")
    found = flow.possible_cycles(around, cfg, stage)
    fresh = F.greatest(*[F.col(f"r{k}.fresh") for k in range(1, n + 1)])
    searches = stage(flow.hop_searches(found.filter(fresh), cfg), "hop-searches")
    span = searches.agg(F.min("t_lo").alias("lo"), F.max("t_hi").alias("hi")).first()
    # Two times, as constants that reach the scan.
    lo, hi = (F.lit(str(t) if t else None).cast("timestamp_ntz") for t in span)
    old = old.filter(F.col("event_timestamp").between(lo, hi))
    hops = flow.ring_transfers(old, cfg).unionByName(new_hops)
    candidates = stage(flow.candidate_hops(hops, searches, cfg, stage), "candidate-hops")
    ids = [f"hop{k}_id" for k in range(1, n + 1)]
    rings = flow.assemble(candidates, cfg, stage).filter(F.greatest(*ids) > after_id)
    return global_rank(rings, ["ts_hop1", *ids], "finding_id", stage)
