"""Connected components of a graph given as an edge table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.staging import Staging


def _order(node: str, turn: int):
    """A fresh random order of the nodes in each turn, so that long chains fold up quickly."""
    return F.struct(F.xxhash64(F.lit(turn), node).alias("h"), F.col(node).alias("n"))


def components(edges: DataFrame, stage: Staging) -> DataFrame:
    """(node, root) for every node of `edges` (a, b; each link once, either way round).

    Randomised contraction: every node merges into the first of itself and its neighbours in a
    random order; links between merged nodes drop out. An expected fixed share of the nodes goes
    in each turn, so there are O(log n) turns. Partial aggregation before each shuffle and tables
    as cut points keep nodes with very many links from landing in one task. Roots are arbitrary
    nodes of their component.
    """
    edges = stage(edges.where("a <> b").distinct(), "edges")
    labels = None
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        # The first neighbour; the node itself stands in the order too.
        near = both.groupBy("node").agg(F.min(_order("near", turn)).alias("near"))
        step = stage(near.select("node", F.least(F.col("near"), _order("node", turn))["n"].alias("to")), "step")
        if labels is None:
            labels = step.select("node", F.col("to").alias("root"))
        else:
            moved = step.withColumnRenamed("node", "root")
            labels = stage(
                labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels"
            )
        to_a = step.select(F.col("node").alias("a"), F.col("to").alias("na"))
        to_b = step.select(F.col("node").alias("b"), F.col("to").alias("nb"))
        edges = stage(
            edges.join(to_a, "a").join(to_b, "b").where("na <> nb")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(),
            "edges",
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if labels is None else labels
