"""The part of a graph that can lie on cycles of a given length.

Two ways to rule links out, both of which never remove a link of such a cycle. First every node sends a
few marks along the links for as many steps as the cycle has, the marks of all senders of a step united in
one number of fixed size; a node that does not get its own marks back is on no closed walk of that
length. Its cost does not depend on how long the chains of the graph are. Then links are trimmed whose
payer is paid by nobody or whose payee pays nobody, as long as a round removes enough to pay for itself:
what a later round would still remove does no harm.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.staging import Staging

GRAPH = ("currency", "w")
# Numbers of 64 marks per node.
WORDS = 4
# Trimming goes on while a round removes more than this part of the links.
LEAST_GAIN = 0.1


def _own(node: str, word: int) -> Column:
    """The mark of a node in a word."""
    return F.expr(f"shiftleft(1L, cast(pmod(xxhash64({word}, {node}), 64) as int))")


def _marks(word: int) -> str:
    return f"m{word}"


def returning_nodes(links: DataFrame, hops: int, stage: Staging, graph: Sequence[str] = GRAPH) -> DataFrame:
    """(graph, node) of the nodes that may lie on a closed walk of `hops` links."""
    sent = links.select(*graph, "dst", *[_own("src", k).alias(_marks(k)) for k in range(WORDS)])
    united = [F.bit_or(_marks(k)).alias(_marks(k)) for k in range(WORDS)]
    reached = sent.groupBy(*graph, "dst").agg(*united)
    for step in range(1, hops):
        reached = stage(reached.withColumnRenamed("dst", "src"), f"marks-{step}")
        reached = links.join(reached, [*graph, "src"]).groupBy(*graph, "dst").agg(*united)
    back = [F.col(_marks(k)).bitwiseAND(_own("dst", k)) != 0 for k in range(WORDS)]
    return reached.where(functools.reduce(operator.and_, back)).select(*graph, F.col("dst").alias("node"))


def _between(links: DataFrame, payers: DataFrame, payees: DataFrame, graph: Sequence[str]) -> DataFrame:
    """Links from one of `payers` to one of `payees`, both (graph, node)."""
    return links.join(payers.withColumnRenamed("node", "src"), [*graph, "src"], "left_semi").join(
        payees.withColumnRenamed("node", "dst"), [*graph, "dst"], "left_semi"
    )


def cyclic_core(links: DataFrame, hops: int, stage: Staging, graph: Sequence[str] = GRAPH) -> DataFrame:
    """The rows of `links` (graph, src, dst, ...) without most of those that no cycle of `hops` links can use.

    `links` must be a stored table with one row per link.
    """
    narrow = links.select(*graph, "src", "dst")
    nodes = stage(returning_nodes(narrow, hops, stage, graph), "returning")
    left = stage(_between(narrow, nodes, nodes, graph), "core")
    n, before = left.count(), narrow.count()
    while n < (1 - LEAST_GAIN) * before:
        paid = left.select(*graph, F.col("dst").alias("node")).distinct()
        pays = left.select(*graph, F.col("src").alias("node")).distinct()
        left, before = stage(_between(left, paid, pays, graph), "core"), n
        n = left.count()
    return links.join(left, [*graph, "src", "dst"], "left_semi")
