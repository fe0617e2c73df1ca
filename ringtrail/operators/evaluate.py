"""How well findings agree with the label, measured after detection.

Flagged transfers are few; they are joined to the label table by transfer id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail import constants as K

DETECTORS = ("circular_flow", "mule_hub", "laundering_exposure")
GRAPH_NATIVE = "graph_native"


def _detector() -> Column:
    """Detector name of an assessment id, whatever its version."""
    name = F.col("assessment_id")
    return (
        F.when(name.startswith("circular_flow"), "circular_flow")
        .when(name.startswith("mule_hub"), "mule_hub")
        .otherwise("laundering_exposure")
    )


def _is_labelled():
    return F.col("is_laundering") == 1


def base_rate(labels: DataFrame) -> DataFrame:
    return labels.agg(
        F.count(F.lit(1)).alias("transactions"), F.count_if(_is_labelled()).alias("labeled")
    ).withColumn("base_rate", F.try_divide("labeled", "transactions"))


def flagged(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Each transfer once per detector that flagged it, with its label."""
    once = edges.select("fin_txn_id", _detector().alias("detector")).distinct()
    return once.join(labels, "fin_txn_id")


def precision(edges: DataFrame, labels: DataFrame) -> DataFrame:
    return (
        flagged(edges, labels)
        .groupBy("detector")
        .agg(F.count(F.lit(1)).alias("flagged_txns"), F.count_if(_is_labelled()).alias("labeled_txns"))
        .withColumn("precision_pct", F.round(100.0 * F.col("labeled_txns") / F.col("flagged_txns"), 1))
    )


def recall(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Share of labelled transfers each detector captured, and both graph detectors together.

    Every detector has a row, at zero too; the share is NULL where nothing is labelled.
    """
    hits = flagged(edges, labels).filter(_is_labelled()).select("fin_txn_id", "detector")
    native = (
        hits.filter(F.col("detector").isin("circular_flow", "mule_hub"))
        .select("fin_txn_id", F.lit(GRAPH_NATIVE).alias("detector"))
        .distinct()
    )
    captured = hits.unionByName(native).groupBy("detector").agg(F.count(F.lit(1)).alias("labeled_captured"))
    # One row per detector from the totals' one row.
    names = F.explode(F.array(*[F.lit(d) for d in (*DETECTORS, GRAPH_NATIVE)]))
    total = labels.agg(F.count_if(_is_labelled()).alias("labeled_total")).select(names.alias("detector"), "labeled_total")
    return total.join(captured, "detector", "left").select(
        "detector",
        F.coalesce("labeled_captured", F.lit(0)).alias("labeled_captured"),
        "labeled_total",
        F.round(
            F.try_divide(100.0 * F.coalesce("labeled_captured", F.lit(0)), F.col("labeled_total")), 2
        ).alias("recall_pct"),
    )


def lift(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Precision relative to drawing transfers blindly; NULL where nothing is labelled."""
    names = F.explode(F.array(*[F.lit(d) for d in DETECTORS]))
    base = base_rate(labels).select(names.alias("detector"), "transactions", "labeled")
    share = F.col("labeled_txns") / F.col("flagged_txns")
    return precision(edges, labels).join(base, "detector").select(
        "detector", F.round(F.try_divide(share * F.col("transactions"), F.col("labeled")), 2).alias("lift")
    )


def ring_overlap(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Rings with all hops labelled, with any, and labelled hops over all rings."""
    rings = edges.filter(F.col("assessment_id") == K.CIRCULAR_FLOW)
    per_ring = (
        rings.select("finding_id", "fin_txn_id")
        .join(labels, "fin_txn_id")
        .groupBy("finding_id")
        .agg(F.count(F.lit(1)).alias("hops"), F.count_if(_is_labelled()).alias("labeled"))
    )
    return per_ring.agg(
        F.count(F.lit(1)).alias("rings"),
        F.count_if(F.col("labeled") == F.col("hops")).alias("strict_all_labeled"),
        F.count_if(F.col("labeled") >= 1).alias("loose_any_labeled"),
        F.coalesce(F.sum("hops"), F.lit(0)).alias("ring_hops"),
        F.coalesce(F.sum("labeled"), F.lit(0)).alias("labeled_hops"),
    )


def account_signal(entities: DataFrame, transfers: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled share of the transfers that touch an account named in a mule-hub finding.

    A transfer of an account to itself touches it once. Touches are counted from the transfers
    alone; only labelled ones are looked up.
    """
    accounts = (
        entities.filter((F.col("assessment_id") == K.MULE_HUB) & (F.col("entity_type") == K.ACCOUNT))
        .select(F.col("entity_id").alias("account_key"))
        .distinct()
    )
    ends = F.array_distinct(F.array("from_account_key", "to_account_key"))
    touches = transfers.select("fin_txn_id", F.explode(ends).alias("account_key")).join(accounts, "account_key")
    per_account = (
        touches.join(labels.filter(_is_labelled()).select("fin_txn_id", F.lit(1).alias("hit")), "fin_txn_id", "left")
        .groupBy("account_key")
        .agg(F.count(F.lit(1)).alias("touched"), F.count("hit").alias("labeled"))
    )
    return per_account.agg(
        F.count(F.lit(1)).alias("accounts"),
        F.count_if(F.col("labeled") >= 1).alias("touching_1"),
        F.count_if(F.col("labeled") >= 5).alias("touching_5"),
        F.round(F.avg(F.col("labeled") / F.col("touched")), 6).alias("mean_labeled_ratio"),
    )
