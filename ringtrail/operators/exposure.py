"""Accounts touching many labelled transfers. The only detector that reads the label."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail import constants as K
from ringtrail import schemas
from ringtrail.config import Assessment
from ringtrail.functions.columns import account_key, whole_hours
from ringtrail.functions.membership import may_occur
from ringtrail.functions.ranking import global_rank
from ringtrail.operators.findings import (
    account_entities,
    both_sides,
    counterparty_roles,
    edge_rows,
    entity_rows,
    finding_rows,
    first_role,
    owners_and_banks,
    stats,
    top_counterparties,
    top_transfers,
)
from ringtrail.staging import Staging

ROLES = [K.EXPOSED_ROLE, K.ACCOUNT_OWNER, K.CUSTODIAN_BANK, K.INBOUND_COUNTERPARTY, K.OUTBOUND_COUNTERPARTY]


def labeled_edges(transfers: DataFrame, txns: DataFrame, stage: Staging) -> DataFrame:
    """Transfers matching a labelled raw row on time, both accounts and amount.

    Raw rows have no id, so copies of a labelled row match every copy of the transfer.
    Instead of emitting that product, the labelled rows are counted first and each
    transfer carries `copies`, the number of labelled rows it matches.
    """
    key = ["event_timestamp", "from_account_key", "to_account_key", "amount"]
    labelled = (
        txns.filter(F.col("is_laundering") == 1)
        .groupBy(
            "event_timestamp",
            account_key("from_bank", "from_account").alias("from_account_key"),
            account_key("to_bank", "to_account").alias("to_account_key"),
            F.col("amount_paid").alias("amount"),
        )
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # Labelled rows are rare. Staging them shows their size before the join is planned; where they are too
    # many to broadcast, transfers that match none stay out of the shuffle.
    labelled = stage(labelled, "labelled-keys")
    near = may_occur(transfers, [F.struct(*key)], labelled, F.struct(*key), stage)
    return stage(near.join(labelled, key).select(*schemas.TRANSFERS_TO.names, "copies"), "labelled-edges")


def candidates(labeled: DataFrame, cfg: Assessment, stage: Staging) -> DataFrame:
    """Accounts over the threshold, ranked; a self-transfer counts on both sides."""
    touches = both_sides(labeled, "amount", "currency", "event_timestamp", "copies")
    # A transfer is one row, so that only one to the account itself is met twice; what is summed
    # needs no distinct. Per currency first, so that the dominant one comes out of the same sums.
    again = (F.col("account_key") == F.col("counterparty")) & (F.col("side") == "outbound")
    per_currency = touches.groupBy("account_key", "currency").agg(
        F.sum("copies").alias("edges"),
        F.count_if(~again).alias("txns"),
        F.sum(F.col("amount") * F.col("copies")).alias("total"),
        F.min("amount").alias("amt_min"),
        F.max("amount").alias("amt_max"),
        F.min("event_timestamp").alias("ts_first"),
        F.max("event_timestamp").alias("ts_last"),
    )
    per_account = (
        per_currency.groupBy("account_key")
        .agg(
            F.sum("edges").alias("labeled_edges"),
            F.sum("txns").alias("distinct_labeled_txns"),
            F.sum("total").cast(schemas.MONEY_TOTAL).alias("labeled_amount_total"),
            F.min("amt_min").alias("amt_min"),
            F.max("amt_max").alias("amt_max"),
            F.min("ts_first").alias("ts_first"),
            F.max("ts_last").alias("ts_last"),
            F.min_by("currency", F.struct(-F.col("edges"), "currency")).alias("currency"),
        )
        .filter(F.col("labeled_edges") >= cfg.params["min_labeled_edges"])
    )
    # Ranked and stored in one.
    return global_rank(per_account, [F.col("labeled_edges").desc(), F.col("account_key")], "finding_id", stage)


def findings(cands: DataFrame, cfg: Assessment, run_ts: datetime) -> DataFrame:
    # Fixed texts: title and description as they appear in a finding.
    title = F.format_string("Labeled exposure: %s (%d labeled transfers)", "account_key", "labeled_edges")
    description = F.format_string(
        "Account %s participates in %d transactions flagged IsLaundering=1 by the AMLSim ground-truth "
        "label. Label-driven, supervised — contrast with graph-native assessments.",
        "account_key", "labeled_edges",
    )
    return finding_rows(
        cands,
        cfg,
        run_ts,
        severity=F.when(F.col("labeled_edges") >= K.EXPOSURE_CRITICAL_EDGES, "CRITICAL")
        .when(F.col("labeled_edges") >= K.EXPOSURE_HIGH_EDGES, "HIGH")
        .otherwise("MEDIUM"),
        title=title,
        description=description,
        summary=stats(
            currency=F.col("currency"),
            labeled_edges=F.col("labeled_edges"),
            distinct_labeled_txns=F.col("distinct_labeled_txns"),
            labeled_amount_total=F.col("labeled_amount_total"),
            amount_min=F.col("amt_min"),
            amount_max=F.col("amt_max"),
            time_span_hours=whole_hours("ts_first", "ts_last"),
        ),
        trigger="ts_first",
    )


def exposed_counterparties(cands: DataFrame, labeled: DataFrame, cfg: Assessment) -> DataFrame:
    totals = labeled.groupBy("from_account_key", "to_account_key").agg(
        F.sum(F.col("amount") * F.col("copies")).alias("total")
    )
    anchors = cands.select("finding_id", "account_key")
    return top_counterparties(anchors, totals, cfg.params["top_counterparties_per_side"])


def entities(
    cands: DataFrame, labeled: DataFrame, cfg: Assessment, has_account: DataFrame, is_held_at: DataFrame
) -> DataFrame:
    anchors = cands.select("finding_id", "account_key")
    every = (
        account_entities(anchors, "account_key", F.lit(K.EXPOSED_ROLE))
        .unionByName(owners_and_banks(anchors, has_account, is_held_at))
        .unionByName(counterparty_roles(exposed_counterparties(cands, labeled, cfg)))
    )
    return entity_rows(first_role(every, ROLES), cfg)


def edges(cands: DataFrame, labeled: DataFrame, cfg: Assessment) -> DataFrame:
    """The largest labelled transfers into and out of each account."""
    anchors = cands.select("finding_id", "account_key")
    per_side = cfg.params["top_transfers"] // 2
    top = top_transfers(anchors, labeled, per_side, copies="copies")
    return edge_rows(top, cfg, direction=True, labelled=True)
