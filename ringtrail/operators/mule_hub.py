"""Accounts with many distinct senders and many distinct receivers.

Everything starts from one row per (from, to): that single shuffle is keyed on the
pair, so it splits even an account that is part of most transfers, and both degree
profiles and the counterparty ranking come out of it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail import constants as K
from ringtrail import schemas
from ringtrail.config import Assessment
from ringtrail.functions.columns import rounded_ratio, whole_hours
from ringtrail.functions.membership import may_occur
from ringtrail.functions.ranking import dominant_value, global_rank
from ringtrail.operators.findings import (
    account_entities,
    both_sides,
    counterparty_roles,
    edge_rows,
    entity_rows,
    finding_rows,
    first_role,
    looked_up_transfers,
    owners_and_banks,
    stats,
    top_counterparties,
    top_transfers,
)
from ringtrail.staging import Staging

ROLES = [K.HUB_ROLE, K.ACCOUNT_OWNER, K.CUSTODIAN_BANK, K.INBOUND_COUNTERPARTY, K.OUTBOUND_COUNTERPARTY]


def pair_totals(transfers: DataFrame) -> DataFrame:
    """Transfers between two accounts: the one pass over all transfers that the degrees and the top
    counterparties come from."""
    return transfers.groupBy("from_account_key", "to_account_key").agg(
        F.count(F.lit(1)).alias("transfers"),
        F.sum("amount").alias("total"),
        F.min("event_timestamp").alias("first_ts"),
        F.max("event_timestamp").alias("last_ts"),
    )


def degree_profile(pairs: DataFrame, side: str) -> DataFrame:
    """Per account: distinct counterparties, transfers, total, first and last time on one side."""
    key = {"out": "from_account_key", "in": "to_account_key"}[side]
    return pairs.groupBy(F.col(key).alias("account_key")).agg(
        F.count(F.lit(1)).alias(f"{side}_deg"),
        F.sum("transfers").alias(f"{side}_cnt"),
        F.sum("total").cast(schemas.MONEY_TOTAL).alias(f"{side}_total"),
        F.min("first_ts").alias(f"{side}_first"),
        F.max("last_ts").alias(f"{side}_last"),
    )


def hubs(pairs: DataFrame, cfg: Assessment, stage: Staging) -> DataFrame:
    """Accounts over both thresholds, ranked by degree; the rank is the local finding id."""
    payers = degree_profile(pairs, "out").filter(F.col("out_deg") >= cfg.params["min_out_degree"])
    payees = degree_profile(pairs, "in").filter(F.col("in_deg") >= cfg.params["min_in_degree"])
    both = payees.join(payers, "account_key").select(
        "account_key",
        "in_deg",
        "out_deg",
        "in_cnt",
        "out_cnt",
        "in_total",
        "out_total",
        F.least("in_first", "out_first").alias("ts_first"),
        F.greatest("in_last", "out_last").alias("ts_last"),
        F.least("in_total", "out_total").alias("amt_min"),
        F.greatest("in_total", "out_total").alias("amt_max"),
    )
    order = [(F.col("in_deg") + F.col("out_deg")).desc(), F.col("account_key")]
    return global_rank(both, order, "finding_id", stage)


def dominant_currency(hub: DataFrame, transfers: DataFrame, stage: Staging) -> DataFrame:
    """Currency of most transfers touching each hub, by finding_id. Transfers are counted per account and
    currency before they are shuffled, those of most other accounts not at all."""
    anchors = stage(hub.select("finding_id", "account_key"), "anchors")
    touched = may_occur(both_sides(transfers, "currency"), [F.col("account_key")], anchors, F.col("account_key"), stage)
    counted = touched.groupBy("account_key", "currency").agg(F.count(F.lit(1)).alias("n"))
    return dominant_value(counted.join(anchors, "account_key"), "finding_id", "currency", F.col("n"))


def candidates(hub: DataFrame, transfers: DataFrame, stage: Staging) -> DataFrame:
    """The hubs with their currency."""
    return stage(hub.join(dominant_currency(hub, transfers, stage), "finding_id", "left"), "mule-candidates")


def findings(cands: DataFrame, cfg: Assessment, run_ts: datetime) -> DataFrame:
    def over(degree: int):
        return (F.col("in_deg") >= degree) & (F.col("out_deg") >= degree)

    hours = whole_hours("ts_first", "ts_last")
    # Fixed texts: title and description as they appear in a finding.
    title = F.format_string(
        "Mule hub %s (%d in / %d out counterparties)", "account_key", "in_deg", "out_deg"
    )
    description = F.format_string(
        "Account %s received from %d distinct counterparties and dispersed to %d distinct "
        "counterparties over %d hours.",
        "account_key", "in_deg", "out_deg", hours,
    )
    return finding_rows(
        cands,
        cfg,
        run_ts,
        severity=F.when(over(K.HUB_CRITICAL_DEGREE), "CRITICAL")
        .when(over(K.HUB_HIGH_DEGREE), "HIGH")
        .otherwise("MEDIUM"),
        title=title,
        description=description,
        summary=stats(
            currency=F.col("currency"),
            in_degree=F.col("in_deg"),
            out_degree=F.col("out_deg"),
            in_txn_count=F.col("in_cnt"),
            out_txn_count=F.col("out_cnt"),
            in_amount_total=F.col("in_total"),
            out_amount_total=F.col("out_total"),
            balance_ratio=rounded_ratio("out_total", "in_total"),
            amount_min=F.col("amt_min"),
            amount_max=F.col("amt_max"),
            time_span_hours=hours,
        ),
        trigger="ts_first",
    )


def hub_counterparties(cands: DataFrame, pairs: DataFrame, cfg: Assessment) -> DataFrame:
    anchors = cands.select("finding_id", "account_key")
    return top_counterparties(anchors, pairs, cfg.params["top_counterparties_per_side"])


def entities(
    cands: DataFrame, pairs: DataFrame, cfg: Assessment, has_account: DataFrame, is_held_at: DataFrame
) -> DataFrame:
    """Hub, owners, banks and top counterparties; an entity keeps its most telling role."""
    anchors = cands.select("finding_id", "account_key")
    every = (
        account_entities(anchors, "account_key", F.lit(K.HUB_ROLE))
        .unionByName(owners_and_banks(anchors, has_account, is_held_at))
        .unionByName(counterparty_roles(hub_counterparties(cands, pairs, cfg)))
    )
    return entity_rows(first_role(every, ROLES), cfg)


def edges(cands: DataFrame, transfers: DataFrame, cfg: Assessment, stage: Staging | None = None) -> DataFrame:
    """The largest transfers into and out of each hub. With a `stage`, few columns of the others are shuffled."""
    anchors, k = cands.select("finding_id", "account_key"), cfg.params["top_transfers_per_side"]
    top = top_transfers(anchors, transfers, k) if stage is None else looked_up_transfers(anchors, transfers, k, stage)
    return edge_rows(top, cfg, direction=True)
