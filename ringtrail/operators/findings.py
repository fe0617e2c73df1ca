"""The one shape all detectors write: finding, finding_entity, finding_edge."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail import constants as K
from ringtrail import schemas
from ringtrail.config import Assessment
from ringtrail.functions.membership import may_occur
from ringtrail.functions.ranking import top_k_per_group
from ringtrail.staging import Staging


def stats(**known: Column) -> Column:
    """summary_stats struct; fields a typology does not have stay NULL."""
    fields = [
        known.pop(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.SUMMARY_STATS.fields
    ]
    if known:
        raise ValueError(f"not in summary_stats: {sorted(known)}")
    return F.struct(*fields)


def finding_rows(
    df: DataFrame,
    cfg: Assessment,
    run_ts: datetime,
    *,
    severity: Column,
    title: Column,
    description: Column,
    summary: Column,
    trigger: str,
) -> DataFrame:
    """Stamp the configuration on detector rows. It is a few literals, so no join is needed."""
    values = {
        "finding_id": F.col("finding_id"),
        "finding_type": F.lit(cfg.finding_type),
        "severity": severity,
        "title": title,
        "description": description,
        "detected_at": F.lit(run_ts.isoformat(sep=" ")),
        "summary_stats": summary,
        "control_mapping": cfg.controls(),
        "sla_trigger_date": F.col(trigger),
        "sla_action_date": F.lit(None),
        "sla_duration": cfg.sla_duration(),
        "assessment_id": F.lit(cfg.assessment_id),
    }
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.FINDING.fields])


def entity_rows(df: DataFrame, cfg: Assessment) -> DataFrame:
    return df.select(
        "finding_id", "entity_type", "entity_id", "role", F.lit(cfg.assessment_id).alias("assessment_id")
    )


def edge_rows(df: DataFrame, cfg: Assessment, *, direction: bool = False, labelled: bool = False) -> DataFrame:
    """Edges from columns finding_id, hop_order, src, dst and the transfer's own columns."""
    attrs = {
        "amount": F.col("amount"),
        "currency": F.col("currency"),
        "event_timestamp": F.col("event_timestamp"),
        "payment_format": F.col("payment_format"),
        "direction": F.col("side") if direction else F.lit(None),
        "is_laundering": F.lit(True) if labelled else F.lit(None),
    }
    return df.select(
        "finding_id",
        F.col("hop_order").cast("short").alias("hop_order"),
        F.lit(K.TRANSFER_EDGE).alias("edge_type"),
        F.col("src").alias("from_entity"),
        F.col("dst").alias("to_entity"),
        "fin_txn_id",
        F.struct(*[attrs[f.name].cast(f.dataType).alias(f.name) for f in schemas.EDGE_ATTRS.fields]).alias("attrs"),
        F.lit(cfg.assessment_id).alias("assessment_id"),
    )


def owners_and_banks(anchors: DataFrame, has_account: DataFrame, is_held_at: DataFrame) -> DataFrame:
    """Owner parties and custodian banks of (finding_id, account_key) anchors.

    Anchors are staged, so their size on disk decides whether they are broadcast
    against the two large edge tables or shuffled with them.
    """
    owner = anchors.join(has_account, "account_key").select(
        "finding_id",
        F.lit(K.PARTY).alias("entity_type"),
        F.col("party_id").alias("entity_id"),
        F.lit(K.ACCOUNT_OWNER).alias("role"),
    )
    bank = anchors.join(is_held_at, "account_key").select(
        "finding_id",
        F.lit(K.INSTITUTION).alias("entity_type"),
        F.col("fse_id").alias("entity_id"),
        F.lit(K.CUSTODIAN_BANK).alias("role"),
    )
    return owner.unionByName(bank)


def account_entities(df: DataFrame, account: str, role: Column) -> DataFrame:
    return df.select(
        "finding_id", F.lit(K.ACCOUNT).alias("entity_type"), F.col(account).alias("entity_id"), role.alias("role")
    )


def first_role(entities: DataFrame, roles: Sequence[str]) -> DataFrame:
    """One row per (finding, entity): the role that comes first in `roles`."""
    names = F.array(*[F.lit(r) for r in roles])
    return (
        entities.groupBy("finding_id", "entity_type", "entity_id")
        .agg(F.min(F.array_position(names, F.col("role"))).alias("_first"))
        .select("finding_id", "entity_type", "entity_id", F.element_at(names, F.col("_first").cast("int")).alias("role"))
    )


def both_sides(transfers: DataFrame, *columns: str) -> DataFrame:
    """Each transfer once per touched side: account_key is the touched account,
    counterparty the other end, side says which way the money went. A transfer of an
    account to itself appears on both sides."""
    ends = [
        ("inbound", F.col("to_account_key"), F.col("from_account_key")),
        ("outbound", F.col("from_account_key"), F.col("to_account_key")),
    ]
    sides = F.array(
        *[
            F.struct(F.lit(side).alias("side"), acct.alias("account_key"), other.alias("counterparty"))
            for side, acct, other in ends
        ]
    )
    return transfers.select(*columns, F.explode(sides).alias("_t")).select(*columns, "_t.*")


def top_counterparties(
    anchors: DataFrame, pair_totals: DataFrame, k: int
) -> DataFrame:
    """The k counterparties per side with the largest totals, for (finding_id, account_key) anchors.

    `pair_totals` holds one row per (from, to) with its `total`; ties go to the smaller key.
    """
    touched = anchors.join(both_sides(pair_totals, "total"), "account_key")
    return top_k_per_group(
        touched, ["finding_id", "side"], [F.col("total").desc(), F.col("counterparty")], k, "rank"
    ).select("finding_id", "side", "rank", "counterparty", "total")


def counterparty_roles(top: DataFrame) -> DataFrame:
    role = F.when(F.col("side") == "inbound", K.INBOUND_COUNTERPARTY).otherwise(K.OUTBOUND_COUNTERPARTY)
    return account_entities(top, "counterparty", role)


def top_transfers(anchors: DataFrame, transfers: DataFrame, k: int, *, copies: str | None = None) -> DataFrame:
    """The k largest transfers per side of each anchor, numbered inbound first.

    `copies` names a column telling how often a row counts; no row can fill more than
    k places, so at most k copies of it are made.
    """
    names = ["fin_txn_id", "amount", "currency", "event_timestamp", "payment_format"]
    touched = anchors.join(both_sides(transfers, *names, *([copies] if copies else [])), "account_key")
    if copies:
        repeat = F.sequence(F.lit(1), F.least(F.col(copies), F.lit(k)).cast("int"))
        touched = touched.withColumn("_copy", F.explode(repeat))
    inbound = F.col("side") == "inbound"
    ranked = top_k_per_group(
        touched, ["finding_id", "side"], [F.col("amount").desc(), F.col("fin_txn_id")], k, "rank"
    ).select(
        "finding_id",
        "side",
        "rank",
        F.when(inbound, F.col("counterparty")).otherwise(F.col("account_key")).alias("src"),
        F.when(inbound, F.col("account_key")).otherwise(F.col("counterparty")).alias("dst"),
        *names,
    )
    # At most 2k rows per finding are left, so numbering them is a small second step.
    return top_k_per_group(ranked, ["finding_id"], [F.col("side"), F.col("rank")], 2 * k, "hop_order")


def looked_up_transfers(anchors: DataFrame, transfers: DataFrame, k: int, stage: Staging) -> DataFrame:
    """`top_transfers` where many accounts are anchors: transfers are ranked by id and amount alone, and the
    rest is looked up for those that are left. Transfers have one row per fin_txn_id."""
    sides = [
        F.struct(F.col(f"{end}_account_key").alias("account_key"), F.lit(inbound).alias("inbound"))
        for end, inbound in (("to", True), ("from", False))
    ]
    touched = anchors.join(transfers.select("fin_txn_id", "amount", F.inline(F.array(*sides))), "account_key")
    largest = [F.col("amount").desc(), F.col("fin_txn_id")]
    ranked = top_k_per_group(touched, ["finding_id", "inbound"], largest, k, "rank").drop("account_key", "amount")
    top = top_k_per_group(ranked, ["finding_id"], [F.col("inbound").desc(), F.col("rank")], 2 * k, "hop_order")
    top = stage(top, "largest-transfers")
    return may_occur(transfers, [F.col("fin_txn_id")], top, F.col("fin_txn_id"), stage).join(top, "fin_txn_id").select(
        "finding_id",
        F.when(F.col("inbound"), "inbound").otherwise("outbound").alias("side"),
        "rank",
        F.col("from_account_key").alias("src"),
        F.col("to_account_key").alias("dst"),
        "fin_txn_id", "amount", "currency", "event_timestamp", "payment_format", "hop_order",
    )


def last_finding_id(existing: DataFrame) -> int:
    """Largest id in use, 0 if there are no findings."""
    return existing.agg(F.coalesce(F.max("finding_id"), F.lit(0)).alias("last")).first()["last"]


def with_id_offset(df: DataFrame, existing: DataFrame) -> DataFrame:
    """Shift 1-based ranks behind the ids already given out."""
    return df.withColumn("finding_id", F.col("finding_id") + F.lit(last_finding_id(existing)))


def severity_breakdown(findings: DataFrame, assessment_id: str | None = None) -> DataFrame:
    """Findings per type and severity, optionally of one assessment."""
    if assessment_id is not None:
        findings = findings.filter(F.col("assessment_id") == assessment_id)
    return (
        findings.groupBy("finding_type", "severity")
        .agg(F.count(F.lit(1)).alias("findings"))
        .orderBy("finding_type", "severity")
    )
