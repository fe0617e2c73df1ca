"""Findings -> flat display tables. One job for all assessments, no branch per typology.

Findings are small next to the graph, so the graph tables are first cut to the keys the
findings mention (a semi-join, broadcast when the staged side is small) and only the
remainder is joined. Rows of each entity type are joined on their own key, which keeps
NULL keys out of the shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail import constants as K
from ringtrail import schemas
from ringtrail.functions.columns import null_if_empty


def _conform(df: DataFrame, schema, **values: Column) -> DataFrame:
    return df.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _needed(dimension: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of a large table whose key occurs in the one-column frame `wanted`."""
    keys = wanted.toDF(key).distinct()
    return dimension.join(keys, key, "left_semi")


def account_owners(entity: DataFrame, has_account: DataFrame) -> DataFrame:
    """Owner of each account among the parties of the same finding: the primary owner
    first, then the smallest party id."""
    accounts = entity.filter(F.col("entity_type") == K.ACCOUNT).select(
        "finding_id", F.col("entity_id").alias("account_key")
    )
    present = entity.filter(F.col("entity_type") == K.PARTY).select(
        "finding_id", F.col("entity_id").alias("party_id")
    )
    later = F.when(F.col("relationship") == K.PRIMARY_OWNER, 0).otherwise(1)
    return (
        accounts.join(has_account.select("account_key", "party_id", "relationship"), "account_key")
        .join(present, ["finding_id", "party_id"], "left_semi")
        .groupBy("finding_id", "account_key")
        .agg(F.min(F.struct(later.alias("later"), F.col("party_id"))).alias("best"))
        .select("finding_id", "account_key", F.col("best.party_id").alias("owner_party_id"))
    )


def gold_entity(
    entity: DataFrame, party: DataFrame, institution: DataFrame, account: DataFrame, has_account: DataFrame
) -> DataFrame:
    def of_type(kind: str) -> DataFrame:
        return entity.filter(F.col("entity_type") == kind).drop("assessment_id")

    base = {c: F.col(c) for c in ("finding_id", "entity_type", "entity_id", "role")}

    people = of_type(K.PARTY)
    people = people.join(
        _needed(party.select("party_id", "name", "country_of_residence", "risk_tier"), "party_id", people.select("entity_id")),
        F.col("entity_id") == F.col("party_id"),
        "left",
    )
    people = _conform(
        people,
        schemas.GOLD_FINDING_ENTITY,
        **base,
        display_name=F.col("name"),
        country=F.col("country_of_residence"),
        risk_tier=F.col("risk_tier"),
    )

    banks = of_type(K.INSTITUTION).join(institution, F.col("entity_id") == F.col("fse_id"), "left")
    banks = _conform(
        banks, schemas.GOLD_FINDING_ENTITY, **base, display_name=F.col("name"), bank_name=F.col("name")
    )

    accounts = of_type(K.ACCOUNT)
    located = _needed(account.select("account_key", "bank_id"), "account_key", accounts.select("entity_id"))
    accounts = (
        accounts.withColumn("account_key", F.col("entity_id"))
        .join(located, "account_key", "left")
        .join(institution, F.col("bank_id") == F.col("fse_id"), "left")
        .join(account_owners(entity, has_account), ["finding_id", "account_key"], "left")
    )
    accounts = _conform(
        accounts,
        schemas.GOLD_FINDING_ENTITY,
        **base,
        display_name=F.col("entity_id"),
        bank_id=F.col("bank_id"),
        bank_name=F.col("name"),
        owner_party_id=F.col("owner_party_id"),
    )
    return people.unionByName(banks).unionByName(accounts)


def entity_summary(gold_entities: DataFrame) -> DataFrame:
    """Per finding: parties, banks, countries; the arrays are sorted and NULL when empty."""
    is_bank = F.col("entity_type") == K.INSTITUTION
    countries = F.array_sort(F.collect_set("country"))
    banks = F.array_sort(F.collect_set(F.when(is_bank, F.col("display_name"))))
    return gold_entities.groupBy("finding_id").agg(
        F.count_if(F.col("entity_type") == K.PARTY).alias("party_count"),
        F.count_if(is_bank).alias("bank_count"),
        null_if_empty(countries).alias("countries"),
        null_if_empty(banks).alias("banks"),
    )


def gold_finding(finding: DataFrame, gold_entities: DataFrame) -> DataFrame:
    """Flat finding with the list-view aggregates of its entities."""
    joined = finding.join(entity_summary(gold_entities), "finding_id", "left")
    plain = ["finding_id", "assessment_id", "finding_type", "severity", "title", "description", "detected_at"]
    stat = F.col("summary_stats").getField
    control = F.col("control_mapping").getItem

    def count(column: Column) -> Column:
        return F.coalesce(column, F.lit(0))

    return _conform(
        joined,
        schemas.GOLD_FINDING,
        **{c: F.col(c) for c in plain},
        hop_count=stat("hops"),
        **{c: stat(c) for c in ("currency", "amount_min", "amount_max", "amount_ratio", "time_span_hours")},
        control_bsa=control("BSA"),
        control_fatf=control("FATF"),
        control_eu_amld=control("EU_AMLD"),
        sla_trigger_date=F.col("sla_trigger_date"),
        sla_due_date=F.col("sla_trigger_date") + F.col("sla_duration"),
        sla_duration=F.col("sla_duration"),
        party_count=count(F.col("party_count")),
        bank_count=count(F.col("bank_count")),
        country_count=F.when(F.col("countries").isNull(), 0).otherwise(F.size("countries")),
        countries=F.col("countries"),
        banks=F.col("banks"),
    )


def gold_edge(edge: DataFrame, account: DataFrame) -> DataFrame:
    """Flat edge with the banks of both accounts."""
    touched = edge.select(F.explode(F.array("from_entity", "to_entity")))
    located = _needed(account.select("account_key", "bank_id"), "account_key", touched)
    sender = located.toDF("from_entity", "from_bank_id")
    receiver = located.toDF("to_entity", "to_bank_id")
    joined = edge.join(sender, "from_entity", "left").join(receiver, "to_entity", "left")
    plain = ["finding_id", "hop_order", "edge_type", "from_bank_id", "to_bank_id", "fin_txn_id"]
    attr = F.col("attrs").getField
    return _conform(
        joined,
        schemas.GOLD_FINDING_EDGE,
        **{c: F.col(c) for c in plain},
        from_account_key=F.col("from_entity"),
        to_account_key=F.col("to_entity"),
        **{c: attr(c) for c in ("amount", "currency", "event_timestamp", "payment_format")},
    )
