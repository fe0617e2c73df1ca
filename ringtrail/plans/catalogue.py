"""Named queries: every operator over whole tables, flattened for comparison with SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringtrail import config, schemas
from ringtrail.operators import appended_rings, circular_flow, evaluate, exposure, findings, lineage, mule_hub, publish, quality, reads, two_hop
from ringtrail.plans.pipeline import FINDING_TABLES
from ringtrail.plans.workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]

CONTROL_KEYS = {"control_bsa": "BSA", "control_fatf": "FATF", "control_eu_amld": "EU_AMLD"}


def _interval_hours(column: Column) -> Column:
    start = F.expr("timestamp_ntz'2000-01-01 00:00:00'")
    micros = F.timestamp_diff("MICROSECOND", start, start + column)
    return F.floor(micros / F.lit(3_600_000_000))


def flat(df: DataFrame) -> DataFrame:
    """Plain columns only: amounts as double, whole numbers as bigint, times as text,
    intervals as hours, arrays joined by '|'."""
    out = []
    for f in df.schema.fields:
        column, kind = F.col(f.name), f.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("long")
        elif isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
            column = column.cast("string")
        elif isinstance(kind, T.DayTimeIntervalType):
            column = _interval_hours(column)
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), "|")
        out.append(column.alias(f.name))
    return df.select(*out)


def _finding_columns(df: DataFrame, *stats: str) -> DataFrame:
    return flat(
        df.select(
            "finding_id",
            "assessment_id",
            "finding_type",
            "severity",
            "title",
            "description",
            *[F.col("summary_stats").getField(s).alias(s) for s in stats],
            *[F.col("control_mapping").getItem(k).alias(c) for c, k in CONTROL_KEYS.items()],
            "sla_trigger_date",
            F.col("sla_duration").alias("sla_hours"),
        )
    )


def _edge_columns(df: DataFrame) -> DataFrame:
    return flat(df.select("finding_id", "hop_order", "edge_type", "from_entity", "to_entity", "fin_txn_id", "attrs.*"))


def _entity_columns(df: DataFrame) -> DataFrame:
    return df.select("finding_id", "entity_type", "entity_id", "role")


_queries: dict[str, Query] = {}


def _query(step: str):
    """Register a function of a workspace in which `step` is done."""

    def register(build: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(workspace(spark, sf_dir).after(step))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        _queries[build.__name__] = run
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


# --- sources ------------------------------------------------------------------------


@_query("bronze")
def bronze_transactions(w: Workspace) -> DataFrame:
    """As loaded from the CSV drop."""
    return flat(w.table("bronze/transactions_raw"))


@_query("bronze")
def bronze_accounts(w: Workspace) -> DataFrame:
    return flat(w.table("bronze/accounts_raw"))


@_query("gold")
def layer_row_counts(w: Workspace) -> DataFrame:
    # Fixed list: the tables a run reports on.
    names = [
        "bronze/transactions_raw", "silver/transfers_to", "silver/party", "silver/account",
        "silver/finding", "gold/finding", "gold/finding_entity", "gold/finding_edge",
    ]
    return quality.layer_counts({n: w.table(n) for n in names})


@_query("exposure")
def assessment_config_upsert(w: Workspace) -> DataFrame:
    """Stored rows upserted with a changed one, and what the new SLA means for the findings.

    The changed row replaces the stored one but keeps its creation time.
    """
    stored = w.table("silver/assessment_config")
    later = w.pipeline.run_ts + timedelta(days=1)
    changed = replace(config.CIRCULAR_FLOW, title="Circular fund flow, revised", sla_hours=24)
    merged = config.upsert_config(stored, config.config_frame(w.spark, later, [changed]))
    open_findings = (
        w.table("silver/finding")
        .groupBy("assessment_id")
        .agg(F.count(F.lit(1)).alias("findings"), F.max("sla_trigger_date").alias("last_trigger"))
    )
    return flat(
        merged.join(open_findings, "assessment_id", "left").select(
            "assessment_id",
            "title",
            "severity_default",
            "finding_config.*",
            *[F.col("control_mapping").getItem(k).alias(c) for c, k in CONTROL_KEYS.items()],
            F.col("sla_duration").alias("sla_hours"),
            "created_at",
            "findings",
            (F.col("last_trigger") + F.col("sla_duration")).alias("last_due"),
        )
    )


# --- graph --------------------------------------------------------------------------


@_query("silver")
def kg_financial_institution(w: Workspace) -> DataFrame:
    return w.table("silver/financial_institution")


@_query("silver")
def kg_account(w: Workspace) -> DataFrame:
    return w.table("silver/account")


@_query("silver")
def kg_party(w: Workspace) -> DataFrame:
    return flat(w.table("silver/party"))


@_query("silver")
def kg_txn_ids(w: Workspace) -> DataFrame:
    """Ids with both ends and the label, joined back from the tables they were spread over."""
    txn = w.table("silver/financial_transaction").select("fin_txn_id", "event_timestamp", "amount_paid")
    payer = w.table("silver/has_originating_account").withColumnRenamed("account_key", "from_account_key")
    payee = w.table("silver/has_beneficiary_account").withColumnRenamed("account_key", "to_account_key")
    label = w.table("label/txn_label")
    return flat(txn.join(payer, "fin_txn_id").join(payee, "fin_txn_id").join(label, "fin_txn_id"))


@_query("silver")
def kg_financial_transaction(w: Workspace) -> DataFrame:
    return flat(w.table("silver/financial_transaction"))


@_query("silver")
def kg_has_originating_account(w: Workspace) -> DataFrame:
    return w.table("silver/has_originating_account")


@_query("silver")
def kg_has_beneficiary_account(w: Workspace) -> DataFrame:
    return w.table("silver/has_beneficiary_account")


@_query("silver")
def kg_transfers_to(w: Workspace) -> DataFrame:
    return flat(w.table("silver/transfers_to"))


@_query("silver")
def kg_has_account(w: Workspace) -> DataFrame:
    return w.table("silver/has_account")


@_query("silver")
def kg_is_held_at(w: Workspace) -> DataFrame:
    return w.table("silver/is_held_at")


# --- circular flow -------------------------------------------------------------------


@_query("silver")
def two_hop_path_counts(w: Workspace) -> DataFrame:
    hops = circular_flow.ring_transfers(w.table("silver/transfers_to"), config.CIRCULAR_FLOW)
    return flat(two_hop.two_hop_path_counts(hops, config.CIRCULAR_FLOW, w.stage))


@_query("circular_flow")
def closable_paths(w: Workspace) -> DataFrame:
    return flat(circular_flow.closable_paths(w.frame("rings")))


@_query("circular_flow")
def circular_flow_cycles(w: Workspace) -> DataFrame:
    return flat(w.frame("rings").select("finding_id", *circular_flow.ring_columns(3)))


def _rings_of(hops: int):
    """Register the rings of another number of hops with what their findings say, over the same transfers."""

    def rings(w: Workspace) -> DataFrame:
        cfg = config.rings_of(hops)
        found = w.stage(circular_flow.cycles(w.table("silver/transfers_to"), cfg, w.stage), f"rings-{hops}")
        texts = circular_flow.findings(found, cfg, w.pipeline.run_ts).select("finding_id", "severity", "title", "description")
        return flat(found.select("finding_id", *circular_flow.ring_columns(hops)).join(texts, "finding_id"))

    rings.__name__ = f"circular_flow_{hops}_hops"
    return _query("silver")(rings)


for _hops in config.OTHER_RINGS:
    _rings_of(_hops)


@_query("silver")
def circular_flow_appended(w: Workspace) -> DataFrame:
    """All rings over two loads: those of the transfers before a day, then those that the rest closes."""
    cfg, transfers = config.CIRCULAR_FLOW, w.table("silver/transfers_to")
    day = F.lit(config.SECOND_LOAD).cast("timestamp_ntz")
    old, new = transfers.filter(F.col("event_timestamp") < day), transfers.filter(F.col("event_timestamp") >= day)
    before = circular_flow.cycles(old, cfg, w.stage)
    stored = w.stage(circular_flow.link_summaries(circular_flow.ring_transfers(old, cfg)), "link-summaries")
    last = old.agg(F.coalesce(F.max("fin_txn_id"), F.lit(0)).alias("last")).first()["last"]
    added = appended_rings.cycles_of_append(stored, old, new, last, cfg, w.stage)
    added = findings.with_id_offset(added, before)
    both = before.withColumn("load", F.lit(1)).unionByName(added.withColumn("load", F.lit(2)))
    return flat(both.select("load", "finding_id", *circular_flow.ring_columns(3)))


@_query("circular_flow")
def circular_flow_findings(w: Workspace) -> DataFrame:
    rows = circular_flow.findings(w.frame("rings"), config.CIRCULAR_FLOW, w.pipeline.run_ts)
    return _finding_columns(
        rows, "hops", "currency", "amount_min", "amount_max", "amount_ratio", "time_span_hours",
        "payment_formats", "accounts",
    )


@_query("circular_flow")
def circular_flow_entities(w: Workspace) -> DataFrame:
    return _entity_columns(
        circular_flow.entities(
            w.frame("rings"), config.CIRCULAR_FLOW, w.table("silver/has_account"), w.table("silver/is_held_at")
        )
    )


@_query("circular_flow")
def circular_flow_edges(w: Workspace) -> DataFrame:
    return _edge_columns(circular_flow.edges(w.frame("rings"), config.CIRCULAR_FLOW)).drop("direction", "is_laundering")


@_query("exposure")
def finding_breakdown(w: Workspace) -> DataFrame:
    return findings.severity_breakdown(w.table("silver/finding"))


# --- mule hub ------------------------------------------------------------------------


@_query("silver")
def account_out_degree(w: Workspace) -> DataFrame:
    return flat(mule_hub.degree_profile(mule_hub.pair_totals(w.table("silver/transfers_to")), "out"))


@_query("silver")
def account_in_degree(w: Workspace) -> DataFrame:
    return flat(mule_hub.degree_profile(mule_hub.pair_totals(w.table("silver/transfers_to")), "in"))


@_query("mule_hub")
def mule_hub_candidates(w: Workspace) -> DataFrame:
    return flat(w.frame("hubs"))


@_query("mule_hub")
def dominant_currency(w: Workspace) -> DataFrame:
    hubs = w.frame("hubs").select("finding_id", "account_key")
    currency = mule_hub.dominant_currency(hubs, w.table("silver/transfers_to"), w.stage)
    return hubs.join(currency, "finding_id").drop("finding_id")


@_query("exposure")
def finding_id_offsets(w: Workspace) -> DataFrame:
    """First and last id per assessment, and the id each one continues from."""
    ids = w.table("silver/finding").groupBy("assessment_id")
    return ids.agg(
        F.min("finding_id").alias("first_id"),
        F.max("finding_id").alias("last_id"),
        F.count(F.lit(1)).alias("findings"),
        (F.min("finding_id") - 1).alias("id_offset"),
    )


@_query("mule_hub")
def mule_hub_findings(w: Workspace) -> DataFrame:
    rows = mule_hub.findings(w.frame("hubs"), config.MULE_HUB, w.pipeline.run_ts)
    return _finding_columns(
        rows, "currency", "in_degree", "out_degree", "in_txn_count", "out_txn_count", "in_amount_total",
        "out_amount_total", "balance_ratio", "amount_min", "amount_max", "time_span_hours",
    )


@_query("mule_hub")
def mule_hub_top_counterparties(w: Workspace) -> DataFrame:
    return flat(mule_hub.hub_counterparties(w.frame("hubs"), w.frame("pair_totals"), config.MULE_HUB))


@_query("mule_hub")
def mule_hub_entities(w: Workspace) -> DataFrame:
    return _entity_columns(
        mule_hub.entities(
            w.frame("hubs"),
            w.frame("pair_totals"),
            config.MULE_HUB,
            w.table("silver/has_account"),
            w.table("silver/is_held_at"),
        )
    )


@_query("mule_hub")
def mule_hub_edges(w: Workspace) -> DataFrame:
    rows = mule_hub.edges(w.frame("hubs"), w.table("silver/transfers_to"), config.MULE_HUB)
    return _edge_columns(rows).drop("is_laundering")


# --- exposure ------------------------------------------------------------------------


@_query("exposure")
def labeled_edges(w: Workspace) -> DataFrame:
    return flat(w.frame("labeled"))


@_query("exposure")
def exposure_candidates(w: Workspace) -> DataFrame:
    return flat(w.frame("exposed"))


@_query("exposure")
def exposure_findings(w: Workspace) -> DataFrame:
    rows = exposure.findings(w.frame("exposed"), config.LAUNDERING_EXPOSURE, w.pipeline.run_ts)
    return _finding_columns(
        rows, "currency", "labeled_edges", "distinct_labeled_txns", "labeled_amount_total", "amount_min",
        "amount_max", "time_span_hours",
    )


@_query("exposure")
def exposure_top_counterparties(w: Workspace) -> DataFrame:
    return flat(exposure.exposed_counterparties(w.frame("exposed"), w.frame("labeled"), config.LAUNDERING_EXPOSURE))


@_query("exposure")
def exposure_entities(w: Workspace) -> DataFrame:
    return _entity_columns(
        exposure.entities(
            w.frame("exposed"),
            w.frame("labeled"),
            config.LAUNDERING_EXPOSURE,
            w.table("silver/has_account"),
            w.table("silver/is_held_at"),
        )
    )


@_query("exposure")
def exposure_edges(w: Workspace) -> DataFrame:
    rows = exposure.edges(w.frame("exposed"), w.frame("labeled"), config.LAUNDERING_EXPOSURE)
    return _edge_columns(rows).withColumn("is_laundering", F.col("is_laundering").cast("long"))


# --- gold and reads --------------------------------------------------------------------


@_query("gold")
def gold_finding(w: Workspace) -> DataFrame:
    return flat(w.table("gold/finding").drop("detected_at").withColumnRenamed("sla_duration", "sla_hours"))


@_query("gold")
def gold_finding_entity(w: Workspace) -> DataFrame:
    return w.table("gold/finding_entity")


@_query("exposure")
def gold_account_owner(w: Workspace) -> DataFrame:
    return publish.account_owners(w.table("silver/finding_entity"), w.table("silver/has_account"))


@_query("gold")
def gold_finding_edge(w: Workspace) -> DataFrame:
    return flat(w.table("gold/finding_edge"))


@_query("gold")
def list_findings(w: Workspace) -> DataFrame:
    return flat(reads.list_findings(w.table("gold/finding")).drop("detected_at"))


@_query("gold")
def list_findings_by_severity(w: Workspace) -> DataFrame:
    return flat(reads.list_findings(w.table("gold/finding"), "HIGH", reads.MAX_LIMIT).drop("detected_at"))


@_query("gold")
def finding_detail(w: Workspace) -> DataFrame:
    detail = reads.finding_detail(w.table("gold/finding"), 1)
    return flat(detail.drop("detected_at").withColumnRenamed("sla_duration", "sla_hours"))


@_query("gold")
def finding_graph_entities(w: Workspace) -> DataFrame:
    return reads.finding_graph(w.table("gold/finding_entity"), w.table("gold/finding_edge"), 1)[0]


@_query("gold")
def finding_graph_edges(w: Workspace) -> DataFrame:
    return flat(reads.finding_graph(w.table("gold/finding_entity"), w.table("gold/finding_edge"), 1)[1])


@_query("gold")
def findings_by_type_sample(w: Workspace) -> DataFrame:
    return flat(reads.ids_by_type(w.table("gold/finding")))


@_query("gold")
def graph_export_nodes(w: Workspace) -> DataFrame:
    return reads.graph_elements(w.table("gold/finding_entity"), w.table("gold/finding_edge"))[0]


@_query("gold")
def graph_export_edges(w: Workspace) -> DataFrame:
    return flat(reads.graph_elements(w.table("gold/finding_entity"), w.table("gold/finding_edge"))[1])


@_query("gold")
def finding_display(w: Workspace) -> DataFrame:
    shown = reads.with_display(w.table("gold/finding"))
    return flat(shown.select("finding_id", "currency", "currency_code", "country_names", "time_span_hours", "duration"))


# --- quality ---------------------------------------------------------------------------


def _all_tables(w: Workspace) -> dict[str, DataFrame]:
    return {name: w.table(name) for name in schemas.TABLES}


@_query("gold")
def dq_not_null(w: Workspace) -> DataFrame:
    return quality.not_null_report(_all_tables(w))


@_query("gold")
def dq_pk_violations(w: Workspace) -> DataFrame:
    tables = _all_tables(w)
    return quality.pk_report({name: tables[name] for name in schemas.PRIMARY_KEYS})


@_query("gold")
def dq_fk_violations(w: Workspace) -> DataFrame:
    return quality.fk_report(_all_tables(w))


@_query("exposure")
def dq_findings_without_account(w: Workspace) -> DataFrame:
    return quality.findings_without_account(w.table("silver/finding"), w.table("silver/finding_entity"))


@_query("exposure")
def dq_unknown_finding_types(w: Workspace) -> DataFrame:
    return quality.unknown_types(w.table("silver/finding"))


@_query("gold")
def dq_gold_matches_silver(w: Workspace) -> DataFrame:
    return quality.counts_match(w.table("silver/finding"), w.table("gold/finding"))


@_query("gold")
def dq_label_lineage(w: Workspace) -> DataFrame:
    """Per stored table: columns with values of the label, and whether it chose or ordered the rows. The
    finding tables stand once per assessment, as the detectors differ in what they may read."""
    skipped = ("bronze/accounts_raw", "silver/assessment_config", *FINDING_TABLES)
    paths = [n for n in schemas.TABLES if n not in skipped]
    paths += [f"{n}/assessment_id={a}" for n in FINDING_TABLES for a in config.ASSESSMENTS]
    tables = {n: w.spark.read.parquet(f"{w.pipeline.root}/{n}") for n in paths}
    uses = lineage.uses_of(tables, "is_laundering", w.pipeline.origins)
    known = w.spark.createDataFrame(uses, "table_name string, label_columns string, label_chose boolean, label_ordered boolean")
    return quality.layer_counts(tables).join(known, "table_name")


@_query("gold")
def dq_label_isolation(w: Workspace) -> DataFrame:
    """Rows and label columns of every graph table; the label table is the only one with a label."""
    rows = quality.layer_counts(
        {n: w.table(n) for n in schemas.TABLES if n.startswith(("label/", "silver/")) and "finding" not in n and "config" not in n}
    )
    tables = {n: w.stored(n) for n in schemas.TABLES}
    labelled = quality.columns_named(tables, "is_laundering")
    count = F.lit(0)
    for name, columns in labelled.items():
        count = F.when(F.col("table_name") == name, len(columns)).otherwise(count)
    return rows.withColumn("label_columns", count.cast("long"))


# --- evaluation --------------------------------------------------------------------------


@_query("silver")
def eval_base_rate(w: Workspace) -> DataFrame:
    return evaluate.base_rate(w.table("label/txn_label"))


@_query("exposure")
def eval_precision(w: Workspace) -> DataFrame:
    return evaluate.precision(w.table("silver/finding_edge"), w.table("label/txn_label"))


@_query("exposure")
def eval_recall(w: Workspace) -> DataFrame:
    return evaluate.recall(w.table("silver/finding_edge"), w.table("label/txn_label"))


@_query("exposure")
def eval_lift(w: Workspace) -> DataFrame:
    return evaluate.lift(w.table("silver/finding_edge"), w.table("label/txn_label"))


@_query("circular_flow")
def eval_ring_overlap(w: Workspace) -> DataFrame:
    return evaluate.ring_overlap(w.table("silver/finding_edge"), w.table("label/txn_label"))


@_query("mule_hub")
def eval_mule_accounts(w: Workspace) -> DataFrame:
    return evaluate.account_signal(
        w.table("silver/finding_entity"), w.table("silver/transfers_to"), w.table("label/txn_label")
    )
