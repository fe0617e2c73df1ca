"""Assessment configuration: one row per typology, kept as data."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail import constants as K
from ringtrail import schemas


@dataclass(frozen=True)
class Assessment:
    """Parameters and compliance envelope of one detector."""

    assessment_id: str
    title: str
    description: str
    severity_default: str
    scope_query: str
    success_condition: str
    params: dict[str, object]
    control_mapping: dict[str, str] = field(default_factory=dict)
    sla_hours: int = 72

    @property
    def finding_type(self) -> str:
        return K.FINDING_TYPES[self.assessment_id]

    def controls(self) -> Column:
        pairs = [F.lit(x) for kv in self.control_mapping.items() for x in kv]
        return F.create_map(*pairs).cast(schemas.CONTROL_MAPPING)

    def sla_duration(self) -> Column:
        return F.lit(timedelta(hours=self.sla_hours)).cast(schemas.INTERVAL)


# --- fixed values: the three seeded assessments -----------------------------------
SAR_RULE = "31 CFR 1020.320 (Suspicious Activity Reports)"

CIRCULAR_FLOW = Assessment(
    assessment_id=K.CIRCULAR_FLOW,
    title="Circular fund flow (3-hop laundering ring)",
    description=(
        "Detects closed cycles across 3 distinct accounts where money returns to origin "
        "within a short window and a comparable amount."
    ),
    severity_default="HIGH",
    scope_query="SELECT * FROM silver.transfers_to WHERE amount > 1000",
    success_condition=(
        "A -> B -> C -> A with 3 distinct accounts AND max(ts) - min(ts) <= INTERVAL '14 days' "
        "AND max(amount) / min(amount) <= 1.5 AND single currency."
    ),
    params={
        "hops": 3,
        "max_time_span_days": 14,
        "max_amount_ratio": Decimal("1.5"),
        "min_amount": Decimal("1000"),
        "same_currency": True,
    },
    control_mapping={
        "BSA": SAR_RULE,
        "FATF": "R.20 (Reporting of suspicious transactions)",
        "EU_AMLD": "Directive 2015/849 Art. 33",
    },
    sla_hours=72,
)

MULE_HUB = Assessment(
    assessment_id=K.MULE_HUB,
    title="Mule-hub fan-in / fan-out",
    description=(
        "Detects accounts that receive from many distinct counterparties AND disperse to many "
        "distinct counterparties — classic mule / collector-account topology. Graph-native; no labels."
    ),
    severity_default="HIGH",
    scope_query=(
        "SELECT from_account_key, to_account_key, amount, currency, event_timestamp FROM silver.transfers_to"
    ),
    success_condition=(
        "Account.in_degree (distinct counterparties) >= 10 AND "
        "Account.out_degree (distinct counterparties) >= 10."
    ),
    params={
        "min_in_degree": 10,
        "min_out_degree": 10,
        "top_counterparties_per_side": 5,
        "top_transfers_per_side": 5,
    },
    control_mapping={
        "BSA": SAR_RULE,
        "FATF": "R.10 (Customer due diligence) / R.20 (Reporting)",
        "EU_AMLD": "Directive 2015/849 Art. 18 (Enhanced CDD)",
    },
    sla_hours=72,
)

LAUNDERING_EXPOSURE = Assessment(
    assessment_id=K.LAUNDERING_EXPOSURE,
    title="Laundering-labelled exposure (supervised)",
    description=(
        "Ranks accounts by exposure to transactions flagged IsLaundering=1 in the AMLSim "
        "ground-truth label. Supervised complement to the graph-native assessments — used when "
        "a training label IS available."
    ),
    severity_default="HIGH",
    scope_query="SELECT * FROM bronze.transactions_raw WHERE is_laundering = 1",
    success_condition="Count of labeled transfers touching an Account (as source or destination) >= 20.",
    params={
        "min_labeled_edges": 20,
        "top_transfers": 10,
        "top_counterparties_per_side": 3,
    },
    control_mapping={
        "BSA": SAR_RULE,
        "FATF": "R.10 (Customer due diligence)",
        "EU_AMLD": "Directive 2015/849 Art. 33",
    },
    sla_hours=48,
)

# Rings of other lengths, as queries look for them: longer ones over a wider span and ratio.
OTHER_RINGS = {
    2: {},
    4: {"max_time_span_days": 180, "max_amount_ratio": Decimal("5")},
    5: {"max_time_span_days": 180, "max_amount_ratio": Decimal("5")},
}


# The day from which the query of appended loads counts a transfer to the second one.
SECOND_LOAD = "1996-06-03"


def rings_of(hops: int) -> Assessment:
    """The circular-flow assessment for rings of another number of hops."""
    return replace(CIRCULAR_FLOW, params=CIRCULAR_FLOW.params | {"hops": hops} | OTHER_RINGS[hops])


ASSESSMENTS = {a.assessment_id: a for a in (CIRCULAR_FLOW, MULE_HUB, LAUNDERING_EXPOSURE)}


def config_frame(
    spark: SparkSession, created_at: datetime, assessments: list[Assessment] | None = None
) -> DataFrame:
    """The assessment_config rows of the given (default: all seeded) assessments."""
    rows = [
        (
            a.assessment_id,
            a.title,
            a.description,
            a.severity_default,
            a.scope_query,
            a.success_condition,
            {f: a.params.get(f) for f in schemas.FINDING_CONFIG.names},
            dict(a.control_mapping),
            timedelta(hours=a.sla_hours),
            created_at,
        )
        for a in (assessments if assessments is not None else ASSESSMENTS.values())
    ]
    return spark.createDataFrame(rows, schemas.ASSESSMENT_CONFIG)


def upsert_config(old: DataFrame, new: DataFrame) -> DataFrame:
    """Insert new assessments, replace known ones entirely, keep the first created_at."""
    o, n = old.alias("o"), new.alias("n")
    is_new = F.col("n.assessment_id").isNotNull()
    merged = [
        F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
        for c in schemas.ASSESSMENT_CONFIG.names
        if c != "created_at"
    ]
    kept = F.coalesce("o.created_at", "n.created_at").alias("created_at")
    return o.join(n, F.col("o.assessment_id") == F.col("n.assessment_id"), "full_outer").select(*merged, kept)
