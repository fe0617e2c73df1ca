"""Declared schemas of every layer table; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(20, 4)
# A busy account's total over a very large table does not fit 16 integer digits.
MONEY_TOTAL = T.DecimalType(30, 4)
RATIO = T.DecimalType(10, 4)
NTZ = T.TimestampNTZType()
INTERVAL = T.DayTimeIntervalType()
TEXT = T.StringType()
LONG = T.LongType()


def _struct(*fields: tuple) -> T.StructType:
    """Build a StructType from (name, type) pairs; a third item False marks NOT NULL."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


TRANSACTIONS_RAW = _struct(
    ("event_timestamp", NTZ, False),
    ("from_bank", TEXT, False),
    ("from_account", TEXT, False),
    ("to_bank", TEXT, False),
    ("to_account", TEXT, False),
    ("amount_received", MONEY, False),
    ("receiving_currency", TEXT, False),
    ("amount_paid", MONEY, False),
    ("payment_currency", TEXT, False),
    ("payment_format", TEXT, False),
    ("is_laundering", T.ShortType(), False),
)

ACCOUNTS_RAW = _struct(
    ("bank_name", TEXT, False),
    ("bank_id", TEXT, False),
    ("account_id", TEXT, False),
    ("entity_id", TEXT, False),
    ("entity_name", TEXT, False),
)

PARTY = _struct(
    ("party_id", TEXT, False),
    ("source_customer_id", TEXT, False),
    ("record_source", TEXT),
    ("name", TEXT),
    ("date_of_birth", T.DateType()),
    ("country_of_residence", TEXT),
    ("address_text", TEXT),
    ("phone", TEXT),
    ("email", TEXT),
    ("government_id", TEXT),
    ("risk_tier", TEXT),
)

FINANCIAL_INSTITUTION = _struct(("fse_id", TEXT, False), ("name", TEXT, False))

ACCOUNT = _struct(
    ("account_key", TEXT, False),
    ("bank_id", TEXT, False),
    ("account_id", TEXT, False),
    ("currency", TEXT),
)

FINANCIAL_TRANSACTION = _struct(
    ("fin_txn_id", LONG, False),
    ("event_timestamp", NTZ, False),
    ("amount_paid", MONEY, False),
    ("payment_currency", TEXT, False),
    ("amount_received", MONEY, False),
    ("receiving_currency", TEXT, False),
    ("payment_format", TEXT, False),
    ("source", TEXT),
)

HAS_ACCOUNT = _struct(
    ("party_id", TEXT, False),
    ("account_key", TEXT, False),
    ("relationship", TEXT),
    ("source", TEXT),
)

IS_HELD_AT = _struct(("account_key", TEXT, False), ("fse_id", TEXT, False))

TXN_ACCOUNT = _struct(("fin_txn_id", LONG, False), ("account_key", TEXT, False))

TRANSFERS_TO = _struct(
    ("fin_txn_id", LONG, False),
    ("from_account_key", TEXT, False),
    ("to_account_key", TEXT, False),
    ("event_timestamp", NTZ, False),
    ("amount", MONEY, False),
    ("currency", TEXT, False),
    ("payment_format", TEXT, False),
)

TXN_LABEL = _struct(("fin_txn_id", LONG, False), ("is_laundering", T.ShortType(), False))

FINDING_CONFIG = _struct(
    ("hops", T.IntegerType()),
    ("max_time_span_days", T.IntegerType()),
    ("max_amount_ratio", RATIO),
    ("min_amount", MONEY),
    ("same_currency", T.BooleanType()),
    ("min_in_degree", T.IntegerType()),
    ("min_out_degree", T.IntegerType()),
    ("min_labeled_edges", T.IntegerType()),
    ("top_counterparties_per_side", T.IntegerType()),
    ("top_transfers_per_side", T.IntegerType()),
    ("top_transfers", T.IntegerType()),
)

CONTROL_MAPPING = T.MapType(TEXT, TEXT)

ASSESSMENT_CONFIG = _struct(
    ("assessment_id", TEXT, False),
    ("title", TEXT, False),
    ("description", TEXT),
    ("severity_default", TEXT, False),
    ("scope_query", TEXT, False),
    ("success_condition", TEXT, False),
    ("finding_config", FINDING_CONFIG, False),
    ("control_mapping", CONTROL_MAPPING),
    ("sla_duration", INTERVAL),
    ("created_at", NTZ, False),
)

# One nullable superset for all typologies, so that every detector writes one shape.
SUMMARY_STATS = _struct(
    ("hops", T.ShortType()),
    ("currency", TEXT),
    ("amount_min", MONEY_TOTAL),
    ("amount_max", MONEY_TOTAL),
    ("amount_ratio", RATIO),
    ("time_span_hours", LONG),
    ("payment_formats", T.ArrayType(TEXT)),
    ("accounts", T.ArrayType(TEXT)),
    ("in_degree", LONG),
    ("out_degree", LONG),
    ("in_txn_count", LONG),
    ("out_txn_count", LONG),
    ("in_amount_total", MONEY_TOTAL),
    ("out_amount_total", MONEY_TOTAL),
    ("balance_ratio", T.DoubleType()),
    ("labeled_edges", LONG),
    ("distinct_labeled_txns", LONG),
    ("labeled_amount_total", MONEY_TOTAL),
)

FINDING = _struct(
    ("finding_id", LONG, False),
    ("finding_type", TEXT, False),
    ("severity", TEXT, False),
    ("title", TEXT, False),
    ("description", TEXT),
    ("detected_at", NTZ, False),
    ("summary_stats", SUMMARY_STATS, False),
    ("control_mapping", CONTROL_MAPPING),
    ("sla_trigger_date", NTZ),
    ("sla_action_date", NTZ),
    ("sla_duration", INTERVAL),
    ("assessment_id", TEXT, False),
)

FINDING_ENTITY = _struct(
    ("finding_id", LONG, False),
    ("entity_type", TEXT, False),
    ("entity_id", TEXT, False),
    ("role", TEXT),
    ("assessment_id", TEXT, False),
)

EDGE_ATTRS = _struct(
    ("amount", MONEY),
    ("currency", TEXT),
    ("event_timestamp", NTZ),
    ("payment_format", TEXT),
    ("direction", TEXT),
    ("is_laundering", T.BooleanType()),
)

FINDING_EDGE = _struct(
    ("finding_id", LONG, False),
    ("hop_order", T.ShortType(), False),
    ("edge_type", TEXT, False),
    ("from_entity", TEXT, False),
    ("to_entity", TEXT, False),
    ("fin_txn_id", LONG),
    ("attrs", EDGE_ATTRS),
    ("assessment_id", TEXT, False),
)

GOLD_FINDING = _struct(
    ("finding_id", LONG, False),
    ("assessment_id", TEXT, False),
    ("finding_type", TEXT, False),
    ("severity", TEXT, False),
    ("title", TEXT, False),
    ("description", TEXT),
    ("detected_at", NTZ, False),
    ("hop_count", T.ShortType()),
    ("currency", TEXT),
    ("amount_min", MONEY_TOTAL),
    ("amount_max", MONEY_TOTAL),
    ("amount_ratio", RATIO),
    ("time_span_hours", T.IntegerType()),
    ("control_bsa", TEXT),
    ("control_fatf", TEXT),
    ("control_eu_amld", TEXT),
    ("sla_trigger_date", NTZ),
    ("sla_due_date", NTZ),
    ("sla_duration", INTERVAL),
    ("party_count", T.IntegerType()),
    ("bank_count", T.IntegerType()),
    ("country_count", T.IntegerType()),
    ("countries", T.ArrayType(TEXT)),
    ("banks", T.ArrayType(TEXT)),
)

GOLD_FINDING_ENTITY = _struct(
    ("finding_id", LONG, False),
    ("entity_type", TEXT, False),
    ("entity_id", TEXT, False),
    ("role", TEXT),
    ("display_name", TEXT),
    ("country", TEXT),
    ("risk_tier", TEXT),
    ("bank_id", TEXT),
    ("bank_name", TEXT),
    ("owner_party_id", TEXT),
)

GOLD_FINDING_EDGE = _struct(
    ("finding_id", LONG, False),
    ("hop_order", T.ShortType(), False),
    ("edge_type", TEXT, False),
    ("from_account_key", TEXT, False),
    ("to_account_key", TEXT, False),
    ("from_bank_id", TEXT),
    ("to_bank_id", TEXT),
    ("fin_txn_id", LONG),
    ("amount", MONEY),
    ("currency", TEXT),
    ("event_timestamp", NTZ),
    ("payment_format", TEXT),
)

# Layer-qualified name -> schema. The label table lives outside silver on purpose.
TABLES: dict[str, T.StructType] = {
    "bronze/transactions_raw": TRANSACTIONS_RAW,
    "bronze/accounts_raw": ACCOUNTS_RAW,
    "label/txn_label": TXN_LABEL,
    "silver/financial_institution": FINANCIAL_INSTITUTION,
    "silver/account": ACCOUNT,
    "silver/party": PARTY,
    "silver/financial_transaction": FINANCIAL_TRANSACTION,
    "silver/has_account": HAS_ACCOUNT,
    "silver/is_held_at": IS_HELD_AT,
    "silver/has_originating_account": TXN_ACCOUNT,
    "silver/has_beneficiary_account": TXN_ACCOUNT,
    "silver/transfers_to": TRANSFERS_TO,
    "silver/assessment_config": ASSESSMENT_CONFIG,
    "silver/finding": FINDING,
    "silver/finding_entity": FINDING_ENTITY,
    "silver/finding_edge": FINDING_EDGE,
    "gold/finding": GOLD_FINDING,
    "gold/finding_entity": GOLD_FINDING_ENTITY,
    "gold/finding_edge": GOLD_FINDING_EDGE,
}

# Stored as one folder per assessment.
PER_ASSESSMENT = (FINDING, FINDING_ENTITY, FINDING_EDGE)

PRIMARY_KEYS: dict[str, list[str]] = {
    "silver/financial_institution": ["fse_id"],
    "silver/account": ["account_key"],
    "silver/party": ["party_id"],
    "silver/financial_transaction": ["fin_txn_id"],
    "silver/has_account": ["party_id", "account_key"],
    "silver/is_held_at": ["account_key", "fse_id"],
    "silver/has_originating_account": ["fin_txn_id"],
    "silver/has_beneficiary_account": ["fin_txn_id"],
    "silver/transfers_to": ["fin_txn_id"],
    "silver/assessment_config": ["assessment_id"],
    "silver/finding": ["finding_id"],
    "silver/finding_entity": ["finding_id", "entity_type", "entity_id"],
    "silver/finding_edge": ["finding_id", "hop_order"],
    "gold/finding": ["finding_id"],
    "gold/finding_entity": ["finding_id", "entity_type", "entity_id"],
    "gold/finding_edge": ["finding_id", "hop_order"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("silver/account", "bank_id", "silver/financial_institution", "fse_id"),
    ("silver/has_account", "party_id", "silver/party", "party_id"),
    ("silver/has_account", "account_key", "silver/account", "account_key"),
    ("silver/is_held_at", "account_key", "silver/account", "account_key"),
    ("silver/is_held_at", "fse_id", "silver/financial_institution", "fse_id"),
    ("silver/has_originating_account", "fin_txn_id", "silver/financial_transaction", "fin_txn_id"),
    ("silver/has_originating_account", "account_key", "silver/account", "account_key"),
    ("silver/has_beneficiary_account", "fin_txn_id", "silver/financial_transaction", "fin_txn_id"),
    ("silver/has_beneficiary_account", "account_key", "silver/account", "account_key"),
    ("silver/transfers_to", "fin_txn_id", "silver/financial_transaction", "fin_txn_id"),
    ("silver/transfers_to", "from_account_key", "silver/account", "account_key"),
    ("silver/transfers_to", "to_account_key", "silver/account", "account_key"),
    ("silver/finding", "assessment_id", "silver/assessment_config", "assessment_id"),
    ("silver/finding_entity", "finding_id", "silver/finding", "finding_id"),
    ("silver/finding_edge", "finding_id", "silver/finding", "finding_id"),
    ("silver/finding_edge", "fin_txn_id", "silver/financial_transaction", "fin_txn_id"),
    ("gold/finding_entity", "finding_id", "gold/finding", "finding_id"),
    ("gold/finding_edge", "finding_id", "gold/finding", "finding_id"),
]


def not_null_columns(table: str) -> list[str]:
    """Columns declared NOT NULL in a layer table."""
    return [f.name for f in TABLES[table].fields if not f.nullable]
