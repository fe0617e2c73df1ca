"""Raw rows -> typed graph: parties, accounts, institutions, transactions and their edges.

The label never enters these frames; it leaves the numbered transactions only
through `txn_labels`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail import constants as K
from ringtrail import schemas
from ringtrail.functions.columns import account_key
from ringtrail.functions.ranking import global_rank
from ringtrail.sources.tables import add_missing_columns
from ringtrail.staging import Staging

# Sort order of the transaction ids; the columns after amount_paid only settle ties.
TXN_ORDER = [
    "event_timestamp",
    "from_bank",
    "from_account",
    "to_bank",
    "to_account",
    "amount_paid",
    "amount_received",
    "receiving_currency",
    "payment_currency",
    "payment_format",
]


def number_transactions(txns: DataFrame, stage: Staging, after: int = 0) -> DataFrame:
    """Add fin_txn_id, the dense rank of a transfer in time order, blind to the label, counted on from `after`.

    `txns` must be a stored table (the bronze layer): see `global_rank`. Rows that agree in all but the
    label are numbered in the order of the table.
    """
    return global_rank(txns.select(*TXN_ORDER, "is_laundering"), TXN_ORDER, "fin_txn_id", stage, may_repeat=True, start=after)


def txn_labels(numbered: DataFrame) -> DataFrame:
    return numbered.select("fin_txn_id", "is_laundering")


def financial_transactions(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "fin_txn_id",
        "event_timestamp",
        "amount_paid",
        "payment_currency",
        "amount_received",
        "receiving_currency",
        "payment_format",
        F.lit(K.TRANSACTIONS_SOURCE).alias("source"),
    )


def originating(numbered: DataFrame) -> DataFrame:
    return numbered.select("fin_txn_id", account_key("from_bank", "from_account").alias("account_key"))


def beneficiary(numbered: DataFrame) -> DataFrame:
    return numbered.select("fin_txn_id", account_key("to_bank", "to_account").alias("account_key"))


def transfers_to(numbered: DataFrame) -> DataFrame:
    """One row per transfer, account to account: what the detectors traverse."""
    return numbered.select(
        "fin_txn_id",
        account_key("from_bank", "from_account").alias("from_account_key"),
        account_key("to_bank", "to_account").alias("to_account_key"),
        "event_timestamp",
        F.col("amount_paid").alias("amount"),
        F.col("payment_currency").alias("currency"),
        "payment_format",
    )


def transaction_accounts(txns: DataFrame) -> DataFrame:
    """Distinct accounts seen on either side of a transfer.

    Deduplicated inside each map task first, so one busy account costs one row per task.
    """
    sides = F.array(
        F.struct(F.col("from_bank").alias("bank_id"), F.col("from_account").alias("account_id")),
        F.struct(F.col("to_bank").alias("bank_id"), F.col("to_account").alias("account_id")),
    )
    return (
        txns.select(F.explode(sides).alias("s"))
        .select("s.bank_id", "s.account_id")
        .distinct()
        .withColumn("account_key", account_key("bank_id", "account_id"))
    )


def financial_institutions(txn_accounts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every bank named anywhere, with its ledger name or a made-up one."""
    named = accounts.select("bank_id", "bank_name").distinct()
    unnamed = txn_accounts.select("bank_id", F.lit(None).cast("string").alias("bank_name")).distinct()
    return (
        named.unionByName(unnamed)
        .groupBy(F.col("bank_id").alias("fse_id"))
        .agg(F.max("bank_name").alias("name"))
        .select("fse_id", F.coalesce("name", F.concat(F.lit("Bank "), "fse_id")).alias("name"))
    )


def account_nodes(txn_accounts: DataFrame, accounts: DataFrame) -> DataFrame:
    ledger = accounts.select("bank_id", "account_id").withColumn(
        "account_key", account_key("bank_id", "account_id")
    )
    both = ledger.unionByName(txn_accounts).select("account_key", "bank_id", "account_id").distinct()
    return add_missing_columns(both, schemas.ACCOUNT)


def parties(txn_accounts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Ledger entities plus one synthesized party per transaction account.

    A ledger entity wins over a synthesized party of the same id; of several names
    the smallest is kept.
    """
    ledger = (
        accounts.select("entity_id", "entity_name")
        .distinct()
        .groupBy(F.col("entity_id").alias("party_id"))
        .agg(F.min("entity_name").alias("name"))
        .withColumn("record_source", F.lit(K.ACCOUNTS_SOURCE))
    )
    synthesized = (
        txn_accounts.select(F.col("account_key").alias("party_id"))
        .distinct()
        .join(ledger.select("party_id"), "party_id", "left_anti")
        .select("party_id", F.col("party_id").alias("name"), F.lit(K.SYNTHESIZED_SOURCE).alias("record_source"))
    )
    both = ledger.unionByName(synthesized).withColumn("source_customer_id", F.col("party_id"))
    return add_missing_columns(both, schemas.PARTY)


def has_account(txn_accounts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Who owns which account: ledger ownership plus the synthesized one-to-one rows."""
    ledger = (
        accounts.select(F.col("entity_id").alias("party_id"), account_key("bank_id", "account_id").alias("account_key"))
        .distinct()
        .withColumn("source", F.lit(K.ACCOUNTS_SOURCE))
    )
    key = F.col("account_key")
    synthesized = (
        txn_accounts.select(key.alias("party_id"), key.alias("account_key"))
        .distinct()
        .join(ledger.select("party_id", "account_key"), ["party_id", "account_key"], "left_anti")
        .withColumn("source", F.lit(K.SYNTHESIZED_SOURCE))
    )
    return add_missing_columns(ledger.unionByName(synthesized), schemas.HAS_ACCOUNT)


def is_held_at(account: DataFrame) -> DataFrame:
    return account.select("account_key", F.col("bank_id").alias("fse_id"))
