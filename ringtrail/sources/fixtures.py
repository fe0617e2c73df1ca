"""Transfers and accounts derived from the shared test tables (orders, lineitem, customer, nation).

Squared keys make some accounts busy; every 25th order plants a three-hop ring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail import schemas
from ringtrail.sources import csv_files

# --- fixed values: shape of the derived data -------------------------------------------
BANKS = 25
RING_EVERY = 25
LATE_RING_EVERY = 125
LATE_RING_DAYS = 20
HOURS_BETWEEN_HOPS = 30
# hop, delay steps, offset of the paying customer, offset of the receiving customer
RING_HOPS = [(1, 0, 0, 7), (2, 1, 7, 13), (3, 2, 13, 0)]
CURRENCIES = {"A": "US Dollar", "N": "Euro"}
OTHER_CURRENCY = "Saudi Riyal"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _squared(key: str, n: int) -> Column:
    """key * key div n; the product of two large keys needs more than 64 bits."""
    wide = f"cast({key} as decimal(19,0))"
    return F.expr(f"{wide} * {wide} div {n}")


def _bank(account: Column) -> Column:
    return F.concat(F.lit("B"), F.lpad((account % BANKS).cast("string"), 2, "0"))


def derived_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A single number from file footers.
    n = _table(spark, sf_dir, "customer").count()
    orders = _table(spark, sf_dir, "orders")
    lineitem = _table(spark, sf_dir, "lineitem")
    label_seed = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 50
    ordinary = lineitem.join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.col("l_shipdate").alias("ts"),
        _squared("o_custkey", n).alias("payer"),
        _squared(f"(l_partkey % {n})", n).alias("payee"),
        (
            F.col("l_extendedprice").cast("decimal(20,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)")
        ).cast(schemas.MONEY).alias("received"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("paid"),
        F.col("l_returnflag").alias("ccy"),
        F.col("l_linestatus").alias("fmt"),
        F.when(label_seed == 0, 1).otherwise(0).alias("label"),
    )

    key = F.col("o_orderkey")
    last = F.col("hop.n") == 3
    hops = F.explode(
        F.array(
            *[
                F.struct(*[F.lit(v).alias(a) for v, a in zip(h, ("n", "steps", "from_shift", "to_shift"))])
                for h in RING_HOPS
            ]
        )
    )
    delay = F.when((key % LATE_RING_EVERY == 0) & last, F.make_dt_interval(F.lit(LATE_RING_DAYS))).otherwise(
        F.make_dt_interval(F.lit(0), F.col("hop.steps") * HOURS_BETWEEN_HOPS)
    )
    factor = (
        F.when(~last, F.lit("1.00"))
        .when(key % 4 == 0, F.lit("1.05"))
        .when(key % 4 == 1, F.lit("1.30"))
        .when(key % 4 == 2, F.lit("1.50"))
        .otherwise(F.lit("1.60"))
        .cast("decimal(4,2)")
    )
    amount = (F.col("o_totalprice").cast("decimal(20,2)") * factor).cast(schemas.MONEY)
    planted = (
        orders.filter(key % RING_EVERY == 0)
        .withColumn("hop", hops)
        .select(
            (F.col("o_orderdate") + delay).alias("ts"),
            ((F.col("o_custkey") + F.col("hop.from_shift")) % n).alias("payer"),
            ((F.col("o_custkey") + F.col("hop.to_shift")) % n).alias("payee"),
            amount.alias("received"),
            amount.alias("paid"),
            F.lit("R").alias("ccy"),
            F.when((key % 8 == 4) & (F.col("hop.n") == 2), "F").otherwise("O").alias("fmt"),
            F.when((key % 3 == 0) & last, 0).when(key % 7 == 0, 0).otherwise(1).alias("label"),
        )
    )

    currency = F.when(F.col("ccy") == "A", CURRENCIES["A"]).when(F.col("ccy") == "N", CURRENCIES["N"])
    currency = currency.otherwise(OTHER_CURRENCY)
    return ordinary.unionByName(planted).select(
        F.col("ts").alias("event_timestamp"),
        _bank(F.col("payer")).alias("from_bank"),
        F.col("payer").cast("string").alias("from_account"),
        _bank(F.col("payee")).alias("to_bank"),
        F.col("payee").cast("string").alias("to_account"),
        F.col("received").alias("amount_received"),
        currency.alias("receiving_currency"),
        F.col("paid").alias("amount_paid"),
        currency.alias("payment_currency"),
        F.when(F.col("fmt") == "O", "ACH").otherwise("Wire").alias("payment_format"),
        F.col("label").cast("short").alias("is_laundering"),
    )


def derived_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 == 0)
    nation = _table(spark, sf_dir, "nation")
    owner = F.expr("cast(c_custkey div 6 as string)")
    return customer.join(nation, F.col("n_nationkey") == F.col("c_custkey") % BANKS).select(
        F.concat(F.lit("Bank of "), F.col("n_name")).alias("bank_name"),
        _bank(F.col("c_custkey")).alias("bank_id"),
        F.col("c_custkey").cast("string").alias("account_id"),
        F.concat(F.lit("E"), owner).alias("entity_id"),
        F.concat(F.lit("Entity #"), owner).alias("entity_name"),
    )


def write_csv(spark: SparkSession, sf_dir: str, out: str) -> None:
    """The derived rows as the two CSV drops below a folder, compressed."""
    options = {"header": True, "timestampNTZFormat": csv_files.TIMESTAMP_FORMAT, "compression": "gzip"}
    for frame, name in (
        (derived_transactions(spark, sf_dir), csv_files.TRANSACTIONS_FILE),
        (derived_accounts(spark, sf_dir), csv_files.ACCOUNTS_FILE),
    ):
        frame.write.options(**options).csv(f"{out}/{name}")
