"""Readers of the two raw CSV drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringtrail import schemas

# --- fixed values: file names of the public data set ---------------------------------
TRANSACTIONS_FILE = "HI-Small_Trans.csv"
ACCOUNTS_FILE = "HI-Small_accounts.csv"
TIMESTAMP_FORMAT = "yyyy/MM/dd HH:mm"


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Bind columns by position, skip the header, fail on the first malformed row and on a
    missing value in a NOT NULL column, which the source itself would let pass.

    The transactions header repeats a column name, so names in the file cannot be used.
    A missing file fails when the frame is defined (PATH_NOT_FOUND).
    """
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    rows = (
        spark.read.schema(nullable)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )
    return rows.select(*[F.col(f.name) if f.nullable else _required(f.name) for f in schema.fields])


def _required(name: str) -> Column:
    value = F.col(name)
    return F.when(value.isNull(), F.raise_error(F.lit(f"NULL in column {name}"))).otherwise(value).alias(name)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.TRANSACTIONS_RAW)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.ACCOUNTS_RAW)
