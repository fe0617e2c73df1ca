"""Layer tables as Parquet directories: full refresh, per-assessment replacement, reads."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringtrail import schemas
from ringtrail.sources.switching import Change, commit, fresh_folder, pending
from ringtrail.staging import exists

PARTITION_COLUMN = "assessment_id"
LOAD = "load-"


@dataclass(frozen=True)
class WriteReport:
    """What one write did; the row count is observed during the write itself."""

    table: str
    rows: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / max(self.seconds, 1e-3)

    def __str__(self) -> str:
        return f"[{self.table}] {self.rows:,} rows in {self.seconds:,.1f}s ({self.rows_per_second:,.0f} rows/s)"


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring an older or narrower frame to a schema: absent columns become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, root: str | None = None, changes: Sequence[Change] = ()
) -> DataFrame:
    """Read with the declared schema; columns that old files lack come back as NULL.

    What a commit below `root` (default: the folder around the table) has changed counts from the moment
    of the commit, whether or not its folders have been moved; `changes` count as well, for the step that
    makes them.
    """
    base, replaced, added = path, [], []
    for change in [*pending(spark, root or _parent(path)), *changes]:
        if change.path == path and change.fresh is not None:
            base, replaced, added = change.fresh, [], []
        elif change.path.startswith(f"{path}/{PARTITION_COLUMN}="):
            replaced.append(change)
        elif change.path.startswith(f"{path}/{LOAD}"):
            added.append(change.fresh)
    if schema in schemas.PER_ASSESSMENT:
        return _read_partitions(spark, base, schema, replaced)
    # Later loads lie in folders of their own below the first.
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(base, *added)


def _read_partitions(spark: SparkSession, base: str, schema: T.StructType, replaced: Sequence[Change]) -> DataFrame:
    reader = spark.read.schema(schema)
    if not replaced:
        return reader.parquet(base)
    df = reader.parquet(base) if exists(spark, base) else spark.createDataFrame([], schema)
    for change in replaced:
        value = change.path.rpartition("=")[2]
        df = df.filter(F.col(PARTITION_COLUMN) != value)
        if change.fresh is not None:
            inner = T.StructType([f for f in schema.fields if f.name != PARTITION_COLUMN])
            fresh = spark.read.schema(inner).parquet(change.fresh).withColumn(PARTITION_COLUMN, F.lit(value))
            df = df.unionByName(fresh)
    return df


def load_folder(path: str) -> str:
    """Where one more load of a table lies."""
    return f"{path}/{LOAD}{uuid.uuid4().hex}"


def _parent(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0]


def write_fresh(df: DataFrame, path: str, name: str = "table") -> tuple[WriteReport, Change]:
    """Write what is to take the place of a table, and say so; nothing changes before a commit."""
    seen = Observation()
    started = time.perf_counter()
    fresh = fresh_folder(path)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(fresh)
    return WriteReport(name, seen.get["rows"], time.perf_counter() - started), Change(fresh, path)


def write_fresh_partition(df: DataFrame, path: str, assessment_id: str, name: str = "table") -> tuple[WriteReport, Change]:
    """One assessment's rows in place of those it has.

    Each assessment is one partition directory, so replacing it with an empty result
    removes the old rows too (a dynamic partition overwrite would keep them).
    """
    rows = df.filter(F.col(PARTITION_COLUMN) == assessment_id).drop(PARTITION_COLUMN)
    return write_fresh(rows, f"{path}/{PARTITION_COLUMN}={assessment_id}", name)


def overwrite_table(df: DataFrame, path: str, name: str = "table") -> WriteReport:
    """Full refresh of one table on its own: whatever was there is replaced."""
    report, change = write_fresh(df, path, name)
    commit(df.sparkSession, _parent(path), [change])
    return report


def replace_assessment(df: DataFrame, path: str, assessment_id: str, name: str = "table") -> WriteReport:
    """Replace one assessment's rows of one table and leave the others alone."""
    report, change = write_fresh_partition(df, path, assessment_id, name)
    commit(df.sparkSession, _parent(path), [change])
    return report
