"""Session settings the jobs are written for."""

from __future__ import annotations

import atexit
import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning does the heavy lifting: it coalesces small shuffle partitions,
# splits skewed join partitions and turns joins into broadcasts once sizes are known.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where a following aggregation then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Prefer hashing to sorting when every partition of a side is known to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Compressed columns are several times larger in memory than on disk.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Stored and staged tables are most of what a run writes.
    "spark.sql.parquet.compression.codec": "zstd",
}


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the above in a running session, except what its owner configured."""
    configured = spark.sparkContext.getConf()
    for key, value in ENGINE_CONF.items():
        if not configured.contains(key):
            spark.conf.set(key, value)


def ensure_scratch(spark: SparkSession) -> None:
    """Give a session without spark.checkpoint.dir a temporary folder, as tests need one.

    A folder of one machine is of no use to a cluster, whose owner has to name a shared one.
    """
    if spark.sparkContext.getConf().contains("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir():
        return
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.TemporaryDirectory(prefix="ringtrail-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    spark.sparkContext.setCheckpointDir(folder.name)


def local_session(cpus: str = "8", app: str = "ringtrail", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**ENGINE_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_scratch(spark)
    return spark
