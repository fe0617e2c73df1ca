"""Cut points: intermediate results written once to shared storage and read back.

A staged frame survives the loss of any executor, is columnar (later readers prune
columns and skip row groups) and carries a real size, so that Catalyst's own
broadcast threshold decides between a broadcast and a shuffled join.
"""

from __future__ import annotations

import atexit
import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured is None:
        configured = spark.sparkContext.getCheckpointDir()
    if configured is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it names it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


class Staging:
    """Writes frames below one unique folder and hands back readers of them."""

    def __init__(
        self, spark: SparkSession, root: str | None = None, *, sweep: bool = False, origins: dict[str, DataFrame] | None = None
    ):
        self.spark = spark
        self.origins = origins  # where given: the frame behind each path
        if sweep:  # the frames outlive the call that made them: deleted when the driver ends
            atexit.register(self._sweep)
        self.root = f"{root or shared_root(spark)}/ringtrail-{uuid.uuid4().hex}"
        self._next = itertools.count()

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{next(self._next):03d}-{name}"
        df.write.parquet(path)
        if self.origins is not None:
            self.origins[path] = df
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete everything staged here; frames handed out before become unreadable."""
        delete(self.spark, self.root)

    def _sweep(self) -> None:
        try:
            self.clear()
        except Exception:  # the session is gone, and with it the way to its folder
            return
