"""One pipeline run over the shared test tables, built step by step as queries need it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail.plans.pipeline import Pipeline
from ringtrail.sources import fixtures
from ringtrail.staging import Staging

SOURCE_TABLES = ["orders", "lineitem", "customer", "nation"]
# Detection time of the catalogue's runs; never part of a compared result.
RUN_TS = datetime(2024, 1, 1)

# step -> step it builds on. Detectors follow each other because finding ids continue.
STEPS = {
    "bronze": None,
    "silver": "bronze",
    "config": "silver",
    "circular_flow": "config",
    "mule_hub": "circular_flow",
    "exposure": "mule_hub",
    "gold": "exposure",
}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.stage = Staging(spark, sweep=True)
        self.pipeline = Pipeline(spark, self.stage.root, run_ts=RUN_TS, keep_scratch=True, origins={})
        self._done: set[str] = set()

    def _run(self, step: str) -> None:
        p = self.pipeline
        if step == "bronze":
            fixtures.write_csv(self.spark, self.sf_dir, f"{p.root}/csv")
            p.load_csv(f"{p.root}/csv")
        else:
            {
                "silver": p.build_silver,
                "config": p.save_config,
                "circular_flow": p.detect_circular_flow,
                "mule_hub": p.detect_mule_hub,
                "exposure": p.detect_exposure,
                "gold": p.publish,
            }[step]()

    def after(self, step: str) -> Workspace:
        """This workspace with `step` and everything before it done."""
        if step not in self._done:
            if STEPS[step] is not None:
                self.after(STEPS[step])
            self._run(step)
            self._done.add(step)
        return self

    def close(self) -> None:
        """Delete all tables of this workspace; also done when the driver ends."""
        self.stage.clear()
        for key in [k for k, w in _workspaces.items() if w is self]:
            del _workspaces[key]

    def stored(self, name: str) -> DataFrame:
        """A table with the columns its files have, not those it should have."""
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.pipeline.root}/{name}")

    def table(self, name: str) -> DataFrame:
        return self.pipeline.table(name)

    def frame(self, name: str) -> DataFrame:
        return self.pipeline.frames[name]


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """File count, bytes and newest change of the source tables, from listings alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = files.load([f"{sf_dir}/{t}.parquet" for t in SOURCE_TABLES]).select("length", "modificationTime")
    return tuple(listed.agg(F.count("length"), F.sum("length"), F.max("modificationTime")).first())


_workspaces: dict[tuple, Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of this application and these exact input files."""
    key = (spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir))
    if key not in _workspaces:
        _workspaces[key] = Workspace(spark, sf_dir)
    return _workspaces[key]
