"""Times the pipeline stage by stage, from CSV files to published findings, and the reads.

Prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the input and the local cores.
The CSV files are derived from the test tables before the clock starts. The same run is timed
twice: cold, right after the session began, and warm, as in a long-running cluster session.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from ringtrail.plans.pipeline import Pipeline
from ringtrail.operators import evaluate, reads
from ringtrail.session import local_session
from ringtrail.sources import fixtures

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(spark, sf_dir: str, work: str) -> dict[str, float]:
    csv_dir = f"{work}/csv"
    fixtures.write_csv(spark, sf_dir, csv_dir)
    p = Pipeline(spark, f"{work}/tables")
    seconds: dict[str, float] = {}

    def timed(name, job):
        started = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - started, 3)

    timed("bronze_load", lambda: p.load_csv(csv_dir))
    timed("silver_transform", p.build_silver)
    timed("save_config", p.save_config)
    timed("circular_flow", p.detect_circular_flow)
    timed("mule_hub", p.detect_mule_hub)
    timed("laundering_exposure", p.detect_exposure)
    timed("gold_publish", p.publish)
    timed("list_findings", lambda: reads.list_findings(p.table("gold/finding")).collect())
    timed("finding_detail", lambda: reads.finding_detail(p.table("gold/finding"), 1).collect())
    graph = reads.finding_graph(p.table("gold/finding_entity"), p.table("gold/finding_edge"), 1)
    timed("finding_graph", lambda: [part.collect() for part in graph])
    timed(
        "eval_precision",
        lambda: evaluate.precision(p.table("silver/finding_edge"), p.table("label/txn_label")).collect(),
    )
    return seconds


def main() -> None:
    spark = local_session(CPUS, "ringtrail-bench")
    with tempfile.TemporaryDirectory(prefix="ringtrail-bench-", ignore_cleanup_errors=True) as work:
        cold = run(spark, SF_DIR, f"{work}/cold")
        seconds = run(spark, SF_DIR, f"{work}/run")
        spark.stop()
    result = {
        "metric": "pipeline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": SF_DIR.rsplit("sf", 1)[-1],
    }
    sys.stdout.write(json.dumps(result) + "\n")


if __name__ == "__main__":
    main()
