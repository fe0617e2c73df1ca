"""Command line: run pipeline steps on a table root, or read published findings.

    spark-submit ... -m ringtrail run   --root s3a://lake/aml --data s3a://drop/hi-small
    spark-submit ... -m ringtrail append --root ROOT --data s3a://drop/next
    spark-submit ... -m ringtrail step  --root ROOT silver
    spark-submit ... -m ringtrail list  --root ROOT --severity HIGH --limit 20
    spark-submit ... -m ringtrail show  --root ROOT 81
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ringtrail.operators import reads
from ringtrail.operators.findings import severity_breakdown
from ringtrail.plans.pipeline import Pipeline
from ringtrail.session import ENGINE_CONF


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="ringtrail")
    commands = ap.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the layer tables")
        return sub

    run = command("run", "everything from CSV to published findings")
    run.add_argument("--data", required=True, help="folder of the two CSV files")
    load = command("load", "mirror the CSV files")
    load.add_argument("--data", required=True)
    load.add_argument("--only", choices=["trans", "accounts"])
    append = command("append", "add a further drop to the stored ones, with the rings it closes")
    append.add_argument("--data", required=True)
    step = command("step", "one later step")
    step.add_argument("step", choices=["silver", "circular_flow", "mule_hub", "exposure", "detectors", "publish"])
    listing = command("list", "most severe findings first")
    listing.add_argument("--severity")
    listing.add_argument("--limit", type=int, default=50)
    show = command("show", "one finding with its entities and edges")
    show.add_argument("finding_id", type=int)
    command("breakdown", "findings by type and severity")
    return ap


def print_rows(df: DataFrame) -> None:
    """All rows, tab-separated below their names; fetched one partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"ringtrail-{args.command}")
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    p = Pipeline(spark, args.root)

    if args.command == "run":
        p.run(args.data)
    elif args.command == "load":
        p.load_csv(args.data, args.only)
    elif args.command == "append":
        p.append_csv(args.data)
    elif args.command == "step":
        {
            "silver": p.build_silver,
            "circular_flow": p.detect_circular_flow,
            "mule_hub": p.detect_mule_hub,
            "exposure": p.detect_exposure,
            "detectors": p.run_detectors,
            "publish": p.publish,
        }[args.step]()
    elif args.command == "list":
        print_rows(reads.list_findings(p.table("gold/finding"), args.severity, args.limit))
    elif args.command == "breakdown":
        print_rows(severity_breakdown(p.table("silver/finding")))
    elif args.command == "show":
        detail = reads.finding_detail(p.table("gold/finding"), args.finding_id)
        if detail.isEmpty():
            raise SystemExit(f"finding {args.finding_id} not found")
        detail.show(truncate=False, vertical=True)
        for part in reads.finding_graph(p.table("gold/finding_entity"), p.table("gold/finding_edge"), args.finding_id):
            print_rows(part)
    for report in p.reports:
        print(report)


if __name__ == "__main__":
    main()
