"""Whole runs: repeatability, label blindness, one shape, evaluation."""

from dataclasses import replace
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F
from conftest import SMALL, accounts_frame, hours, raw, raw_frame

from ringtrail import constants as K
from ringtrail import schemas
from ringtrail.config import ASSESSMENTS, CIRCULAR_FLOW
from ringtrail.operators import circular_flow, evaluate, exposure, findings, mule_hub
from ringtrail.plans import catalogue, oracle
from ringtrail.plans.pipeline import Pipeline
from ringtrail.sources import csv_files, fixtures
from ringtrail.sources.tables import overwrite_table

RUN_TS = datetime(2024, 1, 1)
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    p = Pipeline(spark, str(tmp_path_factory.mktemp("pipeline")), run_ts=RUN_TS, keep_scratch=True)
    p.load_frames(fixtures.derived_transactions(spark, SMALL), fixtures.derived_accounts(spark, SMALL))
    p.build_silver()
    p.run_detectors()
    p.publish()
    return p


def test_expected_findings(done):
    rows = findings.severity_breakdown(done.table("silver/finding")).collect()
    assert [tuple(r) for r in rows] == [
        ("CIRCULAR_FLOW", "HIGH", 6),
        ("CIRCULAR_FLOW", "MEDIUM", 30),
        ("LAUNDERING_EXPOSURE", "HIGH", 1),
        ("MULE_HUB", "CRITICAL", 7),
        ("MULE_HUB", "HIGH", 90),
        ("MULE_HUB", "MEDIUM", 14),
    ]
    only = findings.severity_breakdown(done.table("silver/finding"), K.MULE_HUB).collect()
    assert [r["findings"] for r in only] == [7, 90, 14]


def test_ids_continue_from_detector_to_detector(done):
    ids = {}
    for r in done.table("silver/finding").select("assessment_id", "finding_id").collect():
        ids.setdefault(r["assessment_id"], []).append(r["finding_id"])
    assert {a: (min(i), max(i)) for a, i in ids.items()} == {
        K.CIRCULAR_FLOW: (1, 36),
        K.MULE_HUB: (37, 147),
        K.LAUNDERING_EXPOSURE: (148, 148),
    }
    assert sum(map(len, ids.values())) == 148


def snapshot(p, *layers):
    """Contents of all tables of the layers, without the times a run stamps on them."""
    names = [n for n in schemas.TABLES if n.startswith(layers)]
    return {n: sorted(map(repr, p.table(n).drop("detected_at", "created_at").collect())) for n in names}


def test_one_detector_again_keeps_the_others(done):
    before = snapshot(done, "silver/finding")
    done.detect_mule_hub()
    after = snapshot(done, "silver/finding")
    # Ids continue behind all others, here the one exposure finding; nothing else moves.
    assert {n: len(rows) for n, rows in after.items()} == {n: len(rows) for n, rows in before.items()}
    ids = [r["finding_id"] for r in done.table("silver/finding").filter("finding_type = 'MULE_HUB'").collect()]
    assert (min(ids), max(ids)) == (149, 259)
    done.run_detectors()
    assert snapshot(done, "silver/finding") == before


def test_tables_have_their_declared_types(done):
    for name, schema in schemas.TABLES.items():
        assert done.table(name).schema.simpleString() == schema.simpleString()


def analyzed(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_graph_detectors_never_see_the_label(done):
    """Neither their input nor any plan below their output names the label."""
    transfers = done.table("silver/transfers_to")
    assert "is_laundering" not in analyzed(transfers)
    cfg = ASSESSMENTS[K.CIRCULAR_FLOW]
    hops = circular_flow.ring_transfers(transfers, cfg)
    steps = [circular_flow.hung_links(circular_flow.as_links(hops), circular_flow.activity(circular_flow.as_links(hops))), mule_hub.pair_totals(transfers), done.frames["rings"], done.frames["hubs"]]
    assert all("is_laundering" not in analyzed(step) for step in steps)


def test_all_detectors_write_one_shape(done):
    run = (RUN_TS,)
    shapes = [
        circular_flow.findings(done.frames["rings"], ASSESSMENTS[K.CIRCULAR_FLOW], *run),
        mule_hub.findings(done.frames["hubs"], ASSESSMENTS[K.MULE_HUB], *run),
        exposure.findings(done.frames["exposed"], ASSESSMENTS[K.LAUNDERING_EXPOSURE], *run),
    ]
    assert {s.schema.simpleString() for s in shapes} == {schemas.FINDING.simpleString()}


def test_precision_of_exposure_is_complete(done):
    rows = {r["detector"]: r for r in evaluate.precision(done.table("silver/finding_edge"), done.table("label/txn_label")).collect()}
    assert rows["laundering_exposure"]["precision_pct"] == 100.0
    overlap = evaluate.ring_overlap(done.table("silver/finding_edge"), done.table("label/txn_label")).first()
    assert (overlap["rings"], overlap["strict_all_labeled"], overlap["loose_any_labeled"]) == (36, 20, 30)


def test_plans_have_no_cross_join_or_one_task_window(done):
    cfg = ASSESSMENTS[K.CIRCULAR_FLOW]
    hops = circular_flow.ring_transfers(done.table("silver/transfers_to"), cfg)
    hung = circular_flow.hung_links(circular_flow.as_links(hops), circular_flow.activity(circular_flow.as_links(hops)))
    plans = [
        hung,
        circular_flow.link_triangles(hung, cfg),
        mule_hub.pair_totals(done.table("silver/transfers_to")),
        mule_hub.edges(done.frames["hubs"], done.table("silver/transfers_to"), ASSESSMENTS[K.MULE_HUB]),
    ]
    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text and "SinglePartition" not in text
    assert "WindowGroupLimit" in text


def test_every_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    sql = oracle.oracle_sql()
    queries = catalogue.queries()
    assert set(sql) == set(queries)
    wrong = []
    for name, query in queries.items():
        df = query(spark, SMALL)
        columns = sorted(df.columns)
        got = sorted(repr([r[c] for c in columns]) for r in df.collect())
        answer = con.execute(sql[name])
        order = [d[0] for d in answer.description]
        expected = sorted(repr([r[order.index(c)] for c in columns]) for r in answer.fetchall()) if set(order) == set(columns) else None
        if got != expected:
            wrong.append(name)
    assert wrong == []


def test_command_line_from_csv_to_reads(spark, done, tmp_path, capfd):
    from ringtrail.__main__ import main

    data, root = tmp_path / "drop", str(tmp_path / "root")
    options = {"header": True, "timestampNTZFormat": csv_files.TIMESTAMP_FORMAT}
    fixtures.derived_transactions(spark, SMALL).write.options(**options).csv(f"{data}/{csv_files.TRANSACTIONS_FILE}")
    fixtures.derived_accounts(spark, SMALL).write.options(**options).csv(f"{data}/{csv_files.ACCOUNTS_FILE}")

    main(["run", "--root", root, "--data", str(data)])
    assert "[bronze/transactions_raw] 6,180 rows" in capfd.readouterr().out
    # A second run from other files of the same rows gives the same tables.
    again = Pipeline(spark, root)
    assert snapshot(again, "silver/", "gold/", "label/") == snapshot(done, "silver/", "gold/", "label/")
    main(["load", "--root", root, "--data", str(data), "--only", "accounts"])
    out = capfd.readouterr().out
    assert "[bronze/accounts_raw] 50 rows" in out and "transactions_raw" not in out
    main(["list", "--root", root, "--severity", "HIGH", "--limit", "3"])
    assert capfd.readouterr().out.count("\tHIGH\t") == 3
    main(["show", "--root", root, "1"])
    assert "ring_member" in capfd.readouterr().out
    with pytest.raises(SystemExit, match="not found"):
        main(["show", "--root", root, "100000"])
    main(["breakdown", "--root", root])
    before = spark.read.parquet(f"{root}/silver/finding").count()
    route = ["B90:x", "B90:y", "B91:z", "B90:x"]
    ring = [raw(hours(k), a, b, 2000) for k, (a, b) in enumerate(zip(route, route[1:], strict=False))]
    options = {"header": True, "timestampNTZFormat": "yyyy/MM/dd HH:mm"}
    raw_frame(spark, ring).write.options(**options).csv(str(tmp_path / "next" / csv_files.TRANSACTIONS_FILE))
    main(["append", "--root", root, "--data", str(tmp_path / "next")])
    assert spark.read.parquet(f"{root}/silver/finding").count() == before + 1
    assert "MULE_HUB" in capfd.readouterr().out
    # A finding with very many entities is shown whole.
    wide = again.table("gold/finding_entity").filter("finding_id = 1").limit(1)
    wide = wide.withColumn("entity_id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(1500)), lambda n: F.format_string("N%05d", n))))
    overwrite_table(wide, f"{root}/gold/finding_entity")
    main(["show", "--root", root, "1"])
    shown = capfd.readouterr().out
    assert all(f"N{n:05d}" in shown for n in range(1, 1501))


def test_a_single_detector_leaves_no_broken_reference(spark, done, tmp_path):
    """On a root without assessments a detector saves them first."""
    p = Pipeline(spark, str(tmp_path), run_ts=RUN_TS)
    p.load_frames(done.table("bronze/transactions_raw"), done.table("bronze/accounts_raw"))
    p.build_silver()
    p.detect_exposure()
    config = p.table("silver/assessment_config").select("assessment_id")
    assert p.table("silver/finding").join(config, "assessment_id", "left_anti").count() == 0
    assert p.table("silver/finding").count() > 0


def test_scratch_is_gone_after_a_failed_step(spark, done, tmp_path, monkeypatch):
    p = Pipeline(spark, str(tmp_path), run_ts=RUN_TS)
    p.load_frames(done.table("bronze/transactions_raw"), done.table("bronze/accounts_raw"))
    p.build_silver()

    def fail(*_, **__):
        raise RuntimeError("stopped")

    monkeypatch.setattr(exposure, "candidates", fail)
    with pytest.raises(RuntimeError, match="stopped"):
        p.detect_exposure()
    assert not list((tmp_path / "_scratch").glob("*"))


def test_point_reads_skip_files(spark, done):
    """Gold is ordered by finding, so that the files' ranges of ids hardly overlap."""
    rows = done.table("gold/finding_edge").select("finding_id", F.input_file_name().alias("file"))
    spans = rows.groupBy("file").agg(F.min("finding_id").alias("a"), F.max("finding_id").alias("b")).orderBy("a").collect()
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:], strict=False))


def test_label_check_sees_stored_columns(spark, tmp_path):
    """A label column in the files is found, though the declared schema lacks it."""
    from ringtrail.operators.quality import columns_named
    from ringtrail.sources.tables import read_table

    path = str(tmp_path / "account")
    spark.range(2).selectExpr("cast(id as string) account_key", "1 as is_laundering").write.parquet(path)
    assert columns_named({"a": read_table(spark, path, schemas.ACCOUNT)}, "is_laundering") == {}
    assert columns_named({"a": spark.read.parquet(path)}, "is_laundering") == {"a": ["is_laundering"]}


def test_evaluation_without_hits_or_labels(spark, done):
    edges = done.table("silver/finding_edge").filter("finding_type = 'MULE_HUB'" if "finding_type" in done.table("silver/finding_edge").columns else "assessment_id like 'mule%'")
    labels = done.table("label/txn_label")
    none = labels.withColumn("is_laundering", F.lit(0).cast("short"))
    got = {r["detector"]: r for r in evaluate.recall(edges, none).collect()}
    assert set(got) == {"circular_flow", "mule_hub", "laundering_exposure", "graph_native"}
    assert all(r["labeled_captured"] == 0 and r["recall_pct"] is None for r in got.values())
    assert [r["lift"] for r in evaluate.lift(edges, none).collect()] == [None]
    assert evaluate.base_rate(labels.limit(0)).first()["base_rate"] is None


def test_a_pipeline_configured_for_four_hops(spark, tmp_path):
    """The configuration row decides the shape of a ring, from detection to the published tables."""
    four = replace(CIRCULAR_FLOW, params=CIRCULAR_FLOW.params | {"hops": 4})
    p = Pipeline(spark, str(tmp_path), run_ts=RUN_TS, assessments=ASSESSMENTS | {K.CIRCULAR_FLOW: four})
    route = ["B1:p", "B1:q", "B2:r", "B2:s", "B1:p"]
    rows = [raw(hours(k), a, b, 2000) for k, (a, b) in enumerate(zip(route, route[1:], strict=False))]
    rows += [raw(hours(9), "B1:q", "B1:p", 2000), raw(hours(10), "B2:r", "B1:p", 2000)]  # rings of two and three hops
    p.load_frames(raw_frame(spark, rows), accounts_frame(spark, [("One", "B1", "p", "E1", "Entity 1")]))
    p.build_silver()
    p.detect_circular_flow()
    p.publish()
    (found,) = p.table("gold/finding").collect()
    assert found["hop_count"] == 4 and found["title"].startswith("4-hop circular fund flow: B1:p -> B1:q -> B2:r -> B2:s")
    edges = sorted(p.table("gold/finding_edge").collect(), key=lambda r: r["hop_order"])
    assert [(e["from_account_key"], e["to_account_key"]) for e in edges] == list(zip(route, route[1:], strict=False))
    assert p.table("silver/assessment_config").where("finding_config.hops = 4").count() == 1


def test_appending_a_load_closes_its_rings(spark, tmp_path):
    """Two loads give the graph, the rings and the published findings of one, with ids that go on."""
    txns, accounts = fixtures.derived_transactions(spark, SMALL), fixtures.derived_accounts(spark, SMALL)
    day = F.lit("1996-06-01").cast("timestamp_ntz")
    # The second load also brings some earlier transfers.
    late = (F.col("event_timestamp") >= day) | (F.col("from_account") == "7")
    whole, parts = (Pipeline(spark, str(tmp_path / name), run_ts=RUN_TS) for name in ("whole", "parts"))
    whole.load_frames(txns, accounts)
    parts.load_frames(txns.where(~late), accounts)
    for p in (whole, parts):
        p.build_silver()
        p.detect_circular_flow()
        p.detect_mule_hub()
    first = {r["finding_id"] for r in parts.table("silver/finding").collect()}
    middle = parts.table("silver/transfers_to").count() + 40
    rest = txns.where(late).orderBy("event_timestamp", "from_account", "to_account", "amount_paid")
    rest = rest.withColumn("k", F.monotonically_increasing_id()).checkpoint()
    for part in (rest.where(F.col("k") < 40), rest.where(F.col("k") >= 40)):
        parts.append_frames(part.drop("k"))
    assert parts.table("silver/transfers_to").count() == whole.table("silver/transfers_to").count() > middle

    def rows(p, name, *columns):
        return sorted(map(repr, p.table(name).select(*columns).collect()))

    same = {
        "bronze/transactions_raw": schemas.TRANSACTIONS_RAW.names,
        "silver/transfers_to": ["from_account_key", "to_account_key", "event_timestamp", "amount", "currency", "payment_format"],
        "silver/account": ["*"], "silver/party": ["*"], "silver/has_account": ["*"], "silver/financial_institution": ["*"],
    }
    for name, columns in same.items():
        assert rows(parts, name, *columns) == rows(whole, name, *columns), name
    txn_ids = [r[0] for r in parts.table("silver/transfers_to").select("fin_txn_id").collect()]
    assert sorted(txn_ids) == list(range(1, len(txn_ids) + 1))

    def rings(p):
        found = p.table("silver/finding").where(F.col("assessment_id") == K.CIRCULAR_FLOW)
        return sorted(r["title"] + str(r["sla_trigger_date"]) + str(r["summary_stats"]) for r in found.collect())

    assert rings(parts) == rings(whole) and len(rings(whole)) > 20
    ids = [r["finding_id"] for r in parts.table("silver/finding").collect()]
    assert len(ids) == len(set(ids)) and first < set(ids) and min(set(ids) - first) > max(first)
    parts.publish()
    edges = parts.table("gold/finding_edge").join(parts.table("silver/finding").where(F.col("assessment_id") == K.CIRCULAR_FLOW), "finding_id")
    assert edges.count() == 3 * len(rings(whole))
    # A full refresh starts anew.
    parts.build_silver()
    assert not (tmp_path / "parts" / "silver" / "link_summary").exists()
    assert parts.table("silver/transfers_to").count() == len(txn_ids)
