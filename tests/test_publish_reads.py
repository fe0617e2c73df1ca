"""Flat tables and the reads over them."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import START

from ringtrail import schemas
from ringtrail.config import CIRCULAR_FLOW
from ringtrail.operators import findings, publish, quality, reads
from ringtrail.sources.tables import add_missing_columns

RUN_TS = datetime(2024, 1, 1)


def entities_frame(spark, rows):
    return spark.createDataFrame([(*r, "circular_flow_v1") for r in rows], schemas.FINDING_ENTITY)


@pytest.fixture(scope="module")
def layers(spark):
    from pyspark.sql import functions as F

    anchor = spark.createDataFrame([(1, START), (2, START)], "finding_id long, t timestamp_ntz")
    finding = findings.finding_rows(
        anchor,
        CIRCULAR_FLOW,
        RUN_TS,
        severity=F.when(F.col("finding_id") == 1, "HIGH").otherwise("MEDIUM"),
        title=F.lit("t"),
        description=F.lit("d"),
        summary=findings.stats(hops=F.lit(3), currency=F.lit("Yen"), time_span_hours=F.lit(77), amount_min=F.lit(1.5)),
        trigger="t",
    )
    entity = entities_frame(
        spark,
        [
            (1, "Account", "B1:a", "ring_member"),
            (1, "Account", "B2:b", "ring_member"),
            (1, "Account", "B9:gone", "ring_member"),
            (1, "Party", "p1", "account_owner"),
            (1, "Party", "p2", "account_owner"),
            (1, "Party", "p3", "account_owner"),
            (1, "FinancialInstitution", "B1", "custodian_bank"),
            (1, "FinancialInstitution", "B2", "custodian_bank"),
            (2, "Account", "B1:a", "ring_member"),
        ],
    )
    people = [("p1", "Ava", "NL", "MEDIUM"), ("p2", "Mia", "GB", "LOW"), ("p3", "Lucas", "AE", None), ("p0", "Out", "US", "HIGH")]
    party = add_missing_columns(
        spark.createDataFrame(people, "party_id string, name string, country_of_residence string, risk_tier string"),
        schemas.PARTY,
    )
    bank = spark.createDataFrame([("B1", "Zed Bank"), ("B2", "Alpha Bank")], schemas.FINANCIAL_INSTITUTION)
    account = spark.createDataFrame([("B1:a", "B1", "a", None), ("B2:b", "B2", "b", None)], schemas.ACCOUNT)
    owns = spark.createDataFrame(
        [
            ("p1", "B1:a", None, "s"),
            ("p2", "B1:a", "PRIMARY_OWNER", "s"),
            ("p3", "B2:b", None, "s"),
            ("p1", "B2:b", None, "s"),
            ("p0", "B2:b", "PRIMARY_OWNER", "s"),
        ],
        schemas.HAS_ACCOUNT,
    )
    gold_entity = publish.gold_entity(entity, party, bank, account, owns)
    return finding, entity, gold_entity, publish.gold_finding(finding, gold_entity), account


def test_entity_rows(layers):
    rows = {(r["finding_id"], r["entity_id"]): r for r in layers[2].collect()}
    assert len(rows) == 9
    a = rows[(1, "B1:a")]
    # The primary owner beats the smaller party id.
    assert (a["display_name"], a["bank_id"], a["bank_name"], a["owner_party_id"]) == ("B1:a", "B1", "Zed Bank", "p2")
    # p0 would be primary, but is not part of the finding.
    assert rows[(1, "B2:b")]["owner_party_id"] == "p1"
    assert rows[(2, "B1:a")]["owner_party_id"] is None
    assert rows[(1, "B9:gone")]["bank_id"] is None and rows[(1, "B9:gone")]["display_name"] == "B9:gone"
    assert (rows[(1, "p1")]["display_name"], rows[(1, "p1")]["country"], rows[(1, "p1")]["risk_tier"]) == ("Ava", "NL", "MEDIUM")
    assert (rows[(1, "B2")]["display_name"], rows[(1, "B2")]["bank_name"]) == ("Alpha Bank", "Alpha Bank")


def test_finding_rows(layers):
    rows = {r["finding_id"]: r for r in layers[3].collect()}
    one, two = rows[1], rows[2]
    assert (one["party_count"], one["bank_count"], one["country_count"]) == (3, 2, 3)
    assert one["countries"] == ["AE", "GB", "NL"] and one["banks"] == ["Alpha Bank", "Zed Bank"]
    assert (two["party_count"], two["bank_count"], two["country_count"]) == (0, 0, 0)
    assert two["countries"] is None and two["banks"] is None
    assert one["sla_due_date"] == START + timedelta(hours=72) and one["sla_duration"] == timedelta(hours=72)
    assert one["control_eu_amld"] == "Directive 2015/849 Art. 33"
    assert one["hop_count"] == 3 and one["amount_min"] == Decimal("1.5000") and one["time_span_hours"] == 77
    assert layers[3].schema.names == schemas.GOLD_FINDING.names


def test_edge_rows(spark, layers):
    edge = add_missing_columns(
        spark.createDataFrame(
            [(1, 1, "transfers_to", "B1:a", "B9:gone", 7)],
            "finding_id long, hop_order short, edge_type string, from_entity string, to_entity string, fin_txn_id long",
        ),
        schemas.FINDING_EDGE,
    )
    row = publish.gold_edge(edge, layers[4]).first()
    assert (row["from_bank_id"], row["to_bank_id"], row["fin_txn_id"]) == ("B1", None, 7)


def gold(spark, rows):
    frame = spark.createDataFrame(
        rows, "finding_id long, severity string, detected_at timestamp_ntz, finding_type string, currency string, countries array<string>, time_span_hours int"
    )
    return add_missing_columns(frame, schemas.GOLD_FINDING)


def test_list_order_filter_and_limit(spark):
    later = datetime(2024, 6, 1)
    frame = gold(
        spark,
        [
            (1, "LOW", RUN_TS, "X", None, None, None),
            (2, "CRITICAL", RUN_TS, "X", None, None, None),
            (3, "ODD", RUN_TS, "X", None, None, None),
            (4, "HIGH", RUN_TS, "X", None, None, None),
            (5, "HIGH", later, "X", None, None, None),
            (6, "MEDIUM", RUN_TS, "Y", None, None, None),
            (7, "HIGH", RUN_TS, "X", None, None, None),
        ],
    )
    ids = [r["finding_id"] for r in reads.list_findings(frame).collect()]
    assert ids == [2, 5, 4, 7, 6, 1, 3]
    assert [r["finding_id"] for r in reads.list_findings(frame, "HIGH", 2).collect()] == [5, 4]
    assert reads.list_findings(frame).columns == reads.SUMMARY_COLUMNS
    for limit in (0, 501):
        with pytest.raises(ValueError):
            reads.list_findings(frame, limit=limit)
    assert reads.finding_detail(frame, 99).count() == 0 and reads.finding_detail(frame, 3).count() == 1
    sample = {r["finding_type"]: r["ids"] for r in reads.ids_by_type(frame).collect()}
    assert sample == {"X": [1, 2, 3], "Y": [6]}


def test_display(spark):
    frame = gold(
        spark,
        [
            (1, "LOW", RUN_TS, "X", "Saudi Riyal", ["AE", "gb", "ZZ"], 47),
            (2, "LOW", RUN_TS, "X", "Doubloon", None, 60),
            (3, "LOW", RUN_TS, "X", None, ["NL"], None),
            (4, "LOW", RUN_TS, "X", "Euro", [], 48),
            (5, "LOW", RUN_TS, "X", "Euro", [], 59),
        ],
    )
    rows = {r["finding_id"]: r for r in reads.with_display(frame).collect()}
    assert [rows[i]["currency_code"] for i in range(1, 5)] == ["SAR", "Doubloon", "", "EUR"]
    assert rows[1]["country_names"] == ["United Arab Emirates", "United Kingdom", "ZZ"]
    assert [rows[i]["duration"] for i in range(1, 6)] == ["47h", "3d", "—", "2d", "2d"]


def test_graph_export(spark, layers):
    edges = add_missing_columns(
        spark.createDataFrame(
            [(1, 1, "B1:a", "B2:b", Decimal("56544.5000"), "Saudi Riyal"), (1, 2, "B2:b", "B1:a", Decimal("0.0000"), None)],
            "finding_id long, hop_order short, from_account_key string, to_account_key string, amount decimal(20,4), currency string",
        ),
        schemas.GOLD_FINDING_EDGE,
    )
    nodes, links = reads.graph_elements(layers[2], edges)
    node = {r["id"]: r for r in nodes.filter("finding_id = 1").collect()}
    assert node["acc:B1:a"]["label"] == "a" and node["acc:B1:a"]["owner_party_id"] == "p2"
    assert node["party:p1"]["label"] == "Ava" and node["party:p1"]["country"] == "NL"
    assert node["bank:B2"]["type"] == "bank" and node["bank:B2"]["label"] == "Alpha Bank"
    link = {r["id"]: r for r in links.filter("finding_id = 1").collect()}
    assert link["cycle:1"]["label"] == "56,545 Saudi Riyal" and link["cycle:2"]["label"] == ""
    assert (link["held:B1:a"]["source"], link["held:B1:a"]["target"]) == ("acc:B1:a", "bank:B1")
    assert link["owns:p2-B1:a"]["type"] == "hasAccount"
    assert "held:B9:gone" not in link


def test_quality_checks_find_planted_errors(spark, layers):
    finding, entity, _, published, account = layers
    orphan = spark.createDataFrame([(9, "x")], "finding_id long, finding_type string")
    assert [r["finding_id"] for r in quality.findings_without_account(orphan, entity).collect()] == [9]
    assert quality.findings_without_account(finding, entity).count() == 0
    assert [r["finding_type"] for r in quality.unknown_types(orphan).collect()] == ["x"]
    match = quality.counts_match(finding, published).first()
    assert match["matches"] and match["silver_findings"] == 2
    twice = account.unionByName(account.limit(1))
    assert quality.pk_violations(twice, ["account_key"]).count() == 1
    child = spark.createDataFrame([("B1",), ("B7",), ("B7",), (None,)], "bank_id string")
    bad = quality.fk_violations(child, account, [("bank_id", "bank_id")]).collect()
    assert [(r["bank_id"], r["rows"]) for r in bad] == [("B7", 2)]
    nulls = {r["column_name"]: r["nulls"] for r in quality.not_null(account, ["account_key", "currency"]).collect()}
    assert nulls == {"account_key": 0, "currency": 2}
