"""Label exposure: bands, self-transfers, copies of labelled rows."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import hours, raw, raw_frame

from ringtrail.config import LAUNDERING_EXPOSURE
from ringtrail.operators import exposure, graph
from ringtrail.staging import Staging

RUN_TS = datetime(2024, 1, 1)


def touches(account, n, first=0, label=1):
    return [raw(hours(first + i), f"B1:{account}", f"B2:{account}c{i}", 100 + i, label=label) for i in range(n)]


ROWS = (
    touches("e19", 19)
    + touches("e20", 20)
    + touches("e30", 30)
    + touches("e50", 50)
    + touches("clean", 60, label=0)
    # Ten self-transfers touch the account twice each.
    + [raw(hours(i), "B1:selfish", "B1:selfish", 50, label=1) for i in range(10)]
    # Two labelled and one clean copy: three transfers, each matching two labelled rows.
    + [raw(hours(1), "B1:copied", "B2:target", 70, label=flag) for flag in (1, 1, 0)]
    + touches("copied", 14, first=5)
)


@pytest.fixture(scope="module")
def exposed(spark, tmp_path_factory):
    stage = Staging(spark, str(tmp_path_factory.mktemp("exposure")))
    txns = stage(raw_frame(spark, ROWS), "raw")
    transfers = stage(graph.transfers_to(graph.number_transactions(txns, stage)), "transfers")
    labeled = exposure.labeled_edges(transfers, txns, stage)
    return labeled, exposure.candidates(labeled, LAUNDERING_EXPOSURE, stage)


def test_bands(exposed):
    _, cands = exposed
    rows = exposure.findings(cands, LAUNDERING_EXPOSURE, RUN_TS).orderBy("finding_id").collect()
    assert [(r["title"].split()[2], r["severity"]) for r in rows] == [
        ("B1:e50", "CRITICAL"),
        ("B1:e30", "HIGH"),
        ("B1:copied", "MEDIUM"),
        ("B1:e20", "MEDIUM"),
        ("B1:selfish", "MEDIUM"),
    ]
    assert rows[3]["title"] == "Labeled exposure: B1:e20 (20 labeled transfers)"
    assert rows[3]["description"].startswith("Account B1:e20 participates in 20 transactions flagged IsLaundering=1")


def test_self_transfers_count_twice(exposed):
    _, cands = exposed
    row = cands.filter("account_key = 'B1:selfish'").first()
    assert (row["labeled_edges"], row["distinct_labeled_txns"]) == (20, 10)
    assert row["labeled_amount_total"] == Decimal("1000.0000")


def test_copies_are_counted_not_emitted(exposed):
    labeled, cands = exposed
    copies = labeled.filter("to_account_key = 'B2:target'").collect()
    assert [r["copies"] for r in copies] == [2, 2, 2]
    row = cands.filter("account_key = 'B1:copied'").first()
    # Three transfers matching two labelled rows each are six labelled edges.
    assert (row["labeled_edges"], row["distinct_labeled_txns"]) == (14 + 6, 14 + 3)
    assert row["labeled_amount_total"] == sum(range(100, 114)) + 6 * 70


def test_copies_fill_places_among_the_largest(spark, exposed):
    labeled, cands = exposed
    only = labeled.filter("to_account_key = 'B2:target'")
    anchor = cands.filter("account_key = 'B1:copied'")
    rows = sorted(exposure.edges(anchor, only, LAUNDERING_EXPOSURE).collect(), key=lambda r: r["hop_order"])
    assert len(rows) == 5 and len({r["fin_txn_id"] for r in rows}) == 3
    assert all(r["attrs"]["is_laundering"] for r in rows)


def test_entities(spark, exposed):
    labeled, cands = exposed
    empty = spark.createDataFrame([], "party_id string, account_key string")
    held = spark.createDataFrame([("B1:e20", "B1")], "account_key string, fse_id string")
    rows = exposure.entities(cands.filter("account_key = 'B1:e20'"), labeled, LAUNDERING_EXPOSURE, empty, held)
    assert sorted((r["entity_id"], r["role"]) for r in rows.collect()) == [
        ("B1", "custodian_bank"),
        ("B1:e20", "exposed_account"),
        ("B2:e20c17", "outbound_counterparty"),
        ("B2:e20c18", "outbound_counterparty"),
        ("B2:e20c19", "outbound_counterparty"),
    ]
