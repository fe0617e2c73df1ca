"""Hub detection: degree bands, ties, roles, top lists."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import hours, transfer, transfers_frame

from ringtrail.config import MULE_HUB
from ringtrail.operators import mule_hub
from ringtrail.staging import Staging

RUN_TS = datetime(2024, 1, 1)


def star(first_id, hub, n_in, n_out, currency="Euro"):
    rows = [
        transfer(first_id + i, f"B2:{hub}i{i:02d}", f"B1:{hub}", hours(i), 100 + i, currency) for i in range(n_in)
    ]
    rows += [
        transfer(first_id + n_in + i, f"B1:{hub}", f"B3:{hub}o{i:02d}", hours(50 + i), 200 + i, currency)
        for i in range(n_out)
    ]
    return rows


ROWS = (
    star(1000, "h9", 9, 10)
    + star(2000, "h10", 10, 10)
    + star(3000, "h20", 20, 20)
    + star(4000, "h50", 50, 50)
    + star(5000, "h49", 50, 49)
    # Pays itself the largest amount of all: one more counterparty on both sides.
    + star(6000, "self", 9, 9)
    + [transfer(6900, "B1:self", "B1:self", hours(1), 9999)]
    # The same account on both sides, and a tie of two currencies.
    + star(7000, "two", 10, 10)
    + [
        transfer(7900 + i, s, d, hours(2), 5000, "Yen")
        for i, (s, d) in enumerate([("B9:both", "B1:two"), ("B1:two", "B9:both")] * 10)
    ]
)


@pytest.fixture(scope="module")
def hubs(spark, tmp_path_factory):
    stage = Staging(spark, str(tmp_path_factory.mktemp("hubs")))
    transfers = stage(transfers_frame(spark, ROWS), "transfers")
    pairs = stage(mule_hub.pair_totals(transfers), "pairs")
    return transfers, pairs, mule_hub.candidates(mule_hub.hubs(pairs, MULE_HUB, stage), transfers, stage)


def test_bands_and_order(hubs):
    _, _, cands = hubs
    findings = mule_hub.findings(cands, MULE_HUB, RUN_TS).orderBy("finding_id").collect()
    assert [(f["finding_id"], f["title"].split()[2], f["severity"]) for f in findings] == [
        (1, "B1:h50", "CRITICAL"),
        (2, "B1:h49", "HIGH"),
        (3, "B1:h20", "HIGH"),
        (4, "B1:two", "MEDIUM"),
        (5, "B1:h10", "MEDIUM"),
        (6, "B1:self", "MEDIUM"),
    ]
    h10 = findings[4]
    assert h10["title"] == "Mule hub B1:h10 (10 in / 10 out counterparties)"
    assert h10["description"] == (
        "Account B1:h10 received from 10 distinct counterparties and dispersed to 10 distinct "
        "counterparties over 59 hours."
    )
    stats = h10["summary_stats"]
    assert stats["in_amount_total"] == Decimal("1045.0000") and stats["out_amount_total"] == Decimal("2045.0000")
    assert stats["balance_ratio"] == round(2045 / 1045, 4)
    assert (stats["amount_min"], stats["amount_max"]) == (Decimal("1045.0000"), Decimal("2045.0000"))


def test_currency_tie_goes_to_the_smaller_name(hubs):
    _, _, cands = hubs
    row = cands.filter("account_key = 'B1:two'").first()
    assert row["currency"] == "Euro" and row["in_deg"] == 11 and row["in_cnt"] == 20


def test_entities_keep_the_most_telling_role(spark, hubs):
    _, pairs, cands = hubs
    has_account = spark.createDataFrame([("P", "B1:self"), ("P", "B1:two")], "party_id string, account_key string")
    held = spark.createDataFrame([("B1:self", "B1"), ("B1:two", "B1")], "account_key string, fse_id string")
    chosen = cands.filter("account_key in ('B1:self', 'B1:two')")
    rows = mule_hub.entities(chosen, pairs, MULE_HUB, has_account, held).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault((r["finding_id"], r["entity_id"]), []).append(r["role"])
    assert by_id[(6, "B1:self")] == ["mule_hub"]
    assert by_id[(4, "B9:both")] == ["inbound_counterparty"]
    assert by_id[(4, "P")] == ["account_owner"] and by_id[(4, "B1")] == ["custodian_bank"]
    assert sum(r["finding_id"] == 6 for r in rows) == 1 + 1 + 1 + 4 + 4


def test_edges_are_the_largest_per_side(hubs):
    transfers, _, cands = hubs
    edges = mule_hub.edges(cands.filter("account_key = 'B1:h10'"), transfers, MULE_HUB)
    rows = sorted(edges.collect(), key=lambda r: r["hop_order"])
    assert [r["hop_order"] for r in rows] == list(range(1, 11))
    assert [(r["attrs"]["direction"], int(r["attrs"]["amount"])) for r in rows] == [
        *[("inbound", 109 - i) for i in range(5)],
        *[("outbound", 209 - i) for i in range(5)],
    ]


def test_equal_amounts_are_taken_by_id(spark, stage):
    rows = [transfer(i, f"B2:{i}", "B1:x", hours(0), 500) for i in range(20, 0, -1)]
    cands = spark.createDataFrame([(1, "B1:x")], "finding_id long, account_key string")
    edges = mule_hub.edges(cands, transfers_frame(spark, rows), MULE_HUB)
    assert sorted(r["fin_txn_id"] for r in edges.collect()) == [1, 2, 3, 4, 5]


def test_other_columns_are_looked_up_for_the_largest_transfers_alone(hubs, spark, stage):
    """With a stage transfers are ranked by id and amount; the edges are the same, also of an account paying itself."""
    transfers, _, cands = hubs
    staged = {}

    def noted(df, name):
        staged[name] = df
        return stage(df, name)

    plain = mule_hub.edges(cands, transfers, MULE_HUB)
    edges = mule_hub.edges(cands, transfers, MULE_HUB, noted)
    assert edges.dtypes == plain.dtypes
    assert sorted(map(repr, edges.collect())) == sorted(map(repr, plain.collect())) and edges.count() == 60
    assert set(staged["largest-transfers"].columns) == {"finding_id", "inbound", "fin_txn_id", "rank", "hop_order"}
    assert staged["largest-transfers"].count() == 60
