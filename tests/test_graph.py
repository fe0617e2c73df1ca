"""Graph build: ids, banks, accounts, parties, ownership."""

import random

from conftest import accounts_frame, hours, raw, raw_frame

from ringtrail import constants as K
from ringtrail.functions.ranking import global_rank
from ringtrail.operators import graph

LEDGER = [
    ("First Bank", "001", "A1", "E1", "Acme"),
    ("First Bank", "001", "A2", "E1", "Zeta"),
    ("Other name", "001", "A3", "E2", "Solo"),
    # An entity that carries the id of a synthesized party.
    ("Second Bank", "002", "B7", "003:C9", "Real owner"),
]


def test_nodes_and_ownership(spark, stage):
    txns = raw_frame(spark, [raw(hours(0), "001:A1", "003:C9", 10), raw(hours(1), "003:C9", "003:C9", 20)])
    ledger = accounts_frame(spark, LEDGER)
    seen = stage(graph.transaction_accounts(txns), "seen")
    banks = {r["fse_id"]: r["name"] for r in graph.financial_institutions(seen, ledger).collect()}
    assert banks == {"001": "Other name", "002": "Second Bank", "003": "Bank 003"}

    accounts = graph.account_nodes(seen, ledger)
    assert sorted(r["account_key"] for r in accounts.collect()) == ["001:A1", "001:A2", "001:A3", "002:B7", "003:C9"]
    assert sorted((r[0], r[1]) for r in graph.is_held_at(accounts).collect())[0] == ("001:A1", "001")

    parties = {r["party_id"]: r for r in graph.parties(seen, ledger).collect()}
    assert {p: r["name"] for p, r in parties.items()} == {
        "E1": "Acme",
        "E2": "Solo",
        "003:C9": "Real owner",
        "001:A1": "001:A1",
    }
    assert parties["003:C9"]["record_source"] == K.ACCOUNTS_SOURCE
    assert parties["001:A1"]["record_source"] == K.SYNTHESIZED_SOURCE
    assert parties["E1"]["country_of_residence"] is None

    owns = sorted((r["party_id"], r["account_key"]) for r in graph.has_account(seen, ledger).collect())
    assert owns == [
        ("001:A1", "001:A1"),
        ("003:C9", "002:B7"),
        ("003:C9", "003:C9"),
        ("E1", "001:A1"),
        ("E1", "001:A2"),
        ("E2", "001:A3"),
    ]


def numbered_ids(spark, stage, rows):
    txns = stage(raw_frame(spark, rows).repartition(5), "raw")
    return graph.number_transactions(txns, stage)


def test_ids_follow_the_sort_order_for_any_partition_count(spark, stage):
    rng = random.Random(3)
    rows = [
        raw(hours(rng.randrange(6)), f"0{rng.randrange(3)}:{rng.randrange(4)}", "09:x", rng.randrange(1, 5))
        for _ in range(600)
    ]
    # A third of all rows are copies of one row.
    rows += [raw(hours(3), "01:1", "09:x", 2)] * 300
    expected = sorted((r[0], *r[1:5], r[7]) for r in rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = sorted(numbered_ids(spark, stage, rows).collect(), key=lambda r: r["fin_txn_id"])
            assert [r["fin_txn_id"] for r in got] == list(range(1, len(rows) + 1))
            keys = [
                (r["event_timestamp"], r["from_bank"], r["from_account"], r["to_bank"], r["to_account"], r["amount_paid"])
                for r in got
            ]
            assert keys == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_of_one_row_spread_over_the_sort(spark, stage):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        txns = stage(raw_frame(spark, [raw(hours(1), "01:1", "02:2", 5)] * 4000).repartition(4), "raw")
        ids = graph.number_transactions(txns, stage)
        per_file = ids.selectExpr("input_file_name() as f").groupBy("f").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(per_file) == 4 and max(r["count"] for r in per_file) < 2000


def test_rank_of_nothing_and_start(spark, stage):
    empty = spark.createDataFrame([], "a int")
    assert global_rank(empty, ["a"], "id", stage).count() == 0
    three = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    ranked = global_rank(three, ["a"], "id", stage, start=10)
    assert sorted(map(tuple, ranked.collect())) == [(11, 1), (12, 2), (13, 3)]


def test_label_never_enters_the_graph(spark, stage):
    numbered = numbered_ids(spark, stage, [raw(hours(0), "01:1", "02:2", 5, label=1)])
    tables = [
        graph.financial_transactions(numbered),
        graph.originating(numbered),
        graph.beneficiary(numbered),
        graph.transfers_to(numbered),
    ]
    assert all("is_laundering" not in t.columns for t in tables)
    assert graph.txn_labels(numbered).first()["is_laundering"] == 1
