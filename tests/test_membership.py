"""Rows without a partner stay out of shuffles; the results do not change."""

import random

from conftest import hours, raw, raw_frame, transfer, transfers_frame
from pyspark.sql import functions as F
from test_circular_flow import brute_force

from ringtrail.config import CIRCULAR_FLOW
from ringtrail.functions import membership
from ringtrail.operators import appended_rings, circular_flow, exposure, graph, mule_hub


class Named:
    """A staging that knows what was stored."""

    def __init__(self, stage):
        self.stage, self.frames = stage, []

    def __call__(self, df, name):
        self.frames.append(name)
        return self.stage(df, name)


def _kept(spark, stage, rows, known):
    left = spark.createDataFrame(rows, "a string, b bigint")
    right = stage(spark.createDataFrame(known, "a string, b bigint"), "known")
    key = F.struct("a", "b")
    return {tuple(r) for r in membership.may_occur(left, [key], right, key, stage).collect()}


def test_partners_stay_and_most_others_go(spark, stage):
    rows = [(f"k{n}", n) for n in range(2000)] + [(None, 5), ("k5", None)]
    known = [(f"k{n}", n) for n in range(0, 2000, 20)] + [(None, 5), (None, 5)]
    kept = _kept(spark, stage, rows, known)
    assert set(known) <= kept and len(kept) < 300
    assert _kept(spark, stage, rows, []) == set()


def test_a_full_field_keeps_all(spark, stage, monkeypatch):
    monkeypatch.setattr(membership, "MAX_CELLS", 50)
    rows = [(f"k{n}", n) for n in range(200)]
    assert _kept(spark, stage, rows, rows[:60]) == set(rows)


def test_several_keys_must_all_occur(spark, stage):
    rows = spark.createDataFrame([(a, b) for a in range(30) for b in range(30)], "a bigint, b bigint")
    known = stage(spark.range(3), "known")
    kept = membership.may_occur(rows, [F.col("a"), F.col("b")], known, F.col("id"), stage)
    assert kept.columns == ["a", "b"]
    assert {(a, b) for a in range(3) for b in range(3)} <= {tuple(r) for r in kept.collect()}
    assert kept.count() < 30


def test_transfers_without_a_labelled_row_are_not_shuffled(spark, stage):
    """Broadcasts off, as for many labelled rows: the join sees few of the transfers."""
    rows = [raw(hours(n), f"B:{n}", f"B:{n + 1}", 100 + n, label=int(n % 100 == 0)) for n in range(1000)]
    txns = stage(raw_frame(spark, rows), "raw")
    transfers = stage(graph.transfers_to(graph.number_transactions(txns, stage)), "transfers")
    named = Named(stage)
    found = exposure.labeled_edges(transfers, txns, named)
    assert "key-cells" in named.frames
    assert {r["from_account_key"] for r in found.collect()} == {f"B:{n}" for n in range(0, 1000, 100)}


def _random_transfers(seed):
    rng = random.Random(seed)
    return [
        transfer(n, f"B:{rng.randrange(12)}", f"B:{rng.randrange(12)}", hours(rng.randrange(1200)), rng.randrange(900, 3000))
        for n in range(1, 400)
    ]


def test_rings_come_from_links_that_may_close(spark, stage):
    rows = _random_transfers(3)
    named = Named(stage)
    rings = circular_flow.cycles(stage(transfers_frame(spark, rows), "transfers"), CIRCULAR_FLOW, named)
    found = {(r["hop1_id"], r["hop2_id"], r["hop3_id"]) for r in rings.collect()}
    assert found == brute_force(rows) and found
    # Links of active accounts, links that close an open pair, transfers of a search.
    assert named.frames.count("key-cells") == 3 and "open-pairs" in named.frames


def test_a_large_second_load_is_not_cut_to_its_surroundings(spark, stage):
    """New transfers are not summed up per pair, and links not searched for a new one where most are new."""
    rows = _random_transfers(4)
    for new_from, cut in ((100, False), (380, True)):
        named = Named(stage)
        old, new = (stage(transfers_frame(spark, part), "load") for part in (rows[:new_from], rows[new_from:]))
        stored = stage(circular_flow.link_summaries(circular_flow.ring_transfers(old, CIRCULAR_FLOW)), "summaries")
        rings = appended_rings.cycles_of_append(stored, old, new, new_from, CIRCULAR_FLOW, named)
        found = {(r["hop1_id"], r["hop2_id"], r["hop3_id"]) for r in rings.collect()}
        assert found == {ids for ids in brute_force(rows) if max(ids) > new_from} and found
        assert ("links-around" in named.frames) is cut
        assert "new-summaries" not in named.frames


def test_currencies_are_counted_before_the_hubs_are_met(spark, stage):
    """Ties go to the smaller name, and both sides of a transfer to oneself count."""
    rows = [transfer(n, "B:hub", f"B:{n}", hours(n), 10, "Euro") for n in range(3)]
    rows += [transfer(9 + n, "B:hub", "B:hub", hours(n), 10, "Dollar") for n in range(2)]
    rows += [transfer(20 + n, f"B:{n}", "B:hub", hours(n), 10, "Euro") for n in range(1)]
    hub = stage(spark.createDataFrame([(7, "B:hub")], "finding_id bigint, account_key string"), "hubs")
    named = Named(stage)
    found = mule_hub.dominant_currency(hub, transfers_frame(spark, rows), named)
    assert [tuple(r) for r in found.collect()] == [(7, "Dollar")] and "key-cells" in named.frames


def test_activity_is_the_same_for_busy_and_quiet_accounts(spark, stage, monkeypatch, capsys):
    """Quiet accounts meet in one shuffle, whatever the share from which an account counts as busy."""
    rows = _random_transfers(5) + [transfer(1000 + n, "B:0", f"B:{n % 40}", hours(n), 2000) for n in range(400)]
    links = circular_flow.as_links(circular_flow.ring_transfers(stage(transfers_frame(spark, rows), "transfers"), CIRCULAR_FLOW))
    found = {}
    for share in (2, 4, 1000):
        monkeypatch.setattr(circular_flow, "BUSY_SHARE", share)
        found[share] = sorted(map(repr, circular_flow.activity(links).collect()))
    assert found[2] == found[4] == found[1000] and found[2]
    monkeypatch.setattr(circular_flow, "BUSY_SHARE", 4)
    ends = links.select(F.xxhash64("currency", "src").alias("acct")).unionByName(links.select(F.xxhash64("currency", "dst").alias("acct")))
    assert circular_flow.busy_accounts(ends) == [spark.range(1).select(F.xxhash64(F.lit("Euro"), F.lit("B:0"))).first()[0]]
    assert circular_flow.busy_accounts(ends.filter("false")) == []
    monkeypatch.setattr(circular_flow, "BUSY_SHARE", 2)
    circular_flow.activity(links).explain()
    assert capsys.readouterr().out.count("Exchange") == 1
