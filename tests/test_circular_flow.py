"""Ring detection: boundary cases by hand and random graphs against brute force."""

import random
import time
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal
from itertools import permutations

import pytest
from conftest import START, hours, transfer, transfers_frame

from ringtrail.config import CIRCULAR_FLOW
from ringtrail.operators import circular_flow, cyclic_core

RUN_TS = datetime(2024, 1, 1)


def brute_force(rows):
    """All rings by definition, as (hop1, hop2, hop3) ids."""
    kept = [r for r in rows if r[4] > 1000 and r[1] != r[2]]
    by_src = {}
    for r in kept:
        by_src.setdefault(r[1], []).append(r)
    found = set()
    limit = timedelta(days=14)
    for x in kept:
        for y in by_src.get(x[2], ()):
            if y[5] != x[5] or not x[3] <= y[3] <= x[3] + limit:
                continue
            for z in by_src.get(y[2], ()):
                amounts = (x[4], y[4], z[4])
                if (
                    z[2] == x[1]
                    and z[5] == x[5]
                    and y[3] <= z[3] <= x[3] + limit
                    and max(amounts) * 2 <= min(amounts) * 3
                ):
                    found.add((x[0], y[0], z[0]))
    return found


def ring(base, amounts, at=(0, 30, 60), currency="Euro", formats=("ACH",) * 3, name=None):
    a, b, c = (f"B1:{name or base}{k}" for k in "abc")
    route = [(a, b), (b, c), (c, a)]
    return [
        transfer(base + i, s, d, hours(at[i]), amounts[i], currency, formats[i]) for i, (s, d) in enumerate(route)
    ]


HAND_MADE = {
    "hero": ring(10, (56544.74, 51178.80, 51203.66), (11.35, 81.683333, 88.316667), "Saudi Riyal"),
    "edge_in": ring(20, (2000, 2000, 2000), (0, 30, 14 * 24)),
    "edge_out": ring(30, (2000, 2000, 2000), (0, 30, 14 * 24 + 1 / 60)),
    "dust": ring(40, (1000, 1200, 1200)),
    "above_dust": ring(50, (1000.0001, 1200, 1200)),
    "ratio_1_2": ring(60, (10000, 12000, 11000)),
    "ratio_1_2001": ring(70, (10000, 12001, 11000)),
    "ratio_1_5": ring(80, (10000, 15000, 11000)),
    "ratio_1_5001": ring(90, (10000, 15001, 11000)),
    "formats_differ": ring(100, (2000, 2000, 2000), formats=("ACH", "Wire", "ACH")),
    "currencies_differ": ring(110, (2000, 2000, 2000))[:2] + ring(110, (2000, 2000, 2000), currency="Yen")[2:],
    "time_reversed": ring(120, (2000, 2000, 2000), (60, 30, 0)),
    "equal_times": ring(130, (2000, 2000, 2000), (5, 5, 5)),
    "two_equal_times": ring(140, (2000, 2000, 2000), (5, 5, 6)),
    "back_and_forth": [
        transfer(150, "B1:p", "B1:q", hours(0), 2000),
        transfer(151, "B1:q", "B1:p", hours(1), 2000),
        transfer(152, "B1:p", "B1:q", hours(2), 2000),
        transfer(153, "B1:q", "B1:q", hours(3), 2000),
    ],
}


@pytest.fixture(scope="module")
def hand_made(spark, tmp_path_factory):
    from ringtrail.staging import Staging

    rows = [r for case in HAND_MADE.values() for r in case]
    stage = Staging(spark, str(tmp_path_factory.mktemp("rings")))
    rings = stage(circular_flow.cycles(transfers_frame(spark, rows), CIRCULAR_FLOW, stage), "rings")
    return rows, rings, circular_flow.findings(rings, CIRCULAR_FLOW, RUN_TS).collect()


def found_cases(rings):
    names = {}
    for name, rows in HAND_MADE.items():
        for r in rows:
            names[r[0]] = name
    counts = {}
    for r in rings.collect():
        counts[names[r["hop1_id"]]] = counts.get(names[r["hop1_id"]], 0) + 1
    return counts


def test_which_cases_are_rings(hand_made):
    _, rings, _ = hand_made
    # time_reversed starts with its third hop: c->a, a->b would need b->c afterwards.
    assert found_cases(rings) == {
        "hero": 1,
        "edge_in": 1,
        "above_dust": 1,
        "ratio_1_2": 1,
        "ratio_1_2001": 1,
        "ratio_1_5": 1,
        "formats_differ": 1,
        "equal_times": 3,
        "two_equal_times": 1,
    }


def test_hand_made_equals_brute_force(hand_made):
    rows, rings, _ = hand_made
    got = {(r["hop1_id"], r["hop2_id"], r["hop3_id"]) for r in rings.collect()}
    assert got == brute_force(rows)


def test_ids_are_dense_in_time_order(hand_made):
    _, rings, _ = hand_made
    ordered = sorted(rings.collect(), key=lambda r: r["finding_id"])
    assert [r["finding_id"] for r in ordered] == list(range(1, len(ordered) + 1))
    keys = [(r["ts_hop1"], r["hop1_id"], r["hop2_id"], r["hop3_id"]) for r in ordered]
    assert keys == sorted(keys)


def test_severity(hand_made):
    _, rings, findings = hand_made
    severity = {f["finding_id"]: f["severity"] for f in findings}
    by_hop = {r["hop1_id"]: severity[r["finding_id"]] for r in rings.collect()}
    assert by_hop[10] == "HIGH" and by_hop[60] == "HIGH"
    assert by_hop[70] == "MEDIUM" and by_hop[80] == "MEDIUM" and by_hop[100] == "MEDIUM"


def test_hero_finding(hand_made):
    _, _, findings = hand_made
    hero = next(f for f in findings if "10a" in f["title"])
    assert hero["title"] == "3-hop circular fund flow: B1:10a -> B1:10b -> B1:10c -> B1:10a"
    assert hero["description"] == (
        "Ring of 3 distinct accounts returning funds to origin over 77 hours. "
        "Amount range 51178.8000-56544.7400 Saudi Riyal."
    )
    stats = hero["summary_stats"]
    assert stats["amount_ratio"] == Decimal("1.1048") and stats["time_span_hours"] == 77 and stats["hops"] == 3
    assert hero["sla_duration"] == timedelta(hours=72)
    assert hero["sla_trigger_date"] == START + hours(11.35)


def test_entities_and_edges(spark, hand_made):
    _, rings, _ = hand_made
    hero = rings.filter("hop1_id = 10")
    owned = [("P1", "B1:10a"), ("P1", "B1:10b"), ("P2", "B1:10c"), ("P3", "B9:x")]
    has_account = spark.createDataFrame(owned, "party_id string, account_key string")
    held = spark.createDataFrame([(f"B1:10{k}", "B1") for k in "abc"], "account_key string, fse_id string")
    rows = circular_flow.entities(hero, CIRCULAR_FLOW, has_account, held).collect()
    assert sorted((r["entity_type"], r["entity_id"], r["role"]) for r in rows) == [
        ("Account", "B1:10a", "ring_member"),
        ("Account", "B1:10b", "ring_member"),
        ("Account", "B1:10c", "ring_member"),
        ("FinancialInstitution", "B1", "custodian_bank"),
        ("Party", "P1", "account_owner"),
        ("Party", "P2", "account_owner"),
    ]
    edges = sorted(circular_flow.edges(hero, CIRCULAR_FLOW).collect(), key=lambda r: r["hop_order"])
    assert [(e["hop_order"], e["from_entity"], e["to_entity"], e["fin_txn_id"]) for e in edges] == [
        (1, "B1:10a", "B1:10b", 10),
        (2, "B1:10b", "B1:10c", 11),
        (3, "B1:10c", "B1:10a", 12),
    ]
    assert edges[0]["attrs"]["amount"] == Decimal("56544.7400") and edges[0]["attrs"]["direction"] is None


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graph_equals_brute_force(spark, stage, seed):
    """Few accounts, many repeats, long time span, times and amounts on boundaries."""
    rng = random.Random(seed)
    accounts = [f"B{i % 3}:{i}" for i in range(14)]
    rows = []
    for i in range(1, 1500):
        hub = rng.random() < 0.35
        src = accounts[0] if hub and rng.random() < 0.5 else rng.choice(accounts)
        dst = accounts[0] if hub and src != accounts[0] else rng.choice(accounts)
        amount = rng.choice([999, 1000, 1001, 1500, 1501.5, 2000, 3000, 3000.0001, 9000])
        rows.append(
            transfer(i, src, dst, hours(rng.randrange(0, 24 * 300, 12)), amount, rng.choice(["Euro", "Yen"]))
        )
    rings = circular_flow.cycles(transfers_frame(spark, rows), CIRCULAR_FLOW, stage).collect()
    got = [(r["hop1_id"], r["hop2_id"], r["hop3_id"]) for r in rings]
    expected = brute_force(rows)
    assert len(expected) > 20
    assert len(got) == len(set(got)) and set(got) == expected


def test_before_1970(spark, stage):
    early = [(r[0], r[1], r[2], r[3].replace(year=1965), *r[4:]) for r in ring(10, (2000, 2100, 2200), (0, 100, 300))]
    assert circular_flow.cycles(transfers_frame(spark, early), CIRCULAR_FLOW, stage).count() == 1


def test_a_hub_does_not_multiply_links(spark, stage):
    """n senders and n receivers of one account: pairings stay linear, not n * n."""
    n = 400
    rows = [transfer(i, f"B1:s{i}", "B1:hub", hours(i % 100), 2000) for i in range(n)]
    rows += [transfer(n + i, "B1:hub", f"B1:r{i}", hours(i % 100), 2000) for i in range(n)]
    rows += [transfer(2 * n + i, f"B1:r{i}", f"B1:s{i}", hours(100 + i % 100), 2000) for i in range(n)]
    hops = circular_flow.ring_transfers(transfers_frame(spark, rows), CIRCULAR_FLOW)
    hung = stage(circular_flow.hung_links(circular_flow.as_links(hops), circular_flow.activity(circular_flow.as_links(hops))), "hung")
    leaving = hung.filter("hangs_on_src").groupBy("currency", "w", "src").count()
    entering = hung.filter("not hangs_on_src").groupBy("currency", "w", "dst").count()
    assert max(r["count"] for r in leaving.collect() + entering.collect()) <= 2
    assert circular_flow.cycles(transfers_frame(spark, rows), CIRCULAR_FLOW, stage).count() == len(brute_force(rows))


def busy_ring(n):
    """n transfers on two sides of a ring, of which almost no two fit, and one that closes it."""
    rows = [transfer(i, "B1:a", "B1:b", hours(1), 1600 if i == 0 else 1500) for i in range(n)]
    rows += [transfer(n + i, "B1:b", "B1:c", hours(2), 2200 if i == 0 else 2390) for i in range(n)]
    return [*rows, transfer(2 * n, "B1:c", "B1:a", hours(3), 1900)]


def test_a_busy_ring_forms_no_product(spark, stage):
    """Of n * n pairs 2n - 1 are rings: the joins before the last conditions stay linear."""
    n = 20_000
    frame = transfers_frame(spark, busy_ring(n))
    began = time.monotonic()
    rings = circular_flow.cycles(frame, CIRCULAR_FLOW, stage)
    assert rings.count() == 2 * n - 1
    assert time.monotonic() - began < 120


@pytest.mark.parametrize("sides", [(60, 70, 3), (3, 60, 70), (70, 3, 60)])
def test_fine_cells_equal_brute_force(spark, stage, sides, monkeypatch):
    """Amounts and times around the limits, with every ring large enough for cells."""
    monkeypatch.setattr(circular_flow, "COARSE_PAIRS", 5)
    rng = random.Random(sum(sides[:2]))
    rows, accounts = [], ["B1:a", "B1:b", "B1:c"]
    for k, n in enumerate(sides):
        for _ in range(n):
            amount = rng.choice([1500, 1600, 1999.9999, 2000, 2250, 2250.0001, 2399, 2400, 2400.0001, 3000])
            when = timedelta(hours=rng.choice([0, 1, 83, 84, 85, 335, 336, 337, 400]))
            rows.append(transfer(len(rows) + 1, accounts[k], accounts[(k + 1) % 3], when, amount))
    rings = circular_flow.cycles(transfers_frame(spark, rows), CIRCULAR_FLOW, stage).collect()
    got = [(r["hop1_id"], r["hop2_id"], r["hop3_id"]) for r in rings]
    expected = brute_force(rows)
    assert len(expected) > 20 and len(got) == len(set(got)) and set(got) == expected


def shaped(**params):
    return replace(CIRCULAR_FLOW, params=CIRCULAR_FLOW.params | params)


@pytest.mark.parametrize("params", [{"hops": 1}, {"hops": 27}, {"same_currency": False}, {"min_amount": Decimal("-1")}])
def test_unsupported_shape_is_refused(spark, stage, params):
    with pytest.raises(ValueError, match="circular flow is defined for"):
        circular_flow.cycles(transfers_frame(spark, []), shaped(**params), stage)


def walks(rows, hops, days, ratio):
    """All rings of so many hops by definition, as tuples of ids."""
    by_src = {}
    for r in rows:
        if r[4] > 1000 and r[1] != r[2]:
            by_src.setdefault((r[1], r[5]), []).append(r)
    found = set()

    def go(path):
        first, last = path[0], path[-1]
        if len(path) == hops:
            if last[2] == first[1]:
                found.add(tuple(r[0] for r in path))
            return
        for r in by_src.get((last[2], first[5]), ()):
            amounts = [x[4] for x in path] + [r[4]]
            nodes = [x[1] for x in path]
            if last[3] <= r[3] <= first[3] + timedelta(days=days) and max(amounts) <= ratio * min(amounts) and r[1] not in nodes:
                go([*path, r])

    for group in by_src.values():
        for r in group:
            go([r])
    return found


@pytest.mark.parametrize(("hops", "accounts", "n"), [(2, 14, 900), (3, 14, 900), (4, 10, 800), (5, 9, 600), (6, 8, 500)])
def test_rings_of_any_length_equal_brute_force(spark, stage, hops, accounts, n):
    rng = random.Random(hops)
    rows = []
    for i in range(1, n):
        hub = rng.random() < 0.3
        src = "B:0" if hub and rng.random() < 0.5 else f"B:{rng.randrange(accounts)}"
        dst = "B:0" if hub and src != "B:0" else f"B:{rng.randrange(accounts)}"
        amount = rng.choice([999, 1001, 1500, 1501.5, 2000, 3000, 9000])
        rows.append(transfer(i, src, dst, hours(rng.randrange(0, 24 * (90 if hops < 5 else 40), 6)), amount, rng.choice(["Euro", "Yen"])))
    # A ring whose accounts all differ, at the ends of the span and the ratio.
    for k in range(hops):
        when = hours(0 if k == 0 else 20 * 24 if k == hops - 1 else 24)
        rows.append(transfer(5000 + k, f"C:{k}", f"C:{(k + 1) % hops}", when, 2000 if k else 3000))
    cfg = shaped(hops=hops, max_time_span_days=20)
    rings = circular_flow.cycles(transfers_frame(spark, rows), cfg, stage)
    assert rings.columns == ["finding_id", *circular_flow.ring_columns(hops)]
    got = sorted(rings.collect(), key=lambda r: r["finding_id"])
    ids = [tuple(r[f"hop{k}_id"] for k in range(1, hops + 1)) for r in got]
    expected = walks(rows, hops, 20, Decimal("1.5"))
    assert len(expected) > 20 and len(ids) == len(set(ids)) and set(ids) == expected
    assert [(r["ts_hop1"], i) for r, i in zip(got, ids, strict=True)] == sorted((r["ts_hop1"], i) for r, i in zip(got, ids, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_peeling_changes_no_ring(spark, stage, seed):
    rng = random.Random(seed)
    rows = [
        transfer(i, f"B:{rng.randrange(12)}", f"B:{rng.randrange(12)}", hours(rng.randrange(0, 24 * 90, 6)), rng.choice([1500, 2000, 2900]))
        for i in range(700)
    ]
    frame = transfers_frame(spark, rows)
    plain, peeled = (sorted(map(repr, circular_flow.cycles(frame, CIRCULAR_FLOW, stage, peel).collect())) for peel in (False, True))
    assert plain == peeled and len(plain) > 20


def test_findings_of_four_hops(spark, stage):
    rows = [transfer(k, f"B1:{a}", f"B1:{b}", hours(k), 2000 + k) for k, (a, b) in enumerate(["pq", "qr", "rs", "sp"])]
    cfg = shaped(hops=4)
    rings = stage(circular_flow.cycles(transfers_frame(spark, rows), cfg, stage), "rings")
    (found,) = circular_flow.findings(rings, cfg, RUN_TS).collect()
    assert found["title"] == "4-hop circular fund flow: B1:p -> B1:q -> B1:r -> B1:s -> B1:p"
    assert found["description"].startswith("Ring of 4 distinct accounts") and found["summary_stats"]["hops"] == 4
    edges = sorted(circular_flow.edges(rings, cfg).collect(), key=lambda r: r["hop_order"])
    assert [(e["from_entity"][-1], e["to_entity"][-1], e["fin_txn_id"]) for e in edges] == [("p", "q", 0), ("q", "r", 1), ("r", "s", 2), ("s", "p", 3)]
    none = spark.createDataFrame([], "party_id string, account_key string")
    held = spark.createDataFrame([("B1:p", "B1")], "account_key string, fse_id string")
    assert circular_flow.entities(rings, cfg, none, held).count() == 5


def links_frame(spark, pairs):
    return spark.createDataFrame([("Euro", 0, a, b) for a, b in pairs], "currency string, w bigint, src string, dst string")


@pytest.mark.parametrize("hops", [2, 3, 5])
def test_the_core_holds_every_cycle(spark, stage, hops):
    rng = random.Random(hops)
    pairs = sorted({(f"n{a}", f"n{b}") for a, b in ((rng.randrange(40), rng.randrange(40)) for _ in range(70)) if a != b})
    left = {(r["src"], r["dst"]) for r in cyclic_core.cyclic_core(stage(links_frame(spark, pairs), "links"), hops, stage).collect()}
    after = {}
    for a, b in pairs:
        after.setdefault(a, []).append(b)

    def closes(first, at, steps):
        return at == first if steps == 0 else any(closes(first, b, steps - 1) for b in after.get(at, ()))

    assert left >= {(a, b) for a, b in pairs if closes(a, b, hops - 1)}
    assert left <= set(pairs)


def test_nothing_of_a_graph_without_cycles_stays(spark, stage):
    """A million transfers on one chain with side steps, too long to be trimmed from its ends."""
    n = 1_000_000
    rows = spark.range(n).selectExpr(
        "'Euro' currency", "0L w", "concat('n', id div 2) src", "concat('n', id div 2 + 1 + id % 2 * 2) dst"
    )
    began = time.monotonic()
    assert cyclic_core.cyclic_core(stage(rows, "links"), 4, stage).isEmpty()
    assert time.monotonic() - began < 120


def test_rotations_of_brute_force_are_distinct():
    rows = ring(1, (2000, 2000, 2000), (5, 5, 5))
    assert brute_force(rows) == {p for p in permutations((1, 2, 3)) if p in {(1, 2, 3), (2, 3, 1), (3, 1, 2)}}
