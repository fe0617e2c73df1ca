"""Rings over two loads: each found once, in the load that closes it, and nothing old looked at again."""

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from conftest import hours, transfer, transfers_frame

from ringtrail.config import CIRCULAR_FLOW
from ringtrail.operators import appended_rings
from ringtrail.operators import circular_flow as flow
from ringtrail.staging import Staging


class Noting(Staging):
    """Keeps what is staged by name."""

    def __call__(self, df, name):
        self.__dict__.setdefault("seen", {})[name] = out = super().__call__(df, name)
        return out


def ids(rings, hops):
    return {tuple(r[f"hop{k}_id"] for k in range(1, hops + 1)) for r in rings}


def append(spark, root, old, new, cfg):
    stage = Noting(spark, str(root))
    old, new = transfers_frame(spark, old), transfers_frame(spark, new)
    stored = stage(flow.link_summaries(flow.ring_transfers(old, cfg)), "stored")
    last = old.agg({"fin_txn_id": "max"}).first()[0] or 0
    rings = appended_rings.cycles_of_append(stored, old, new, last, cfg, stage).collect()
    return rings, stage.seen


def graph(seed, n, days):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        src, dst = rng.sample(range(10), 2) if rng.random() < 0.7 else (0, rng.randrange(1, 10))
        rows.append((f"B:{src}", f"B:{dst}", hours(rng.randrange(0, 24 * days, 6)), rng.choice([1500, 1600, 2000, 3000, 9000])))
    return rows


@pytest.mark.parametrize(("hops", "n", "days"), [(2, 300, 120), (3, 700, 120), (4, 500, 60)])
@pytest.mark.parametrize("by_time", [True, False])
def test_two_loads_find_the_rings_of_one(spark, stage, tmp_path, hops, n, days, by_time):
    cfg = replace(CIRCULAR_FLOW, params=CIRCULAR_FLOW.params | {"hops": hops, "max_time_span_days": 10})
    rows = graph(hops, n, days)
    if by_time:
        rows.sort(key=lambda r: r[2])
    rows = [transfer(k, *r) for k, r in enumerate(rows, 1)]
    half = n // 2
    whole = ids(flow.cycles(transfers_frame(spark, rows), cfg, stage).collect(), hops)
    first = ids(flow.cycles(transfers_frame(spark, rows[:half]), cfg, stage).collect(), hops)
    found, _ = append(spark, tmp_path, rows[:half], rows[half:], cfg)
    second = ids(found, hops)
    assert len(found) == len(second) and len(second) > 10
    assert not first & second and first | second == whole
    assert sorted(r["finding_id"] for r in found) == list(range(1, len(found) + 1))


def test_only_what_a_new_transfer_touches_is_read(spark, tmp_path):
    def ring(base, at, name):
        route = [(f"B:{name}{a}", f"B:{name}{b}") for a, b in ("pq", "qr", "rp")]
        return [transfer(base + k, s, d, at + hours(k), 2000) for k, (s, d) in enumerate(route)]

    day = timedelta(days=1)
    old = [r for k in range(30) for r in ring(3 * k + 1, k * 40 * day, f"x{k}-")]
    # One ring waits for its last hop, in the window of another that is complete.
    waiting = ring(200, 400 * day, "w")
    old += waiting[:2]
    rings, seen = append(spark, tmp_path, old, waiting[2:], CIRCULAR_FLOW)
    assert ids(rings, 3) == {(200, 201, 202)}
    assert seen["links"].count() <= 6
    assert {r["src"][:3] for r in seen["links-around"].collect()} == {"B:w"}
    assert {r["fin_txn_id"] for r in seen["candidate-hops"].collect()} == {200, 201, 202}
    # A transfer that closes nothing.
    rings, seen = append(spark, tmp_path, old, [transfer(300, "B:x3-p", "B:new", 3 * 40 * day, 2000)], CIRCULAR_FLOW)
    assert rings == [] and seen["candidate-hops"].count() == 0 and seen["links-around"].isEmpty()


@pytest.mark.parametrize(("old", "new"), [([], []), ([], [0, 1, 2]), ([0, 1, 2], [])])
def test_empty_loads(spark, tmp_path, old, new):
    route = [("B:a", "B:b"), ("B:b", "B:c"), ("B:c", "B:a")]
    rows = [transfer(k + 1, *route[k], hours(k), 2000) for k in range(3)]
    rings, _ = append(spark, tmp_path, [rows[k] for k in old], [rows[k] for k in new], CIRCULAR_FLOW)
    assert len(rings) == (1 if new else 0)


def test_summaries_of_two_loads_count_as_one(spark, stage):
    rows = [transfer(k, *r) for k, r in enumerate(graph(9, 200, 60), 1)]
    parts = [flow.link_summaries(flow.ring_transfers(transfers_frame(spark, p), CIRCULAR_FLOW)) for p in (rows[:90], rows[90:])]
    both = stage(parts[0].unionByName(parts[1]), "both")
    plain = flow.as_links(flow.ring_transfers(transfers_frame(spark, rows), CIRCULAR_FLOW))
    assert sorted(map(repr, flow.activity(both).collect())) == sorted(map(repr, flow.activity(plain).collect()))
    left = flow.hung_links(both, flow.activity(both)).collect()
    assert sorted(map(repr, left)) == sorted(map(repr, flow.hung_links(plain, flow.activity(plain)).collect())) and left
