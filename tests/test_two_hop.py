"""Counts of two-hop paths against a self-join by brute force, and the shape of the plan."""

import random
import time
from datetime import timedelta

import pytest
from conftest import hours, transfer, transfers_frame

from ringtrail.config import CIRCULAR_FLOW
from ringtrail.operators import circular_flow, two_hop


def counts(spark, stage, rows):
    hops = circular_flow.ring_transfers(transfers_frame(spark, rows), CIRCULAR_FLOW)
    found = two_hop.two_hop_path_counts(hops, CIRCULAR_FLOW, stage)
    return {(r["account_key"], r["currency"]): tuple(int(r[k]) for k in ("arrivals", "departures", "paths", "returning_paths", "open_paths")) for r in found.collect()}


def brute_force(rows):
    kept = [r for r in rows if r[4] > 1000 and r[1] != r[2]]
    limit, out = timedelta(days=14), {}
    for x in kept:
        for y in kept:
            if x[2] == y[1] and x[5] == y[5] and x[3] <= y[3] <= x[3] + limit:
                all_, back = out.get((y[1], y[5]), (0, 0))
                out[y[1], y[5]] = (all_ + 1, back + (x[1] == y[2]))
    return {
        (a, c): (sum(r[2] == a and r[5] == c for r in kept), sum(r[1] == a and r[5] == c for r in kept), p, b, p - b)
        for (a, c), (p, b) in out.items()
    }


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs_equal_brute_force(spark, stage, seed):
    rng = random.Random(seed)
    rows = [
        transfer(k, f"B1:{rng.randrange(9)}", f"B1:{rng.randrange(9)}", timedelta(minutes=30 * rng.randrange(1, 1500)),
                 rng.choice([900, 1000, 1001, 5000]), rng.choice(["Euro", "Yen"]))
        for k in range(400)
    ]
    assert counts(spark, stage, rows) == brute_force(rows)


def test_ends_of_the_span_count(spark, stage):
    day = timedelta(days=1)
    rows = [
        transfer(1, "B:a", "B:m", 0 * day, 2000), transfer(2, "B:m", "B:c", 14 * day, 2000),
        transfer(3, "B:m", "B:a", 14 * day, 2000), transfer(4, "B:m", "B:d", 14 * day + timedelta(minutes=1), 2000),
        transfer(5, "B:m", "B:e", 0 * day, 2000), transfer(6, "B:m", "B:f", -timedelta(minutes=1), 2000),
    ]
    assert counts(spark, stage, rows) == brute_force(rows) == {("B:m", "Euro"): (1, 5, 3, 1, 2)}


def test_no_transfers(spark, stage):
    assert counts(spark, stage, []) == {}


def test_a_busy_account_takes_linear_work(spark, stage):
    """300,000 transfers into and as many out of one account are 4.5 * 10^10 paths."""
    n = 300_000
    minute = "timestamp_ntz'2022-09-01 00:00:00' + make_dt_interval(0, 0, cast(id % 10000 as int))"
    rows = spark.range(2 * n).selectExpr(
        "id fin_txn_id", f"if(id < {n}, concat('s', id), 'hub') from_account_key", f"if(id < {n}, 'hub', concat('r', id)) to_account_key",
        f"{minute} event_timestamp", "cast(5000 as decimal(20,4)) amount", "'Euro' currency", "'ACH' payment_format",
    )
    hops = circular_flow.ring_transfers(rows, CIRCULAR_FLOW)
    began = time.monotonic()
    (row,) = two_hop.two_hop_path_counts(hops, CIRCULAR_FLOW, stage).collect()
    assert time.monotonic() - began < 60
    # Each minute has 30 arrivals and 30 departures; all lie within 14 days.
    assert int(row["paths"]) == sum(30 * 30 * (m + 1) for m in range(10_000))


def test_no_join_pairs_arrivals_with_departures(spark, stage):
    rows = [transfer(k, f"B:{k % 5}", f"B:{k % 7}", hours(k), 2000) for k in range(50)]
    hops = circular_flow.ring_transfers(transfers_frame(spark, rows), CIRCULAR_FLOW)
    plan = two_hop.two_hop_path_counts(hops, CIRCULAR_FLOW, stage)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert joins and all("stretch" in line or "account_key" in line for line in joins)
    assert not any("src" in line or "dst" in line for line in joins)
