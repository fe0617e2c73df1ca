"""What steps write and shuffle stays small next to their input."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import SMALL, hours, transfer, transfers_frame

from ringtrail import config
from ringtrail.operators import circular_flow, cyclic_core, two_hop
from ringtrail.plans.pipeline import Pipeline
from ringtrail.sources import csv_files, fixtures


def _files(folder, pattern):
    return [f for f in Path(folder).rglob(pattern) if not f.name.startswith(".")]


def test_drops_and_tables_are_compressed(spark, tmp_path):
    fixtures.write_csv(spark, SMALL, str(tmp_path / "csv"))
    pipeline = Pipeline(spark, str(tmp_path / "tables"))
    pipeline.load_csv(str(tmp_path / "csv"))
    drop = _files(tmp_path / "csv" / csv_files.TRANSACTIONS_FILE, "part-*")
    rows = pipeline.table("bronze/transactions_raw").count()
    assert rows == fixtures.derived_transactions(spark, SMALL).count()
    assert sum(f.stat().st_size for f in drop) < 50 * rows  # some 82 bytes a row as plain text
    tables = _files(tmp_path / "tables" / "bronze", "*.parquet")
    assert tables and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in tables} == {"ZSTD"}


def test_two_hop_paths_do_not_look_their_totals_up(spark, stage, capsys):
    rows = [transfer(k, f"B:{k % 5}", f"B:{(k * 3 + 1) % 5}", hours(k), 2000) for k in range(200)]
    hops = circular_flow.ring_transfers(transfers_frame(spark, rows), config.CIRCULAR_FLOW)
    two_hop.two_hop_path_counts(hops, config.CIRCULAR_FLOW, stage).explain()
    assert not [line for line in capsys.readouterr().out.splitlines() if "Join" in line and "stretch" in line]


class Named:
    """A staging that knows what was stored."""

    def __init__(self, stage):
        self.stage, self.frames = stage, []

    def __call__(self, df, name):
        self.frames.append((name, df.columns))
        return self.stage(df, name)

    def of(self, name):
        return [columns for n, columns in self.frames if n == name]


def test_trimming_stops_when_it_does_not_pay(spark, stage):
    """Twenty cycles of four links each: nothing can be trimmed."""
    pairs = [(f"n{k}-{i}", f"n{k}-{(i + 1) % 4}") for k in range(20) for i in range(4)]
    links = spark.createDataFrame([("Euro", 0, a, b) for a, b in pairs], "currency string, w bigint, src string, dst string")
    named = Named(stage)
    assert cyclic_core.cyclic_core(stage(links, "links"), 4, named).count() == 80
    assert len(named.of("core")) == 1


def _cycles_of(spark, stage, times):
    rows = [transfer(k, f"B:{k}", f"B:{(k + 1) % 4}", hours(t), 2000) for k, t in enumerate(times)]
    cfg = config.rings_of(4)
    links = circular_flow.as_links(circular_flow.ring_transfers(transfers_frame(spark, rows), cfg))
    hung = stage(circular_flow.hung_links(links, stage(circular_flow.activity(links), "activity"), keep_busy=True), "hung")
    return circular_flow.possible_cycles(hung, cfg, stage, peel=False)


def test_link_cycles_out_of_order_end_early(spark, stage):
    """Around a ring the time falls once; links that must fall twice hold none."""
    assert _cycles_of(spark, stage, [3, 4, 1, 2]).select("v1").distinct().count() == 1
    assert _cycles_of(spark, stage, [3, 1, 4, 2]).isEmpty()


def test_half_paths_carry_no_ranges(spark, stage):
    named = Named(stage)
    found = _cycles_of(spark, named, [1, 2, 3, 4])
    assert {"r1", "r2", "r3", "r4"} <= set(found.columns) and not found.isEmpty()
    assert named.of("link-cycles") == [["currency", "w", "v1", "v2", "v3", "v4"]]


def test_links_are_peeled_where_half_paths_are_many(spark, stage):
    """A ring of four is not peeled; forty payers of each of forty accounts that pay twenty others are."""
    few = [(f"a{k}", f"a{(k + 1) % 4}") for k in range(4)]
    many = [(f"p{k}", f"m{j}") for k in range(40) for j in range(40)] + [(f"m{j}", f"z{i}") for j in range(40) for i in range(20)]
    for pairs, peeled in ((few, 0), (many, 1)):
        rows = [("Euro", 0, a, b, not a.startswith("p") and b == "a0") for a, b in pairs]
        hung = spark.createDataFrame(rows, "currency string, w bigint, src string, dst string, hangs_on_src boolean")
        assert (circular_flow.paths_per_link(hung) > circular_flow.PATHS_PER_LINK) == bool(peeled)
    named = Named(stage)
    rows = [transfer(k, f"B:{k}", f"B:{(k + 1) % 4}", hours(k), 2000) for k in range(4)]
    assert circular_flow.cycles(transfers_frame(spark, rows), config.rings_of(4), named).count() == 1
    assert not named.of("core-links")


@pytest.mark.parametrize("hops", [4, 5])
def test_rings_of_dense_accounts_come_from_paths_of_transfers(spark, stage, hops):
    """Few transfers per link: no cycle of links is formed, and the rings are those that links give."""
    rng = random.Random(hops)
    rows = [
        transfer(i, f"B:{rng.randrange(9)}", f"B:{rng.randrange(9)}", hours(rng.randrange(0, 24 * 300, 24)), rng.choice([1500, 2000, 9000]))
        for i in range(110)
    ]
    named, frame = Named(stage), transfers_frame(spark, rows)
    found = circular_flow.cycles(frame, config.rings_of(hops), named)
    assert named.of("arcs") and not named.of("link-cycles")
    links = circular_flow.cycles(frame, config.rings_of(hops), stage, peel=False)
    assert found.schema == links.schema and found.count() > 20
    assert sorted(map(repr, found.collect())) == sorted(map(repr, links.collect()))


def test_rings_of_busy_pairs_come_from_links(spark, stage):
    rows = [transfer(30 * k + i, f"B:{k}", f"B:{(k + 1) % 4}", hours(40 * k + i), 2000) for k in range(4) for i in range(5)]
    named = Named(stage)
    assert circular_flow.cycles(transfers_frame(spark, rows), config.rings_of(4), named).count() == 5**4
    assert named.of("link-cycles") and not named.of("arcs")
