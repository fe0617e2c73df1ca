"""The whole run: bronze -> silver -> detectors -> gold, one Parquet directory per table.

Layers are cut at stored tables, so every step can be run again on its own and a lost
executor costs only the tasks it held.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail import constants as K
from ringtrail import schemas
from ringtrail.config import ASSESSMENTS, Assessment, config_frame, upsert_config
from ringtrail.operators import appended_rings, circular_flow, exposure, graph, mule_hub, publish
from ringtrail.operators.findings import with_id_offset
from ringtrail.session import apply_engine_conf
from ringtrail.sources import csv_files
from ringtrail.sources.switching import Change, commit, finish
from ringtrail.sources.tables import WriteReport, load_folder, read_table, write_fresh, write_fresh_partition
from ringtrail.staging import Staging, delete, exists

def _by_finding(df: DataFrame) -> DataFrame:
    """Ordered by finding across and within files, so that a read of one finding skips the others."""
    return df.repartitionByRange("finding_id").sortWithinPartitions("finding_id")


# Links of the transfers of each load, per configuration of the rings; for `append_frames`.
SUMMARIES = "silver/link_summary"
FINDING_TABLES = ["silver/finding", "silver/finding_entity", "silver/finding_edge"]


def _tidy(step):
    """A step of the pipeline that leaves no scratch behind when it raises."""

    @functools.wraps(step)
    def run(self, *args, **kwargs):
        try:
            return step(self, *args, **kwargs)
        except BaseException:
            self.clear_scratch()
            raise

    return run


@dataclass
class Pipeline:
    """Tables below `root`, a shared folder. `keep_scratch` leaves the staged
    intermediates readable through `frames` after a step."""

    spark: SparkSession
    root: str
    run_ts: datetime = field(default_factory=lambda: datetime.now(UTC).replace(tzinfo=None))
    assessments: dict[str, Assessment] = field(default_factory=lambda: dict(ASSESSMENTS))
    keep_scratch: bool = False
    # Where given: notes the frame behind every path written, for `operators.lineage`.
    origins: dict[str, DataFrame] | None = None
    parallel_jobs: int = 4
    frames: dict[str, DataFrame] = field(default_factory=dict)
    reports: list[WriteReport] = field(default_factory=list)
    _open: list[Staging] = field(default_factory=list, repr=False)
    _changes: list[Change] | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        apply_engine_conf(self.spark)

    def table(self, name: str) -> DataFrame:
        # What the current step has written so far counts for it.
        return read_table(self.spark, f"{self.root}/{name}", schemas.TABLES[name], self.root, self._changes or ())

    @contextmanager
    def _at_once(self) -> Iterator[None]:
        """Tables saved inside change together when the block ends, and not at all if it raises."""
        if self._changes is not None:  # part of a larger change
            yield
            return
        finish(self.spark, self.root)
        self._changes = []
        try:
            yield
        except BaseException:
            for change in self._changes:
                if change.fresh is not None:
                    delete(self.spark, change.fresh)
            self._changes = None
            raise
        changes, self._changes = self._changes, None
        commit(self.spark, self.root, changes)

    def _save(self, name: str, df: DataFrame) -> None:
        with self._at_once():
            self._note(df, *write_fresh(df, f"{self.root}/{name}", name))

    def _add(self, name: str, df: DataFrame) -> None:
        """One more load of a table, beside those it has."""
        with self._at_once():
            self._note(df, *write_fresh(df, load_folder(f"{self.root}/{name}"), name))

    def _note(self, df: DataFrame, report: WriteReport, change: Change) -> None:
        self.reports.append(report)
        self._changes.append(change)
        if self.origins is not None:
            self.origins |= {change.path: df, change.fresh: df}

    def _together(self, *jobs: Callable[[], object]) -> None:
        """Run independent jobs side by side, so that one's last tasks do not leave executors idle."""
        with ThreadPoolExecutor(self.parallel_jobs) as pool:
            for running in [pool.submit(job) for job in jobs]:
                running.result()

    def _save_all(self, **tables: DataFrame) -> None:
        """Write silver tables side by side."""
        self._together(*[lambda n=n, df=df: self._save(f"silver/{n}", df) for n, df in tables.items()])

    def _staging(self) -> Staging:
        stage = Staging(self.spark, f"{self.root}/_scratch", origins=self.origins)
        self._open.append(stage)
        return stage

    def _done(self, stage: Staging, **frames: DataFrame) -> None:
        if self.keep_scratch:
            self.frames.update(frames)
            self._open.remove(stage)
        else:
            self.clear_scratch()

    def clear_scratch(self) -> None:
        """Delete what steps have staged and not kept."""
        while self._open:
            self._open.pop().clear()

    # --- bronze -------------------------------------------------------------------

    def load_csv(self, data_dir: str, only: str | None = None) -> None:
        """Mirror the CSV drops; `only` is "trans" or "accounts"."""
        if only not in (None, "trans", "accounts"):
            raise ValueError(f"unknown source: {only}")
        with self._at_once():
            if only in (None, "trans"):
                path = f"{data_dir}/{csv_files.TRANSACTIONS_FILE}"
                self._save("bronze/transactions_raw", csv_files.read_transactions(self.spark, path))
            if only in (None, "accounts"):
                path = f"{data_dir}/{csv_files.ACCOUNTS_FILE}"
                self._save("bronze/accounts_raw", csv_files.read_accounts(self.spark, path))

    def load_frames(self, txns: DataFrame, accounts: DataFrame) -> None:
        with self._at_once():
            self._save("bronze/transactions_raw", txns)
            self._save("bronze/accounts_raw", accounts)

    # --- silver -------------------------------------------------------------------

    @_tidy
    def build_silver(self) -> None:
        """Rebuild the graph. Findings refer to it, so they are emptied in the same change."""
        stage = self._staging()
        with self._at_once():
            self._together(lambda: self._build_transactions(stage), lambda: self._build_parties(stage))
            self.clear_findings()
            self._changes.append(Change(None, f"{self.root}/{SUMMARIES}"))
        self._done(stage)

    def _build_transactions(self, stage: Staging) -> None:
        numbered = graph.number_transactions(self.table("bronze/transactions_raw"), stage)
        self._together(
            lambda: self._save("silver/transfers_to", graph.transfers_to(numbered)),
            lambda: self._save("silver/financial_transaction", graph.financial_transactions(numbered)),
            lambda: self._save("silver/has_originating_account", graph.originating(numbered)),
            lambda: self._save("silver/has_beneficiary_account", graph.beneficiary(numbered)),
            lambda: self._save("label/txn_label", graph.txn_labels(numbered)),
        )

    def _build_parties(self, stage: Staging) -> None:
        accounts = self.table("bronze/accounts_raw")
        seen = stage(graph.transaction_accounts(self.table("bronze/transactions_raw")), "transaction-accounts")
        self._save("silver/account", graph.account_nodes(seen, accounts))
        self._save_all(
            financial_institution=graph.financial_institutions(seen, accounts),
            party=graph.parties(seen, accounts),
            has_account=graph.has_account(seen, accounts),
            is_held_at=graph.is_held_at(self.table("silver/account")),
        )

    def append_csv(self, data_dir: str) -> None:
        """A further drop of transactions, with or without one of accounts; see `append_frames`."""
        accounts = f"{data_dir}/{csv_files.ACCOUNTS_FILE}"
        self.append_frames(
            csv_files.read_transactions(self.spark, f"{data_dir}/{csv_files.TRANSACTIONS_FILE}"),
            csv_files.read_accounts(self.spark, accounts) if exists(self.spark, accounts) else None,
        )

    @_tidy
    def append_frames(self, txns: DataFrame, accounts: DataFrame | None = None) -> None:
        """Add a load to those stored, in one change: its rows, and the rings that it closes.

        Transfers get ids after all others, and the new rings findings after all others; what is stored of
        earlier loads stays. Tables of accounts and parties, which hold each of them once, are rebuilt. The other
        two detectors look at whole accounts and are run again by their own steps.
        """
        cfg, stage = self._detector(K.CIRCULAR_FLOW), self._staging()
        old = self.table("silver/transfers_to")
        last = old.agg(F.coalesce(F.max("fin_txn_id"), F.lit(0)).alias("last")).first()["last"]
        before = self.table("silver/finding") if exists(self.spark, f"{self.root}/silver/finding") else None
        with self._at_once():
            self._add("bronze/transactions_raw", txns)
            stored = self.spark.read.schema(schemas.TRANSACTIONS_RAW).parquet(self._changes[-1].fresh)
            if accounts is not None:
                self._add("bronze/accounts_raw", accounts)
            numbered = graph.number_transactions(stored, stage, last)
            new = stage(graph.transfers_to(numbered), "new-transfers")
            summaries = self._link_summaries(old, new, cfg, stage)
            self._together(
                lambda: self._add("silver/transfers_to", new),
                lambda: self._add("silver/financial_transaction", graph.financial_transactions(numbered)),
                lambda: self._add("silver/has_originating_account", graph.originating(numbered)),
                lambda: self._add("silver/has_beneficiary_account", graph.beneficiary(numbered)),
                lambda: self._add("label/txn_label", graph.txn_labels(numbered)),
            )
            self._build_parties(stage)
            rings = appended_rings.cycles_of_append(summaries, old, new, last, cfg, stage)
            if before is not None:
                rings = with_id_offset(rings, before)
            self._save_rings(rings, cfg, keep=before is not None)
        self._done(stage, new_rings=rings)

    def _link_summaries(self, old: DataFrame, new: DataFrame, cfg: Assessment, stage: Staging) -> DataFrame:
        """Those of the earlier loads, made once for a configuration; those of the new one are added to them."""
        path = f"{SUMMARIES}/{cfg.params['max_time_span_days']}-{cfg.params['min_amount']}"

        def summary(transfers: DataFrame) -> DataFrame:
            return circular_flow.link_summaries(circular_flow.ring_transfers(transfers, cfg))

        if exists(self.spark, f"{self.root}/{path}"):
            known = self.spark.read.option("recursiveFileLookup", True).parquet(f"{self.root}/{path}")
        else:
            known = stage(summary(old), "link-summaries")
            self._add(path, known)
        self._add(path, summary(new))
        return known

    # --- detectors -----------------------------------------------------------------

    @_tidy
    def save_config(self) -> None:
        """Upsert the assessment rows; known ones keep their created_at."""
        new = config_frame(self.spark, self.run_ts, list(self.assessments.values()))
        stage = self._staging()
        if exists(self.spark, f"{self.root}/silver/assessment_config"):
            new = stage(upsert_config(self.table("silver/assessment_config"), new), "config")
        self._save("silver/assessment_config", new.coalesce(1))
        stage.clear()
        self._open.remove(stage)

    def clear_findings(self) -> None:
        with self._at_once():
            self._changes.extend(Change(None, f"{self.root}/{name}") for name in FINDING_TABLES)

    def _save_findings(self, assessment_id: str, **tables: Callable[[], DataFrame]) -> None:
        """The three tables of one assessment, in one change."""

        def save(name: str) -> None:
            df = tables[name.split("/")[1]]()
            self._note(df, *write_fresh_partition(df, f"{self.root}/{name}", assessment_id, name))

        with self._at_once():
            self._together(*[lambda n=n: save(n) for n in FINDING_TABLES])

    def _with_ids(self, ranked: DataFrame, assessment_id: str) -> DataFrame:
        """Continue behind the ids of the other assessments."""
        if not exists(self.spark, f"{self.root}/silver/finding"):
            return ranked
        finding = self.table("silver/finding")
        return with_id_offset(ranked, finding.filter(finding.assessment_id != assessment_id))

    def _detector(self, assessment_id: str) -> Assessment:
        """The assessment, whose row a finding refers to: it is saved before the first findings."""
        finish(self.spark, self.root)
        if not exists(self.spark, f"{self.root}/silver/assessment_config"):
            self.save_config()
        return self.assessments[assessment_id]

    @_tidy
    def detect_circular_flow(self) -> None:
        cfg, stage = self._detector(K.CIRCULAR_FLOW), self._staging()
        rings = circular_flow.cycles(self.table("silver/transfers_to"), cfg, stage)
        rings = self._with_ids(rings, cfg.assessment_id)
        self._save_rings(rings, cfg)
        self._done(stage, rings=rings)

    def _save_rings(self, rings: DataFrame, cfg: Assessment, *, keep: bool = False) -> None:
        """Findings of rings, in place of those stored or, to `keep` them, beside them."""

        def made(name: str, df: DataFrame) -> DataFrame:
            return df.unionByName(self.table(f"silver/{name}").filter(F.col("assessment_id") == cfg.assessment_id)) if keep else df

        self._save_findings(
            cfg.assessment_id,
            finding=lambda: made("finding", circular_flow.findings(rings, cfg, self.run_ts)),
            finding_entity=lambda: made(
                "finding_entity",
                circular_flow.entities(rings, cfg, self.table("silver/has_account"), self.table("silver/is_held_at")),
            ),
            finding_edge=lambda: made("finding_edge", circular_flow.edges(rings, cfg)),
        )

    @_tidy
    def detect_mule_hub(self) -> None:
        cfg, stage = self._detector(K.MULE_HUB), self._staging()
        transfers = self.table("silver/transfers_to")
        pairs = stage(mule_hub.pair_totals(transfers), "pair-totals")
        hubs = self._with_ids(mule_hub.hubs(pairs, cfg, stage), cfg.assessment_id)
        found: dict[str, DataFrame] = {}

        def findings() -> DataFrame:
            # Only the finding itself names the currency; entities and edges need not wait for it.
            found["hubs"] = mule_hub.candidates(hubs, transfers, stage)
            return mule_hub.findings(found["hubs"], cfg, self.run_ts)

        self._save_findings(
            cfg.assessment_id,
            finding=findings,
            finding_entity=lambda: mule_hub.entities(
                hubs, pairs, cfg, self.table("silver/has_account"), self.table("silver/is_held_at")
            ),
            finding_edge=lambda: mule_hub.edges(hubs, transfers, cfg, stage),
        )
        self._done(stage, pair_totals=pairs, **found)

    @_tidy
    def detect_exposure(self) -> None:
        cfg, stage = self._detector(K.LAUNDERING_EXPOSURE), self._staging()
        labeled = exposure.labeled_edges(
            self.table("silver/transfers_to"), self.table("bronze/transactions_raw"), stage
        )
        exposed = self._with_ids(exposure.candidates(labeled, cfg, stage), cfg.assessment_id)
        self._save_findings(
            cfg.assessment_id,
            finding=lambda: exposure.findings(exposed, cfg, self.run_ts),
            finding_entity=lambda: exposure.entities(
                exposed, labeled, cfg, self.table("silver/has_account"), self.table("silver/is_held_at")
            ),
            finding_edge=lambda: exposure.edges(exposed, labeled, cfg),
        )
        self._done(stage, labeled=labeled, exposed=exposed)

    def run_detectors(self) -> None:
        """All three on an empty slate, so ids run through 1..n in assessment order."""
        self.save_config()
        self.clear_findings()
        self.detect_circular_flow()
        self.detect_mule_hub()
        self.detect_exposure()

    # --- gold ----------------------------------------------------------------------

    def publish(self) -> None:
        account, institution = self.table("silver/account"), self.table("silver/financial_institution")
        entity = publish.gold_entity(
            self.table("silver/finding_entity"),
            self.table("silver/party"),
            institution,
            account,
            self.table("silver/has_account"),
        )

        def entities_then_findings() -> None:
            self._save("gold/finding_entity", _by_finding(entity))
            published = publish.gold_finding(self.table("silver/finding"), self.table("gold/finding_entity"))
            self._save("gold/finding", _by_finding(published))

        edges = publish.gold_edge(self.table("silver/finding_edge"), account)
        with self._at_once():
            self._together(entities_then_findings, lambda: self._save("gold/finding_edge", _by_finding(edges)))

    def run(self, data_dir: str) -> None:
        self.load_csv(data_dir)
        self.build_silver()
        self.run_detectors()
        self.publish()
