"""Rings A -> B -> ... -> A of a set number of hops: close in time, one currency, similar amounts.

A direct self-join of the transfers pairs every incoming with every outgoing transfer
of an account, which explodes at busy accounts. Instead:

1. Only accounts that both pay and receive in a time window can be in a ring; transfers
   between such accounts are reduced to *links* (currency, window, from, to) with the
   range of their times and amounts, so repeated transfers collapse.
2. Every link hangs on its less busy end. Each ring has exactly one least busy account,
   so two links hanging on the same account plus one closing link find it once, and a
   busy account is never the centre of a pairing: of n transfers in a window, an account
   has at most sqrt(2n) busier neighbours.
3. The few link triangles whose ranges could hold a ring pick the transfers to look at,
   and only these are joined into rings with the exact conditions.

Three hops are the configured case. Other numbers take the same way, with cycles of links in place of
triangles: two half-paths leave the busiest account of the cycle, one along and one against the links,
and meet in the middle, so that a busy account is only ever an end. Before that, links that no closed
walk of so many steps can use are peeled off (`operators/cyclic_core.py`) where half-paths would be many.

Steps 1 and 2 only rule out what cannot be a ring; step 3 decides.
"""

from __future__ import annotations

import functools
import itertools
import math
import operator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtrail import constants as K
from ringtrail.config import Assessment
from ringtrail.functions.columns import rounded_ratio, whole_hours
from ringtrail.functions.membership import may_occur
from ringtrail.functions.ranking import global_rank
from ringtrail.operators.cyclic_core import cyclic_core
from ringtrail.operators.findings import (
    account_entities,
    edge_rows,
    entity_rows,
    finding_rows,
    owners_and_banks,
    stats,
)
from ringtrail.staging import Staging

# Cells of the last joins, see _cells; rings with no more pairs of candidates than this need none.
BANDS, SLICES = 8, 4
COARSE_PAIRS = 10_000
# Links are peeled before half-paths are formed if there are more two-step paths than this for each.
PATHS_PER_LINK = 10
# Rings are looked for among transfers if these form no more two-step paths than this for each one of links.
PATHS_PER_LINK_PATH = 4
# An account with a larger share of the rows than 1 / this is counted on its own.
BUSY_SHARE = 1000
RANGES = ["t_min", "t_max", "first_min", "first_max", "a_min", "a_max"]


def letters(hops: int) -> list[str]:
    """Names of the accounts of a ring in travel order."""
    return list("abcdefghijklmnopqrstuvwxyz"[:hops])


def ring_columns(hops: int) -> list[str]:
    per_hop = [[f"{name}{n}" for n in range(1, hops + 1)] for name in ("ts_hop", "amt_hop", "pf_hop")]
    ids = [f"hop{n}_id" for n in range(1, hops + 1)]
    accounts = [f"acct_{c}" for c in letters(hops)]
    return [*ids, *accounts, *per_hop[0], *per_hop[1], "currency", *per_hop[2], "amt_min", "amt_max"]


def _hops(cfg: Assessment) -> int:
    hops = int(cfg.params["hops"])
    if not 2 <= hops <= 26 or not cfg.params["same_currency"]:
        raise ValueError("circular flow is defined for two to 26 hops in one currency")
    if cfg.params["min_amount"] < 0:
        raise ValueError("circular flow is defined for amounts above zero: min_amount must not be negative")
    return hops


def _days(cfg: Assessment) -> int:
    return int(cfg.params["max_time_span_days"])


def _most(*columns: Column) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def _least(*columns: Column) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def _ratio(cfg: Assessment) -> Column:
    return F.lit(cfg.params["max_amount_ratio"])


def ring_transfers(transfers: DataFrame, cfg: Assessment) -> DataFrame:
    """Transfers that may be a hop: no dust, no self-transfers. `bucket` numbers the
    stretches of max_time_span_days, so a ring starting in bucket w ends by bucket w + 1."""
    _hops(cfg)
    day = F.unix_date(F.col("event_timestamp").cast("date"))
    return transfers.filter(
        (F.col("amount") > F.lit(cfg.params["min_amount"]))
        & (F.col("from_account_key") != F.col("to_account_key"))
    ).select(
        "currency",
        F.floor(day / F.lit(_days(cfg))).alias("bucket"),
        F.col("from_account_key").alias("src"),
        F.col("to_account_key").alias("dst"),
        "fin_txn_id",
        F.col("event_timestamp").alias("ts"),
        "amount",
        "payment_format",
    )


def _account(end: str) -> Column:
    """A number for an account in a currency."""
    return F.xxhash64("currency", end)


def as_links(hops: DataFrame) -> DataFrame:
    """Each transfer as a link of its own: `n` transfers, the range of their times and of their amounts in
    whole units, rounded down."""
    units = F.floor("amount").cast("long")
    return hops.select(
        "currency", "bucket", "src", "dst", F.lit(1).alias("n"),
        F.col("ts").alias("t_min"), F.col("ts").alias("t_max"), units.alias("a_min"), units.alias("a_max"),
    )


def link_summaries(hops: DataFrame) -> DataFrame:
    """One row per currency, bucket and ordered pair of accounts. Summaries of several loads may stand side
    by side: what is made of them adds counts and joins ranges."""
    return as_links(hops).groupBy("currency", "bucket", "src", "dst").agg(
        F.sum("n").alias("n"), F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"),
        F.min("a_min").alias("a_min"), F.max("a_max").alias("a_max"),
    )


def activity(links: DataFrame) -> DataFrame:
    """How busy each account is in the two windows a bucket belongs to, from `as_links` or `link_summaries`.

    Window w covers buckets w and w + 1. `here` counts an account's transfers in the
    window starting with the bucket, `before` in the one ending with it; NULL where the
    account does not both pay and receive. Rows are counted per bucket first, so what is
    ordered per account is one row per bucket, however many transfers it has. The rows of an account
    meet in one shuffle for both, but for the few busy ones, which are counted before any.

    `acct` is a hash of currency and account. Should two ever share one, both count as busy as the
    two together, which rules out less and changes no ring.
    """
    ends = [
        F.struct(_account(end).alias("acct"), (F.col("n") * pays).alias("pays"), (F.col("n") * (1 - pays)).alias("gets"))
        for end, pays in (("src", 1), ("dst", 0))
    ]
    rows = links.select("bucket", F.inline(F.array(*ends)))
    busy_ones = F.col("acct").isin(busy_accounts(rows))
    parts = [rows.filter(~busy_ones).repartition("acct"), rows.filter(busy_ones)]
    return functools.reduce(DataFrame.unionByName, [_activity(part) for part in parts])


def busy_accounts(rows: DataFrame) -> list[int]:
    """The numbers of the accounts with more than 1 / BUSY_SHARE of the rows, fewer than BUSY_SHARE of them.

    A sketch of frequent items finds every such account; how exact its counts are decides no result.
    """
    top = F.expr(f"approx_top_k(acct, {BUSY_SHARE}, {10 * BUSY_SHARE})")
    found = rows.agg(F.count("acct").alias("n"), top.alias("top")).first()
    return [item["item"] for item in found["top"] or [] if item["count"] * BUSY_SHARE > found["n"]]


def _activity(rows: DataFrame) -> DataFrame:
    """`activity` of rows that are all there are of their accounts."""
    counts = rows.groupBy("acct", "bucket").agg(F.sum("pays").alias("pays"), F.sum("gets").alias("gets"))
    by_bucket = Window.partitionBy("acct").orderBy("bucket")

    def busy(neighbour: Column, distance: int) -> Column:
        """Own and neighbouring bucket together, if the neighbour really is adjacent."""
        adjacent = neighbour["bucket"] == F.col("bucket") + distance
        pays, gets = (F.col(c) + F.coalesce(F.when(adjacent, neighbour[c]), F.lit(0)) for c in ("pays", "gets"))
        return F.when(F.least(pays, gets) > 0, pays + gets)

    row = F.struct("bucket", "pays", "gets")
    return (
        counts.withColumns({"next": F.lead(row).over(by_bucket), "previous": F.lag(row).over(by_bucket)})
        .select(
            "bucket",
            "acct",
            busy(F.col("next"), 1).alias("here"),
            busy(F.col("previous"), -1).alias("before"),
        )
        .filter(F.col("here").isNotNull() | F.col("before").isNotNull())
    )


def hung_links(links: DataFrame, active: DataFrame, *, keep_busy: bool = False) -> DataFrame:
    """One row per currency, window and ordered pair of active accounts.

    `r` holds the ranges: times and amounts of the pair's transfers in the window, and
    as `first_*` the times of those in bucket w, the only ones that may start a ring of
    this window. Amounts are widened to whole units before the shuffles, which keeps the
    ranges valid and the rows small. `hangs_on_src` marks the less busy end; `keep_busy` keeps
    how busy both are and the number `n` of transfers. A column `fresh` of `links` comes back in `r`: whether
    any of them is.
    """
    flags = ["fresh"] if "fresh" in links.columns else []
    number = ["n"] if keep_busy else []

    def of(end: str) -> DataFrame:
        return active.withColumnsRenamed({"acct": f"{end}_acct", "here": f"{end}_here", "before": f"{end}_before"})

    windows = F.array(
        *[
            F.struct(w.alias("w"), F.col(f"src_{which}").alias("src_busy"), F.col(f"dst_{which}").alias("dst_busy"))
            for w, which in ((F.col("bucket"), "here"), (F.col("bucket") - 1, "before"))
        ]
    )
    at_start = F.col("w") == F.col("bucket")
    return (
        links.select(
            "currency", "bucket", "src", "dst", "t_min", "t_max", "a_min", "a_max", *flags, *number,
            _account("src").alias("src_acct"), _account("dst").alias("dst_acct"),
        )
        .join(of("src"), ["bucket", "src_acct"])
        .join(of("dst"), ["bucket", "dst_acct"])
        .drop("src_acct", "dst_acct")
        .select("currency", "bucket", "src", "dst", "t_min", "t_max", "a_min", "a_max", *flags, *number, F.inline(windows))
        .filter(F.col("src_busy").isNotNull() & F.col("dst_busy").isNotNull())
        .groupBy("currency", "w", "src", "dst", "src_busy", "dst_busy")
        .agg(
            F.min("t_min").alias("t_min"),
            F.max("t_max").alias("t_max"),
            F.min(F.when(at_start, F.col("t_min"))).alias("first_min"),
            F.max(F.when(at_start, F.col("t_max"))).alias("first_max"),
            F.min("a_min").alias("a_min"),
            (F.max("a_max") + 1).alias("a_max"),
            *[F.max(flag).alias(flag) for flag in flags],
            *[F.sum(c).alias(c) for c in number],
        )
        .select(
            "currency",
            "w",
            "src",
            "dst",
            F.struct(*RANGES, *flags).alias("r"),
            (F.struct("src_busy", "src") < F.struct("dst_busy", "dst")).alias("hangs_on_src"),
            *(["src_busy", "dst_busy", *number] if keep_busy else []),
        )
    )


def links_of_active(links: DataFrame, active: DataFrame, stage: Staging) -> DataFrame:
    """`links` without most of those that `hung_links` drops as an end is not active."""
    ends = [F.struct("bucket", _account(end).alias("acct")) for end in ("src", "dst")]
    return may_occur(links, ends, active, F.struct("bucket", "acct"), stage)


def _compatible(one: str, other: str, cfg: Assessment) -> Column:
    """Whether two ranges can hold transfers of one ring: amounts within the allowed ratio,
    times within the allowed span."""
    days = F.lit(timedelta(days=_days(cfg)))
    return (
        (F.col(f"{one}.a_min") <= _ratio(cfg) * F.col(f"{other}.a_max"))
        & (F.col(f"{other}.a_min") <= _ratio(cfg) * F.col(f"{one}.a_max"))
        & (F.col(f"{one}.t_min") <= F.col(f"{other}.t_max") + days)
        & (F.col(f"{other}.t_min") <= F.col(f"{one}.t_max") + days)
    )


def link_triangles(hung: DataFrame, cfg: Assessment, stage: Staging | None = None) -> DataFrame:
    """Directed link triangles v1 -> v2 -> v3 -> v1 with the ranges r1 to r3, each once, v1 being the least busy.

    Few open pairs fit each other: with a `stage`, only links that may close one of them are shuffled.
    """
    at = ["currency", "w"]
    leaving = hung.filter("hangs_on_src").select(
        *at, F.col("src").alias("v1"), F.col("dst").alias("v2"), F.col("r").alias("r1")
    )
    entering = hung.filter(~F.col("hangs_on_src")).select(
        *at, F.col("dst").alias("v1"), F.col("src").alias("v3"), F.col("r").alias("r3")
    )
    closing = hung.select(*at, F.col("src").alias("v2"), F.col("dst").alias("v3"), F.col("r").alias("r2"))
    open_pairs = leaving.join(entering, [*at, "v1"]).filter((F.col("v2") != F.col("v3")) & _compatible("r1", "r3", cfg))
    ends = [*at, "v2", "v3"]
    if stage is not None:
        open_pairs = stage(open_pairs, "open-pairs")
        closing = may_occur(closing, [F.struct(*ends)], open_pairs, F.struct(*ends), stage)
    return open_pairs.join(closing, ends).filter(_compatible("r1", "r2", cfg) & _compatible("r2", "r3", cfg))


def _bounds(r: str) -> dict[str, Column]:
    """What a path of one link has to keep of its ranges `r`, see `_narrowed`."""
    return {
        "a_lo": F.col(f"{r}.a_min"), "a_hi": F.col(f"{r}.a_max"), "t_lo": F.col(f"{r}.t_min"), "t_hi": F.col(f"{r}.t_max"),
        "begin": F.col(f"{r}.t_max"), "end": F.col(f"{r}.t_min"), "falls": F.lit(0),
    }


def _narrowed(first: str, then: str) -> dict[str, Column]:
    """The bounds of two joined paths, in the direction of the links.

    Ranges fit each other pair by pair just if the largest lower end fits the smallest upper end, so
    four numbers stand for the ranges of a path. `begin` and `end` are the latest time of the first link and
    the earliest of the last one; `falls` counts the steps whose transfers cannot be in order.
    """
    falls = F.when(F.col(f"{first}.end") > F.col(f"{then}.begin"), 1).otherwise(0)
    return {
        "a_lo": F.greatest(f"{first}.a_lo", f"{then}.a_lo"), "a_hi": F.least(f"{first}.a_hi", f"{then}.a_hi"),
        "t_lo": F.greatest(f"{first}.t_lo", f"{then}.t_lo"), "t_hi": F.least(f"{first}.t_hi", f"{then}.t_hi"),
        "begin": F.col(f"{first}.begin"), "end": F.col(f"{then}.end"),
        "falls": F.col(f"{first}.falls") + F.col(f"{then}.falls") + falls,
    }


def _may_hold(bounds: Column, cfg: Assessment) -> Column:
    """Whether links with these bounds can be on one ring. Around a ring the time falls once, where it closes."""
    days = F.lit(timedelta(days=_days(cfg)))
    return (
        (bounds["a_lo"] <= _ratio(cfg) * bounds["a_hi"])
        & (bounds["t_lo"] <= bounds["t_hi"] + days)
        & (bounds["falls"] <= 1)
    )


def _struct(columns: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(name) for name, c in columns.items()])


def link_cycles(hung: DataFrame, cfg: Assessment, stage: Staging) -> DataFrame:
    """Directed cycles v1 -> ... -> vn -> v1 of links with the ranges r1 to rn, each once, v1 being the busiest.

    Half-paths leave v1 along and against the links, through less busy accounts only, and meet. They
    carry bounds alone; the ranges are looked up for the cycles that are left.
    """
    n, at = _hops(cfg), ["currency", "w"]
    along = -(-n // 2)
    root = F.struct("root_busy", "v1")

    def fresh(name: str, others: list[str]) -> Column:
        return functools.reduce(operator.and_, [F.col(name) != F.col(o) for o in ["v1", *others]])

    def grown(path: DataFrame, first: str, then: str) -> DataFrame:
        """The path with the bounds of both parts, if a ring can be on it."""
        joined = path.withColumn("both", _struct(_narrowed(first, then))).filter(_may_hold(F.col("both"), cfg))
        return joined.drop(first, then).withColumnRenamed("both", "p")

    links = hung.select(*at, "src", "dst", "src_busy", "dst_busy", "hangs_on_src", _struct(_bounds("r")).alias("p"))
    there = links.filter(~F.col("hangs_on_src")).select(
        *at, F.col("src").alias("v1"), F.col("src_busy").alias("root_busy"), F.col("dst").alias("v2"), "p"
    )
    for k in range(2, along + 1):
        step = links.select(*at, F.col("src").alias(f"v{k}"), F.col("dst").alias(f"v{k + 1}"), F.col("dst_busy").alias("busy"), F.col("p").alias("q"))
        there = grown(
            there.join(step, [*at, f"v{k}"]).filter(
                (F.struct("busy", f"v{k + 1}") < root) & fresh(f"v{k + 1}", [f"v{j}" for j in range(2, k + 1)])
            ).drop("busy"),
            "p", "q",
        )
    back = links.filter("hangs_on_src").select(
        *at, F.col("dst").alias("v1"), F.col("dst_busy").alias("root_busy"), F.col("src").alias(f"v{n}"), "p"
    )
    for k in range(n - 1, along, -1):
        step = links.select(*at, F.col("dst").alias(f"v{k + 1}"), F.col("src").alias(f"v{k}"), F.col("src_busy").alias("busy"), F.col("p").alias("q"))
        back = grown(
            back.join(step, [*at, f"v{k + 1}"]).filter(
                (F.struct("busy", f"v{k}") < root) & fresh(f"v{k}", [f"v{j}" for j in range(k + 1, n + 1)])
            ).drop("busy"),
            "q", "p",
        )
    back = back.drop("root_busy").withColumnRenamed("p", "q")
    met = there.drop("root_busy").join(back, [*at, "v1", f"v{along + 1}"])
    others = [F.col(f"v{i}") != F.col(f"v{j}") for i in range(2, along + 1) for j in range(along + 2, n + 1)]
    if others:
        met = met.filter(functools.reduce(operator.and_, others))
    closing = F.when(F.col("p.end") > F.col("p.begin"), 1).otherwise(0)
    met = grown(met, "p", "q").filter(F.col("p.falls") + closing <= 1)
    nodes = [f"v{k}" for k in range(1, n + 1)]
    met = stage(met.select(*at, *nodes), "link-cycles")
    ends = F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in zip(nodes, [*nodes[1:], "v1"], strict=True)])
    used = met.select(*at, F.inline(ends)).distinct()
    ranges = stage(hung.join(used, [*at, "src", "dst"], "left_semi").select(*at, "src", "dst", "r"), "cycle-links")
    for k, (a, b) in enumerate(zip(nodes, [*nodes[1:], "v1"], strict=True), 1):
        met = met.join(ranges.select(*at, F.col("src").alias(a), F.col("dst").alias(b), F.col("r").alias(f"r{k}")), [*at, a, b])
    return met


def hop_searches(found: DataFrame, cfg: Assessment) -> DataFrame:
    """What to look for: per possible ring a, b, ... and hop, the pair, bucket and ranges.

    Chronology decides which account is a, so all rotations are tried.
    """
    n = _hops(cfg)
    days = F.lit(timedelta(days=_days(cfg)))
    nodes, ranges = letters(n), [f"p{k}" for k in range(1, n + 1)]
    turns = [
        F.struct(
            *[F.col(f"v{(k + turn) % n + 1}").alias(name) for k, name in enumerate(nodes)],
            *[F.col(f"r{(k + turn) % n + 1}").alias(name) for k, name in enumerate(ranges)],
        )
        for turn in range(n)
    ]
    rotated = found.select("currency", "w", F.explode(F.array(*turns)).alias("ring")).select("currency", "w", "ring.*")

    def c(name: str) -> Column:
        return F.col(name)

    latest_start = c("p1.first_max") + days
    later = range(2, n + 1)
    fits = [c("p1.first_min").isNotNull()]
    fits += [c("p1.first_min") <= c(f"p{k}.t_max") for k in later]
    fits += [c(f"p{k}.t_min") <= latest_start for k in later]
    fits += [c(f"p{j}.t_min") <= c(f"p{k}.t_max") for k in later for j in range(2, k)]
    possible = rotated.filter(functools.reduce(operator.and_, fits))

    def search(hop: int) -> Column:
        others = [f"p{k}" for k in range(1, n + 1) if k != hop]
        before = [c(f"p{k}.t_min") for k in range(2, hop)]
        after = [c(f"p{k}.t_max") for k in range(hop + 1, n + 1)]
        if hop == 1:
            t_lo = F.greatest(c("p1.first_min"), _most(*[c(f"{o}.t_min") for o in others]) - days)
            t_hi = F.least(c("p1.first_max"), *after)
        else:
            t_lo, t_hi = _most(c("p1.first_min"), *before), _least(latest_start, *after)
        return F.struct(
            F.lit(hop).alias("hop"),
            c(nodes[hop - 1]).alias("src"),
            c(nodes[hop % n]).alias("dst"),
            (F.array(c("w")) if hop == 1 else F.array(c("w"), c("w") + 1)).alias("buckets"),
            t_lo.alias("t_lo"),
            t_hi.alias("t_hi"),
            _most(*[c(f"{o}.a_min") for o in others]).alias("other_a_min"),
            _least(*[c(f"{o}.a_max") for o in others]).alias("other_a_max"),
        )

    searches = F.array(*[search(hop) for hop in range(1, n + 1)])
    return (
        possible.select("currency", "w", *nodes, F.explode(searches).alias("s"))
        .select("currency", "w", *nodes, "s.*")
        .withColumn("bucket", F.explode("buckets"))
        .drop("buckets")
    )


def candidate_hops(hops: DataFrame, searches: DataFrame, cfg: Assessment, stage: Staging) -> DataFrame:
    """Transfers that fit a search. `searches` is staged, so a short list is broadcast and
    the transfers are only scanned; a long one is joined on the pair and its bucket, with the
    transfers that may be on it."""
    pair = ["currency", "bucket", "src", "dst"]
    return (
        may_occur(hops, [F.struct(*pair)], searches, F.struct(*pair), stage)
        .join(searches, pair)
        .filter(
            F.col("ts").between(F.col("t_lo"), F.col("t_hi"))
            & (F.col("amount") <= _ratio(cfg) * F.col("other_a_max"))
            & (F.col("other_a_min") <= _ratio(cfg) * F.col("amount"))
        )
        .select("currency", "w", *letters(_hops(cfg)), "hop", "fin_txn_id", "ts", "amount", "payment_format")
    )


def _cells(lo: Column, hi: Column, amount_lo: Column, amount_hi: Column, cfg: Assessment) -> Column:
    """The cells that a span of times and amounts reaches, as an array of (band, slice).

    A band is 1 / BANDS of the allowed ratio, a slice 1 / SLICES of the allowed span. Rings with
    few candidates have one cell, number 0, for everything.
    """
    bands = F.sequence(_band(amount_lo, cfg, -1e-6), _band(amount_hi, cfg, 1e-6))
    slices = F.sequence(_slice(lo, cfg), _slice(hi, cfg))
    fine = F.flatten(
        F.transform(bands, lambda b: F.transform(slices, lambda t: F.struct(b.alias("band"), t.alias("slice"))))
    )
    one = F.array(F.struct(F.lit(0).cast("long").alias("band"), F.lit(0).cast("long").alias("slice")))
    empty = (lo > hi) | (amount_lo > amount_hi)
    return F.when(empty, F.filter(one, lambda _: F.lit(False))).when(F.col("fine"), fine).otherwise(one)


def _band(amount: Column, cfg: Assessment, slack: float = 0.0) -> Column:
    width = math.log(float(cfg.params["max_amount_ratio"])) / BANDS
    return F.floor(F.ln(amount.cast("double")) / F.lit(width) + F.lit(slack))


def _slice(ts: Column, cfg: Assessment) -> Column:
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.floor(F.timestamp_diff("SECOND", start, ts) / F.lit(_days(cfg) * 86400 // SLICES))


def _reach(known: list[Column], hop: Column, cfg: Assessment) -> dict[str, Column]:
    """Times and amounts that a hop may have, given other hops of its ring."""
    days = F.lit(timedelta(days=_days(cfg)))
    los = [F.when(k["hop"] < hop, k["ts"]).otherwise(k["ts"] - days) for k in known]
    his = [F.when(k["hop"] < hop, k["ts"] + days).otherwise(k["ts"]) for k in known]
    amounts = [k["amount"] for k in known]
    most, least = (F.greatest(*amounts), F.least(*amounts)) if len(known) > 1 else (amounts[0], amounts[0])
    many = len(known) > 1
    return {
        "t_lo": F.greatest(*los) if many else los[0],
        "t_hi": F.least(*his) if many else his[0],
        # Compared without a division, which would round.
        "top": most,
        "bottom": least,
    }


def assemble(candidates: DataFrame, cfg: Assessment, stage: Staging) -> DataFrame:
    """Rings with the exact conditions, from the candidate transfers of each possible ring.

    The hop with the fewest candidates goes first, the one with the most last. Where a ring has
    many, hops meet by cells of amount and time, so that next to no pairs are formed that break a
    condition, and the work of a busy ring spreads over tasks.
    """
    n = _hops(cfg)
    numbers = range(1, n + 1)
    ring = ["currency", "w", *letters(n)]
    turn_names = [f"turn{k}" for k in numbers]
    sizes = candidates.groupBy(*ring).agg(*[F.count_if(F.col("hop") == k).alias(f"n{k}") for k in numbers])
    by_size = F.array_sort(F.array(*[F.struct(F.col(f"n{k}").alias("n"), F.lit(k).alias("hop")) for k in numbers]))
    sizes = sizes.filter(functools.reduce(operator.and_, [F.col(f"n{k}") > 0 for k in numbers])).withColumn("o", by_size)
    turns = stage(
        sizes.select(
            *ring,
            *[F.col("o")[k]["hop"].alias(name) for k, name in enumerate(turn_names)],
            (F.col("o")[n - 2]["n"] * F.col("o")[n - 1]["n"] > COARSE_PAIRS).alias("fine"),
        ),
        "ring-sizes",
    )
    hop = F.struct("hop", "fin_txn_id", "ts", "amount", "payment_format")
    ranked = stage(
        candidates.join(turns, ring).select(*ring, *turn_names, "fine", hop.alias("h")), "ranked-candidates"
    )

    def of(turn: str, name: str) -> DataFrame:
        h = F.col("h")
        band = F.when(F.col("fine"), _band(h["amount"], cfg)).otherwise(F.lit(0))
        cut = F.when(F.col("fine"), _slice(h["ts"], cfg)).otherwise(F.lit(0))
        chosen = ranked.filter(h["hop"] == F.col(turn))
        return chosen.select(*ring, h.alias(name), band.alias("band"), cut.alias("slice"))

    def meet(left: DataFrame, known: list[str], turn: str, name: str) -> DataFrame:
        ratio = _ratio(cfg)
        reach = _reach([F.col(k) for k in known], F.col(turn), cfg)
        spread = left.withColumns(reach)
        cells = _cells(
            F.col("t_lo"), F.col("t_hi"),
            F.col("top").cast("double") / ratio.cast("double"), F.col("bottom").cast("double") * ratio.cast("double"), cfg,
        )
        spread = spread.select("*", F.inline(cells))
        amount, ts = F.col(name)["amount"], F.col(name)["ts"]
        return (
            spread.join(of(turn, name), [*ring, "band", "slice"])
            .filter(
                ts.between(F.col("t_lo"), F.col("t_hi"))
                & (F.greatest(F.col("top"), amount) <= ratio * F.least(F.col("bottom"), amount))
            )
            .drop("band", "slice", *reach)
        )

    found = ranked.filter(F.col("h")["hop"] == F.col("turn1")).withColumnRenamed("h", "x1")
    for k in range(2, n + 1):
        found = meet(found, [f"x{j}" for j in range(1, k)], f"turn{k}", f"x{k}")
    hops = F.array_sort(F.array(*[f"x{k}" for k in numbers]))
    found = found.select(*ring, *[hops[k - 1].alias(f"h{k}") for k in numbers])
    days = F.lit(timedelta(days=_days(cfg)))
    h = [F.col(f"h{k}") for k in numbers]
    amounts = [x["amount"] for x in h]
    in_order = [x["ts"] <= y["ts"] for x, y in itertools.pairwise(h)] + [h[-1]["ts"] <= h[0]["ts"] + days]
    made = {f"hop{k}_id": x["fin_txn_id"] for k, x in enumerate(h, 1)}
    made |= {f"acct_{c}": F.col(c) for c in letters(n)} | {"currency": F.col("currency")}
    for name, field in (("ts_hop", "ts"), ("amt_hop", "amount"), ("pf_hop", "payment_format")):
        made |= {f"{name}{k}": x[field] for k, x in enumerate(h, 1)}
    made |= {"amt_min": F.least(*amounts), "amt_max": F.greatest(*amounts)}
    return found.filter(functools.reduce(operator.and_, in_order)).select(*[made[c].alias(c) for c in ring_columns(n)])


def two_step_paths(hung: DataFrame) -> tuple[int, float, float]:
    """How many links there are, and how many two-step paths of links and of their transfers, of those that
    begin at the busier end of a link.

    It says what half-paths cost before one is formed; counted per node, with one row of sums.
    """
    weight = F.col("n") if "n" in hung.columns else F.lit(1)
    enters, none = (~F.col("hangs_on_src")).cast("long"), F.lit(0).cast("long")
    ends = [
        _struct({"node": F.col("dst"), "enter": enters, "leave": none, "enter_n": enters * weight, "leave_n": none}),
        _struct({"node": F.col("src"), "enter": none, "leave": none + 1, "enter_n": none, "leave_n": none + weight}),
    ]
    nodes = hung.select("currency", "w", F.inline(F.array(*ends))).groupBy("currency", "w", "node")
    counts = ["enter", "leave", "enter_n", "leave_n"]
    sums = nodes.agg(*[F.sum(c).alias(c) for c in counts]).agg(
        F.sum("leave").alias("links"),
        F.sum(F.col("enter").cast("double") * F.col("leave")).alias("paths"),
        F.sum(F.col("enter_n").cast("double") * F.col("leave_n")).alias("paths_n"),
    ).first()
    return sums["links"] or 0, sums["paths"] or 0.0, sums["paths_n"] or 0.0


def paths_per_link(hung: DataFrame) -> float:
    """How many two-step paths there are for each link, see `two_step_paths`."""
    links, paths, _ = two_step_paths(hung)
    return paths / links if links else 0.0


def thinly_linked(hung: DataFrame) -> bool:
    """Whether links hold so few transfers that transfers form hardly more paths than links do."""
    _, paths, of_transfers = two_step_paths(hung)
    return of_transfers <= PATHS_PER_LINK_PATH * paths


def transfer_rings(hops: DataFrame, cfg: Assessment, stage: Staging) -> DataFrame:
    """Rings with the exact conditions, from half-paths of transfers in place of links.

    Where accounts are densely linked by few transfers each, next to every cycle of links has ranges that could
    hold a ring. A path of transfers keeps its times and amounts, so it ends as soon as they break a condition.
    As in `link_cycles` both halves leave the busiest account, through less busy ones only. Accounts of
    a currency are numbered by how busy they are.
    """
    n = _hops(cfg)
    along = -(-n // 2)
    days, ratio = F.lit(timedelta(days=_days(cfg))), _ratio(cfg)
    ends = hops.select("currency", F.explode(F.array("src", "dst")).alias("account"))
    busy = ends.groupBy("currency", "account").agg(F.count(F.lit(1)).alias("busy"))
    number = global_rank(busy, ["busy", "currency", "account"], "number", stage).drop("busy")
    arcs = hops
    for end in ("src", "dst"):
        arcs = arcs.join(number.toDF(f"{end}_no", "currency", end), ["currency", end])
    arcs = stage(arcs.drop("dst"), "arcs")
    carried = {"id{}": "fin_txn_id", "ts{}": "ts", "amt{}": "amount", "pf{}": "payment_format", "acct{}": "src"}

    def hop(k: int, src: str, dst: str, rows: DataFrame, *also: str) -> DataFrame:
        ends = [F.col("src_no").alias(src), F.col("dst_no").alias(dst)]
        return rows.select("bucket", *also, *ends, *[F.col(c).alias(name.format(k)) for name, c in carried.items()])

    def kept(path: DataFrame, ks: list[int]) -> DataFrame:
        """Paths of the hops `ks` in travel order that a ring can hold: its times fall once around it."""
        ts, amounts = [F.col(f"ts{k}") for k in ks], [F.col(f"amt{k}") for k in ks]
        falls = [(a > b).cast("int") for a, b in zip(ts, [*ts[1:], ts[0]], strict=True)]
        return path.filter(
            (F.greatest(*amounts) <= ratio * F.least(*amounts))
            & (F.greatest(*ts) <= F.least(*ts) + days)
            & (functools.reduce(operator.add, falls) <= 1)
        )

    def other(name: str, known: list[str]) -> Column:
        """Less busy than the busiest account, and none of the path."""
        return functools.reduce(operator.and_, [F.col(name) != F.col(v) for v in known], F.col(name) < F.col("v1"))

    # `bucket` is the one of the hop at the busiest account: the others are in it or next to it.
    near = F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1))
    steps = arcs.withColumn("bucket", near)
    leaving = arcs.filter(F.col("src_no") > F.col("dst_no"))
    there = hop(1, "v1", "v2", leaving, "currency")
    for k in range(2, along + 1):
        there = there.join(hop(k, f"v{k}", f"v{k + 1}", steps), ["bucket", f"v{k}"])
        there = kept(there.filter(other(f"v{k + 1}", [f"v{j}" for j in range(2, k + 1)])), list(range(1, k + 1)))
    back = hop(n, f"v{n}", "v1", arcs.filter(F.col("dst_no") > F.col("src_no")))
    for k in range(n - 1, along, -1):
        back = back.join(hop(k, f"v{k}", f"v{k + 1}", steps), ["bucket", f"v{k + 1}"])
        back = kept(back.filter(other(f"v{k}", [f"v{j}" for j in range(k + 1, n + 1)])), list(range(k, n + 1)))
    met = there.join(back.withColumn("bucket", near), ["bucket", "v1", f"v{along + 1}"])
    apart = [F.col(f"v{i}") != F.col(f"v{j}") for i in range(2, along + 1) for j in range(along + 2, n + 1)]
    met = kept(met.filter(functools.reduce(operator.and_, apart, F.lit(True))), list(range(1, n + 1)))
    # Of hops at one time more than one may be the first.
    made = {"hop{}_id": "id", "ts_hop{}": "ts", "amt_hop{}": "amt", "pf_hop{}": "pf"}
    turns = []
    for turn in range(n):
        ks = [(k + turn) % n + 1 for k in range(n)]
        in_order = [F.col(f"ts{a}") <= F.col(f"ts{b}") for a, b in itertools.pairwise(ks)]
        ring = {name.format(at): F.col(f"{c}{k}") for at, k in enumerate(ks, 1) for name, c in made.items()}
        ring |= {f"acct_{c}": F.col(f"acct{k}") for c, k in zip(letters(n), ks, strict=True)}
        turns.append(F.when(functools.reduce(operator.and_, in_order), _struct(ring)))
    amounts = [f"amt{k}" for k in range(1, n + 1)]
    rings = met.select(
        "currency", F.least(*amounts).alias("amt_min"), F.greatest(*amounts).alias("amt_max"),
        F.inline(F.array_compact(F.array(*turns))),
    )
    return rings.select(*ring_columns(n))


def possible_cycles(hung: DataFrame, cfg: Assessment, stage: Staging, peel: bool | None = None) -> DataFrame:
    """Cycles of links that could hold a ring.

    `peel` reduces the links to their cyclic core first; by default where the half-paths would be many times
    the links, and never for three hops, whose triangles are found from the less busy ends in one join.
    """
    n = _hops(cfg)
    if n > 3 and paths_per_link(hung) > PATHS_PER_LINK if peel is None else peel:
        hung = stage(cyclic_core(hung, n, stage), "core-links")
    return link_triangles(hung, cfg, stage) if n == 3 else link_cycles(hung, cfg, stage)


def cycles(transfers: DataFrame, cfg: Assessment, stage: Staging, peel: bool | None = None) -> DataFrame:
    """All rings, with finding_id by time of the first hop and then by transfer ids.

    Those of more than three hops are looked for among the transfers where links hold few of them each, unless
    `peel` says how to treat the links.
    """
    n = _hops(cfg)
    hops = ring_transfers(transfers, cfg)
    links = as_links(hops)
    active = stage(activity(links), "activity")
    hung = stage(hung_links(links_of_active(links, active, stage), active, keep_busy=n != 3), "hung-links")
    if n > 3 and peel is None and thinly_linked(hung):
        rings = transfer_rings(links_of_active(hops, active, stage), cfg, stage)
    else:
        found = possible_cycles(hung, cfg, stage, peel)
        searches = stage(hop_searches(found, cfg), "hop-searches")
        rings = assemble(stage(candidate_hops(hops, searches, cfg, stage), "candidate-hops"), cfg, stage)
    order = ["ts_hop1", *[f"hop{k}_id" for k in range(1, n + 1)]]
    return global_rank(rings, order, "finding_id", stage)


def closable_paths(rings: DataFrame) -> DataFrame:
    """Two-hop paths that some later transfer closes, with the number of closing transfers."""
    return rings.groupBy(
        "hop1_id", "hop2_id", "acct_a", "acct_b", "acct_c", "currency", "ts_hop1", "ts_hop2"
    ).agg(F.count(F.lit(1)).alias("closing_transfers"))


def findings(rings: DataFrame, cfg: Assessment, run_ts: datetime) -> DataFrame:
    n = _hops(cfg)
    accounts, formats = [f"acct_{c}" for c in letters(n)], [f"pf_hop{k}" for k in range(1, n + 1)]
    one_format = functools.reduce(operator.and_, [F.col(x) == F.col(y) for x, y in itertools.pairwise(formats)])
    tight = F.col("amt_max") <= F.lit(K.RING_HIGH_MAX_RATIO).cast("decimal(10,4)") * F.col("amt_min")
    hours = whole_hours("ts_hop1", f"ts_hop{n}")
    # Fixed texts: title and description as they appear in a finding.
    title = F.concat(
        F.lit(f"{n}-hop circular fund flow: "),
        F.concat_ws(" -> ", *accounts, accounts[0]),
    )
    description = F.concat(
        F.lit(f"Ring of {n} distinct accounts returning funds to origin over "),
        hours.cast("string"),
        F.lit(" hours. Amount range "),
        F.col("amt_min").cast("string"),
        F.lit("-"),
        F.col("amt_max").cast("string"),
        F.lit(" "),
        F.col("currency"),
        F.lit("."),
    )
    return finding_rows(
        rings,
        cfg,
        run_ts,
        severity=F.when(one_format & tight, "HIGH").otherwise("MEDIUM"),
        title=title,
        description=description,
        summary=stats(
            hops=F.lit(n),
            currency=F.col("currency"),
            amount_min=F.col("amt_min"),
            amount_max=F.col("amt_max"),
            amount_ratio=rounded_ratio("amt_max", "amt_min"),
            time_span_hours=hours,
            payment_formats=F.array(*formats),
            accounts=F.array(*accounts),
        ),
        trigger="ts_hop1",
    )


def entities(rings: DataFrame, cfg: Assessment, has_account: DataFrame, is_held_at: DataFrame) -> DataFrame:
    """Ring accounts, their owners and their banks, each once per finding."""
    accounts = F.array(*[f"acct_{c}" for c in letters(_hops(cfg))])
    members = rings.select("finding_id", F.explode(accounts).alias("account_key"))
    context = owners_and_banks(members, has_account, is_held_at)
    accounts = account_entities(members, "account_key", F.lit(K.RING_MEMBER))
    return entity_rows(accounts.unionByName(context).distinct(), cfg)


def edges(rings: DataFrame, cfg: Assessment) -> DataFrame:
    """The hops of each ring in travel order."""
    accounts = [f"acct_{c}" for c in letters(_hops(cfg))]
    route = zip(accounts, [*accounts[1:], accounts[0]], strict=True)
    hops = [
        F.struct(
            F.lit(n).alias("hop_order"),
            F.col(src).alias("src"),
            F.col(dst).alias("dst"),
            F.col(f"hop{n}_id").alias("fin_txn_id"),
            F.col(f"amt_hop{n}").alias("amount"),
            F.col(f"ts_hop{n}").alias("event_timestamp"),
            F.col(f"pf_hop{n}").alias("payment_format"),
        )
        for n, (src, dst) in enumerate(route, start=1)
    ]
    return edge_rows(rings.select("finding_id", "currency", F.inline(F.array(*hops))), cfg)
