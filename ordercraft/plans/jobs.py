"""The two jobs: staged (J13) and backfill.

``staged_plan`` / ``backfill_plan`` build every output as DataFrames (no writes to targets);
``run_staged`` / ``run_backfill`` run them against a ``TableStore``: steps that several outputs
read are written once as stage tables, only the buckets of a target that hold keys of the run are
read and rewritten, the refill table is written before the offers use it as their pointer view,
and all targets become current with one manifest.

Per-row commits of the source become one commit per run; the order loop becomes joins with
the order set (SURVEY 4.1 R1).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ordercraft.functions.scalars import ts_lit
from ordercraft.operators.checks import Check
from ordercraft.operators.errors import error_rows
from ordercraft.operators.ids import max_or
from ordercraft.operators.offers import (
    BACKFILL_SCOPE, STAGED_SCOPE, also_offers, opportunity_reset, opportunity_upsert,
)
from ordercraft.operators.orders import backfill_orders, staged_orders
from ordercraft.operators.refill import GRACE_DAYS, refill_candidates, refill_purge, refill_reset, refill_upsert
from ordercraft.session import materialize, run_folder, small_broadcasts
from ordercraft.sources.binding import Tables
from ordercraft.sources.lookup import few, of_orders
from ordercraft.sources.tables import State, TableStore, bucket_of, month_of

REFIL_SEQ = "refil_seq"
ERROR_SEQ = "error_seq"


def checkpoint_cut(df: DataFrame) -> DataFrame:
    """Lineage cut: a Parquet table in the session's shared checkpoint folder (survives executor loss)."""
    return materialize(df, "cut")


def packed_cut(df: DataFrame) -> DataFrame:
    """As ``checkpoint_cut``, for large steps: about half the disk, at some CPU time."""
    return materialize(df, "cut", compression="zstd")


@dataclass(frozen=True)
class Options:
    """Choices of a run.

    ``mode``: refill upsert, ``first_row`` (as the source) or ``per_row``. ``pair_on_rebuy``: strict pairing of refill
    rules (Q3). ``pointer_view``: the view (cf_id, cn_id, id_key) that offers point into (S3); by default the refreshed
    refill table. ``refill_checks``, ``opportunity_checks``: insert checks, by default the not-null ones.
    ``affinity``: (customers, as_of, scope) -> brands, by default read from all lines of the last 12 months.
    ``latest``: the customers' latest orders, by default read from all orders.
    """

    mode: str = "first_row"
    pair_on_rebuy: bool = False
    pointer_view: DataFrame | None = None
    refill_checks: list[Check] | None = None
    opportunity_checks: list[Check] | None = None
    affinity: Callable[[DataFrame, dt.datetime, list[str]], DataFrame] | None = None
    latest: DataFrame | None = None
    cut: Callable[[DataFrame], DataFrame] = checkpoint_cut


@dataclass
class RunOutput:
    refil: DataFrame
    opportunities: DataFrame
    quarantine: DataFrame
    driver: DataFrame
    new_errors_fn: Callable[[], DataFrame]
    current_errors: DataFrame
    extra: dict = field(default_factory=dict)

    @property
    def new_errors(self) -> DataFrame:
        """Error rows of this run; ids are assigned (an eager step) only when asked for."""
        return self.new_errors_fn()

    @property
    def errors(self) -> DataFrame:
        return self.current_errors.unionByName(self.new_errors)


def _per_order(rejected: DataFrame, contexts: DataFrame, scope: list[str]) -> DataFrame:
    """An error row per processed order and failing offer: the source tries a customer's offers for every order."""
    return contexts.select(*scope, "order_id").distinct().join(rejected, scope).select("order_id", "error_code", "error")


@dataclass
class Work:
    """What a run processes; nothing here depends on the targets."""

    driver: DataFrame
    candidates: DataFrame
    quarantine: DataFrame
    scope: list[str]
    start_date: dt.datetime | None = None  # of a backfill

    @property
    def contexts(self) -> DataFrame:
        return self.driver.select(F.col("profile_id").alias("cf_id"), *self.scope[1:], "order_id")

    @property
    def staged(self) -> bool:
        return self.start_date is None


def staged_work(t: Tables, as_of: dt.datetime, options: Options) -> Work:
    """J3 -> J5. The tables of a small batch are read by its order ids (``sources.lookup``)."""
    cut = options.cut
    staged = few(t.dcspp_order_item_stg.select("order_id"))
    t = t if staged is None else of_orders(t, staged)
    driver, q_orders = staged_orders(t, as_of, cut)
    driver = cut(driver)
    candidates, q_refill = refill_candidates(t, driver, as_of, cut, options.pair_on_rebuy)
    return Work(driver, cut(candidates), q_orders.unionByName(q_refill), STAGED_SCOPE)


def backfill_work(t: Tables, start_date: dt.datetime, as_of: dt.datetime, options: Options) -> Work:
    """J4 -> J5."""
    cut = options.cut
    driver = cut(backfill_orders(t, start_date, as_of))
    candidates, q_refill = refill_candidates(t, driver, as_of, cut, options.pair_on_rebuy)
    return Work(driver, cut(candidates), q_refill, BACKFILL_SCOPE, start_date)


def backfill_reset(
    t: Tables, refil: DataFrame, opportunities: DataFrame, driver: DataFrame, start_date: dt.datetime,
) -> tuple[DataFrame, DataFrame]:
    """Drop opportunities dated from ``start_date`` and reminders of orders submitted from it.

    Takes effect only when the backfill has orders to process: with none, the source's
    deletes are never committed (Q13).
    """
    if driver.isEmpty():
        return refil, opportunities
    return refill_reset(t, refil, start_date), opportunity_reset(opportunities, start_date)


def refill_step(
    t: Tables, work: Work, refil: DataFrame, as_of: dt.datetime, options: Options, base: int | None,
    others: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, int]:
    """J6, in a staged run then J7: ``(next_refil, rejected, last_id)`` of the rows ``refil``.

    No purge when no order passed the guards (Q12), nor in a backfill. ``others``: the rows of untouched buckets.
    """
    out, rejected, last_id = refill_upsert(
        refil, work.candidates, work.driver, base, options.mode, options.refill_checks, options.cut, others)
    if work.staged and not work.driver.isEmpty():
        out = refill_purge(out, as_of)
    return out, rejected, last_id


def offer_step(
    work: Work, offers: DataFrame, opportunities: DataFrame, view: DataFrame, options: Options, others: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(opportunities, quarantine, rejected)``."""
    view = view if options.pointer_view is None else options.pointer_view
    opps, q_offers, rejected = opportunity_upsert(
        opportunities, offers, view.select("cf_id", "cn_id", "id_key"), work.scope, work.staged,
        options.opportunity_checks, options.cut, others)
    return opps, q_offers, _per_order(rejected, work.contexts, work.scope)


def offers_of(t: Tables, work: Work, as_of: dt.datetime, options: Options) -> DataFrame:
    """J9 -> J10."""
    return options.cut(also_offers(t, work.contexts, as_of, work.scope, options.cut, options.affinity, options.latest))


def _plan(t: Tables, work: Work, as_of: dt.datetime, options: Options) -> RunOutput:
    refil0, opps0, base = t.cit_refil, t.cit_opportunities, None
    if not work.staged:
        refil0, opps0 = backfill_reset(t, refil0, opps0, work.driver, work.start_date)
        base = max_or(t.cit_refil, "id_key")  # ids never step back below deleted ones
    refil, rejected, _ = refill_step(t, work, refil0, as_of, options, base)
    offers = offers_of(t, work, as_of, options)
    opps, q_offers, opp_rejected = offer_step(work, offers, opps0, refil, options)
    return RunOutput(
        refil=refil,
        opportunities=opps,
        quarantine=work.quarantine.unionByName(q_offers),
        driver=work.driver,
        new_errors_fn=lambda: error_rows(
            t.cit_opp_errors, {"R": rejected, "A": opp_rejected}, as_of, None, options.cut)[0],
        current_errors=t.cit_opp_errors,
        extra={"candidates": work.candidates, "offers": offers},
    )


def staged_plan(t: Tables, as_of: dt.datetime, options: Options = Options()) -> RunOutput:
    """J13 as DataFrames, without writes to the targets."""
    return _plan(t, staged_work(t, as_of, options), as_of, options)


def backfill_plan(t: Tables, start_date: dt.datetime, as_of: dt.datetime, options: Options = Options()) -> RunOutput:
    """J14 as DataFrames, without writes to the targets."""
    return _plan(t, backfill_work(t, start_date, as_of, options), as_of, options)


def purged_pieces(store: TableStore, state: State, pieces: list[str], as_of: dt.datetime) -> list[str]:
    """J7 on stored pieces of the refill table: the pieces that are left, those of the edge month rewritten.

    Pieces of months before the edge month are dropped unread, later ones are named again unread. Of the edge month only
    the buckets that hold an expired row are rewritten.
    """
    edge = f"{as_of - dt.timedelta(days=GRACE_DAYS):%Y%m}"
    kept = [p for p in pieces if month_of(p) is None or month_of(p) > edge]
    at_edge = [p for p in pieces if month_of(p) == edge]
    expired = store.read_pieces("cit_refil", at_edge).where(F.col("expiration") < ts_lit(as_of - dt.timedelta(days=GRACE_DAYS)))
    hit = store.touched(expired, "cit_refil", state) if at_edge else set()
    rewritten = [p for p in at_edge if bucket_of(p) in hit]
    fresh = store.write("cit_refil", refill_purge(store.read_pieces("cit_refil", rewritten), as_of), state) if rewritten else []
    return kept + [p for p in at_edge if bucket_of(p) not in hit] + fresh


def _commit(
    store: TableStore, t: Tables, as_of: dt.datetime, options: Options, batch: int | None, make_work: Callable[[Tables], Work],
) -> int:
    """Rewrite the touched buckets of the targets, the refill table first (the offers point into it); commit all at once."""
    state = store.state()
    if batch is not None and state.batch is not None and batch <= state.batch:
        return state.run  # a replayed batch that was committed before

    def base(sequence: str, table: str, column: str) -> int:
        return state.sequences[sequence] if sequence in state.sequences else max_or(store.read(table, state), column)

    with run_folder(store.spark), small_broadcasts(store.spark):
        work = make_work(t)
        processes = not work.driver.isEmpty()
        offers = offers_of(t, work, as_of, options)

        touched = {"cit_refil": store.touched(work.candidates, "cit_refil", state),
                   "cit_opportunities": store.touched(offers, "cit_opportunities", state)}
        if processes and not work.staged:  # the buckets of rows that the reset drops
            refil, opps = store.read("cit_refil", state), store.read("cit_opportunities", state)
            started = t.dcspp_order.where(F.col("submitted_date") >= ts_lit(work.start_date)).select("order_id")
            touched["cit_refil"] |= store.touched(refil.join(started, "order_id", "left_semi"), "cit_refil", state)
            touched["cit_opportunities"] |= store.touched(
                opps.where(F.col("order_date") >= ts_lit(work.start_date)), "cit_opportunities", state)
        every = set(range(state.buckets))
        now = {name: store.read(name, state, b) for name, b in touched.items()}
        rest = {name: store.read(name, state, every - b) for name, b in touched.items()}
        if not work.staged:
            now["cit_refil"], now["cit_opportunities"] = backfill_reset(
                t, now["cit_refil"], now["cit_opportunities"], work.driver, work.start_date)

        refil, rejected, last_id = refill_step(
            t, work, now["cit_refil"], as_of, options, base(REFIL_SEQ, "cit_refil", "id_key"), rest["cit_refil"])
        fresh = store.write("cit_refil", refil, state)
        old = store.swapped("cit_refil", state, touched["cit_refil"], [])
        refil_pieces = (purged_pieces(store, state, old, as_of) if work.staged and processes else old) + fresh
        opps, q_offers, opp_rejected = offer_step(
            work, offers, now["cit_opportunities"], store.read_pieces("cit_refil", refil_pieces), options, rest["cit_opportunities"])
        tables = {
            "cit_refil": refil_pieces,
            "cit_opportunities": store.swapped(
                "cit_opportunities", state, touched["cit_opportunities"], store.write("cit_opportunities", opps, state)),
        }
        error_base = base(ERROR_SEQ, "cit_opp_errors", "id")
        errors, error_id = error_rows(
            store.read("cit_opp_errors", state), {"R": rejected, "A": opp_rejected}, as_of, error_base, options.cut)
        if error_id > error_base:
            tables["cit_opp_errors"] = state.tables.get("cit_opp_errors", []) + store.write("cit_opp_errors", errors, state)
        quarantine = options.cut(work.quarantine.unionByName(q_offers))
        if not quarantine.isEmpty():
            tables["quarantine"] = state.tables.get("quarantine", []) + store.write("quarantine", quarantine, state)
        return store.commit(state, tables, {REFIL_SEQ: last_id, ERROR_SEQ: error_id}, batch)


def run_staged(
    t: Tables, as_of: dt.datetime, store: TableStore, options: Options = Options(), batch: int | None = None,
) -> int:
    """Run J13 and commit: the touched buckets of the refill and opportunity tables, further error and quarantine rows.

    Returns the number of the committed run. ``batch`` numbers the batches of a stream; one that is committed already is
    skipped. Raises ``StaleRun`` if another run was committed meanwhile; the run can then be repeated.
    """
    return _commit(store, t, as_of, options, batch, lambda tt: staged_work(tt, as_of, options))


def run_backfill(
    t: Tables, start_date: dt.datetime, as_of: dt.datetime, store: TableStore, options: Options = Options(),
) -> int:
    """Run J14 from ``start_date`` and commit, like ``run_staged``."""
    return _commit(store, t, as_of, options, None, lambda tt: backfill_work(tt, start_date, as_of, options))
