"""Which orders a run processes: staged (J3) and backfill (J4), plus order quarantine (Q4, Q5).

The source loops over a cursor of orders and re-reads each order's payment group
and consultant; here the same checks are counts joined back once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ordercraft.functions.scalars import months_cutoff, ts_lit
from ordercraft.sources.binding import Tables

# Fixed values of the jobs: order and payment states.
SUBMITTED = "SUBMITTED"
NO_PENDING_ACTION = "NO_PENDING_ACTION"
SETTLED = "SETTLED"
STAGED_STATES = (SUBMITTED,)
ACTIVE_STATES = (SUBMITTED, NO_PENDING_ACTION)

REASON_PAY_GROUPS = "several payment groups"
REASON_CONSULTANTS = "several consultant rows"


def settled_order_ids(t: Tables) -> DataFrame:
    """Orders with at least one settled payment group (an existence join, N14)."""
    return t.dcspp_pay_group.where(F.col("state") == SETTLED).select(F.col("order_ref").alias("order_id"))


def _orders_in(t: Tables, states: tuple[str, ...]) -> DataFrame:
    return t.dcspp_order.where(F.col("state").isin(*states)).select(
        "order_id", "state", "submitted_date", "profile_id")


def staged_base(t: Tables) -> DataFrame:
    """Submitted, settled and staged orders, before the per-order guards."""
    return (
        _orders_in(t, STAGED_STATES)
        .join(settled_order_ids(t), "order_id", "left_semi")
        .join(t.dcspp_order_item_stg.select("order_id"), "order_id", "left_semi")
        .distinct()
    )


def staged_orders(t: Tables, as_of: dt.datetime, cut=lambda df: df) -> tuple[DataFrame, DataFrame]:
    """``(driver, quarantine)``.

    driver: (order_id, state, submitted_date, profile_id, cn_id) of orders that pass
    the guards: exactly one payment group, submitted within 12 months of ``as_of``,
    exactly one consultant row with a consultant.
    quarantine: orders whose payment group (Q4) or consultant (Q5) look-up would
    return several rows; the source aborts the whole run there, we set them aside.
    """
    base = cut(staged_base(t))  # read three times below
    ids = base.select("order_id")
    pay = (
        t.dcspp_pay_group.select(F.col("order_ref").alias("order_id"))
        .join(ids, "order_id", "left_semi")
        .groupBy("order_id").agg(F.count(F.lit(1)).alias("n_pay"))
    )
    cons = (
        t.nt_order.select("order_id", "cn_id")
        .join(ids, "order_id", "left_semi")
        .groupBy("order_id").agg(F.count(F.lit(1)).alias("n_cn"), F.max("cn_id").alias("cn_id"))
    )
    checked = cut(base.join(pay, "order_id", "left").join(cons, "order_id", "left"))
    recent = F.col("submitted_date") > ts_lit(months_cutoff(as_of))
    one_pay = F.col("n_pay") == 1
    quarantine = checked.where((F.col("n_pay") > 1) | (one_pay & recent & (F.col("n_cn") > 1))).select(
        "order_id",
        F.col("profile_id").alias("cf_id"),
        F.lit(None).cast("string").alias("cn_id"),
        F.when(F.col("n_pay") > 1, REASON_PAY_GROUPS).otherwise(REASON_CONSULTANTS).alias("reason"),
        F.lit("O").alias("source"),
    )
    driver = checked.where(one_pay & recent & (F.col("n_cn") == 1) & F.col("cn_id").isNotNull()).select(
        "order_id", "state", "submitted_date", "profile_id", "cn_id")
    return driver, quarantine


def backfill_orders(t: Tables, start_date: dt.datetime, as_of: dt.datetime) -> DataFrame:
    """(order_id, state, submitted_date, profile_id, cn_id), one row per consultant row.

    Consultants may be NULL here (Q14); an order with two consultant rows is
    listed twice (Q19).
    """
    recent = (F.col("submitted_date") >= ts_lit(start_date)) & (
        F.col("submitted_date") > ts_lit(months_cutoff(as_of)))
    return (
        _orders_in(t, ACTIVE_STATES).where(recent)
        .join(settled_order_ids(t), "order_id", "left_semi")
        .join(t.nt_order.select("order_id", "cn_id"), "order_id")
        .distinct()
    )


def order_quarantine(t: Tables, as_of: dt.datetime) -> DataFrame:
    return staged_orders(t, as_of)[1]
