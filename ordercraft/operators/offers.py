"""Offer also: brand affinity (J9), best brand offers (J10), opportunity upsert.

For each customer (staged) or customer and consultant (backfill): the brands they
bought in the last 12 months, the rules "bought brand X -> offer brand Y" whose Y
they do not have, the best such rule by (interest, support) with ties kept, and
the consultant of their latest order.

The nested correlated maxima of the source become one partial aggregate,
``max(struct(interest, support))`` per customer, joined back: an aggregate
combines map-side, so a customer holding a large share of the rows does not end
up whole in one task the way a window partition would.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ordercraft.functions.scalars import months_cutoff, ts_lit
from ordercraft.operators.orders import ACTIVE_STATES, settled_order_ids
from ordercraft.operators.checks import Check, failed_check, not_null, unique_failures
from ordercraft.operators.refill import _pinned, order_items
from ordercraft.sources.binding import Tables
from ordercraft.sources.schemas import TARGETS

STAGED_SCOPE = ["cf_id"]
BACKFILL_SCOPE = ["cf_id", "cn_id"]

REASON_SEVERAL_OPPORTUNITIES = "several stored opportunities"
REASON_NULL_CONSULTANT = "offer without consultant"
ALSO = "A"


def brand_affinity(
    t: Tables, contexts: DataFrame, as_of: dt.datetime, scope: list[str] = STAGED_SCOPE, cut=lambda df: df,
) -> DataFrame:
    """Distinct (scope..., brand_id) of settled, active orders of the last 12 months.

    ``contexts`` lists the customers (and, for the backfill scope, consultants) to
    compute; a NULL consultant matches no order (Q14). ``cut`` (e.g. a written stage table) is applied to the
    customers' orders, which the line look-up reads twice.
    """
    orders = (
        t.dcspp_order.where(F.col("state").isin(*ACTIVE_STATES)
                            & (F.col("submitted_date") > ts_lit(months_cutoff(as_of))))
        .select("order_id", F.col("profile_id").alias("cf_id"))
        .join(contexts.select("cf_id").distinct(), "cf_id", "left_semi")
        .join(settled_order_ids(t), "order_id", "left_semi")
    )
    if "cn_id" in scope:
        orders = orders.join(t.nt_order.select("order_id", "cn_id"), "order_id").join(
            contexts.select(*scope).distinct(), scope, "left_semi")
    orders = cut(orders)
    product_brand = t.oe_product.select("product_id", "brand_id").join(t.oe_brand.select("brand_id"), "brand_id", "left_semi")
    return (
        orders.join(order_items(t, orders), "order_id")
        .join(t.dcspp_item.select("commerce_item_id", "product_id"), "commerce_item_id")
        .join(product_brand, "product_id")
        .select(*scope, "brand_id")
        .distinct()
    )


def eligible_rules(t: Tables, affinity: DataFrame, scope: list[str] = STAGED_SCOPE) -> DataFrame:
    """Rules from a brand the customer has to a brand they do not have.

    The source's NOT IN drops a NULL offered brand, so that is filtered first (R7).
    """
    rules = t.cit_offer.where(F.col("brand_offer").isNotNull()).select(
        F.col("brand_order").alias("brand_id"), "brand_offer", "interest", "support")
    owned = affinity.select(*scope, F.col("brand_id").alias("brand_offer"))
    return (
        affinity.join(rules, "brand_id")
        .join(owned, [*scope, "brand_offer"], "left_anti")
        .select(*scope, F.col("brand_id").alias("brand_order"), "brand_offer", "interest", "support")
    )


def top_rules(eligible: DataFrame, scope: list[str] = STAGED_SCOPE) -> DataFrame:
    """Rules at the per-customer maximum interest, then maximum support; ties kept.

    NULL interest never wins (MAX ignores NULL), and if every top-interest rule has a
    NULL support, nothing is kept (equality with NULL fails), as in the source (R5).
    """
    best = eligible.where(F.col("interest").isNotNull()).groupBy(*scope).agg(
        F.max(F.struct("interest", "support")).alias("best"))
    return eligible.join(best, scope).where(
        (F.col("interest") == F.col("best.interest")) & (F.col("support") == F.col("best.support"))
    ).drop("best")


def latest_orders(orders: DataFrame) -> DataFrame:
    """The rows of ``orders(cf_id, order_date, order_id)`` at their customer's latest date, ties kept."""
    latest = orders.groupBy("cf_id").agg(F.max("order_date").alias("order_date"))
    # Joined back on (customer, date): a customer with very many orders still spreads by date.
    return orders.join(latest, ["cf_id", "order_date"]).select("cf_id", "order_date", "order_id")


def dated_orders(t: Tables) -> DataFrame:
    """(cf_id, order_date, order_id) of all orders, any state (Q17)."""
    return t.dcspp_order.select(F.col("profile_id").alias("cf_id"), F.col("submitted_date").alias("order_date"), "order_id")


def latest_consultant(t: Tables, customers: DataFrame | None = None, latest: DataFrame | None = None) -> DataFrame:
    """(cf_id, cn_id, order_date) of each customer's latest orders.

    ``latest`` may give these orders (cf_id, order_date, order_id), as ``latest_orders`` or a kept state has them.
    """
    orders = dated_orders(t) if latest is None else latest
    if customers is not None:
        orders = orders.join(customers.select("cf_id").distinct(), "cf_id", "left_semi")
    return (
        (latest_orders(orders) if latest is None else orders)
        .join(t.nt_order.select("order_id", "cn_id"), "order_id")
        .select("cf_id", "cn_id", "order_date")
        .distinct()
    )


def also_offers(
    t: Tables,
    contexts: DataFrame,
    as_of: dt.datetime,
    scope: list[str] = STAGED_SCOPE,
    cut=lambda df: df,
    affinity_of=None,
    latest: DataFrame | None = None,
) -> DataFrame:
    """(cn_id, cf_id, offer, order_date).

    Staged scope: per customer, the consultant comes from the latest order.
    Backfill scope: per customer and consultant, kept only when the customer's latest
    order has that consultant (Q15); rows are distinct.
    The brand name is joined after ranking, so a top rule with an unnamed brand gives
    no offer (Q16). ``cut`` (e.g. a checkpoint) is applied to the brand affinity, which
    the rule steps read several times. ``affinity_of(contexts, as_of, scope)`` and ``latest`` may give the brands and the
    latest orders from kept states instead of from all lines and orders.
    """
    affinity = cut(affinity_of(contexts, as_of, scope) if affinity_of else brand_affinity(t, contexts, as_of, scope, cut))
    top = top_rules(eligible_rules(t, affinity, scope), scope)
    names = t.oe_brand.select(F.col("brand_id").alias("brand_offer"), F.col("name").alias("offer"))
    named = top.join(names, "brand_offer")
    latest = latest_consultant(t, contexts, latest)
    if "cn_id" in scope:
        latest = latest.join(contexts.select(*scope).distinct(), scope, "left_semi")
    out = named.join(latest, scope).select("cn_id", "cf_id", "offer", "order_date")
    return out.distinct() if "cn_id" in scope else out


def opportunity_checks() -> list[Check]:
    """Default insert checks of an opportunity row."""
    return [not_null("cit_opportunities", "cf_id"), not_null("cit_opportunities", "offer")]


def refill_pointer(refill_view: DataFrame) -> DataFrame:
    """A4: latest refill group per (cf_id, cn_id)."""
    return refill_view.groupBy("cf_id", "cn_id").agg(F.max("id_key").alias("refil"))


def opportunity_upsert(
    current: DataFrame,
    offers: DataFrame,
    refill_view: DataFrame,
    scope: list[str] = STAGED_SCOPE,
    clear_pointer_first: bool = True,
    checks: list[Check] | None = None,
    cut=lambda df: df,
    others: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(next_opportunities, quarantine, rejected)``.

    Per key (customer, or customer and consultant) the source deletes the stored row and
    inserts each offer in turn, so the last offer in the pinned order (CN_ID, OFFER
    ascending) wins (W3). Keys with several stored rows stop the look-up: their rows stay,
    and the staged job has by then cleared their pointers if the first offer has one
    (Q6). Offers without a consultant are set aside instead of piling up (Q7); a stored
    row without a consultant is replaced like any other. ``rejected`` holds every offer that fails the insert ``checks``:
    (scope..., error_code, error). ``cut`` is applied to the decided keys, which all outputs read.

    ``current`` may be the part of the table that holds the offers' customers; ``others`` is then the rest, which is only
    read for unique checks.
    """
    checks = opportunity_checks() if checks is None else checks
    pointer = refill_pointer(refill_view)
    valid = offers.where(F.col("cn_id").isNotNull())
    null_cn = offers.where(F.col("cn_id").isNull())
    order = _pinned("cn_id", "offer")
    ranked = valid.groupBy(*scope).agg(
        F.max(F.struct(order.alias("k"), F.struct("cn_id", "cf_id", "offer", "order_date").alias("row"))).alias("last"),
        F.min(F.struct(order.alias("k"), F.col("cn_id").alias("cn_id"))).alias("first"),
    )
    winners = ranked.select(
        *[F.col(c) for c in scope],
        F.col("last.row.cn_id").alias("win_cn_id"), F.col("last.row.offer").alias("offer"),
        F.col("last.row.order_date").alias("order_date"), F.col("first.cn_id").alias("first_cn_id"),
    )
    stored = (
        current.join(winners.select(*scope), scope, "left_semi")
        .groupBy(*scope).agg(F.count(F.lit(1)).alias("n_stored"))
    )
    decided = cut(winners.join(stored, scope, "left").withColumn(
        "blocked", F.coalesce(F.col("n_stored"), F.lit(0)) >= 2))

    # Keys with at most one stored row: replace it by the winner.
    replace = decided.where(~F.col("blocked"))
    kept = current.join(replace.select(*scope), scope, "left_anti")
    code, msg = failed_check(checks)
    new_rows = (
        replace.join(pointer.select("cf_id", F.col("cn_id").alias("win_cn_id"), "refil"), ["cf_id", "win_cn_id"], "left")
        .select(F.col("win_cn_id").alias("cn_id"), "cf_id", "offer", "refil", "order_date")
        .withColumn("error_code", code).withColumn("error", msg)
    )
    taken = kept if others is None else kept.unionByName(others.select(*kept.columns))
    new_rows = unique_failures(new_rows, taken, checks, ["cf_id", "cn_id", "offer"], cut)
    inserted = new_rows.where(F.col("error_code").isNull()).select(*TARGETS["cit_opportunities"].fieldNames())
    # Every offer is an insert of its own, whether it wins or not.
    tried = valid.join(replace.select(*scope), scope, "left_semi").withColumn("error_code", code).withColumn("error", msg)
    rejected = tried.where(F.col("error_code").isNotNull()).select(*scope, "error_code", "error").unionByName(
        new_rows.where(F.col("duplicate")).select(*scope, "error_code", "error"))

    if clear_pointer_first:
        # Blocked keys: the staged job clears their pointers when the first offer has a pointer.
        clear = (
            decided.where(F.col("blocked"))
            .join(pointer.select("cf_id", F.col("cn_id").alias("first_cn_id"), F.col("refil").alias("first_refil")),
                  ["cf_id", "first_cn_id"])
            .where(F.col("first_refil").isNotNull())
            .select(*scope, F.lit(True).alias("clear"))
        )
        kept = kept.join(clear, scope, "left").select(
            "cn_id", "cf_id", "offer",
            F.when(F.col("clear"), F.lit(None).cast("bigint")).otherwise(F.col("refil")).alias("refil"),
            "order_date",
        )
    next_rows = kept.select(*TARGETS["cit_opportunities"].fieldNames()).unionByName(inserted)

    quarantine = decided.where(F.col("blocked")).select(
        F.lit(None).cast("string").alias("order_id"), "cf_id",
        (F.col("cn_id") if "cn_id" in scope else F.col("win_cn_id")).alias("cn_id"),
        F.lit(REASON_SEVERAL_OPPORTUNITIES).alias("reason"), F.lit(ALSO).alias("source"),
    ).unionByName(null_cn.select(
        F.lit(None).cast("string").alias("order_id"), "cf_id", "cn_id",
        F.lit(REASON_NULL_CONSULTANT).alias("reason"), F.lit(ALSO).alias("source"),
    ).distinct())
    return next_rows, quarantine, rejected


def opportunity_reset(current: DataFrame, start_date: dt.datetime) -> DataFrame:
    """J8 (offer part): drop opportunities dated on or after ``start_date``; NULL dates stay."""
    return current.where(F.col("order_date").isNull() | (F.col("order_date") < ts_lit(start_date)))
