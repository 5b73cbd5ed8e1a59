"""Offer again: refill candidates (J5), upsert (J6), purge (J7), reset.

For each processed order: which SKUs will run out and when. Three branches:

* **R** (rebuy): a line's SKU has a rule pointing to another SKU; the rebuy SKU's
  own rule days, times its quantity in the same order, extend the expiry;
* **F** (base): a line's SKU has a rule pointing to itself; dropped where an R
  row of the same order covers the same rebuy SKU;
* **default**: the line's SKU has no rule at all: 90 days, not refillable.

The per-order cursor of the source becomes one join with the order set. Whether a
rule or SKU table is broadcast is left to Spark, which measures it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ordercraft.functions.scalars import plus_days, trunc_day, ts_lit
from ordercraft.operators.checks import Check, failed_check, not_null, unique_failures
from ordercraft.operators.details import product_names
from ordercraft.operators.ids import dense_ids, max_or
from ordercraft.sources.binding import Tables
from ordercraft.sources.schemas import CANDIDATE_COLUMNS, REFILL_KEY, TARGETS

# Fixed values of the refill job.
GRACE_DAYS = 60          # a reminder is kept this long after it expires
DEFAULT_DAYS = 90        # expiry of a product without a rule
REBUY = "R"
BASE = "F"
NOT_REFILLABLE = "N"
REASON_REPEATED_SKU = "refill sku on several lines of the order"


def order_items(t: Tables, orders: DataFrame) -> DataFrame:
    """(order_id, commerce_item_id) links of ``orders``."""
    items = t.dcspp_order_item.join(orders.select("order_id").distinct(), "order_id", "left_semi")
    return items.select("order_id", F.col("commerce_items").alias("commerce_item_id"))


def order_lines(t: Tables, orders: DataFrame) -> DataFrame:
    """(order_id, sku, product_id, quantity) of the lines of ``orders``."""
    return t.dcspp_item.select(
        "commerce_item_id", F.col("catalog_ref_id").alias("sku"), "product_id", "quantity",
    ).join(order_items(t, orders), "commerce_item_id").drop("commerce_item_id")


def _rules(t: Tables) -> DataFrame:
    return t.cit_product_refil.select("sku_order", "sku_rebuy", "expiration", "refillable")


def rebuy_rows(t: Tables, lines: DataFrame) -> DataFrame:
    """Joined R rows before DISTINCT: (order_id, sku_order, sku_rebuy, expiration, n_lines)."""
    rules = _rules(t)
    rule = rules.where(F.col("sku_order") != F.col("sku_rebuy")).select("sku_order", "sku_rebuy")
    rebuy_rule = rules.select(F.col("sku_order").alias("sku_rebuy"), F.col("expiration").alias("rebuy_days"))
    per_sku = lines.groupBy("order_id", F.col("sku").alias("sku_rebuy")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("quantity").alias("rebuy_qty"))
    return (
        lines.select("order_id", F.col("sku").alias("sku_order")).distinct()
        .join(rule, "sku_order")
        .join(rebuy_rule, "sku_rebuy")
        .join(per_sku, ["order_id", "sku_rebuy"], "left")
        .select("order_id", "sku_order", "sku_rebuy",
                F.when(F.col("n_lines") == 1, F.col("rebuy_qty") * F.col("rebuy_days")).alias("expiration"),
                "n_lines")
    )


def refill_rebuy(t: Tables, lines: DataFrame, joined: DataFrame | None = None) -> DataFrame:
    """R rows of ``temp``: (code, order_id, sku_order, expiration, sku_rebuy).

    ``expiration`` is NULL when the rebuy SKU is not in the order. ``joined`` may pass
    precomputed ``rebuy_rows``.
    """
    joined = rebuy_rows(t, lines) if joined is None else joined
    return joined.select(
        F.lit(REBUY).alias("code"), "order_id", "sku_order", "expiration", "sku_rebuy").distinct()


def refill_base(t: Tables, lines: DataFrame) -> DataFrame:
    """F rows of ``temp``: lines whose SKU has a rule onto itself."""
    self_rule = _rules(t).where(F.col("sku_order") == F.col("sku_rebuy")).select("sku_order", "sku_rebuy")
    return (
        lines.select("order_id", F.col("sku").alias("sku_order"))
        .join(self_rule, "sku_order")
        .select(F.lit(BASE).alias("code"), "order_id", "sku_order", F.lit(0).alias("expiration"), "sku_rebuy")
        .distinct()
    )


def repeated_refill_orders(t: Tables, lines: DataFrame, joined: DataFrame | None = None) -> DataFrame:
    """Q2: orders where a rebuy SKU sits on several lines; the source skips all their refills."""
    joined = rebuy_rows(t, lines) if joined is None else joined
    return joined.where(F.col("n_lines") > 1).select("order_id").distinct()


def _order_heads(t: Tables, orders: DataFrame) -> DataFrame:
    """(order_id, submitted_date, cf_id, cn_id), one row per consultant row of the order."""
    heads = orders.select("order_id", "submitted_date", F.col("profile_id").alias("cf_id")).distinct()
    return heads.join(t.nt_order.select("order_id", "cn_id"), "order_id")


def sku_names(t: Tables) -> DataFrame:
    """SKU code -> display name through the SKU map."""
    return t.nt_sku.select(F.col("sku_code").alias("sku_rebuy_t"), "sku_id").join(
        t.dcs_sku.select("sku_id", "display_name"), "sku_id").drop("sku_id")


def rule_candidates(
    t: Tables, orders: DataFrame, lines: DataFrame, as_of: dt.datetime, rebuy: DataFrame | None = None,
    pair_on_rebuy: bool = False, cut=lambda df: df, heads: DataFrame | None = None,
) -> DataFrame:
    """Rule-based candidates (R and F rows joined back to the lines and rules).

    ``pair_on_rebuy`` pairs a rule only with the ``temp`` row of its own rebuy SKU, so that each SKU gets its own
    description; the source does not (Q3). ``cut`` is applied to the ``temp`` rows and to the joined rows, which both
    branches read. ``heads`` may pass precomputed ``_order_heads``.
    """
    rebuy = refill_rebuy(t, lines) if rebuy is None else rebuy
    temp = cut(rebuy.unionByName(refill_base(t, lines)).select(
        "order_id", "sku_order", "code",
        F.col("sku_rebuy").alias("sku_rebuy_t"), F.col("expiration").alias("extra_days")))
    rules = _rules(t).where(F.col("sku_rebuy").isNotNull()).select(
        "sku_order", "sku_rebuy", F.col("expiration").alias("days"), "refillable")
    # The temp join is on (order, sku_order) only, so every rule of a SKU pairs with every
    # temp row of that SKU: a SKU can carry another rebuy SKU's name (kept on purpose, Q3).
    # Repeated lines of a SKU would only multiply rows that the final DISTINCT removes.
    paired = lines.select("order_id", F.col("sku").alias("sku_order")).distinct().join(rules, "sku_order").join(
        temp, ["order_id", "sku_order"])
    if pair_on_rebuy:
        paired = paired.where(F.col("sku_rebuy") == F.col("sku_rebuy_t"))
    joined = cut(
        paired
        .join(sku_names(t), "sku_rebuy_t")
        .join(_order_heads(t, orders) if heads is None else heads, "order_id")
        .where(F.col("submitted_date").isNotNull())
    )
    now = ts_lit(as_of)
    base_due = plus_days("submitted_date", F.col("days"))
    rebuy_due = plus_days(base_due, F.coalesce(F.col("extra_days"), F.lit(0)))
    covered = rebuy.select("order_id", F.col("sku_rebuy").alias("sku_rebuy_t"))
    base_rows = (
        joined.where((F.col("code") == BASE) & (plus_days(base_due, GRACE_DAYS) >= now))
        .join(covered, ["order_id", "sku_rebuy_t"], "left_anti")
        .withColumn("expiration", trunc_day(base_due))
    )
    rebuy_rows_ = joined.where((F.col("code") == REBUY) & (plus_days(rebuy_due, GRACE_DAYS) >= now)).withColumn(
        "expiration", trunc_day(rebuy_due))
    pick = [F.col("order_id"), F.col("sku_rebuy").alias("sku"), F.col("display_name").alias("description"),
            F.col("refillable"), F.col("cf_id"), F.col("cn_id"), F.col("expiration")]
    return base_rows.select(*pick).unionByName(rebuy_rows_.select(*pick))


def default_candidates(
    t: Tables, orders: DataFrame, lines: DataFrame, as_of: dt.datetime, heads: DataFrame | None = None,
) -> DataFrame:
    """Lines whose SKU has no rule: 90 days, time of day kept (Q10). ``heads`` may pass precomputed ``_order_heads``."""
    no_rule = lines.join(_rules(t).select(F.col("sku_order").alias("sku")), "sku", "left_anti")
    return (
        no_rule.join(product_names(t, True), "product_id")
        .join(_order_heads(t, orders) if heads is None else heads, "order_id")
        .where(F.col("submitted_date").isNotNull()
               & (plus_days("submitted_date", DEFAULT_DAYS + GRACE_DAYS) >= ts_lit(as_of)))
        .select("order_id", "sku", F.col("display_name").alias("description"),
                F.lit(NOT_REFILLABLE).alias("refillable"), "cf_id", "cn_id",
                plus_days("submitted_date", DEFAULT_DAYS).alias("expiration"))
    )


def refill_candidates(
    t: Tables, orders: DataFrame, as_of: dt.datetime, cut=lambda df: df, pair_on_rebuy: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(candidates, quarantine)``.

    ``orders`` needs (order_id, submitted_date, profile_id); candidates depend only on
    the order id, so an order listed twice is processed once (Q19). ``cut`` (e.g. a
    checkpoint) is applied to the steps that several branches read, and to each branch: all are
    joined by order id, so that uncut their sorts and hash tables would all be held by one task.
    """
    order_set = orders.select("order_id", "submitted_date", "profile_id").distinct()
    lines = cut(order_lines(t, order_set))
    joined = cut(rebuy_rows(t, lines))
    rebuy = cut(refill_rebuy(t, lines, joined))
    heads = cut(_order_heads(t, order_set))
    ruled = cut(rule_candidates(t, order_set, lines, as_of, rebuy, pair_on_rebuy, cut, heads))
    union = ruled.unionByName(cut(default_candidates(t, order_set, lines, as_of, heads))).distinct()
    repeated = repeated_refill_orders(t, lines, joined)
    candidates = union.join(repeated, "order_id", "left_anti").select(*CANDIDATE_COLUMNS)
    quarantine = repeated.join(order_set, "order_id").select(
        "order_id", F.col("profile_id").alias("cf_id"), F.lit(None).cast("string").alias("cn_id"),
        F.lit(REASON_REPEATED_SKU).alias("reason"), F.lit(REBUY).alias("source"))
    return candidates, quarantine


# -- upsert ---------------------------------------------------------------------------------

def _pinned(*cols: str) -> Column:
    """Sort key for 'ascending, NULLs last' over ``cols``, usable in min/max aggregates."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.struct(*parts)


CANDIDATE_ORDER = ("sku", "description", "refillable", "cf_id", "cn_id", "expiration")


def refill_checks() -> list[Check]:
    """Default insert checks of a refill row."""
    return [not_null("cit_refil", "order_id"), not_null("cit_refil", "sku")]


def refill_upsert(
    current: DataFrame,
    candidates: DataFrame,
    orders: DataFrame,
    id_base: int | None = None,
    mode: str = "first_row",
    checks: list[Check] | None = None,
    cut=lambda df: df,
    others: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, int]:
    """``(next_refil, rejected, last_id)``.

    ``mode='first_row'`` keeps the source's rule (Q9): the first candidate of an order
    (pinned order, Q1) is looked up by (CN, CF, SKU, ORDER_ID); found exactly once, every
    candidate of the order updates REFILLABLE and EXPIRATION of the rows with its key (new
    SKUs are not inserted); otherwise every candidate is inserted under one new id.
    ``mode='per_row'`` is a true upsert per key. Repeated updates of one key keep the last
    candidate (W4). ``rejected`` holds would-be inserts that fail the ``checks``, with
    (order_id, error_code, error). ``last_id`` is the last id given to a new group, or the base: ids of groups that are
    purged at once count too. ``cut`` is applied to the marked candidates, the new groups and the checked inserts.

    ``current`` may be the part of the table that holds the candidates' orders; ``others`` is then the rest, which is
    only read for unique checks.
    """
    checks = refill_checks() if checks is None else checks
    key = REFILL_KEY
    # Only stored rows whose key a candidate carries are counted.
    keys = candidates.select(*key).distinct()
    stored = (
        current.join(keys, key, "left_semi")
        .groupBy(*key).agg(F.count(F.lit(1)).alias("n_stored"))
    )
    if mode == "first_row":
        first = candidates.groupBy("order_id").agg(F.min(_pinned(*CANDIDATE_ORDER)).alias("first"))
        first = first.select("order_id", *[F.col(f"first.{c}").alias(c) for c in ("sku", "cf_id", "cn_id")])
        found = first.join(stored, key, "left").select(
            "order_id", (F.coalesce(F.col("n_stored"), F.lit(0)) == 1).alias("update_order"))
        marked = cut(candidates.join(found, "order_id"))
        to_update = marked.where("update_order").drop("update_order")
        to_insert = marked.where(~F.col("update_order")).drop("update_order")
    elif mode == "per_row":
        marked = cut(candidates.join(stored, key, "left"))
        to_update = marked.where(F.col("n_stored").isNotNull()).drop("n_stored")
        to_insert = marked.where(F.col("n_stored").isNull()).drop("n_stored")
    else:
        raise ValueError(f"unknown mode {mode!r}")

    last = to_update.groupBy(*key).agg(
        F.max(_pinned(*CANDIDATE_ORDER, "order_id")).alias("last"))
    last = last.select(*key, F.col("last.refillable").alias("new_refillable"),
                       F.col("last.expiration").alias("new_expiration"), F.lit(True).alias("matched"))
    updated = current.join(last, key, "left").select(
        "id_key", "description", "sku",
        F.when(F.col("matched"), F.col("new_refillable")).otherwise(F.col("refillable")).alias("refillable"),
        F.when(F.col("matched"), F.col("new_expiration")).otherwise(F.col("expiration")).alias("expiration"),
        "cf_id", "cn_id", "order_id",
    )

    new_orders = cut(to_insert.select("order_id").distinct().join(
        orders.select("order_id", "submitted_date").distinct(), "order_id"))
    base = max_or(current, "id_key") if id_base is None else id_base
    numbered, last_id = dense_ids(new_orders, ["submitted_date", "order_id"], base, "id_key")
    code, msg = failed_check(checks)
    inserts = to_insert.join(numbered.select("order_id", "id_key"), "order_id").withColumn(
        "error_code", code).withColumn("error", msg)
    taken = updated if others is None else updated.unionByName(others.select(*updated.columns))
    inserts = cut(unique_failures(inserts, taken, checks, ["id_key", *CANDIDATE_ORDER], cut))
    rejected = inserts.where(F.col("error_code").isNotNull()).select("order_id", "error_code", "error")
    inserted = inserts.where(F.col("error_code").isNull()).select(*TARGETS["cit_refil"].fieldNames())
    return updated.unionByName(inserted), rejected, last_id


def refill_purge(current: DataFrame, as_of: dt.datetime, grace_days: int = GRACE_DAYS) -> DataFrame:
    """Drop reminders expired more than ``grace_days`` before ``as_of``; NULL expiry stays."""
    return current.where(
        F.col("expiration").isNull() | (plus_days("expiration", grace_days) >= ts_lit(as_of)))


def refill_reset(t: Tables, current: DataFrame, start_date: dt.datetime) -> DataFrame:
    """J8 (refill part): drop reminders of orders submitted on or after ``start_date``."""
    started = t.dcspp_order.where(F.col("submitted_date") >= ts_lit(start_date)).select("order_id")
    return current.join(started, "order_id", "left_anti")
