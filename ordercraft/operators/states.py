"""Kept states: what the offers need of all orders, merged with new orders instead of computed again.

* The latest orders of each customer (B4, N20): one row a customer, more on ties.
* The brands that a customer bought per day (J9): the 12-month window slides by days that enter and leave.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ordercraft.functions.scalars import months_cutoff, trunc_day, ts_lit
from ordercraft.operators.offers import STAGED_SCOPE, latest_orders
from ordercraft.operators.orders import ACTIVE_STATES, settled_order_ids
from ordercraft.operators.refill import order_items
from ordercraft.sources.binding import Tables
from ordercraft.sources.schemas import STATES

# -- latest orders --------------------------------------------------------------------------


def merge_latest(state: DataFrame, changed: DataFrame, orders: DataFrame, cut=lambda df: df) -> DataFrame:
    """The latest orders per customer after orders were added or changed, all as (cf_id, order_date, order_id).

    ``changed`` has the present rows of the new and changed orders, late ones (dated before the state) included; an order
    that is gone or lost its customer comes with a NULL ``cf_id``. Partial states merge by the larger date, equal dates
    keep all their orders. Only where a customer's latest orders were all changed to something earlier are that customer's
    ``orders`` read again.
    """
    kept = state.join(changed.select("order_id"), "order_id", "left_anti").select(*state.columns)
    merged = cut(latest_orders(kept.unionByName(changed.where("cf_id is not null and order_date is not null"))))
    before = state.select("cf_id", F.col("order_date").alias("before")).distinct()
    now = merged.select("cf_id", F.col("order_date").alias("now")).distinct()
    fallen = cut(before.join(now, "cf_id", "left").where("now is null or now < before").select("cf_id"))
    again = latest_orders(orders.join(fallen, "cf_id", "left_semi"))
    return merged.join(fallen, "cf_id", "left_anti").unionByName(again).select(*STATES["latest_orders"].fieldNames())


# -- brands per day -------------------------------------------------------------------------


def order_cells(orders: DataFrame) -> DataFrame:
    """The (cf_id, day) cells of ``orders(profile_id, submitted_date)``; undated orders have none."""
    return orders.where("profile_id is not null and submitted_date is not null").select(
        F.col("profile_id").alias("cf_id"), trunc_day("submitted_date").alias("day")).distinct()


def brand_days(t: Tables, cells: DataFrame | None = None, cut=lambda df: df) -> DataFrame:
    """(day, cf_id, cn_id, brand_id, last_date): brands of settled, active orders, of all days or of ``cells(cf_id, day)``.

    ``last_date`` is the day's last order with that brand, which decides on the day where the window begins. Orders
    without a consultant row have a NULL ``cn_id``.
    """
    orders = t.dcspp_order.where(F.col("state").isin(*ACTIVE_STATES) & F.col("submitted_date").isNotNull()).select(
        "order_id", F.col("profile_id").alias("cf_id"), "submitted_date", trunc_day("submitted_date").alias("day"))
    if cells is not None:
        orders = orders.join(cells, ["cf_id", "day"], "left_semi")
    orders = cut(orders.join(settled_order_ids(t), "order_id", "left_semi"))
    product_brand = t.oe_product.select("product_id", "brand_id").join(t.oe_brand.select("brand_id"), "brand_id", "left_semi")
    return (
        orders.join(order_items(t, orders), "order_id")
        .join(t.dcspp_item.select("commerce_item_id", "product_id"), "commerce_item_id")
        .join(product_brand, "product_id")
        .join(t.nt_order.select("order_id", "cn_id"), "order_id", "left")
        .groupBy("day", "cf_id", "cn_id", "brand_id").agg(F.max("submitted_date").alias("last_date"))
        .select(*STATES["brand_days"].fieldNames())
    )


def merge_brand_days(state: DataFrame, cells: DataFrame, fresh: DataFrame) -> DataFrame:
    """``state`` with the rows of ``cells(cf_id, day)`` replaced by ``fresh`` (``brand_days`` of these cells)."""
    return state.join(cells, ["cf_id", "day"], "left_anti").select(*state.columns).unionByName(fresh)


def in_window(as_of: dt.datetime) -> Column:
    """Rows of a brand-day state that count at ``as_of``: the first day of the window only by its orders after the cut-off."""
    cutoff = months_cutoff(as_of)
    return (F.col("day") >= ts_lit(cutoff.date())) & (F.col("last_date") > ts_lit(cutoff))


def sliding_affinity(state: DataFrame, contexts: DataFrame, as_of: dt.datetime, scope: list[str] = STAGED_SCOPE) -> DataFrame:
    """J9 from a brand-day state: what ``brand_affinity`` reads from all lines of the last 12 months."""
    return state.where(in_window(as_of)).join(contexts.select(*scope).distinct(), scope, "left_semi").select(
        *scope, "brand_id").distinct()
