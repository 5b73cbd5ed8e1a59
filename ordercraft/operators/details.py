"""Order details (J1) and its older form.

One row per distinct order line x price adjustment x payment group x shipping
group, 31 columns.

Plan shape, chosen for scale:

* the two correlated subqueries become keyed pre-aggregates (B1 installments per
  payment group, B2 order discount per order price) that are left-joined once;
* the output is split into four components that each carry only their own output
  columns plus the order id: header, lines, payments, shipments. Each component
  is made distinct *before* the fan-out, while it is still small. The component
  columns are disjoint, so the join of four distinct components is itself
  distinct: the 31-column DISTINCT of the source never has to shuffle the
  fanned-out result. All four are distinct within the partitioning of the join (no extra shuffle); a very large order's
  lines are spread over pieces before;
* lines get their order id first; price adjustments are joined to their links on rows without NULL keys, so lines are
  joined once with the result, in the partitioning of the item price; lines without a price id are spread by a salt;
* image links are added to the result, so they are never shuffled;
* an order with very many lines is joined in pieces (``hot_orders``), so no task gets it whole;
* with ``cut`` the joins by other keys than the order's are steps of their own, so that the disk holds the shuffles of one
  step at a time; links and adjustments are joined once for lines and order discounts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ordercraft.functions.scalars import concat_nullable, customer_name, item_discount
from ordercraft.session import freed_shuffles, steps
from ordercraft.sources.binding import Tables
from ordercraft.sources.schemas import ORDER_DETAILS_COLUMNS

# Fixed values of the details view: the constant city/state text.
CITY_STATE = "MOCK - MK"
# Image link = prefix || SKU || suffix. The prefix is the shop's image host, so it
# is a parameter; this neutral default stands in for it.
IMAGE_PREFIX = "//images.example/sku/"
IMAGE_SUFFIX = "_1.jpg"


def installments_first(t: Tables) -> DataFrame:
    """B1: installments per payment group, pinned to the smallest value (Q8)."""
    return t.oe_pay_group.groupBy("payment_group_id").agg(F.min("no_of_payments").alias("installments"))


def linked_adjustments(t: Tables) -> DataFrame:
    """(amount_info_id, adjustments, adjustment, pricing_model) per link; NULL where the adjustment is missing."""
    adjust = t.dcspp_price_adjust.select(F.col("adjustment_id").alias("adjustments"), "adjustment", "pricing_model")
    return t.dcspp_amtinfo_adj.select("amount_info_id", "adjustments").join(adjust, "adjustments", "left")


def order_discount_sum(t: Tables, linked: DataFrame | None = None) -> DataFrame:
    """B2: per order price, the sum of its negative adjustments that differ from the subtotal.

    The outer joins of the source are made inner by its WHERE clause; a NULL
    subtotal fails ``<>`` and drops the row. Orders with no row get NULL later.
    ``linked``: the ``linked_adjustments``, if they are there already.
    """
    price = t.dcspp_order_price.select("amount_info_id", "raw_subtotal")
    linked = linked_adjustments(t) if linked is None else linked
    return (
        linked.where(F.col("adjustment") < 0).select("amount_info_id", "adjustment")
        .join(price, "amount_info_id")
        .where(F.col("raw_subtotal") != F.col("adjustment"))
        .groupBy("amount_info_id")
        .agg(F.sum("adjustment").cast("decimal(19,2)").alias("order_discount"))
    )


def product_names(t: Tables, require_product_map: bool = True) -> DataFrame:
    """Product id -> display name; J1 requires the product in the product map (N4), J2 does not."""
    names = t.dcs_product.select("product_id", "display_name")
    if require_product_map:
        names = names.join(t.nt_product.select("product_id"), "product_id", "left_semi")
    return names


def _header(t: Tables, linked: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    order = t.dcspp_order.select(
        "order_id", "profile_id", "state", "submitted_date", "creation_date", "last_modified_date", "price_info")
    user = t.dps_user.select(
        F.col("id").alias("profile_id"),
        customer_name("first_name", "last_name").alias("customer_name"),
        F.col("email").alias("customer_email"),
        F.col("date_of_birth").alias("customer_birthday"),
    )
    price = t.dcspp_order_price.select(F.col("amount_info_id").alias("price_info"), "raw_subtotal", "shipping")
    discount = order_discount_sum(t, linked).withColumnRenamed("amount_info_id", "price_info")
    priced = keep(
        order.join(user, "profile_id")
        .join(price, "price_info", "left")
        .join(discount, "price_info", "left")
        .drop("price_info"))
    return (
        priced.join(t.oe_order.select("order_id", "order_number"), "order_id")
        .join(t.nt_order.select("order_id", "cn_id", "coupon_id"), "order_id")
        .select(
            "order_id",
            F.col("profile_id").alias("cf_id"),
            "cn_id",
            F.col("order_number").alias("order_number_broker"),
            F.col("state").alias("order_state"),
            F.col("submitted_date").alias("order_date"),
            "raw_subtotal",
            "coupon_id",
            "shipping",
            F.col("raw_subtotal").alias("order_total"),
            "customer_name",
            "customer_email",
            "customer_birthday",
            "creation_date",
            "last_modified_date",
            "order_discount",
        )
    )


def _salted(key: str, spread: str) -> tuple:
    """Join key columns that spread rows with a NULL key (which match nothing) over all partitions."""
    return F.col(key), F.when(F.col(key).isNull(), F.xxhash64(spread)).otherwise(F.lit(0).cast("long"))


def _lines(t: Tables, require_product_map: bool, linked: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The lines of the details before they are made distinct."""
    order_item = t.dcspp_order_item.select("order_id", F.col("commerce_items").alias("commerce_item_id"))
    key, salt = _salted("price_info", "commerce_item_id")
    # Order id first: prices and adjustments then meet lines that already know their order, and the result moves once.
    line = step(order_item.join(t.dcspp_item, "commerce_item_id").select(
        "order_id", "catalog_ref_id", "product_id", "quantity", key.alias("price_id"), salt.alias("salt")))
    zero = F.lit(0).cast("long").alias("salt")
    item_price = t.dcspp_item_price.select(
        F.col("amount_info_id").alias("price_id"), zero, "list_price", "raw_total_price", "order_discount",
        F.lit(True).alias("priced"))
    # Item price and adjustments are both optional and both keyed by the item's price id; an adjustment counts only
    # if a price was found.
    adjust = linked.select(
        F.col("amount_info_id").alias("price_id"), zero, "adjustment", "pricing_model")
    joined = line.join(item_price, ["price_id", "salt"], "left").join(adjust, ["price_id", "salt"], "left")
    counted = lambda c: F.when(F.col("priced"), F.col(c))
    names = product_names(t, require_product_map).distinct()
    priced = step(joined.select(
        "order_id",
        F.col("catalog_ref_id").alias("sku_id"),
        "product_id",
        "quantity",
        item_discount(counted("adjustment"), "quantity", "list_price").alias("un_discount"),
        F.col("list_price").alias("un_price"),
        "raw_total_price",
        counted("pricing_model").alias("promotion_id"),
        F.col("order_discount").alias("item_discount"),
    ))
    return priced.join(names, "product_id")


# An order with more lines than this, and than half a mean shuffle partition, is split over partitions.
HOT_LINES = 10_000
PIECES = 4  # pieces of a hot order per mean partition


def hot_orders(t: Tables, least: int = HOT_LINES) -> DataFrame | None:
    """(order_id, pieces) of orders that hold so many of all lines that one task could not take them; None if there are none.

    Two passes over the order ids of the lines: their number, and partial counts per order. There are at most twice as many
    such orders as shuffle partitions, each with over 1 / (2 x partitions) of all lines.
    """
    spark = t.dcspp_order_item.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = t.dcspp_order_item.where("order_id is not null").select("order_id")
    total = ids.count()
    bound = max(least, total // (2 * parts))
    if total <= bound:
        return None
    with freed_shuffles(spark):
        rows = ids.groupBy("order_id").count().where(F.col("count") > bound).collect()
    mean = max(1, total // parts)
    return spark.createDataFrame([(r["order_id"], -(-PIECES * r["count"] // mean)) for r in rows], "order_id string, pieces long") \
        if rows else None


def _dealt(df: DataFrame, hot: DataFrame, lines: bool) -> DataFrame:
    """``df`` with ``piece``: each line of a hot order in one of its pieces, its other rows in every piece; else 0."""
    cols = df.columns
    pieces = F.coalesce("pieces", F.lit(1).cast("long"))
    piece = F.pmod(F.xxhash64(*cols), pieces) if lines else F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))
    return df.join(F.broadcast(hot), "order_id", "left").select(*cols, piece.alias("piece"))


def _payments(t: Tables) -> DataFrame:
    return (
        t.dcspp_pay_group.select(F.col("order_ref").alias("order_id"), "payment_group_id", "state", "payment_method")
        .join(installments_first(t), "payment_group_id", "left")
        .select("order_id", "state", "payment_method", "installments")
    )


def _shipments(t: Tables) -> DataFrame:
    return (
        t.dcspp_ship_group.select(F.col("order_ref").alias("order_id"), "shipping_group_id")
        .join(t.nt_ship_group, "shipping_group_id", "left")
        .select("order_id", F.col("sched_deliv_date").alias("deliver_date"))
    )


def order_details(
    t: Tables,
    require_product_map: bool = True,
    image_prefix: str = IMAGE_PREFIX,
    image_suffix: str = IMAGE_SUFFIX,
    hot_lines: int = HOT_LINES,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """J1 (``require_product_map=True``) and J2 (``False``): the order-details table O1.

    Orders with very many lines (see ``hot_orders``) are joined in pieces: their lines are dealt over the pieces, their
    header, payments and shipments are copied to each.

    With ``cut``, each step that joins by another key is written at once, so that its shuffles are freed before the next
    one; the steps that the result does not read go, and only the join by order is left to the result's plan. The tables
    it reads are as long-lived as what ``cut`` writes.
    """
    hot = hot_orders(t, hot_lines)
    key = ["order_id"] if hot is None else ["order_id", "piece"]
    with steps(t.dcspp_order_item.sparkSession, cut) as (step, keep):
        linked = step(linked_adjustments(t).select("amount_info_id", "adjustment", "pricing_model"))
        lines = keep(_lines(t, require_product_map, linked, step))
        header, payments, shipments = _header(t, linked, keep), keep(_payments(t)), keep(_shipments(t))
    if hot is not None:
        lines, (header, payments, shipments) = _dealt(lines, hot, True), (_dealt(x, hot, False) for x in (header, payments, shipments))
    # Lines first: they are the streamed side of each sort-merge join, and the per-order
    # components (one header row, a few payment and shipping rows) are the buffered side.
    joined = (
        lines.repartition(*key).distinct()
        .join(header.repartition(*key).distinct(), key)
        .join(payments.repartition(*key).distinct(), key)
        .join(shipments.repartition(*key).distinct(), key)
    )
    return joined.select(
        *[
            F.col("order_id").alias("order_number") if c == "order_number"
            else F.lit(CITY_STATE).alias("city_state") if c == "city_state"
            else concat_nullable(F.lit(image_prefix), "sku_id", F.lit(image_suffix)).alias("image_url") if c == "image_url"
            else F.col(c)
            for c in ORDER_DETAILS_COLUMNS
        ]
    )


def unit_discounts(t: Tables) -> DataFrame:
    """P4 on its own: the unit discount of every item x adjustment pair."""
    return (
        t.dcspp_item.select("commerce_item_id", "quantity", F.col("price_info").alias("amount_info_id"))
        .join(t.dcspp_item_price.select("amount_info_id", "list_price"), "amount_info_id")
        .join(t.dcspp_amtinfo_adj, "amount_info_id")
        .join(t.dcspp_price_adjust.select(F.col("adjustment_id").alias("adjustments"), "adjustment"), "adjustments")
        .select(
            "commerce_item_id",
            F.col("adjustments").alias("adjustment_id"),
            item_discount("adjustment", "quantity", "list_price").alias("un_discount"),
        )
    )


def create_order_details_view(t: Tables, name: str = "order_details", **options) -> DataFrame:
    """Register the details table as a temporary view for SQL users; returns the DataFrame.

    ``options``: as for ``order_details``; with ``cut`` the view has the details of the time it was created.
    Unlike a forced view of the source, missing input tables fail at analysis time.
    """
    df = order_details(t, **options)
    df.createOrReplaceTempView(name)
    return df
