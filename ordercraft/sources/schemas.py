"""Schemas of the input tables (T1-T23), the targets (O2-O4) and helpers to conform to them.

The catalog columns are those the jobs read; business ids are strings, money is
decimal(19,2), dates carry time of day and are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DecimalType(19, 2)
TS = T.TimestampNTZType()

MONEY = D


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


INPUTS: dict[str, T.StructType] = {
    "dcspp_order": _struct(
        ("order_id", S), ("profile_id", S), ("state", S), ("submitted_date", TS),
        ("creation_date", TS), ("last_modified_date", TS), ("price_info", S)),
    "oe_order": _struct(("order_id", S), ("order_number", S)),
    "nt_order": _struct(("order_id", S), ("cn_id", S), ("coupon_id", S)),
    "dcspp_order_item": _struct(("order_id", S), ("commerce_items", S)),
    "dcspp_order_item_stg": _struct(("order_id", S)),
    "dcspp_item": _struct(
        ("commerce_item_id", S), ("catalog_ref_id", S), ("product_id", S), ("quantity", I), ("price_info", S)),
    "dcspp_order_price": _struct(("amount_info_id", S), ("raw_subtotal", D), ("shipping", D)),
    "dcspp_item_price": _struct(
        ("amount_info_id", S), ("list_price", D), ("raw_total_price", D), ("order_discount", D)),
    "dcspp_amtinfo_adj": _struct(("amount_info_id", S), ("adjustments", S)),
    "dcspp_price_adjust": _struct(("adjustment_id", S), ("adjustment", D), ("pricing_model", S)),
    "nt_product": _struct(("product_id", S), ("product_code", S)),
    "dcs_product": _struct(("product_id", S), ("display_name", S)),
    "nt_sku": _struct(("sku_code", S), ("sku_id", S)),
    "dcs_sku": _struct(("sku_id", S), ("display_name", S)),
    "dcspp_pay_group": _struct(("order_ref", S), ("payment_group_id", S), ("state", S), ("payment_method", S)),
    "oe_pay_group": _struct(("payment_group_id", S), ("no_of_payments", I)),
    "dps_user": _struct(
        ("id", S), ("first_name", S), ("last_name", S), ("email", S), ("date_of_birth", TS)),
    "dcspp_ship_group": _struct(("order_ref", S), ("shipping_group_id", S)),
    "nt_ship_group": _struct(("shipping_group_id", S), ("sched_deliv_date", TS)),
    "cit_product_refil": _struct(("sku_order", S), ("sku_rebuy", S), ("expiration", I), ("refillable", S)),
    "oe_product": _struct(("product_id", S), ("brand_id", S)),
    "oe_brand": _struct(("brand_id", S), ("name", S)),
    "cit_offer": _struct(("brand_order", S), ("brand_offer", S), ("interest", I), ("support", I)),
}

TARGETS: dict[str, T.StructType] = {
    "cit_refil": _struct(
        ("id_key", L), ("description", S), ("sku", S), ("refillable", S), ("expiration", TS),
        ("cf_id", S), ("cn_id", S), ("order_id", S)),
    "cit_opportunities": _struct(
        ("cn_id", S), ("cf_id", S), ("offer", S), ("refil", L), ("order_date", TS)),
    "cit_opp_errors": _struct(
        ("id", L), ("order_id", S), ("error", S), ("error_date", TS), ("error_code", I), ("source", S)),
}

# Rows the jobs set aside instead of failing or silently skipping.
QUARANTINE = _struct(("order_id", S), ("cf_id", S), ("cn_id", S), ("reason", S), ("source", S))

# Tables kept between runs so that a run need not read all orders again.
STATES: dict[str, T.StructType] = {
    # The latest orders of each customer (B4), ties kept.
    "latest_orders": _struct(("cf_id", S), ("order_date", TS), ("order_id", S)),
    # Per day, the brands that a customer bought from a consultant, and the last order of the day.
    "brand_days": _struct(("day", TS), ("cf_id", S), ("cn_id", S), ("brand_id", S), ("last_date", TS)),
    # The details table (O1), kept fresh by order.
    "order_details": _struct(
        ("cf_id", S), ("cn_id", S), ("order_number", S), ("order_number_broker", S), ("order_state", S), ("state", S),
        ("order_date", TS), ("sku_id", S), ("product_id", S), ("display_name", S), ("quantity", I), ("un_discount", D),
        ("un_price", D), ("raw_subtotal", D), ("raw_total_price", D), ("promotion_id", S), ("coupon_id", S),
        ("shipping", D), ("order_total", D), ("item_discount", D), ("customer_name", S), ("customer_email", S),
        ("customer_birthday", TS), ("creation_date", TS), ("last_modified_date", TS), ("deliver_date", TS),
        ("payment_method", S), ("city_state", S), ("image_url", S), ("installments", I), ("order_discount", D)),
}

# The order-details output (O1), in declared order.
ORDER_DETAILS_COLUMNS = STATES["order_details"].fieldNames()

REFILL_KEY = ["cn_id", "cf_id", "sku", "order_id"]
CANDIDATE_COLUMNS = ["order_id", "sku", "description", "refillable", "cf_id", "cn_id", "expiration"]


def conform(df: DataFrame, schema: T.StructType, empty_strings_as_null: bool = True) -> DataFrame:
    """Select and cast ``df`` to ``schema``; strings ``''`` become NULL, as the source dialect treats them."""
    cols: list[Column] = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if empty_strings_as_null and isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit(""))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
