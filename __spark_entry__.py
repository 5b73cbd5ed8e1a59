"""

``entry(spark)`` runs the flagship query (order details) on sf0.001;
``oracle_sql()`` gives the DuckDB statement each is checked against. Every query
derives its input tables from the driver tables in ``sf_dir`` (FIXTURES.md
section 2), so its work grows with them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordercraft.checks.oracle_sql import IMAGE_PREFIX, oracle_queries
from ordercraft.functions.scalars import add_months_keep_time, customer_name, plus_days, trunc_day, ts_lit
from ordercraft.operators import details, offers, orders, refill
from ordercraft.operators.checks import not_null, unique
from ordercraft.plans import jobs, refresh
from ordercraft.session import ensure_checkpoint_dir
from ordercraft.sources import ingest
from ordercraft.sources.binding import Tables, bind_test_tables
from ordercraft.sources.tables import TableStore

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixture parameters (FIXTURES.md section 2).
AS_OF = dt.datetime(2001, 8, 1, 12, 0, 0)
START = dt.datetime(2001, 1, 1)


def entry(spark: SparkSession) -> DataFrame:
    return details.order_details(bind_test_tables(spark, SMOKE_DIR), image_prefix=IMAGE_PREFIX)


def _tables(spark: SparkSession, sf_dir: str):
    return bind_test_tables(spark, sf_dir)


def _staged(spark, sf_dir):
    """The staged orders, written: several steps of a query read them."""
    t = _tables(spark, sf_dir)
    driver, _ = orders.staged_orders(t, AS_OF, jobs.checkpoint_cut)
    return t, jobs.checkpoint_cut(driver)


def _backfill(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return t, jobs.checkpoint_cut(orders.backfill_orders(t, START, AS_OF))


def _staged_lines(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    return t, jobs.checkpoint_cut(refill.order_lines(t, driver.select("order_id").distinct()))


def _contexts(driver: DataFrame) -> DataFrame:
    return driver.select(F.col("profile_id").alias("cf_id"), "cn_id")


def q_order_details(spark, sf_dir):
    return details.order_details(_tables(spark, sf_dir), image_prefix=IMAGE_PREFIX, cut=jobs.packed_cut)


def q_order_details_legacy(spark, sf_dir):
    return details.order_details(_tables(spark, sf_dir), require_product_map=False, image_prefix=IMAGE_PREFIX, cut=jobs.packed_cut)


def q_installments_first(spark, sf_dir):
    return details.installments_first(_tables(spark, sf_dir))


def q_order_discount_sum(spark, sf_dir):
    return details.order_discount_sum(_tables(spark, sf_dir))


def q_unit_discount(spark, sf_dir):
    return details.unit_discounts(_tables(spark, sf_dir))


def q_customer_name_concat(spark, sf_dir):
    return _tables(spark, sf_dir).dps_user.select("id", customer_name("first_name", "last_name").alias("customer_name"))


def q_months_cutoff(spark, sf_dir):
    return _tables(spark, sf_dir).dcspp_order.select(
        "order_id", "submitted_date", add_months_keep_time("submitted_date", -12).alias("cutoff"))


def q_expiry_arithmetic(spark, sf_dir):
    t = _tables(spark, sf_dir)
    lines = refill.order_lines(t, t.dcspp_order.select("order_id"))
    due = plus_days("submitted_date", F.col("expiration"))
    return (
        lines.select("order_id", F.col("sku").alias("sku_order"))
        .join(t.cit_product_refil.select("sku_order", "sku_rebuy", "expiration"), "sku_order")
        .join(t.dcspp_order.select("order_id", "submitted_date"), "order_id")
        .select("order_id", "sku_order", "sku_rebuy", due.alias("due"), trunc_day(due).alias("due_day"),
                (plus_days(due, refill.GRACE_DAYS) >= ts_lit(AS_OF)).alias("in_grace"))
        .distinct()
    )


def q_staged_orders(spark, sf_dir):
    return _staged(spark, sf_dir)[1]


def q_backfill_orders(spark, sf_dir):
    return _backfill(spark, sf_dir)[1]


def q_order_quarantine(spark, sf_dir):
    return orders.order_quarantine(_tables(spark, sf_dir), AS_OF)


def q_refill_rebuy(spark, sf_dir):
    t, lines = _staged_lines(spark, sf_dir)
    return refill.refill_rebuy(t, lines)


def q_refill_base(spark, sf_dir):
    t, lines = _staged_lines(spark, sf_dir)
    return refill.refill_base(t, lines)


def q_refill_default(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    order_set = driver.select("order_id", "submitted_date", "profile_id").distinct()
    return refill.default_candidates(t, order_set, refill.order_lines(t, order_set), AS_OF)


def q_refill_candidates(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    return refill.refill_candidates(t, driver, AS_OF, jobs.checkpoint_cut)[0]


def q_refill_candidates_cn(spark, sf_dir):
    t, driver = _backfill(spark, sf_dir)
    return refill.refill_candidates(t, driver, AS_OF, jobs.checkpoint_cut)[0]


def q_refill_quarantine(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    return refill.refill_candidates(t, driver, AS_OF, jobs.checkpoint_cut)[1]


def q_refill_upsert(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    candidates, _ = refill.refill_candidates(t, driver, AS_OF, jobs.checkpoint_cut)
    return refill.refill_upsert(t.cit_refil, jobs.checkpoint_cut(candidates), driver, cut=jobs.checkpoint_cut)[0]


def q_refill_upsert_per_row(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    candidates, _ = refill.refill_candidates(t, driver, AS_OF, jobs.checkpoint_cut)
    return refill.refill_upsert(t.cit_refil, jobs.checkpoint_cut(candidates), driver, mode="per_row", cut=jobs.checkpoint_cut)[0]


def q_refill_purge(spark, sf_dir):
    return refill.refill_purge(_tables(spark, sf_dir).cit_refil, AS_OF)


def q_refill_reset(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return refill.refill_reset(t, t.cit_refil, START)


def q_brand_affinity(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    return offers.brand_affinity(t, _contexts(driver), AS_OF, offers.STAGED_SCOPE)


def q_brand_affinity_cn(spark, sf_dir):
    t, driver = _backfill(spark, sf_dir)
    return offers.brand_affinity(t, _contexts(driver), AS_OF, offers.BACKFILL_SCOPE)


def q_eligible_rules(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    return offers.eligible_rules(t, offers.brand_affinity(t, _contexts(driver), AS_OF))


def q_top_rules(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    return offers.top_rules(offers.eligible_rules(t, offers.brand_affinity(t, _contexts(driver), AS_OF)))


def q_latest_consultant(spark, sf_dir):
    return offers.latest_consultant(_tables(spark, sf_dir))


def q_also_offers(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    return offers.also_offers(t, _contexts(driver), AS_OF, offers.STAGED_SCOPE)


def q_also_offers_cn(spark, sf_dir):
    t, driver = _backfill(spark, sf_dir)
    return offers.also_offers(t, _contexts(driver), AS_OF, offers.BACKFILL_SCOPE)


def q_refill_pointer(spark, sf_dir):
    return offers.refill_pointer(_tables(spark, sf_dir).cit_refil)


def q_opportunity_upsert(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    offered = jobs.checkpoint_cut(
        offers.also_offers(t, _contexts(driver), AS_OF, offers.STAGED_SCOPE, jobs.checkpoint_cut))
    return offers.opportunity_upsert(t.cit_opportunities, offered, t.cit_refil, offers.STAGED_SCOPE, True)[0]


def q_opportunity_upsert_cn(spark, sf_dir):
    t, driver = _backfill(spark, sf_dir)
    offered = jobs.checkpoint_cut(
        offers.also_offers(t, _contexts(driver), AS_OF, offers.BACKFILL_SCOPE, jobs.checkpoint_cut))
    current = offers.opportunity_reset(t.cit_opportunities, START)
    return offers.opportunity_upsert(current, offered, t.cit_refil, offers.BACKFILL_SCOPE, False)[0]


def q_opportunity_reset(spark, sf_dir):
    return offers.opportunity_reset(_tables(spark, sf_dir).cit_opportunities, START)


def q_run_staged_refill(spark, sf_dir):
    return jobs.staged_plan(_tables(spark, sf_dir), AS_OF).refil


def q_run_staged_opportunities(spark, sf_dir):
    return jobs.staged_plan(_tables(spark, sf_dir), AS_OF).opportunities


def q_run_backfill_refill(spark, sf_dir):
    return jobs.backfill_plan(_tables(spark, sf_dir), START, AS_OF).refil


def q_run_backfill_opportunities(spark, sf_dir):
    return jobs.backfill_plan(_tables(spark, sf_dir), START, AS_OF).opportunities


def q_run_staged_quarantine(spark, sf_dir):
    return jobs.staged_plan(_tables(spark, sf_dir), AS_OF).quarantine


def q_run_backfill_quarantine(spark, sf_dir):
    return jobs.backfill_plan(_tables(spark, sf_dir), START, AS_OF).quarantine


def q_error_rows(spark, sf_dir):
    return jobs.staged_plan(_tables(spark, sf_dir), AS_OF).errors


def q_error_rows_cn(spark, sf_dir):
    return jobs.backfill_plan(_tables(spark, sf_dir), START, AS_OF).errors


def q_refill_candidates_paired(spark, sf_dir):
    t, driver = _staged(spark, sf_dir)
    return refill.refill_candidates(t, driver, AS_OF, jobs.checkpoint_cut, pair_on_rebuy=True)[0]


def q_run_staged_opportunities_view(spark, sf_dir):
    """S3: the offers point into a given view, here the stored reminders that expire from the start date on."""
    t = _tables(spark, sf_dir)
    view = t.cit_refil.where(F.col("expiration") >= ts_lit(START)).select("cf_id", "cn_id", "id_key")
    return jobs.staged_plan(t, AS_OF, jobs.Options(pointer_view=view)).opportunities


# -- inserts under unique constraints ---------------------------------------------------------

# Two constraints that overlap in the SKU, so that a row rejected by one can leave a key of the other free.
UNIQUE = [not_null("cit_refil", "sku"), unique("cit_refil", "cf_id", "sku"), unique("cit_refil", "sku", "cn_id", "refillable")]


def _staged_unique(spark, sf_dir):
    return jobs.staged_plan(_tables(spark, sf_dir), AS_OF, jobs.Options(refill_checks=UNIQUE))


def q_run_staged_refill_unique(spark, sf_dir):
    return _staged_unique(spark, sf_dir).refil


def q_error_rows_unique(spark, sf_dir):
    return _staged_unique(spark, sf_dir).errors


# -- runs and kept tables in a store ----------------------------------------------------------

_STORES: dict[tuple, TableStore] = {}


def _store(spark, *tables: tuple[str, DataFrame]) -> TableStore:
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/ordercraft-store-{uuid.uuid4().hex}", buckets=4)
    store.seed(dict(tables))
    return store


def _run_store(spark, sf_dir, kind: str) -> TableStore:
    """A store seeded with the stored targets, after one run."""
    key = (id(spark), sf_dir, kind)
    if key not in _STORES:
        t = _tables(spark, sf_dir)
        store = _store(spark, *((n, t[n]) for n in ("cit_refil", "cit_opportunities", "cit_opp_errors")))
        if kind == "staged":
            jobs.run_staged(t, AS_OF, store)
        elif kind == "backfill":
            jobs.run_backfill(t, START, AS_OF, store)
        else:
            state = store.state()
            store.commit(state, {"cit_refil": jobs.purged_pieces(store, state, state.tables["cit_refil"], AS_OF)})
        _STORES[key] = store
    return _STORES[key]


def _stored(kind: str, table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _run_store(spark, sf_dir, kind).read(table)


def _number(column: str) -> Column:
    """The driver table's key inside a derived id."""
    return F.regexp_extract(column, r"^[A-Z]+(\d+)", 1).cast("long")


def q_latest_consultant_kept(spark, sf_dir):
    """Orders arrive in three parts that are not in order of date, some with a date that a later part corrects."""
    t = _tables(spark, sf_dir)
    k = _number("order_id")
    wrong = F.when(k % 21 == 0, F.col("submitted_date") + F.expr("interval 400 days")).otherwise(F.col("submitted_date"))
    store = _store(spark)
    for part in range(3):
        seen = t.dcspp_order.where(k % 3 <= part)
        seen = seen if part == 2 else seen.withColumn("submitted_date", wrong)
        new = seen.where((k % 3 == part) | ((k % 21 == 0) if part == 2 else F.lit(False)))
        refresh.refresh_latest(store, t.replace(dcspp_order=seen), new.select("order_id"))
    return offers.latest_consultant(t, latest=store.read("latest_orders"))


MOMENTS = [dt.datetime(2001, 6, 1, 12), dt.datetime(2001, 7, 1, 12), AS_OF]


def q_brand_affinity_sliding(spark, sf_dir):
    """The brands at three moments, each from the kept days and the orders submitted since the moment before."""
    t, driver = _staged(spark, sf_dir)
    store, out, last = _store(spark), [], None
    for moment in MOMENTS:
        seen = t.dcspp_order.where(F.col("submitted_date") <= ts_lit(moment))
        new = seen if last is None else seen.where(F.col("submitted_date") > ts_lit(last))
        refresh.refresh_brand_days(store, t.replace(dcspp_order=seen), new, moment)
        brands = refresh.kept_affinity(store)(_contexts(driver), moment, offers.STAGED_SCOPE)
        out.append(brands.select(ts_lit(moment).alias("as_of"), "cf_id", "brand_id"))
        last = moment
    return reduce(DataFrame.unionByName, out)


def q_run_staged_opportunities_kept(spark, sf_dir):
    """The staged job with brands and latest orders from kept states."""
    t = _tables(spark, sf_dir)
    store = _store(spark)
    refresh.refresh_latest(store, t, t.dcspp_order)
    refresh.refresh_brand_days(store, t, t.dcspp_order, AS_OF)
    options = jobs.Options(affinity=refresh.kept_affinity(store), latest=store.read("latest_orders"))
    return jobs.staged_plan(t, AS_OF, options).opportunities


def _older(t: Tables) -> tuple[Tables, dict[str, DataFrame]]:
    """The tables before some rows changed, and the keys of these rows."""
    price, ship, order = _number("amount_info_id"), _number("shipping_group_id"), _number("order_id")
    old = t.replace(
        dcspp_item_price=t.dcspp_item_price.withColumn(
            "list_price", F.when(price % 17 == 0, F.col("list_price") + 1).otherwise(F.col("list_price")).cast("decimal(19,2)")),
        nt_ship_group=t.nt_ship_group.where(ship % 23 != 0),
        dcspp_order=t.dcspp_order.withColumn("state", F.when(order % 19 == 0, "INCOMPLETE").otherwise(F.col("state"))))
    changes = {
        "dcspp_item_price": t.dcspp_item_price.where(price % 17 == 0), "nt_ship_group": t.nt_ship_group.where(ship % 23 == 0),
        "dcspp_order": t.dcspp_order.where(order % 19 == 0)}
    return old, changes


def q_order_details_refreshed(spark, sf_dir):
    """The stored details of older tables, refreshed by the orders that changed since."""
    t = _tables(spark, sf_dir)
    old, changes = _older(t)
    store = _store(spark)
    refresh.load_details(store, old, image_prefix=IMAGE_PREFIX)
    refresh.refresh_details(store, t, refresh.affected_orders(t, changes), image_prefix=IMAGE_PREFIX)
    return store.read("order_details")


def q_order_details_hot(spark, sf_dir):
    """The details when the lines of all even orders belong to one order, which is joined in pieces."""
    t = _tables(spark, sf_dir)
    last = t.dcspp_order.where(_number("order_id") % 59 != 0).agg(F.max(_number("order_id"))).first()[0]
    owner = F.when(_number("order_id") % 2 == 0, F.lit(f"O{last}")).otherwise(F.col("order_id"))
    t = t.replace(dcspp_order_item=t.dcspp_order_item.withColumn("order_id", owner))
    return details.order_details(t, image_prefix=IMAGE_PREFIX, hot_lines=100, cut=jobs.packed_cut)


def q_order_details_view(spark, sf_dir):
    """SQL over the named view."""
    details.create_order_details_view(_tables(spark, sf_dir), "order_details_of_the_shop", image_prefix=IMAGE_PREFIX, cut=jobs.packed_cut)
    return spark.sql("""
        select order_state, payment_method, count(*) as n, sum(quantity) as pieces, sum(un_price * quantity) as worth,
               sum(un_discount) as discount, count(distinct cf_id) as customers
        from order_details_of_the_shop group by order_state, payment_method""")


# -- lossless ingest --------------------------------------------------------------------------


def _raw_prices(spark, sf_dir) -> DataFrame:
    """Item prices as a text export: three decimals, some spelled out, some too large."""
    lk, ln = F.col("l_orderkey"), F.col("ln")
    price = F.concat((10 + F.col("l_partkey") % 50).cast("string"), F.lit("."), F.lpad((lk % 40).cast("string"), 3, "0"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", F.col("l_linenumber").alias("ln"), F.col("l_suppkey").alias("sk"))
    return lines.select(
        F.concat(F.lit("IP"), lk.cast("string"), F.lit("-"), ln.cast("string"), F.lit("-"), F.col("sk").cast("string")).alias("amount_info_id"),
        F.when(lk % 101 == 0, F.lit("ten")).otherwise(price).alias("list_price"),
        F.when(lk % 103 == 0, F.concat(price, F.lit("e17"))).otherwise(F.concat(F.lit(" "), ln.cast("string"))).alias("raw_total_price"),
        F.when(ln % 3 != 0, (ln % 4).cast("string")).otherwise(F.lit("")).alias("order_discount"))


def q_ingest_item_prices(spark, sf_dir):
    return ingest.split(_raw_prices(spark, sf_dir), "dcspp_item_price")[0]


def q_ingest_rejects(spark, sf_dir):
    return ingest.split(_raw_prices(spark, sf_dir), "dcspp_item_price")[1].drop("record")


def q_ingest_profile(spark, sf_dir):
    return ingest.profile(_raw_prices(spark, sf_dir), "dcspp_item_price")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "order_details": q_order_details,
    "order_details_legacy": q_order_details_legacy,
    "installments_first": q_installments_first,
    "order_discount_sum": q_order_discount_sum,
    "unit_discount": q_unit_discount,
    "customer_name_concat": q_customer_name_concat,
    "months_cutoff": q_months_cutoff,
    "expiry_arithmetic": q_expiry_arithmetic,
    "staged_orders": q_staged_orders,
    "backfill_orders": q_backfill_orders,
    "order_quarantine": q_order_quarantine,
    "refill_rebuy": q_refill_rebuy,
    "refill_base": q_refill_base,
    "refill_default": q_refill_default,
    "refill_candidates": q_refill_candidates,
    "refill_candidates_cn": q_refill_candidates_cn,
    "refill_quarantine": q_refill_quarantine,
    "refill_upsert": q_refill_upsert,
    "refill_upsert_per_row": q_refill_upsert_per_row,
    "refill_purge": q_refill_purge,
    "refill_reset": q_refill_reset,
    "brand_affinity": q_brand_affinity,
    "brand_affinity_cn": q_brand_affinity_cn,
    "eligible_rules": q_eligible_rules,
    "top_rules": q_top_rules,
    "latest_consultant": q_latest_consultant,
    "also_offers": q_also_offers,
    "also_offers_cn": q_also_offers_cn,
    "refill_pointer": q_refill_pointer,
    "opportunity_upsert": q_opportunity_upsert,
    "opportunity_upsert_cn": q_opportunity_upsert_cn,
    "opportunity_reset": q_opportunity_reset,
    "run_staged_refill": q_run_staged_refill,
    "run_staged_opportunities": q_run_staged_opportunities,
    "run_backfill_refill": q_run_backfill_refill,
    "run_backfill_opportunities": q_run_backfill_opportunities,
    "run_staged_quarantine": q_run_staged_quarantine,
    "run_backfill_quarantine": q_run_backfill_quarantine,
    "error_rows": q_error_rows,
    "error_rows_cn": q_error_rows_cn,
    "refill_candidates_paired": q_refill_candidates_paired,
    "run_staged_opportunities_view": q_run_staged_opportunities_view,
    "run_staged_refill_unique": q_run_staged_refill_unique,
    "error_rows_unique": q_error_rows_unique,
    "run_staged_store_refill": _stored("staged", "cit_refil"),
    "run_staged_store_opportunities": _stored("staged", "cit_opportunities"),
    "run_staged_store_errors": _stored("staged", "cit_opp_errors"),
    "run_staged_store_quarantine": _stored("staged", "quarantine"),
    "run_backfill_store_refill": _stored("backfill", "cit_refil"),
    "run_backfill_store_opportunities": _stored("backfill", "cit_opportunities"),
    "refill_purge_store": _stored("purge", "cit_refil"),
    "latest_consultant_kept": q_latest_consultant_kept,
    "brand_affinity_sliding": q_brand_affinity_sliding,
    "run_staged_opportunities_kept": q_run_staged_opportunities_kept,
    "order_details_refreshed": q_order_details_refreshed,
    "order_details_hot": q_order_details_hot,
    "order_details_view": q_order_details_view,
    "ingest_item_prices": q_ingest_item_prices,
    "ingest_rejects": q_ingest_rejects,
    "ingest_profile": q_ingest_profile,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **(_llm().QUERIES if _llm() else {})}


def _llm():
    """The training-data queries, if that subpackage is installed."""
    spec = find_spec("ordercraft.llm")
    if spec is None or spec.origin is None:  # absent, or an empty folder
        return None
    from ordercraft.llm import queries as llm_queries

    return llm_queries


def oracle_sql() -> dict[str, str]:
    """DuckDB statement per query over the pre-registered driver tables."""
    return {**oracle_queries(), **(_llm().ORACLES if _llm() else {})}
