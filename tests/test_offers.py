"""Hand fixtures H14-H19, H25 (FIXTURES.md section 3) for brand offers."""

import datetime as dt

from pyspark.sql import functions as F

from ordercraft.operators.offers import (
    BACKFILL_SCOPE, STAGED_SCOPE, also_offers, opportunity_upsert,
)
from ordercraft.operators.orders import backfill_orders, staged_orders
from tests.conftest import AS_OF, make_tables, rows, ts, world

BRANDS = {"sa": "A", "sb": "B"}


def staged_offers(t):
    driver, _ = staged_orders(t, AS_OF)
    return rows(also_offers(t, driver.select(F.col("profile_id").alias("cf_id")), AS_OF, STAGED_SCOPE),
                "cn_id", "cf_id", "offer")


def _shop(spark, offers, lines=(("O1", "sa", 1), ("O1", "sb", 1)), **kw):
    return world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], list(lines),
                 brands=BRANDS, offers=offers, **kw)


def test_h14_top_rule(spark):
    t = _shop(spark, [("A", "B", 9, 1), ("A", "C", 5, 2), ("B", "D", 5, 3), ("A", "D", None, 9), ("A", None, 99, 9)])
    assert staged_offers(t) == [("CN1", "U1", "Name D")]


def test_h15_tie_keeps_both_last_wins(spark):
    t = _shop(spark, [("A", "C", 5, 2), ("A", "D", 5, 2)], lines=[("O1", "sa", 1)])
    assert staged_offers(t) == [("CN1", "U1", "Name C"), ("CN1", "U1", "Name D")]
    driver, _ = staged_orders(t, AS_OF)
    offered = also_offers(t, driver.select(F.col("profile_id").alias("cf_id")), AS_OF)
    nxt, _, _ = opportunity_upsert(t.cit_opportunities, offered, t.cit_refil)
    assert rows(nxt, "cf_id", "offer") == [("U1", "Name D")]


def test_h16_null_support_at_top(spark):
    t = _shop(spark, [("A", "C", 5, None), ("A", "D", 4, 9)], lines=[("O1", "sa", 1)])
    assert staged_offers(t) == []


def test_h17_missing_brand_name(spark):
    t = _shop(spark, [("A", "C", 5, 2), ("A", "D", 4, 1)], lines=[("O1", "sa", 1)], unnamed_brands=["C"])
    assert staged_offers(t) == []


def test_h18_latest_consultant(spark):
    orders = [dict(order_id="O1", submitted="2024-05-02 10:00:00", cn="CN1"),
              dict(order_id="O2", submitted="2024-05-20 10:00:00", cn="CN2", pays=["AUTHORIZED"], staged=False)]
    t = world(spark, orders, [("O1", "sa", 1), ("O2", "sb", 1)], brands=BRANDS, offers=[("A", "C", 5, 2)])
    assert staged_offers(t) == [("CN2", "U1", "Name C")]
    driver = backfill_orders(t, dt.datetime(2024, 5, 1), AS_OF)
    ctx = driver.select(F.col("profile_id").alias("cf_id"), "cn_id")
    assert rows(also_offers(t, ctx, AS_OF, BACKFILL_SCOPE)) == []


def test_h19_several_stored_opportunities(spark):
    stored = [dict(cn_id="CN1", cf_id="U1", offer="X", refil=3, order_date=ts("2024-01-01 00:00:00")),
              dict(cn_id="CNX", cf_id="U1", offer="Y", refil=4, order_date=ts("2024-01-01 00:00:00"))]
    refil = [dict(id_key=10, cf_id="U1", cn_id="CN1", order_id="O1", sku="sa")]
    t = _shop(spark, [("A", "C", 5, 2)], lines=[("O1", "sa", 1)], cit_opportunities=stored, cit_refil=refil)
    driver, _ = staged_orders(t, AS_OF)
    offered = also_offers(t, driver.select(F.col("profile_id").alias("cf_id")), AS_OF)
    nxt, quarantine, _ = opportunity_upsert(t.cit_opportunities, offered, t.cit_refil)
    assert rows(nxt, "cn_id", "offer", "refil") == [("CN1", "X", None), ("CNX", "Y", None)]
    assert rows(quarantine, "cf_id", "reason") == [("U1", "several stored opportunities")]
    nxt, _, _ = opportunity_upsert(t.cit_opportunities, offered, t.cit_refil, clear_pointer_first=False)
    assert rows(nxt, "cn_id", "refil") == [("CN1", 3), ("CNX", 4)]


def test_h25_stored_null_consultant_replaced(spark):
    stored = [dict(cn_id=None, cf_id="U1", offer="OLD", refil=None, order_date=ts("2024-01-01 00:00:00"))]
    refil = [dict(id_key=10, cf_id="U1", cn_id="CN1", order_id="O1", sku="sa")]
    t = _shop(spark, [("A", "C", 5, 2)], lines=[("O1", "sa", 1)], cit_opportunities=stored, cit_refil=refil)
    driver, _ = staged_orders(t, AS_OF)
    offered = also_offers(t, driver.select(F.col("profile_id").alias("cf_id")), AS_OF)
    nxt, _, _ = opportunity_upsert(t.cit_opportunities, offered, t.cit_refil)
    assert rows(nxt, "cn_id", "cf_id", "offer", "refil") == [("CN1", "U1", "Name C", 10)]


def test_null_consultant_offer_is_quarantined(spark):
    t = make_tables(spark)
    offered = spark.createDataFrame(
        [(None, "U1", "Name C", ts("2024-05-01 00:00:00"))], "cn_id string, cf_id string, offer string, order_date timestamp_ntz")
    nxt, quarantine, _ = opportunity_upsert(t.cit_opportunities, offered, t.cit_refil)
    assert rows(nxt) == [] and rows(quarantine, "reason") == [("offer without consultant",)]
