"""Hand fixtures H6-H13, H20, H21 (FIXTURES.md section 3) for the refill job."""

import datetime as dt

from ordercraft.operators.orders import staged_orders
from ordercraft.operators.refill import refill_candidates, refill_purge, refill_upsert
from ordercraft.plans.jobs import checkpoint_cut, staged_plan
from tests.conftest import AS_OF, make_tables, rows, ts, world

D = dt.datetime


def candidates(spark, t):
    driver, _ = staged_orders(t, AS_OF)
    cand, quarantine = refill_candidates(t, driver, AS_OF, checkpoint_cut)
    return rows(cand, "sku", "description", "refillable", "expiration"), rows(quarantine, "order_id", "reason")


def test_h6_base_rule(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:30:00")], [("O1", "A", 1)],
              rules=[("A", "A", 30, "Y")])
    assert candidates(spark, t)[0] == [("A", "name A", "Y", D(2024, 5, 31))]


def test_h7_rebuy_in_order(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:30:00")], [("O1", "A", 1), ("O1", "B", 3)],
              rules=[("A", "B", 30, "Y"), ("B", "B", 20, "Y")])
    assert candidates(spark, t)[0] == [("B", "name B", "Y", D(2024, 7, 30))]


def test_h8_rebuy_not_in_order(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 00:00:00")], [("O1", "A", 1)],
              rules=[("A", "B", 30, "Y"), ("B", "B", 20, "Y")])
    assert candidates(spark, t)[0] == [("B", "name B", "Y", D(2024, 5, 31))]


def test_h9_repeated_rebuy_sku(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:30:00")],
              [("O1", "A", 1), ("O1", "B", 3), ("O1", "B", 1)],
              rules=[("A", "B", 30, "Y"), ("B", "B", 20, "Y")])
    got, quarantine = candidates(spark, t)
    assert got == [] and quarantine == [("O1", "refill sku on several lines of the order")]


def test_h10_cross_pairs(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 00:00:00")], [("O1", "A", 1)],
              rules=[("A", "A", 30, "Y"), ("A", "B", 40, "Y"), ("B", "B", 20, "Y")])
    assert candidates(spark, t)[0] == sorted([
        ("A", "name A", "Y", D(2024, 5, 31)), ("A", "name B", "Y", D(2024, 5, 31)),
        ("B", "name A", "Y", D(2024, 6, 10)), ("B", "name B", "Y", D(2024, 6, 10)),
    ], key=repr)


def test_h11_default_keeps_time(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:30:00")], [("O1", "X", 1)])
    assert candidates(spark, t)[0] == [("X", "name X", "N", D(2024, 7, 30, 10, 30))]


def test_h12_grace_edge(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-01-03 12:00:00"),
                      dict(order_id="O2", submitted="2024-01-03 11:59:00")],
              [("O1", "X", 1), ("O2", "Y", 1)])
    got = candidates(spark, t)[0]
    assert [g[0] for g in got] == ["X"]


def test_h13_purge(spark):
    t = make_tables(spark, cit_refil=[
        dict(id_key=1, sku="A", expiration=ts("2024-04-02 12:00:00")),
        dict(id_key=2, sku="B", expiration=ts("2024-04-02 00:00:00")),
        dict(id_key=3, sku="C", expiration=None),
    ])
    assert rows(refill_purge(t.cit_refil, AS_OF), "id_key") == [(1,), (3,)]


def _h20_world(spark, stored):
    return world(spark, [dict(order_id="O1", submitted="2024-05-01 10:30:00")], [("O1", "S1", 1), ("O1", "S2", 1)],
                 cit_refil=stored)


def _upsert(spark, t, mode):
    driver, _ = staged_orders(t, AS_OF)
    cand, _ = refill_candidates(t, driver, AS_OF, checkpoint_cut)
    nxt, rejected, _ = refill_upsert(t.cit_refil, checkpoint_cut(cand), driver, mode=mode)
    return rows(nxt, "id_key", "sku", "refillable", "expiration", "description")


def test_h20_first_row_exists(spark):
    stored = [dict(id_key=5, description="old", sku="S1", refillable="Y", expiration=ts("2024-01-01 00:00:00"),
                   cf_id="U1", cn_id="CN1", order_id="O1")]
    t = _h20_world(spark, stored)
    new_exp = D(2024, 7, 30, 10, 30)
    assert _upsert(spark, t, "first_row") == [(5, "S1", "N", new_exp, "old")]
    assert _upsert(spark, t, "per_row") == sorted([(5, "S1", "N", new_exp, "old"), (6, "S2", "N", new_exp, "name S2")],
                                                  key=repr)


def test_h21_first_row_missing(spark):
    stored = [dict(id_key=5, description="old", sku="S2", refillable="Y", expiration=ts("2024-01-01 00:00:00"),
                   cf_id="U1", cn_id="CN1", order_id="O1")]
    t = _h20_world(spark, stored)
    new_exp = D(2024, 7, 30, 10, 30)
    assert _upsert(spark, t, "first_row") == sorted([
        (5, "S2", "Y", D(2024, 1, 1), "old"), (6, "S1", "N", new_exp, "name S1"), (6, "S2", "N", new_exp, "name S2"),
    ], key=repr)


def test_staged_stage_purges_after_upsert(spark):
    stored = [dict(id_key=9, description="stale", sku="Z", refillable="N", expiration=ts("2023-01-01 00:00:00"),
                   cf_id="U9", cn_id="CN9", order_id="O9")]
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:30:00")], [("O1", "X", 1)], cit_refil=stored)
    out = staged_plan(t, AS_OF)
    assert rows(out.refil, "id_key", "sku") == [(10, "X")]
