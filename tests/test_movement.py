"""What is written and moved: only the tables that a job reads, and lines once by order."""

from __future__ import annotations

import re
from decimal import Decimal as D
from pathlib import Path

from pyspark.sql import types as T

import __spark_entry__ as E
from ordercraft.operators.details import order_details
from ordercraft.operators.orders import staged_orders
from ordercraft.operators.refill import refill_candidates
from ordercraft.plans import jobs
from ordercraft.session import small_broadcasts
from ordercraft.sources.binding import _fx_line, bind_test_tables
from ordercraft.sources.tables import TableStore
from tests.conftest import AS_OF, make_tables, rows, world

SMOKE = "/root/testdata/sf0.001"


def test_only_tables_that_are_read_are_written_and_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ordercraft.sources.binding._MATERIALIZED", {})
    monkeypatch.setattr("ordercraft.session.ensure_checkpoint_dir", lambda s: str(tmp_path))
    written = lambda: {p.name for p in tmp_path.glob("ordercraft-binding-*/*")}
    t = bind_test_tables(spark, SMOKE)
    assert written() == set()
    plain = bind_test_tables(spark, SMOKE, materialize=False)
    assert rows(t.dcspp_order) == rows(plain.dcspp_order) and written() == {"dcspp_order"}
    other = t.replace(oe_order=t.dcspp_order.select("order_id"))
    assert rows(other.dcspp_item) == rows(plain.dcspp_item)
    assert written() == {"dcspp_order", "_fx_line", "dcspp_item"}
    assert other.oe_order.columns == ["order_id"] and set(other) == set(plain)
    assert rows(bind_test_tables(spark, SMOKE).dcspp_item) == rows(plain.dcspp_item)
    assert len([*Path(tmp_path).glob("ordercraft-binding-*")]) == 1
    assert rows(t["cit_refil"]) == rows(plain["cit_refil"]) and t.get("none") is None


def test_numbering_lines_does_not_move_columns_that_decide_nothing(spark):
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax".split()
    schema = T.StructType([T.StructField(n, T.DoubleType() if n[2:] in ("quantity", "extendedprice", "discount", "tax")
                                         else T.LongType()) for n in names])
    data = [(7, 5, 1, 1, 2.0, 9.0, 0.1, 0.2), (7, 5, 1, 1, 2.0, 3.0, 0.1, 0.2), (7, 5, 1, 1, 2.0, 3.0, 0.1, None),
            (7, 2, 1, 2, 4.0, 1.0, 0.0, 0.0), (8, 3, None, 1, None, None, None, None)]
    df = _fx_line(spark.createDataFrame(data, schema))
    assert sorted(map(tuple, df.collect())) == [(7, 2, 4, 2, 1), (7, 5, 2, 1, 2), (7, 5, 2, 1, 3), (7, 5, 2, 1, 4), (8, 3, None, 3, 1)]
    # Named by the table alone, neither by the window nor by the columns kept for it.
    assert df._jdf.queryExecution().optimizedPlan().toString().count("l_extendedprice") == 1


def test_lines_of_the_details_move_once_by_order(spark):
    t = make_tables(
        spark,
        dcspp_order=[dict(order_id="O1", profile_id="U1", price_info="OP1")], oe_order=[dict(order_id="O1", order_number="B1")],
        nt_order=[dict(order_id="O1", cn_id="CN1")], dps_user=[dict(id="U1")],
        # The same line three times; a line without a price id; a line of another product that is not mapped.
        dcspp_order_item=[dict(order_id="O1", commerce_items=i) for i in ("I1", "I1", "I2", "I3", "I4")],
        dcspp_item=[dict(commerce_item_id="I1", catalog_ref_id="S1", product_id="P1", quantity=2, price_info="IP1"),
                    dict(commerce_item_id="I2", catalog_ref_id="S1", product_id="P1", quantity=2, price_info="IP1"),
                    dict(commerce_item_id="I3", catalog_ref_id=None, product_id="P1", quantity=1, price_info=None),
                    dict(commerce_item_id="I4", catalog_ref_id="S2", product_id="P2", quantity=1, price_info="IP1")],
        dcspp_item_price=[dict(amount_info_id="IP1", list_price=10, raw_total_price=20, order_discount=0)],
        dcspp_amtinfo_adj=[dict(amount_info_id="IP1", adjustments="A1"), dict(amount_info_id="IP1", adjustments="A2")],
        dcspp_price_adjust=[dict(adjustment_id="A1", adjustment=-1, pricing_model="M1"),
                            dict(adjustment_id="A2", adjustment=-1, pricing_model="M2")],
        nt_product=[dict(product_id="P1")], dcs_product=[dict(product_id="P1", display_name="N1"), dict(product_id="P2", display_name="N2")],
        dcspp_pay_group=[dict(order_ref="O1", payment_group_id="PG1", state="SETTLED", payment_method="card")],
        dcspp_ship_group=[dict(order_ref="O1", shipping_group_id="SG1")])
    out = order_details(t, image_prefix="//i/")
    got = sorted(((r["sku_id"], r["image_url"], r["un_price"], r["promotion_id"]) for r in out.collect()), key=str)
    assert got == [("S1", "//i/S1_1.jpg", D("10.00"), "M1"), ("S1", "//i/S1_1.jpg", D("10.00"), "M2"), (None, "//i/_1.jpg", None, None)]
    plan = out._jdf.queryExecution().sparkPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"hashpartitioning\(([^()]*)\)", plan)
    assert moved and max(m.count("#") for m in moved) <= 2  # no shuffle by all columns of a line


def joins(df) -> int:
    return len(re.findall(r"Join (?:Inner|Left)", df._jdf.queryExecution().optimizedPlan().toString()))


def test_no_step_of_the_refill_job_holds_all_its_joins(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 00:00:00")], [("O1", "A", 1), ("O1", "C", 1)],
              rules=[("A", "A", 30, "Y"), ("A", "B", 40, "Y"), ("B", "B", 20, "Y")])
    steps = []

    def cut(df):
        steps.append(joins(df))
        return jobs.checkpoint_cut(df)

    driver, held = staged_orders(t, AS_OF, cut)
    candidates, repeated = refill_candidates(t, driver, AS_OF, cut)
    # A step's joins by order id run in one task, where each takes memory of its own.
    assert max([*steps, *map(joins, (driver, held, candidates, repeated))]) <= 5
    plain = staged_orders(t, AS_OF)[0]
    assert rows(candidates) == rows(refill_candidates(t, plain, AS_OF)[0]) and candidates.count() == 5


def test_queries_read_the_processed_orders_from_a_written_table(spark):
    assert joins(E.q_refill_rebuy(spark, SMOKE)) <= 3
    assert all(joins(start(spark, SMOKE)[1]) == 0 for start in (E._staged, E._backfill, E._staged_lines))


def test_a_run_broadcasts_small_tables_only(spark, tmp_path):
    limit, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before, seen = spark.conf.get(limit), []

    def work(t):
        seen.append(spark.conf.get(limit))
        return jobs.staged_work(t, AS_OF, jobs.Options())

    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 00:00:00")], [("O1", "A", 1)])
    jobs._commit(TableStore(spark, str(tmp_path)), t, AS_OF, jobs.Options(), None, work)
    assert seen == [str(1 << 20)] and spark.conf.get(limit) == before and spark.conf.get(adaptive, None) is None
    try:
        spark.conf.set(limit, "-1")
        spark.conf.set(adaptive, "64MB")
        with small_broadcasts(spark):
            assert (spark.conf.get(limit), spark.conf.get(adaptive)) == ("-1", str(1 << 20))
        assert (spark.conf.get(limit), spark.conf.get(adaptive)) == ("-1", "64MB")
    finally:
        spark.conf.set(limit, before)
        spark.conf.unset(adaptive)
