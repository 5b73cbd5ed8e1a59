"""What is on disk at a time: the shuffles of one step, the stage tables that are still read, one wave of the store."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ordercraft.operators import details
from ordercraft.plans import jobs, refresh
from ordercraft.session import FREE_SHUFFLES, materialize, steps
from ordercraft.sources.binding import bind_test_tables
from ordercraft.sources.tables import TableStore, bucket_of
from tests.conftest import make_tables, rows
from tests.test_movement import joins

SMOKE = "/root/testdata/sf0.001"
FULL = details.ORDER_DETAILS_COLUMNS


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def shuffle_files(spark) -> set[str]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(p) for d in dirs for p in Path(d.getPath()).glob("*/shuffle_*")}


def left_over(spark, before: set[str]) -> set[str]:
    """Shuffle files since ``before``; they are removed in the background."""
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_shuffles_go_with_the_query_that_made_them(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k")).repartition(3, "k").groupBy("k").count()
    setting, before = spark.conf.get(FREE_SHUFFLES, None), shuffle_files(spark)
    assert rows(materialize(df)) == rows(df) and shuffle_files(spark) - before  # those of the last plan, which may run again
    before = shuffle_files(spark)
    written = materialize(df)
    store = TableStore(spark, str(tmp_path))
    store.write("quarantine", df.selectExpr("cast(k as string) as order_id", "'U' as cf_id", "'C' as cn_id", "'x' as reason", "'y' as source"))
    assert not left_over(spark, before)
    assert written.count() == 7 and spark.conf.get(FREE_SHUFFLES, None) == setting


@pytest.mark.parametrize("mapped", [True, False])
def test_details_in_steps(spark, tmp_path, monkeypatch, no_broadcast, mapped):
    t = bind_test_tables(spark, SMOKE)
    plain = rows(details.order_details(t, mapped), *FULL)
    before = shuffle_files(spark)
    monkeypatch.setattr("ordercraft.session.ensure_checkpoint_dir", lambda s: str(tmp_path))
    out = details.order_details(t, mapped, cut=jobs.packed_cut)
    # Lines, heads, payments and shipments; other steps and all shuffles are gone before the result runs.
    assert [p.name[:14] for p in tmp_path.iterdir()] == ["ordercraft-cut"] * 4
    assert not left_over(spark, before)
    assert joins(out) == 5 and rows(out, *FULL) == plain


def test_steps_of_repeated_and_missing_keys(spark):
    """Rows that come twice, NULL keys and a hot order: in steps as in one plan."""
    n = range(40)
    t = make_tables(
        spark,
        dcspp_order=[dict(order_id=o, profile_id=u, price_info=p, state="S") for o, u, p in
                     [("O1", "U1", "OP1"), ("O1", "U1", "OP1"), ("O1", "U2", None), ("O2", "U1", "OP2"), (None, "U1", "OP1"), ("O3", None, "OP1")]],
        oe_order=[dict(order_id=o, order_number=b) for o, b in [("O1", "B1"), ("O1", "B2"), ("O2", None), (None, "B")]],
        nt_order=[dict(order_id=o, cn_id=c) for o, c in [("O1", "C1"), ("O1", "C1"), ("O2", None), ("O3", "C1")]],
        dps_user=[dict(id=u, email=u) for u in ("U1", "U1", "U2", None)],
        dcspp_order_item=[dict(order_id="O1" if i % 4 else "O2", commerce_items=f"I{i}" if i else None) for i in n],
        dcspp_item=[dict(commerce_item_id=f"I{i}", catalog_ref_id=f"S{i % 9}" if i % 5 else None, product_id=f"P{i % 3}",
                         quantity=i % 4, price_info=f"A{i % 6}" if i % 7 else None) for i in n],
        dcspp_order_price=[dict(amount_info_id=a, raw_subtotal=s, shipping=1) for a, s in [("OP1", -2), ("OP1", 5), ("OP2", None)]],
        dcspp_item_price=[dict(amount_info_id=a, list_price=3, raw_total_price=9) for a in ("A1", "A1", "A2", "A3", None)],
        dcspp_amtinfo_adj=[dict(amount_info_id=a, adjustments=j) for a in ("A1", "A2", "A4", "OP1", None) for j in ("J1", "J2", "J2", "J9", None)],
        dcspp_price_adjust=[dict(adjustment_id=j, adjustment=v, pricing_model="M") for j, v in [("J1", -2), ("J2", 6), ("J2", -1), (None, -4)]],
        nt_product=[dict(product_id=p) for p in ("P1", "P1", "P2")],
        dcs_product=[dict(product_id=p, display_name=d) for p, d in [("P1", "a"), ("P1", "b"), ("P2", None), ("P0", "c")]],
        dcspp_pay_group=[dict(order_ref=o, payment_group_id=p, state="X") for o, p in [("O1", "G1"), ("O1", "G1"), ("O1", None), ("O2", "G2")]],
        oe_pay_group=[dict(payment_group_id="G1", no_of_payments=k) for k in (3, 2)],
        dcspp_ship_group=[dict(order_ref=o, shipping_group_id=s) for o, s in [("O1", "H1"), ("O1", None), ("O2", "H2"), (None, "H1")]],
        nt_ship_group=[dict(shipping_group_id="H1", sched_deliv_date="2024-01-02 00:00:00")])
    plain = rows(details.order_details(t), *FULL)
    assert plain and len(set(plain)) == len(plain)
    assert rows(details.order_details(t, cut=jobs.packed_cut), *FULL) == plain
    assert rows(details.order_details(t, hot_lines=3, cut=jobs.packed_cut), *FULL) == plain


def test_tables_kept_by_a_step_outlive_its_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ordercraft.session.ensure_checkpoint_dir", lambda s: str(tmp_path))
    df = spark.range(3)
    with steps(spark, jobs.checkpoint_cut) as (step, keep):
        kept = keep(step(df))
        assert len([*tmp_path.iterdir()]) == 2
    assert kept.count() == 3 and len([*tmp_path.iterdir()]) == 1
    with steps(spark, None) as (step, keep):
        assert step(df) is df and keep(df) is df


def test_queries_leave_the_join_by_order_only(spark):
    for query in (E.q_order_details, E.q_order_details_legacy, E.q_order_details_hot):
        assert joins(query(spark, SMOKE)) <= 5 + 4  # and four of the hot orders
    E.q_order_details_view(spark, SMOKE)
    assert joins(spark.table("order_details_of_the_shop")) == 5


def test_stored_details_are_written_in_waves(spark, tmp_path, monkeypatch):
    t = bind_test_tables(spark, SMOKE)
    store, whole, sizes = TableStore(spark, str(tmp_path), 6), details.order_details(t), []
    write = TableStore.write

    def counted(self, table, df, state=None):
        pieces = write(self, table, df, state)
        sizes.append(len({bucket_of(p) for p in pieces}))
        return pieces

    monkeypatch.setattr(TableStore, "write", counted)
    assert refresh.load_details(store, t) == 1 and sizes == [2, 2, 1, 1]
    assert rows(store.read("order_details"), *FULL) == rows(whole, *FULL)
    t = t.replace(dcspp_ship_group=t.dcspp_ship_group.where("abs(hash(order_ref)) % 3 > 0"))
    refresh.refresh_details(store, t, t.dcspp_order)
    assert sizes == [2, 2, 1, 1] * 2 and rows(store.read("order_details"), *FULL) == rows(details.order_details(t), *FULL)
    # Loaded anew, in place of what was.
    assert refresh.load_details(store, t.replace(dcspp_order=t.dcspp_order.limit(0))) == 3
    assert store.read("order_details").count() == 0


def test_tables_of_the_lines_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ordercraft.sources.binding._MATERIALIZED", {})
    monkeypatch.setattr("ordercraft.session.ensure_checkpoint_dir", lambda s: str(tmp_path))
    t = bind_test_tables(spark, SMOKE)
    assert all(t[name].count() for name in ("dcspp_item", "dcspp_price_adjust", "dcspp_order"))
    codecs = {p.parent.name: p.name.split(".")[-2] for p in tmp_path.glob("ordercraft-binding-*/*/*.parquet")}
    assert codecs == {"_fx_line": "zstd", "dcspp_item": "zstd", "dcspp_price_adjust": "zstd", "dcspp_order": "snappy"}
