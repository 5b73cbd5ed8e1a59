"""Job-level fixtures H22-H24, versioned writes, re-runs and plan shape."""

import datetime as dt
import re
import tempfile
from pathlib import Path

import pytest

from ordercraft.operators.details import order_details
from ordercraft.operators.checks import max_length, unique
from ordercraft.plans.jobs import Options, backfill_plan, run_backfill, run_staged, staged_plan
from ordercraft.session import ensure_checkpoint_dir
from ordercraft.sources.binding import bind_test_tables
from ordercraft.sources.tables import TableStore
from tests.conftest import AS_OF, rows, ts, world

SMOKE = "/root/testdata/sf0.001"


def test_h22_empty_backfill_changes_nothing(spark):
    stored_opp = [dict(cn_id="CN1", cf_id="U1", offer="OLD", refil=None, order_date=ts("2024-05-10 00:00:00"))]
    stored_ref = [dict(id_key=1, sku="A", cf_id="U1", cn_id="CN1", order_id="O1",
                       expiration=ts("2024-07-01 00:00:00"))]
    t = world(spark, [dict(order_id="O1", submitted="2024-05-10 00:00:00", state="INCOMPLETE")], [("O1", "A", 1)],
              cit_opportunities=stored_opp, cit_refil=stored_ref)
    out = backfill_plan(t, dt.datetime(2024, 5, 1), AS_OF)
    assert rows(out.opportunities, "offer") == [("OLD",)]
    assert rows(out.refil, "id_key") == [(1,)]


def test_h23_payment_groups_quarantined(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00", pays=["SETTLED", "SETTLED"]),
                      dict(order_id="O2", submitted="2024-05-01 10:00:00")],
              [("O1", "X", 1), ("O2", "Y", 1)])
    out = staged_plan(t, AS_OF)
    assert rows(out.refil, "order_id") == [("O2",)]
    assert rows(out.quarantine, "order_id", "reason") == [("O1", "several payment groups")]


def test_h24_null_consultant(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00", cn=None)], [("O1", "X", 1)])
    assert rows(staged_plan(t, AS_OF).refil) == []
    back = backfill_plan(t, dt.datetime(2024, 1, 1), AS_OF)
    assert rows(back.refil, "order_id", "cn_id") == [("O1", None)]
    assert rows(back.opportunities) == []


def test_error_rows_for_failed_inserts(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)],
              cit_opp_errors=[dict(id=4, order_id="O0", error="old", error_date=ts("2024-01-01 00:00:00"),
                                   error_code=-1, source="R")])
    # A line without SKU: the default branch makes a candidate whose insert fails the check.
    t = t.replace(dcspp_item=t.dcspp_item.selectExpr(
        "commerce_item_id", "CAST(NULL AS STRING) AS catalog_ref_id", "product_id", "quantity", "price_info"))
    out = staged_plan(t, AS_OF)
    assert rows(out.refil) == []
    assert rows(out.errors, "id", "order_id", "error_code", "source") == [(4, "O0", -1, "R"), (5, "O1", -1400, "R")]


AT = dt.datetime(2001, 8, 1, 12)


def _store(spark, t) -> TableStore:
    store = TableStore(spark, tempfile.mkdtemp(prefix="ordercraft-store-"))
    store.seed({"cit_refil": t.cit_refil, "cit_opportunities": t.cit_opportunities, "cit_opp_errors": t.cit_opp_errors})
    return store


TABLES = ("cit_refil", "cit_opportunities", "cit_opp_errors", "quarantine")


def _all(store):
    return {name: rows(store.read(name)) for name in TABLES}


def test_run_staged_through_the_store(spark):
    t = bind_test_tables(spark, SMOKE)
    store = _store(spark, t)
    assert run_staged(t, AT, store) == 2
    first = _all(store)
    lazy = staged_plan(t, AT)
    assert first == {"cit_refil": rows(lazy.refil), "cit_opportunities": rows(lazy.opportunities),
                     "cit_opp_errors": rows(lazy.errors), "quarantine": rows(lazy.quarantine)}
    # ids that were given and purged in the same run are not given again
    assert store.sequence("refil_seq") >= max(r[0] for r in first["cit_refil"])
    assert run_staged(t, AT, store) == 3
    second = _all(store)
    # errors and quarantine are kept and added to
    for name in ("cit_opp_errors", "quarantine"):
        assert len(second[name]) >= len(first[name]) and set(first[name]) <= set(second[name])
    new = {r[0] for r in second["cit_refil"]} - {r[0] for r in first["cit_refil"]}
    assert all(i > max(r[0] for r in first["cit_refil"]) for i in new)


def test_run_backfill_through_the_store(spark):
    t = bind_test_tables(spark, SMOKE)
    store = _store(spark, t)
    start = dt.datetime(2001, 1, 1)
    assert run_backfill(t, start, AT, store) == 2
    lazy = backfill_plan(t, start, AT)
    assert _all(store) == {"cit_refil": rows(lazy.refil), "cit_opportunities": rows(lazy.opportunities),
                           "cit_opp_errors": rows(lazy.errors), "quarantine": rows(lazy.quarantine)}


def test_crash_between_target_writes(spark, monkeypatch):
    """A run that fails after one target is written leaves nothing; its retry equals a single run."""
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)],
              brands={"X": "BX"}, offers=[("BX", "C", 5, 2)])
    single, store = _store(spark, t), _store(spark, t)
    run_staged(t, AS_OF, single)
    before = _all(store)
    write = TableStore.write

    def failing(self, table, df, state=None):
        if table == "cit_opportunities":
            raise OSError("disk gone")
        return write(self, table, df, state)

    monkeypatch.setattr(TableStore, "write", failing)
    with pytest.raises(OSError):
        run_staged(t, AS_OF, store)
    monkeypatch.undo()
    assert _all(store) == before and store.state().run == 1
    run_staged(t, AS_OF, store)
    assert _all(store) == _all(single)


def test_committed_batch_is_skipped(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)])
    store = _store(spark, t)
    assert run_staged(t, AS_OF, store, batch=0) == 2
    assert run_staged(t, AS_OF, store, batch=0) == 2
    assert run_staged(t, AS_OF, store, batch=1) == 3


def test_quarantine_outlives_the_next_run(spark):
    orders = [dict(order_id="O1", submitted="2024-05-01 10:00:00", pays=["SETTLED", "SETTLED"]),
              dict(order_id="O2", submitted="2024-05-01 10:00:00")]
    t = world(spark, orders, [("O1", "X", 1), ("O2", "Y", 1)])
    store = _store(spark, t)
    run_staged(t, AS_OF, store)
    run_staged(t.replace(dcspp_order_item_stg=t.dcspp_order_item_stg.where("order_id = 'O2'")), AS_OF, store)
    assert rows(store.read("quarantine"), "order_id") == [("O1",)]


def test_manifest_errors_are_raised(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)])
    store = _store(spark, t)
    (Path(store.root) / "_manifests" / "0000000002.json").write_text("{")
    with pytest.raises(ValueError):
        store.read("cit_refil")


def test_stage_tables_go_with_the_run(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)])
    store = _store(spark, t)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    run_staged(t, AS_OF, store)
    assert set(folder.iterdir()) == before


def test_error_row_per_order_and_failing_offer(spark):
    """Two orders of one customer, each with its consultant; the only offer has no name."""
    orders = [dict(order_id="O1", submitted="2024-05-01 10:00:00", cn="CN1"),
              dict(order_id="O2", submitted="2024-05-02 10:00:00", cn="CN2")]
    t = world(spark, orders, [("O1", "X", 1), ("O2", "Y", 1)], brands={"X": "BX", "Y": "BY"},
              offers=[("BX", "C", 5, 2), ("BY", "C", 5, 2)], unnamed_brands=["C"])
    t = t.replace(oe_brand=t.oe_brand.union(spark.createDataFrame([("C", None)], "brand_id string, name string")))
    staged = rows(staged_plan(t, AS_OF).errors, "order_id", "source")
    assert staged == [("O1", "A"), ("O1", "A"), ("O2", "A"), ("O2", "A")]  # two failing offers, tried for each order
    back = rows(backfill_plan(t, dt.datetime(2024, 1, 1), AS_OF).errors, "order_id", "source")
    assert back == [("O2", "A")]  # only CN2 has the customer's latest order


def test_insert_checks_are_parameters(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1), ("O1", "LONG", 1)])
    checks = [max_length("cit_refil", "sku", 3)]
    out = staged_plan(t, AS_OF, Options(refill_checks=checks))
    assert rows(out.refil, "sku") == [("X",)]
    assert rows(out.errors, "error_code", "source") == [(-12899, "R")]
    out = staged_plan(t, AS_OF, Options(refill_checks=[unique("cit_refil", "order_id", "cf_id")]))
    assert rows(out.refil, "sku") == [("LONG",)] and rows(out.errors, "error_code") == [(-1,)]


def test_joins_do_not_depend_on_broadcast(spark):
    t = bind_test_tables(spark, SMOKE)
    with_broadcast = rows(staged_plan(t, AT).refil), rows(order_details(t))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert (rows(staged_plan(t, AT).refil), rows(order_details(t))) == with_broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_catalogue_is_whole(spark):
    t = bind_test_tables(spark, SMOKE)
    parts = spark.read.parquet(f"{SMOKE}/part.parquet")
    assert t.dcs_product.count() == t.dcs_sku.count() == t.oe_product.count() == parts.count()
    assert t.nt_product.count() == parts.where("p_partkey % 23 <> 0").count()
    assert t.nt_sku.count() == parts.where("p_partkey % 29 <> 0").count()


def test_lines_without_adjustment_do_not_meet(spark):
    """Most lines have no adjustment: no join of lines has a key that is NULL for them."""
    lines = [("O1", f"S{n}", 1) for n in range(50)]
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], lines,
              oe_order=[dict(order_id="O1", order_number="B1")], dps_user=[dict(id="U1")],
              dcspp_ship_group=[dict(order_ref="O1", shipping_group_id="SG")])
    assert order_details(t).count() == 50
    plan = _plan(order_details(t))
    assert not re.search(r"(SortMergeJoin|HashJoin) \[adjustments#\d+\], \[adjustments#\d+\], LeftOuter.*price_id", plan)
    assert "salt" in plan


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cartesian_product_or_python(spark):
    t = bind_test_tables(spark, SMOKE)
    out = staged_plan(t, dt.datetime(2001, 8, 1, 12))
    for df in (order_details(t), out.refil, out.opportunities):
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scans_prune_columns_and_push_filters(spark):
    from pyspark.sql import functions as F

    from ordercraft.operators.offers import brand_affinity

    t = bind_test_tables(spark, SMOKE)
    ctx = t.dcspp_order.select(F.col("profile_id").alias("cf_id")).limit(5)
    plan = _plan(brand_affinity(t, ctx, dt.datetime(2001, 8, 1, 12)))
    # The order header is read for four of its seven columns, with state and date filters at the scan.
    assert "ReadSchema: struct<order_id:string,profile_id:string,state:string,submitted_date:timestamp_ntz>" in plan
    assert "In(state, [NO_PENDING_ACTION,SUBMITTED])" in plan and "GreaterThan(submitted_date" in plan
    details = _plan(order_details(t))
    assert "LessThan(adjustment,0.00)" in details


def test_q19_backfill_order_with_two_consultants(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00", cn=["CN1", "CN2"])], [("O1", "X", 1)],
              brands={"X": "BX"}, offers=[("BX", "C", 5, 2)])
    out = backfill_plan(t, dt.datetime(2024, 1, 1), AS_OF)
    # One pass per order: both consultant rows share the order's single new group id.
    assert rows(out.refil, "id_key", "sku", "cn_id") == [(1, "X", "CN1"), (1, "X", "CN2")]
    assert rows(out.opportunities, "cn_id", "cf_id", "offer", "refil") == [
        ("CN1", "U1", "Name C", 1), ("CN2", "U1", "Name C", 1)]


def test_only_window_is_the_per_partition_numbering(spark):
    """Per-key choices are partial aggregates; the one window numbers rows inside a range partition."""
    t = bind_test_tables(spark, SMOKE)
    out = staged_plan(t, dt.datetime(2001, 8, 1, 12))
    for df in (out.refil, out.opportunities):
        plan = _plan(df)
        for line in plan.splitlines():
            if re.search(r"\bWindow \[", line):
                assert "_part" in line, line
        assert "SinglePartition" not in plan


def test_uncommitted_folders_are_not_read(spark):
    root = tempfile.mkdtemp(prefix="ordercraft-store-")
    store = TableStore(spark, root)
    schema_cols = ["id_key", "description", "sku", "refillable", "expiration", "cf_id", "cn_id", "order_id"]
    pad = lambda df: df.selectExpr(*[c if c in df.columns else f"NULL AS {c}" for c in schema_cols])
    row = lambda n: pad(spark.createDataFrame([(n, f"S{n}")], "id_key bigint, sku string"))
    assert rows(store.read("cit_refil")) == []
    assert store.commit(store.state(), {"cit_refil": store.write("cit_refil", row(1))}) == 1
    store.write("cit_refil", row(99))  # a crashed run
    assert rows(store.read("cit_refil"), "id_key") == [(1,)]
    state = store.state()
    assert store.commit(state, {"cit_refil": state.tables["cit_refil"] + store.write("cit_refil", row(2))}) == 2
    assert rows(TableStore(spark, root).read("cit_refil"), "id_key") == [(1,), (2,)]
