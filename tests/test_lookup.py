"""A small staged batch reads few row groups."""

from __future__ import annotations

import datetime as dt

import pytest

from ordercraft.plans.jobs import staged_plan
from ordercraft.sources import lookup
from ordercraft.sources.binding import Tables, bind_test_tables
from tests.conftest import rows

SF = "/root/testdata/sf0.01"
AT = dt.datetime(2001, 8, 1, 12)


def scanned(df) -> int:
    """Rows that the scan of a plain read gave, after skipped row groups."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    t, root = bind_test_tables(spark, SF), tmp_path_factory.mktemp("clustered")
    names = ("dcspp_order", "nt_order", "dcspp_pay_group", "dcspp_order_item", "dcspp_item")
    for name in names:
        lookup.write_clustered(t[name], name, f"{root}/{name}", files=60)
    return t.replace(**Tables.from_paths(spark, {n: f"{root}/{n}" for n in names}))


def test_ten_orders_read_a_small_share_of_the_row_groups(spark, clustered):
    t = clustered
    picked = [r[0] for r in t.dcspp_order.where("state = 'SUBMITTED'").join(t.dcspp_order_item_stg, "order_id").orderBy("order_id").limit(10).collect()]
    small = lookup.of_orders(t, picked)
    for name in ("dcspp_order", "nt_order", "dcspp_pay_group", "dcspp_order_item", "dcspp_item"):
        assert scanned(small[name]) <= 0.25 * t[name].count(), name
        keys = [r[0] for r in small[name].select(lookup.KEYS[name]).collect()]
        assert keys and len(keys) <= scanned(small[name])


def test_absent_ids_are_skipped_by_the_bloom_filter(spark, clustered):
    """An id inside a row group's range that the group does not hold."""
    absent = clustered.dcspp_order.where(lookup.key_in("order_id", ["O1x", "O333y", "O9z"]))
    assert scanned(absent) == 0


def test_a_small_batch_gives_the_same_run(spark, clustered, monkeypatch):
    staged = spark.createDataFrame(
        [(r[0],) for r in clustered.dcspp_order_item_stg.orderBy("order_id").limit(40).collect()], "order_id string")
    t = clustered.replace(dcspp_order_item_stg=staged)
    by_ids = staged_plan(t, AT)
    monkeypatch.setattr("ordercraft.plans.jobs.few", lambda ids: None)
    joined = staged_plan(t, AT)
    for name in ("refil", "opportunities", "quarantine", "errors"):
        assert rows(getattr(by_ids, name)) == rows(getattr(joined, name))


def test_many_ids_are_joined(spark):
    assert lookup.few(spark.range(501).selectExpr("cast(id as string) as x")) is None
    assert len(lookup.few(spark.range(500).selectExpr("if(id = 0, null, cast(id as string)) as x"))) == 499
    assert lookup.key_in("x", []) is not None
