"""Kept states and the refreshed details against their full forms, under random changes."""

from __future__ import annotations

import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from ordercraft.operators import details, offers
from ordercraft.plans import refresh
from ordercraft.sources.binding import bind_test_tables
from ordercraft.sources.tables import TableStore, bucket_of
from tests.conftest import make_tables, rows, world

SMOKE = "/root/testdata/sf0.001"
FULL = [c for c in details.ORDER_DETAILS_COLUMNS]


def _store(spark, buckets=4) -> TableStore:
    return TableStore(spark, tempfile.mkdtemp(prefix="ordercraft-store-"), buckets)


def test_latest_orders_after_random_changes(spark):
    """Added, late, moved (forward, back, to another customer), undated and removed orders; ties."""
    rng = random.Random(11)
    day = lambda: None if rng.random() < 0.1 else dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(12))
    who = lambda: f"U{rng.randrange(6)}"
    orders: dict[str, tuple] = {}
    store = _store(spark)
    for step in range(4):
        new = {f"O{step}-{i}": (who(), day()) for i in range(8)}
        old = rng.sample(sorted(orders), min(6, len(orders)))
        moved = {o: (who() if rng.random() < 0.3 else orders[o][0], day()) for o in old[:4]}
        orders |= new | moved
        for o in old[4:]:
            del orders[o]
        t = make_tables(spark, dcspp_order=[dict(order_id=o, profile_id=p, submitted_date=d) for o, (p, d) in orders.items()],
                        nt_order=[dict(order_id=o, cn_id=f"CN{len(o) % 3}") for o in orders])
        changed = spark.createDataFrame([(o,) for o in [*new, *old]], "order_id string")
        refresh.refresh_latest(store, t, changed)
        want = {}
        for o, (p, d) in orders.items():
            if d is not None:
                best = want.setdefault(p, [d, set()])
                if d > best[0]:
                    best[:] = [d, set()]
                if d == best[0]:
                    best[1].add(o)
        assert rows(store.read("latest_orders")) == sorted(((p, d, o) for p, (d, os) in want.items() for o in os), key=repr)
        kept = offers.latest_consultant(t, latest=store.read("latest_orders"))
        assert rows(kept) == rows(offers.latest_consultant(t))


def test_latest_orders_leave_other_buckets_alone(spark):
    orders = [dict(order_id=f"O{i}", submitted="2024-05-01 10:00:00", profile_id=f"U{i}") for i in range(40)]
    t = world(spark, orders, [("O1", "X", 1)])
    store = _store(spark, 8)
    refresh.refresh_latest(store, t, t.dcspp_order)
    before = set(store.state().tables["latest_orders"])
    refresh.refresh_latest(store, t, t.dcspp_order.where("order_id = 'O7'"))
    assert len(before - set(store.state().tables["latest_orders"])) == 1


def test_sliding_affinity_needs_no_old_line(spark):
    """At each moment the lines of earlier orders are gone from the tables."""
    orders = [dict(order_id=f"O{i}", submitted=f"{2023 + (i + 4) // 12}-{(i + 4) % 12 + 1:02d}-01 {8 + i % 8:02d}:00:00",
                   profile_id=f"U{i % 2}", cn=["CN1", "CN2", None][i % 3]) for i in range(20)]
    lines = [(o["order_id"], f"S{n % 5}", 1) for n, o in enumerate(orders)]
    t = world(spark, orders, lines)
    store, last = _store(spark), None
    contexts = spark.createDataFrame([("U0", "CN1"), ("U1", "CN2")], "cf_id string, cn_id string")
    for moment in (dt.datetime(2024, 3, 1, 10), dt.datetime(2024, 6, 1, 9), dt.datetime(2024, 12, 1, 8)):
        seen = t.dcspp_order.where(F.col("submitted_date") <= F.lit(moment).cast("timestamp_ntz"))
        new = seen if last is None else seen.where(F.col("submitted_date") > F.lit(last).cast("timestamp_ntz"))
        only_new = t.dcspp_order_item.join(new.select("order_id"), "order_id", "left_semi")
        refresh.refresh_brand_days(store, t.replace(dcspp_order=seen, dcspp_order_item=only_new), new, moment)
        kept = refresh.kept_affinity(store)
        now = t.replace(dcspp_order=seen)
        for scope in (offers.STAGED_SCOPE, offers.BACKFILL_SCOPE):
            assert rows(kept(contexts, moment, scope)) == rows(offers.brand_affinity(now, contexts, moment, scope)) != []
        last = moment
    months = {p.rsplit("=", 1)[1] for p in store.state().tables["brand_days"]}
    assert min(months) >= "202312"  # what left the window is dropped


def test_a_late_payment_and_a_cancelled_order_change_their_day(spark):
    orders = [dict(order_id="O1", submitted="2024-04-01 10:00:00"), dict(order_id="O2", submitted="2024-04-01 12:00:00", pays=["AUTHORIZED"]),
              dict(order_id="O3", submitted="2024-04-02 12:00:00")]
    lines = [("O1", "A", 1), ("O2", "B", 1), ("O3", "C", 1)]
    t = world(spark, orders, lines)
    store, at = _store(spark), dt.datetime(2024, 6, 1)
    contexts = spark.createDataFrame([("U1",)], "cf_id string")
    refresh.refresh_brand_days(store, t, t.dcspp_order, at)
    assert rows(refresh.kept_affinity(store)(contexts, at, ["cf_id"]), "brand_id") == [("BA",), ("BC",)]
    orders[1]["pays"], orders[2]["state"] = ["SETTLED"], "REMOVED"
    t = world(spark, orders, lines)
    refresh.refresh_brand_days(store, t, t.dcspp_order.where("order_id in ('O2', 'O3')"), at)
    assert rows(refresh.kept_affinity(store)(contexts, at, ["cf_id"]), "brand_id") == [("BA",), ("BB",)]


def test_refreshed_details_after_random_changes(spark):
    t = bind_test_tables(spark, SMOKE)
    store = _store(spark, 6)
    store.seed({"order_details": details.order_details(t)})
    for step, (name, key, column, value) in enumerate([
            ("dcspp_price_adjust", "adjustment_id", "adjustment", "cast(-99 as decimal(19,2))"), ("dps_user", "id", "email", "'new@example.test'"),
            ("dcspp_item", "commerce_item_id", "quantity", "quantity + 1"), ("oe_pay_group", "payment_group_id", "no_of_payments", "12"),
            ("dcs_product", "product_id", "display_name", "'renamed'")]):
        hit = f"abs(xxhash64({key}, {step})) % 97 = 0"
        changes = {name: t[name].where(hit)}
        t = t.replace(**{name: t[name].selectExpr(*[f"if({hit}, {value}, {c}) as {c}" if c == column else c for c in t[name].columns])})
        refresh.refresh_details(store, t, refresh.affected_orders(t, changes))
    assert rows(store.read("order_details"), *FULL) == rows(details.order_details(t), *FULL)
    # A removed order takes its rows with it, and other buckets stay.
    gone = t.dcspp_order.limit(1).select("order_id").collect()[0][0]
    before = set(store.state().tables["order_details"])
    t = t.replace(dcspp_order=t.dcspp_order.where(F.col("order_id") != gone))
    refresh.refresh_details(store, t, spark.createDataFrame([(gone,)], "order_id string"))
    after = set(store.state().tables["order_details"])
    assert len({bucket_of(p) for p in before - after}) == 1
    assert refresh.create_kept_details_view(store, "kept_details").where(F.col("order_number") == gone).count() == 0
    assert spark.sql("select count(*) from kept_details").first()[0] == details.order_details(t).count()


def test_the_named_view(spark):
    t = bind_test_tables(spark, SMOKE)
    df = details.create_order_details_view(t, "order_details_view")
    assert spark.table("order_details_view").columns == details.ORDER_DETAILS_COLUMNS
    assert spark.sql("select count(*) from order_details_view").first()[0] == df.count()


def test_hot_order_is_split_evenly(spark):
    """One order holds half of all lines: the largest task of the final join stays under four times the median."""
    n = 4000
    lines = [("HOT" if i % 2 else f"O{i % 400}", f"S{i % 10}", 1 + i % 7) for i in range(n)]
    orders = [dict(order_id=o, submitted="2024-05-01 10:00:00") for o in sorted({x[0] for x in lines})]
    t = world(spark, orders, lines, oe_order=[dict(order_id=o["order_id"], order_number="B") for o in orders], dps_user=[dict(id="U1")],
              dcspp_ship_group=[dict(order_ref=o["order_id"], shipping_group_id="SG" + o["order_id"]) for o in orders])
    # Lines are distinct by their price.
    t = t.replace(dcspp_item=t.dcspp_item.withColumn("price_info", F.concat(F.lit("IP"), "commerce_item_id")))
    t = t.replace(dcspp_item_price=t.dcspp_item.select(
        F.col("price_info").alias("amount_info_id"), F.lit(1).cast("decimal(19,2)").alias("list_price"),
        F.pmod(F.xxhash64("commerce_item_id"), F.lit(10**9)).cast("decimal(19,2)").alias("raw_total_price"),
        F.lit(0).cast("decimal(19,2)").alias("order_discount")))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = details.hot_orders(t, 100)
        assert [r["order_id"] for r in hot.collect()] == ["HOT"] and hot.first()["pieces"] >= 16

        def tasks(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

        split, whole = details.order_details(t, hot_lines=100), details.order_details(t, hot_lines=n)
        assert rows(split) == rows(whole)
        sizes = tasks(split)
        assert sizes[-1] < 4 * sizes[len(sizes) // 2]
        assert tasks(whole)[-1] >= n // 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
