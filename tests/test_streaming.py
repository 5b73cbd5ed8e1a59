"""The stream-driven staged job: one committed run per batch."""

import datetime as dt
import tempfile

from ordercraft.plans.jobs import run_staged, staged_plan
from ordercraft.sources.binding import bind_test_tables
from ordercraft.sources.tables import TableStore
from ordercraft.streaming.staged import start_staged_stream
from tests.conftest import AS_OF as WORLD_AS_OF, rows, world

SMOKE = "/root/testdata/sf0.001"
AS_OF = dt.datetime(2001, 8, 1, 12)


def _store(spark, t, root) -> TableStore:
    store = TableStore(spark, root)
    store.seed({"cit_refil": t.cit_refil, "cit_opportunities": t.cit_opportunities,
                "cit_opp_errors": t.cit_opp_errors})
    return store


def test_one_batch_equals_the_batch_job(spark):
    t = bind_test_tables(spark, SMOKE)
    work = tempfile.mkdtemp(prefix="ordercraft-stream-")
    staged_dir = f"{work}/staged"
    t.dcspp_order_item_stg.coalesce(1).write.parquet(staged_dir)
    store = _store(spark, t, f"{work}/store")
    q = start_staged_stream(spark, t, staged_dir, store, f"{work}/ckpt", as_of=lambda: AS_OF, available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    batch = staged_plan(t, AS_OF)
    assert rows(store.read("cit_refil")) == rows(batch.refil)
    assert rows(store.read("cit_opportunities")) == rows(batch.opportunities)


def test_two_batches_equal_two_runs_and_a_restart_repeats_nothing(spark):
    orders = [dict(order_id="O1", submitted="2024-05-02 10:00:00"),
              dict(order_id="O2", submitted="2024-05-01 10:00:00", profile_id="U2")]
    t = world(spark, orders, [("O1", "X", 1), ("O2", "Y", 1)])
    work = tempfile.mkdtemp(prefix="ordercraft-stream-")
    one, two = _store(spark, t, f"{work}/one"), _store(spark, t, f"{work}/two")
    for order in ("O1", "O2"):
        staged = t.dcspp_order_item_stg.where(f"order_id = '{order}'")
        run_staged(t.replace(dcspp_order_item_stg=staged), WORLD_AS_OF, two)
        staged.coalesce(1).write.mode("append").parquet(f"{work}/staged")

    def stream():
        q = start_staged_stream(spark, t, f"{work}/staged", one, f"{work}/ckpt", as_of=lambda: WORLD_AS_OF,
                                available_now=True, max_files_per_trigger=1)
        q.awaitTermination(600)
        assert q.exception() is None

    stream()
    ids = rows(one.read("cit_refil"), "id_key", "order_id")
    assert sorted(ids) == sorted(rows(two.read("cit_refil"), "id_key", "order_id")) and len(ids) == 2
    run = one.state().run
    assert run == 3
    stream()
    assert one.state().run == run
