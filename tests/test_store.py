"""Touched pieces, purge by month, refused stale commits."""

from __future__ import annotations

import datetime as dt
import random
import tempfile
from pathlib import Path

import pytest

from ordercraft.operators.refill import refill_purge
from ordercraft.plans.jobs import purged_pieces, run_backfill, run_staged, staged_plan
from ordercraft.sources.schemas import STATES, TARGETS
from ordercraft.sources.tables import StaleRun, TableStore, bucket_of, month_of
from tests.conftest import AS_OF, rows, ts, world


def _store(spark, t, buckets=8) -> TableStore:
    store = TableStore(spark, tempfile.mkdtemp(prefix="ordercraft-store-"), buckets)
    store.seed({"cit_refil": t.cit_refil, "cit_opportunities": t.cit_opportunities, "cit_opp_errors": t.cit_opp_errors})
    return store


def _stored(n: int) -> dict:
    return dict(
        cit_refil=[dict(id_key=i, description="d", sku=f"S{i}", refillable="N", expiration=ts("2024-08-01 00:00:00"),
                        cf_id=f"U{i}", cn_id="CN1", order_id=f"P{i}") for i in range(1, n)],
        cit_opportunities=[dict(cn_id="CN1", cf_id=f"V{i}", offer="OLD", order_date=ts("2023-09-01 00:00:00")) for i in range(n)])


def _files(store, table, state=None) -> dict[str, set]:
    return {p: {f.name for f in Path(store.root, p).iterdir()} for p in (state or store.state()).tables[table]}


def test_a_run_leaves_the_other_buckets_files_alone(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)],
              brands={"X": "BX"}, offers=[("BX", "C", 5, 2)], **_stored(60))
    store = _store(spark, t)
    before = store.state()
    old = {name: _files(store, name) for name in ("cit_refil", "cit_opportunities")}
    run_staged(t, AS_OF, store)
    lazy = staged_plan(t, AS_OF)
    assert rows(store.read("cit_refil")) == rows(lazy.refil) and rows(store.read("cit_opportunities")) == rows(lazy.opportunities)
    for name, key, value in (("cit_refil", "order_id", "O1"), ("cit_opportunities", "cf_id", "U1")):
        hit = store.touched(spark.createDataFrame([(value,)], f"{key} string"), name, before)
        now = _files(store, name)
        assert len(hit) == 1 and len(old[name]) >= 8
        assert {p for p in now if bucket_of(p) not in hit} == {p for p in old[name] if bucket_of(p) not in hit}
        assert all(now[p] == old[name][p] for p in now if p in old[name])
        assert not {p for p in now if bucket_of(p) in hit} & set(old[name])


def test_a_run_reads_only_the_touched_buckets(spark):
    """The other buckets' files could be unreadable: only the pointer look-up reads them."""
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)], **_stored(60))
    store = _store(spark, t)
    hit = store.touched(spark.createDataFrame([("U1",)], "cf_id string"), "cit_opportunities", store.state())
    for piece in store.state().tables["cit_opportunities"]:
        if bucket_of(piece) not in hit:
            for f in Path(store.root, piece).glob("*.parquet"):
                f.write_bytes(b"gone")
                f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    run_staged(t, AS_OF, store)


def test_stale_runs_are_refused(spark):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)])
    first = _store(spark, t)
    second = TableStore(spark, first.root)
    read = second.state()
    row = spark.createDataFrame([(1, "A")], "id bigint, error string").selectExpr(
        *[f"{c} as {c}" if c in ("id", "error") else f"null as {c}" for c in TARGETS["cit_opp_errors"].fieldNames()])
    first.commit(first.state(), {"cit_opp_errors": first.write("cit_opp_errors", row)})
    with pytest.raises(StaleRun):
        second.commit(read, {"cit_opp_errors": second.write("cit_opp_errors", row.selectExpr(
            *[f"'B' as {c}" if c == "error" else c for c in row.columns]))})
    assert rows(first.read("cit_opp_errors"), "error") == [("A",)]
    assert not list(Path(first.root, "_manifests").glob("_*"))


def test_a_run_that_was_overtaken_is_refused(spark, monkeypatch):
    t = world(spark, [dict(order_id="O1", submitted="2024-05-01 10:00:00")], [("O1", "X", 1)])
    store = _store(spark, t)
    write, raced = TableStore.write, []

    def overtaken(self, table, df, state=None):
        if not raced:
            raced.append(True)
            run_staged(t, AS_OF, TableStore(spark, store.root))
        return write(self, table, df, state)

    monkeypatch.setattr(TableStore, "write", overtaken)
    with pytest.raises(StaleRun):
        run_staged(t, AS_OF, store)
    assert store.state().run == 2 and store.read("cit_refil").count() == 1
    monkeypatch.undo()
    run_staged(t, AS_OF, store)  # repeated, it counts on the other run's rows


def test_purge_drops_months_and_reads_the_edge_only(spark):
    rng = random.Random(4)
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 300))
    stored = [dict(id_key=i, sku="S", order_id=f"P{i}", expiration=None if i % 20 == 0 else day()) for i in range(300)]
    t = world(spark, [], [("O1", "X", 1)], cit_refil=stored)
    store = _store(spark, t, 4)
    state = store.state()
    edge = "202404"  # of 2024-06-01 less 60 days
    for piece in state.tables["cit_refil"]:  # months before and after the edge are not read
        if month_of(piece) not in (edge, None) and month_of(piece) < edge:
            for f in Path(store.root, piece).glob("*"):
                f.unlink()
    pieces = purged_pieces(store, state, state.tables["cit_refil"], AS_OF)
    later = {p for p in state.tables["cit_refil"] if month_of(p) is None or month_of(p) > edge}
    assert later <= set(pieces) and not any(month_of(p) and month_of(p) < edge for p in pieces)
    assert rows(store.read_pieces("cit_refil", pieces)) == rows(refill_purge(t.cit_refil, AS_OF))
    # Nothing more expires: the edge month is named again.
    store.commit(state, {"cit_refil": pieces})
    assert purged_pieces(store, store.state(), pieces, AS_OF) == sorted(pieces, key=lambda p: (month_of(p) == edge,))


def test_backfill_in_buckets_equals_the_plan(spark):
    orders = [dict(order_id=f"O{i}", submitted=f"2024-0{1 + i % 5}-11 10:00:00", profile_id=f"U{i % 4}", cn=f"CN{i % 3}") for i in range(12)]
    stored = [dict(id_key=i + 1, sku="X", order_id=f"O{i}", cf_id=f"U{i % 4}", cn_id=f"CN{i % 3}", expiration=ts("2024-07-01 00:00:00")) for i in range(12)]
    t = world(spark, orders, [(o["order_id"], "X", 1) for o in orders], cit_refil=stored, **{"cit_opportunities": [
        dict(cn_id="CN0", cf_id=f"W{i}", offer="OLD", order_date=ts(f"2024-0{1 + i}-02 00:00:00")) for i in range(5)]})
    from ordercraft.plans.jobs import backfill_plan

    store, start = _store(spark, t), dt.datetime(2024, 3, 1)
    run_backfill(t, start, AS_OF, store)
    lazy = backfill_plan(t, start, AS_OF)
    assert rows(store.read("cit_refil")) == rows(lazy.refil)
    assert rows(store.read("cit_opportunities")) == rows(lazy.opportunities)


def test_a_store_keeps_its_bucket_count(spark):
    t = world(spark, [], [("O1", "X", 1)], **_stored(30))
    store = _store(spark, t, 3)
    again = TableStore(spark, store.root, 16)
    assert again.state().buckets == 3
    run_staged(t, AS_OF, again)
    assert {bucket_of(p) for p in again.state().tables["cit_refil"]} <= {0, 1, 2}


def test_wide_rows_are_written_where_they_are(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="ordercraft-store-"), 2)
    schema = STATES["order_details"]
    at = schema.fieldNames().index("order_number")
    data = [tuple(f"O{i}" if k == at else None for k in range(len(schema))) for i in range(60)]
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    store.seed({"order_details": spark.createDataFrame(data, schema).repartition(3)})
    # Each of the three tasks wrote its own rows of each bucket: nothing was moved to a task per bucket.
    assert all(sum(n.endswith(".parquet") for n in names) == 3 for names in _files(store, "order_details").values())
    assert len(store.state().tables["order_details"]) == 2
    assert sorted(r["order_number"] for r in store.read("order_details").collect()) == sorted(f"O{i}" for i in range(60))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
