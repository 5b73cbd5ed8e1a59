"""Set-based upserts against a row-by-row model of the source loops.

Orders (refills) and customers (offers) do not interact, so one random instance with
many independent orders/customers covers many cases in a single Spark run.
"""

from __future__ import annotations

import datetime as dt
import random

from ordercraft.operators.offers import opportunity_upsert
from ordercraft.operators.refill import refill_upsert
from ordercraft.sources.schemas import TARGETS
from tests.conftest import rows

CAND = "order_id string, sku string, description string, refillable string, cf_id string, cn_id string, " \
       "expiration timestamp_ntz"


def _eq(a, b):
    return a is not None and b is not None and a == b


def _nulls_last(*values):
    return tuple((v is None, v if v is not None else "") for v in values)


def refill_loop(table, cands, order_dates, seq):
    """The staged loop: first candidate decides insert (new id) or update for the whole order."""
    table = [dict(r) for r in table]
    for oid in sorted(order_dates, key=lambda o: (order_dates[o], o)):
        mine = sorted((c for c in cands if c["order_id"] == oid),
                      key=lambda c: _nulls_last(c["sku"], c["description"], c["refillable"], c["cf_id"],
                                                c["cn_id"], c["expiration"]))
        v_seq, exist = None, 0
        for c in mine:
            if v_seq is None:
                hits = [r for r in table if all(_eq(r[k], c[k]) for k in ("cn_id", "cf_id", "sku", "order_id"))]
                exist = hits[0]["id_key"] if len(hits) == 1 else 0
                if exist == 0:
                    seq += 1
                    v_seq = seq
            if exist == 0:
                table.append({**c, "id_key": v_seq})
            else:
                v_seq = exist
                for r in table:
                    if all(_eq(r[k], c[k]) for k in ("cn_id", "cf_id", "sku", "order_id")):
                        r["refillable"], r["expiration"] = c["refillable"], c["expiration"]
    return table


def test_refill_upsert_matches_loop(spark):
    rnd = random.Random(7)
    skus, cns, descs = ["A", "B", "C"], ["CN1", "CN2", None], ["d1", "d2"]
    day = dt.datetime(2024, 5, 1)
    table, cands, order_dates = [], [], {}
    for o in range(120):
        oid, cf = f"O{o:03d}", f"U{o % 40}"
        order_dates[oid] = day + dt.timedelta(hours=rnd.randrange(48))
        cn = rnd.choice(cns)
        seen = set()
        for _ in range(rnd.randrange(1, 5)):
            c = dict(order_id=oid, sku=rnd.choice(skus), description=rnd.choice(descs), refillable=rnd.choice("YN"),
                     cf_id=cf, cn_id=cn, expiration=day + dt.timedelta(days=rnd.randrange(3)))
            key = tuple(c.values())
            if key not in seen:
                seen.add(key)
                cands.append(c)
        for _ in range(rnd.choice([0, 0, 1, 2])):
            table.append(dict(id_key=rnd.randrange(1, 50), description="old", sku=rnd.choice(skus), refillable="Y",
                              expiration=day, cf_id=cf, cn_id=rnd.choice(cns), order_id=oid))
    schema = TARGETS["cit_refil"]
    current = spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in table], schema)
    cand_df = spark.createDataFrame([tuple(c[k] for k in CAND_COLS) for c in cands], CAND)
    orders = spark.createDataFrame(list(order_dates.items()), "order_id string, submitted_date timestamp_ntz")
    got, _, _ = refill_upsert(current, cand_df, orders, id_base=100)
    want = refill_loop(table, cands, order_dates, 100)
    cols = schema.fieldNames()
    assert rows(got, *cols) == sorted((tuple(r[c] for c in cols) for r in want), key=repr)


CAND_COLS = ["order_id", "sku", "description", "refillable", "cf_id", "cn_id", "expiration"]


def opportunity_loop(table, offers, pointer):
    """Staged offer loop per customer, with the SURVEY Q7 change (NULL-consultant offers set aside,
    a stored NULL-consultant row replaced like any other)."""
    table = [dict(r) for r in table]
    for cf in sorted({o["cf_id"] for o in offers}):
        mine = sorted((o for o in offers if o["cf_id"] == cf and o["cn_id"] is not None),
                      key=lambda o: _nulls_last(o["cn_id"], o["offer"]))
        for o in mine:
            p = pointer.get((cf, o["cn_id"]))
            if p is not None:
                for r in table:
                    if r["cf_id"] == cf:
                        r["refil"] = None
            stored = [r for r in table if r["cf_id"] == cf]
            if len(stored) >= 2:
                break
            table = [r for r in table if r["cf_id"] != cf]
            if o["offer"] is not None:
                table.append(dict(cn_id=o["cn_id"], cf_id=cf, offer=o["offer"], refil=p, order_date=o["order_date"]))
    return table


def test_opportunity_upsert_matches_loop(spark):
    rnd = random.Random(11)
    day = dt.datetime(2024, 5, 1)
    table, offers, view = [], [], []
    for c in range(150):
        cf = f"U{c:03d}"
        date = day + dt.timedelta(days=rnd.randrange(5))
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            offers.append(dict(cn_id=rnd.choice(["CN1", "CN2", None]), cf_id=cf,
                               offer=rnd.choice(["X", "Y", "Z", None]), order_date=date))
        for _ in range(rnd.choice([0, 1, 1, 2])):
            table.append(dict(cn_id=rnd.choice(["CN1", "CN3", None]), cf_id=cf, offer="OLD",
                              refil=rnd.choice([None, 1, 2]), order_date=day))
        for _ in range(rnd.choice([0, 1, 2])):
            view.append((cf, rnd.choice(["CN1", "CN2"]), rnd.randrange(1, 99)))
    pointer: dict = {}
    for cf, cn, i in view:
        pointer[(cf, cn)] = max(pointer.get((cf, cn), i), i)
    opp_schema = TARGETS["cit_opportunities"]
    current = spark.createDataFrame([tuple(r[f] for f in opp_schema.fieldNames()) for r in table], opp_schema)
    offer_df = spark.createDataFrame([(o["cn_id"], o["cf_id"], o["offer"], o["order_date"]) for o in offers],
                                     "cn_id string, cf_id string, offer string, order_date timestamp_ntz")
    view_df = spark.createDataFrame(view, "cf_id string, cn_id string, id_key bigint")
    got, _, _ = opportunity_upsert(current, offer_df, view_df)
    want = opportunity_loop(table, offers, pointer)
    cols = opp_schema.fieldNames()
    assert rows(got, *cols) == sorted((tuple(r[c] for c in cols) for r in want), key=repr)
