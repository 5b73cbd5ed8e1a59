from __future__ import annotations

import datetime as dt
from decimal import Decimal
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql.types import DecimalType, TimestampNTZType  # noqa: E402

from ordercraft.sources.binding import Tables  # noqa: E402
from ordercraft.sources.schemas import INPUTS, TARGETS  # noqa: E402

AS_OF = dt.datetime(2024, 6, 1, 12, 0)


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("ordercraft-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ordercraft-test-ckpt-"))
    yield s


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def make_tables(spark, **rows) -> Tables:
    """Tables from lists of dicts; missing tables are empty."""
    t = Tables()
    for name, schema in {**INPUTS, **TARGETS}.items():
        data = [tuple(_coerce(d.get(f.name), f.dataType) for f in schema.fields) for d in rows.get(name, [])]
        t[name] = spark.createDataFrame(data, schema)
    return t


def _coerce(value, data_type):
    if value is not None and isinstance(data_type, DecimalType) and not isinstance(value, Decimal):
        return Decimal(str(value))
    if isinstance(value, str) and isinstance(data_type, TimestampNTZType):
        return ts(value)
    return value


def world(spark, orders, lines, rules=(), brands=None, offers=(), **extra) -> Tables:
    """A small shop.

    orders: dicts with order_id, submitted (str), and optional profile_id ('U1'), state
    ('SUBMITTED'), cn ('CN1'; None for a NULL consultant, 'missing' for no row), pays
    (['SETTLED']), staged (True).
    lines: (order_id, sku, qty). Every SKU has its product, SKU map and names.
    rules: (sku_order, sku_rebuy, days, refillable).
    brands: sku -> brand id (default: brand 'B' + sku); every brand is named unless listed
    in extra['unnamed_brands'].
    offers: (brand_order, brand_offer, interest, support).
    """
    r: dict[str, list[dict]] = {k: [] for k in INPUTS}
    skus = sorted({s for _, s, _ in lines} | {x for rule in rules for x in rule[:2] if x})
    brands = brands or {s: "B" + s for s in skus}
    for o in orders:
        oid = o["order_id"]
        r["dcspp_order"].append(dict(
            order_id=oid, profile_id=o.get("profile_id", "U1"), state=o.get("state", "SUBMITTED"),
            submitted_date=ts(o["submitted"]) if o.get("submitted") else None, price_info="OP" + oid))
        cn = o.get("cn", "CN1")
        if cn != "missing":
            for c in (cn if isinstance(cn, list) else [cn]):
                r["nt_order"].append(dict(order_id=oid, cn_id=c))
        for i, state in enumerate(o.get("pays", ["SETTLED"])):
            r["dcspp_pay_group"].append(dict(order_ref=oid, payment_group_id=f"PG{oid}-{i}", state=state))
        if o.get("staged", True):
            r["dcspp_order_item_stg"].append(dict(order_id=oid))
    for n, (oid, sku, qty) in enumerate(lines):
        item = f"I{oid}-{n}"
        r["dcspp_order_item"].append(dict(order_id=oid, commerce_items=item))
        r["dcspp_item"].append(dict(commerce_item_id=item, catalog_ref_id=sku, product_id="P" + sku, quantity=qty))
    for s in skus:
        r["nt_product"].append(dict(product_id="P" + s, product_code="C" + s))
        r["dcs_product"].append(dict(product_id="P" + s, display_name="name " + s))
        r["nt_sku"].append(dict(sku_code=s, sku_id="K" + s))
        r["dcs_sku"].append(dict(sku_id="K" + s, display_name="name " + s))
        r["oe_product"].append(dict(product_id="P" + s, brand_id=brands.get(s, "B" + s)))
    unnamed = set(extra.pop("unnamed_brands", ()))
    all_brands = set(brands.values()) | {b for rule in offers for b in rule[:2] if b}
    for b in sorted(all_brands - unnamed):
        r["oe_brand"].append(dict(brand_id=b, name="Name " + b))
    for so, sr, days, refillable in rules:
        r["cit_product_refil"].append(dict(sku_order=so, sku_rebuy=sr, expiration=days, refillable=refillable))
    for bo, bf, i, s in offers:
        r["cit_offer"].append(dict(brand_order=bo, brand_offer=bf, interest=i, support=s))
    r.update(extra)
    return make_tables(spark, **r)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
