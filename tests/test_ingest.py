"""Ingest without silent changes: what does not fit is refused or set aside."""

from __future__ import annotations

from decimal import Decimal

import pytest

from ordercraft.sources.ingest import LossyExport, ingest, ingest_exports, profile, read_export, split
from tests.conftest import rows


def _prices(spark, *values, kind="string"):
    return spark.createDataFrame([(f"P{i}", v, None, "") for i, v in enumerate(values)],
                                 f"amount_info_id string, list_price {kind}, raw_total_price {kind}, order_discount string")


def test_no_digit_is_lost(spark):
    raw = _prices(spark, "1.005", "2.999", "3.10", "4.100000", "5", "", None, " 6.5 ", "x", "99999999999999999.99", "100000000000000000.00",
                  "1.0000000000000000000000001", "1e2", "-0.01")
    good, bad = split(raw, "dcspp_item_price")
    assert rows(good, "amount_info_id", "list_price") == sorted(
        [("P2", Decimal("3.10")), ("P3", Decimal("4.10")), ("P4", Decimal("5.00")), ("P5", None), ("P6", None), ("P7", Decimal("6.50")),
         ("P9", Decimal("99999999999999999.99")), ("P12", Decimal("100.00")), ("P13", Decimal("-0.01"))], key=repr)
    assert rows(bad, "column", "value") == sorted(
        [("list_price", v) for v in ("1.005", "2.999", "x", "100000000000000000.00", "1.0000000000000000000000001")], key=repr)
    for value in ("1.005", "x"):
        with pytest.raises(Exception, match=f"list_price: {value}"):
            ingest(_prices(spark, value), "dcspp_item_price").collect()
    for kind, value in (("double", 1.005), ("decimal(20,4)", Decimal("2.9990"))):
        with pytest.raises(Exception, match="list_price"):
            ingest(_prices(spark, value, kind=kind), "dcspp_item_price").collect()
    assert rows(ingest(_prices(spark, 2.5, kind="double"), "dcspp_item_price"), "list_price") == [(Decimal("2.50"),)]


def test_whole_numbers_and_dates(spark):
    raw = spark.createDataFrame([("a", "7"), ("b", "7.0"), ("c", "7.5"), ("d", "3000000000"), ("e", "-1")], "payment_group_id string, no_of_payments string")
    good, bad = split(raw, "oe_pay_group")
    assert rows(good) == [("a", 7), ("b", 7), ("e", -1)] and rows(bad, "value") == [("3000000000",), ("7.5",)]
    dates = spark.createDataFrame([("a", "2024-05-01 10:00:00"), ("b", "2024-02-30"), ("c", "2024-05-02"), ("d", "")], "shipping_group_id string, sched_deliv_date string")
    good, bad = split(dates, "nt_ship_group")
    assert rows(good, "shipping_group_id") == [("a",), ("c",), ("d",)] and rows(bad, "column", "value") == [("sched_deliv_date", "2024-02-30")]


def test_csv_records_with_missing_and_extra_fields(spark, tmp_path):
    (tmp_path / "x.csv").write_text('payment_group_id,no_of_payments,more\nP1,2,z\nP2,3\nP3,4,z,surplus\n"P4, quoted",5,z\n')
    good, bad = split(read_export(spark, str(tmp_path / "x.csv"), "csv"), "oe_pay_group")
    assert rows(good) == [("P1", 2), ("P4, quoted", 5)]
    assert rows(bad, "reason", "value") == [("malformed record", "P2,3"), ("malformed record", "P3,4,z,surplus")]


def test_rejects_are_kept_and_reported(spark, tmp_path):
    raw = tmp_path / "raw"
    _prices(spark, "1.50", "1.505").write.option("header", "true").csv(str(raw))
    with pytest.raises(LossyExport, match="dcspp_item_price': 1"):
        ingest_exports(spark, {"dcspp_item_price": str(raw)}, str(tmp_path / "one"), fmt="csv")
    t = ingest_exports(spark, {"dcspp_item_price": str(raw)}, str(tmp_path / "two"), fmt="csv", keep_rejects=True)
    assert rows(t.dcspp_item_price, "list_price") == [(Decimal("1.50"),)]
    for out in ("one", "two"):
        bad = spark.read.parquet(str(tmp_path / out / "_rejects" / "dcspp_item_price"))
        assert rows(bad, "table", "column", "value") == [("dcspp_item_price", "list_price", "1.505")]
        assert '"amount_info_id":"P1"' in bad.first()["record"]


def test_profile_shows_what_would_hold_the_export(spark):
    got = {r["column"]: r for r in profile(_prices(spark, "1.005", "-200", "", "x"), "dcspp_item_price").collect()}
    price = got["list_price"]
    assert (price["n"], price["nulls"], price["lossy"], price["scale"]) == (4, 1, 2, 3)
    assert (price["low"], price["high"]) == (Decimal("-200"), Decimal("1.005"))
    assert got["amount_info_id"]["low"] is None and got["amount_info_id"]["lossy"] == 0


def test_a_missing_column_is_named(spark):
    with pytest.raises(LossyExport, match="oe_pay_group has no column no_of_payments"):
        ingest(spark.createDataFrame([("a",)], "payment_group_id string"), "oe_pay_group")
