import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ordercraft.functions.scalars import (
    add_months_keep_time, customer_name, item_discount, months_cutoff, plus_days, trunc_day,
)
from tests.conftest import ts


def test_h1_customer_name_null_parts(spark):
    df = spark.createDataFrame([(None, "L"), ("F", None), (None, None)], "first string, last string")
    got = [r[0] for r in df.select(customer_name("first", "last")).collect()]
    assert got == [" L", "F ", " "]


def test_h2_unit_discount(spark):
    d = Decimal
    df = spark.createDataFrame(
        [(d(20), 2, d(10)), (d(-3), 2, d(10)), (None, 2, d(10)), (d(5), 2, None)],
        "adj decimal(19,2), qty int, price decimal(19,2)")
    got = [r[0] for r in df.select(item_discount("adj", "qty", "price")).collect()]
    assert [None if g is None else float(g) for g in got] == [0.0, -3.0, None, 5.0]


def test_h5_cutoff_driver_side():
    assert months_cutoff(ts("2025-02-28 13:14:15")) == ts("2024-02-29 13:14:15")
    assert months_cutoff(ts("2024-02-29 13:14:15")) == ts("2023-02-28 13:14:15")
    assert months_cutoff(ts("2025-03-15 01:00:00")) == ts("2024-03-15 01:00:00")
    assert months_cutoff(ts("2024-03-31 08:00:00"), 1) == ts("2024-02-29 08:00:00")


def test_h5_cutoff_column_matches_driver_rule(spark):
    values = [ts("2025-02-28 13:14:15"), ts("2024-02-29 13:14:15"), ts("2025-03-15 01:00:00"),
              ts("2024-01-31 23:59:59"), ts("2023-12-31 00:00:00")]
    df = spark.createDataFrame([(v,) for v in values], "x timestamp_ntz")
    got = [r[0] for r in df.select(add_months_keep_time("x", -12)).collect()]
    assert got == [months_cutoff(v) for v in values]


def test_day_arithmetic_keeps_or_cuts_time(spark):
    df = spark.createDataFrame([(ts("2024-05-01 10:30:00"), 30)], "x timestamp_ntz, n int")
    r = df.select(plus_days("x", F.col("n")).alias("a"), trunc_day(plus_days("x", 30)).alias("b")).first()
    assert r.a == dt.datetime(2024, 5, 31, 10, 30) and r.b == dt.datetime(2024, 5, 31)
    assert dict(df.select(trunc_day("x").alias("d")).dtypes)["d"] == "timestamp_ntz"


def test_month_arithmetic_column_equals_driver_rule(spark):
    """Random times and offsets: the column form and the driver-side rule agree."""
    import random

    rnd = random.Random(3)
    cases = []
    for _ in range(3000):
        day = dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randrange(365 * 30))
        t = dt.datetime(day.year, day.month, day.day, rnd.randrange(24), rnd.randrange(60), rnd.randrange(60))
        cases.append((t, rnd.choice([-25, -13, -12, -1, 1, 11, 12])))
    df = spark.createDataFrame(cases, "x timestamp_ntz, m int")
    got = {}
    for m in sorted({c[1] for c in cases}):
        for r in df.where(F.col("m") == m).select("x", add_months_keep_time("x", m).alias("y")).collect():
            got[(r.x, m)] = r.y
    from ordercraft.functions.scalars import add_months_value

    assert all(got[(x, m)] == add_months_value(x, m) for x, m in cases)


def test_ingest_exports_normalizes_empty_strings(spark, tmp_path):
    from ordercraft.sources.binding import ingest_exports

    raw = tmp_path / "raw_nt_order"
    spark.createDataFrame([("O1", "", "CP1", "x"), ("O2", "CN2", "", "y")],
                          "order_id string, cn_id string, coupon_id string, extra string") \
        .coalesce(1).write.option("header", "true").csv(str(raw))
    t = ingest_exports(spark, {"nt_order": str(raw)}, str(tmp_path / "tables"), fmt="csv")
    got = sorted(tuple(r) for r in t.nt_order.collect())
    assert got == [("O1", None, "CP1"), ("O2", "CN2", None)]
    assert t.nt_order.columns == ["order_id", "cn_id", "coupon_id"]
