"""Unique checks against a row-by-row model of the inserts."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ordercraft.operators.checks import settle, unique, unique_failures
from tests.conftest import rows

SCHEMA = "pos int, a string, b string, c string, error_code int, error string"


def insert_loop(table: list[dict], stored: list[dict], checks) -> list[tuple]:
    """Insert one by one: (pos, code, message, duplicate)."""
    held = set()

    def keys(row):
        out = []
        for i, c in enumerate(checks):
            values = tuple(row[x] for x in c.columns)
            if any(v is not None for v in values):
                out.append((i, values))
        return out

    for row in stored:
        held.update(keys(row))
    out = []
    for row in sorted(table, key=lambda r: (r["pos"] is None, r["pos"] or 0)):
        code, msg, dup = row["error_code"], row["error"], False
        if code is None:
            hit = [i for i, v in keys(row) if (i, v) in held]
            if hit:
                code, msg, dup = checks[hit[0]].code, checks[hit[0]].message, True
            else:
                held.update(keys(row))
        out.append((row["pos"], code, msg, dup))
    return sorted(out, key=repr)


def test_two_overlapping_constraints_match_the_loop(spark):
    checks = [unique("t", "a", "b"), unique("t", "b", "c"), unique("t", "c")]
    for seed in range(4):
        rng = random.Random(seed)
        wide = 3 + 4 * seed
        value = lambda p: None if rng.random() < 0.1 else f"{p}{rng.randrange(wide)}"
        table = [dict(pos=None if n == 40 else n, a=value("a"), b=value("b"), c=value("c"),
                      error_code=-1400 if rng.random() < 0.1 else None, error=None) for n in range(80)]
        stored = [dict(a=value("a"), b=value("b"), c=value("c")) for _ in range(3)]
        rng.shuffle(table)
        got = unique_failures(
            spark.createDataFrame([tuple(r.values()) for r in table], SCHEMA),
            spark.createDataFrame([tuple(r.values()) for r in stored], "a string, b string, c string"), checks, ["pos"])
        assert rows(got, "pos", "error_code", "error", "duplicate") == insert_loop(table, stored, checks)


def test_a_rejected_row_does_not_block_another(spark):
    """Row 2 falls under the first check, so row 3 may take the key that row 2 would have had under the second."""
    table = spark.createDataFrame([(1, "x", "p", None, None, None), (2, "x", "q", None, None, None), (3, "y", "q", None, None, None)], SCHEMA)
    got = unique_failures(table, table.limit(0), [unique("t", "a"), unique("t", "b")], ["pos"])
    assert rows(got, "pos", "duplicate") == [(1, False), (2, True), (3, False)]


def test_a_long_chain_alternates(spark):
    """Row n shares a key with row n + 1: every other row enters."""
    claims = spark.range(1, 13).select(F.col("id").alias("place"), F.explode(F.array("id", F.col("id") + 1)).alias("key"))
    holders = settle(claims.select("place", F.array(F.col("key").cast("string")).alias("key")), spark.createDataFrame([], "key array<string>"))
    assert sorted({r["holder"] for r in holders.collect()}) == [1, 3, 5, 7, 9, 11]


def test_one_hot_key(spark):
    many = spark.range(3000).selectExpr("cast(id as int) as pos", "if(id % 3 = 0, 'hot', cast(id as string)) as a", "'b' || id as b",
                                        "cast(null as string) as c", "cast(null as int) as error_code", "cast(null as string) as error")
    got = unique_failures(many, many.limit(0), [unique("t", "a")], ["pos"])
    assert got.where("duplicate").count() == 999 and got.where("not duplicate and a = 'hot'").head()["pos"] == 0
