"""Insert checks: what a target's constraints would reject, and with which error."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ordercraft.operators.ids import dense_ids
from ordercraft.session import materialize

# Error codes of the source dialect.
NULL_CODE, LENGTH_CODE, UNIQUE_CODE = -1400, -12899, -1


@dataclass(frozen=True)
class Check:
    """``kind`` is not_null, max_length (of a text column) or unique (over several columns)."""

    kind: str
    columns: tuple[str, ...]
    code: int
    message: str
    limit: int = 0


def not_null(table: str, column: str) -> Check:
    return Check("not_null", (column,), NULL_CODE, f"cannot insert NULL into {table}.{column}")


def max_length(table: str, column: str, limit: int) -> Check:
    return Check("max_length", (column,), LENGTH_CODE, f"value too large for {table}.{column} (maximum {limit})", limit)


def unique(table: str, *columns: str) -> Check:
    return Check("unique", columns, UNIQUE_CODE, f"unique constraint on {table} ({', '.join(columns)}) violated")


def failed_check(checks: list[Check]) -> tuple[Column, Column]:
    """(error code, error message) of the first failing row check, NULL if all pass; unique checks are not row checks."""
    code, msg = F.lit(None).cast("int"), F.lit(None).cast("string")
    for c in reversed([c for c in checks if c.kind != "unique"]):
        col = F.col(c.columns[0])
        fails = col.isNull() if c.kind == "not_null" else F.char_length(col) > c.limit
        code = F.when(fails, F.lit(c.code)).otherwise(code)
        msg = F.when(fails, F.lit(c.message[:200])).otherwise(msg)
    return code, msg


def _claims(rows: DataFrame, uniques: list[Check], *kept: str) -> DataFrame:
    """(kept..., key): a row for every unique key that a row of ``rows`` takes up.

    ``key`` holds the check's number and the values as text. A key whose columns are all NULL is none; beside a value,
    NULLs count as equal (as the source's database has it).
    """
    keys = []
    for i, c in enumerate(uniques):
        some = reduce(lambda a, b: a | b, (F.col(x).isNotNull() for x in c.columns))
        parts = [F.coalesce(F.concat(F.lit("="), F.col(x).cast("string")), F.lit("")) for x in c.columns]
        keys.append(F.when(some, F.array(F.lit(str(i)), *parts)))
    return rows.select(*kept, F.explode(F.filter(F.array(*keys), lambda k: k.isNotNull())).alias("key"))


def settle(claims: DataFrame, held: DataFrame, cut=lambda df: materialize(df, "unique")) -> DataFrame:
    """Who holds each key when rows are inserted one by one: ``(key, holder)``.

    ``claims(place, key)``: the keys of the rows, which are inserted by rising ``place``; a row enters only if none of its
    keys is held, and then holds them all. ``held(key)``: keys that are held beforehand, by holder 0 (places are above 0).

    Each round lets in every open row that comes first for all of its keys among the open rows, and shuts out the rows that
    share a key with one let in. A row that was shut out no longer stands before others, so a row rejected for one key does
    not block a later row under another. Rounds go on until no row is open: as many as the longest chain of rows where each
    depends on the one before. Only (place, key) rows travel, and keys are joined to one row each, never to each other.
    """
    holders = held.select("key", F.lit(0).cast("long").alias("holder"))
    lost = claims.join(held, "key", "left_semi").select("place").distinct()
    waiting = cut(claims.join(lost, "place", "left_anti"))
    while not waiting.isEmpty():
        heads = waiting.groupBy("key").agg(F.min("place").alias("head"))
        first = waiting.join(heads, "key").groupBy("place").agg(F.min(F.col("place") == F.col("head")).alias("first"))
        entered = cut(waiting.join(first.where("first").select("place"), "place").select("key", F.col("place").alias("holder")))
        holders = holders.unionByName(entered)
        done = waiting.join(entered.select("key"), "key", "left_semi").select("place").distinct()
        waiting = cut(waiting.join(done, "place", "left_anti"))
    return holders


def unique_failures(
    rows: DataFrame, stored: DataFrame, checks: list[Check], order: list[str], cut=lambda df: materialize(df, "unique"),
) -> DataFrame:
    """``rows`` (with error_code, error) plus ``duplicate``: rows that pass the row checks but repeat a unique key.

    Rows are inserted one by one in ``order`` (ascending, NULLs last), as the source inserts them: a key repeats if
    ``stored`` has it or if an earlier row with it was itself inserted. The error is that of the first check, in their
    order, whose key was held by then. Rows alike in all of ``order`` follow each other.
    """
    uniques = [c for c in checks if c.kind == "unique"]
    if not uniques:
        return rows.withColumn("duplicate", F.lit(False))
    late = {f"_late{i}": F.col(c).isNull() for i, c in enumerate(order)}
    placed, _ = dense_ids(cut(rows.withColumns(late)), [x for i, c in enumerate(order) for x in (f"_late{i}", c)], 0, "_place")
    placed = cut(placed.drop(*late))
    claims = cut(_claims(placed.where("error_code is null").withColumn("place", F.col("_place")), uniques, "place"))
    wanted = claims.select("key").distinct()
    held = cut(_claims(stored, uniques).join(wanted, "key", "left_semi").distinct())
    met = claims.join(settle(claims, held, cut), "key").where("holder < place")
    first = met.groupBy(F.col("place").alias("_place")).agg(F.min(F.element_at("key", 1).cast("int")).alias("_check"))
    said = F.array(*[F.lit(c.message[:200]) for c in uniques])
    codes = F.array(*[F.lit(c.code) for c in uniques])
    fails = F.col("_check").isNotNull()
    return placed.join(first, "_place", "left").withColumns({
        "duplicate": fails,
        "error": F.when(fails, F.element_at(said, F.col("_check") + 1)).otherwise(F.col("error")),
        "error_code": F.when(fails, F.element_at(codes, F.col("_check") + 1)).otherwise(F.col("error_code")),
    }).drop("_place", "_check")
