"""Connected components of an edge table: spanning forests within tasks, and alternating large-star and small-star steps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordercraft.session import materialize

CHUNK = 200_000  # edges that one task turns into a forest


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _forests(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges ``(a, b)`` from every vertex to the smallest that it reaches by the edges of its task; b < a."""
    def forest(batches):
        parent: dict = {}

        def root(x):
            top = x
            while parent.get(top, top) != top:
                top = parent[top]
            while parent.get(x, x) != top:
                parent[x], x = top, parent[x]
            return top

        schema = None
        for batch in batches:
            schema = batch.schema
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        if parent:
            found = [(x, root(x)) for x in parent]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    return edges.repartition(tasks).mapInArrow(forest, edges.schema)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every vertex of ``edges(a, b)`` that is not its component's smallest id.

    Every round first replaces each task's edges by a spanning forest of them, ``CHUNK`` edges a task, which takes out
    cycles and shortens paths. Edges that fit one task are done with that; others go through a large-star and a small-star
    step, until the edges no longer change. Each round is written to the shared folder. Hubs are joined, not grouped: minima
    are partial sums and a hub's edges may be split over tasks.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    state = _state(now)
    while True:
        tasks = max(1, -(-state[0] // CHUNK))
        now = _forests(now, tasks)
        if tasks > 1:
            now = _small_star(_large_star(now.distinct()))
        now = materialize(now, "edges")
        before, state = state, _state(now)
        if tasks == 1 or state == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
