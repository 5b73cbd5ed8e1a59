"""Near-duplicate embeddings by collision counting over one-dimensional projections.

Vectors are grouped by the signs of a few random projections, in several tables, so that a pair at the threshold
shares a group in some table with the wanted recall. Inside a group the vectors are sorted on one projection and each
is the query of a window in it; over a further set of projections the windows in which a pair collides are counted,
and pairs that reach a count which the same recall allows are verified by their exact cosine.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordercraft.llm.components import connected_components
from ordercraft.session import materialize

RECALL = 0.998  # each, of the tables and of the counts, for a pair exactly at the threshold
CELL_ROWS = 512  # mean rows of a sign group
BLOCK_ROWS = 2048  # larger groups are compared block by block
COUNTED = 32  # projections whose window collisions are counted
WINDOW = 2.0  # half width of a window, in standard deviations of a pair at the threshold


def plan(rows: int, threshold: float) -> tuple[int, int]:
    """Sign bits of a group and number of tables: bits grow with the rows, tables keep the recall."""
    bits = min(30, max(0, math.ceil(math.log2(max(1, rows / CELL_ROWS)))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - same))) if same < 1 else 1


def least_count(counted: int = COUNTED, window: float = WINDOW) -> int:
    """Largest count that a pair at the threshold still reaches with the wanted recall (binomial tail)."""
    p, tail = math.erf(window / math.sqrt(2)), 0.0
    for k in range(counted, -1, -1):
        tail += math.comb(counted, k) * p**k * (1 - p) ** (counted - k)
        if tail >= RECALL:
            return k
    return 0


def _directions(dim: int, n: int, what: int) -> np.ndarray:
    return np.random.default_rng([dim, what]).standard_normal((dim, n))


def _pack(vector: list[float]) -> bytes:
    """Single precision where that loses nothing (components as stored), else double."""
    x = np.asarray(vector, np.float64)
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return (single if (single == x).all() else x).tobytes()


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.stack([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64) for r in raw]).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    signs = (x @ _directions(x.shape[1], bits * tables, 1) > 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _cells(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """A row per vector and table: ``t, cell, id, weight, vec``. Vectors of other lengths are in other cells."""
    def cells(batches):
        for batch in batches:
            ids, weights = batch.column("id"), batch.column("weight")
            vectors = batch.column("embedding").to_pylist()
            for dim in sorted({len(v) for v in vectors}):
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                raw = [_pack(vectors[i]) for i in at]
                codes = _codes(_unit(raw, dim), bits, tables) + (dim << 32)
                vec = pa.array(raw, pa.binary())
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), t, np.int32)), pa.array(codes[:, t]), ids.take(pa.array(at)),
                         weights.take(pa.array(at)), vec], names=["t", "cell", "id", "weight", "vec"])

    return vectors.select("id", "weight", "embedding").mapInArrow(cells, "t int, cell long, id long, weight long, vec binary")


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``n`` vertices reaches over the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(group: pa.Table, bits: int, tables: int, threshold: float, counted: int) -> pa.Table:
    """Links found first in this unit: the linked weight of each vector, and its smallest reachable id here."""
    group = group.sort_by("id")
    ids, weight = group.column("id").to_numpy(), group.column("weight").to_numpy()
    t, left, right = (group.column(c)[0].as_py() for c in ("t", "low", "high"))
    mine = group.column("block").to_numpy()
    dim = group.column("cell")[0].as_py() >> 32
    x = _unit(group.column("vec").to_pylist(), dim)
    codes = _codes(x, bits, tables)
    spread = math.sqrt(2 - 2 * threshold) * WINDOW
    lead = x @ _directions(dim, 1, 2)[:, 0]
    points = (x @ _directions(dim, counted, 3)).astype(np.float32)
    need = least_count(counted)
    order = np.argsort(lead, kind="stable")
    lead, place = lead[order], np.arange(len(order))
    wide = math.sqrt(2 - 2 * threshold) * 4  # misses a pair at the threshold with probability 6e-5
    links, pairs = np.zeros(len(x), np.int64), []
    for start in range(0, len(x), 256):
        q = order[start:start + 256]
        end = np.searchsorted(lead, lead[min(start + 255, len(x) - 1)] + wide, side="right")
        c = order[start:end]  # each pair is met from its first vector on the sorted line
        hit = place[start:end][None, :] > place[start:start + len(q)][:, None]
        hit &= lead[start:end][None, :] - lead[start:start + len(q)][:, None] <= wide
        if left != right:
            hit &= mine[q][:, None] != mine[c][None, :]
        count = np.zeros(hit.shape, np.int8)
        for k in range(counted):
            count += np.abs(points[q, k][:, None] - points[c, k][None, :]) <= spread
        hit &= count >= need
        hit &= x[q] @ x[c].T >= threshold
        a, b = np.nonzero(hit)
        a, b = q[a], c[b]
        if t:
            new = ~(codes[a, :t] == codes[b, :t]).any(axis=1)  # counted in the first table that joins the pair
            a, b = a[new], b[new]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        pairs.append((a, b))
    root = _forest(len(x), np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))
    some = links > 0
    return pa.table({"id": ids[some], "links": links[some], "root": ids[root[some]]})


def near_vectors(vectors: DataFrame, threshold: float = 0.9, counted: int = COUNTED) -> tuple[DataFrame, DataFrame]:
    """``(id, links)`` and ``(id, component)`` of the distinct valid vectors ``(id, weight, embedding)``.

    ``links`` adds up the weights of the other vectors with cosine >= threshold. A group larger than ``BLOCK_ROWS`` is
    cut into blocks and each pair of blocks is a unit of work of its own, so no task gets more than two blocks; pairs
    are never written out, only each unit's sums and a spanning forest.
    """
    vectors = materialize(vectors, "embed-vectors")
    bits, tables = plan(vectors.count(), threshold)
    cells = _cells(vectors, bits, tables)
    large = materialize(
        cells.groupBy("t", "cell").count().where(F.col("count") > BLOCK_ROWS).select(
            F.col("t").alias("_t"), F.col("cell").alias("_cell"), F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")),
        "embed-cells")
    blocked = cells.join(large, (F.col("t") == F.col("_t")) & (F.col("cell") == F.col("_cell")), "left").drop("_t", "_cell")
    blocked = blocked.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    units = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "t", "cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "weight", "vec")

    def unit(group: pa.Table) -> pa.Table:
        return _links(group, bits, tables, threshold, counted)

    found = materialize(units.groupBy("t", "cell", "low", "high").applyInArrow(unit, "id long, links long, root long"), "embed-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    return links, connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))


def dedup_embeddings(embeddings: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, a row per row of ``embeddings(vec_id, embedding)``.

    Vectors that are NULL, empty, zero or hold a NULL or non-finite component link with nothing, and so do rows with a
    NULL vec_id (component NULL, not kept). Equal vectors are compared once and counted as often as they occur;
    repeated rows count once and all stay.
    """
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: F.coalesce(x.between(-1.7976931348623157e308, 1.7976931348623157e308), F.lit(False)))
    valid = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = materialize(rows.withColumn("valid", valid).withColumn("_key", F.when(F.col("valid"), F.xxhash64("embedding"))), "embed-rows")
    vectors = rows.where("valid").select("vec_id", "embedding").distinct().groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    vectors = materialize(vectors, "embed-distinct")
    links, components = near_vectors(vectors, threshold)
    classes = vectors.join(links, "id", "left").join(components, "id", "left").select(
        F.xxhash64("embedding").alias("_key"), F.col("embedding").alias("_vec"), "weight",
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    out = rows.join(classes, ["_key"], "left").where("_vec is null or _vec = embedding")
    return out.select(
        "vec_id", F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))


def op9_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
with recursive v as (
  select distinct vec_id, embedding::double[] e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (
  select a.vec_id a, b.vec_id b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join link l on r.b = l.a),
comp as (select a, min(b) component_id from reach group by a)
select e.vec_id, (select count(*) from link where link.a = e.vec_id)::bigint n_links, c.component_id, c.component_id = e.vec_id kept
from embeddings e join comp c on c.a = e.vec_id
"""
