"""Hard-negative mining: rows of another label that score close below an anchor's positives.

Vectors are rotated at random and kept as one bit a dimension, with the length of their part along that code (the
alignment); the rest (the residual) is rotated and coded in the same way, a few times over. An anchor's rotated vector is
rounded to a few bits a dimension; its product with a code is then a sum of popcounts. The products times the alignments
estimate the score, and the Cauchy-Schwarz inequality bounds what the last residual can add, so every row has an interval
that surely holds its score. Rows whose interval misses what is asked for are skipped; the others are scored exactly, in
integers.

Rows are dealt into blocks that fit a task. Anchors (a stated share of the rows) are sent to every block and stream past
it; each block answers with a few rows per anchor, and the answers of all blocks are ranked per anchor. This is done twice:
for the positives, and for the negatives within the bounds that the positives' scores set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ordercraft.session import materialize

SCALE = 256
ANCHOR_EVERY = 50
LABEL_SHIFT_EVERY, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 3
LOWER, UPPER = 50, 95  # a negative's score lies between these percentages of the positive's
STAGES = 4  # codes of a row; each leaves about three fifths of the residual before it
PLANES = 6  # bits a dimension of a rounded anchor
BLOCK_BYTES = 48 << 20  # of the vectors of a block
LEAST_BLOCK_ROWS = 2048
CELLS = 1 << 21  # scores estimated at a time, about: sets how many anchors meet a block at once
SLACK = 1e-9  # of the product of lengths, for rounding in doubles


def padded(dim: int) -> int:
    return max(64, -(-dim // 64) * 64)


def rotations(dim: int, seed: int = 13) -> list[np.ndarray]:
    """A random rotation for each stage; the first also pads vectors to whole words."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(STAGES):
        q, r = np.linalg.qr(rng.standard_normal((padded(dim), padded(dim))))
        out.append(q * np.sign(np.diag(r)))
    return [out[0][:dim], *out[1:]]


def as_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a list column as rows, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dim), np.int64)
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(dim) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Codes:
    """One-bit codes of rotated rows, stage by stage: bits and alignments (a row per stage), and the last residual's length."""

    def __init__(self, vectors: np.ndarray, turns: list[np.ndarray]):
        self.words, self.align, left = [], [], vectors
        for turn in turns:
            turned = left @ turn
            bits, scale = turned > 0, 1 / np.sqrt(turned.shape[1])
            self.words.append(np.packbits(bits, axis=1).view(np.uint64))
            self.align.append(np.abs(turned).sum(axis=1) * scale)
            left = turned - np.where(bits, scale, -scale) * self.align[-1][:, None]
        self.rest = np.sqrt((left**2).sum(axis=1))

    def take(self, rows: slice | np.ndarray) -> "Codes":
        out = Codes.__new__(Codes)
        out.words, out.align, out.rest = [w[rows] for w in self.words], [a[rows] for a in self.align], self.rest[rows]
        return out


def intervals(anchors: np.ndarray, turns: list[np.ndarray], codes: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimate, least and greatest possible score of every row for every anchor (anchors by rows)."""
    estimate = np.zeros((len(anchors), len(codes.rest)))
    spread = np.zeros_like(estimate)
    turned = anchors
    for turn, words, align in zip(turns, codes.words, codes.align, strict=True):
        turned = turned @ turn
        dim = turned.shape[1]
        low = turned.min(axis=1, keepdims=True)
        step = np.maximum((turned.max(axis=1, keepdims=True) - low) / (2**PLANES - 1), 1e-300)
        level = np.rint((turned - low) / step).astype(np.uint8)
        off = np.abs(turned - (low + level * step)).sum(axis=1, keepdims=True) / np.sqrt(dim)
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        hits = np.zeros(estimate.shape, np.int64)
        for p in range(PLANES):
            plane = np.packbits((level >> p) & 1, axis=1).view(np.uint64)
            for w in range(plane.shape[1]):
                hits += np.bitwise_count(plane[:, w, None] & words[None, :, w]).astype(np.int64) << p
        # Product with the signs: twice the sum over the set bits, less the sum over all.
        rounded = 2 * (low * ones + step * hits) - (low[:, 0] * dim + step[:, 0] * level.sum(axis=1, dtype=np.int64))[:, None]
        estimate += align * (rounded / np.sqrt(dim))
        spread += align * off
    length = np.sqrt((turned**2).sum(axis=1, keepdims=True))
    spread += codes.rest * length + SLACK * length * (sum(codes.align) + codes.rest) + 1e-6
    return estimate, estimate - spread, estimate + spread


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id (a missing id last)."""
    return np.lexsort((rows, ids, -scores))[:k]


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    return np.argpartition(-scores, k)[:k] if len(scores) > k else np.arange(len(scores))


class Block:
    """Rows of one block, sorted by label."""

    def __init__(self, row, ids, labels, vectors, turns):
        order = np.argsort(labels, kind="stable")
        self.row, self.ids, self.labels = row[order], ids[order], labels[order]
        self.codes = Codes(vectors[order], turns)
        small = np.abs(vectors).max(initial=0) < 1 << 31
        self.vectors = vectors[order].astype(np.int32) if small else vectors[order]
        self.turns = turns
        names, first = np.unique(self.labels, return_index=True)
        self.span = dict(zip(names.tolist(), zip(first, np.append(first[1:], len(order)), strict=True), strict=True))

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        return self.vectors[at].astype(np.int64) @ anchor

    def positives(self, ids, labels, vectors, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per anchor (by position) its ``k`` best rows of the same label and another id, and their scores."""
        for label in np.unique(labels):
            if label not in self.span:
                continue
            mine, (i, j) = np.flatnonzero(labels == label), self.span[label]
            estimate, _, high = intervals(vectors[mine], self.turns, self.codes.take(slice(i, j)))
            for n, a in enumerate(mine):
                rows = np.flatnonzero(self.ids[i:j] != ids[a])
                first = rows[_top(estimate[n, rows], k)]
                known = np.sort(self.scores(i + first, vectors[a]))
                if len(known) == k:  # a row that cannot reach the k-th known score is out
                    rows = rows[high[n, rows] >= known[0]]
                score = self.scores(i + rows, vectors[a])
                best = _best(score, self.ids[i + rows], self.row[i + rows], k)
                yield a, i + rows[best], score[best]

    def negatives(self, labels, vectors, bounds: list[list[int]], k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Per anchor and positive score (by position) the ``k`` best rows of another label within its bounds."""
        estimate, low, high = intervals(vectors, self.turns, self.codes)
        for a, positives in enumerate(bounds):
            i, j = self.span.get(labels[a], (0, 0))
            other = np.r_[0:i, j:len(self.row)]
            near, least, most = estimate[a, other], low[a, other], high[a, other]
            wanted = []
            for positive in positives:
                floor, ceiling = positive * LOWER, positive * UPPER
                rows = np.flatnonzero((100 * most >= floor) & (100 * least <= ceiling))
                first = rows[_top(np.where(100 * near[rows] <= ceiling, near[rows], -np.inf), 4 * k)]
                known = self.scores(other[first], vectors[a])
                known = np.sort(known[(100 * known >= floor) & (100 * known <= ceiling)])
                wanted.append(rows[most[rows] >= known[-k]] if len(known) >= k else rows)
            asked = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
            score = self.scores(other[asked], vectors[a])
            for place, positive in enumerate(positives):
                fit = np.flatnonzero((100 * score >= positive * LOWER) & (100 * score <= positive * UPPER))
                best = fit[_best(score[fit], self.ids[other[asked[fit]]], self.row[other[asked[fit]]], k)]
                yield a, place, other[asked[best]], score[best]


def prepared(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """Written rows (row, vec_id, label, vector) that take part: labels shifted, components in whole 256ths."""
    x = F.col(vector)
    sound = F.col("label").isNotNull() & x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    shifted = F.when(F.col("vec_id") % LABEL_SHIFT_EVERY == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(LABELS))).otherwise(F.col("label"))
    whole = F.transform(x, lambda v: F.floor(SCALE * v.cast("double")).cast("long"))
    return materialize(table.where(sound).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        shifted.cast("long").alias("label"), whole.alias("vector")), "hardneg-rows")


_RESULT = "anchor long, anchor_id long, place int, vec_id long, row long, score long"


def _search(rows: DataFrame, anchors: DataFrame, dim: int, blocks: int, negatives: bool) -> DataFrame:
    """The blocks' answers: for each anchor its best rows (``place`` 0), or its best negatives for each of its ``bounds``."""
    none = F.array().cast("array<bigint>")
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block")
    dealt = rows.select(block, F.lit(False).alias("anchor"), "row", "vec_id", "label", "vector", none.alias("bounds"))
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("anchor"), "row",
                          "vec_id", "label", "vector", (F.col("bounds") if negatives else none).alias("bounds"))

    def run(batches):
        turns = rotations(dim)
        held: dict = {}

        def unpack(batch):
            ids = batch.column("vec_id")
            return (batch.column("row").to_numpy(), ids.fill_null((1 << 63) - 1).to_numpy(), batch.column("label").to_numpy(),
                    as_matrix(batch.column("vector"), dim), ids)

        def answer(batch):
            block = held["block"]
            row, ids, labels, vectors, shown = unpack(batch)
            shown = shown.to_pylist()
            found = []
            some = min(64, max(1, CELLS // len(block.row)))
            for i in range(0, len(row), some):
                part = slice(i, i + some)
                if negatives:
                    bounds = batch.column("bounds").slice(i, some).to_pylist()
                    got = block.negatives(labels[part], vectors[part], bounds, NEGATIVES)
                else:
                    got = ((a, 0, at, s) for a, at, s in block.positives(ids[part], labels[part], vectors[part], POSITIVES))
                for a, place, at, score in got:
                    found += [(row[i + a], shown[i + a], place, v, r, s)
                              for v, r, s in zip(block.ids[at], block.row[at], score, strict=True)]
            cols = list(zip(*found, strict=True)) if found else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            out = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(out, names=["anchor", "anchor_id", "place", "vec_id", "row", "score"])

        def close():
            """The rows of the present block are all there."""
            if held.get("parts"):
                held["block"] = Block(*(np.concatenate([p[c] for p in held["parts"]]) for c in range(4)), turns)
                held["parts"] = []

        for batch in batches:
            key = np.stack([batch.column("block").to_numpy(), batch.column("anchor").to_numpy(zero_copy_only=False)], axis=1)
            cuts = np.flatnonzero(np.any(np.diff(key, axis=0) != 0, axis=1)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if i == j:
                    continue
                part = batch.slice(i, j - i)
                if held.get("at") != key[i, 0]:
                    held = {"at": key[i, 0], "parts": [], "block": None}
                if key[i, 1]:
                    close()
                    if held["block"] is not None:
                        yield answer(part)
                else:
                    held["parts"].append(unpack(part)[:4])

    # A block's rows come first, then the anchors that pass it. By ranges, as a hash would put several blocks in one task.
    return dealt.unionByName(sent).repartitionByRange(blocks, "block").sortWithinPartitions("block", "anchor").mapInArrow(run, _RESULT)


def mine(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Needs ``vec_id``, ``label`` and ``vector``. Rows with a NULL label, a NULL vector or a NULL or non-finite component take
    no part. A row's score is its integer inner product with the anchor; higher scores come first, ties by smaller
    ``vec_id``. Rows with a NULL ``vec_id`` are no anchors and count as the largest id. Shorter vectors count as filled up
    with zeros. Repeated rows are rows of their own, also as anchors; an anchor's positives have another ``vec_id``. An
    anchor without positives or without negatives in its bounds gives no rows, and so does an empty table. Scores are right
    if the inner products fit in 63 bits.
    """
    rows = prepared(table, vector)
    n, dim = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    dim = max(dim or 0, 1)
    fit = max(1, BLOCK_BYTES // (4 * dim))  # rows of a block, at most
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // fit), min(2 * cores, -(-n // LEAST_BLOCK_ROWS)))
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)

    def leading(found: DataFrame, k: int, name: str) -> DataFrame:
        # Each block sends at most k rows of an anchor (and positive), so these groups are small.
        first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "row")
        return found.withColumn(name, F.row_number().over(first)).where(F.col(name) <= k)

    positives = materialize(leading(_search(rows, anchors, dim, blocks, False), POSITIVES, "n"), "hardneg-positives")
    bounds = positives.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("n", "score"))).alias("b")).select(
        F.col("anchor").alias("row"), F.col("b.score").alias("bounds"))
    found = leading(_search(rows, anchors.join(bounds, "row"), dim, blocks, True), NEGATIVES, "rank")
    shown = F.when(F.col("vec_id") != F.lit((1 << 63) - 1), F.col("vec_id"))
    pairs = positives.select("anchor", (F.col("n") - 1).alias("place"), shown.alias("positive_id"), F.col("score").alias("positive_score"))
    return found.select("anchor", "anchor_id", "place", "rank", shown.alias("negative_id"), F.col("score").alias("negative_score")).join(
        pairs, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
with e as materialized (
  select row_number() over () r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
         list_transform(embedding, lambda x: floor(256 * x::double)) v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
  select a.r ar, a.vec_id anchor_id, b.r br, b.vec_id, a.label = b.label same, list_inner_product(a.v, b.v)::bigint score
  from e a join e b on a.vec_id % 50 = 0 and a.vec_id is distinct from b.vec_id or a.vec_id % 50 = 0 and a.label <> b.label),
p as materialized (
  select ar, anchor_id, br, vec_id positive_id, score positive_score from s where same
  qualify row_number() over (partition by ar order by score desc, vec_id nulls last, br) <= 5),
n as (
  select p.ar, p.br, p.anchor_id, p.positive_id, p.positive_score, s.vec_id negative_id, s.score negative_score,
         row_number() over (partition by p.ar, p.br order by s.score desc, s.vec_id nulls last, s.br) k
  from p join s on p.ar = s.ar
  where not s.same and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
select anchor_id, positive_id, k::int as rank, negative_id, positive_score, negative_score from n where k <= 3
"""
