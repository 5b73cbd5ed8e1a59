"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the documents are range-sorted
on that key: the key's leading bits name equal-width ranges (buckets), per-bucket token sums
give each bucket's start, and a running sum inside a bucket finishes the distributed prefix
sum. The mix cuts each source's order at its exact token budget; a budget above the source's
size starts the order again (another epoch). DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ordercraft.operators.ids import assign_dense_ids
from ordercraft.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 128
MAX_BUCKET_BITS = 16


def word_count(text: Column) -> Column:
    """Number of runs of non-blank characters; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], share: float, max_repeat: int) -> DataFrame:
    """``sizes(source, source_size)`` plus ``target``.

    Sources in code point order (NULL last) take ``weights`` in turn and share ``share`` times
    the total size. A target stops at ``max_repeat`` times its source's size; the excess goes to
    the others by weight until no target is above. Each turn of the loop reads two sums.
    """
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    ranked = assign_dense_ids(sizes.withColumn("_last", F.col("source").isNull()), ["_last", "source"], -1, "_rank")
    pick = F.array(*[F.lit(float(w)) for w in weights])
    ranked = materialize(
        ranked.select("source", "source_size",
                      F.element_at(pick, (F.col("_rank") % len(weights) + 1).cast("int")).alias("_weight")), "mix-sources")
    cap = F.col("source_size") * max_repeat
    level, capped = -1.0, None
    while True:
        over = cap <= F.col("_weight") * level
        row = ranked.agg(F.count(F.when(over, 1)), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("_weight")))).first()
        if row[0] == capped or not row[2]:
            break
        capped, level = row[0], (share * total - (row[1] or 0)) / row[2]
    target = F.least(cap.cast("double"), F.col("_weight") * level) if level >= 0 else F.lit(0.0)
    return ranked.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2,
                seed: str = "mix") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` (double) and ``taken`` added (same-named columns are replaced).

    ``taken`` is the number of words the mix takes from the document, repeats counted, at most
    ``max_repeat`` times its size; a source's taken words add up to the whole part of its target.

    Needs ``doc_id``, ``text``, ``source``. A NULL text has size 0 and takes 0; NULL sources form one
    source, ranked last; NULL doc_ids share one key. Rows with equal keys go in doc_id, size order, so
    repeated rows get one result up to exchange among themselves. An empty table gives an empty result.
    """
    docs = docs.drop("size", "source_size", "target", "taken")
    sized = docs.withColumn("size", word_count(F.col("text")))
    rows = docs.count()
    bits = min(MAX_BUCKET_BITS, max(0, math.ceil(math.log2(max(1, rows / ROWS_PER_BUCKET)))))
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    bucket = F.shiftright(F.conv(F.substring(key, 1, 4), 16, 10).cast("int"), 16 - bits)
    keyed = sized.withColumn("_key", key).withColumn("_bucket", bucket)

    in_bucket = materialize(keyed.groupBy("source", "_bucket").agg(F.sum("size").alias("_words")), "mix-buckets")
    sizes = in_bucket.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, list(weights), share, max_repeat)
    ahead = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        in_bucket.withColumn("_start", F.coalesce(F.sum("_words").over(ahead), F.lit(0)))
        .select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_start")
        .join(targets.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    )
    inner = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_inner", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    left = F.floor("target") - F.col("_start") - F.col("_inner")
    taken = sum((F.least(F.greatest(left - F.col("source_size") * e, F.lit(0)), F.col("size")) for e in range(max_repeat)),
                F.lit(0))
    return placed.withColumn("taken", taken.cast("long")).drop("_key", "_bucket", "_inner", "_s", "_b", "_start")


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
with d as (
  select doc_id, source, md5('mix:' || coalesce(cast(doc_id as varchar), '')) k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size
  from documents),
s as (select source, sum(size)::bigint source_size from d group by source),
r as (select *, [3.0, 1.0, 2.0][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::double w from s),
c as (select *, 2.0 * source_size / w ratio from r),
lv as (
  select ratio, (1.5 * (select sum(source_size) from s)
           - coalesce(sum(2 * source_size) over (order by ratio, source is null, source rows between unbounded preceding and current row), 0))::double
         / nullif((select sum(w) from r) - sum(w) over (order by ratio, source is null, source rows between unbounded preceding and current row), 0) lam,
         lead(ratio) over (order by ratio, source is null, source) nxt
  from c
  union all
  select -1, 1.5 * (select sum(source_size) from s) / (select sum(w) from r), (select min(ratio) from c)),
t as (
  select source, source_size,
         least(2.0 * source_size, w * (select min(lam) from lv where ratio <= lam and (nxt is null or lam < nxt)))::double target
  from c),
p as (
  select d.*, coalesce(sum(size) over (partition by source order by k, doc_id, size
                                       rows between unbounded preceding and 1 preceding), 0)::bigint before from d)
select p.doc_id, p.size::bigint as size, t.source_size, t.target,
       (greatest(0, least(p.size, floor(t.target)::bigint - p.before))
        + greatest(0, least(p.size, floor(t.target)::bigint - t.source_size - p.before)))::bigint as taken
from p join t on p.source is not distinct from t.source
"""
