"""Importance resampling towards a target distribution.

Features are hashed into a fixed number of buckets, counted over the corpus and over the target texts; a bucket's gain is
the log ratio of its two smoothed frequencies, and a document's weight is the mean gain of its features, read from the
array of gains. Adding Gumbel noise derived from the document's id turns the highest scores into a weighted sample without
replacement. The scores are written once; the cut-off is found by bisection on their values, with exact counts of the
written scores in each step, then by bisection on the ids tied at the cut-off. Only the drawn rows are sorted for ranks.
"""

from __future__ import annotations

import math
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ordercraft.llm.words import small_batches
from ordercraft.operators.ids import dense_ids
from ordercraft.session import materialize

BUCKETS = 10_000
SHARE = 25  # percent of the eligible documents that are drawn
LEAST_WORDS = 20
PIVOTS = 31  # values counted in one step of a bisection

# A-Z become a-z; bytes that are not 0-9, a-z or of a character from U+0080 up become blanks.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def feature_buckets(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words of a text, and the buckets of its words and of its pairs of neighbouring words."""
    words = text.translate(_FOLD).split(b" ")
    words = [w for w in words if w]
    ones = list(map(crc32, words))
    twos = map(crc32, words[1:], map(crc32, repeat(b" "), ones))  # a checksum continues from that of what stands before
    n = len(words)
    crcs = np.empty(max(0, 2 * n - 1), np.int64)
    crcs[:n] = ones
    crcs[n:] = np.fromiter(twos, np.int64, max(0, n - 1))
    return n, crcs % buckets


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``texts`` (column ``text``) fall in each bucket (int64): tasks count, Spark adds up."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch):
                total += np.bincount(feature_buckets(text, buckets)[1], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    with small_batches(texts.sparkSession):
        for row in texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(
                F.sum("n").alias("n")).collect():  # a row per bucket at most
            out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandfold log ratio of the smoothed frequencies of each bucket, floored."""
    smooth = len(corpus)
    all_corpus, all_target = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_corpus + smooth) / ((s + 1) * (all_target + smooth))))
                     for s, t in zip(corpus.astype(float), target.astype(float), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``docs`` (its columns but the text) with ``n_words``, ``n_features`` and ``weight``, the floored mean gain."""
    kept = [c for c in docs.columns if c not in ("text", "n_words", "n_features", "weight")]
    buckets = len(gain)

    def score(batches):
        for batch in batches:
            made = []
            for text in _texts(batch):
                n, cells = feature_buckets(text, buckets)
                made.append((n, len(cells), int(gain[cells].sum()) // len(cells) if n else 0))
            cols = [pa.array([m[i] for m in made], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + cols, names=[*kept, "n_words", "n_features", "weight"])

    types = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])
    return docs.select(*kept, "text").mapInArrow(score, types)


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandfold Gumbel noise from the hash of the id, floored (NULL: the hash of no id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def cutoff(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """Largest ``v`` that at least ``k`` rows reach (``column`` >= v), and how many rows lie above it.

    ``rows`` is a written table with at least ``k`` >= 1 rows that have a value. Each step counts the rows at or above some
    values between the bounds, exactly and over the whole table, and keeps the span that holds the cut-off.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()  # the cut-off is in [low, high]
    above = 0
    while low < high:
        pivots = sorted({low + (high - low) * i // (PIVOTS + 1) + 1 for i in range(PIVOTS + 1)})
        got = rows.agg(*[F.count(F.when(F.col(column) >= p, 1)) for p in pivots]).first()
        reached = [p for p, n in zip(pivots, got, strict=True) if n >= k]
        missed = [(p, n) for p, n in zip(pivots, got, strict=True) if n < k]
        low = reached[-1] if reached else low
        if missed:
            high, above = missed[0][0] - 1, missed[0][1]
    return low, above


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = 7) -> DataFrame:
    """``docs`` (its columns but the text) with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (long).

    ``target`` holds the texts whose distribution is aimed at. Of the documents with at least ``least_words`` words,
    ``share`` percent (floored) are drawn: those with the highest scores, ties to the smaller ``doc_id``. ``rank`` counts
    from 1 in that order and is NULL for undrawn documents. Same-named columns of ``docs`` are replaced.

    ``doc_id`` must be of an integer type, as ties are bisected on it; a NULL comes after all others. NULL and empty texts
    have no words and weight 0. Repeated rows are documents of their own; if the cut falls among rows of one id, as many
    of them are drawn as are left to draw. Empty tables give an empty result; an empty target leaves all gains to the corpus.
    """
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id must be of an integer type")
    docs = docs.drop("score", "rank")
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    with small_batches(docs.sparkSession):
        scored = materialize(
            weigh(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
            .withColumn("_spread", F.monotonically_increasing_id()), "resample-scores")
    able = F.col("n_words") >= least_words
    open_rows = scored.where(able)
    k = open_rows.count() * share // 100
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.drop("_spread").withColumn("rank", none)
    score, above = cutoff(open_rows.select("score"), "score", k)
    # Smaller ids first: the cut-off of the negated ids. NULL is beyond every id.
    tied = open_rows.where(F.col("score") == score)
    order = F.when(F.col("doc_id").isNull(), F.lit(-(1 << 63)).cast("long")).otherwise(-F.col("doc_id").cast("long"))
    last, _ = cutoff(tied.select(order.alias("order")), "order", k - above)
    drawn = able & ((F.col("score") > score) | ((F.col("score") == score) & (order >= last)))
    ranked, _ = dense_ids(
        materialize(scored.where(drawn).withColumns({"_down": -F.col("score"), "_late": F.col("doc_id").isNull()}), "resample-drawn"),
        ["_down", "_late", "doc_id", "_spread"], 0, "rank")
    # Rows of the last id may be more than are left to draw.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank"))).drop("_down", "_late")
    return ranked.unionByName(scored.where(~drawn).withColumn("rank", none)).drop("_spread")


def op12_resample(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
with tab as (
  select list_transform(range(256), lambda n: list_reduce([n] || range(8),
           lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) t),
docs as materialized (select row_number() over () r, doc_id, text from documents),
texts as (
  select 'd' kind, r, text from docs union all select 'b', row_number() over (), text from benchmark),
ws as materialized (
  select kind, r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from texts where text is not null),
fs as materialized (
  select kind, r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) f from ws where len(w) > 0),
n as materialized (select kind, r, f, count(*) n from fs group by all),
cs as materialized (
  select f, xor(4294967295, list_reduce([4294967295::bigint] || list_transform(regexp_extract_all(hex(encode(f)), '..'),
                lambda h: ('0x' || h)::bigint), lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1]))) % 10000 b
  from (select distinct f from n), tab),
k as materialized (
  select b, coalesce(sum(n) filter (kind = 'd'), 0)::double s, coalesce(sum(n) filter (kind = 'b'), 0)::double t
  from n join cs using (f) group by b),
g as materialized (
  select b, floor(1000 * ln((t + 1) * ((select sum(s) from k) + 10000) / ((s + 1) * ((select sum(t) from k) + 10000))))::bigint g
  from k),
wt as materialized (
  select r, sum(n)::bigint n_features, floor(sum(n * g)::double / sum(n))::bigint weight
  from n join cs using (f) join g using (b) where kind = 'd' group by r),
sc as materialized (
  select d.doc_id, d.r, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substring(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint
                                                    + 0.5::double) / 4294967296)))::bigint score
  from docs d left join wt using (r)),
rk as (
  select r, row_number() over (order by score desc, doc_id nulls last) k, count(*) over () m
  from sc where n_features >= 39)
select doc_id, n_features::bigint n_features, weight::bigint weight, score::bigint score,
       case when k <= m * 25 // 100 then k end as rank
from sc left join rk using (r)
"""
