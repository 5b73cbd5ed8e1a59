"""Benchmark decontamination by winnowing.

Of every window of consecutive word k-grams the smallest hash is kept as a fingerprint, on both sides, so any span
of ``WINDOW`` words that a document shares with a benchmark item has a common fingerprint. A fingerprint stands for the
windows whose smallest hash it is. Documents' fingerprints that may be among the items' (by a bit table whose size follows
the benchmark's) are extended to their windows and joined with the items' on fingerprint and window together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordercraft.llm.words import (
    free, gram_hashes, mark_cells, marked, materialize, powers, mix64, slices, text_bytes, text_key, whole, word_count, word_hashes,
)

WINDOW = 10
GRAM = 5
_SECOND = 0xD6E8FEB86659FD93  # base of the second half of a window's 128-bit key
# The bit tables have 16 to 32 bits per item window, within these bounds (the upper one is 64 MB, enough for 2^25 windows;
# fuller tables let more windows through to the join).
LEAST_BITS, MOST_BITS = 16, 29
OUT_ROWS = 100_000  # rows of one batch of windows


def winnow(words: np.ndarray, owner: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the whole windows, and each one's fingerprint: the smallest of its gram hashes."""
    grams = gram_hashes(words, gram)
    starts = np.flatnonzero(whole(owner, window))
    if not len(starts):
        return starts, grams[:0]
    best = grams[starts]
    for j in range(1, window - gram + 1):
        best = np.minimum(best, grams[starts + j])
    return starts, best


def windows_at(words: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit keys of the windows of ``n`` words that begin at ``at``."""
    out = []
    for p in (powers(n), powers(n, _SECOND)):
        key = np.zeros(len(at), np.uint64)
        for j in range(n):
            key += words[at + j] * p[j]
        out.append(mix64(key))
    return out[0], out[1]


def _rows(names: list[str], kinds: list[pa.DataType], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``n, print, h1, h2, item_ids``: each distinct window of the items; an item with 1 to 9 words is one window.

    ``item_ids`` (text) leaves out items without an id, whose windows count all the same. Short windows have print 0.
    """
    def windows(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), text_bytes(batch), strict=True):
                words, owner = word_hashes([text])
                if not len(words):
                    continue
                n = min(WINDOW, len(words))
                at, prints = winnow(words, owner) if n == WINDOW else (np.zeros(1, np.int64), np.zeros(1, np.uint64))
                for i in range(0, len(at), OUT_ROWS):
                    h1, h2 = windows_at(words, at[i:i + OUT_ROWS], n)
                    yield _rows(["key", "n", "print", "h1", "h2"], [pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], [
                        [key] * len(h1), np.full(len(h1), n), prints[i:i + OUT_ROWS].view(np.int64), h1.view(np.int64), h2.view(np.int64)])

    texts = benchmark.where(F.col("text").isNotNull()).select(
        text_key().alias("key"), "text", F.col("item_id").cast("string").alias("item_id"))
    ids = texts.groupBy("key").agg(F.collect_set("item_id").alias("item_ids"))  # leaves out NULLs
    found = texts.groupBy("key").agg(F.first("text").alias("text")).mapInArrow(
        windows, "key binary, n int, print long, h1 long, h2 long").distinct()
    return found.join(ids, "key").groupBy("n", "print", "h1", "h2").agg(
        F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"))


def _cell(values: np.ndarray, bits: int) -> np.ndarray:
    return (values.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def candidate_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct windows of the documents ``(key, text)`` that may be among ``items``: (key, at, n, print, h1, h2), written.

    One reading of the texts. A document's window is passed on if its fingerprint and its own hash may be the items'.
    """
    rows = items.count()
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, rows))) + 4))
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # ten at most

    def table(name: str) -> np.ndarray:
        return mark_cells(items.select(F.col(name).alias("x")), lambda batch: _cell(batch.column("x").to_numpy(), bits), bits)

    shared = docs.sparkSession.sparkContext.broadcast((table("print"), table("h1")))

    def scan(batches):
        prints, hashes = shared.value
        names, kinds = ["key", "at", "n", "print", "h1", "h2"], [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), text_bytes(batch)
            for i, j in slices([len(t) for t in texts]):
                words, owner = word_hashes(texts[i:j])
                first = np.searchsorted(owner, np.arange(j - i))
                for n in lengths:
                    if n == WINDOW:
                        at, mine = winnow(words, owner)
                        hit = marked(prints, _cell(mine, bits))
                        at, mine = at[hit], mine[hit]
                    else:
                        at = np.flatnonzero(whole(owner, n))
                        mine = np.zeros(len(at), np.uint64)
                    for k in range(0, len(at), OUT_ROWS):
                        some, fps = at[k:k + OUT_ROWS], mine[k:k + OUT_ROWS]
                        h1, h2 = windows_at(words, some, n)
                        hit = marked(hashes, _cell(h1, bits))
                        if hit.any():
                            some = some[hit]
                            yield _rows(names, kinds, [
                                [keys[i + o] for o in owner[some]], some - first[owner[some]], np.full(len(some), n),
                                fps[hit].view(np.int64), h1[hit].view(np.int64), h2[hit].view(np.int64)])

    # Copies of a text give the same rows.
    out = materialize(docs.mapInArrow(scan, "key binary, at long, n int, print long, h1 long, h2 long").distinct(), "decontam-windows")
    shared.destroy()
    return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per distinct contaminated text: ``key, n_hit, n_items, items_sha256, spans``.

    ``spans`` are the windows found, as word ranges (first, end) in order; ``n_hit`` counts the words in any of them. NULL
    texts, texts and items without words match nothing. Words in windows of items without an id are hit; such items are
    left out of ``n_items`` and the digest.
    """
    items = materialize(item_windows(benchmark), "decontam-items")
    keyed = docs.where(F.col("text").isNotNull()).select(text_key().alias("key"), "text")
    hits = candidate_windows(keyed, items).join(items, ["n", "print", "h1", "h2"])
    per_text = hits.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("n")).alias("end")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("_items"))
    zero = F.lit(0).cast("long")
    covered = F.aggregate(
        "spans", F.struct(zero.alias("end"), zero.alias("words")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["end"]).alias("end"),
            (acc["words"] + F.greatest(zero, x["end"] - F.greatest(acc["end"], x["at"]))).alias("words")))
    return per_text.select(
        "key", "spans", covered["words"].alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items_sha256, contaminated`` (same-named columns are replaced).

    A row per input row; NULL text has no words. ``items_sha256`` of no items is the digest of the empty string.
    """
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    docs = docs.drop(*added)
    doc, hit = free(docs, "_doc"), free(docs, "_hit")
    hits = materialize(contamination(docs, benchmark).select(F.struct("key", "n_hit", "n_items", "items_sha256").alias(hit)), "decontam-hits")
    # Words are counted before the join, so that a join by shuffle carries texts only if they are asked for.
    counted = docs.withColumns({"n_words": word_count("text"), doc: text_key()})
    joined = counted.join(hits, F.col(doc) == F.col(f"{hit}.key"), "left")
    zero = F.lit(0).cast("long")
    return joined.withColumns({
        "n_hit": F.coalesce(f"{hit}.n_hit", zero), "n_items": F.coalesce(f"{hit}.n_items", zero),
        "items_sha256": F.coalesce(f"{hit}.items_sha256", F.sha2(F.lit(""), 256))}).withColumn(
        "contaminated", F.col("n_hit") > 0).drop(doc, hit)


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE = r"""
with folded as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from documents),
item as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where text is not null),
item_window as (
  select distinct item_id, least(len(w), 10) n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from item where len(w) > 0)),
doc_window as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') s
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from folded, (select distinct n from item_window) where len(w) >= n)),
hit as (select d.doc_id, d.n, d.i, b.item_id from doc_window d join item_window b on d.n = b.n and d.s = b.s),
word as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hit) group by doc_id),
items as (
  select doc_id, count(*) n_items, sha256(string_agg(s, ',' order by s)) items_sha256
  from (select distinct doc_id, item_id::varchar s from hit where item_id is not null) group by doc_id)
select f.doc_id, len(f.w)::bigint n_words, coalesce(word.n_hit, 0)::bigint n_hit, coalesce(items.n_items, 0)::bigint n_items,
       coalesce(items.items_sha256, sha256('')) items_sha256, coalesce(word.n_hit, 0) > 0 contaminated
from folded f left join word using (doc_id) left join items using (doc_id)
"""
