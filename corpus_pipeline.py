"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and rereads it as the next stage's docs. All but the last return the columns of documents.
NULL texts and empty tables pass through every stage without error (texts without a letter go in the first).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordercraft.llm.decontam import contamination
from ordercraft.llm.langid import UNKNOWN, predict_languages
from ordercraft.llm.linededup import dedup_lines, without_removed
from ordercraft.llm.minhash import near_duplicates
from ordercraft.llm.mixing import mix_sources
from ordercraft.llm.words import WORD, free, materialize, text_key, without
from ordercraft.session import checkpoint_root, run_folder

# Least share of a document's main language; below it the document is no text of one language.
MIN_SHARE = 0.4


def _beside(docs: DataFrame, added: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)`` with the columns of ``docs``: own columns named like those that an operator adds keep their values."""
    aside = {c: free(docs, f"_own_{c}") for c in added if c in docs.columns}
    done = work(docs.withColumnsRenamed(aside))
    return done.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised main language (op 8); the others go."""
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SHARE)
    # predicted in a step of its own, in small batches: whoever writes the result may run it in batches of any size
    gone = materialize(predict_languages(docs.select("doc_id", "text", "lang")).where(~known).select(text_key().alias("key")).distinct(),
                       "pipeline-unknown")
    key = free(docs, "_text_key")
    return without(docs.withColumn(key, text_key()), key, gone).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line repeats (op 3); documents left without a word go."""
    text = without_removed(F.col("text"), F.col("removed"))
    left = _beside(docs, ["n_lines", "removed"], lambda rows: dedup_lines(rows).withColumn("text", text).where(F.col("text").rlike(WORD)))
    return left.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else left


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (op 6): that with the smallest id."""
    kept = F.col("doc_id").eqNullSafe(F.col("class_id"))
    gone = near_duplicates(docs).groupBy("doc_id").agg(F.max(kept).alias("kept")).where("not kept").select("doc_id")
    return without(docs, "doc_id", materialize(gone, "pipeline-gone"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item (op 1)."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = materialize(contamination(docs, benchmark).select("key"), "pipeline-hits")
    key = free(docs, "_text_key")
    return without(docs.withColumn(key, text_key()), key, hit).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix of sources (op 5), with their size, their source's size and target, and the words taken."""
    return mix_sources(docs).where(F.col("taken") > 0)


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
]

# Language ID, line dedup and MinHash are not expressible in SQL as built; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = checkpoint_root(spark).rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{root}/ordercraft-pipeline-{name}-{uuid.uuid4().hex}"
        with run_folder(spark):  # the stage's own tables go once its result is written
            out = stage(spark, docs, sf_dir)
            out.write.mode("errorifexists").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
