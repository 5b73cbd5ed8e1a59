"""Language identification as multilingual mixture inference.

Per-language n-gram likelihoods are counted over all training documents (Spark sums of hashed
byte n-gram counts). A document is modelled as a mixture of languages: expectation-maximisation
estimates the proportions from its n-gram likelihoods, and the language set is the one that
maximises the likelihood minus a penalty per language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordercraft.llm.words import small_batches

UNKNOWN = "und"
NGRAM = 3
MAX_FEATURES = 1 << 13
SMOOTHING = 0.5
EM_STEPS = 25


def _gram_counts(text: str, features: int) -> np.ndarray:
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    h = np.zeros(len(raw) - NGRAM + 1, np.uint32)
    for i in range(NGRAM):
        h = (h ^ raw[i:len(raw) - NGRAM + 1 + i]) * np.uint32(0x01000193)
    h ^= h >> np.uint32(15)
    return np.bincount((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(features).bit_length() + 1), minlength=features)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(labelled: DataFrame, max_features: int = MAX_FEATURES) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and log p(gram | language), shape (features, languages), from ``labelled(text, lang)``.

    Counts cover every row with a language and a letter in its text. The result takes ``max_features`` doubles (64 KB) a
    language, however many documents or languages there are.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    features = max_features

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                if _has_letter(text):
                    grams = _gram_counts(text, features)
                    sums[lang] = sums[lang] + grams if lang in sums else grams
            for lang, grams in sums.items():
                at = np.nonzero(grams)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(grams[at].astype(np.int64))],
                    names=["lang", "gram", "n"])

    with small_batches(labelled.sparkSession):
        totals = rows.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(totals["lang"].unique())
    table = np.zeros((features, len(names)))
    table[totals["gram"].to_numpy(int), np.searchsorted(names, totals["lang"]) if names else []] = totals["n"]
    table += SMOOTHING
    return names, np.log(table / table.sum(axis=0)) if names else table


def _mixture(counts: np.ndarray, likelihood: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and the log-likelihood (up to a constant of the document)."""
    share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
    if len(share) > 1:
        for _ in range(EM_STEPS):
            share = share * (likelihood.T @ (counts / (likelihood @ share))) / counts.sum()
    return share, float(counts @ np.log(likelihood @ share))


def infer(counts: np.ndarray, logp: np.ndarray, penalty: float) -> tuple[int, float]:
    """Index of the main language of the chosen set, and its share of the all-language mixture.

    Sets are nested by share. A larger set is taken only if it gains more than
    ``penalty * log(n-grams)`` for each added language.
    """
    at = np.nonzero(counts)[0]
    counts, logs = counts[at].astype(float), logp[at]
    likelihood = np.exp(logs - logs.max(axis=1, keepdims=True))
    share, full = _mixture(counts, likelihood)
    single = counts @ np.log(likelihood)
    price = penalty * np.log(counts.sum() + 1)
    order = np.argsort(-share, kind="stable")
    best = int(np.argmax(single))
    value, chosen = single[best] - price, best
    for k in range(2, len(order) + 1):
        if full - price * k <= value:
            break
        part, likely = _mixture(counts, likelihood[:, order[:k]])
        if likely - price * k > value:
            value, chosen = likely - price * k, int(order[np.argmax(part)])
    return chosen, float(share[chosen])


def identify(text: Column, model: tuple[list[str], np.ndarray], spark, penalty: float = 4.0) -> Column:
    """Struct (lang_pred, score) for a text column.

    ``und`` with score 0 if the text is NULL or has no letter, or if no language was learned. Whole texts are used.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, logp = shared.value
        for texts in batches:
            out = []
            for t in texts:
                if names and _has_letter(t):
                    lang, score = infer(_gram_counts(t, len(logp)), logp, penalty)
                    out.append((names[lang], round(min(1.0, max(0.0, score)), 6)))
                else:
                    out.append((UNKNOWN, 0.0))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return predict(text)


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 modulo 4 (a NULL id is learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def predict_languages(docs: DataFrame, penalty: float = 4.0) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score`` (same-named columns are replaced).

    Learns from text and lang of the documents that are not held out; one output row per input row,
    repeated rows alike. An empty table gives an empty result.
    """
    docs = docs.drop("held_out", "lang_pred", "score").withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.where(~F.col("held_out")))
    found = docs.withColumn("_found", identify(F.col("text"), model, docs.sparkSession, penalty))
    return found.withColumn("lang_pred", F.col("_found.lang_pred")).withColumn("score", F.col("_found.score")).drop("_found")


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return predict_languages(docs).select("doc_id", "held_out", "lang_pred", "score")
