"""Registered queries of the training-data operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from ordercraft.llm import (
    chat, decontam, embeddup, hardneg, htmltext, langid, linededup, minhash, mixing, repeats, resample, sharding, warc,
)

QUERIES = {
    "op1_decontaminate": decontam.op1_decontaminate,
    "op2_html_text": htmltext.op2_html_text,
    "op3_line_dedup": linededup.op3_line_dedup,
    "op4_warc": warc.op4_warc,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_minhash_dedup": minhash.op6_minhash_dedup,
    "op7_repeated_bytes": repeats.op7_repeated_bytes,
    "op8_language_id": langid.op8_language_id,
    "op9_embedding_dedup": embeddup.op9_embedding_dedup,
    "op10_chat_format": chat.op10_chat_format,
    "op11_shard_ring": sharding.op11_shard_ring,
    "op12_resample": resample.op12_resample,
    "op13_hard_negatives": hardneg.op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_decontaminate": decontam.ORACLE,
    "op3_line_dedup": linededup.ORACLE,
    "op4_warc": warc.ORACLE,
    "op5_mix_sources": mixing.ORACLE,
    "op9_embedding_dedup": embeddup.ORACLE,
    "op10_chat_format": chat.ORACLE,
    "op11_shard_ring": sharding.ORACLE,
    "op12_resample": resample.ORACLE,
    "op13_hard_negatives": hardneg.ORACLE,
}
