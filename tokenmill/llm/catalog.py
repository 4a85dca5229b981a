"""The registered queries of this subpackage: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tokenmill.llm import (chat_format, collocations, contamination, embedding_dedup, licenses, lm_scoring, near_dedup,
                           quality, secrets, sentencepiece, spelling, token_counts, toxicity)

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {
    "op1_token_counts": token_counts.query,
    "op2_sentencepiece": sentencepiece.query,
    "op3_embedding_dedup": embedding_dedup.query,
    "op4_minhash_dedup": near_dedup.query,
    "op5_lm_scoring": lm_scoring.query,
    "op6_secret_scans": secrets.query,
    "op7_quality": quality.query,
    "op8_licenses": licenses.query,
    "op9_toxicity": toxicity.query,
    "op10_decontamination": contamination.query,
    "op11_spelling_variants": spelling.query,
    "op12_collocations": collocations.query,
    "op13_chat_format": chat_format.query,
}
SQL: dict[str, str] = {
    "op10_decontamination": contamination.SQL,
    "op12_collocations": collocations.SQL,
    "op13_chat_format": chat_format.SQL,
}
