"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storetally.llm import (
    ann,
    conversation_repair,
    decontamination,
    exact_dedup,
    html_extract,
    ngram_join,
    pieces,
    pii,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_ann": ann.op6_ann,
    "op7_html": html_extract.op7_html,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_decontamination": decontamination.op10_decontamination,
    "op11_exact_dedup": exact_dedup.op11_exact_dedup,
    "op12_whitening": whitening.op12_whitening,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op2_ngram_join": ngram_join.ORACLE,
    "op4_url_filter": url_filter.oracle(),
    "op10_decontamination": decontamination.ORACLE,
    "op11_exact_dedup": exact_dedup.ORACLE,
}
