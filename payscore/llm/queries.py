"""The registered queries on text corpora, and SQL that gives the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from payscore.llm import chat, decontaminate, divergence, html, language, mixing, neardup, privacy, quality, search, substrings, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": chat.op1_chat,
    "op2_language": language.op2_language,
    "op3_substrings": substrings.op3_substrings,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_neardup": neardup.op5_neardup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_mixing": mixing.op7_mixing,
    "op8_quality": quality.op8_quality,
    "op9_privacy": privacy.op9_privacy,
    "op10_html": html.op10_html,
    "op11_divergence": divergence.op11_divergence,
    "op12_whitening": whitening.op12_whitening,
    "op13_search": search.op13_search,
}

ORACLE: dict[str, str] = {
    "op7_mixing": mixing.OP7_SQL,
    "op8_quality": quality.OP8_SQL,
    "op11_divergence": divergence.OP11_SQL,
    "op13_search": search.OP13_SQL,
}
