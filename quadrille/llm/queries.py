"""The queries opN_<name> of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quadrille.llm import decontamination, html_extraction, jaccard_join, media, mixing, quality, token_files, toxicity, url_filters, warc

_MODULES = {
    "op1_jaccard_join": jaccard_join,
    "op2_html_extraction": html_extraction,
    "op3_url_filters": url_filters,
    "op4_toxicity": toxicity,
    "op5_quality": quality,
    "op6_decontamination": decontamination,
    "op7_token_files": token_files,
    "op8_mixing": mixing,
    "op9_media": media,
    "op10_warc": warc,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: m.query for name, m in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: m.SQL for name, m in _MODULES.items() if hasattr(m, "SQL")}
