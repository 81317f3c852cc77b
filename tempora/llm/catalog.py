"""Queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tempora.llm import chat, decontaminate, jaccard, lines, packing, quality, substrings, suffix_dedup, tokens, toxicity

MODULES = (tokens, packing, jaccard, quality, lines, toxicity, substrings, decontaminate, suffix_dedup, chat)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in getattr(module, "ORACLE_SQL", {}).items()}
