"""Operators of a training-data pipeline: one module each, with its query and checking SQL.

Every module defines ``register(queries, oracles)``. Nothing outside this package
and ``corpus_pipeline.py`` imports it.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = (
    "url_filter",
    "mixing",
    "secret_scan",
    "line_dedup",
    "language_id",
    "html_text",
    "ann",
    "decontamination",
    "lm_scoring",
    "ngram_join",
    "packing",
    "centroids",
    "collocations",
)


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """All queries of this package and the SQL of those that SQL can express."""
    queries: dict = {}
    oracles: dict = {}
    for name in MODULES:
        importlib.import_module(f"tidemark.llm.{name}").register(queries, oracles)
    return queries, oracles
