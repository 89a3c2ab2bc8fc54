"""Five cleaning stages over the documents, each written and read again by the next.

``run(spark, sf_dir)`` applies them to ``documents``; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, line_dedup, mixing, ngram_join
from tidemark.llm.common import table
from tidemark.session import shared_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language: texts without a letter go, clean ones never do.

    Profiles are learned from the labelled documents of the training folds; where nothing
    is labelled nothing can be rejected for its language, and only texts without letters go.
    """
    profiles = language_id.learn(docs.filter(~F.coalesce(language_id.held_out("doc_id"), F.lit(False))))
    return language_id.lettered(docs, profiles)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of many documents stay in one of them; a text that loses all its lines becomes empty."""
    rows = line_dedup.dedup_lines(docs)
    return rows.withColumns({"text": F.col("kept"), "n_chars": F.coalesce(F.length("kept"), F.lit(0)).cast("long")}).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, Jaccard 0.8 or more, chained) the least id stays."""
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    rows = mixing.mix(mixing.sized(docs.select("doc_id", "text", "lang", "source")), block=mixing.BLOCK)
    return rows.select("doc_id", "lang", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

#: Language profiles and the closure of near copies have no plain SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder, so later stages don't redo earlier ones."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        spark.catalog.clearCache()
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
