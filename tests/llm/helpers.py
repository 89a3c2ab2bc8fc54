"""Small inputs that every operator must survive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark: SparkSession, rows: list[tuple], schema: str = DOCS) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def plain(texts: list[str | None], lang: str | None = "en", source: str | None = "a") -> list[tuple]:
    return [(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
