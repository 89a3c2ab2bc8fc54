"""Statistics over authored documents and detector outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUSES = r"\|\s*(DONE|CLOSED|OPEN|WIP)\s*(?=\|)"
OPEN_BULLET = r"(?m)^\s*[-*]\s[^\n]*\b(?:NOW|NEXT|OPEN|TODO|pending)\b"
LISTED = r"(?m)^- \d+\.\d+\.\d+ ->"
TARGET = (2560, 1440)


def count_claims(docs: DataFrame, key: str, text: str, words: dict[str, int]) -> DataFrame:
    """Documents that state a number of rows other than the number they list."""
    word = F.lower(F.regexp_extract(text, r"[Tt]he (\w+) most recent", 1))
    table = F.create_map(*[F.lit(x) for p in words.items() for x in p])
    after = F.regexp_replace(text, r"(?s)^.*?[Tt]he \w+ most recent", "")
    d = docs.select(key, table[word].alias("claimed"), F.regexp_count(after, F.lit(LISTED)).alias("listed"))
    return d.filter("claimed is not null and listed > 0 and listed <> claimed").select(
        key, F.col("claimed").cast("long").alias("claimed"), F.col("listed").cast("long").alias("listed")
    )


def status_tally(docs: DataFrame, text: str) -> DataFrame:
    """Status cells of tables by word, and open bullets."""
    cells = docs.select(F.explode(F.regexp_extract_all(text, F.lit(STATUSES), F.lit(1))).alias("status")).groupBy("status").agg(F.count("*").alias("n"))
    bullets = docs.agg(F.sum(F.regexp_count(text, F.lit(OPEN_BULLET))).cast("long").alias("n")).select(F.lit("open_bullet").alias("status"), "n")
    return cells.unionByName(bullets).filter("n > 0")


def adequacy(sources: DataFrame, group: str) -> DataFrame:
    """Audited sources under the target in either dimension; rows without an audit are counted, not guessed."""
    w, h = F.col("w"), F.col("h")
    scale = F.when(w.isNotNull(), F.greatest(TARGET[0] / w, TARGET[1] / h))
    return sources.groupBy(group).agg(
        F.count("*").alias("manifests"), F.count("w").alias("audited"),
        F.count_if(w.isNotNull() & ((w < TARGET[0]) | (h < TARGET[1]))).alias("under_target"), F.max(scale).alias("worst_upscale"),
    )


def localizer_summary(rows: DataFrame) -> DataFrame:
    """Outcomes per backend and side: fine, or which fallback was taken."""
    fallback = F.when(F.col("c") < 0.1, "missing_wrist").when(F.col("c") < 0.3, "low_conf").otherwise("none")
    return rows.groupBy("backend", "side", fallback.alias("fallback")).agg(F.count("*").alias("n")).withColumn("ok", F.col("fallback") == "none")
