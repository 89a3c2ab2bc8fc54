"""Layered settings and intake rules that need a second table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Intake rules.
IMAGE_EXTS = (".png", ".jpg", ".jpeg", ".webp")
PARTIAL_EXTS = (".crdownload", ".part", ".tmp", ".download")
MIN_AGE_SECONDS = 10.0


def resolve(
    df: DataFrame, overrides: DataFrame, on: list[str], defaults: dict[str, float], config: dict[str, float]
) -> DataFrame:
    """Add one column per threshold: per-batch override, else config, else default."""
    given = [c for c in overrides.columns if c not in on]
    renamed = overrides.select(*on, *[F.col(c).alias(f"_o_{c}") for c in given])
    joined = df.join(renamed, on, "left")
    cols = {}
    for name, value in defaults.items():
        base = F.lit(float(config.get(name, value)))
        cols[name] = F.coalesce(F.col(f"_o_{name}"), base) if name in given else base
    return joined.withColumns(cols).drop(*[f"_o_{c}" for c in given])


def eligibility(first: DataFrame, second: DataFrame, now: float) -> DataFrame:
    """Why a file may not be taken in yet; null when it may.

    ``second`` is a later inventory of the same files: a size that moved between
    the two means the file is still being written.
    """
    later = second.select("name", F.col("size").alias("_later"))
    ext = F.lower(F.regexp_extract("name", r"(\.[^./\\]*)$", 1))
    reason = (
        F.when(ext.isin(*PARTIAL_EXTS), "partial-download extension")
        .when(~ext.isin(*IMAGE_EXTS), "unsupported extension")
        .when(F.col("size") == 0, "zero-byte file")
        .when(F.lit(now) - F.col("mtime") < MIN_AGE_SECONDS, "modified too recently (still downloading?)")
        .when(F.col("_later") != F.col("size"), "size still changing")
    )
    return first.join(later, "name", "left").withColumn("reason", reason).drop("_later")
