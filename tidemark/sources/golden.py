"""Frozen metric baselines: one nested document per case set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "struct<path string, sha256 string>"
METRICS = "struct<msssim double, lpips double, lap_ratio double, halo_pct double, band_delta double>"
CASE = f"struct<slug string, input {FILE}, baseline {FILE}, metrics {METRICS}, defect_axes array<string>, blessed boolean>"
SCHEMA = f"schema int, pipeline_version string, created_ts string, cases array<{CASE}>"


def fingerprint(pinned: Column) -> Column:
    """Hash of a map's canonical JSON: keys sorted, no spaces."""
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(pinned)))), 256)


def freeze_baseline(cases: DataFrame, path: str, version: str, created_ts: str) -> None:
    """Write one row per case, partitioned by the pinned version; case sets may be large."""
    cases.select(
        F.lit(1).alias("schema"), F.lit(created_ts).alias("created_ts"), "slug", "input", "baseline", "metrics", "defect_axes", "blessed",
        F.lit(version).alias("pipeline_version"),
    ).write.mode("overwrite").partitionBy("pipeline_version").json(path)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Cases of a baseline, whether one document with a case array or one row per case."""
    doc = spark.read.schema(f"{SCHEMA}, slug string, input {FILE}, baseline {FILE}, metrics {METRICS}, defect_axes array<string>, blessed boolean").option("multiLine", False).json(path)
    own = F.struct("slug", "input", "baseline", "metrics", "defect_axes", "blessed")
    return doc.select("pipeline_version", "created_ts", F.explode(F.coalesce("cases", F.array(own))).alias("c")).select(
        "pipeline_version", "created_ts", "c.*"
    )
