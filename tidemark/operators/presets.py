"""Settings resolved through layers, with the winning layer named."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve(rows: DataFrame, clusters: DataFrame, items: DataFrame, default: str) -> DataFrame:
    """Explicit value, then the cluster's, then the item's own, then the default.

    ``rows``: slug, cluster?, preset?, chroma?. ``clusters`` and ``items`` hold
    (cluster | slug, preset, chroma). Spark broadcasts them only while they are
    under the session's broadcast threshold.
    """
    c = clusters.select("cluster", F.col("preset").alias("_cp"), F.col("chroma").alias("_cc"))
    i = items.select("slug", F.col("preset").alias("_ip"), F.col("chroma").alias("_ic"), F.lit(True).alias("_has"))
    joined = rows.join(c, "cluster", "left").join(i, "slug", "left")
    explicit = F.col("preset").isNotNull() | F.col("chroma").isNotNull()
    clustered = F.col("cluster").isNotNull()
    preset = (
        F.when(explicit, F.coalesce("preset", "_cp", "_ip"))
        .when(clustered, F.col("_cp"))
        .otherwise(F.col("_ip"))
    )
    chroma = F.coalesce(
        F.when(explicit, F.col("chroma")), F.when(clustered, F.col("_cc")).otherwise(F.col("_ic"))
    )
    layer = (
        F.when(explicit, "explicit").when(clustered, "cluster").when(F.col("_has"), "slug").otherwise("default")
    )
    return joined.withColumns(
        {"layer": layer, "preset": F.coalesce(preset, F.lit(default)), "chroma": chroma}
    ).drop("_cp", "_cc", "_ip", "_ic", "_has")
