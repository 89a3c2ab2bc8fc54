"""Session helpers: settings every query relies on, table access, checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Stamps are stored without a zone; one fixed zone keeps casts reproducible.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Spark 4.1 may keep a union's partitioning although its inputs were merged
    # differently at run time; a grouping on top then misses rows.
    "spark.sql.unionOutputPartitioning": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Where none is set, a local session (tests, one machine) gets a folder of its own;
    on a cluster that would scatter files over machines, so it is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


class Tables:
    """Parquet tables of one folder, read lazily by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
