"""Sinks that can be repeated or read while they are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import numbered

QUEUE_FIELDS = ("target", "reason", "suggested_tools")


def queue_rows(df: DataFrame) -> DataFrame:
    """The queue's fixed columns: extra ones dropped, missing ones blank."""
    return df.select(
        *[
            (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c)
            for c in QUEUE_FIELDS
        ]
    )


def append_queue(df: DataFrame, path: str) -> None:
    queue_rows(df).write.mode("append").option("header", True).csv(path)


def plan_put(incoming: DataFrame, present: DataFrame) -> DataFrame:
    """What a hash-keyed put would do with each file (seq, name, sha).

    Same name and hash: nothing. Same name, other hash: never overwritten, the
    file goes in under a numbered name. Repeats inside the batch count once.
    """
    known = present.select("name", "sha").distinct()
    first = incoming.groupBy("name", "sha").agg(F.min("seq").alias("seq"))
    fresh = first.join(known, ["name", "sha"], "left_anti")
    taken = known.groupBy("name").agg(F.count("*").alias("_taken"))
    placed = numbered(fresh, ["name"], "seq", "_n").join(taken, "name", "left")
    k = F.col("_n") + F.coalesce("_taken", F.lit(0))
    target = F.when(k == 1, F.col("name")).otherwise(F.concat("name", F.lit("~"), k.cast("string")))
    action = F.when(k == 1, "write").otherwise("write_renamed")
    done = placed.select("seq", target.alias("target"), action.alias("action"))
    return incoming.join(done, "seq", "left").withColumns(
        {"action": F.coalesce("action", F.lit("noop")), "target": F.coalesce("target", F.col("name"))}
    )


def put_if_absent(incoming: DataFrame, path: str) -> int:
    """Append only what is new to the table at ``path``; running it twice changes nothing."""
    spark = incoming.sparkSession
    try:
        present = spark.read.parquet(path).select("name", "sha")
    except Exception as exc:  # a missing table is an empty one, any other fault is real
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        present = incoming.select("name", "sha").limit(0)
    new = plan_put(incoming, present).filter("action <> 'noop'").select("seq", "name", "sha", "target")
    new = new.persist()  # counted and written from one plan; what is lost is computed again
    try:
        n = new.count()
        new.write.mode("append").parquet(path)
    finally:
        new.unpersist()
    return n



def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    """Write a whole version, then its pointer: readers see the old or the new one."""
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    spark = df.sparkSession
    spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1).write.mode("append").parquet(f"{path}/_pointer")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest version whose pointer row exists."""
    newest = spark.read.schema("version long").parquet(f"{path}/_pointer").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{path}/v={newest}")
