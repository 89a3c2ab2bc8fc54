"""Embedding sets: mean cosines in linear time, and ranked promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import top_n


def unit_cells(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """One row per dimension of each unit vector; a zero vector stays zero."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    staged = df.select(*keys, v.alias("_v"), F.when(norm == 0, 1.0).otherwise(norm).alias("_n"))
    return staged.select(*keys, "_n", F.posexplode("_v").alias("i", "x")).select(*keys, "i", (F.col("x") / F.col("_n")).alias("u"))


def self_similarity(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean cosine over distinct pairs of each group, without building a pair.

    The pair sum is (|sum u|^2 - sum |u|^2) / 2, so per-dimension sums suffice.
    Groups of fewer than two members get no value.
    """
    cells = unit_cells(df, [group], vector)
    dims = cells.groupBy(group, "i").agg(F.sum("u").alias("s"), F.sum(F.col("u") * F.col("u")).alias("q"), F.count("*").alias("n"))
    g = dims.groupBy(group).agg(F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("q").alias("qq"), F.max("n").alias("n"))
    mean = (F.col("ss") - F.col("qq")) / (F.col("n") * (F.col("n") - 1))
    return g.select(group, "n", F.when(F.col("n") > 1, mean).alias("mean_cos"))


def cross_cosines(arm: DataFrame, ref: DataFrame, item: str, vector: str) -> DataFrame:
    """Mean cosine of every arm item against all of ``ref``: one dot with the mean vector."""
    centre = unit_cells(ref, [], vector).groupBy("i").agg(F.avg("u").alias("m"))
    # one row per dimension of a vector, whatever the sizes of the sets
    return unit_cells(arm, [item], vector).join(F.broadcast(centre), "i").groupBy(item).agg(F.sum(F.col("u") * F.col("m")).alias("mean_cos"))


def medium_report(arms: DataFrame, ref: DataFrame, group: str, item: str, vector: str) -> DataFrame:
    """Per arm: mean cosine to the reference set, its distance to the set's own ceiling, and the verdict."""
    ceiling = self_similarity(ref.withColumn("_r", F.lit(1)), "_r", vector).agg(F.max("mean_cos").alias("ceiling"))
    items = cross_cosines(arms, ref, item, vector).join(arms.select(item, group), item)
    g = items.groupBy(group).agg(F.count("*").alias("n_arm"), F.avg("mean_cos").alias("arm_mean_cos")).join(ceiling)
    delta = F.col("arm_mean_cos") - F.col("ceiling")
    return g.withColumns({"delta": delta, "verdict": F.when(delta >= 0, "at_or_above").otherwise("below")})


def promote(cands: DataFrame, batch: str, item: str, score: str, passed: Column, oversize: Column, top_k: int) -> DataFrame:
    """Best PASS candidates of each batch; oversize ones go to review; without any PASS the best near miss does."""
    c = cands.withColumns({"_pass": passed, "_big": oversize})
    best = top_n(c.filter("_pass"), [batch], [F.col(score).desc_nulls_last(), F.col(item)], top_k)
    chosen = best.select(batch, item, F.when(F.col("_big"), "review_oversize").otherwise("promoted").alias("outcome"))
    near = c.groupBy(batch).agg(F.bool_or("_pass").alias("any"), F.max_by(item, F.struct(F.col(score), -F.col(item))).alias(item))
    missed = near.filter("not any").select(batch, item, F.lit("review_zero_pass").alias("outcome"))
    return chosen.unionByName(missed)
