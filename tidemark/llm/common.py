"""What several operators of this package share: reading, words, Arrow mapping, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage, shared_dir, tune

#: White space as the contracts mean it: blank and \t \n \v \f \r, nothing else.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the given folder; batches to Python stay small, as texts may be long."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null: blanks are folded first, so no array of words is built."""
    flat = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return F.when(F.coalesce(F.length(flat), F.lit(0)) == 0, F.lit(0)).otherwise(
        F.length(flat) - F.length(F.translate(flat, " ", "")) + 1
    ).cast("long")


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` batch by batch inside the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


#: Holds the columns that an operator only passes on, so that none of its own names can clash with them.
REST = "_tidemark_rest"


def sheltered(df: DataFrame, needs: tuple[str, ...], new: tuple[str, ...], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator`` over the columns it ``needs``; all others are out of its sight and come back as they were.

    Columns of ``df`` named like ``new`` ones are replaced.
    """
    others = [c for c in df.columns if c not in (*needs, *new)]
    packed = df.select(*needs, F.struct(*[F.col(f"`{c}`") for c in others]).alias(REST)) if others else df.select(*needs)
    out = operator(packed)
    back = [F.col(REST)[c].alias(c) if c in others else F.col(c) for c in df.columns if c not in new]
    return out.select(*back, *new)


def on_disk(df: DataFrame) -> DataFrame:
    """Keep a result that several branches read; lost parts are computed anew from their lineage."""
    return df.persist(StorageLevel.DISK_ONLY)


def kept(df: DataFrame) -> DataFrame:
    """Write a result that later steps read to the shared folder: lineage ends here.

    The session then also drops a query's shuffle files when the query ends, so that the
    files of finished steps don't pile up; what is lost with an executor is written anew.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    path = f"{shared_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a map of numbers: a fixed size, however many numbers it holds.
MAP_BITS = 24


def bit_map(numbers: DataFrame, column: str) -> np.ndarray:
    """A map of ``2 ** MAP_BITS`` bits that holds all numbers of a column (and some others); made by aggregation."""
    bit = F.col(column).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rows = numbers.filter(F.col(column).isNotNull()).select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("at")).groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).collect()
    out = np.zeros((1 << MAP_BITS) + (1 << 16), bool)
    for r in rows:  # bucket k holds the numbers from (k - 1) * 32768 + 1 on
        bits = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little").astype(bool)
        first = 0 if r.bucket == 0 else (r.bucket - 1) * 32768 + 1
        out[first : first + 32768] |= bits
    return out[: 1 << MAP_BITS]


def with_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in ``ids``; rows that a bit map rules out are not moved at all."""
    known = np.packbits(bit_map(ids.select(F.xxhash64(key).alias("_h")), "_h"))

    @F.pandas_udf(T.BooleanType())
    def maybe(h: pd.Series) -> pd.Series:
        at = h.to_numpy() & ((1 << MAP_BITS) - 1)
        return pd.Series((known[at >> 3] >> (7 - (at & 7)) & 1).astype(bool))

    # By a merge at every size: few texts are left, and they move alike whatever the size of ids.
    return rows.filter(maybe(F.xxhash64(key))).join(ids.select(key).distinct().hint("merge"), key, "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, root)`` per node, root the least node.

    Alternating large and small stars: every round hangs neighbours under the least
    node they know, by one aggregation and one equi-join, so a hub is never gathered
    in one place (its join is split by the engine). The rounds needed grow with the
    logarithm of a component's size. Every round is checkpointed in the shared folder.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    state = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        near = both(state)
        low = near.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = near.join(low, near.a == low.u).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.join(least, large.a == least.u)
        small = joined.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        state = cut_lineage(small.select("e.a", "e.b").filter("a <> b").distinct())
    leaves = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
