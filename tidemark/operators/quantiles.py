"""Exact interpolated percentiles by radix selection, without collecting or ranking a group in one task.

Values become 64-bit codes in their own order. A round counts a group's values by the next
digit of their codes, finds the digit that holds each wanted rank, and keeps only values
that share it; after the last digit the code is the answer. The number of rounds is fixed by
the digit's width, the counts of a group by the number of digits, whatever the data are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

#: Bits of a digit: three rounds, and at most four million counts per group and rank.
DIGIT = 22


def _codes(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys, _c, _v, _x``: a row for each value that is there, with its column's number and its code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in range(len(columns)):
                some = batch.filter(pc.is_valid(batch.column(len(keys) + c)))
                x = some.column(len(keys) + c).to_numpy() + 0.0  # one zero
                x[np.isnan(x)] = np.nan
                bits = x.view(np.int64)
                code = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
                yield pa.RecordBatch.from_arrays([*some.columns[: len(keys)], pa.array(np.full(len(x), c, np.int32)), pa.array(code), pa.array(x)], names=[*keys, "_c", "_v", "_x"])

    rows = df.select(*keys, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    schema = StructType([*[df.schema[k] for k in keys], StructField("_c", IntegerType()), StructField("_v", LongType()), StructField("_x", DoubleType())])
    return rows.mapInArrow(run, schema)


def percentiles(df: DataFrame, keys: list[str], wanted: dict[str, dict[str, float]], total: bool = False, digit: int = DIGIT) -> DataFrame:
    """Percentiles of several columns at once: ``wanted`` maps a column to names and shares.

    One row per key with a column per name; null keys are groups, null values are left out.
    With ``total`` there is one more row over all keys, with ``_all`` true; without keys there
    is one row in any case.
    """
    columns = list(wanted)
    names = [(c, name, float(p)) for c, column in enumerate(columns) for name, p in wanted[column].items()]
    pack = F.struct(*keys) if keys else F.lit(0)
    rows = _codes(df, keys, columns).select(pack.alias("_k"), "_c", "_v", "_x")
    nobody = F.struct(*[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys]) if keys else F.lit(0)
    prefix = lambda r: F.shiftright("_v", max(64 - digit * r, 0))
    group = ["_all", "_k", "_c"]
    # Without keys a round asks for as many prefixes as names; with keys Spark decides by size.
    side = (lambda d: d) if keys else F.broadcast

    counts = rows.groupBy(F.lit(False).alias("_all"), "_k", "_c", F.lit(0).cast("long").alias("_p"), prefix(1).alias("_q")).agg(F.count("*").alias("_n"), F.min("_x").alias("_x"))
    if total:
        sums = counts.groupBy("_c", "_p", "_q").agg(F.sum("_n").alias("_n"), F.min("_x").alias("_x"))
        counts = counts.unionByName(sums.withColumns({"_all": F.lit(True), "_k": nobody}))
    entries = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(n).alias("name"), F.lit(p).alias("p")) for c, n, p in names])
    asked = counts.groupBy(*group).agg(F.sum("_n").alias("_size")).select("*", F.explode(F.filter(entries, lambda e: e["c"] == F.col("_c"))).alias("e"))
    rank = F.col("e.p") * (F.col("_size") - 1)
    asked = asked.select(*group, "e.name", (rank - F.floor(rank)).alias("share"), F.explode(F.array(F.struct(F.lit(0).alias("high"), F.floor(rank).alias("left")), F.struct(F.lit(1).alias("high"), F.ceil(rank).alias("left")))).alias("s"))
    asked = asked.select(*group, "name", "share", "s.high", "s.left", F.lit(0).cast("long").alias("_p"))
    totals = rows
    for r in range(1, -(-64 // digit) + 1):
        if r > 1:
            before = asked.select(*group, "_p").distinct()
            own = before.filter("NOT _all").select(*[F.col(c).alias(f"{c}_") for c in ("_k", "_c", "_p")])
            # A semi join may broadcast what it looks up only, never the values.
            rows = rows.join(side(own), (F.col("_k") == F.col("_k_")) & (F.col("_c") == F.col("_c_")) & (prefix(r - 1) == F.col("_p_")), "left_semi")
            counts = rows.groupBy(F.lit(False).alias("_all"), "_k", "_c", prefix(r - 1).alias("_p"), prefix(r).alias("_q")).agg(F.count("*").alias("_n"), F.min("_x").alias("_x"))
            if total:
                few = before.filter("_all").select(F.col("_c").alias("_c_"), F.col("_p").alias("_p_"))  # two for each name at most
                totals = totals.join(F.broadcast(few), (F.col("_c") == F.col("_c_")) & (prefix(r - 1) == F.col("_p_"))).select("_k", "_c", "_v", "_x")
                more = totals.groupBy("_c", prefix(r - 1).alias("_p"), prefix(r).alias("_q")).agg(F.count("*").alias("_n"), F.min("_x").alias("_x"))
                counts = counts.unionByName(more.withColumns({"_all": F.lit(True), "_k": nobody}))
        upto = Window.partitionBy(*group, "_p").orderBy("_q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = counts.withColumn("_end", F.sum("_n").over(upto))
        # The ends, as many as the values have digits, lie sorted by these columns: merged, not broadcast.
        asked = asked.join(ends.hint("merge"), [*group, "_p"]).filter((F.col("left") < F.col("_end")) & (F.col("left") >= F.col("_end") - F.col("_n")))
        asked = asked.select(*group, "name", "share", "high", (F.col("left") - F.col("_end") + F.col("_n")).alias("left"), F.col("_q").alias("_p"), "_x")
        if r * digit < 64:
            # A few rows per key and name that two branches read: kept, with their lineage, so that neither is planned or run twice.
            asked = asked.drop("_x").persist(StorageLevel.DISK_ONLY)
    at = lambda n, high: F.max(F.when((F.col("name") == n) & (F.col("high") == high), F.col("_x")))
    share = lambda n: F.max(F.when(F.col("name") == n, F.col("share")))
    wide = [(at(n, 0) + (at(n, 1) - at(n, 0)) * share(n)).alias(n) for _, n, _ in names]
    if not keys:
        return asked.agg(*wide)
    out = asked.groupBy("_all", "_k").agg(*wide)
    return out.select(*[F.col(f"_k.{k}").alias(k) for k in keys], *(["_all"] if total else []), *[n for _, n, _ in names])


def exact_percentiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float], digit: int = DIGIT) -> DataFrame:
    """One row per key with a column per wanted percentile of one column (linear interpolation)."""
    return percentiles(df, list(keys), {value: ps}, digit=digit)
