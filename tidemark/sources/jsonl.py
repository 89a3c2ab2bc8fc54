"""JSON lines whose last line may be half written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and an order inside it: (block start, position in the block).

    Files stay splittable; no file passes through one task as a whole.
    """
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("line_no"),
            F.col("value").alias("line"),
        )
        .filter(F.col("line").rlike(r"\S"))
    )


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    """``rec`` and ``_ok``: a line is good if it is a JSON object; a field of another type is null, no more."""
    raw = lines.withColumn("_raw", F.when(F.col("line").rlike(r"^\s*\{"), F.from_json("line", "map<string,string>")))
    fields = []
    for f in T.StructType.fromDDL(schema):
        text = F.col("_raw").getItem(f.name)
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        fields.append((F.from_json(text, f.dataType) if nested else text.try_cast(f.dataType)).alias(f.name))
    return raw.withColumn("_ok", F.col("_raw").isNotNull()).withColumn("rec", F.when(F.col("_ok"), F.struct(*fields))).drop("_raw")


def parsed_stats(lines: DataFrame, schema: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Per file: good lines, corrupt lines in the middle, and whether the tail is torn.

    A bad last line is a race with the writer, a bad middle line a producer
    fault; the two are counted apart. ``extra`` aggregates over good records.
    """
    p = _parsed(lines, schema)
    g = p.groupBy("file").agg(
        F.count_if("_ok").alias("parsed"), F.count_if(~F.col("_ok")).alias("_bad"), F.max_by(~F.col("_ok"), "line_no").alias("torn_tail"),
        *[e.alias(n) for n, e in (extra or {}).items()],
    )
    return g.withColumn("corrupt_lines", F.col("_bad") - F.col("torn_tail").cast("long")).drop("_bad")


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, per-file quality). Bad lines never fail the read."""
    lines = read_lines(spark, path)
    good = _parsed(lines, schema).filter("_ok").select("file", "line_no", "rec.*")
    return good, parsed_stats(lines, schema)
