"""A keyed table that is merged on read: batches append what they bring, buckets are compacted by size.

Layout, all Parquet: ``delta/batch=n/bucket=b`` holds the rows of batch n, ``base/upto=n/bucket=b``
the merged rows of all batches up to n. Readers merge a bucket's newest base with the deltas
after it. A bucket is compacted once its deltas outweigh half its base, so every row is
rewritten a bounded number of times and a batch's cost follows the batch, not the table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming.jobs import feed


class Folder:
    """Listing and removing folders through Hadoop's file systems, so that any store works."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf, self.path = spark._jvm, spark._jsc.hadoopConfiguration(), path

    def _open(self, below: str):
        at = self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)
        return at.getFileSystem(self.conf), at

    def names(self, below: str = "") -> list[str]:
        fs, at = self._open(below)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def has(self, below: str) -> bool:
        fs, at = self._open(below)
        return fs.exists(at)

    def bytes(self, below: str) -> int:
        fs, at = self._open(below)
        return fs.getContentSummary(at).getLength() if fs.exists(at) else 0

    def remove(self, below: str) -> None:
        fs, at = self._open(below)
        fs.delete(at, True)

    def buckets(self, below: str, name: str) -> dict[int, list[int]]:
        """Per bucket, the numbers n of the finished folders ``name=n`` that hold it, ascending."""
        out: dict[int, list[int]] = {}
        for n in sorted(int(m.group(1)) for x in self.names(below) if (m := re.fullmatch(rf"{name}=(\d+)", x))):
            inside = self.names(f"{below}/{name}={n}")
            for x in inside if "_SUCCESS" in inside else ():
                if m := re.fullmatch(r"bucket=(\d+)", x):
                    out.setdefault(int(m.group(1)), []).append(n)
        return out


class KeyedTable:
    """``merge(rows, order)`` reduces rows to one per key; ``order`` names the column that tells later rows from earlier ones.

    Merging must be associative: merged rows are merged again with later ones.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, merge: Callable[[DataFrame, str], DataFrame], buckets: int = 16, slack: float = 0.5):
        self.spark, self.path, self.key, self.merge, self.buckets, self.slack = spark, path, key, merge, buckets, slack
        self.schema = spark.createDataFrame([], schema).schema
        self.folder = Folder(spark, path)

    def _parts(self, before: int | None = None) -> dict[int, tuple[int, list[tuple[str, int]]]]:
        """Per bucket the newest base's number, and what its reader must merge, each with its order."""
        early = lambda ns: [n for n in ns if before is None or n < before]
        bases, deltas = self.folder.buckets("base", "upto"), self.folder.buckets("delta", "batch")
        out = {}
        for bucket in sorted({*bases, *deltas}):
            base = max(early(bases.get(bucket, [])), default=-1)
            parts = [(f"base/upto={base}/bucket={bucket}", base)] if base >= 0 else []
            out[bucket] = base, parts + [(f"delta/batch={n}/bucket={bucket}", n) for n in early(deltas.get(bucket, [])) if n > base]
        return out

    def _read(self, parts: list[tuple[str, int]]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema).withColumn("_order", F.lit(0).cast("long"))
        # One scan for all files; the order is in their paths.
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p, _ in parts])
        return rows.withColumn("_order", F.regexp_extract("_metadata.file_path", r"/(?:upto|batch)=(\d+)/", 1).cast("long"))

    def _write(self, rows: DataFrame, below: str) -> None:
        """All buckets in one job; a hot bucket may have several files."""
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rows.select(*self.schema.names).withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{below}")

    def read(self, before: int | None = None) -> DataFrame:
        """One row per key, from all batches, or from those before one."""
        parts = [p for _, some in self._parts(before).values() for p in some]
        return self.merge(self._read(parts), "_order").select(*self.schema.names)

    def append(self, rows: DataFrame, batch: int) -> None:
        """Write a batch's rows; writing it again replaces them. Then compact the buckets that need it."""
        self._write(rows, f"delta/batch={batch}")
        self.compact(batch)

    def compact(self, batch: int) -> None:
        """Merge the deltas of buckets where they outweigh the slack into new bases; then remove what the bases before replaced.

        A base stays readable until the next compaction of its bucket, so a batch that is run
        again finds the table as it was.
        """
        due = []
        for bucket, (base, parts) in self._parts().items():
            grown = sum(self.folder.bytes(p) for p, n in parts if n != base)
            if base < batch and grown > self.slack * sum(self.folder.bytes(p) for p, n in parts if n == base):
                due.append((bucket, base, parts))
        if not due:
            return
        bases, deltas = self.folder.buckets("base", "upto"), self.folder.buckets("delta", "batch")
        for bucket, base, _ in due:  # no reader of this batch or a later one needs these
            for n in bases.get(bucket, []):
                if n < base:
                    self.folder.remove(f"base/upto={n}/bucket={bucket}")
            for n in deltas.get(bucket, []):
                if n <= base:
                    self.folder.remove(f"delta/batch={n}/bucket={bucket}")
        self._write(self.merge(self._read([p for _, _, parts in due for p in parts]), "_order"), f"base/upto={batch}")


def mirror_stream(stream: DataFrame, path: str, summarise: Callable[[DataFrame], DataFrame], table: KeyedTable) -> DataFrame:
    """Monotone mirror of a growing folder: each batch's summary is appended, reading merges. ``table`` lies below ``path``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.append(summarise(batch), batch_id)

    feed(stream, path, handle)
    return table.read()


def fold_monotone(rows: DataFrame, key: str, static: list[str], order: str) -> DataFrame:
    """Rows of a mirror to one per key: counters only grow, the window only widens, names are the latest known ones."""
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    first = F.min_by("first_seen", F.when(F.col("first_seen").isNotNull(), F.col(order)))
    grown = [F.max(c).alias(c) for c in ("events", "output_tokens", "last_event")]
    return rows.groupBy(key).agg(*[known(c).alias(c) for c in static], *grown, F.min("start").alias("start"), first.alias("first_seen"))
