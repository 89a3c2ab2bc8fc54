"""Line dedup: range-partitioned line hashes, streamed in order, answered with keep bitmaps.

1. Lines worth counting become rows ``(hash, doc, pos)`` that carry no text. They are
   range-partitioned and sorted by hash, then document (largest first), then position.
2. Each partition is streamed once. Of every hash the first document stays, later ones
   go as soon as enough documents were seen. A hash that may run over a partition's edge
   is left open, with a count for each partition it touches; these few counts (two per
   partition at most) are summed and settle the open rows. A hash with a third of all
   lines is thus spread over many partitions.
3. The dropped positions of a document become one compressed bitmap of kept lines.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ascii_lower, on_disk, sheltered, table

MIN_LENGTH = 40
MIN_DOCS = 5
#: Rows without a document id count as one document, below all others.
NO_ID = -(2**63)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of (hash, doc descending) to decisions.

    kind 0: drop this row. kind 1: an edge row whose hash may go on before or after
    this partition. kind 2: what this partition counts of such a hash (docs, largest doc).
    Rows held back are those of a hash's first few documents.
    """
    names = ["kind", "hash", "hash2", "doc", "mark", "pos", "n"]
    kinds = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    out: list[tuple] = []
    key, doc, n, first_run, held, top = None, None, 0, True, [], None

    def close(last: bool) -> None:
        """The run of ``key`` has ended here."""
        if key is None:
            return
        if first_run or last:
            out.extend((1, *key, d, m, p, 0) for d, m, p in held)
            out.append((2, *key, top, 0, 0, n))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(5)]
        for h, h2, d, m, p in zip(*cols):
            if key != (h, h2):
                if key is not None:
                    close(False)
                    first_run = False
                key, doc, n, held, top = (h, h2), None, 0, [], d
            if doc is None or d != doc:
                doc, n = d, n + 1
                if n == min_docs and not first_run:
                    out.extend((0, *key, x, y, z, 0) for x, y, z in held if x != top)
                    held = [x for x in held if x[0] == top]
            if first_run:  # may have begun in an earlier partition: everything stays open
                out.append((1, h, h2, d, m, p, 0))
            elif n >= min_docs:
                out.append((0, h, h2, d, m, p, 0))
            else:
                held.append((d, m, p))
            if len(out) >= 20_000:
                yield flush()
                out = []
    close(True)
    if out:
        yield flush()


def dropped_lines(docs: DataFrame, min_length: int, min_docs: int) -> DataFrame:
    """``(doc, mark, pos)`` of every line to drop; ``docs`` has ``doc, mark, text``."""
    parts = docs.select("doc", "mark", F.posexplode(F.split(F.col("text"), "\n", -1)).alias("pos", "line"))
    parts = parts.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= min_length)
    rows = parts.select(F.xxhash64("key").alias("hash"), F.xxhash64(F.lit(1), F.reverse("key")).alias("hash2"), "doc", "mark", "pos")
    # A document's rows of one hash never part: only whole documents are dealt over partitions.
    spread = rows.repartitionByRange("hash", "hash2", F.col("doc").desc()).sortWithinPartitions("hash", "hash2", F.col("doc").desc(), "mark", "pos")
    said = on_disk(spread.mapInArrow(lambda b: _stream(b, min_docs), "kind byte, hash long, hash2 long, doc long, mark long, pos int, n long"))
    totals = said.filter("kind = 2").groupBy(F.col("hash").alias("h"), F.col("hash2").alias("h2")).agg(F.sum("n").alias("docs"), F.max("doc").alias("top"))
    # At most two rows per partition of the sort, whatever the input.
    late = said.filter("kind = 1").join(F.broadcast(totals), F.expr("hash = h AND hash2 = h2")).filter((F.col("docs") >= min_docs) & (F.col("doc") < F.col("top")))
    return said.filter("kind = 0").select("doc", "mark", "pos").union(late.select("doc", "mark", "pos"))


def bitmap(dropped: list[int]) -> bytes:
    """Lines up to the last dropped one as bits, 1 for kept, deflated; lines after it stay."""
    at = np.asarray(dropped, np.int64)
    bits = np.ones(-(-(int(at.max()) + 1) // 8) * 8, np.uint8)  # the last byte is filled up with kept lines
    bits[at] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def kept(text: str, packed: bytes) -> str:
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))
    return "\n".join(line for i, line in enumerate(lines) if i >= len(bits) or bits[i])


@F.pandas_udf(T.BinaryType())
def _bitmaps(dropped: pd.Series) -> pd.Series:
    return dropped.map(bitmap)


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, packed: pd.Series) -> pd.Series:
    return pd.Series([t if b is None or t is None else kept(t, b) for t, b in zip(text, packed)], dtype=object)


def keyed(docs: DataFrame) -> DataFrame:
    """Add ``_doc`` and ``_mark``, which tell rows apart; equal rows share both and every decision."""
    return docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_mark": F.xxhash64("text")})


def keep_bitmaps(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc, mark, keep, n_dropped)`` of documents that lose a line; ``keep`` is the compressed bitmap."""
    rows = keyed(docs.select("doc_id", "text")).select(F.col("_doc").alias("doc"), F.col("_mark").alias("mark"), "text")
    gone = dropped_lines(rows, min_length, min_docs).groupBy("doc", "mark").agg(F.collect_set("pos").alias("at"))
    return gone.select("doc", "mark", _bitmaps("at").alias("keep"), F.size("at").cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``kept`` (the text without dropped lines), ``n_lines`` and ``n_dropped``.

    Null and empty texts are one empty line and keep it (``kept`` stays null for null).
    Rows that share a ``doc_id`` are one document; rows equal in both are decided alike.
    A null ``doc_id`` counts as one document below all others. Ties cannot arise: the
    largest document keeps all its lines of a key. Very long texts are split and joined whole;
    an empty table gives no rows. Columns named like results are replaced.
    """
    maps = keep_bitmaps(docs, min_length, min_docs).select(F.col("doc").alias("_of"), F.col("mark").alias("_of_mark"), F.col("keep").alias("_keep"), F.col("n_dropped").alias("_gone"))
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"))) + 1

    def deduped(rows: DataFrame) -> DataFrame:
        met = keyed(rows).join(maps, F.expr("_doc = _of AND _mark = _of_mark"), "left")
        return met.withColumns({"kept": _kept("text", "_keep"), "n_lines": F.coalesce(lines, F.lit(1)).cast("long"), "n_dropped": F.coalesce("_gone", F.lit(0).cast("long"))})

    return sheltered(docs, ("doc_id", "text"), ("kept", "n_lines", "n_dropped"), deduped)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keys AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS top FROM keys WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id < c.top AS gone FROM keys k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def register(queries: dict, oracles: dict) -> None:
    queries["op5_line_dedup"] = op5_line_dedup
    oracles["op5_line_dedup"] = SQL
