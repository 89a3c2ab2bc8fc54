"""Secret scans over a ledger of content-addressed blobs.

A text is a blob, addressed by its SHA-256. Only pairs of blob and rule version that
the ledger has not seen are scanned; findings are joined back to every path that
holds the blob. A ledger is a Parquet table ``(blob, rule, spans)``; its rows are
appended per run and never changed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import sheltered, table
from tidemark.session import shared_dir

#: kind -> (version, pattern, group whose length counts, least length). In the order that ties are listed.
RULES = {
    "assign": (1, re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 8),
    "access": (1, re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (1, re.compile(r"[0-9a-f]+"), 0, 32),
}
#: What a text must hold, in ASCII lower case, for a rule to be tried at all.
_HINTS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",)}
#: Most texts have no run long enough; this search is quicker than listing all short runs.
_LONG_HEX = re.compile(r"[0-9a-f]{32}")


def find(text: str, kinds: tuple[str, ...]) -> list[tuple[int, int, str]]:
    """Spans ``(start, end, kind)`` in code points, end exclusive, by start and then kind as listed."""
    low = text.lower()  # only a hint: at least as wide as the ASCII rule
    spans = []
    for at, kind in enumerate(RULES):
        if kind not in kinds or (kind in _HINTS and not any(h in low for h in _HINTS[kind])):
            continue
        _, pattern, group, least = RULES[kind]
        if kind == "hex" and not _LONG_HEX.search(text):
            continue
        spans += [(m.start(), at, m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(s, e, k) for s, _, e, k in sorted(spans)]


SPANS = "array<struct<start:long,stop:long,kind:string>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())])
    for batch in batches:
        wanted = batch.column(2).to_pylist()
        found = []
        for i, text in enumerate(batch.column(1)):
            for rule in wanted[i]:
                spans = find(text.as_py(), (rule.partition("@")[0],))
                found.append((i, rule, [{"start": s, "stop": e, "kind": k} for s, e, k in spans]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array([i for i, _, _ in found], pa.int32())), pa.array([r for _, r, _ in found], pa.string()), pa.array([s for _, _, s in found], pa.list_(kind))],
            names=["blob", "rule", "spans"],
        )


def rule_ids(kinds: tuple[str, ...] = tuple(RULES)) -> list[str]:
    return [f"{k}@{RULES[k][0]}" for k in kinds]


def address(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``blob``, the content address; a null text is the empty blob."""
    return docs.withColumn("blob", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)))


def scan(docs: DataFrame, ledger: DataFrame | None = None, text: str = "text", kinds: tuple[str, ...] = tuple(RULES)) -> DataFrame:
    """New ledger rows ``(blob, rule, spans)``: one for every unseen pair of blob and rule version.

    Copies meet on their address before the text is looked at, so each blob is scanned
    once however many documents hold it. Without rows there is nothing to scan.
    """
    blobs = address(docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))).groupBy("blob").agg(F.first("text").alias("text"))
    blobs = blobs.withColumn("rules", F.array(*map(F.lit, rule_ids(kinds))))
    if ledger is not None:
        seen = ledger.groupBy(F.col("blob").alias("_blob")).agg(F.collect_set("rule").alias("seen"))
        blobs = blobs.join(seen, F.col("blob") == F.col("_blob"), "left").withColumn("rules", F.array_except("rules", F.coalesce("seen", F.array().cast("array<string>")))).drop("_blob", "seen")
    return blobs.filter(F.size("rules") > 0).select("blob", "text", "rules").mapInArrow(_scan, f"blob binary, rule string, spans {SPANS}")


def current(ledger: DataFrame, kinds: tuple[str, ...] = tuple(RULES)) -> DataFrame:
    """``(blob, spans)`` of the current rule versions, spans in order; blobs without findings are left out."""
    rows = ledger.filter(F.col("rule").isin(rule_ids(kinds)) & (F.size("spans") > 0))
    per_rule = rows.groupBy("blob", "rule").agg(F.first("spans").alias("spans"))  # two runs may have written the same pair
    at = F.create_map(*[x for i, k in enumerate(RULES) for x in (F.lit(k), F.lit(i))])
    every = F.array_sort(F.transform(F.flatten(F.collect_list("spans")), lambda s: F.struct(s.start.alias("start"), at[s.kind].alias("at"), s.stop.alias("stop"), s.kind.alias("kind"))))
    return per_rule.groupBy("blob").agg(F.transform(every, lambda s: F.struct(s.start.alias("start"), s.stop.alias("stop"), s.kind.alias("kind"))).alias("spans"))


def find_secrets(docs: DataFrame, ledger: DataFrame | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``spans`` (start, stop, kind), through the ledger: every row, repeated ones too.

    Null and empty texts have no spans. ``blob`` and ``spans`` columns of the input are replaced.
    """
    fresh = scan(docs, ledger, text)
    return located(docs, fresh if ledger is None else ledger.select("blob", "rule", "spans").unionByName(fresh), text)


def located(docs: DataFrame, ledger: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``blob`` and the ``spans`` that the ledger has of it: only addresses and findings travel to the paths."""
    found = current(ledger).select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))

    def joined(rows: DataFrame) -> DataFrame:
        met = address(rows, text).join(found, F.col("blob") == F.col("_blob"), "left")
        return met.withColumn("spans", F.coalesce(F.col("_spans"), F.array().cast(SPANS)))

    return sheltered(docs, tuple(c for c in docs.columns if c in ("doc_id", text)), ("blob", "spans"), joined)


def update_ledger(docs: DataFrame, path: str, text: str = "text", kinds: tuple[str, ...] = tuple(RULES)) -> DataFrame:
    """Append to the ledger stored at ``path`` what ``docs`` holds that it hasn't seen, and return the whole ledger.

    Call it for each delivery of versions. An append that is lost half-way leaves no rows, and
    one that is made twice only repeats rows, which ``current`` folds.
    """
    spark = docs.sparkSession
    book = lambda: spark.read.schema(f"blob binary, rule string, spans {SPANS}").parquet(path)
    try:
        seen = book()
    except AnalysisException:  # nothing is stored yet
        seen = None
    scan(docs, seen, text, kinds).write.mode("append").parquet(path)
    return book()


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Findings of all documents from a ledger in the shared folder, which the query fills."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger = update_ledger(docs, f"{shared_dir(spark).rstrip('/')}/secrets-{uuid.uuid4().hex}")
    return digest_spans(located(docs, ledger))


def digest_spans(rows: DataFrame) -> DataFrame:
    """Counts by kind and the spans as text, ``kind:start:end`` in their order."""
    said = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in RULES]
    return rows.select("doc_id", *counts, F.sha2(said.cast("binary"), 256).alias("base_sha256"), said.alias("spans"))


def register(queries: dict, oracles: dict) -> None:
    queries["op9_secret_scan"] = op9_secret_scan
