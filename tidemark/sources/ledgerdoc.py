"""Authored ledgers and session notes cut into items and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Item and heading grammar.
ITEM_START = r"(?m)^(?=\d+\.\s)"
ITEM = r"(?s)^(\d+)\.\s+\S+\s+\*\*(\d{4}-\d{2}-\d{2})\s*-\s*(.+?)\*\*"
SEP = "\n---\n\n"
HEADING = r"(?m)^(?=#{1,2} (?:s\d+(?:\.\d+)*(?:-s\d+(?:\.\d+)*)? wrap\b|\d{4}-\d{2}-\d{2}\b))"


def ledger_items(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Numbered, dated items of a ledger: (number, date, title, body)."""
    blocks = docs.select(*keep, F.posexplode(F.split(text, ITEM_START)).alias("pos", "body")).filter(F.col("body").rlike(ITEM))
    return blocks.select(
        *keep, F.regexp_extract("body", ITEM, 1).cast("long").alias("number"), F.regexp_extract("body", ITEM, 2).alias("date"),
        F.regexp_extract("body", ITEM, 3).alias("title"), "body",
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Items of ledger files. A ledger is one authored document, read whole."""
    return ledger_items(spark.read.text(path, wholetext=True), "value", [])


def split_blocks(docs: DataFrame, key: str, text: str, sep: str = SEP, heading: str = HEADING) -> DataFrame:
    """(key, pos, kind, block): header, pinned blocks before the first session, sessions, extras after.

    A block that holds several headings is cut again at each of them.
    """
    parts = F.split(text, "\\Q" + sep + "\\E")
    is_session = F.transform(parts, lambda p, i: (i > 0) & F.regexp_replace(p, "^\n+", "").rlike(r"\A" + heading))
    first = F.array_position(is_session, True)
    d = docs.select(key, F.posexplode(F.arrays_zip(parts.alias("p"), is_session.alias("s"))).alias("pos", "z"), first.alias("first"))
    kind = (
        F.when(F.col("pos") == 0, "header").when(F.col("z.s"), "session")
        .when((F.col("first") == 0) | (F.col("pos") + 1 < F.col("first")), "pinned").otherwise("extra")
    )
    # glued sessions: text before the first heading stays with the first piece
    glued = F.split("z.p", heading)
    pieces = F.when(
        F.col("z.s") & (F.size(glued) > 1) & glued[0].rlike(r"^\s*$"),
        F.concat(F.array(F.concat(glued[0], glued[1])), F.slice(glued, F.lit(3), F.greatest(F.lit(0), F.size(glued) - 2))),
    ).when(F.col("z.s"), glued).otherwise(F.array("z.p"))
    return d.select(key, "pos", kind.alias("kind"), F.posexplode(pieces).alias("sub", "block"))
