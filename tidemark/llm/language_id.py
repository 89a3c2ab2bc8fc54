"""Language ID by rank-order profiles: out-of-place distance of frequent n-grams.

Profiles are learned from every labelled training document: n-grams of 1 to 3 letters
(words padded with blanks) are counted per language, and the most frequent ones, in
order, are the language's profile. A document is compared by its own most frequent
n-grams: each adds the distance between its two ranks, or the profile's length where
the language doesn't list it. The nearest profile wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import table

PROFILE = 400
UND = "und"
#: Characters counted at once while learning; bounds memory, not what is counted.
CHUNK = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Code of each character: itself for letters (folded to 16 bits), blank for all else."""
    table = np.full(0x110000, 32, np.uint64)
    for i in range(0x110000):
        if chr(i).isalpha():
            table[i] = i if i < 0x10000 else 0x8000 | (i * 40503 & 0x7FFF)
    return table


def grams(text: str) -> np.ndarray:
    """All 1- to 3-grams of the letters of a text, packed into integers; empty without letters."""
    chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    codes = _letters()[chars]
    gap = codes == 32
    codes = codes[~(gap & np.concatenate(([False], gap[:-1])))]
    if len(codes) < 2:
        return codes[:0]
    two = (codes[:-1] << np.uint64(16)) | codes[1:]
    three = (two[:-1] << np.uint64(16)) | codes[2:]
    return np.concatenate((codes[codes != 32], two, three))


def _counted(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(g):
        return g, np.zeros(0, np.int64)
    g = np.sort(g)
    at = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    return g[at], np.diff(np.append(at, len(g)))


def ranked(g: np.ndarray, length: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by value."""
    if not len(g):
        return g
    value, n = _counted(g)
    return value[np.argsort(-n, kind="stable")[:length]]


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(lang: str, texts: list[str]) -> pa.RecordBatch:
        value, n = _counted(grams("\n".join(texts)))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(value)), pa.array(value.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    held: dict[str, list] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            texts, size = held.get(lang, ([], 0))
            texts.append(text)
            held[lang] = texts, size + len(text)
            if size + len(text) >= CHUNK:
                yield emit(lang, held.pop(lang)[0])
    for lang, (texts, _) in held.items():
        if any(texts):
            yield emit(lang, texts)


def learn(docs: DataFrame, length: int = PROFILE) -> DataFrame:
    """Profiles ``(lang, gram, rank)`` from every row of ``docs(lang, text)`` that has both; at most ``length`` rows a language."""
    counts = docs.select("lang", "text").dropna().mapInArrow(_learn, "lang string, gram long, n long")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    return total.withColumn("rank", rank - 1).filter(F.col("rank") < length).select("lang", "gram", "rank")


class Profiles:
    """Rank tables of all languages over the n-grams that any of them lists."""

    def __init__(self, rows: list[tuple[str, int, int]], length: int = PROFILE):
        self.length = length
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([g for _, g, _ in rows], np.uint64))
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        at = np.searchsorted(self.grams, np.array([g for _, g, _ in rows], np.uint64))
        for (lang, _, rank), i in zip(rows, at):
            self.ranks[self.langs.index(lang), i] = rank

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and score: how far the nearest profile lies before the second, from 0 to 1."""
        mine = ranked(grams(text), self.length) if text else []
        if not len(mine) or not self.langs:
            return UND, 0.0
        at = np.searchsorted(self.grams, mine)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == mine, at, len(self.grams))
        theirs = self.ranks[:, at]
        far = np.where(theirs < 0, self.length, np.abs(theirs - np.arange(len(mine)))).sum(axis=1)
        best = int(np.argmin(far))
        others = np.delete(far, best)
        worst = int(others.min()) if len(others) else self.length * len(mine)
        return self.langs[best], (worst - int(far[best])) / worst if worst else 0.0


def identify(docs: DataFrame, profiles: DataFrame, length: int = PROFILE, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every
    text if nothing was learned. Texts are read whole. Ties go to the first language by
    code point. Equal texts get equal results. Columns of those names are replaced. The
    profiles, at most ``length`` rows a language, come to the driver and travel with the tasks.
    """
    model = Profiles([tuple(r) for r in profiles.select("lang", "gram", "rank").collect()], length)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*keep)
    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [model.judge(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([s for s, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], names=[*keep, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def lettered(docs: DataFrame, profiles: DataFrame, length: int = PROFILE) -> DataFrame:
    """``docs`` without the rows whose language can't be told: those judged ``und``.

    Nothing learned rejects nothing but texts without a letter.
    """
    said = identify(docs.drop("lang_pred", "score").withColumn("_text", F.col("text")), profiles, length, "_text")
    return said.filter((F.col("lang_pred") != UND) | F.col("_text").rlike(r"\p{L}")).select(*docs.columns)


def held_out(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    profiles = learn(docs.filter(~held_out("doc_id")))
    said = identify(docs.select("doc_id", "text"), profiles)
    return said.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def register(queries: dict, oracles: dict) -> None:
    queries["op10_language_id"] = op10_language_id
