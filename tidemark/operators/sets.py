"""Set logic over collections of files and documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a text scope leaves out.
SKIP_PARTS = ("_archive", "node_modules", "__pycache__", ".git", "logs")
SKIP_PREFIXES = ("ops/runtime/",)
SKIP_EXTS = (
    ".pyc", ".pyd", ".db", ".db-shm", ".db-wal", ".png", ".jpg", ".jpeg", ".gif", ".webp", ".ico", ".zip", ".gz", ".exe", ".dll",
    ".lnk", ".woff", ".woff2", ".ttf", ".bin", ".so", ".o", ".jsonl",
)
LOG_NAME = r"(?i)\.log(\.\d+)?$"
HISTORY = r"(?i)CHANGELOG|HISTORY|LEDGER|_archive|WAKEUP"


def reconcile_set(owed: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """History kept, vanished owed items dropped, new items added: (key, status)."""
    shown = owed.filter("shown").select(key, F.lit("shown").alias("status"))
    still = owed.filter("not shown").join(present.select(key), key, "left_semi").select(key, F.lit("owed").alias("status"))
    new = present.select(key).join(owed.select(key), key, "left_anti").select(key, F.lit("new").alias("status"))
    return shown.unionByName(still).unionByName(new)


def prefer_live(live: DataFrame, mirror: DataFrame, key: str) -> DataFrame:
    """Union in which a live row replaces the mirrored one of the same id."""
    rest = mirror.join(live.select(key), key, "left_anti")
    return live.withColumn("source", F.lit("live")).unionByName(rest.withColumn("source", F.lit("mirror")))


def in_scope(path: Column, roots: tuple[str, ...] = (), parts=SKIP_PARTS, prefixes=SKIP_PREFIXES, exts=SKIP_EXTS) -> Column:
    """Whether a relative path is authored text rather than data, logs or build output."""
    pieces = F.split(path, "/")
    name = F.lower(F.element_at(pieces, -1))
    out = F.arrays_overlap(pieces, F.array(*[F.lit(p) for p in parts])) | name.rlike(LOG_NAME)
    for p in prefixes:
        out = out | path.startswith(p)
    if roots:
        out = out | pieces[0].isin(*roots)
    return ~(out | F.lower(F.regexp_extract(name, r"[^.](\.[^.]*)$", 1)).isin(*exts))


def exclude_paths(df: DataFrame, path: str, **rules) -> DataFrame:
    return df.filter(in_scope(F.col(path), **rules))


def census_population(routed: DataFrame, unrouted: DataFrame, key: str) -> DataFrame:
    """Both populations, each asset once; the routed row wins."""
    both = routed.withColumn("population", F.lit("routed")).unionByName(unrouted.withColumn("population", F.lit("unrouted")))
    rest = [c for c in both.columns if c != key]
    g = both.groupBy(key).agg(F.min_by(F.struct(*rest), "population").alias("r"))
    return g.select(key, "r.*")


def glob_regex(glob: str) -> str:
    """Path filter pattern: ``**`` spans folders, ``*`` and ``?`` do not."""
    out = re.escape(glob).replace(r"\*\*/", "(?:.*/)?").replace(r"\*\*", ".*").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
    return f"^{out}$"


def ignored_by_all(files: DataFrame, group: str, path: str, filters: dict[str, list[str]]) -> DataFrame:
    """True only when every trigger's filter covers every file of the group; no filter means false."""
    usable = bool(filters) and all(filters.values())
    covered = F.lit(usable)
    for globs in filters.values():
        hit = F.lit(False)
        for g in globs:
            hit = hit | F.col(path).rlike(glob_regex(g))
        covered = covered & hit
    return files.groupBy(group).agg(F.bool_and(covered).alias("ignored"))


def stale_mentions(docs: DataFrame, path: str, text: str, terms: list[str], history: str = HISTORY) -> DataFrame:
    """Documents outside the history that still hold a retired term: (path, term)."""
    found = F.filter(F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in terms]), lambda x: x.isNotNull())
    return docs.filter(~F.col(path).rlike(history)).select(path, F.explode(found).alias("term"))
