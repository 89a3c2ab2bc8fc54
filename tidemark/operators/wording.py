"""Fuzzy wordmark rules over whole texts.

Similarity is costly, so it runs once per distinct token that can reach the
floor at all (a bound from lengths and shared letters, as a column), not once per
word of every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X


def can_reach(token: Column, targets: tuple[str, ...], floor: float) -> Column:
    """Whether the letters a token shares with some target allow a similarity of ``floor`` at all."""
    letters = sorted(set("".join(targets)))
    held = {c: F.length(token) - F.length(F.replace(token, F.lit(c))) for c in letters}
    some = F.lit(False)
    for t in targets:
        shared = sum((F.least(held[c], F.lit(t.count(c))) for c in sorted(set(t))), F.lit(0))
        some = some | (2 * shared >= floor * (F.length(token) + len(t)))
    return some


def tokens_of(words: DataFrame) -> DataFrame:
    """Distinct ``word`` with its ``token``.

    The one-element explode keeps the optimizer from writing the token's expression into
    every use of it, and filters on it from sinking below the de-duplication.
    """
    return words.select("word").distinct().select("word", F.explode(F.array(X.norm_token(F.col("word")))).alias("token"))


def similar_tokens(words: DataFrame, targets: tuple[str, ...], floor: float) -> DataFrame:
    """``token, target, ratio`` of every distinct token that is at least ``floor`` similar to a target."""
    pairs = tokens_of(words).select("token").distinct().select("token", F.explode(F.array(*map(F.lit, targets))).alias("target"))
    reach = F.lit(False)
    for t in targets:
        reach = reach | ((F.col("target") == t) & can_reach(F.col("token"), (t,), floor))
    rated = pairs.filter((F.col("token") != "") & reach).withColumn("ratio", X.fuzzy_ratio(F.col("token"), F.col("target")))
    return rated.filter(F.col("ratio") >= floor)


def _docs_with_token(words: DataFrame, key: str, targets: tuple[str, ...], floor: float) -> DataFrame:
    """Keys holding a word at least ``floor`` similar to one of ``targets``."""
    n, sizes = F.length("token"), [len(t) for t in targets]
    # The lengths alone allow it: 2 * min / (a + b) >= floor.
    near = (n * (2 - floor) >= floor * min(sizes)) & (n * floor <= (2 - floor) * max(sizes))
    words = words.filter(F.length("word") * (2 - floor) >= floor * min(sizes))  # a token is no longer than its word
    vocab = tokens_of(words).filter(near).filter(can_reach(F.col("token"), targets, floor))
    good = vocab.filter(X.best_ratio(targets, floor)(F.col("token")) >= floor).select("word")
    return words.join(good, "word", "left_semi").select(key).distinct()


def _words(df: DataFrame, key: str, text: str, split: str) -> DataFrame:
    return df.select(key, F.explode(F.split(text, split)).alias("word"))


def keep_wordmark(df: DataFrame, key: str, text: str, split: str = r"\s+") -> DataFrame:
    """Key and whether its words read as the wordmark that must be kept."""
    joined = df.select(key, X.norm_token(F.col(text)).alias("_j"))
    # a whole text can only reach one half if it is at most three times the target
    short = joined.filter(F.length("_j") <= 3 * len(X.KEEP_TARGET))
    whole = short.filter(X.best_ratio((X.KEEP_TARGET,), 0.5)(F.col("_j")) >= 0.5).select(key)
    halves = joined.filter(F.contains("_j", F.lit("LEAGUE")) & F.contains("_j", F.lit("LEGENDS"))).select(key)
    token = _docs_with_token(_words(df, key, text, split), key, X.KEEP_WORDS, 0.7)
    hits = whole.unionByName(halves).unionByName(token).distinct().withColumn("keep", F.lit(True))
    return df.select(key).join(hits, key, "left").fillna(False, ["keep"])


def fuzzy_credit(df: DataFrame, key: str, text: str, split: str = r"\s+") -> DataFrame:
    """Key and whether it names a credit host, exactly or through a garbled word."""
    exact = df.filter(X.credit_exact(F.array(F.col(text)))).select(key)
    token = _docs_with_token(_words(df, key, text, split), key, X.CREDIT_HOSTS, 0.7)
    hits = exact.unionByName(token).distinct().withColumn("credit", F.lit(True))
    return df.select(key).join(hits, key, "left").fillna(False, ["credit"])
