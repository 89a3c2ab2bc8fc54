"""Claims on paths, start gates, reconciliation and reference checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import naming


def _holders(claims: DataFrame) -> DataFrame:
    """First and last holder name per key: enough to know if anyone else holds it."""
    return claims.groupBy("key").agg(F.min("agent").alias("lo"), F.max("agent").alias("hi"))


def claim_conflicts(claims: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted paths with their conflict flag and whether the whole request is granted.

    ``claims``: key, agent. ``wanted``: request, agent, key (null = unusable path).
    Containment both ways becomes equi-joins on ancestor paths; holders are
    reduced to two names per key first, so no pair list is built.
    """
    held = _holders(claims)
    above = (
        wanted.filter("key is not null").select("request", "agent", "key", F.explode(naming.ancestors(F.col("key"))).alias("anc"))
        .join(held.withColumnRenamed("key", "anc"), "anc")
    )
    below_keys = claims.select(F.explode(naming.ancestors(F.col("key"))).alias("anc"), "agent").groupBy("anc").agg(
        F.min("agent").alias("lo"), F.max("agent").alias("hi")
    )
    below = wanted.filter("key is not null").select("request", "agent", "key", F.col("key").alias("anc")).join(below_keys, "anc")
    other = (F.col("lo") != F.col("agent")) | (F.col("hi") != F.col("agent"))
    hits = above.unionByName(below).filter(other).select("request", "agent", "key").distinct().withColumn("_hit", F.lit(True))
    flagged = wanted.join(hits, ["request", "agent", "key"], "left").withColumn(
        "conflict", F.col("key").isNull() | F.coalesce("_hit", F.lit(False))
    ).drop("_hit")
    grant = flagged.groupBy("request").agg((~F.bool_or("conflict")).alias("granted"))
    return flagged.join(grant, "request")


def start_gate(slices: DataFrame, claims: DataFrame) -> DataFrame:
    """Every problem that keeps a slice from starting: (slice, file, problem).

    ``slices``: slice, agent, file (null = declares none). ``claims``: key, agent,
    ord; the first claim that covers a file holds it.
    """
    named = slices.withColumn("key", naming.claim_key(F.col("file")))
    covers = claims.groupBy(F.col("key").alias("anc")).agg(F.min(F.struct("ord", "agent")).alias("h"))
    held = (
        named.filter("key is not null").select("slice", "file", F.explode(naming.ancestors(F.col("key"))).alias("anc"))
        .join(covers, "anc").groupBy("slice", "file").agg(F.min("h").alias("h"))
    )
    joined = named.join(held, ["slice", "file"], "left")
    problem = (
        F.when(F.coalesce(F.trim("file"), F.lit("")) == "", "no_files")
        .when(F.col("key").isNull(), "bad_path")
        .when(F.col("h").isNull(), "unclaimed")
        .when(F.col("h.agent") != F.col("agent"), "held_by_other")
    )
    return joined.withColumn("problem", problem).filter("problem is not null").select("slice", "file", "problem")


def shared_files(slices: DataFrame, parts: int | None = None) -> DataFrame:
    """Files named by two or more open slices. ``parts``: tasks that the pairs are dealt to, by both columns, so that a hot file is spread."""
    pairs = slices.select("file", "slice")
    once = (pairs.repartition(parts, "file", "slice") if parts else pairs).distinct()
    return once.groupBy("file").agg(
        F.count("slice").alias("n_slices"), F.min("slice").alias("first_slice"), F.max("slice").alias("last_slice")
    ).filter("n_slices > 1")


def reconcile(claims: DataFrame, observed: DataFrame) -> DataFrame:
    """CONFIRM or QUARANTINE per slice; an absent claim is not checked, an absent observation counts zero."""
    j = claims.join(observed, "slice", "left")
    p, f = F.coalesce("passed", F.lit(0)), F.coalesce("failed", F.lit(0))
    why = F.concat_ws(
        ";",
        F.when(~F.coalesce("file_exists", F.lit(False)), "file_missing"),
        F.when(F.col("claimed_passed") != p, F.concat_ws("", F.lit("passed "), "claimed_passed", F.lit("<>"), p)),
        F.when(F.col("claimed_failed") != f, F.concat_ws("", F.lit("failed "), "claimed_failed", F.lit("<>"), f)),
    )
    return j.select("slice", F.when(why == "", "CONFIRM").otherwise("QUARANTINE").alias("verdict"), why.alias("discrepancies"))


def reconcile_total(slices: DataFrame, observed: DataFrame) -> DataFrame:
    """One row: REFUSE while a slice is quarantined or the suite is red."""
    q = slices.agg(F.count_if(F.col("verdict") == "QUARANTINE").alias("quarantined"))
    s = observed.agg(F.coalesce(F.sum("failed"), F.lit(0)).alias("suite_failed"), (F.count("*") == 0).alias("no_tests_ran"))
    bad = (F.col("quarantined") > 0) | (F.col("suite_failed") > 0) | F.col("no_tests_ran")
    return q.join(s).withColumn("verdict", F.when(bad, "REFUSE").otherwise("PROCEED"))


def attribute(slices: DataFrame, agents: DataFrame) -> DataFrame:
    """The agent whose text names a slice as a whole token; preferred agents win. A hint, not a record.

    Texts are cut into letter-digit runs, so naming is an equi-join on the
    slice's first run; only pairs that meet there take the text along again, for
    the full token test. ``agent`` is an id; rows that share one are read alike.
    """
    from tidemark.functions.text import mentions

    lead = F.regexp_extract(F.lower("slice"), "[0-9a-z]+", 0)
    s = slices.select("slice", lead.alias("run"))
    runs = agents.select(
        "agent", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[0-9a-z]+"), F.lit(0)))).alias("run")
    )
    pairs = runs.join(s, "run").select("agent", "slice").distinct()
    hit = pairs.join(agents, "agent").filter(mentions(F.col("text"), F.col("slice")))
    best = F.min(F.struct((~F.col("preferred")).alias("rest"), F.col("agent").alias("agent")))
    return hit.groupBy("slice").agg(best.alias("b")).select("slice", F.col("b.agent").alias("agent"), F.lit(True).alias("hint"))


def dangling_refs(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """Reference faults: (kind, ref_id). Self-declared unknowns are kept apart, never looked up.

    ``refs``: ref_id, line (null = whole target), unverified. ``targets``: ref_id, n_lines.
    """
    sure = refs.filter("not unverified")
    unknown = refs.filter("unverified").select(F.lit("unverified").alias("kind"), "ref_id")
    missing = sure.join(targets, "ref_id", "left_anti").select(F.lit("missing").alias("kind"), "ref_id")
    uncited = targets.join(refs.select("ref_id").distinct(), "ref_id", "left_anti").select(F.lit("uncited").alias("kind"), "ref_id")
    beyond = sure.join(targets, "ref_id").filter("line > n_lines").select(F.lit("missing_line").alias("kind"), "ref_id")
    return unknown.unionByName(missing).unionByName(uncited).unionByName(beyond)
