"""Run analytics: claims against evidence, trajectories, identities, overlaps, mirrors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators.ordered import before, join_on

# Patterns that mark a claim, a report of failure, a hedge, a waiver and a run.
GREEN = r"(?i)(tests?\s+(all\s+)?pass(es|ed|ing)?|(full\s+)?suite\s+(is\s+)?(green|passes|passing)|\d+\s+passed|all\s+green|ci\s+(is\s+)?green|green\s+on\s+[0-9a-f]{7,})"
RED = r"(?i)(\b\d+\s+failed\b|\bfailures?\b|failing[-\s]first|\bRED\b)"
HEDGED = r"(?i)(do(es)?\s*n[o']?t\s+trust|don'?t\s+trust|not\s+(yet\s+)?verified|verification\s+discipline|awaiting\s+verification|verifying\s+now|(claims?|reports?|says)\s+(green|\d+\s+passed))"
WAIVER = r"(?i)(skip|don'?t\s+run|no\s+need\s+to\s+run|without\s+running)\s+(the\s+)?(tests?|suite)"
RUN = r"(?i)(^|[\s;&|])(py\.?test|python\s+-m\s+pytest)\b"
FAILED = r"(?i)\b\d+\s+failed\b"
PASSED = r"(?i)\b\d+\s+(passed|deselected)\b"
INTERRUPTED = (124, 137, 143)


@dataclass(frozen=True)
class Patterns:
    green: str = GREEN
    red: str = RED
    hedged: str = HEDGED
    waiver: str = WAIVER
    run: str = RUN
    failed: str = FAILED
    passed: str = PASSED


def run_verdict(output: Column, code: Column, interrupted: Column, p: Patterns = Patterns()) -> Column:
    """pass, fail, unknown or no-evidence; the count line outranks the exit code."""
    return (
        F.when(interrupted | code.isin(*INTERRUPTED), "unknown")
        .when(output.rlike(p.failed), "fail")
        .when(output.rlike(p.passed), "pass")
        .when(code.isNotNull(), F.when(code == 0, "pass").otherwise("fail"))
        .otherwise("no-evidence")
    )


def pair_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Each call with the result that answers its id; the entry payload beats the part's, the last result wins."""
    answer = results.groupBy("id").agg(
        F.max_by(F.struct(F.coalesce("entry_payload", "part_payload").alias("payload")), "seq").alias("r")
    )
    return calls.join(answer, "id", "left").select(
        *calls.columns, F.col("r").isNotNull().alias("paired"), F.col("r.payload").alias("payload")
    )


def audit_claims(entries: DataFrame, p: Patterns = Patterns()) -> DataFrame:
    """Every unhedged claim judged only by the runs before it.

    ``entries``: transcript, seq, is_claim (may claim), command, output, code,
    interrupted, user_text, text.
    """
    ran = F.col("command").rlike(p.run)
    verdict = F.when(ran, run_verdict(F.coalesce("output", F.lit("")), F.col("code"), F.coalesce("interrupted", F.lit(False)), p))
    waived = entries.groupBy("transcript").agg(F.coalesce(F.bool_or(F.col("user_text").rlike(p.waiver)), F.lit(False)).alias("waived"))
    e = before(
        entries, ["transcript"], "seq",
        last={"_last": F.when(verdict.isin("pass", "fail"), verdict)}, sums={"runs_before": F.when(ran, 1).otherwise(0).cast("long")},
    )
    text = F.col("text")
    claims = e.filter(F.col("is_claim") & text.rlike(p.green) & ~text.rlike(p.red) & ~text.rlike(p.hedged))
    claims = join_on(claims, waived, ["transcript"])
    found = (
        F.when(F.col("waived"), "waived")
        .when(F.col("runs_before") == 0, "claim-no-run")
        .when(F.col("_last") == "fail", "claim-vs-fail")
        .when(F.col("_last").isNull(), "no-counts")
        .otherwise("ok")
    )
    return claims.select("transcript", "seq", "runs_before", found.alias("detector"))


def claim_rate(audited: DataFrame, transcripts: DataFrame) -> DataFrame:
    """How often, with its denominator."""
    d = F.col("detector")
    a = audited.agg(
        F.count("*").alias("claims"),
        F.count_if(d == "waived").alias("waived"),
        F.count_if(~d.isin("waived", "ok")).alias("findings"),
        *[F.count_if(d == x).alias(x.replace("-", "_")) for x in ("claim-no-run", "claim-vs-fail", "no-counts")],
    )
    return transcripts.agg(F.count_distinct("transcript").alias("transcripts")).join(a)


def hook_bypasses(entries: DataFrame, key: str) -> DataFrame:
    """Commits with hooks off after a hook had rejected one, by the rules for commands and their output.

    ``entries``: key, seq, command, output; either may be null.
    """
    return bypass_after_reject(entries, key, X.commit_bypass(F.col("command")), X.hook_rejected(F.col("output")))


def bypass_after_reject(df: DataFrame, key: str, bypass: Column, rejected: Column) -> DataFrame:
    """Bypass actions with any earlier rejection that did not provably succeed."""
    first = df.groupBy(key).agg(F.min(F.when(rejected, F.col("seq"))).alias("_first"))
    return df.filter(bypass).join(first, key).filter("seq > _first").drop("_first")


def suite_trajectory(commits: DataFrame, observations: DataFrame) -> DataFrame:
    """Newest observation per commit, joined on abbreviations of the same hash.

    ``commits``: sha. ``observations``: sha, passed, at (null loses to a stamp).
    """
    rank = F.struct(F.col("at").isNotNull().alias("s"), "at", "passed")
    o = observations.groupBy(F.lower(F.trim("sha")).alias("osha")).agg(F.max(rank).alias("best"), F.count("*").alias("n")).filter("length(osha) >= 6")
    c = commits.select(F.lower(F.trim("sha")).alias("csha")).distinct().filter("length(csha) >= 6")
    # An abbreviation is spelled out on the longer side, at lengths the other side has, so that all matches are equalities.
    used = lambda rows, s: rows.agg(F.collect_set(F.length(s)).alias("_lengths"))  # noqa: E731 - one row
    heads = lambda s, longest: F.explode(F.transform(F.filter("_lengths", lambda n: n <= longest), lambda n: F.left(F.col(s), n))).alias("head")
    shorter = c.join(used(o, "osha")).select("csha", heads("csha", F.length("csha"))).join(o, F.col("head") == F.col("osha"))
    longer = o.join(used(c, "csha")).select("best", "n", heads("osha", F.length("osha") - 1)).join(c, F.col("head") == F.col("csha"))
    hits = shorter.select("csha", "best", "n").union(longer.select("csha", "best", "n"))
    told = hits.groupBy("csha").agg(F.max("best").alias("b"), F.sum("n").alias("observation_count"))
    j = commits.join(told, F.lower(F.trim("sha")) == F.col("csha"), "left")
    return j.select(*commits.columns, F.col("b.passed").alias("passed"), F.coalesce("observation_count", F.lit(0)).alias("observation_count"))


def run_identity(cycles: DataFrame) -> DataFrame:
    """One row per run that names itself; more than one partner id is ambiguous."""
    return cycles.filter("run_id is not null").groupBy("run_id").agg(
        F.count("*").alias("cycle_count"),
        F.count_distinct("manifest_run_id").alias("n_manifests"),
        F.count_distinct("session_id").alias("n_sessions"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    ).withColumn("ambiguous", F.col("n_manifests") > 1)


def runs_by(cycles: DataFrame, other: str) -> DataFrame:
    """Every run that a record names together with an id of another namespace: ``other, run_id, cycle_count, first_ts``.

    One row a pair, not a list per id, so an id that a third of all runs share is no one task's work.
    """
    named = cycles.filter(F.col("run_id").isNotNull() & F.col(other).isNotNull())
    return named.groupBy(other, "run_id").agg(F.count("*").alias("cycle_count"), F.min("ts").alias("first_ts"))


def join_summary(cycles: DataFrame) -> DataFrame:
    """One row: runs that name themselves, those with several partner ids, and cycles that name no run and are joined to none."""
    runs = run_identity(cycles).agg(F.count("*").alias("joined_runs"), F.count_if("ambiguous").alias("ambiguous_runs"))
    return runs.join(cycles.agg(F.count_if(F.col("run_id").isNull()).alias("unjoined_cycles")))


def resolve_identity(cycles: DataFrame, callers: DataFrame) -> DataFrame:
    """Callers' id pairs checked against recorded pairs: joined, conflict or unknown; nothing is guessed."""
    pairs = cycles.filter("run_id is not null and manifest_run_id is not null").select("run_id", "manifest_run_id").distinct()
    run = pairs.select("run_id").distinct().withColumn("_run", F.lit(True))
    man = pairs.select("manifest_run_id").distinct().withColumn("_man", F.lit(True))
    both = pairs.withColumn("_both", F.lit(True))
    j = callers.join(run, "run_id", "left").join(man, "manifest_run_id", "left").join(both, ["run_id", "manifest_run_id"], "left")
    known = F.col("_run").isNotNull() | F.col("_man").isNotNull()
    status = F.when(F.col("_both").isNotNull(), "joined").when(known, "conflict").otherwise("unknown")
    return j.withColumn("status", status).drop("_run", "_man", "_both")


def overlap_summary(a: DataFrame, b: DataFrame, block: int = 1 << 20) -> DataFrame:
    """Per interval of ``a``: how many of ``b`` it truly overlaps, and for how long in all.

    Counts and lengths follow from running totals of b's ends over time, so no
    interval pair is ever built. Inputs: id, s, e in whole seconds.
    """
    big = "decimal(38,0)"
    zero = F.lit(0).cast(big)
    starts = b.select(F.col("s").alias("t"), F.lit(1).cast(big).alias("cs"), F.col("s").cast(big).alias("ss"), zero.alias("ce"), zero.alias("se"))
    ends = b.select(F.col("e").alias("t"), zero.alias("cs"), zero.alias("ss"), F.lit(1).cast(big).alias("ce"), F.col("e").cast(big).alias("se"))
    marks = a.select(F.explode(F.array("s", "e")).alias("t"), *[zero.alias(c) for c in ("cs", "ss", "ce", "se")])
    sums = [F.sum(c).cast(big).alias(c) for c in ("cs", "ss", "ce", "se")]
    pts = starts.unionByName(ends).unionByName(marks).groupBy("t").agg(*sums)
    run = before(pts, [], "t", sums={f"b_{c}": F.col(c) for c in ("cs", "ss", "ce", "se")}, block=block)
    area = F.col("t").cast(big) * (F.col("b_cs") - F.col("b_ce")) - (F.col("b_ss") - F.col("b_se"))
    at = run.select("t", F.col("b_cs").alias("begun"), (F.col("b_ce") + F.col("ce")).alias("over"), area.alias("area"))
    left = at.select(F.col("t").alias("s"), F.col("over").alias("_over"), F.col("area").alias("_a0"))
    right = at.select(F.col("t").alias("e"), F.col("begun").alias("_begun"), F.col("area").alias("_a1"))
    return a.join(left, "s").join(right, "e").select(
        "id", (F.col("_begun") - F.col("_over")).cast("long").alias("n_overlaps"), (F.col("_a1") - F.col("_a0")).cast("long").alias("overlap_s")
    )


def occupancy(intervals: DataFrame, owner: str | None = None, block: int = 1 << 20) -> DataFrame:
    """Number of open intervals after each moment something changed; with ``owner`` also how many owners hold one.

    Owners are folded in two levels: an owner's own intervals first become its steps from
    holding none to holding some and back, then the steps of all owners are added up. A null
    or empty owner holds its slots, but is nobody.
    """
    ends = F.array(F.struct(F.col("s").alias("t"), F.lit(1).alias("d")), F.struct(F.col("e").alias("t"), F.lit(-1).alias("d")))
    ev = intervals.select(*([owner] if owner else []), F.explode(ends).alias("x"))
    if owner is None:
        pts = ev.groupBy(F.col("x.t").alias("t")).agg(F.sum("x.d").alias("d"), F.lit(0).alias("step"))
    else:
        own = before(ev.groupBy(owner, F.col("x.t").alias("t")).agg(F.sum("x.d").alias("d")), [owner], "t", sums={"held": F.col("d")}, block=block)
        step = (F.col("held") + F.col("d") > 0).cast("int") - (F.col("held") > 0).cast("int")
        somebody = F.coalesce(F.col(owner).cast("string") != "", F.lit(False))
        pts = own.groupBy("t").agg(F.sum("d").alias("d"), F.sum(F.when(somebody, step).otherwise(0)).alias("step"))
    out = before(pts, [], "t", sums={"n": F.col("d"), "owners": F.col("step")}, block=block)
    return out.select("t", (F.col("n") + F.col("d")).alias("n"), *([(F.col("owners") + F.col("step")).alias("owners")] if owner else []))


def peak_concurrency(intervals: DataFrame, owner: str | None = None) -> DataFrame:
    """Peak number of open intervals over the moments at which something changed.

    With ``owner``: also the moments at which several owners hold one (``shared``) and the most owners at once.
    """
    more = [F.count_if(F.col("owners") > 1).alias("shared"), F.max("owners").alias("most_owners")] if owner else []
    return occupancy(intervals, owner).agg(F.max("n").alias("peak"), F.count("*").alias("samples"), *more)


def merge_monotone(old: DataFrame, new: DataFrame, key: str, static: list[str]) -> DataFrame:
    """Mirror upsert: counters only grow, the window only widens, nothing is removed."""
    o = old.select(F.col(key), *[F.col(c).alias(f"o_{c}") for c in old.columns if c != key])
    n = new.select(F.col(key), *[F.col(c).alias(f"n_{c}") for c in new.columns if c != key])
    j = o.join(n, key, "full_outer")
    return j.select(
        key,
        *[F.coalesce(f"n_{c}", f"o_{c}").alias(c) for c in static],
        *[F.greatest(f"o_{c}", f"n_{c}").alias(c) for c in ("events", "output_tokens", "last_event")],
        F.least("o_start", "n_start").alias("start"),
        F.coalesce("o_first_seen", "n_first_seen").alias("first_seen"),
    )


def fleet_history(agents: DataFrame) -> DataFrame:
    """Sessions with spend and span; a session without stamps has no span, and one without live sources is mirror-only."""
    g = agents.groupBy("session").agg(
        F.count("*").alias("agent_count"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("events").alias("events"),
        F.min("start").alias("first_start"),
        F.max("last_event").alias("last_event"),
        F.count_if("on_disk").alias("agents_on_disk"),
    )
    span = F.greatest(F.lit(0), F.col("last_event") - F.col("first_start"))
    known = F.col("first_start").isNotNull() & F.col("last_event").isNotNull()
    return g.withColumns({"span_s": F.when(known, span), "mirror_only": F.col("agents_on_disk") == 0})
