"""Transition ledgers: latest state, stage audits, legality and inventory quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import naming
from tidemark.operators.ordered import before, join_on, latest, numbered, previous, top_n

# Stages and states, exempt tools, age limits, sidecar files.
STAGES = ("first", "clean", "final", "last")
SCRATCH = {"first": "FIRST_SCRATCH", "clean": "CLEAN_SCRATCH", "final": "FINAL_SCRATCH", "last": "LAST_SCRATCH"}
DONE = {"first": "FIRST_DONE", "clean": "CLEAN_DONE", "final": "FINAL_DONE", "last": "END_REVIEW"}
#: Ops that leave the state as it is and fit everywhere after intake.
NEUTRAL = ("ANNOTATE", "REPLACE_SOURCE")


def legal_ops() -> tuple[tuple[str, str], ...]:
    """Which op may follow which: edits inside a stage, approval, the next stage's start, the final pass."""
    start = {s: "INTAKE" if s == "first" else f"START_{s.upper()}" for s in STAGES}
    edits = ("SAVE_WORKING", "SUBMIT", "REJECT")
    inside = [("SAVE_WORKING", "SAVE_WORKING"), ("SAVE_WORKING", "SUBMIT"), ("SUBMIT", "REJECT"), ("REJECT", "SAVE_WORKING"), ("REJECT", "SUBMIT")]
    enter = [(op, "SAVE_WORKING") for op in start.values()]
    leave = [("SUBMIT", f"APPROVE_{s.upper()}") for s in STAGES]
    onward = [(f"APPROVE_{a.upper()}", start[b]) for a, b in zip(STAGES, STAGES[1:])]
    end = [("APPROVE_LAST", "FINALIZE"), ("APPROVE_LAST", "REJECT")]
    assert {a for a, _ in inside} == set(edits)
    return tuple(inside + enter + leave + onward + end)


LEGAL = legal_ops()
EXEMPT_TOOLS = ("operator-select", "clean-scan", "manual", "qa")
STALE_LOCK_S = 3600.0
STALE_PART_S = 86400.0
SIDECARS = ("manifest.json", ".gitkeep")
EDITOR_EXTS = (".psd", ".kra", ".xcf", ".bak", ".autosave")
LABEL_RANK = {"needs_none": 3, "wrong_edit": 2, "engine_swap": 1, "other": 0}


def stage_audit(df: DataFrame, key: str, is_entry: Column, audit: Column) -> DataFrame:
    """Latest audit since the stage was opened, in file order; one row per key.

    The newest audit of all is the answer exactly when it came after the newest
    opening, so one aggregation suffices.
    """
    g = df.groupBy(key).agg(
        F.max(F.when(is_entry, F.col("seq"))).alias("_open"),
        F.max(F.when(audit.isNotNull(), F.col("seq"))).alias("_at"),
        F.max_by(audit, F.when(audit.isNotNull(), F.col("seq"))).alias("_audit"),
    )
    live = F.col("_open").isNull() | (F.col("_at") > F.col("_open"))
    return g.select(key, F.when(live, F.col("_audit")).alias("audit"))


def latest_gate(df: DataFrame, key: str, gate: str) -> DataFrame:
    """Newest audit of one gate; its value only when numeric."""
    mine = df.filter(F.col("gate") == gate)
    g = mine.groupBy(key).agg(F.max_by(F.struct("verdict", "value"), "seq").alias("a"))
    return g.select(key, "a.verdict", F.expr("try_cast(a.value as double)").alias("value"))


def evidence(df: DataFrame, key: str) -> DataFrame:
    """Status by the LAST record in file order; earlier refutations stay counted."""
    refuted = F.col("state") == "REFUTE"
    g = df.groupBy(key).agg(
        F.max_by(F.struct("state"), "seq").alias("l"), F.count_if(refuted).alias("_r"), F.count("*").alias("history")
    )
    state = F.col("l.state")
    status = F.when(state == "CONFIRM", "VERIFIED").when(state == "REFUTE", "REFUTED").otherwise("NOT OBSERVED")
    prior = F.col("_r") - F.when(state == "REFUTE", 1).otherwise(0)
    return g.select(key, status.alias("status"), prior.alias("prior_refutes"), "history")


def with_missing(found: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Keys without any record read as not observed, never as blank."""
    return wanted.select(key).distinct().join(found, key, "left").withColumns(
        {
            "status": F.coalesce("status", F.lit("NOT OBSERVED")),
            "prior_refutes": F.coalesce("prior_refutes", F.lit(0)),
            "history": F.coalesce("history", F.lit(0)),
        }
    )


def next_version(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg((F.coalesce(F.max("ver"), F.lit(0)) + 1).alias("next_ver"))


def collision_suffix(df: DataFrame, key: str, name: str, seq: str) -> DataFrame:
    """The first of equal names keeps it, later ones get -2, -3, ..."""
    n = numbered(df, [key, name], seq, "_n")
    return n.withColumn(
        "unique_name", F.when(F.col("_n") == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("-"), F.col("_n")))
    ).drop("_n")


def illegal_steps(df: DataFrame, key: str, legal=LEGAL, stages: bool = True) -> DataFrame:
    """Rows whose predecessor op is not allowed before them (a first row must be INTAKE).

    ``NEUTRAL`` ops are passed over: they are legal after any other op and hide none. An
    approval or a start must also belong to the stage that is open.
    """
    op = F.col("op")
    neutral = op.isin(*NEUTRAL)
    opened = F.when(op == "INTAKE", STAGES[0]).when(op.rlike("^START_"), F.lower(F.substring("op", 7, 20)))
    step = before(df, [key], "seq", last={"prev_op": F.when(~neutral, op), "_stage": opened})
    pair = F.concat_ws(">", "prev_op", "op")
    allowed = pair.isin(*[f"{a}>{b}" for a, b in legal])
    closing = F.when(op.rlike("^APPROVE_"), F.lower(F.substring("op", 9, 20)))
    # Ledgers that name no stage at all are judged by the order of ops alone.
    staged = closing.isNull() | F.col("_stage").isNull() | (F.col("_stage") == closing) | ~F.lit(stages)
    ok = F.when(F.col("prev_op").isNull(), op == "INTAKE").when(neutral, True).otherwise(allowed & staged)
    return step.filter(~F.coalesce(ok, F.lit(False))).drop("_stage")


def replayed_state(df: DataFrame, key: str) -> DataFrame:
    """The state each asset is in after its last op: one of the scratch, done and review states, or PASSED.

    The newest op that opens, closes or finishes a stage decides; a rejection in the
    final review opens the last stage again. Keys without any such op are PENDING_INTAKE.
    """
    op = F.col("op")
    state = F.when(op == "INTAKE", SCRATCH["first"]).when(op == "FINALIZE", "PASSED")
    for s in STAGES:
        state = state.when(op == f"START_{s.upper()}", SCRATCH[s]).when(op == f"APPROVE_{s.upper()}", DONE[s])
    reviewed = previous(df.filter(~op.isin(*NEUTRAL)), [key], "seq", {"_was": op})
    state = state.when((op == "REJECT") & (F.col("_was") == "APPROVE_LAST"), SCRATCH["last"])
    g = reviewed.withColumn("_state", state).groupBy(key).agg(F.max_by("_state", F.when(F.col("_state").isNotNull(), F.struct("ts", "seq"))).alias("state"))
    known = g.withColumn("state", F.coalesce("state", F.lit("PENDING_INTAKE")))
    return join_on(df.select(key).distinct(), known, [key], "left").withColumn("state", F.coalesce("state", F.lit("PENDING_INTAKE")))


def current_state(df: DataFrame, key: str) -> DataFrame:
    return latest(df, [key], ["ts", "seq"])


def drifted(files: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """Files whose hash differs from the latest recorded one; unknown keys are ignored."""
    want = latest(recorded.filter("sha_out is not null").select(*keys, "ts", "seq", "sha_out"), keys, ["ts", "seq"])
    return files.join(want.select(*keys, F.col("sha_out").alias("recorded")), keys).filter("recorded <> sha")


def dense_counts(states: DataFrame, dimension: DataFrame, produced: DataFrame) -> DataFrame:
    """Count per state, zeros kept; count-only states topped up, never counted twice."""
    tracked = states.groupBy("state").agg(F.count("*").alias("_t"))
    p = produced.select("state", F.col("n").alias("_p"))
    return (
        dimension.join(tracked, "state", "left").join(p, "state", "left")
        .select("state", F.greatest(F.coalesce("_t", F.lit(0)), F.coalesce("_p", F.lit(0))).alias("n"))
    )


def verdict_census(df: DataFrame, key: str) -> DataFrame:
    """Which attempt really won: approved content traced by hash to its lowest version."""
    op = F.col("op")
    base = df.groupBy(key).agg(
        F.count_distinct(F.when(op == "SAVE_WORKING", F.col("ver"))).alias("n_saved"),
        F.count_distinct(F.when(op == "REJECT", F.col("ver"))).alias("n_rejected"),
        F.max_by("sha_out", F.when((op == "APPROVE_CLEAN") & F.col("sha_out").isNotNull(), F.col("seq"))).alias("approved"),
        F.max_by("sha_out", F.when(op == "INTAKE", F.col("seq"))).alias("initial"),
    )
    first = df.filter("op = 'SAVE_WORKING'").groupBy(key, F.col("sha_out").alias("approved")).agg(F.min("ver").alias("origin"))
    return base.join(first, [key, "approved"], "left").withColumn(
        "is_initial", F.coalesce(F.col("approved") == F.col("initial"), F.lit(False))
    )


def census_totals(rows: DataFrame) -> DataFrame:
    multi = F.col("n_saved") >= 2
    decided = multi & F.col("approved").isNotNull()
    own = decided & ~F.col("is_initial")
    return rows.agg(
        F.count("*").alias("slugs"),
        F.count_if(multi).alias("multi"),
        F.count_if(decided).alias("decided"),
        F.count_if(own & (F.col("origin") == 1)).alias("settled_first"),
        F.count_if(own & (F.col("origin") > 1)).alias("settled_later"),
        F.count_if(decided & F.col("is_initial")).alias("settled_initial"),
        F.count_if(multi & F.col("approved").isNull()).alias("undecided"),
        F.sum("n_rejected").alias("rejected"),
    )


def label_census(df: DataFrame, key: str) -> DataFrame:
    """Strongest label per asset; an approved initial means nothing was needed."""
    rank = F.create_map(*[F.lit(x) for p in LABEL_RANK.items() for x in p])[F.col("label")]
    op = F.col("op")
    g = df.groupBy(key).agg(
        F.max_by("label", F.when(op == "REJECT", rank)).alias("_best"),
        F.max_by("sha_out", F.when(op == "APPROVE_CLEAN", F.col("seq"))).alias("_a"),
        F.max_by("sha_out", F.when(op == "INTAKE", F.col("seq"))).alias("_i"),
    )
    same = F.coalesce(F.col("_a") == F.col("_i"), F.lit(False))
    label = F.when(same, "needs_none").otherwise(F.coalesce("_best", F.lit("unlabelled")))
    return g.select(key, label.alias("label"), same.alias("approved_is_initial"))


def engines_used(df: DataFrame, key: str) -> DataFrame:
    """Distinct engines of an asset in order of first use; a second one is refused."""
    first = (
        df.filter((F.col("op") == "SAVE_WORKING") & F.col("tool").isNotNull() & ~F.col("tool").isin(*EXEMPT_TOOLS))
        .groupBy(key, "tool").agg(F.min("seq").alias("at"))
    )
    g = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "tool"))).alias("e"))
    return g.select(key, F.transform("e", lambda x: x["tool"]).alias("engines"), (F.size("e") > 1).alias("ladder_refused"))


def inventory_anomalies(files: DataFrame, now: float, lock_name: str = ".lock") -> DataFrame:
    """Quality findings of a folder tree: (slug, class, resumable, n).

    ``files``: slug, ord, kind (scratch | done), stage, name, is_dir, mtime. ``lock_name``
    is the file that marks a folder in use.
    """
    m = naming.parse_milestone(F.col("name"))
    age = F.lit(now) - F.col("mtime")
    ext = F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1))
    side = F.col("name").isin(*SIDECARS, lock_name)
    part = F.col("name").endswith(".part")
    plain = ~F.col("is_dir") & ~side & ~part
    loose = (F.col("kind") == "scratch") | ext.isin(*EDITOR_EXTS)
    # one parse per row: the generator keeps the struct from being spelled out again per use
    f = files.select("*", F.explode(F.array(m)).alias("m")).withColumn(
        "_mine", plain & F.col("m").isNotNull() & (F.col("m.slug") == F.col("slug"))
    )
    unparsed = F.col("is_dir") | (plain & ((F.col("m").isNull() & ~loose) | (F.col("m").isNotNull() & ~F.col("_mine"))))
    lock = ~F.col("is_dir") & (F.col("name") == lock_name) & (age > STALE_LOCK_S)
    stale_part = ~F.col("is_dir") & ~side & part & (age > STALE_PART_S)
    own = F.when(F.col("_mine"), F.struct("m.stage", "m.phase", "m.ver"))

    # files to keys, keys to folders, folders to assets: one scan, ever smaller shuffles
    per_key = f.groupBy("slug", "ord", "kind", "stage", own.alias("own")).agg(
        F.count_if("_mine").alias("n"), F.count_if(unparsed).alias("unparsed"), F.count_if(lock).alias("lock"),
        F.count_if(stale_part).alias("part"), F.bool_or(~side).alias("residue"),
    )

    def has(phase):
        hit = (F.col("own.stage") == F.col("stage")) & (F.col("own.phase") == phase)
        return F.coalesce(F.bool_or(hit), F.lit(False))

    folder = per_key.groupBy("slug", "ord", "kind", "stage").agg(
        has("done").alias("done"), has("needauth").alias("needauth"), has("initial").alias("initial"), F.bool_or(F.col("own").isNotNull()).alias("any"),
        F.bool_or("residue").alias("residue"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("dup"),
        *[F.sum(c).alias(c) for c in ("unparsed", "lock", "part")],
    )
    scratch = F.col("kind") == "scratch"
    quiet = scratch & ~F.col("done") & ~F.col("needauth")
    g = folder.groupBy("slug").agg(
        *[F.sum(c).alias(c) for c in ("unparsed", "lock", "part", "dup")],
        F.count_if(scratch & F.col("done")).alias("pending"), F.count_if(quiet & F.col("any") & ~F.col("initial")).alias("no_initial"),
        F.count_if(quiet & ~F.col("any") & F.col("residue")).alias("left"), F.count_if(quiet & ~F.col("any") & ~F.col("residue")).alias("empty"),
        F.count_if(scratch).alias("_s"), F.count_if(~scratch).alias("_d"),
    )
    rows = (
        ("UNPARSED_FILE", False, F.col("unparsed")), ("STALE_LOCK", True, F.col("lock")), ("STALE_PART", True, F.col("part")),
        ("DUPLICATE_KEY", False, F.col("dup")), ("APPROVED_PENDING_MOVE", True, F.col("pending")), ("MISSING_INITIAL", False, F.col("no_initial")),
        ("SCRATCH_RESIDUE", False, F.col("left")), ("SCRATCH_RESIDUE", True, F.col("empty")),
        ("SPLIT_STATE", False, F.when(F.col("_s") > 1, 1).otherwise(0)), ("STALE_DONE", True, F.greatest(F.col("_d") - 1, F.lit(0))),
    )
    found = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(r).alias("resumable"), n.cast("long").alias("n")) for c, r, n in rows])
    return g.select("slug", F.explode(found).alias("x")).select("slug", "x.*").filter("n > 0")


# ---- ordered analytics over a ledger ---------------------------------------


def delta_with_gaps(df: DataFrame, seq: str, value: str, keys: list[str] | None = None, block: int | None = None) -> DataFrame:
    """Difference to the row before, never across a row nobody measured."""
    kw = {"block": block} if block else {}
    v = F.col(value)
    p = before(
        df, keys or [], seq,
        last={"_row": F.struct(v.isNotNull().alias("seen"), v.alias("v")), "_known": v}, **kw,
    )
    linked = v.isNotNull() & F.coalesce(F.col("_row.seen"), F.lit(False))
    return p.withColumns(
        {
            "delta": F.when(linked, v - F.col("_row.v")),
            "broken_by_gap": v.isNotNull() & F.col("_known").isNotNull() & ~linked,
            "regression": F.coalesce(linked & (v < F.col("_row.v")), F.lit(False)),
        }
    ).drop("_row", "_known")


def segment_runs(df: DataFrame, keys: list[str], seq: str, cycle: str, run_id: str, block: int | None = None) -> DataFrame:
    """Run number inside each file: by run id when every row has one, else by a cycle that does not advance."""
    kw = {"block": block} if block else {}
    backed = df.groupBy(*keys).agg(F.bool_and(F.col(run_id).isNotNull()).alias("id_backed"))
    p = before(join_on(df, backed, keys), keys, seq, last={"_c": F.col(cycle), "_r": F.struct(F.col(run_id).alias("id"))}, **kw)
    by_id = F.col("_r").isNull() | (F.col("_r.id") != F.col(run_id))
    by_cycle = F.col("_c").isNull() | (F.col(cycle).isNotNull() & (F.col(cycle) <= F.col("_c")))
    fresh = F.when(F.col("id_backed"), by_id).otherwise(by_cycle).cast("long")
    s = before(p.withColumn("_new", fresh), keys, seq, sums={"_n": F.col("_new")}, **kw)
    return s.withColumn("run_index", F.col("_n") + F.col("_new")).drop("_c", "_r", "_new", "_n")


def pair_windows(df: DataFrame, keys: list[str], seq: str, opened: Column, closed: Column, at: str) -> DataFrame:
    """Open/close markers to intervals; a close pairs only with the marker right before it."""
    marks = df.withColumn("_m", F.when(opened, "o").when(closed, "c")).filter("_m is not null")
    p = previous(marks, keys, seq, {"_pm": F.col("_m"), "_pa": F.col(at)})
    return p.filter("_m = 'c' and _pm = 'o'").select(*keys, F.col("_pa").alias("s"), F.col(at).alias("e"))


def unpaired(df: DataFrame, keys: list[str], opened: Column, closed: Column) -> DataFrame:
    return df.groupBy(*keys).agg((F.count_if(opened) - F.count_if(closed)).alias("unpaired"))


def split_keep(df: DataFrame, key: str, seq: str, n: int) -> DataFrame:
    """Newest n rows kept, the rest archived; only the cut line is ranked."""
    kept = top_n(df.select(key, seq), [key], [F.col(seq).desc()], n)
    line = kept.groupBy(key).agg(F.min(seq).alias("_line"))
    return join_on(df, line, [key]).withColumn("bucket", F.when(F.col(seq) >= F.col("_line"), "keep").otherwise("archive")).drop("_line")


def attempt_decision(status: Column, attempts: Column, halt: Column, budget: int = 3) -> Column:
    """Next action; what is not understood waits."""
    return (
        F.when(halt, "halt")
        .when(status.isin("success", "not-evaluated"), "idle")
        .when(F.coalesce(status, F.lit("")) != "failure", "wait")
        .when(attempts >= budget, "give-up")
        .otherwise("fix")
    )


def clean_anchor(df: DataFrame, key: str, seq: str, clean: Column) -> DataFrame:
    """Base of each step: the last clean row before it, never younger than two steps back."""
    a = before(df, [key], seq, last={"_clean": F.when(clean, F.col(seq)), "_p1": F.col(seq)})
    b = before(a, [key], seq, last={"_p2s": F.struct(F.col("_p1").alias("p"))})
    floor = F.col("_p2s.p")
    base = F.coalesce(F.least("_clean", floor), F.col("_p1"))
    return b.withColumn("base", base).drop("_clean", "_p1", "_p2s")


def streaks(df: DataFrame, key: str, seq: str, value: str, limit: int = 2) -> DataFrame:
    """Length of the run of equal values ending at each row; 0 at its start."""
    a = before(df, [key], seq, last={"_pv": F.struct(F.col(value).alias("v"))}, sums={"_pos": F.lit(1).cast("long")})
    same = F.coalesce(F.col("_pv.v").eqNullSafe(F.col(value)) & F.col("_pv").isNotNull(), F.lit(False))
    a = a.withColumn("_same", same)
    b = before(a, [key], seq, last={"_start": F.when(~F.col("_same"), F.col("_pos"))})
    streak = F.when(F.col("_same"), F.col("_pos") - F.col("_start")).otherwise(F.lit(0))
    return b.withColumns({"streak": streak, "act": streak >= limit}).drop("_pv", "_pos", "_same", "_start")


def shuffled_cycle(ids: DataFrame, key: str, seed: str, cycle: int, digits: int = 4) -> DataFrame:
    """Each id once, in an order fixed by seed and cycle, with its position.

    Positions come from bucket counts: the hash prefix picks the bucket, a small
    window over buckets gives each its offset, ranks run inside buckets.
    """
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed), F.lit(str(cycle))).cast("binary"))
    d = ids.select(key, h.alias("h")).withColumn("b", F.substring("h", 1, digits))
    sizes = d.groupBy("b").agg(F.count("*").alias("c"))
    offsets = sizes.select(
        "b", F.coalesce(F.sum("c").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("o")
    )
    rank = F.row_number().over(Window.partitionBy("b").orderBy("h", key))
    return d.withColumn("r", rank).join(offsets, "b").select(key, (F.col("o") + F.col("r")).alias("pos"))


def seam_free(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Second cycle with its first two places swapped when it would repeat the last id of the first."""
    end = first.agg(F.max_by(key, "pos").alias("_last"), F.max("pos").alias("_n"))
    head = second.agg(F.max(F.when(F.col("pos") == 1, F.col(key))).alias("_head"))
    seam = end.join(head).select(((F.col("_last") == F.col("_head")) & (F.col("_n") > 1)).alias("_swap"))
    pos = F.when(F.col("_swap") & F.col("pos").isin(1, 2), 3 - F.col("pos")).otherwise(F.col("pos"))
    return second.join(seam).select(key, pos.alias("pos"))


def attribute_lines(docs: DataFrame, key: str, text: str, marker: str, reach: int = 5) -> DataFrame:
    """One row per bullet that a marker line belongs to, with the next-step line after the marker."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("i", "line")).withColumn("s", F.trim("line"))
    w = Window.partitionBy(key).orderBy("i")
    bullet = F.col("s").startswith("- **")
    ahead = w.rowsBetween(1, reach)
    is_next = F.col("s").startswith("Next:")
    stop = (F.col("s").startswith("-") | (F.col("s") == "")) & ~is_next
    seen = lines.withColumns(
        {
            "at": F.last(F.when(bullet, F.struct(F.col("i").alias("i"), F.col("s").alias("s"))), ignorenulls=True).over(
                w.rowsBetween(Window.unboundedPreceding, 0)
            ),
            "n_at": F.min(F.when(is_next, F.col("i"))).over(ahead),
            "n_text": F.first(F.when(is_next, F.trim(F.substring("s", 6, 1 << 30))), ignorenulls=True).over(ahead),
            "stop_at": F.min(F.when(stop, F.col("i"))).over(ahead),
        }
    )
    nxt = F.when(F.coalesce(F.col("n_at") < F.col("stop_at"), F.col("n_at").isNotNull()), F.col("n_text")).otherwise("")
    hits = seen.filter(F.contains("line", F.lit(marker)) & F.col("at").isNotNull()).withColumn("next", nxt)
    g = hits.groupBy(key, F.col("at.i").alias("line_no")).agg(F.min_by(F.struct("at.s", "next"), "i").alias("f"))
    title = F.regexp_replace(F.regexp_replace(F.col("f.s"), "^[- ]+", ""), r"^\*+|\*+$", "")
    return g.select(key, (F.col("line_no") + 1).alias("line_no"), title.alias("title"), "f.next")
