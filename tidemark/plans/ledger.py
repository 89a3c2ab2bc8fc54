"""Queries over the transition ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import gates as G
from tidemark.operators import ledger as L
from tidemark.operators import ordered
from tidemark.plans import views
from tidemark.plans.naming import NAMES_SQL, milestone_names
from tidemark.plans.registry import query

NOW = 1706745600  # the morning after the last event


def tr(t):
    return views.v_transitions(t)


def epoch(col="ts"):
    return F.floor(views.epoch_us(col) / 1_000_000)


@query(
    "w01_latest_record",
    """SELECT slug, seq, op, sha_out FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ts DESC, seq DESC) AS r FROM v_transitions) x WHERE r = 1""",
)
def w01(t):
    return ordered.latest(tr(t).select("slug", "ts", "seq", "op", "sha_out"), ["slug"], ["ts", "seq"]).drop("ts")


AUDIT = "CASE WHEN op IN ('SUBMIT', 'REJECT') THEN ['PASS', 'FLAG', 'FAIL'][ver % 3 + 1] END"


def _audit():
    v = F.element_at(F.array(F.lit("PASS"), F.lit("FLAG"), F.lit("FAIL")), F.col("ver") % 3 + 1)
    return F.when(F.col("op").isin("SUBMIT", "REJECT"), v)


@query(
    "w02_stage_audit",
    f"""WITH a AS (SELECT slug, seq, op, {AUDIT} AS v FROM v_transitions),
    o AS (SELECT slug, coalesce(max(seq) FILTER (op = 'INTAKE'), -1) AS opened FROM a GROUP BY slug),
    k AS (SELECT slug, v, row_number() OVER (PARTITION BY slug ORDER BY seq DESC) AS r FROM a JOIN o USING (slug) WHERE v IS NOT NULL AND seq > opened)
    SELECT o.slug, coalesce(k.v, 'none') AS verdict FROM o LEFT JOIN k ON o.slug = k.slug AND r = 1""",
)
def w02(t):
    out = L.stage_audit(tr(t), "slug", F.col("op") == "INTAKE", _audit())
    return out.select("slug", F.coalesce("audit", F.lit("none")).alias("verdict"))


@query(
    "w03_latest_gate",
    """WITH a AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY seq DESC) AS r FROM v_transitions WHERE op = 'SUBMIT')
    SELECT slug, ['PASS', 'FLAG', 'FAIL'][ver % 3 + 1] AS verdict, CASE WHEN ver % 7 <> 0 THEN value END AS halo FROM a WHERE r = 1""",
)
def w03(t):
    a = tr(t).select(
        "slug",
        "seq",
        F.when(F.col("op") == "SUBMIT", "G1").otherwise("vision-anat").alias("gate"),
        F.element_at(F.array(F.lit("PASS"), F.lit("FLAG"), F.lit("FAIL")), F.col("ver") % 3 + 1).alias("verdict"),
        F.when(F.col("ver") % 7 == 0, "ERR no value").otherwise(F.col("value").cast("string")).alias("value"),
    )
    return L.latest_gate(a, "slug", "G1").withColumnRenamed("value", "halo")


@query(
    "w04_evidence",
    """WITH v AS (SELECT slug, seq, CASE op WHEN 'APPROVE_CLEAN' THEN 'CONFIRM' WHEN 'REJECT' THEN 'REFUTE' WHEN 'SUBMIT' THEN 'odd' END AS s FROM v_transitions WHERE op IN ('APPROVE_CLEAN', 'REJECT', 'SUBMIT')),
    l AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY seq DESC) AS r FROM v),
    g AS (SELECT slug, max(s) FILTER (r = 1) AS last, count(*) FILTER (s = 'REFUTE' AND r > 1) AS prior, count(*) AS n FROM l GROUP BY slug)
    SELECT s.slug, CASE last WHEN 'CONFIRM' THEN 'VERIFIED' WHEN 'REFUTE' THEN 'REFUTED' ELSE 'NOT OBSERVED' END AS status, coalesce(prior, 0) AS prior_refutes, coalesce(n, 0) AS history
    FROM (SELECT DISTINCT slug FROM v_transitions UNION SELECT DISTINCT -slug - 1 FROM v_transitions) s LEFT JOIN g USING (slug)""",
)
def w04(t):
    state = F.when(F.col("op") == "APPROVE_CLEAN", "CONFIRM").when(F.col("op") == "REJECT", "REFUTE").when(F.col("op") == "SUBMIT", "odd")
    v = tr(t).withColumn("state", state).filter("state is not null")
    # each asset has a twin that nobody recorded
    wanted = tr(t).select("slug").union(tr(t).select((-F.col("slug") - 1).alias("slug")))
    return L.with_missing(L.evidence(v, "slug"), wanted, "slug")


@query(
    "w05_gap_delta",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 1000) AS BIGINT) END AS v FROM orders),
    l AS (SELECT *, lag(v) OVER (ORDER BY o_orderkey) AS p, count(v) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM o)
    SELECT o_orderkey, coalesce(v - p, -999999) AS delta, v IS NOT NULL AND known > 0 AND p IS NULL AS broken_by_gap, coalesce(v < p, false) AS regression FROM l""",
)
def w05(t):
    o = t("orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 1000)).alias("v"))
    d = L.delta_with_gaps(o, "o_orderkey", "v")
    return d.select("o_orderkey", F.coalesce("delta", F.lit(-999999)).cast("long").alias("delta"), "broken_by_gap", "regression")


@query(
    "w06_run_segments",
    """WITH e AS (SELECT slug, seq, CASE WHEN ver % 17 <> 0 THEN ver END AS c, CASE WHEN slug % 2 = 0 OR ver % 5 > 0 THEN seq // 500 END AS rid FROM v_transitions),
    b AS (SELECT *, bool_and(rid IS NOT NULL) OVER (PARTITION BY slug) AS backed, last_value(c IGNORE NULLS) OVER w AS pc, lag(rid) OVER (PARTITION BY slug ORDER BY seq) AS pr,
        row_number() OVER (PARTITION BY slug ORDER BY seq) AS rn FROM e WINDOW w AS (PARTITION BY slug ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    n AS (SELECT *, CASE WHEN backed THEN rn = 1 OR pr <> rid ELSE pc IS NULL OR coalesce(c <= pc, false) END AS fresh FROM b)
    SELECT slug, seq, backed AS id_backed, CAST(sum(fresh::INT) OVER (PARTITION BY slug ORDER BY seq) AS BIGINT) AS run_index FROM n""",
)
def w06(t):
    e = tr(t).select(
        "slug",
        "seq",
        F.when(F.col("ver") % 17 != 0, F.col("ver")).alias("c"),
        F.when((F.col("slug") % 2 == 0) | (F.col("ver") % 5 > 0), F.floor(F.col("seq") / 500)).alias("rid"),
    )
    return L.segment_runs(e, ["slug"], "seq", "c", "rid").select("slug", "seq", "id_backed", "run_index")


def locks(t):
    return tr(t).withColumn("at", epoch())


OPENED, CLOSED = "op = 'INTAKE'", "op = 'REJECT'"


@query(
    "w07_pair_windows",
    """WITH m AS (SELECT slug, seq, op, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "at" FROM v_transitions WHERE op IN ('INTAKE', 'REJECT')),
    l AS (SELECT *, lag(op) OVER w AS po, lag("at") OVER w AS pa FROM m WINDOW w AS (PARTITION BY slug ORDER BY seq))
    SELECT slug, pa AS s, "at" AS e FROM l WHERE op = 'REJECT' AND po = 'INTAKE'""",
)
def w07(t):
    return L.pair_windows(locks(t), ["slug"], "seq", F.expr(OPENED), F.expr(CLOSED), "at")


@query(
    "w07_unpaired",
    """SELECT slug, count(*) FILTER (op = 'INTAKE') - count(*) FILTER (op = 'REJECT') AS unpaired FROM v_transitions GROUP BY slug""",
)
def w07_unpaired(t):
    return L.unpaired(tr(t), ["slug"], F.expr(OPENED), F.expr(CLOSED))


@query(
    "w08_max_wait",
    """WITH m AS (SELECT slug, seq, op, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "at" FROM v_transitions WHERE op IN ('SUBMIT', 'SAVE_WORKING')),
    l AS (SELECT *, lag(op) OVER w AS po, lag("at") OVER w AS pa FROM m WINDOW w AS (PARTITION BY slug ORDER BY seq))
    SELECT slug, max("at" - pa) AS max_wait FROM l WHERE op = 'SAVE_WORKING' AND po = 'SUBMIT' GROUP BY slug""",
)
def w08(t):
    waits = L.pair_windows(locks(t), ["slug"], "seq", F.expr("op = 'SUBMIT'"), F.expr("op = 'SAVE_WORKING'"), "at")
    return waits.groupBy("slug").agg(F.max(F.col("e") - F.col("s")).alias("max_wait"))


def board(t):
    """Newest row per asset with its phase, error and age."""
    s = ordered.latest(tr(t).select("slug", "ts", "seq", "op", "ver"), ["slug"], ["ts", "seq"])
    phase = (
        F.when(F.col("op") == "SUBMIT", "_needauth").when(F.col("op") == "SAVE_WORKING", "_working")
        .when(F.col("op") == "APPROVE_CLEAN", "_done").otherwise("_initial")
    )
    return s.select(
        "slug", "seq", phase.alias("phase"), (F.col("ver") % 4 == 0).alias("error"), (F.col("slug") % 4).alias("stage"),
        epoch().alias("at"), (F.lit(NOW) - epoch()).alias("age_s"),
    )


BOARD_SQL = f"""SELECT slug, seq, CASE op WHEN 'SUBMIT' THEN '_needauth' WHEN 'SAVE_WORKING' THEN '_working' WHEN 'APPROVE_CLEAN' THEN '_done' ELSE '_initial' END AS phase,
      ver % 4 = 0 AS error, slug % 4 AS stage, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "at", {NOW} - CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS age_s
    FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ts DESC, seq DESC) AS r FROM v_transitions) x WHERE r = 1"""


@query(
    "w10_attention_lane",
    f"""SELECT slug, kind, age_s FROM (SELECT *, CASE WHEN phase = '_needauth' THEN 'needauth' WHEN error THEN 'error' WHEN phase = '_working' AND age_s > 900 THEN 'stuck' END AS kind FROM ({BOARD_SQL}) b) k WHERE kind IS NOT NULL""",
)
def w10(t):
    kind = (
        F.when(F.col("phase") == "_needauth", "needauth").when(F.col("error"), "error")
        .when((F.col("phase") == "_working") & (F.col("age_s") > 900), "stuck")
    )
    rank = F.array_position(F.array(F.lit("needauth"), F.lit("error"), F.lit("stuck")), F.col("kind"))
    lane = board(t).withColumn("kind", kind).filter("kind is not null")
    return lane.orderBy(rank, F.col("at").desc(), "slug").select("slug", "kind", "age_s")


@query(
    "w11_stage_board",
    f"""WITH b AS ({BOARD_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY stage, phase ORDER BY "at" DESC, slug) AS n, count(*) OVER (PARTITION BY stage) AS total FROM b)
    SELECT stage, slug, phase, total FROM r WHERE phase <> '_done' OR n <= 5""",
)
def w11(t):
    b = board(t)
    done = ordered.top_n(b.filter("phase = '_done'"), ["stage"], [F.col("at").desc(), F.col("slug")], 5).drop("rank")
    totals = b.groupBy("stage").agg(F.count("*").alias("total"))
    return b.filter("phase <> '_done'").unionByName(done).join(totals, "stage").select("stage", "slug", "phase", "total")


@query("w12_stuck", f"SELECT slug, age_s FROM ({BOARD_SQL}) b WHERE phase = '_working' AND age_s > 900")
def w12(t):
    return board(t).filter("phase = '_working' and age_s > 900").select("slug", "age_s")


@query("w13_next_version", "SELECT slug, coalesce(max(ver), 0) + 1 AS next_ver FROM v_transitions WHERE op = 'SAVE_WORKING' GROUP BY slug")
def w13(t):
    return L.next_version(tr(t).filter("op = 'SAVE_WORKING'"), "slug").withColumn("next_ver", F.col("next_ver").cast("long"))


@query(
    "w13_collision_suffix",
    """SELECT seq, CASE WHEN n = 1 THEN 'v' || ver ELSE 'v' || ver || '-' || n END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY slug, ver ORDER BY seq) AS n FROM v_transitions) x""",
)
def w13_suffix(t):
    d = tr(t).select("slug", "seq", F.concat(F.lit("v"), F.col("ver").cast("string")).alias("name"))
    return L.collision_suffix(d, "slug", "name", "seq").select("seq", "unique_name")


@query(
    "w14_keep_newest",
    """SELECT seq, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY seq DESC) <= 3 THEN 'keep' ELSE 'archive' END AS bucket FROM v_transitions""",
)
def w14(t):
    return L.split_keep(tr(t).select("slug", "seq"), "slug", "seq", 3).select("seq", "bucket")


@query(
    "w15_attempt_budget",
    """WITH l AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ts DESC, seq DESC) AS r FROM v_transitions),
    n AS (SELECT slug, sha_out, count(*) AS k FROM v_transitions WHERE op = 'REJECT' GROUP BY ALL)
    SELECT l.slug, coalesce(k, 0) AS attempts, CASE WHEN l.slug % 25 = 0 THEN 'halt' WHEN op = 'APPROVE_CLEAN' THEN 'idle' WHEN op <> 'REJECT' THEN 'wait' WHEN coalesce(k, 0) >= 3 THEN 'give-up' ELSE 'fix' END AS action
    FROM l LEFT JOIN n ON l.slug = n.slug AND l.sha_out = n.sha_out WHERE r = 1""",
)
def w15(t):
    now = ordered.latest(tr(t).select("slug", "ts", "seq", "op", "sha_out"), ["slug"], ["ts", "seq"])
    tries = tr(t).filter("op = 'REJECT'").groupBy("slug", "sha_out").agg(F.count("*").alias("k"))
    status = F.when(F.col("op") == "APPROVE_CLEAN", "success").when(F.col("op") == "REJECT", "failure").otherwise("pending")
    attempts = F.coalesce("k", F.lit(0))
    j = now.join(tries, ["slug", "sha_out"], "left")
    return j.select("slug", attempts.alias("attempts"), L.attempt_decision(status, attempts, F.col("slug") % 25 == 0).alias("action"))


@query(
    "w16_tail",
    "SELECT o_orderkey, o_orderstatus FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25) x",
)
def w16(t):
    last = t("orders").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(25)
    return last.orderBy("o_orderdate", "o_orderkey").select("o_orderkey", "o_orderstatus")


@query(
    "w17_top_spenders",
    """WITH a AS (SELECT slug % 10 AS session, slug AS agent, CAST(sum(ver) AS BIGINT) AS tokens FROM v_transitions GROUP BY ALL)
    SELECT session, agent, tokens, rank FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY tokens DESC, agent) AS rank FROM a) x WHERE rank <= 3""",
)
def w17(t):
    a = tr(t).groupBy((F.col("slug") % 10).alias("session"), F.col("slug").alias("agent")).agg(F.sum("ver").alias("tokens"))
    return ordered.top_n(a, ["session"], [F.col("tokens").desc(), F.col("agent")], 3)


LEGAL_SQL = "('INTAKE>SAVE_WORKING', 'SAVE_WORKING>SAVE_WORKING', 'SAVE_WORKING>SUBMIT', 'SUBMIT>REJECT', 'SUBMIT>APPROVE_CLEAN', 'REJECT>SAVE_WORKING', 'REJECT>SUBMIT')"


@query(
    "w18_legality",
    f"""WITH l AS (SELECT slug, seq, op, lag(op) OVER (PARTITION BY slug ORDER BY seq) AS p FROM v_transitions)
    SELECT slug, seq, coalesce(p, 'start') AS prev_op, op FROM l WHERE CASE WHEN p IS NULL THEN op <> 'INTAKE' ELSE p || '>' || op NOT IN {LEGAL_SQL} END""",
)
def w18(t):
    bad = L.illegal_steps(tr(t).select("slug", "seq", "op"), "slug", stages=False)
    return bad.select("slug", "seq", F.coalesce("prev_op", F.lit("start")).alias("prev_op"), "op")


@query(
    "w18_asset_state",
    """WITH e AS (SELECT slug, ts, seq, CASE op WHEN 'INTAKE' THEN 'FIRST_SCRATCH' WHEN 'APPROVE_CLEAN' THEN 'CLEAN_DONE' END AS state FROM v_transitions),
      l AS (SELECT slug, arg_max(state, (ts, seq)) FILTER (state IS NOT NULL) AS state FROM e GROUP BY slug)
    SELECT slug, coalesce(state, 'PENDING_INTAKE') AS state FROM l""",
)
def w18_asset(t):
    return L.replayed_state(tr(t).select("slug", "ts", "seq", "op"), "slug")


@query(
    "w18_replay_state",
    """SELECT slug, op AS state FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ts DESC, seq DESC) AS r FROM v_transitions) x WHERE r = 1""",
)
def w18_state(t):
    return L.current_state(tr(t).select("slug", "ts", "seq", "op"), "slug").select("slug", F.col("op").alias("state"))


@query(
    "w20_null_first_queue",
    f"""SELECT slug, CASE WHEN slug % 11 = 0 THEN NULL ELSE CAST(age_s AS DOUBLE) END AS age_s FROM ({BOARD_SQL}) b WHERE phase = '_needauth'""",
)
def w20(t):
    q = board(t).filter("phase = '_needauth'").select("slug", F.when(F.col("slug") % 11 != 0, F.col("age_s").cast("double")).alias("age_s"))
    return q.orderBy(F.col("age_s").isNotNull(), F.col("age_s").desc_nulls_first())


@query(
    "w21_cycle_order",
    """WITH a AS (SELECT p_partkey, row_number() OVER (ORDER BY md5(p_partkey || ':s:1'), p_partkey) AS p1, row_number() OVER (ORDER BY md5(p_partkey || ':s:2'), p_partkey) AS p2 FROM part),
    s AS (SELECT max(p_partkey) FILTER (p1 = (SELECT count(*) FROM part)) = max(p_partkey) FILTER (p2 = 1) AS swap FROM a)
    SELECT p_partkey, p1 AS first_pos, CASE WHEN swap AND p2 IN (1, 2) THEN 3 - p2 ELSE p2 END AS second_pos FROM a, s""",
)
def w21(t):
    ids = t("part").select("p_partkey")
    first = L.shuffled_cycle(ids, "p_partkey", "s", 1)
    second = L.seam_free(first, L.shuffled_cycle(ids, "p_partkey", "s", 2), "p_partkey")
    return first.withColumnRenamed("pos", "first_pos").join(second.withColumnRenamed("pos", "second_pos"), "p_partkey")


@query(
    "w22_clean_anchor",
    """WITH l AS (SELECT slug, seq, max(CASE WHEN op <> 'REJECT' THEN seq END) OVER (PARTITION BY slug ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c,
      lag(seq, 1) OVER w AS p1, lag(seq, 2) OVER w AS p2 FROM v_transitions WINDOW w AS (PARTITION BY slug ORDER BY seq))
    SELECT slug, seq, coalesce(CASE WHEN c IS NOT NULL AND p2 IS NOT NULL THEN least(c, p2) ELSE coalesce(c, p2) END, p1, -1) AS base FROM l""",
)
def w22(t):
    a = L.clean_anchor(tr(t).select("slug", "seq", "op"), "slug", "seq", F.col("op") != "REJECT")
    return a.select("slug", "seq", F.coalesce("base", F.lit(-1)).alias("base"))


@query(
    "w23_streaks",
    """WITH p AS (SELECT slug, seq, op, lag(op) OVER (PARTITION BY slug ORDER BY seq) AS po FROM v_transitions),
    g AS (SELECT *, sum(CASE WHEN op = po THEN 0 ELSE 1 END) OVER (PARTITION BY slug ORDER BY seq) AS island FROM p),
    s AS (SELECT slug, seq, row_number() OVER (PARTITION BY slug, island ORDER BY seq) - 1 AS streak FROM g)
    SELECT slug, seq, streak, streak >= 2 AS act FROM s""",
)
def w23(t):
    return L.streaks(tr(t).select("slug", "seq", "op"), "slug", "seq", "op").select("slug", "seq", "streak", "act")


@query(
    "w24_marker_bullets",
    r"""WITH d AS (SELECT doc_id, string_split(replace(regexp_replace(text, '\n([A-E])', chr(10) || '- **\1', 'g'), ' the ', ' OPEN ') || chr(10) || 'Next: step', chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, i, ls[i] AS line, trim(ls[i]) AS s FROM d, LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i) r),
    b AS (SELECT *, max(CASE WHEN starts_with(s, '- **') THEN i END) OVER (PARTITION BY doc_id ORDER BY i) AS "at" FROM l),
    f AS (SELECT doc_id, "at", min(i) AS i FROM b WHERE contains(line, 'OPEN') AND "at" IS NOT NULL GROUP BY ALL),
    n AS (SELECT f.doc_id, f."at", f.i, min(CASE WHEN starts_with(l.s, 'Next:') THEN l.i END) AS nx, min(CASE WHEN starts_with(l.s, '-') OR l.s = '' THEN l.i END) AS st
      FROM f LEFT JOIN l ON l.doc_id = f.doc_id AND l.i BETWEEN f.i + 1 AND f.i + 5 GROUP BY ALL)
    SELECT n.doc_id, "at" AS line_no, regexp_replace(regexp_replace(h.s, '^[- ]+', ''), '^\*+|\*+$', '', 'g') AS title,
      CASE WHEN nx IS NOT NULL AND (st IS NULL OR nx < st) THEN trim(substr(x.s, 6)) ELSE '' END AS next
    FROM n JOIN l h ON h.doc_id = n.doc_id AND h.i = "at" LEFT JOIN l x ON x.doc_id = n.doc_id AND x.i = nx""",
)
def w24(t):
    body = F.concat(F.replace(F.regexp_replace("text", "\n([A-E])", "\n- **$1"), F.lit(" the "), F.lit(" OPEN ")), F.lit("\nNext: step"))
    a = L.attribute_lines(t("documents").select("doc_id", body.alias("body")), "doc_id", "body", "OPEN")
    return a.withColumn("line_no", F.col("line_no").cast("long"))


@query(
    "p26_approval_record",
    f"""WITH a AS (SELECT slug, seq, op, {AUDIT} AS v FROM v_transitions),
    o AS (SELECT slug, coalesce(max(seq) FILTER (op = 'INTAKE'), -1) AS opened FROM a GROUP BY slug),
    k AS (SELECT slug, v, row_number() OVER (PARTITION BY slug ORDER BY seq DESC) AS r FROM a JOIN o USING (slug) WHERE v IS NOT NULL AND seq > opened),
    j AS (SELECT o.slug, v, CASE WHEN o.slug % 3 = 0 THEN 'operator' ELSE 'robot' END AS actor, CASE WHEN o.slug % 4 = 0 THEN ['anat_hand', 'lap'] WHEN o.slug % 4 = 1 THEN ['halo'] ELSE []::VARCHAR[] END AS reasons FROM o LEFT JOIN k ON o.slug = k.slug AND r = 1)
    SELECT slug, CASE WHEN v IS NULL THEN 'no_audit' WHEN v = 'PASS' AND len(reasons) = 0 THEN 'pass' ELSE 'override' END AS gate_check,
      v IS NOT NULL AND NOT (v = 'PASS' AND len(reasons) = 0) AS override, CASE WHEN v IS NOT NULL AND slug % 4 = 0 THEN 'anat_hand' ELSE '' END AS blocking,
      v IS NOT NULL AND actor <> 'operator' AND slug % 4 = 0 AS refused FROM j""",
)
def p26(t):
    a = L.stage_audit(tr(t), "slug", F.col("op") == "INTAKE", _audit())
    reasons = (
        F.when(F.col("slug") % 4 == 0, F.array(F.lit("anat_hand"), F.lit("lap")))
        .when(F.col("slug") % 4 == 1, F.array(F.lit("halo")))
        .otherwise(F.array().cast("array<string>"))
    )
    actor = F.when(F.col("slug") % 3 == 0, "operator").otherwise("robot")
    return a.select("slug", G.approval(F.col("audit"), reasons, actor).alias("r")).select("slug", "r.*")


@query(
    "j03_hash_drift",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY slug, op ORDER BY ts DESC, seq DESC) AS n FROM v_transitions),
    f AS (SELECT slug, op, sha_out AS sha FROM (SELECT *, row_number() OVER (PARTITION BY slug, op ORDER BY seq) AS n FROM v_transitions) x WHERE n = 1)
    SELECT f.slug, f.op, f.sha, r.sha_out AS recorded FROM f JOIN r ON f.slug = r.slug AND f.op = r.op AND n = 1 WHERE f.sha <> r.sha_out""",
)
def j03(t):
    files = tr(t).groupBy("slug", "op").agg(F.min_by("sha_out", "seq").alias("sha"))
    unknown = files.withColumn("op", F.lit("NEVER_RECORDED"))
    return L.drifted(files.unionByName(unknown), tr(t), ["slug", "op"])


@query(
    "a01_state_counts",
    """WITH s AS (SELECT op AS state FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ts DESC, seq DESC) AS r FROM v_transitions) x WHERE r = 1),
    d AS (SELECT unnest(['INTAKE', 'SAVE_WORKING', 'SUBMIT', 'REJECT', 'APPROVE_CLEAN', 'GC_DONE']) AS state),
    p AS (SELECT op AS state, count(*) AS n FROM v_transitions WHERE ver = 0 GROUP BY op)
    SELECT d.state, greatest((SELECT count(*) FROM s WHERE s.state = d.state), coalesce(n, 0)) AS n FROM d LEFT JOIN p USING (state)""",
)
def a01(t):
    states = L.current_state(tr(t).select("slug", "ts", "seq", "op"), "slug").select(F.col("op").alias("state"))
    ops = [*views.OPS.values(), "GC_DONE"]
    dim = t.spark.range(1).select(F.explode(F.array(*[F.lit(o) for o in ops])).alias("state"))
    produced = tr(t).filter("ver = 0").groupBy(F.col("op").alias("state")).agg(F.count("*").alias("n"))
    return L.dense_counts(states, dim, produced)


CENSUS_SQL = """b AS (SELECT slug, count(DISTINCT ver) FILTER (op = 'SAVE_WORKING') AS saved, count(DISTINCT ver) FILTER (op = 'REJECT') AS rejected,
      arg_max(sha_out, seq) FILTER (op = 'APPROVE_CLEAN') AS approved, arg_max(sha_out, seq) FILTER (op = 'INTAKE') AS initial FROM v_transitions GROUP BY slug),
    f AS (SELECT slug, sha_out AS approved, min(ver) AS origin FROM v_transitions WHERE op = 'SAVE_WORKING' GROUP BY ALL),
    c AS (SELECT b.*, origin, coalesce(b.approved = initial, false) AS is_initial FROM b LEFT JOIN f ON b.slug = f.slug AND b.approved = f.approved)"""


@query(
    "a07_verdict_census",
    f"""WITH {CENSUS_SQL} SELECT count(*) AS slugs, count(*) FILTER (saved >= 2) AS multi, count(*) FILTER (saved >= 2 AND approved IS NOT NULL) AS decided,
      count(*) FILTER (saved >= 2 AND approved IS NOT NULL AND NOT is_initial AND origin = 1) AS settled_first, count(*) FILTER (saved >= 2 AND approved IS NOT NULL AND NOT is_initial AND origin > 1) AS settled_later,
      count(*) FILTER (saved >= 2 AND approved IS NOT NULL AND is_initial) AS settled_initial, count(*) FILTER (saved >= 2 AND approved IS NULL) AS undecided, CAST(sum(rejected) AS BIGINT) AS rejected FROM c""",
)
def a07(t):
    return L.census_totals(L.verdict_census(tr(t), "slug"))


@query(
    "a08_label_census",
    """WITH l AS (SELECT *, CASE WHEN op = 'REJECT' THEN [0, 1, 2, 0, 1, 0, 3][ver % 7 + 1] END AS rk FROM v_transitions),
    g AS (SELECT slug, max(rk) AS rk, coalesce(arg_max(sha_out, seq) FILTER (op = 'APPROVE_CLEAN') = arg_max(sha_out, seq) FILTER (op = 'INTAKE'), false) AS same FROM l GROUP BY slug)
    SELECT slug, CASE WHEN same THEN 'needs_none' WHEN rk IS NULL THEN 'unlabelled' ELSE ['other', 'engine_swap', 'wrong_edit', 'needs_none'][rk + 1] END AS label, same AS approved_is_initial FROM g""",
)
def a08(t):
    names = ("other", "engine_swap", "wrong_edit", "other", "engine_swap", "other", "needs_none")
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("ver") % 7 + 1)
    return L.label_census(tr(t).withColumn("label", label), "slug")


@query(
    "a28_engines_used",
    """WITH e AS (SELECT slug, seq, ['lama', 'manual', 'sdxl', NULL, 'qa', 'dekel'][ver % 6 + 1] AS tool FROM v_transitions WHERE op = 'SAVE_WORKING'),
    f AS (SELECT slug, tool, min(seq) AS "at" FROM e WHERE tool IS NOT NULL AND tool NOT IN ('operator-select', 'clean-scan', 'manual', 'qa') GROUP BY ALL)
    SELECT slug, string_agg(tool, '>' ORDER BY "at") AS engines, count(*) > 1 AS ladder_refused FROM f GROUP BY slug""",
)
def a28(t):
    tools = F.array(*[F.lit(n) for n in ("lama", "manual", "sdxl", None, "qa", "dekel")])
    e = tr(t).withColumn("tool", F.element_at(tools, F.col("ver") % 6 + 1))
    return L.engines_used(e, "slug").select("slug", F.array_join("engines", ">").alias("engines"), "ladder_refused")


@query(
    "a29_fingerprint",
    """SELECT p_partkey, sha256('{"brand":"' || p_brand || '","key":"' || p_partkey || '","name":"' || p_name || '"}') AS pipeline_version FROM part""",
)
def a29(t):
    from tidemark.sources.golden import fingerprint

    pinned = F.create_map(F.lit("name"), F.col("p_name"), F.lit("key"), F.col("p_partkey").cast("string"), F.lit("brand"), F.col("p_brand"))
    return t("part").select("p_partkey", fingerprint(pinned).alias("pipeline_version"))


INVENTORY_SQL = rf"""i AS (SELECT 's' || slug AS slug, CASE WHEN e.seq % 10 < 5 THEN 2 * (slug % 4) + 1 ELSE 2 * (slug % 4) + 2 END + CASE WHEN e.seq % 97 = 0 AND slug % 4 < 3 THEN 2 ELSE 0 END AS ord, e.seq,
      CASE WHEN ver = 50 THEN '.lock' WHEN ver = 51 THEN 'x.part' WHEN ver = 52 THEN 'notes.psd' WHEN ver = 53 THEN 'readme.txt' WHEN ver = 54 THEN 'manifest.json' ELSE n.name END AS name,
      ver = 55 AS is_dir, CAST(floor(epoch_us(ts) / 1000000) AS DOUBLE) AS mtime FROM v_transitions e JOIN ({NAMES_SQL}) n USING (seq)),
    f AS (SELECT *, CASE WHEN ord % 2 = 1 THEN 'scratch' ELSE 'done' END AS kind, ['first', 'clean', 'final', 'last'][(ord - 1) // 2 + 1] AS stage,
      name IN ('manifest.json', '.lock', '.gitkeep') AS side, name LIKE '%.part' AS part, regexp_matches(name, '^[a-z0-9][a-z0-9-]*_(first|clean|final|last)(initial|needauth|done|working_[0-9][0-9]+)\.(png|jpg|webp|jpeg|JPG)$') AS ok FROM i),
    p AS (SELECT *, NOT is_dir AND NOT side AND NOT part AND ok AND regexp_extract(name, '^([^_]*)_', 1) = slug AS mine, regexp_extract(name, '_(first|clean|final|last)', 1) AS ms,
      CASE WHEN name LIKE '%working%' THEN 'working' ELSE regexp_extract(name, '(initial|needauth|done)', 1) END AS ph, regexp_extract(name, 'working_([0-9]+)', 1) AS mv FROM f),
    d AS (SELECT slug, ord, kind, bool_or(mine AND ms = stage AND ph = 'done') AS done, bool_or(mine AND ms = stage AND ph = 'needauth') AS na, bool_or(mine AND ms = stage AND ph = 'initial') AS ini, bool_or(mine) AS anym, bool_or(NOT side) AS res FROM p GROUP BY ALL),
    s AS (SELECT slug, count(*) FILTER (kind = 'scratch') AS sc, count(*) FILTER (kind = 'done') AS dn FROM d GROUP BY slug),
    u AS (SELECT slug, 'UNPARSED_FILE' AS class, false AS resumable, 1 AS n FROM p WHERE is_dir OR (NOT side AND NOT part AND ((NOT ok AND kind = 'done' AND name NOT LIKE '%.psd') OR (ok AND NOT mine)))
      UNION ALL SELECT slug, 'STALE_LOCK', true, 1 FROM p WHERE NOT is_dir AND name = '.lock' AND 1706745600 - mtime > 3600
      UNION ALL SELECT slug, 'STALE_PART', true, 1 FROM p WHERE NOT is_dir AND part AND 1706745600 - mtime > 86400
      UNION ALL SELECT slug, 'DUPLICATE_KEY', false, count(*) - 1 FROM p WHERE mine GROUP BY slug, ord, ms, ph, mv HAVING count(*) > 1
      UNION ALL SELECT slug, CASE WHEN done THEN 'APPROVED_PENDING_MOVE' WHEN anym THEN 'MISSING_INITIAL' ELSE 'SCRATCH_RESIDUE' END, done OR (NOT anym AND NOT res), 1 FROM d WHERE kind = 'scratch' AND (done OR (NOT na AND ((anym AND NOT ini) OR NOT anym)))
      UNION ALL SELECT slug, 'SPLIT_STATE', false, 1 FROM s WHERE sc > 1 UNION ALL SELECT slug, 'STALE_DONE', true, dn - 1 FROM s WHERE dn > 1)"""


@query("a30_inventory_anomalies", f"WITH {INVENTORY_SQL} SELECT slug, class, resumable, CAST(sum(n) AS BIGINT) AS n FROM u GROUP BY ALL")
def a30(t):
    m = milestone_names(t)
    four = (F.col("slug") % 4).cast("int")
    ord_ = 2 * four + F.when(F.col("seq") % 10 < 5, 1).otherwise(2) + F.when((F.col("seq") % 97 == 0) & (four < 3), 2).otherwise(0)
    name = (
        F.when(F.col("ver") == 50, ".lock").when(F.col("ver") == 51, "x.part").when(F.col("ver") == 52, "notes.psd")
        .when(F.col("ver") == 53, "readme.txt").when(F.col("ver") == 54, "manifest.json").otherwise(F.col("name"))
    )
    files = m.select(
        F.concat(F.lit("s"), F.col("slug").cast("string")).alias("slug"),
        ord_.alias("ord"),
        name.alias("name"),
        (F.col("ver") == 55).alias("is_dir"),
        epoch().cast("double").alias("mtime"),
    ).withColumns(
        {
            "kind": F.when(F.col("ord") % 2 == 1, "scratch").otherwise("done"),
            "stage": F.element_at(F.array(*[F.lit(s) for s in ("first", "clean", "final", "last")]), F.floor((F.col("ord") - 1) / 2).cast("int") + 1),
        }
    )
    return L.inventory_anomalies(files, float(NOW))
