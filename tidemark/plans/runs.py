"""Transcript, run and spend queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.pricing import token_price
from tidemark.operators import runs as R
from tidemark.plans import views
from tidemark.plans.ledger import BOARD_SQL, board
from tidemark.plans.registry import query

PATTERNS = R.Patterns(green="ing|la ", red="qui", hedged="ß", waiver="xz|thththth", run="en", failed="er ", passed="on ")


@query(
    "j08_result_pairing",
    """WITH c AS (SELECT transcript, seq, transcript || ':' || seq AS id FROM v_entries WHERE role = 'user'),
    r AS (SELECT transcript || ':' || (seq - 1) AS id, CASE WHEN seq % 3 = 0 THEN length(text) ELSE length(role) END AS payload FROM v_entries WHERE role = 'assistant')
    SELECT transcript, seq, r.id IS NOT NULL AS paired, coalesce(payload, -1) AS payload FROM c LEFT JOIN r USING (id)""",
)
def j08(t):
    def ident(seq):
        return F.concat_ws(":", F.col("transcript").cast("string"), seq.cast("string"))

    v = views.v_entries(t)
    calls = v.filter("role = 'user'").select("transcript", "seq", ident(F.col("seq")).alias("id"))
    results = v.filter("role = 'assistant'").select(
        "seq", ident(F.col("seq") - 1).alias("id"), F.when(F.col("seq") % 3 == 0, F.length("text")).alias("entry_payload"), F.length("role").alias("part_payload")
    )
    out = R.pair_results(calls, results)
    return out.select("transcript", "seq", "paired", F.coalesce("payload", F.lit(-1)).cast("long").alias("payload"))


def audited(t):
    v = views.v_entries(t)
    user = F.col("role") != "assistant"
    e = v.select(
        "transcript", "seq", (~user).alias("is_claim"), F.when(user, F.col("text")).alias("command"), F.col("text").alias("output"),
        F.when(F.col("seq") % 5 == 0, F.lit(0)).alias("code"), F.lit(False).alias("interrupted"), F.when(user, F.col("text")).alias("user_text"), "text",
    )
    return R.audit_claims(e, PATTERNS)


AUDIT_SQL = """e AS (SELECT *, role <> 'assistant' AND regexp_matches(text, 'en') AS ran, CASE WHEN role <> 'assistant' AND regexp_matches(text, 'en') THEN
      CASE WHEN regexp_matches(text, 'er ') THEN 'fail' WHEN regexp_matches(text, 'on ') THEN 'pass' WHEN seq % 5 = 0 THEN 'pass' ELSE 'no-evidence' END END AS v,
      bool_or(role <> 'assistant' AND regexp_matches(text, 'xz|thththth')) OVER (PARTITION BY transcript) AS waived FROM v_entries),
    w AS (SELECT *, coalesce(sum(ran::INT) OVER p, 0) AS runs_before, last_value(CASE WHEN v IN ('pass', 'fail') THEN v END IGNORE NULLS) OVER p AS lastv FROM e
      WINDOW p AS (PARTITION BY transcript ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    a AS (SELECT transcript, seq, CAST(runs_before AS BIGINT) AS runs_before, CASE WHEN waived THEN 'waived' WHEN runs_before = 0 THEN 'claim-no-run' WHEN lastv = 'fail' THEN 'claim-vs-fail' WHEN lastv IS NULL THEN 'no-counts' ELSE 'ok' END AS detector
      FROM w WHERE role = 'assistant' AND regexp_matches(text, 'ing|la ') AND NOT regexp_matches(text, 'qui') AND NOT regexp_matches(text, 'ß'))"""


@query("j09_claim_audit", f"WITH {AUDIT_SQL} SELECT * FROM a")
def j09(t):
    return audited(t)


@query("w19_finding_order", f"WITH {AUDIT_SQL} SELECT transcript, seq, detector FROM a WHERE detector NOT IN ('ok', 'waived')")
def w19(t):
    return audited(t).filter("detector not in ('ok', 'waived')").orderBy("transcript", "seq").select("transcript", "seq", "detector")


@query(
    "a10_finding_rate",
    f"""WITH {AUDIT_SQL} SELECT (SELECT count(DISTINCT transcript) FROM v_entries) AS transcripts, count(*) AS claims, count(*) FILTER (detector = 'waived') AS waived, count(*) FILTER (detector NOT IN ('ok', 'waived')) AS findings,
      count(*) FILTER (detector = 'claim-no-run') AS claim_no_run, count(*) FILTER (detector = 'claim-vs-fail') AS claim_vs_fail, count(*) FILTER (detector = 'no-counts') AS no_counts FROM a""",
)
def a10(t):
    return R.claim_rate(audited(t), views.v_entries(t))


@query(
    "j10_bypass_after_reject",
    """SELECT slug, seq FROM v_transitions b WHERE op = 'APPROVE_CLEAN' AND ver % 3 = 0 AND seq > (SELECT min(seq) FROM v_transitions r WHERE r.slug = b.slug AND op = 'REJECT' AND ver % 5 <> 0)""",
)
def j10(t):
    out = R.bypass_after_reject(
        views.v_transitions(t).select("slug", "seq", "op", "ver"), "slug",
        (F.col("op") == "APPROVE_CLEAN") & (F.col("ver") % 3 == 0), (F.col("op") == "REJECT") & (F.col("ver") % 5 != 0),
    )
    return out.select("slug", "seq")


COMMANDS = (
    'git commit -m "x"', "git commit --no-verify -m x", "git push -n", "HUSKY=0 git commit -m x", "git commit -m 'a -n b'", "git -C x commit -n", "cd a && git commit -n", "GIT Commit -N", "git commit -m 'open -n",
)
BYPASSES = (1, 3, 6, 7, 8)


@query(
    "j10_hook_bypass",
    f"""WITH e AS (SELECT conv_id, turn, (conv_id + turn) % {len(COMMANDS) + 1} AS k, CASE WHEN (conv_id + 2 * turn) % 5 = 1 THEN 'precommit_gate  BLOCKED: ' ELSE 'done: ' END || text AS output FROM conversations),
    r AS (SELECT conv_id, min(turn) AS first FROM e WHERE regexp_matches(output, '(?i)(precommit_gate\\s+BLOCKED|pre-commit|pre-push|commit-msg|husky|lint-staged|hook\\s+(failed|rejected|blocked))') GROUP BY conv_id)
    SELECT conv_id, turn FROM e JOIN r USING (conv_id) WHERE k IN {BYPASSES} AND turn > first""",
)
def j10_hooks(t):
    k = (F.col("conv_id") + F.col("turn")) % (len(COMMANDS) + 1)
    said = F.when((F.col("conv_id") + 2 * F.col("turn")) % 5 == 1, "precommit_gate  BLOCKED: ").otherwise("done: ")
    e = t("conversations").select("conv_id", F.col("turn").alias("seq"), F.get(F.array(*map(F.lit, COMMANDS)), k.cast("int")).alias("command"), F.concat(said, "text").alias("output"))
    return R.hook_bypasses(e, "conv_id").select("conv_id", F.col("seq").alias("turn"))


@query(
    "j11_suite_trajectory",
    """WITH c AS (SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS sha FROM orders),
    o AS (SELECT substr(md5(l_orderkey::VARCHAR), 1, [7, 8, 32][l_linenumber % 3 + 1]) AS sha, l_quantity AS passed, CASE WHEN l_linenumber % 4 <> 0 THEN l_shipdate END AS "at" FROM lineitem),
    j AS (SELECT o_orderkey, o.*, row_number() OVER (PARTITION BY o_orderkey ORDER BY ("at" IS NOT NULL) DESC, "at" DESC, passed DESC) AS r, count(o.sha) OVER (PARTITION BY o_orderkey) AS n FROM c LEFT JOIN o ON substr(c.sha, 1, 7) = substr(o.sha, 1, 7) AND substr(c.sha, 1, length(o.sha)) = o.sha)
    SELECT o_orderkey, coalesce(passed, -1.0::DOUBLE) AS passed, n AS observation_count FROM j WHERE r = 1""",
)
def j11(t):
    commits = t("orders").select("o_orderkey", F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("sha"))
    width = F.element_at(F.array(F.lit(7), F.lit(8), F.lit(32)), F.col("l_linenumber") % 3 + 1)
    obs = t("lineitem").select(
        F.substring(F.md5(F.col("l_orderkey").cast("string").cast("binary")), F.lit(1), width).alias("sha"),
        F.col("l_quantity").alias("passed"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_shipdate")).alias("at"),
    )
    return R.suite_trajectory(commits, obs).select("o_orderkey", F.coalesce("passed", F.lit(-1.0)).alias("passed"), "observation_count")


CYCLES_SQL = """c AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN 'r' || o_custkey END AS run_id, CASE WHEN o_orderkey % 3 = 0 THEN 'm' || o_custkey // 2 || CASE WHEN o_orderkey % 60 = 3 THEN 'b' ELSE '' END END AS manifest_run_id,
      o_orderpriority AS session_id, CAST(epoch(o_orderdate) AS BIGINT) AS ts FROM orders)"""


def _cycles(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    manifest = F.concat(F.lit("m"), F.floor(c / 2).cast("string"), F.when(k % 60 == 3, "b").otherwise(""))
    return t("orders").select(
        F.when(k % 10 != 0, F.concat(F.lit("r"), c.cast("string"))).alias("run_id"), F.when(k % 3 == 0, manifest).alias("manifest_run_id"),
        F.col("o_orderpriority").alias("session_id"), F.floor(views.epoch_us("o_orderdate") / 1_000_000).alias("ts"),
    )


@query(
    "j12_run_identity",
    f"""WITH {CYCLES_SQL} SELECT run_id, count(*) AS cycle_count, count(DISTINCT manifest_run_id) AS n_manifests, count(DISTINCT session_id) AS n_sessions, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT manifest_run_id) > 1 AS ambiguous
    FROM c WHERE run_id IS NOT NULL GROUP BY run_id""",
)
def j12(t):
    return R.run_identity(_cycles(t))


@query(
    "j12_runs_by_session",
    f"""WITH {CYCLES_SQL} SELECT session_id, run_id, count(*) AS cycle_count, min(ts) AS first_ts FROM c WHERE run_id IS NOT NULL AND session_id IS NOT NULL GROUP BY ALL""",
)
def j12_sessions(t):
    return R.runs_by(_cycles(t), "session_id")


@query(
    "j12_join_summary",
    f"""WITH {CYCLES_SQL}, r AS (SELECT run_id, count(DISTINCT manifest_run_id) > 1 AS ambiguous FROM c WHERE run_id IS NOT NULL GROUP BY run_id)
    SELECT count(*) AS joined_runs, count(*) FILTER (ambiguous) AS ambiguous_runs, (SELECT count(*) FROM c WHERE run_id IS NULL) AS unjoined_cycles FROM r""",
)
def j12_summary(t):
    return R.join_summary(_cycles(t))


@query(
    "j12_resolve_identity",
    f"""WITH {CYCLES_SQL}, p AS (SELECT DISTINCT run_id, manifest_run_id FROM c WHERE run_id IS NOT NULL AND manifest_run_id IS NOT NULL),
    q AS (SELECT 'r' || c_custkey AS run_id, 'm' || CASE WHEN c_custkey % 4 = 0 THEN c_custkey + 7 ELSE c_custkey // 2 END AS manifest_run_id FROM customer)
    SELECT run_id, manifest_run_id, CASE WHEN (run_id, manifest_run_id) IN (SELECT (run_id, manifest_run_id) FROM p) THEN 'joined' WHEN run_id IN (SELECT run_id FROM p) OR manifest_run_id IN (SELECT manifest_run_id FROM p) THEN 'conflict' ELSE 'unknown' END AS status FROM q""",
)
def j12_resolve(t):
    k = F.col("c_custkey")
    other = F.when(k % 4 == 0, k + 7).otherwise(F.floor(k / 2))
    callers = t("customer").select(F.concat(F.lit("r"), k.cast("string")).alias("run_id"), F.concat(F.lit("m"), other.cast("string")).alias("manifest_run_id"))
    return R.resolve_identity(_cycles(t), callers)


AGENTS_SQL = """a AS (SELECT slug % 12 AS session, slug AS agent, CAST(sum(ver) AS BIGINT) AS tok, count(*) AS ev, CASE WHEN slug % 12 <> 7 THEN CAST(floor(epoch_us(min(ts)) / 1000000) AS BIGINT) END AS s,
      CASE WHEN slug % 12 <> 7 THEN CAST(floor(epoch_us(max(ts)) / 1000000) AS BIGINT) END AS l, slug % 12 <> 5 AND slug % 5 = 0 AS on_disk FROM v_transitions GROUP BY slug)"""


def _agents(t):
    known = F.col("slug") % 12 != 7
    sec = F.floor(views.epoch_us("ts") / 1_000_000)
    g = views.v_transitions(t).groupBy("slug").agg(
        F.sum("ver").alias("output_tokens"), F.count("*").alias("events"), F.min(F.when(known, sec)).alias("start"), F.max(F.when(known, sec)).alias("last_event")
    )
    return g.withColumns({"session": F.col("slug") % 12, "on_disk": (F.col("slug") % 12 != 5) & (F.col("slug") % 5 == 0)})


@query(
    "a11_fleet_history",
    f"""WITH {AGENTS_SQL} SELECT session, count(*) AS agent_count, CAST(sum(tok) AS BIGINT) AS output_tokens, CAST(sum(ev) AS BIGINT) AS events, coalesce(max(l) - min(s), -1) AS span_s, count(*) FILTER (on_disk) AS agents_on_disk, count(*) FILTER (on_disk) = 0 AS mirror_only FROM a GROUP BY session""",
)
def a11(t):
    f = R.fleet_history(_agents(t)).withColumn("span_s", F.coalesce("span_s", F.lit(-1)))
    return f.select("session", "agent_count", "output_tokens", "events", "span_s", "agents_on_disk", "mirror_only")


@query(
    "a11_fleet_totals",
    f"""WITH {AGENTS_SQL}, s AS (SELECT session, count(*) AS n, sum(tok) AS tok, count(*) FILTER (on_disk) AS d, min(s) AS s, max(l) AS l FROM a GROUP BY session)
    SELECT count(*) AS sessions, CAST(sum(n) AS BIGINT) AS agents, CAST(sum(tok) AS BIGINT) AS output_tokens, count(*) FILTER (d = 0) AS mirror_only_sessions, CAST(sum(n - d) AS BIGINT) AS mirror_only_agents, min(s) AS oldest, max(l) AS newest FROM s""",
)
def a11_totals(t):
    return R.fleet_history(_agents(t)).agg(
        F.count("*").alias("sessions"), F.sum("agent_count").alias("agents"), F.sum("output_tokens").alias("output_tokens"), F.count_if("mirror_only").alias("mirror_only_sessions"),
        F.sum(F.col("agent_count") - F.col("agents_on_disk")).alias("mirror_only_agents"), F.min("first_start").alias("oldest"), F.max("last_event").alias("newest"),
    )


def usage_lines(t):
    """Events as transcript lines, one in 50 of them cut short."""
    whole = F.to_json(F.struct(F.col("ts").cast("string").alias("timestamp"), F.col("value").alias("tokens")))
    line = F.when(F.col("event_id") % 50 == 7, F.substring(whole, 1, 20)).otherwise(whole)
    return t("events").select(F.col("user_id").alias("file"), F.col("event_id").alias("line_no"), line.alias("line"))


@query(
    "a12_transcript_stats",
    """WITH e AS (SELECT *, event_id = max(event_id) OVER (PARTITION BY user_id) AS tail, event_id % 50 = 7 AS bad FROM events)
    SELECT user_id AS file, count(*) FILTER (NOT bad) AS events, count(*) FILTER (bad AND NOT tail) AS torn_lines, bool_or(bad AND tail) AS torn_tail, CAST(floor(epoch_us(min(ts) FILTER (NOT bad)) / 1000000) AS BIGINT) AS first_s, CAST(floor(epoch_us(max(ts) FILTER (NOT bad)) / 1000000) AS BIGINT) AS last_s,
      round(sum(value) FILTER (NOT bad), 2) AS tokens FROM e GROUP BY user_id""",
)
def a12(t):
    from tidemark.sources.jsonl import parsed_stats

    stamp = F.unix_micros(F.col("rec.timestamp").cast("timestamp"))
    out = parsed_stats(
        usage_lines(t), "timestamp string, tokens double",
        {"first_s": F.floor(F.min(stamp) / 1_000_000), "last_s": F.floor(F.max(stamp) / 1_000_000), "tokens": F.round(F.sum("rec.tokens"), 2)},
    )
    return out.select("file", F.col("parsed").alias("events"), F.col("corrupt_lines").alias("torn_lines"), "torn_tail", "first_s", "last_s", "tokens")


@query(
    "a13_spend_meter",
    """WITH u AS (SELECT user_id % 5 AS session, floor(value * 1000) AS i, floor(value * 10) AS o, CASE event_type WHEN 'click' THEN 3.0 WHEN 'error' THEN 1.0 ELSE 15.0 END AS pi, CASE event_type WHEN 'click' THEN 15.0 WHEN 'error' THEN 5.0 ELSE 75.0 END AS po FROM events WHERE ts >= TIMESTAMP '2024-01-10')
    SELECT session, round(sum(i * CAST(pi AS DOUBLE) + o * CAST(po AS DOUBLE)) / 1000000, 4) AS usd FROM u GROUP BY session""",
)
def a13(t):
    model = F.when(F.col("event_type") == "click", "sonnet").when(F.col("event_type") == "error", "haiku").otherwise("opus")
    v, zero = F.col("value"), F.lit(0)
    usd = token_price(model, F.floor(v * 1000), F.floor(v * 10), zero, zero)
    late = t("events").filter("ts >= timestamp_ntz'2024-01-10 00:00:00'")
    return late.groupBy((F.col("user_id") % 5).alias("session")).agg(F.round(F.sum(usd), 4).alias("usd"))


@query(
    "a14_activity_profile",
    """SELECT o_orderstatus AS author, count(*) AS commits, count(DISTINCT CAST(o_orderdate AS DATE)) AS active_days, round(count(*) / count(DISTINCT CAST(o_orderdate AS DATE)), 4) AS per_active_day, count(DISTINCT o_custkey) AS files_touched,
      CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS window_start, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS window_end FROM orders GROUP BY 1""",
)
def a14(t):
    day = F.to_date("o_orderdate")
    return t("orders").groupBy(F.col("o_orderstatus").alias("author")).agg(
        F.count("*").alias("commits"), F.count_distinct(day).alias("active_days"), F.round(F.count("*") / F.count_distinct(day), 4).alias("per_active_day"),
        F.count_distinct("o_custkey").alias("files_touched"), F.min(day).cast("string").alias("window_start"), F.max(day).cast("string").alias("window_end"),
    )


@query(
    "a14_top_dirs",
    """SELECT dir, n FROM (SELECT CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) ELSE '(root)' END AS dir, count(*) AS n FROM (SELECT host || '/' || path AS path FROM v_paths) p GROUP BY 1) x ORDER BY n DESC, dir LIMIT 12""",
)
def a14_dirs(t):
    path = F.concat_ws("/", "host", "path")
    top = F.when(F.contains(path, F.lit("/")), F.substring_index(path, "/", 1)).otherwise("(root)")
    return views.v_paths(t).groupBy(top.alias("dir")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "dir").limit(12)


@query(
    "a15_churn",
    """SELECT l_returnflag AS author, CAST(sum(floor(l_quantity)) AS BIGINT) AS added, CAST(sum(l_linenumber) AS BIGINT) AS deleted, CAST(sum(floor(l_quantity)) FILTER (l_linestatus <> 'F') AS BIGINT) AS added_source, CAST(sum(l_linenumber) FILTER (l_linestatus <> 'F') AS BIGINT) AS deleted_source FROM lineitem GROUP BY 1""",
)
def a15(t):
    keep = F.col("l_linestatus") != "F"
    a, d = F.floor("l_quantity"), F.col("l_linenumber")
    return t("lineitem").groupBy(F.col("l_returnflag").alias("author")).agg(
        F.sum(a).alias("added"), F.sum(d).alias("deleted"), F.sum(F.when(keep, a)).alias("added_source"), F.sum(F.when(keep, d)).alias("deleted_source")
    )


@query(
    "a25_queue_cluster",
    f"""SELECT count(*) AS waiting, max(age_s) AS oldest_age_s, count(*) > 1 AND count(DISTINCT stage) = 1 AS clustered, CASE WHEN count(*) > 1 AND count(DISTINCT stage) = 1 THEN min(stage) ELSE -1 END AS cluster_stage FROM ({BOARD_SQL}) b WHERE phase = '_needauth'""",
)
def a25(t):
    one = (F.count("*") > 1) & (F.count_distinct("stage") == 1)
    return board(t).filter("phase = '_needauth'").agg(
        F.count("*").alias("waiting"), F.max("age_s").alias("oldest_age_s"), one.alias("clustered"), F.when(one, F.min("stage")).otherwise(-1).alias("cluster_stage")
    )
