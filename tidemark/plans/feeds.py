"""Source and sink queries: tables rendered to each format and read back by its parser."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import views
from tidemark.plans.registry import query
from tidemark.plans.runs import usage_lines
from tidemark.sources import golden, jsonl, ledgerdoc, logs, manifests, sinks


@query(
    "s01_transition_log",
    """SELECT seq, CASE WHEN seq % 40 <> 0 THEN 's' || slug END AS slug, CASE WHEN seq % 40 <> 0 THEN op END AS op, CASE WHEN seq % 40 <> 0 THEN 'stage ' || (ver % 4) END AS from_stage, CASE WHEN seq % 40 <> 0 THEN 'tool:x' END AS actor,
      CASE WHEN seq % 40 <> 0 THEN substr(sha_out, 1, 12) END AS sha12, CASE WHEN seq % 40 <> 0 AND ver % 3 = 0 THEN 'a | b' END AS note, seq % 40 = 0 AS corrupt FROM v_transitions WHERE seq % 41 <> 0""",
)
def s01(t):
    stage = F.concat(F.lit("stage "), (F.col("ver") % 4).cast("string"))
    line = logs.render_transition(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.concat(F.lit("s"), F.col("slug").cast("string")), F.col("op"), stage, F.lit("next"), F.lit("tool:x"),
        F.substring("sha_out", 1, 12), F.lit("ok"), F.when(F.col("ver") % 3 == 0, "a | b"),
    )
    line = F.when(F.col("seq") % 41 == 0, F.when(F.col("seq") % 2 == 0, "# header").otherwise(" ")).when(F.col("seq") % 40 == 0, F.substring(line, 1, 30)).otherwise(line)
    p = logs.parse_transitions(views.v_transitions(t).select("seq", line.alias("value")))
    return p.select("seq", "slug", "op", "from_stage", "actor", "sha12", "note", F.col("_corrupt").isNotNull().alias("corrupt"))


@query(
    "s02_manifest_source",
    """SELECT l_orderkey, l_linenumber - 1 AS seq, CASE l_linenumber WHEN 1 THEN 'INTAKE' WHEN 2 THEN 'ANNOTATE' ELSE 'SUBMIT' END AS op, CASE WHEN l_linenumber = 2 THEN 'G1' END AS gate, CASE WHEN l_linenumber = 2 THEN 0.5::DOUBLE END AS halo
    FROM (SELECT o_orderkey AS l_orderkey, unnest([1, 2, 3]) AS l_linenumber FROM orders) x""",
)
def s02(t):
    doc = (
        '{"schema": 1, "slug": "%s", "extra": [1], "transitions": [{"op": "INTAKE", "ts": "2026-01-01T00:00:00Z"}, '
        '{"op": "ANNOTATE", "audit": {"gate": "G1", "verdict": "FLAG", "reasons": ["x"], "metrics": {"halo_pct": 0.5}}}, {"op": "SUBMIT"}]}'
    )
    raw = t("orders").select(F.format_string(doc, F.col("o_orderkey").cast("string")).alias("doc"))
    docs = raw.select(F.from_json("doc", manifests.MANIFEST).alias("d")).select("d.*")
    return manifests.explode_manifests(docs).select(
        F.col("slug").cast("long").alias("l_orderkey"), F.col("seq").cast("long").alias("seq"), "op", "audit.gate", F.col("audit.metrics")["halo_pct"].alias("halo")
    )


@query(
    "s03_torn_tail_jsonl",
    """WITH e AS (SELECT *, event_id = max(event_id) OVER (PARTITION BY user_id) AS tail, event_id % 50 = 7 AS bad FROM events)
    SELECT user_id AS file, count(*) FILTER (NOT bad) AS parsed, bool_or(bad AND tail) AS torn_tail, count(*) FILTER (bad AND NOT tail) AS corrupt_lines FROM e GROUP BY user_id""",
)
def s03(t):
    return jsonl.parsed_stats(usage_lines(t), "timestamp string, tokens double")


@query(
    "s04_state_snapshot",
    """SELECT slug, 'i' || slug AS id, CASE WHEN slug % 3 = 2 THEN NULL ELSE 'CLEAN_SCRATCH' END AS state, max(ver) AS working_max FROM v_transitions WHERE slug % 5 <> 4 GROUP BY slug""",
)
def s04(t):
    g = views.v_transitions(t).groupBy("slug").agg(F.max("ver").alias("v"))
    keyed = F.format_string('{"images": {"i%s": {"state": "CLEAN_SCRATCH", "working_max": %s, "odd": {}}}, "counts": 1}', F.col("slug").cast("string"), F.col("v").cast("string"))
    listed = F.format_string('{"images": [{"id": "i%s", "working_max": %s, "state": null}]}', F.col("slug").cast("string"), F.col("v").cast("string"))
    doc = F.when(F.col("slug") % 5 == 4, '{"images": "none"}').when(F.col("slug") % 3 == 2, listed).otherwise(keyed)
    return manifests.explode_snapshots(g.select("slug", doc.alias("doc")), "doc", ["slug"]).select("slug", "id", "state", "working_max")


@query(
    "s05_asset_scan",
    """WITH f AS (SELECT path, doc_id AS mtime, size + CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END AS size, CASE WHEN doc_id % 24 <> 0 THEN sha END AS sha, doc_id % 4 <> 0 AND doc_id % 7 <> 0 AS cached FROM v_files)
    SELECT path, sha, cached FROM f WHERE cached OR sha IS NOT NULL""",
)
def s05(t):
    f = views.v_files(t)
    k = F.col("doc_id")
    listing = f.select("path", k.alias("mtime"), (F.col("size") + F.when(k % 4 == 0, 1).otherwise(0)).alias("size"))
    cache = f.filter("doc_id % 7 <> 0").select("path", k.alias("mtime"), "size", "sha")
    # Bytes meet their path after the cache has been asked, and only then are hashed.
    content = t("documents").select(views.file_path().alias("path"), F.when(k % 24 != 0, F.col("text")).alias("content"))
    sha = F.sha2(F.col("content").cast("binary"), 256)
    fresh = lambda changed: changed.join(content, "path").select(*changed.columns, sha.alias("sha"))
    return manifests.scan_changed(listing, cache, fresh).select("path", "sha", "cached")


@query(
    "s06_golden_set",
    """SELECT l_orderkey AS slug, l_linenumber AS n, msssim, lap_ratio FROM v_versions""",
)
def s06(t):
    doc = F.to_json(
        F.struct(
            F.lit(1).alias("schema"), F.lit("pv").alias("pipeline_version"),
            F.array(
                F.struct(
                    F.col("l_orderkey").cast("string").alias("slug"), F.struct("msssim", "lap_ratio", "lpips", "halo_pct", "band_delta").alias("metrics"),
                    F.array(F.col("l_linenumber").cast("string")).alias("defect_axes"), F.lit(True).alias("blessed"),
                )
            ).alias("cases"),
        )
    )
    c = views.v_versions(t).select(F.from_json(doc, golden.SCHEMA).alias("d")).select(F.explode("d.cases").alias("c"))
    return c.select(F.col("c.slug").cast("long").alias("slug"), F.col("c.defect_axes")[0].cast("int").alias("n"), "c.metrics.msssim", "c.metrics.lap_ratio")


@query(
    "s07_triage_latest",
    """SELECT slug, CASE ver % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'qa' ELSE 'clean' END AS verdict, seq FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY seq DESC) AS r FROM v_transitions) x WHERE r = 1""",
)
def s07(t):
    v = F.element_at(F.array(F.lit("auto"), F.lit("qa"), F.lit("clean")), F.col("ver") % 3 + 1)
    return manifests.latest_triage(views.v_transitions(t).select("slug", "seq", v.alias("verdict"))).select("slug", "verdict", "seq")


@query(
    "s09_ledger_items",
    """SELECT doc_id, doc_id AS number, '2026-0' || (doc_id % 9 + 1) || '-15' AS date, 'Title ' || doc_id AS title FROM documents UNION ALL SELECT doc_id, doc_id + 1, '2026-01-01', 'Next' FROM documents""",
)
def s09(t):
    body = F.format_string("%s\n%d. x **2026-0%d-15 - Title %d** %s\n%d. y **2026-01-01 - Next** z", F.lit("preamble"), F.col("doc_id"), F.col("doc_id") % 9 + 1, F.col("doc_id"), F.replace("text", F.lit("**"), F.lit("")), F.col("doc_id") + 1)
    return ledgerdoc.ledger_items(t("documents").select("doc_id", body.alias("b")), "b", ["doc_id"]).select("doc_id", "number", "date", "title")


@query(
    "s10_session_blocks",
    """SELECT doc_id, kind, n FROM (SELECT doc_id, 'header' AS kind, 1 AS n FROM documents UNION ALL SELECT doc_id, 'pinned', doc_id % 3 FROM documents UNION ALL SELECT doc_id, 'session', 3 FROM documents UNION ALL SELECT doc_id, 'extra', doc_id % 2 FROM documents) x WHERE n > 0""",
)
def s10(t):
    k = F.col("doc_id")
    sep = ledgerdoc.SEP
    body = F.concat(
        "text", F.repeat(F.lit(sep + "# RESOLVED x"), (k % 3).cast("int")), F.lit(sep + "# s12 wrap\na\n# s11.2 wrap\nb"), F.lit(sep + "\n## 2026-08-01 note\nc"), F.repeat(F.lit(sep + "stray"), (k % 2).cast("int"))
    )
    b = ledgerdoc.split_blocks(t("documents").select("doc_id", body.alias("b")), "doc_id", "b")
    return b.groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


@query(
    "s12_diff_added",
    """WITH d AS (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents)
    SELECT doc_id, 'a/f' || doc_id || '.txt' AS file, CAST(7 + i AS BIGINT) AS line_no FROM d, (SELECT unnest(range(3)) AS i) r WHERE i < 2 OR doc_id % 2 = 0 UNION ALL SELECT doc_id, 'g.txt', 1 FROM d""",
)
def s12(t):
    k = F.col("doc_id").cast("string")
    head = F.concat(F.lit("diff --git\n--- a/x\n+++ b/a/f"), k, F.lit(".txt\n@@ -1,2 +7,3 @@ ctx\n+one\n-gone\n+two"))
    more = F.when(F.col("doc_id") % 2 == 0, "\n+three").otherwise("")
    diff = F.concat(head, more, F.lit("\n+++ /dev/null\n@@ -1 +1 @@\n+never\n+++ b/g.txt\n@@ -0,0 +1 @@\n+g"))
    return logs.diff_added_lines(t("documents").select("doc_id", diff.alias("d")), "doc_id", "d").select("doc_id", "file", "line_no")


@query(
    "s13_commit_log",
    """SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS sha, o_orderpriority || ' | x' AS subject FROM orders WHERE o_orderkey % 20 <> 0""",
)
def s13(t):
    k = F.col("o_orderkey")
    sha = F.md5(k.cast("string").cast("binary"))
    whole = F.concat_ws(logs.SEP, sha, F.concat("o_orderpriority", F.lit(" | x")), F.date_format("o_orderdate", "yyyy-MM-dd"))
    line = F.when(k % 40 == 0, F.concat_ws(logs.SEP, sha, F.lit("cut"))).when(k % 20 == 0, F.concat_ws(logs.SEP, F.lit(" "), F.lit("s"), F.lit("d"))).otherwise(whole)
    return logs.parse_commits(t("orders").select("o_orderkey", line.alias("value"))).select("o_orderkey", "sha", "subject")


@query(
    "s13_numstat",
    """SELECT l_returnflag, count(*) AS files, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS added, CAST(sum(l_linenumber) AS BIGINT) AS deleted FROM lineitem WHERE l_linenumber <> 3 GROUP BY 1""",
)
def s13_numstat(t):
    added = F.when(F.col("l_linenumber") == 3, "-").otherwise(F.col("l_quantity").cast("long").cast("string"))
    lines = t("lineitem").select("l_returnflag", F.concat_ws("\t", added, F.col("l_linenumber").cast("string"), F.lit("p")).alias("value"))
    return logs.parse_numstat(lines).groupBy("l_returnflag").agg(F.count("*").alias("files"), F.sum("added").alias("added"), F.sum("deleted").alias("deleted"))


@query(
    "s14_lock_events",
    """SELECT seq, CASE op WHEN 'INTAKE' THEN 'ACQUIRED' WHEN 'REJECT' THEN 'RELEASED' WHEN 'SUBMIT' THEN 'busy' WHEN 'SAVE_WORKING' THEN 'acquired' END AS marker, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS at_s FROM v_transitions WHERE op <> 'APPROVE_CLEAN'""",
)
def s14(t):
    words = F.create_map(
        *[F.lit(x) for x in ("INTAKE", "winmutex: ACQUIRED m", "REJECT", "winmutex: RELEASED m", "SUBMIT", "slots: 3/3 busy - waiting", "SAVE_WORKING", "slots: acquired slot-1", "APPROVE_CLEAN", "cycle 3: done")]
    )
    line = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(" "), words[F.col("op")])
    p = logs.parse_lock_events(views.v_transitions(t).select("seq", line.alias("value")))
    return p.select("seq", "marker", F.col("at").alias("at_s"))


@query(
    "s15_slot_samples",
    """SELECT count(*) AS samples, max(ver % 4) AS peak, count(*) FILTER (ver % 4 >= 2) AS shared FROM v_transitions WHERE seq % 30 <> 0""",
)
def s15(t):
    n = F.col("ver") % 4
    owners = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.concat(F.lit("slot-"), i.cast("string")).alias("slot"), F.concat(F.lit("r"), i.cast("string")).alias("repo")))
    owners = F.when(n > 0, owners).otherwise(F.array().cast("array<struct<slot string, repo string>>"))
    line = F.to_json(F.struct(F.col("seq").cast("double").alias("t"), n.alias("n"), owners.alias("owners")))
    raw = views.v_transitions(t).select(F.when(F.col("seq") % 30 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value"))
    rec = raw.select(F.from_json("value", logs.SAMPLE + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r")).filter("r._bad is null")
    return logs.shared_samples(rec.select("r.*"))


@query(
    "s16_put_if_absent",
    """WITH p AS (SELECT DISTINCT source || '/' || doc_id % 20 AS name, sha FROM v_files WHERE doc_id % 3 = 0), n AS (SELECT doc_id AS seq, source || '/' || doc_id % 20 AS name, sha FROM v_files),
    f AS (SELECT name, sha, min(seq) AS seq FROM n WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.name = n.name AND p.sha = n.sha) GROUP BY ALL),
    k AS (SELECT seq, row_number() OVER (PARTITION BY name ORDER BY seq) + (SELECT count(*) FROM p WHERE p.name = f.name) AS k FROM f)
    SELECT n.seq, CASE WHEN k IS NULL THEN 'noop' WHEN k = 1 THEN 'write' ELSE 'write_renamed' END AS action, CASE WHEN k > 1 THEN name || '~' || k ELSE name END AS target FROM n LEFT JOIN k USING (seq)""",
)
def s16(t):
    f = views.v_files(t)
    name = F.concat_ws("/", "source", (F.col("doc_id") % 20).cast("string"))
    new = f.select(F.col("doc_id").alias("seq"), name.alias("name"), "sha")
    return sinks.plan_put(new, f.filter("doc_id % 3 = 0").select(name.alias("name"), "sha")).select("seq", "action", "target")


@query("s17_snapshot_sink", "SELECT slug, count(*) AS n FROM v_transitions GROUP BY slug")
def s17(t):
    import uuid

    from tidemark.session import shared_dir

    path = f"{shared_dir(t.spark)}/snapshot-{uuid.uuid4().hex}"
    counts = views.v_transitions(t).groupBy("slug").agg(F.count("*").alias("n"))
    sinks.write_snapshot(counts.limit(0), path, 1)
    sinks.write_snapshot(counts, path, 2)
    return sinks.read_snapshot(t.spark, path)
