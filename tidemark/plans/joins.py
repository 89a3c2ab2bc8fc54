"""Claim, reference, overlap and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import naming
from tidemark.operators import censuses as C
from tidemark.operators import claims as K
from tidemark.operators import runs as R
from tidemark.plans import views
from tidemark.plans.registry import query


@query(
    "j13_interval_overlap",
    """WITH a AS (SELECT * FROM v_intervals WHERE owner IN ('1-URGENT', '2-HIGH')), b AS (SELECT * FROM v_intervals WHERE owner NOT IN ('1-URGENT', '2-HIGH'))
    SELECT a.id, count(b.id) AS n_overlaps, CAST(coalesce(sum(least(a.e, b.e) - greatest(a.s, b.s)) FILTER (b.id IS NOT NULL), 0) AS BIGINT) AS overlap_s
    FROM a LEFT JOIN b ON b.s < a.e AND a.s < b.e GROUP BY a.id""",
)
def j13(t):
    v = views.v_intervals(t)
    pressing = F.col("owner").isin("1-URGENT", "2-HIGH")
    return R.overlap_summary(v.filter(pressing), v.filter(~pressing))


@query(
    "a26_peak_concurrency",
    """WITH p AS (SELECT t, sum(d) AS d FROM (SELECT s AS t, 1 AS d FROM v_intervals UNION ALL SELECT e, -1 FROM v_intervals) x GROUP BY t),
    r AS (SELECT t, sum(d) OVER (ORDER BY t) AS n FROM p), w AS (SELECT id, s, e, CASE WHEN owner LIKE '5%' THEN NULL ELSE owner || '-' || id % 40 END AS owner FROM v_intervals),
    o AS (SELECT p.t, count(DISTINCT owner) AS k FROM p LEFT JOIN w ON s <= p.t AND p.t < e GROUP BY p.t)
    SELECT CAST(max(n) AS BIGINT) AS peak, count(*) AS samples, count(*) FILTER (k > 1) AS shared, max(k) AS most_owners FROM r JOIN o USING (t)""",
)
def a26(t):
    who = F.when(~F.col("owner").startswith("5"), F.concat_ws("-", "owner", (F.col("id") % 40).cast("string")))
    return R.peak_concurrency(views.v_intervals(t).withColumn("owner", who), "owner")


HELD_SQL = """p AS (SELECT page_id, CASE WHEN path = '' THEN NULL ELSE rtrim(path, '/') END AS key, 'a' || page_id % 7 AS agent, page_id % 40 AS request FROM v_paths),
    h AS (SELECT page_id AS ord, CASE WHEN page_id % 12 = 0 THEN split_part(key, '/', 1) || '/x' ELSE key END AS key, agent FROM p WHERE page_id % 3 = 0 AND key IS NOT NULL),
    w AS (SELECT page_id, request, agent, CASE WHEN page_id % 10 = 1 THEN split_part(key, '/', 1) ELSE key END AS key FROM p WHERE page_id % 3 <> 0)"""


def _claims(t):
    key = naming.claim_key(F.col("path"))
    p = views.v_paths(t).select("page_id", key.alias("key"), F.concat(F.lit("a"), (F.col("page_id") % 7).cast("string")).alias("agent"))
    top = F.substring_index("key", "/", 1)
    held = p.filter("page_id % 3 = 0 and key is not null").select(
        F.col("page_id").alias("ord"), F.when(F.col("page_id") % 12 == 0, F.concat(top, F.lit("/x"))).otherwise(F.col("key")).alias("key"), "agent"
    )
    wanted = p.filter("page_id % 3 <> 0").select(
        "page_id", (F.col("page_id") % 40).alias("request"), "agent", F.when(F.col("page_id") % 10 == 1, top).otherwise(F.col("key")).alias("key")
    )
    return held, wanted


@query(
    "j14_claim_conflicts",
    f"""WITH {HELD_SQL}, c AS (SELECT *, key IS NULL OR EXISTS (SELECT 1 FROM h WHERE h.agent <> w.agent AND (h.key = w.key OR starts_with(h.key, w.key || '/') OR starts_with(w.key, h.key || '/'))) AS conflict FROM w)
    SELECT page_id, request, conflict, NOT bool_or(conflict) OVER (PARTITION BY request) AS granted FROM c""",
)
def j14(t):
    held, wanted = _claims(t)
    return K.claim_conflicts(held, wanted).select("page_id", "request", "conflict", "granted")


@query(
    "j15_start_gate",
    f"""WITH {HELD_SQL}, s AS (SELECT 's' || page_id AS slice, agent, CASE page_id % 9 WHEN 1 THEN NULL WHEN 4 THEN '/' || key ELSE key END AS file, key, page_id FROM p WHERE page_id % 3 <> 0 AND key IS NOT NULL),
    g AS (SELECT s.*, (SELECT arg_min(h.agent, h.ord) FROM h WHERE h.key = s.key OR starts_with(s.key, h.key || '/')) AS holder FROM s)
    SELECT slice, coalesce(file, '') AS file, CASE WHEN page_id % 9 = 1 THEN 'no_files' WHEN page_id % 9 = 4 THEN 'bad_path' WHEN holder IS NULL THEN 'unclaimed' ELSE 'held_by_other' END AS problem
    FROM g WHERE page_id % 9 IN (1, 4) OR holder IS NULL OR holder <> agent""",
)
def j15(t):
    held, _ = _claims(t)
    p = views.v_paths(t).select("page_id", naming.claim_key(F.col("path")).alias("key")).filter("page_id % 3 <> 0 and key is not null")
    m = F.col("page_id") % 9
    s = p.select(
        F.concat(F.lit("s"), F.col("page_id").cast("string")).alias("slice"),
        F.concat(F.lit("a"), (F.col("page_id") % 7).cast("string")).alias("agent"),
        F.when(m == 1, None).when(m == 4, F.concat(F.lit("/"), "key")).otherwise(F.col("key")).alias("file"),
    )
    return K.start_gate(s, held).fillna("", ["file"])


#: Rows of a table that one task of ``j16_shared_files`` takes, on the average.
TASK_ROWS = 1 << 20


@query(
    "j16_shared_files",
    """SELECT l_partkey AS file, count(DISTINCT o_orderkey) AS n_slices, min(o_orderkey) AS first_slice, max(o_orderkey) AS last_slice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' GROUP BY 1 HAVING count(DISTINCT o_orderkey) > 1""",
)
def j16(t):
    lines = t("lineitem").select("l_orderkey", "l_partkey")
    parts = lines.count() // TASK_ROWS + 1  # from the files' footers: a task's share doesn't grow with the table
    open_ = t("orders").filter("o_orderstatus <> 'F'").select("o_orderkey").repartition(parts, "o_orderkey").hint("merge")
    s = lines.repartition(parts, "l_orderkey").join(open_, F.col("l_orderkey") == F.col("o_orderkey"))
    return K.shared_files(s.select(F.col("l_partkey").alias("file"), F.col("o_orderkey").alias("slice")), parts)


def _reconciled(t):
    k = F.col("o_orderkey")
    claims = t("orders").select(
        k.alias("slice"), F.when(k % 7 != 0, k % 5).alias("claimed_passed"), F.when(k % 2 == 0, F.lit(0).cast("long")).alias("claimed_failed")
    )
    observed = t("lineitem").groupBy(F.col("l_orderkey").alias("slice")).agg(
        F.count_if(F.col("l_returnflag") != "R").alias("passed"), F.count_if(F.col("l_returnflag") == "R").alias("failed"), F.lit(True).alias("file_exists")
    )
    return K.reconcile(claims, observed), observed


RECON_SQL = """o AS (SELECT l_orderkey AS slice, count(*) FILTER (l_returnflag <> 'R') AS passed, count(*) FILTER (l_returnflag = 'R') AS failed FROM lineitem GROUP BY 1),
    c AS (SELECT o_orderkey AS slice, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 5 END AS cp, CASE WHEN o_orderkey % 2 = 0 THEN 0 END AS cf FROM orders),
    d AS (SELECT c.slice, concat_ws(';', CASE WHEN o.slice IS NULL THEN 'file_missing' END, CASE WHEN cp <> coalesce(passed, 0) THEN 'passed ' || cp || '<>' || coalesce(passed, 0) END,
      CASE WHEN cf <> coalesce(failed, 0) THEN 'failed ' || cf || '<>' || coalesce(failed, 0) END) AS discrepancies FROM c LEFT JOIN o USING (slice))"""


@query("j17_reconcile", f"WITH {RECON_SQL} SELECT slice, CASE WHEN discrepancies = '' THEN 'CONFIRM' ELSE 'QUARANTINE' END AS verdict, discrepancies FROM d")
def j17(t):
    return _reconciled(t)[0]


@query(
    "j17_reconcile_total",
    f"WITH {RECON_SQL} SELECT count(*) FILTER (discrepancies <> '') AS quarantined, (SELECT CAST(sum(failed) AS BIGINT) FROM o) AS suite_failed, false AS no_tests_ran, 'REFUSE' AS verdict FROM d",
)
def j17_total(t):
    return K.reconcile_total(*_reconciled(t))


@query(
    "j18_baseline_regress",
    """WITH v AS (SELECT *, l_orderkey * 10 + (l_linenumber + 1) // 2 AS case_id FROM v_versions), b AS (SELECT * FROM v WHERE l_linenumber % 2 = 1), c AS (SELECT * FROM v WHERE l_linenumber % 2 = 0),
    r AS (SELECT case_id, c.l_orderkey IS NULL AS missing, concat_ws(';', CASE WHEN abs(c.msssim - b.msssim) > 0.01 THEN 'msssim' END, CASE WHEN abs(c.lpips - b.lpips) > 0.02 THEN 'lpips' END,
      CASE WHEN abs(c.halo_pct - b.halo_pct) > 0.02 THEN 'halo_pct' END, CASE WHEN b.lap_ratio <> 0 AND abs(c.lap_ratio - b.lap_ratio) / b.lap_ratio > 0.05 THEN 'lap_ratio' END) AS why FROM b LEFT JOIN c USING (case_id))
    SELECT case_id, NOT missing AND why = '' AS ok, CASE WHEN missing THEN 'missing candidate' ELSE why END AS reasons FROM r""",
)
def j18(t):
    # odd versions are baselines, the even one after each its candidate; a last odd one has none
    v = views.v_versions(t).withColumn("case_id", F.col("l_orderkey") * 10 + F.expr("(l_linenumber + 1) div 2")).drop("l_orderkey")
    odd = F.col("l_linenumber") % 2 == 1
    return C.regress(v.filter(odd).drop("l_linenumber"), v.filter(~odd).drop("l_linenumber"), "case_id")


BANDS_SQL = """m AS (SELECT p_brand AS key, p_retailprice AS lv, p_size / 25 AS rt FROM part),
    b AS (SELECT key, quantile_cont(lv, 0.5) AS lm, quantile_cont(rt, 0.5) AS rm, quantile_cont(lv, 0.05) AS l5, quantile_cont(lv, 0.95) AS l95, quantile_cont(rt, 0.05) AS r5, quantile_cont(rt, 0.95) AS r95, count(*) AS n FROM m GROUP BY key
      UNION ALL SELECT '_default', quantile_cont(lv, 0.5), quantile_cont(rt, 0.5), quantile_cont(lv, 0.05), quantile_cont(lv, 0.95), quantile_cont(rt, 0.05), quantile_cont(rt, 0.95), count(*) FROM m)"""


def _bands(t):
    m = t("part").select(F.col("p_brand").alias("key"), F.col("p_retailprice").alias("level"), (F.col("p_size") / 25).alias("ratio"))
    return C.build_bands(m)


@query(
    "a18_group_bands",
    f"""WITH {BANDS_SQL} SELECT key, n, round(lm, 6) AS level_median, round(l5, 6) AS level_lo, round(l95, 6) AS level_hi, round(rm, 6) AS ratio_median, round(r5, 6) AS ratio_lo, round(r95, 6) AS ratio_hi FROM b""",
)
def a18(t):
    return _bands(t).select("key", "n", *[F.round(c, 6).alias(c) for c in ("level_median", "level_lo", "level_hi", "ratio_median", "ratio_lo", "ratio_hi")])


@query(
    "j19_band_lookup",
    f"""WITH {BANDS_SQL}, q AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Brand#' || c_custkey % 35 ELSE 'brand#' || c_custkey % 35 END AS key FROM customer)
    SELECT c_custkey, round(coalesce(CASE WHEN o.n >= 70 THEN o.lm END, d.lm), 6) AS level_median, CASE WHEN o.n >= 70 THEN 'group:' || q.key || ' (n=' || o.n || ')' ELSE 'default (n=' || d.n || ')' END AS band_source
    FROM q LEFT JOIN b o ON o.key = q.key CROSS JOIN (SELECT * FROM b WHERE key = '_default') d""",
)
def j19(t):
    k = F.col("c_custkey")
    name = F.when(k % 2 == 0, "Brand#").otherwise("brand#")
    req = t("customer").select(k, F.concat(name, (k % 35).cast("string")).alias("key"))
    out = C.band_for(req, _bands(t), min_n=70)
    return out.select("c_custkey", F.round("level_median", 6).alias("level_median"), "band_source")


DET_SQL = """d AS (SELECT doc_id, CASE WHEN contains(text, '@') OR contains(text, 'http') THEN 'auto' WHEN n_chars > 3000 THEN 'qa' ELSE 'clean' END AS verdict,
      CASE WHEN contains(text, '@') THEN 'handle' WHEN contains(text, 'http') THEN 'url' WHEN n_chars > 8000 THEN 'area_too_large' WHEN n_chars > 3000 THEN 'low_conf' ELSE 'none' END AS reason FROM documents),
    j AS (SELECT d.*, quality, toxic, CASE WHEN quality IS NULL THEN 'unlabelled' WHEN quality = 1 AND toxic = 0 THEN 'needs_none' WHEN toxic = 1 THEN 'wrong_edit' ELSE 'other' END AS label FROM d LEFT JOIN labels USING (doc_id))"""


def detections(t):
    """Detector verdicts over documents with the reviewer's label attached."""
    has, url = F.contains("text", F.lit("@")), F.contains("text", F.lit("http"))
    d = t("documents").select(
        "doc_id",
        F.when(has | url, "auto").when(F.col("n_chars") > 3000, "qa").otherwise("clean").alias("verdict"),
        F.when(has, "handle").when(url, "url").when(F.col("n_chars") > 8000, "area_too_large").when(F.col("n_chars") > 3000, "low_conf").otherwise("none").alias("reason"),
    )
    label = (
        F.when(F.col("quality").isNull(), "unlabelled").when((F.col("quality") == 1) & (F.col("toxic") == 0), "needs_none")
        .when(F.col("toxic") == 1, "wrong_edit").otherwise("other")
    )
    return d.join(t("labels"), "doc_id", "left").withColumn("label", label)


@query(
    "j20_detector_census",
    f"""WITH {DET_SQL} SELECT doc_id, label, verdict, label = 'needs_none' AND verdict = 'auto' AS false_positive FROM j""",
)
def j20(t):
    return C.detector_census(detections(t)).select("doc_id", "label", "verdict", "false_positive")


@query(
    "a04_label_verdict",
    f"""WITH {DET_SQL} SELECT label, count(*) FILTER (verdict = 'auto') AS auto, count(*) FILTER (verdict = 'qa') AS qa, count(*) FILTER (verdict = 'clean') AS clean, count(*) FILTER (verdict IS NULL OR verdict NOT IN ('auto', 'qa', 'clean')) AS other, count(*) FILTER (label = 'needs_none' AND verdict = 'auto') AS false_positives FROM j GROUP BY label""",
)
def a04(t):
    return C.cross_tab(C.detector_census(detections(t)))


@query(
    "a05_precision_wilson",
    f"""WITH {DET_SQL}, g AS (SELECT reason, count(*) AS n, count(*) FILTER (quality = 0) AS tp FROM j WHERE verdict <> 'clean' AND quality IS NOT NULL GROUP BY reason)
    SELECT reason, n, tp, round(tp / n, 6) AS prec, round((tp / n + 3.8416 / (2 * n) - 1.96 * sqrt(tp / n * (1 - tp / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS lo,
      round((tp / n + 3.8416 / (2 * n) + 1.96 * sqrt(tp / n * (1 - tp / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS hi FROM g""",
)
def a05(t):
    d = detections(t).filter("verdict <> 'clean' and quality is not null").withColumn("hit", F.col("quality") == 0)
    p = C.precision_by(d, "reason", F.col("hit"))
    return p.select("reason", "n", "tp", F.round("precision", 6).alias("prec"), F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query(
    "a06_recall_stratum",
    f"""WITH {DET_SQL}, g AS (SELECT reason, count(*) AS size, count(quality) AS reviewed, count(*) FILTER (quality = 0) AS misses FROM j GROUP BY reason)
    SELECT reason, size, reviewed, misses, round(CASE WHEN reviewed > 0 THEN misses / reviewed * size ELSE 0 END, 6) AS estimated, round(CASE WHEN reviewed > 0 THEN misses / reviewed ELSE 0 END, 6) AS rate FROM g""",
)
def a06(t):
    d = detections(t)
    sizes = d.groupBy("reason").agg(F.count("*").alias("size"))
    r = C.recall_by_stratum(d.filter("quality is not null"), sizes, "reason", F.col("quality") == 0)
    return r.select("reason", "size", "reviewed", "misses", F.round("estimated", 6).alias("estimated"), F.round("rate", 6).alias("rate"))


@query(
    "j21_retry_compare",
    """WITH b AS (SELECT * FROM v_versions WHERE l_linenumber = 1 AND halo_pct > 0), w AS (SELECT * FROM v_versions WHERE l_linenumber > 1 AND halo_pct > 0)
    SELECT w.l_linenumber AS version, count(*) AS n, count(*) FILTER (w.msssim > b.msssim) AS better, count(*) FILTER (w.msssim < b.msssim) AS worse, count(*) FILTER (w.msssim = b.msssim) AS tie,
      round(avg(w.halo_pct / b.halo_pct), 6) AS area_ratio, count(*) FILTER (w.lpips < b.lpips) AS moved_further FROM w JOIN b USING (l_orderkey) GROUP BY 1""",
)
def j21(t):
    v = views.v_versions(t).select(
        F.col("l_orderkey").alias("slug"), F.col("l_linenumber").alias("version"), F.col("msssim").alias("seam"),
        F.col("lpips").alias("change"), F.col("halo_pct").alias("edit_pct"), (F.col("halo_pct") <= 0).alias("excluded"),
    )
    r = C.retry_compare(v)
    return r.withColumn("area_ratio", F.round("area_ratio", 6))


@query(
    "j22_monotone_upsert",
    """WITH e AS (SELECT user_id, event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "at", event_type, value, CASE user_id % 10 WHEN 3 THEN 1 WHEN 4 THEN 0 ELSE event_id % 2 END AS half FROM events),
    g AS (SELECT user_id, half, arg_max(event_type, event_id) AS kind, count(*) AS events, CAST(sum(floor(value)) AS BIGINT) AS tok, min("at") AS s, max("at") AS l FROM e GROUP BY ALL)
    SELECT user_id, coalesce(n.kind, o.kind) AS kind, greatest(o.events, n.events) AS events, greatest(o.tok, n.tok) AS output_tokens, greatest(o.l, n.l) AS last_event, least(o.s, n.s) AS start,
      CASE WHEN o.user_id IS NOT NULL THEN 'first' ELSE 'second' END AS first_seen FROM (SELECT * FROM g WHERE half = 0) o FULL JOIN (SELECT * FROM g WHERE half = 1) n USING (user_id)""",
)
def j22(t):
    e = t("events").select("user_id", "event_id", F.floor(views.epoch_us("ts") / 1_000_000).alias("at"), "event_type", "value")
    # some users are in one half only
    ten = F.col("user_id") % 10
    half = F.when(ten == 3, 1).when(ten == 4, 0).otherwise(F.col("event_id") % 2)

    def mirror(part, seen):
        return e.filter(half == part).groupBy("user_id").agg(
            F.max_by("event_type", "event_id").alias("kind"), F.count("*").alias("events"), F.sum(F.floor("value")).alias("output_tokens"),
            F.min("at").alias("start"), F.max("at").alias("last_event"), F.lit(seen).alias("first_seen"),
        )

    return R.merge_monotone(mirror(0, "first"), mirror(1, "second"), "user_id", ["kind"])


@query(
    "j23_attribution",
    """WITH a AS (SELECT doc_id, doc_id % 4 = 0 AS pref, lower(text || ' B' || doc_id % 30 || '-x') AS txt FROM documents), s AS (SELECT 'B' || n_nationkey AS slice FROM nation),
    h AS (SELECT slice, doc_id, row_number() OVER (PARTITION BY slice ORDER BY NOT pref, doc_id) AS r FROM s JOIN a ON regexp_matches(txt, '(^|[^0-9a-z])' || lower(slice) || '([^0-9a-z]|$)'))
    SELECT slice, doc_id AS agent, true AS hint FROM h WHERE r = 1""",
)
def j23(t):
    text = F.concat("text", F.lit(" B"), (F.col("doc_id") % 30).cast("string"), F.lit("-x"))
    agents = t("documents").select(F.col("doc_id").alias("agent"), (F.col("doc_id") % 4 == 0).alias("preferred"), text.alias("text"))
    slices = t("nation").select(F.concat(F.lit("B"), F.col("n_nationkey").cast("string")).alias("slice"))
    return K.attribute(slices, agents)


@query(
    "j24_dangling_refs",
    """WITH r AS (SELECT doc_id + CASE WHEN doc_id % 5 = 0 THEN 100000000 ELSE 0 END AS ref_id, CASE WHEN quality = 1 THEN doc_id % 50 END AS line, toxic = 1 AS unv FROM labels),
    d AS (SELECT doc_id AS ref_id, len(string_split(text, chr(10))) AS n FROM documents)
    SELECT 'unverified' AS kind, ref_id FROM r WHERE unv UNION ALL SELECT 'missing', ref_id FROM r WHERE NOT unv AND ref_id NOT IN (SELECT ref_id FROM d)
    UNION ALL SELECT 'uncited', ref_id FROM d WHERE ref_id NOT IN (SELECT ref_id FROM r) UNION ALL SELECT 'missing_line', ref_id FROM r JOIN d USING (ref_id) WHERE NOT unv AND line > n""",
)
def j24(t):
    k = F.col("doc_id")
    refs = t("labels").select(
        (k + F.when(k % 5 == 0, 100_000_000).otherwise(0)).alias("ref_id"), F.when(F.col("quality") == 1, k % 50).alias("line"), (F.col("toxic") == 1).alias("unverified")
    )
    targets = t("documents").select(k.alias("ref_id"), F.size(F.split("text", "\n")).alias("n_lines"))
    return K.dangling_refs(refs, targets)
