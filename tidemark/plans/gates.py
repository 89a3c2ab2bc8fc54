"""Gate, routing and grading queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import gates as G
from tidemark.functions import geometry as geo
from tidemark.functions.pricing import token_price
from tidemark.operators import presets, thresholds
from tidemark.plans import views
from tidemark.plans.registry import query

METRICS = ("msssim", "lpips", "lap_ratio", "halo_pct", "band_delta")

STATES_SQL = """
    CASE WHEN msssim IS NULL OR msssim >= 0.98 THEN 0 WHEN msssim < 0.96 THEN 2 ELSE 1 END AS r1,
    CASE WHEN lpips IS NULL OR lpips <= 0.12 THEN 0 WHEN lpips > 0.20 THEN 2 ELSE 1 END AS r2,
    CASE WHEN backend = 'downscale-only' OR lap_ratio IS NULL OR lap_ratio >= 1.0 THEN 0 ELSE 2 END AS r3,
    CASE WHEN halo_pct > 0.05 THEN 1 ELSE 0 END AS r4,
    CASE WHEN band_delta > 0.05 THEN 1 ELSE 0 END AS r5"""

VERDICT_SQL = f"""
  SELECT *, ['PASS','FLAG','FAIL'][greatest(r1, r2, r3, r4, r5) + 1] AS verdict,
    array_to_string(list_filter([
      CASE WHEN r1 > 0 THEN 'msssim:' || ['PASS','FLAG','FAIL'][r1 + 1] END,
      CASE WHEN r2 > 0 THEN 'lpips:' || ['PASS','FLAG','FAIL'][r2 + 1] END,
      CASE WHEN r3 > 0 THEN 'lap_ratio:' || ['PASS','FLAG','FAIL'][r3 + 1] END,
      CASE WHEN r4 > 0 THEN 'halo_pct:FLAG' END,
      CASE WHEN r5 > 0 THEN 'band_delta:FLAG' END], lambda x: x IS NOT NULL), ';') AS reasons
  FROM (SELECT *, {STATES_SQL} FROM v_metrics) s"""


def gated(t):
    """Every metric row with its backend-conditioned verdict."""
    m = views.v_metrics(t)
    cols = G.gated_metrics({c: F.col(c) for c in METRICS}, F.col("backend"))
    return m.withColumn("_g", G.gate_verdict(cols)).select(
        "*", F.col("_g.verdict").alias("verdict"), F.array_join("_g.reasons", ";").alias("reasons")
    ).drop("_g")


@query(
    "metric_census",
    f"""SELECT variant, count(*) AS measured, count(*) FILTER (halo_pct > 0.05) AS over_line,
      min(halo_pct) AS min_halo, max(halo_pct) AS max_halo,
      count(*) FILTER (verdict = 'PASS') AS n_pass, count(*) FILTER (verdict = 'FLAG') AS n_flag,
      count(*) FILTER (verdict = 'FAIL') AS n_fail
    FROM ({VERDICT_SQL}) g GROUP BY variant""",
)
def metric_census(t):
    return gated(t).groupBy("variant").agg(
        F.count("halo_pct").alias("measured"),
        F.count_if(F.col("halo_pct") > 0.05).alias("over_line"),
        F.min("halo_pct").alias("min_halo"),
        F.max("halo_pct").alias("max_halo"),
        *[F.count_if(F.col("verdict") == s).alias(f"n_{s.lower()}") for s in ("PASS", "FLAG", "FAIL")],
    )


def _corners():
    return [F.coalesce(f"a.{s}", F.lit(-1)).cast("long").alias(f"box_{s}") for s in ("left", "top", "right", "bottom")]


@query(
    "p12_aspect_class",
    """WITH d AS (SELECT p_partkey, 1200 + p_size * 40 AS w, CAST(floor(p_retailprice) AS BIGINT) AS h FROM part),
    c AS (SELECT *, CASE WHEN w / h > 2560 / 1440 THEN least(CAST(round_even(h * 16 / 9, 0) AS BIGINT), w) ELSE w END AS nw,
      CASE WHEN w / h < 2560 / 1440 THEN least(CAST(round_even(w * 9 / 16, 0) AS BIGINT), h) ELSE h END AS nh FROM d),
    e AS (SELECT *, abs(w / h - 2560 / 1440) <= 0.02 AS ok, 1.0 - CAST(nw * nh AS DOUBLE) / (w * h) AS loss FROM c)
    SELECT p_partkey, CASE WHEN ok THEN 'ok' WHEN loss <= 0.08 THEN 'crop_ok' ELSE 'crop_heavy' END AS cls,
      CASE WHEN NOT ok THEN (w - nw) // 2 ELSE -1 END AS box_left, CASE WHEN NOT ok THEN (h - nh) // 2 ELSE -1 END AS box_top,
      CASE WHEN NOT ok THEN (w - nw) // 2 + nw ELSE -1 END AS box_right, CASE WHEN NOT ok THEN (h - nh) // 2 + nh ELSE -1 END AS box_bottom,
      round(CASE WHEN ok THEN 0.0 ELSE loss END, 6) AS area_loss FROM e""",
)
def p12(t):
    d = t("part").select("p_partkey", (1200 + F.col("p_size") * 40).alias("w"), F.floor("p_retailprice").alias("h"))
    return d.withColumn("a", geo.aspect_class(F.col("w"), F.col("h"))).select(
        "p_partkey",
        "a.cls",
        *_corners(),
        F.round("a.area_loss", 6).alias("area_loss"),
    )


@query(
    "p13_anchored_crop",
    """WITH d AS (SELECT p_partkey, 1200 + p_size * 40 AS w, CAST(floor(p_retailprice) AS BIGINT) AS h,
      CASE p_partkey % 4 WHEN 0 THEN ['left'] WHEN 1 THEN ['top', 'left'] WHEN 2 THEN ['right', 'bottom', 'left'] ELSE ['top', 'bottom'] END AS s FROM part),
    c AS (SELECT *, w / h > 2560 / 1440 AS wide, abs(w / h - 2560 / 1440) <= 0.02 AS near,
      least(CAST(round_even(h * 16 / 9, 0) AS BIGINT), w) AS nw, least(CAST(round_even(w * 9 / 16, 0) AS BIGINT), h) AS nh FROM d),
    e AS (SELECT *, CASE WHEN near THEN NULL
        WHEN wide AND NOT list_contains(s, 'left') AND NOT list_contains(s, 'right') THEN 'needs_left_or_right'
        WHEN NOT wide AND NOT list_contains(s, 'top') AND NOT list_contains(s, 'bottom') THEN 'needs_top_or_bottom' END AS error,
      CASE WHEN near OR NOT wide THEN 0 WHEN list_contains(s, 'left') AND list_contains(s, 'right') THEN (w - nw) // 2
        WHEN list_contains(s, 'left') THEN w - nw ELSE 0 END AS l,
      CASE WHEN near OR wide THEN 0 WHEN list_contains(s, 'top') AND list_contains(s, 'bottom') THEN (h - nh) // 2
        WHEN list_contains(s, 'top') THEN h - nh ELSE 0 END AS tp FROM c)
    SELECT p_partkey, CASE WHEN error IS NULL THEN l ELSE -1 END AS box_left, CASE WHEN error IS NULL THEN tp ELSE -1 END AS box_top,
      CASE WHEN error IS NULL THEN CASE WHEN near OR NOT wide THEN w ELSE l + nw END ELSE -1 END AS box_right,
      CASE WHEN error IS NULL THEN CASE WHEN near OR wide THEN h ELSE tp + nh END ELSE -1 END AS box_bottom, error FROM e""",
)
def p13(t):
    d = t("part").select(
        "p_partkey",
        (1200 + F.col("p_size") * 40).alias("w"),
        F.floor("p_retailprice").alias("h"),
        F.element_at(
            F.array(
                F.array(F.lit("left")),
                F.array(F.lit("top"), F.lit("left")),
                F.array(F.lit("right"), F.lit("bottom"), F.lit("left")),
                F.array(F.lit("top"), F.lit("bottom")),
            ),
            (F.col("p_partkey") % 4 + 1).cast("int"),
        ).alias("s"),
    )
    return d.withColumn("a", geo.anchored_crop(F.col("w"), F.col("h"), F.col("s"))).select(
        "p_partkey", *_corners(), "a.error"
    )


@query(
    "p14_common_scale",
    """WITH d AS (SELECT p_partkey, CAST(p_size AS BIGINT) * 300 AS w, CAST(floor(p_retailprice * 3) AS BIGINT) AS h FROM part),
    r AS (SELECT *, w * h > 8294400 AS capped, sqrt(8294400.0::DOUBLE / (w * h)) AS f FROM d)
    SELECT p_partkey, CASE WHEN capped THEN greatest(1, CAST(trunc(w * f) AS BIGINT)) ELSE w END AS common_w,
      CASE WHEN capped THEN greatest(1, CAST(trunc(h * f) AS BIGINT)) ELSE h END AS common_h, capped FROM r""",
)
def p14(t):
    d = t("part").select("p_partkey", (F.col("p_size") * 300).alias("w"), F.floor(F.col("p_retailprice") * 3).alias("h"))
    return d.withColumn("a", geo.common_scale(F.col("w"), F.col("h"))).select(
        "p_partkey", F.col("a.w").alias("common_w"), F.col("a.h").alias("common_h"), F.col("a.capped").alias("capped")
    )


@query(
    "p15_tri_state",
    """SELECT asset, CASE WHEN msssim >= 0.98 THEN 'PASS' WHEN msssim < 0.96 THEN 'FAIL' ELSE 'FLAG' END AS higher_better,
      CASE WHEN lpips <= 0.12 THEN 'PASS' WHEN lpips > 0.2 THEN 'FAIL' ELSE 'FLAG' END AS lower_better,
      CASE WHEN lap_ratio < 1.0 THEN 'FAIL' ELSE 'PASS' END AS floor_rule,
      CASE WHEN halo_pct > 0.05 THEN 'FLAG' ELSE 'PASS' END AS flag_over,
      CASE WHEN band_delta > 0.07 THEN 'FAIL' ELSE 'PASS' END AS fail_over FROM v_metrics""",
)
def p15(t):
    return views.v_metrics(t).select(
        "asset",
        G.tri("higher_better", F.col("msssim"), G.THRESHOLDS["msssim"]).alias("higher_better"),
        G.tri("lower_better", F.col("lpips"), G.THRESHOLDS["lpips"]).alias("lower_better"),
        G.tri("floor", F.col("lap_ratio"), G.THRESHOLDS["lap_ratio"]).alias("floor_rule"),
        G.tri("flag_over", F.col("halo_pct"), G.THRESHOLDS["halo_pct"]).alias("flag_over"),
        G.tri("fail_over", F.col("band_delta"), {"fail": 0.07}).alias("fail_over"),
    )


@query("p16_gate_verdict", f"SELECT asset, verdict, reasons FROM ({VERDICT_SQL}) g")
def p16(t):
    return gated(t).select("asset", "verdict", "reasons")


@query(
    "p17_gate_metrics",
    """SELECT asset, backend, msssim, lpips, CASE WHEN backend <> 'downscale-only' THEN lap_ratio END AS lap_ratio,
      halo_pct, band_delta FROM v_metrics""",
)
def p17(t):
    cols = G.gated_metrics({c: F.col(c) for c in METRICS}, F.col("backend"))
    return views.v_metrics(t).select("asset", "backend", *[c.alias(n) for n, c in cols.items()])


@query(
    "p18_route_ladder",
    """WITH b AS (SELECT l_orderkey AS asset, l_quantity * 40 AS x0, l_quantity * 40 + 20 + 30 * l_linenumber AS x1,
        CAST(l_partkey % 1200 AS DOUBLE) AS y0, 10 * l_discount AS conf, l_returnflag AS rf, l_linestatus AS ls, l_linenumber AS ln, l_tax FROM lineitem),
    g AS (SELECT asset, count(*) FILTER (conf >= 0.35) AS n, coalesce(max(conf) FILTER (conf >= 0.35), 0) AS conf,
        bool_or(rf = 'R' AND ln = 1) AS credit, bool_or(ls = 'F' AND ln = 2) AS keep,
        coalesce(sum((x1 - x0) * 60) FILTER (conf >= 0.35), 0) / (2560 * 1440) * 100 AS area,
        coalesce(sum((x1 - x0) * 60 * (x0 + x1) / 2) FILTER (conf >= 0.35) / sum((x1 - x0) * 60) FILTER (conf >= 0.35), 0) AS cx,
        coalesce(sum((x1 - x0) * 60 * (y0 + 30)) FILTER (conf >= 0.35) / sum((x1 - x0) * 60) FILTER (conf >= 0.35), 0) AS cy,
        max(l_tax) * 1.9 AS overlay,
        count(*) FILTER (conf >= 0.05 AND conf < 0.35 AND (x1 - x0) / 2560 >= 0.05) AS faint
      FROM b GROUP BY asset),
    r AS (SELECT *, CASE WHEN n > 0 AND credit AND area <= 8 THEN 'auto/watermark_ocr' WHEN overlay >= 0.15 THEN 'qa/centre_overlay'
      WHEN n <= 0 THEN 'clean/no_detections' WHEN keep AND NOT credit THEN 'clean/lol_logo'
      WHEN cy > 0.8 * 1440 AND conf >= 0.5 AND area <= 8 THEN 'auto/bottom_banner'
      WHEN (cx <= 256 OR cx >= 2304 OR cy <= 144 OR cy >= 1296) AND conf >= 0.5 AND area <= 2 THEN 'auto/corner_mark'
      WHEN area > 8 THEN 'qa/area_too_large' WHEN conf < 0.5 THEN 'qa/low_conf' ELSE 'qa/not_border' END AS v FROM g)
    SELECT asset, CASE WHEN v LIKE 'clean/%' AND faint > 0 THEN 'qa' ELSE split_part(v, '/', 1) END AS verdict,
      CASE WHEN v LIKE 'clean/%' AND faint > 0 THEN 'faint_mark' ELSE split_part(v, '/', 2) END AS reason FROM r""",
)
def p18(t):
    b = t("lineitem").select(
        F.col("l_orderkey").alias("asset"),
        (F.col("l_quantity") * 40).alias("x0"),
        (F.col("l_quantity") * 40 + 20 + 30 * F.col("l_linenumber")).alias("x1"),
        (F.col("l_partkey") % 1200).cast("double").alias("y0"),
        (10 * F.col("l_discount")).alias("conf"),
        "l_returnflag",
        "l_linestatus",
        "l_linenumber",
        "l_tax",
    )
    w, h = F.lit(2560.0), F.lit(1440.0)
    hit = F.col("conf") >= G.DETECT_CONF
    size = F.when(hit, (F.col("x1") - F.col("x0")) * 60)
    g = b.groupBy("asset").agg(
        F.count_if(hit).alias("n"),
        F.coalesce(F.max(F.when(hit, F.col("conf"))), F.lit(0.0)).alias("conf"),
        F.bool_or((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)).alias("credit"),
        F.bool_or((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 2)).alias("keep"),
        (F.coalesce(F.sum(size), F.lit(0.0)) / (w * h) * 100).alias("area"),
        F.coalesce(F.sum(size * (F.col("x0") + F.col("x1")) / 2) / F.sum(size), F.lit(0.0)).alias("cx"),
        F.coalesce(F.sum(size * (F.col("y0") + 30)) / F.sum(size), F.lit(0.0)).alias("cy"),
        (F.max("l_tax") * 1.9).alias("overlay"),
        F.count_if(G.is_faint(F.col("conf"), F.col("x0"), F.col("x1"), w)).alias("faint"),
    )
    c = F.col
    routed = G.route(
        c("n"), c("conf"), c("credit"), c("keep"), c("area"), c("cx"), c("cy"), w, h, c("overlay"), c("faint")
    )
    return g.select("asset", routed.alias("r")).select("asset", "r.verdict", "r.reason")


@query(
    "p19_verify_verdict",
    """WITH m AS (SELECT l_orderkey, l_linenumber, 1 - l_tax / 10 AS o, l_discount * 12 AS mad, l_quantity / 50 AS ch,
      l_quantity / 5 AS e0, l_quantity / 5 * l_discount * 10 AS e1, 1 - l_tax AS seam FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN o < 0.995 OR mad > 1 THEN 'discard' WHEN ch > 0.9 THEN 'fail'
      WHEN e0 >= 4 AND e1 > 0.45 * e0 AND e1 >= 4 THEN 'fail' ELSE 'pass' END AS verdict,
      CASE WHEN o < 0.995 OR mad > 1 THEN concat_ws(';', CASE WHEN o < 0.995 THEN 'outside_ssim' END, CASE WHEN mad > 1 THEN 'mad_outside' END)
        WHEN ch > 0.9 THEN 'no_op' WHEN e0 >= 4 AND e1 > 0.45 * e0 AND e1 >= 4 THEN 'text_residue'
        WHEN seam < 0.92 THEN 'seam' ELSE '' END AS detail FROM m""",
)
def p19(t):
    q = F.col("l_quantity")
    left = G.residue(q / 5, q / 5 * F.col("l_discount") * 10)
    v = G.verify(1 - F.col("l_tax") / 10, F.col("l_discount") * 12, q / 50, left, 1 - F.col("l_tax"))
    return t("lineitem").select("l_orderkey", "l_linenumber", v.alias("v")).select("l_orderkey", "l_linenumber", "v.*")


def _scores(t):
    e = [F.abs(F.element_at("embedding", i + 1).cast("double")) for i in range(4)]
    return t("embeddings").select(
        "vec_id",
        "label",
        (0.2 + e[0]).alias("subject"),
        e[1].alias("off"),
        (0.4 + e[2]).alias("aesthetic"),
        (80 + 400 * e[3]).alias("blur"),
    )


SCORES_SQL = """SELECT vec_id, label, 0.2 + abs(CAST(embedding[1] AS DOUBLE)) AS subject, abs(CAST(embedding[2] AS DOUBLE)) AS "off",
      0.4 + abs(CAST(embedding[3] AS DOUBLE)) AS aesthetic, 80 + 400 * abs(CAST(embedding[4] AS DOUBLE)) AS blur FROM embeddings"""


@query(
    "p20_two_stage_grade",
    f"""WITH s AS ({SCORES_SQL}),
    r AS (SELECT vec_id, CASE WHEN subject < 0.26 OR subject <= "off" THEN 'wrong_subject' WHEN subject - "off" < 0.05 THEN 'weak_margin'
      WHEN aesthetic < 0.45 THEN 'degenerate' WHEN blur < 100 THEN 'blurry' END AS reason FROM s)
    SELECT vec_id, CASE WHEN reason IS NULL THEN 'PASS' ELSE 'REJECT' END AS verdict, reason,
      (reason IS NULL OR reason IN ('degenerate', 'blurry')) AS stage_a,
      CASE WHEN reason IN ('wrong_subject', 'weak_margin') THEN 'not_run' WHEN reason IS NULL THEN 'pass' ELSE 'fail' END AS stage_b FROM r""",
)
def p20(t):
    th = {k: F.lit(v) for k, v in G.GRADE_DEFAULTS.items()}
    g = G.grade(F.col("subject"), F.col("off"), F.col("aesthetic"), F.col("blur"), th)
    stage_b = F.when(F.col("g.stage_b").isNull(), "not_run").when(F.col("g.stage_b"), "pass").otherwise("fail")
    return _scores(t).select("vec_id", g.alias("g")).select(
        "vec_id", "g.verdict", "g.reason", "g.stage_a", stage_b.alias("stage_b")
    )


@query(
    "p21_four_clause_grade",
    f"""WITH s AS ({SCORES_SQL}),
    r AS (SELECT vec_id, CASE WHEN subject < 0.22 OR subject <= "off" THEN 'weapon_offclass' WHEN subject - "off" < 0.03 THEN 'weapon_weak_margin'
      WHEN blur < 150 THEN 'weapon_mush' END AS reason FROM s)
    SELECT vec_id, CASE WHEN reason IS NULL THEN 'PASS' ELSE 'REJECT' END AS verdict, reason FROM r""",
)
def p21(t):
    g = G.grade4(F.col("subject"), F.col("off"), F.col("blur"))
    return _scores(t).select("vec_id", g.alias("g")).select("vec_id", "g.verdict", "g.reason")


@query(
    "p22_threshold_resolution",
    """WITH o AS (SELECT label, CASE WHEN label % 2 = 0 THEN round(0.2 + avg(abs(CAST(embedding[1] AS DOUBLE))), 6) END AS o1,
        CASE WHEN label % 3 = 0 THEN 90.0 + label END AS o4 FROM embeddings GROUP BY label)
    SELECT vec_id, coalesce(o1, 0.26) AS t_subj, 0.07 AS t_margin, 0.45 AS t_aes, CAST(coalesce(o4, 100.0) AS DOUBLE) AS t_blur
    FROM embeddings LEFT JOIN o USING (label)""",
)
def p22(t):
    e = t("embeddings")
    first = F.abs(F.element_at("embedding", 1).cast("double"))
    overrides = e.groupBy("label").agg(F.round(0.2 + F.avg(first), 6).alias("a")).select(
        "label",
        F.when(F.col("label") % 2 == 0, F.col("a")).alias("T_subj"),
        F.when(F.col("label") % 3 == 0, F.lit(90.0) + F.col("label")).alias("T_blur"),
    )
    out = thresholds.resolve(e, overrides, ["label"], G.GRADE_DEFAULTS, {"T_margin": 0.07})
    return out.select("vec_id", *[F.col(k).alias(k.lower()) for k in G.GRADE_DEFAULTS])


@query(
    "p23_intake_eligibility",
    """WITH a AS (SELECT doc_id, ['.png', '.jpg', '.crdownload', '.gif', '.webp', '.JPEG', '.tmp'][doc_id % 7 + 1] AS ext,
        CASE WHEN doc_id % 11 = 0 THEN 0 ELSE n_chars END AS size, doc_id % 30 AS age FROM documents)
    SELECT doc_id, CASE WHEN lower(ext) IN ('.crdownload', '.part', '.tmp', '.download') THEN 'partial-download extension'
      WHEN lower(ext) NOT IN ('.png', '.jpg', '.jpeg', '.webp') THEN 'unsupported extension' WHEN size = 0 THEN 'zero-byte file'
      WHEN age < 10 THEN 'modified too recently (still downloading?)' WHEN doc_id % 13 = 0 THEN 'size still changing' END AS reason FROM a""",
)
def p23(t):
    ext = F.element_at(
        F.array(*[F.lit(x) for x in (".png", ".jpg", ".crdownload", ".gif", ".webp", ".JPEG", ".tmp")]),
        (F.col("doc_id") % 7 + 1).cast("int"),
    )
    first = t("documents").select(
        "doc_id",
        F.concat(F.lit("f"), F.col("doc_id").cast("string"), ext).alias("name"),
        F.when(F.col("doc_id") % 11 == 0, 0).otherwise(F.col("n_chars")).alias("size"),
        (1000 - F.col("doc_id") % 30).cast("double").alias("mtime"),
    )
    second = first.select("name", (F.col("size") + (F.col("doc_id") % 13 == 0).cast("long")).alias("size"))
    return thresholds.eligibility(first, second, now=1000.0).select("doc_id", "reason")


@query(
    "p24_blocking_flags",
    """SELECT l_orderkey, l_linenumber, array_to_string(list_sort(list_distinct(list_filter(
      ['anat_' || l_returnflag, 'halo_' || l_linestatus, 'anat_' || l_linestatus, 'anat_' || l_returnflag],
      lambda x: starts_with(x, 'anat_')))), ';') AS blocking FROM lineitem""",
)
def p24(t):
    r = F.array(
        F.concat(F.lit("anat_"), "l_returnflag"),
        F.concat(F.lit("halo_"), "l_linestatus"),
        F.concat(F.lit("anat_"), "l_linestatus"),
        F.concat(F.lit("anat_"), "l_returnflag"),
    )
    return t("lineitem").select("l_orderkey", "l_linenumber", F.array_join(G.blocking_flags(r), ";").alias("blocking"))


@query(
    "p25_verdict_clamp",
    """WITH e AS (SELECT seq, CASE WHEN op IN ('SAVE_WORKING', 'SUBMIT') THEN 'vision-anat' ELSE 'G1' END AS gate,
      ['PASS', 'FLAG', 'FAIL', 'REJECT'][ver % 4 + 1] AS v FROM v_transitions)
    SELECT seq, gate, CASE WHEN gate = 'vision-anat' AND v IN ('REJECT', 'FAIL') THEN 'FLAG' ELSE v END AS verdict,
      CASE WHEN gate = 'vision-anat' AND v IN ('REJECT', 'FAIL') THEN v END AS clamped_from FROM e""",
)
def p25(t):
    e = views.v_transitions(t).select(
        "seq",
        F.when(F.col("op").isin("SAVE_WORKING", "SUBMIT"), "vision-anat").otherwise("G1").alias("gate"),
        F.element_at(F.array(*[F.lit(x) for x in ("PASS", "FLAG", "FAIL", "REJECT")]), F.col("ver") % 4 + 1).alias("v"),
    )
    return e.select("seq", "gate", G.clamp(F.col("gate"), F.col("v")).alias("c")).select("seq", "gate", "c.*")


@query(
    "p46_token_price",
    """WITH u AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'opus' WHEN 'click' THEN 'sonnet' WHEN 'error' THEN 'haiku' ELSE 'default' END AS m,
      floor(value * 1000) AS i, floor(value * 100) AS o, floor(value * 10) AS cw, floor(value * 5000) AS cr FROM events),
    r AS (SELECT * FROM (VALUES ('opus', 15.0, 75.0, 18.75, 1.5), ('sonnet', 3.0, 15.0, 3.75, 0.3), ('haiku', 1.0, 5.0, 1.25, 0.1), ('default', 15.0, 75.0, 18.75, 1.5)) v(m, pi, po, pw, pr))
    SELECT event_id, round(CAST(i * CAST(pi AS DOUBLE) + o * CAST(po AS DOUBLE) + cw * CAST(pw AS DOUBLE) + cr * CAST(pr AS DOUBLE) AS DOUBLE) / 1000000, 8) AS usd FROM u JOIN r USING (m)""",
)
def p46(t):
    model = (
        F.when(F.col("event_type") == "view", "x-opus-1")
        .when(F.col("event_type") == "click", "x-Sonnet-2")
        .when(F.col("event_type") == "error", "x-haiku")
        .otherwise("other")
    )
    v = F.col("value")
    usd = token_price(model, F.floor(v * 1000), F.floor(v * 100), F.floor(v * 10), F.floor(v * 5000))
    return t("events").select("event_id", F.round(usd, 8).alias("usd"))


@query(
    "p47_band_membership",
    """WITH m AS (SELECT l_orderkey, l_linenumber, l_quantity AS lv, CASE WHEN l_tax > 0 THEN l_discount * 15 END AS r FROM lineitem)
    SELECT l_orderkey, l_linenumber, coalesce(lv BETWEEN -3 AND 45 AND r BETWEEN 0.64 AND 1.26, false) AS in_band,
      CASE WHEN r IS NULL THEN 'inf' ELSE 'finite' END AS kind, round(abs(lv - 24.3) + 30.0 * abs(r - 0.83), 6) AS distance FROM m""",
)
def p47(t):
    level, ratio = F.col("l_quantity"), F.when(F.col("l_tax") > 0, F.col("l_discount") * 15)
    d = G.band_distance(level, ratio)
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.coalesce(level.between(-3.0, 45.0) & ratio.between(0.64, 1.26), F.lit(False)).alias("in_band"),
        F.when(d == float("inf"), "inf").otherwise("finite").alias("kind"),
        F.when(d < float("inf"), F.round(d, 6)).alias("distance"),
    )


@query(
    "p48_disposition",
    """WITH m AS (SELECT l_orderkey, l_linenumber, ['auto', 'qa', 'clean'][l_linenumber % 3 + 1] AS v, l_tax >= 0.08 AS bad,
      l_returnflag <> 'R' AS cmds, CASE WHEN l_discount > 0.08 THEN 3 WHEN l_discount < 0.01 THEN 1 ELSE 0 END AS rc FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN v <> 'clean' AND bad THEN 'error' WHEN v = 'qa' OR (v = 'auto' AND NOT cmds) THEN 'queued-qa'
      WHEN rc = 3 THEN 'refused' WHEN rc <> 0 THEN 'failed' ELSE 'done' END AS status FROM m""",
)
def p48(t):
    v = F.element_at(F.array(F.lit("auto"), F.lit("qa"), F.lit("clean")), F.col("l_linenumber") % 3 + 1)
    rc = F.when(F.col("l_discount") > 0.08, 3).when(F.col("l_discount") < 0.01, 1).otherwise(0)
    status = G.dispose(v, F.col("l_tax") >= 0.08, F.col("l_returnflag") != "R", rc)
    return t("lineitem").select("l_orderkey", "l_linenumber", status.alias("status"))


@query(
    "p49_preset_resolution",
    """WITH c AS (SELECT c_custkey, n_name AS slug, CASE WHEN c_custkey % 3 = 0 THEN r_name END AS cluster,
        CASE WHEN c_custkey % 10 = 0 THEN 'frame-x' END AS ex, CASE WHEN c_custkey % 15 = 0 THEN 77 END AS ec
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    cp AS (SELECT r_name AS cluster, 'c-' || r_name AS cr, r_regionkey * 10 AS cc FROM region WHERE r_regionkey < 3),
    sp AS (SELECT n_name AS slug, 's-' || n_name AS sr, n_nationkey AS sc FROM nation WHERE n_nationkey % 4 = 0)
    SELECT c_custkey, CASE WHEN ex IS NOT NULL OR ec IS NOT NULL THEN coalesce(ex, cr, sr, 'default') WHEN c.cluster IS NOT NULL THEN coalesce(cr, 'default')
        ELSE coalesce(sr, 'default') END AS preset,
      CAST(coalesce(CASE WHEN ex IS NOT NULL OR ec IS NOT NULL THEN CASE WHEN ec IS NOT NULL THEN ec WHEN c.cluster IS NOT NULL THEN cc ELSE sc END
        WHEN c.cluster IS NOT NULL THEN cc ELSE sc END, -1) AS BIGINT) AS chroma,
      CASE WHEN ex IS NOT NULL OR ec IS NOT NULL THEN 'explicit' WHEN c.cluster IS NOT NULL THEN 'cluster' WHEN sr IS NOT NULL THEN 'slug' ELSE 'default' END AS layer
    FROM c LEFT JOIN cp ON c.cluster = cp.cluster LEFT JOIN sp USING (slug)""",
)
def p49(t):
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "c_custkey",
        F.col("n_name").alias("slug"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("r_name")).alias("cluster"),
        F.when(F.col("c_custkey") % 10 == 0, "frame-x").alias("preset"),
        F.when(F.col("c_custkey") % 15 == 0, F.lit(77).cast("long")).alias("chroma"),
    )
    clusters = t("region").filter("r_regionkey < 3").select(
        F.col("r_name").alias("cluster"), F.concat(F.lit("c-"), "r_name").alias("preset"),
        (F.col("r_regionkey") * 10).cast("long").alias("chroma"),
    )
    items = t("nation").filter("n_nationkey % 4 = 0").select(
        F.col("n_name").alias("slug"), F.concat(F.lit("s-"), "n_name").alias("preset"),
        F.col("n_nationkey").cast("long").alias("chroma"),
    )
    return presets.resolve(c, clusters, items, "default").select(
        "c_custkey", "preset", F.coalesce("chroma", F.lit(-1)).alias("chroma"), "layer"
    )
