"""Census and document-statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import geometry as geo
from tidemark.functions import text as X
from tidemark.operators import censuses as C
from tidemark.plans import views
from tidemark.plans.geometry import KP_SQL
from tidemark.plans.registry import query
from tidemark.plans.texts import PLANT_SQL, planted


@query(
    "a02_threshold_crossings",
    """SELECT variant, count(*) FILTER (halo_pct > 0.05) AS over_line, count(*) AS measured, max(halo_pct) AS max, min(halo_pct) AS min FROM v_metrics WHERE l_linenumber <> 7 GROUP BY variant""",
)
def a02(t):
    m = views.v_metrics(t)
    raw = F.when(F.col("l_linenumber") == 7, "ERR measuring").otherwise(F.col("halo_pct").cast("string"))
    return C.crossings(m.withColumn("raw", raw), "variant", "raw", 0.05)


@query(
    "a03_metric_distribution",
    """WITH l AS (UNPIVOT (SELECT variant, msssim, lpips, lap_ratio, halo_pct FROM v_metrics) ON msssim, lpips, lap_ratio, halo_pct INTO NAME metric VALUE v)
    SELECT variant, metric, count(*) AS measured, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, CASE WHEN metric = 'msssim' THEN 'min' ELSE 'max' END AS worse_is FROM l GROUP BY variant, metric""",
)
def a03(t):
    return C.fidelity_summary(views.v_metrics(t), "variant", ["msssim", "lpips", "lap_ratio", "halo_pct"])


@query(
    "a16_phrase_counts",
    """WITH d AS (SELECT doc_id, lower(text) AS s, source < 'src5' AS in_window FROM documents)
    SELECT in_window, CAST(sum(len(regexp_extract_all(s, 'the of|of the|en la'))) AS BIGINT) AS stale_state, CAST(sum(len(regexp_extract_all(s, 'und [a-z]+ der'))) AS BIGINT) AS premise, CAST(sum(len(regexp_extract_all(s, 'la [a-zé]+ que|que la'))) AS BIGINT) AS noop, max(doc_id) FILTER (regexp_matches(s, 'the of|of the|en la')) AS latest_stale_state, max(doc_id) FILTER (regexp_matches(s, 'und [a-z]+ der')) AS latest_premise, max(doc_id) FILTER (regexp_matches(s, 'la [a-zé]+ que|que la')) AS latest_noop, max(doc_id) AS latest_item, count(*) AS blocks FROM d GROUP BY in_window""",
)
def a16(t):
    phrases = {"stale_state": "the of|of the|en la", "premise": "und [a-z]+ der", "noop": "la [a-zé]+ que|que la"}
    return C.phrase_counts(t("documents"), F.expr("source < 'src5'").alias("in_window"), "doc_id", F.lower("text"), phrases)


@query(
    "a17_distribution_profile",
    """SELECT count(*) AS n, min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS stdev, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
      round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem""",
)
def a17(t):
    p = C.profile(t("lineitem").select("l_extendedprice"), "l_extendedprice")
    return p.select("n", "min", "max", *[F.round(c, 4).alias(c) for c in ("mean", "stdev", "p25", "median", "p75", "p90", "p95")])


GROUP_SQL = "CASE WHEN reason IN ('spine_point_low_conf', 'spine_point_missing', 'no_head_points') THEN 'confidence' WHEN reason IS NULL THEN 'measured' ELSE 'geometry' END"


@query(
    "a19_state_groups",
    f"""WITH {KP_SQL}, f AS (SELECT r.vec_id, vec_id // 2 AS image, reason FROM r), sg AS (SELECT unnest(['measured', 'confidence', 'geometry', 'other', 'no_metrics']) AS grp),
    i AS (SELECT image, count(*) AS n FROM f GROUP BY image)
    SELECT grp AS state_group, (SELECT count(*) FROM f WHERE {GROUP_SQL} = grp) AS figures, (SELECT count(*) FROM i) AS images, (SELECT count(*) FROM i WHERE n > 1) AS multi_figure FROM sg""",
)
def a19(t):
    o = views.v_keypoints(t).select((F.floor(F.col("vec_id") / 2)).alias("image"), geo.axis_offset(F.col("kp"))["reason"].alias("reason"))
    group = (
        F.when(F.col("reason").isNull(), "measured")
        .when(F.col("reason").isin("spine_point_missing", "spine_point_low_conf", "no_head_points"), "confidence").otherwise("geometry")
    )
    counts = o.groupBy(group.alias("state_group")).agg(F.count("*").alias("figures"))
    per_image = o.groupBy("image").agg(F.count("*").alias("n")).agg(F.count("*").alias("images"), F.count_if(F.col("n") > 1).alias("multi_figure"))
    dim = t.spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in ("measured", "confidence", "geometry", "other", "no_metrics")])).alias("state_group"))
    return dim.join(counts, "state_group", "left").fillna(0, ["figures"]).join(per_image)


@query(
    "a20_weak_joints",
    """SELECT ['left_shoulder', 'right_shoulder', 'left_hip', 'right_hip', 'nose', 'left_ear', 'right_ear'][joint + 1] AS joint, count(*) AS n FROM v_keypoints WHERE conf < 0.3 GROUP BY joint""",
)
def a20(t):
    weak = F.explode(geo.low_conf_joints(F.col("kp"), views.JOINTS))
    return views.v_keypoints(t).select(weak.alias("joint")).groupBy("joint").agg(F.count("*").alias("n"))


@query(
    "a24_hygiene_report",
    f"""WITH p AS (SELECT *, doc_id % 3 = 0 AS hit FROM ({PLANT_SQL}) x)
    SELECT source, lang, count(*) FILTER (hit) AS files_hit, count(*) FILTER (hit) AS variant_a, count(*) FILTER (hit) AS variant_b, count(*) FILTER (hit AND (source = 'src3' OR lang = 'de')) AS frozen FROM p GROUP BY source, lang HAVING count(*) FILTER (hit) > 0""",
)
def a24(t):
    p = planted(t).withColumn("r", X.repair_mojibake(F.col("body")))
    hit = (F.col("r.variant_a") + F.col("r.variant_b")) > 0
    return p.filter(hit).groupBy("source", "lang").agg(
        F.count("*").alias("files_hit"), F.sum("r.variant_a").alias("variant_a"), F.sum("r.variant_b").alias("variant_b"), F.count_if((F.col("source") == "src3") | (F.col("lang") == "de")).alias("frozen")
    )


@query(
    "a24_hygiene_top",
    f"""SELECT doc_id, CAST((length(body) - length(replace(body, chr(9472), ''))) AS BIGINT) AS hits FROM ({PLANT_SQL}) p ORDER BY hits DESC, doc_id LIMIT 20""",
)
def a24_top(t):
    return planted(t).select("doc_id", X.count_of(F.col("body"), X.RULE_GLYPH).alias("hits")).orderBy(F.col("hits").desc(), "doc_id").limit(20)


COUNT_WORDS = {"three": 3, "five": 5, "ten": 10, "twelve": 12, "fifteen": 15, "twenty": 20}


@query(
    "a27_counted_claims",
    """SELECT doc_id, [3, 5, 10][doc_id % 3 + 1] AS claimed, doc_id % 7 AS listed FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 7 <> 0 AND doc_id % 7 <> [3, 5, 10][doc_id % 3 + 1]""",
)
def a27(t):
    from tidemark.operators.documents import count_claims

    word = F.element_at(F.array(F.lit("three"), F.lit("Five"), F.lit("ten")), (F.col("doc_id") % 3 + 1).cast("int"))
    head = F.when(F.col("doc_id") % 4 == 0, "none stated").otherwise(F.concat(F.lit("The "), word, F.lit(" most recent")))
    body = F.concat("text", F.lit("\n"), head, F.repeat(F.lit("\n- 1.2.3 -> x"), (F.col("doc_id") % 7).cast("int")))
    return count_claims(t("documents").select("doc_id", body.alias("body")), "doc_id", "body", COUNT_WORDS)


@query(
    "a31_status_tally",
    """SELECT status, n FROM (SELECT 'DONE' AS status, count(*) FILTER (doc_id % 5 IN (0, 1)) AS n FROM documents UNION ALL SELECT 'OPEN', count(*) FILTER (doc_id % 5 = 2) + count(*) FILTER (doc_id % 5 = 1) FROM documents
      UNION ALL SELECT 'WIP', count(*) FILTER (doc_id % 5 = 3) FROM documents UNION ALL SELECT 'open_bullet', count(*) FILTER (doc_id % 3 = 0) FROM documents) x WHERE n > 0""",
)
def a31(t):
    from tidemark.operators.documents import status_tally

    cells = F.element_at(
        F.array(*[F.lit(x) for x in ("| DONE |", "| DONE | x |  OPEN |", "|OPEN|", "| WIP |", "| LATER |")]), (F.col("doc_id") % 5 + 1).cast("int")
    )
    body = F.concat("text", F.lit("\n"), cells, F.when(F.col("doc_id") % 3 == 0, "\n- step NEXT up").otherwise("\n- step x"))
    return status_tally(t("documents").select(body.alias("body")), "body")


@query(
    "a38_source_adequacy",
    """WITH a AS (SELECT p_brand, CASE WHEN p_partkey % 12 <> 0 THEN 800 + p_size * 60 END AS w, CAST(floor(p_retailprice * 1.4) AS BIGINT) AS h FROM part)
    SELECT p_brand, count(*) AS manifests, count(w) AS audited, count(*) FILTER (w < 2560 OR (w IS NOT NULL AND h < 1440)) AS under_target, round(max(greatest(2560 / w, 1440 / h)), 6) AS worst_upscale FROM a GROUP BY p_brand""",
)
def a38(t):
    from tidemark.operators.documents import adequacy

    d = t("part").select(
        "p_brand", F.when(F.col("p_partkey") % 12 != 0, 800 + F.col("p_size") * 60).alias("w"), F.floor(F.col("p_retailprice") * 1.4).alias("h")
    )
    return adequacy(d, "p_brand").withColumn("worst_upscale", F.round("worst_upscale", 6))


@query(
    "a41_localizer_fallbacks",
    """WITH s AS (SELECT label % 2 AS backend, joint % 2 AS side_n, vec_id, min(conf) AS c FROM v_keypoints WHERE joint < 4 GROUP BY ALL),
    r AS (SELECT CASE WHEN backend = 0 THEN 'a' ELSE 'b' END AS backend, CASE WHEN side_n = 0 THEN 'left' ELSE 'right' END AS side, CASE WHEN c < 0.1 THEN 'missing_wrist' WHEN c < 0.3 THEN 'low_conf' ELSE 'none' END AS fallback FROM s)
    SELECT backend, side, fallback, fallback = 'none' AS ok, count(*) AS n FROM r GROUP BY ALL""",
)
def a41(t):
    from tidemark.operators.documents import localizer_summary

    kp = F.col("kp")
    rows = views.v_keypoints(t).select(
        F.when(F.col("label") % 2 == 0, "a").otherwise("b").alias("backend"),
        F.explode(F.create_map(*[x for s in ("left", "right") for x in (F.lit(s), F.least(kp[f"{s}_shoulder"]["conf"], kp[f"{s}_hip"]["conf"]))])).alias("side", "c"),
    )
    return localizer_summary(rows)
