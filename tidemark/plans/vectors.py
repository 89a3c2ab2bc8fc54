"""Embedding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import gates as G
from tidemark.operators import vectors as V
from tidemark.plans.gates import SCORES_SQL, _scores
from tidemark.plans.registry import query

UNIT_SQL = """u AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE))))) AS u FROM embeddings)"""


@query(
    "a21_self_similarity",
    f"""WITH {UNIT_SQL} SELECT a.label, (SELECT count(*) FROM embeddings e WHERE e.label = a.label) AS n, round(avg(list_inner_product(a.u, b.u)), 6) AS mean_cos FROM u a JOIN u b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY a.label""",
)
def a21(t):
    return V.self_similarity(t("embeddings"), "label", "embedding").withColumn("mean_cos", F.round("mean_cos", 6))


@query(
    "a22_cross_items",
    f"""WITH {UNIT_SQL} SELECT a.vec_id, round(avg(list_inner_product(a.u, b.u)), 6) AS mean_cos FROM u a, u b WHERE a.label <> 0 AND b.label = 0 GROUP BY a.vec_id""",
)
def a22_items(t):
    e = t("embeddings")
    return V.cross_cosines(e.filter("label <> 0"), e.filter("label = 0"), "vec_id", "embedding").withColumn("mean_cos", F.round("mean_cos", 6))


@query(
    "a22_medium_report",
    f"""WITH {UNIT_SQL}, c AS (SELECT avg(list_inner_product(a.u, b.u)) AS ceiling FROM u a JOIN u b ON a.vec_id < b.vec_id WHERE a.label = 0 AND b.label = 0),
    r AS (SELECT a.label, count(DISTINCT a.vec_id) AS n_arm, avg(list_inner_product(a.u, b.u)) AS m FROM u a, u b WHERE a.label <> 0 AND b.label = 0 GROUP BY a.label)
    SELECT label, n_arm, round(m, 6) AS arm_mean_cos, round(ceiling, 6) AS ceiling, round(m - ceiling, 6) AS delta, CASE WHEN m >= ceiling THEN 'at_or_above' ELSE 'below' END AS verdict FROM r, c""",
)
def a22(t):
    e = t("embeddings")
    r = V.medium_report(e.filter("label <> 0"), e.filter("label = 0"), "label", "vec_id", "embedding")
    return r.select("label", "n_arm", *[F.round(c, 6).alias(c) for c in ("arm_mean_cos", "ceiling", "delta")], "verdict")


@query(
    "w09_ranked_promotion",
    f"""WITH s AS ({SCORES_SQL}), p AS (SELECT *, NOT (subject < 0.26 OR subject <= "off" OR subject - "off" < 0.05 OR aesthetic < 0.45 OR blur < 100) AND label <> 3 AS ok, vec_id % 7 = 0 AS big FROM s),
    r AS (SELECT *, row_number() OVER (PARTITION BY label, ok ORDER BY subject DESC, vec_id) AS n, bool_or(ok) OVER (PARTITION BY label) AS anyok FROM p)
    SELECT label, vec_id, CASE WHEN NOT anyok THEN 'review_zero_pass' WHEN big THEN 'review_oversize' ELSE 'promoted' END AS outcome FROM r WHERE (anyok AND ok AND n <= 3) OR (NOT anyok AND n = 1)""",
)
def w09(t):
    th = {k: F.lit(v) for k, v in G.GRADE_DEFAULTS.items()}
    ok = (G.grade(F.col("subject"), F.col("off"), F.col("aesthetic"), F.col("blur"), th)["verdict"] == "PASS") & (F.col("label") != 3)
    return V.promote(_scores(t), "label", "vec_id", "subject", ok, F.col("vec_id") % 7 == 0, 3)
