"""Box and keypoint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import gates as G
from tidemark.functions import geometry as geo
from tidemark.operators import boxes as B
from tidemark.operators.quantiles import exact_percentiles
from tidemark.plans import views
from tidemark.plans.registry import query

W, H = 2560, 1440


@query(
    "p40_box_geometry",
    """SELECT asset, x0, y0, x1, y1, greatest(0, CAST(floor(x0) AS BIGINT) - 15) AS dx0, greatest(0, CAST(floor(y0) AS BIGINT) - 15) AS dy0,
      least(2560, CAST(ceil(x1) AS BIGINT) + 15) AS dx1, least(1440, CAST(ceil(y1) AS BIGINT) + 15) AS dy1,
      ((x0 + x1) / 2 <= 256 OR (x0 + x1) / 2 >= 2304 OR (y0 + y1) / 2 <= 144 OR (y0 + y1) / 2 >= 1296) AS border,
      (x0 < 2000 AND 1000 < x1 AND y0 < 800 AND 400 < y1) AS touches,
      greatest(0, CAST(x0 AS BIGINT) - CAST(round_even(0.1::DOUBLE * (x1 - x0), 0) AS BIGINT)) AS px0, least(2560, CAST(x1 AS BIGINT) + CAST(round_even(0.1::DOUBLE * (x1 - x0), 0) AS BIGINT)) AS px1
    FROM v_boxes""",
)
def p40(t):
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    w, h = F.lit(W), F.lit(H)
    fixed = F.struct(F.lit(1000.0).alias("x0"), F.lit(400.0).alias("y0"), F.lit(2000.0).alias("x1"), F.lit(800.0).alias("y1"))
    d = geo.dilate_box(x0, y0, x1, y1, w, h)
    p = geo.pad_box(x0, y0, x1, y1, F.lit(0.1), w, h)
    return views.v_boxes(t).select(
        "asset", "x0", "y0", "x1", "y1",
        *[d[c].alias(f"d{c}") for c in ("x0", "y0", "x1", "y1")],
        G.in_border_band((x0 + x1) / 2, (y0 + y1) / 2, w, h).alias("border"),
        geo.boxes_overlap(F.struct("x0", "y0", "x1", "y1"), fixed).alias("touches"),
        p["x0"].alias("px0"), p["x1"].alias("px1"),
    )


@query(
    "p41_region_envelope",
    """SELECT asset, greatest(0, CAST(min(x0) AS BIGINT) - 24) AS x0, greatest(0, CAST(min(y0) AS BIGINT) - 24) AS y0,
      least(2560, CAST(max(x1) AS BIGINT) + 25) AS x1, least(1440, CAST(max(y1) AS BIGINT) + 25) AS y1 FROM v_boxes GROUP BY asset""",
)
def p41(t):
    return B.envelope(views.v_boxes(t), "asset", F.lit(W), F.lit(H))


def _marks(t):
    """Faint boxes of the detector and OCR boxes (here: every box of another part) per asset."""
    b = views.v_boxes(t)
    faint = G.is_faint(F.col("conf"), F.col("x0"), F.col("x1"), F.lit(float(W)))
    kind = F.when(faint, "faint").when(F.col("conf") >= 0.6, "ocr")
    return b.select("asset", "x0", "y0", "x1", "y1", kind.alias("kind")).filter("kind is not null")


FAINT_SQL = """k AS (SELECT asset, x0, y0, x1, y1, CASE WHEN conf >= 0.05 AND conf < 0.35 AND (x1 - x0) / 2560 >= 0.05 THEN 'faint' WHEN conf >= 0.6 THEN 'ocr' END AS kind FROM v_boxes),
    f AS (SELECT DISTINCT asset, x0, y0, x1, y1 FROM k WHERE kind = 'faint'),
    o AS (SELECT DISTINCT asset, x0, y0, x1, y1 FROM k WHERE kind = 'ocr'),
    u AS (SELECT *, 1 AS a, 0 AS b FROM f UNION ALL SELECT *, 0, 1 FROM o WHERE EXISTS (SELECT 1 FROM f WHERE f.asset = o.asset
      AND o.x0 < f.x1 AND f.x0 < o.x1 AND o.y0 < f.y1 AND f.y0 < o.y1)),
    r AS (SELECT asset, greatest(0, CAST(min(x0) AS BIGINT)) AS x0, greatest(0, CAST(min(y0) AS BIGINT)) AS y0, least(2560, CAST(max(x1) AS BIGINT)) AS x1,
      least(1440, CAST(max(y1) AS BIGINT)) AS y1, CAST(sum(a) AS BIGINT) AS n_faint, CAST(sum(b) AS BIGINT) AS n_ocr FROM u GROUP BY asset HAVING sum(a) > 0)"""


@query("p42_faint_region", f"WITH {FAINT_SQL} SELECT * FROM r")
def p42(t):
    return B.faint_regions(_marks(t), "asset", F.lit(W), F.lit(H))


@query(
    "p42_faint_residual",
    """WITH k AS (SELECT asset, x0, y0, x1, y1, row_number() OVER () AS rid FROM v_boxes WHERE conf >= 0.05 AND conf < 0.35 AND (x1 - x0) / 2560 >= 0.05),
    r AS (SELECT asset, greatest(0, CAST(min(x0) AS BIGINT) - 24) AS a0, greatest(0, CAST(min(y0) AS BIGINT) - 24) AS b0, least(2560, CAST(max(x1) AS BIGINT) + 25) AS a1, least(1440, CAST(max(y1) AS BIGINT) + 25) AS b1
      FROM v_boxes WHERE conf >= 0.6 GROUP BY asset)
    SELECT k.asset, x0, y0, x1, y1 FROM k JOIN r USING (asset) WHERE x0 < a1 AND a0 < x1 AND y0 < b1 AND b0 < y1""",
)
def p42_residual(t):
    marks = _marks(t)
    cleaned = B.envelope(marks.filter("kind = 'ocr'"), "asset", F.lit(W), F.lit(H))
    return B.residual(marks, cleaned, "asset").drop("kind")


KP_SQL = """k AS (SELECT vec_id, max(x) FILTER (joint = 0) AS x0, max(y) FILTER (joint = 0) AS y0, max(x) FILTER (joint = 1) AS x1, max(y) FILTER (joint = 1) AS y1,
      max(x) FILTER (joint = 2) AS x2, max(y) FILTER (joint = 2) AS y2, max(x) FILTER (joint = 3) AS x3, max(y) FILTER (joint = 3) AS y3,
      min(joint) FILTER (joint < 4 AND conf < 0.3) AS bad, count(*) FILTER (joint >= 4 AND conf >= 0.3) AS heads,
      avg(x) FILTER (joint >= 4 AND conf >= 0.3) AS hx, avg(y) FILTER (joint >= 4 AND conf >= 0.3) AS hy FROM v_keypoints GROUP BY vec_id),
    g AS (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS sw, (x0 + x1) / 2 - (x2 + x3) / 2 AS ax, (y0 + y1) / 2 - (y2 + y3) / 2 AS ay, (x2 + x3) / 2 AS mx, (y2 + y3) / 2 AS my FROM k),
    s AS (SELECT *, sqrt(ax * ax + ay * ay) AS sp FROM g),
    r AS (SELECT *, CASE WHEN bad IS NOT NULL THEN 'spine_point_low_conf' WHEN sw <= 0 THEN 'degenerate_shoulders' WHEN sp <= 0 THEN 'degenerate_spine'
      WHEN sw / sp < 0.35 THEN 'implausible_geometry' WHEN heads = 0 THEN 'no_head_points' END AS reason, (ax * (hy - my) - ay * (hx - mx)) / sp AS off FROM s)"""


def _offsets(t):
    return views.v_keypoints(t).select("vec_id", "label", "kp", geo.axis_offset(F.col("kp")).alias("o"))


@query(
    "p43_axis_offset",
    f"""WITH {KP_SQL} SELECT vec_id, coalesce(reason, 'measured') AS reason, coalesce(['left_shoulder', 'right_shoulder', 'left_hip', 'right_hip'][bad + 1], '') AS detail,
      CASE WHEN reason IS NULL THEN round("off", 6) END AS offset_px, CASE WHEN reason IS NULL THEN round("off" / sw, 6) END AS offset_norm FROM r""",
)
def p43(t):
    return _offsets(t).select(
        "vec_id",
        F.coalesce("o.reason", F.lit("measured")).alias("reason"),
        F.coalesce("o.detail", F.lit("")).alias("detail"),
        F.round("o.offset", 6).alias("offset_px"),
        F.round("o.offset_norm", 6).alias("offset_norm"),
    )


@query(
    "p44_triage_band",
    f"""WITH {KP_SQL}, m AS (SELECT vec_id, abs("off" / sw) AS m FROM r WHERE reason IS NULL),
    q AS (SELECT quantile_cont(m, 0.9) AS p90, quantile_cont(m, 0.95) AS p95 FROM m)
    SELECT vec_id, CASE WHEN m >= p95 THEN 'ABOVE_P95' WHEN m >= p90 THEN 'ABOVE_P90' ELSE 'TYPICAL' END AS band FROM m, q""",
)
def p44(t):
    m = _offsets(t).filter("o.offset_norm is not null").select("vec_id", F.abs("o.offset_norm").alias("m"))
    marks = exact_percentiles(m, [], "m", {"p90": 0.90, "p95": 0.95})  # one row
    joined = m.join(marks)
    return joined.select("vec_id", G.triage_band(F.col("m"), F.col("p90"), F.col("p95")).alias("band"))


@query(
    "p45_joint_confidence",
    """WITH j AS (SELECT *, ['left_shoulder', 'right_shoulder', 'left_hip', 'right_hip', 'nose', 'left_ear', 'right_ear'][joint + 1] AS name FROM v_keypoints),
    k AS (SELECT vec_id, coalesce(string_agg(name, ',' ORDER BY joint) FILTER (conf < 0.3), '') AS weak,
      max(x) FILTER (joint = 0) AS x0, max(y) FILTER (joint = 0) AS y0, max(x) FILTER (joint = 1) AS x1, max(y) FILTER (joint = 1) AS y1,
      max(x) FILTER (joint = 2) AS x2, max(y) FILTER (joint = 2) AS y2, max(x) FILTER (joint = 3) AS x3, max(y) FILTER (joint = 3) AS y3 FROM j GROUP BY vec_id),
    d AS (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) / sqrt(((x0 + x1) / 2 - (x2 + x3) / 2) ** 2 + ((y0 + y1) / 2 - (y2 + y3) / 2) ** 2) AS ratio FROM k)
    SELECT vec_id, weak, round(ratio, 6) AS ratio, ratio < 0.35 AS below_floor FROM d""",
)
def p45(t):
    kp = F.col("kp")
    ratio = geo.figure_geometry(kp)["ratio"]
    return views.v_keypoints(t).select(
        "vec_id",
        F.array_join(geo.low_conf_joints(kp, views.JOINTS), ",").alias("weak"),
        F.round(ratio, 6).alias("ratio"),
        (ratio < geo.MIN_SHOULDER_SPINE_RATIO).alias("below_floor"),
    )


@query(
    "a32_connected_boxes",
    """WITH RECURSIVE b AS (SELECT DISTINCT asset, CAST(x0 AS DOUBLE) AS x0, y0, CAST(x1 AS DOUBLE) AS x1, y1 FROM v_boxes WHERE x0 < x1 AND y0 < y1),
    n AS (SELECT asset, row_number() OVER (PARTITION BY asset ORDER BY x0, y0, x1, y1) AS id, x0, y0, x1, y1, true AS moved, 0 AS step FROM b),
    r AS (SELECT * FROM n UNION ALL
      SELECT asset, id, x0, y0, x1, y1, bool_or(grown) OVER (PARTITION BY asset) AS moved, step + 1 FROM
        (SELECT a.asset, a.id, min(c.x0) AS x0, min(c.y0) AS y0, max(c.x1) AS x1, max(c.y1) AS y1, min(c.x0) < a.x0 OR min(c.y0) < a.y0 OR max(c.x1) > a.x1 OR max(c.y1) > a.y1 AS grown, a.step
         FROM r a JOIN r c ON a.asset = c.asset AND a.x0 < c.x1 AND c.x0 < a.x1 AND a.y0 < c.y1 AND c.y0 < a.y1 WHERE a.moved
         GROUP BY a.asset, a.id, a.x0, a.y0, a.x1, a.y1, a.step) g)
    SELECT DISTINCT asset, x0, y0, x1, y1 FROM (SELECT *, max(step) OVER (PARTITION BY asset) AS last FROM r) f WHERE step = last""",
)
def a32(t):
    return B.merge_components(views.v_boxes(t), "asset")


@query(
    "a33_box_centroid",
    """SELECT asset, round(sum((x1 - x0) * (y1 - y0) * (x0 + x1) / 2) / sum((x1 - x0) * (y1 - y0)), 6) AS cx,
      round(sum((x1 - x0) * (y1 - y0) * (y0 + y1) / 2) / sum((x1 - x0) * (y1 - y0)), 6) AS cy FROM v_boxes GROUP BY asset""",
)
def a33(t):
    return B.centroid(views.v_boxes(t), "asset").select("asset", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


ROWS_SQL = """r AS (SELECT asset, x0, unnest(range(y0, y1)) AS y, x1 FROM d WHERE x1 > x0 AND y1 > y0),
    g AS (SELECT asset, y, x0, max(x1) AS x1 FROM r GROUP BY ALL),
    s AS (SELECT asset, greatest(0, x1 - greatest(x0, coalesce(max(x1) OVER (PARTITION BY asset, y ORDER BY x0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), x0))) AS fresh FROM g)"""


@query(
    "a33_union_area",
    f"""WITH d AS (SELECT DISTINCT asset, greatest(0, CAST(floor(x0) AS BIGINT) - 15) AS x0, greatest(0, CAST(floor(y0) AS BIGINT) - 15) AS y0,
      least(2560, CAST(ceil(x1) AS BIGINT) + 15) AS x1, least(1440, CAST(ceil(y1) AS BIGINT) + 15) AS y1 FROM v_boxes), {ROWS_SQL}
    SELECT asset, round(CAST(sum(fresh) AS DOUBLE) / (2560 * 1440) * 100.0, 6) AS area_pct FROM s GROUP BY asset""",
)
def a33_area(t):
    return B.dilated_area_pct(views.v_boxes(t), "asset", W, H).select("asset", F.round("area_pct", 6).alias("area_pct"))


@query(
    "a39_box_coverage",
    f"""WITH d AS (SELECT asset, greatest(CAST(floor(x0) AS BIGINT), 400) AS x0, greatest(CAST(floor(y0) AS BIGINT), 300) AS y0,
      least(CAST(ceil(x1) AS BIGINT), 1400) AS x1, least(CAST(ceil(y1) AS BIGINT), 700) AS y1 FROM v_boxes), {ROWS_SQL},
    c AS (SELECT asset, CAST(sum(fresh) AS DOUBLE) / 400000 AS c FROM s GROUP BY asset)
    SELECT asset, round(least(1.0::DOUBLE, coalesce(c, 0.0::DOUBLE)), 6) AS coverage FROM (SELECT DISTINCT asset FROM v_boxes) a LEFT JOIN c USING (asset)""",
)
def a39(t):
    return B.coverage(views.v_boxes(t), "asset", (400, 300, 1400, 700)).select("asset", F.round("coverage", 6).alias("coverage"))
