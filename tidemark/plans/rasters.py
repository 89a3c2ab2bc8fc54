"""Raster queries over 8x8 frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import rasters as R
from tidemark.plans.registry import query

W = H = 8


def frames(t):
    """Source frame, a posterised output and a sharpened output per asset."""
    src = F.transform("embedding", lambda e: 127.5 * (1 + e.cast("double")))
    base = t("embeddings").select("vec_id", src.alias("src"))
    return base.select(
        "vec_id", "src", F.transform("src", lambda v: F.floor(v / 8) * 8.0).alias("post"), F.transform("src", lambda v: 127.5 + (v - 127.5) * 3).alias("sharp")
    )


def at(dy: int, dx: int, of: str = "src") -> str:
    return f"{of}[greatest(0, least(7, y + {dy})) * 8 + greatest(0, least(7, x + {dx})) + 1]"


FRAME_SQL = """f AS (SELECT vec_id, list_transform(embedding, lambda e: 127.5 * (1 + CAST(e AS DOUBLE))) AS src FROM embeddings),
    g AS (SELECT vec_id, src, list_transform(src, lambda v: floor(v / 8) * 8.0) AS post, list_transform(src, lambda v: 127.5 + (v - 127.5) * 3) AS sharp FROM f),
    c AS (SELECT vec_id, src, post, sharp, CAST(i // 8 AS INT) AS y, CAST(i % 8 AS INT) AS x, CAST(i AS INT) AS i FROM g, (SELECT unnest(range(64)) AS i) r)"""


def lap(of):
    return f"{at(-1, 0, of)} + {at(1, 0, of)} + {at(0, -1, of)} + {at(0, 1, of)} - 4 * {at(0, 0, of)}"


@query(
    "a34_raster_quality",
    f"""WITH {FRAME_SQL} SELECT vec_id, round(var_pop({lap('src')}), 4) AS lap_var, round(var_pop({lap('post')}) / var_pop({lap('src')}), 6) AS lap_ratio,
      round(avg(abs({at(0, 0)} - {at(0, 0, 'post')})) FILTER (i % 8 >= 3), 6) AS mad_outside FROM c GROUP BY vec_id""",
)
def a34(t):
    mask = F.transform("src", lambda _, i: i % 8 < 3)
    return frames(t).select(
        "vec_id", F.round(R.laplacian_var(F.col("src"), W, H), 4).alias("lap_var"),
        F.round(R.laplacian_ratio(F.col("src"), F.col("post"), W, H), 6).alias("lap_ratio"),
        F.round(R.mad_outside(F.col("src"), F.col("post"), mask), 6).alias("mad_outside"),
    )


@query(
    "a35_halo_share",
    f"""WITH {FRAME_SQL}, s AS (SELECT *, {at(-1, 1)} + 2 * {at(0, 1)} + {at(1, 1)} - {at(-1, -1)} - 2 * {at(0, -1)} - {at(1, -1)} AS gx, {at(1, -1)} + 2 * {at(1, 0)} + {at(1, 1)} - {at(-1, -1)} - 2 * {at(-1, 0)} - {at(-1, 1)} AS gy FROM c),
    d AS (SELECT *, sqrt(gx * gx + gy * gy) AS gr FROM s), e AS (SELECT *, gr >= greatest(quantile_cont(gr, 0.95) OVER (PARTITION BY vec_id), 1e-6) AS strong FROM d),
    n AS (SELECT a.vec_id, a.i, any_value({at(0, 0, 'a.sharp').replace('y +', 'a.y +').replace('x +', 'a.x +')}) AS o, bool_or(b.strong) AS near, max(b.src[b.i + 1]) AS hi, min(b.src[b.i + 1]) AS lo FROM e a JOIN e b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 2 AND abs(a.x - b.x) <= 2 GROUP BY a.vec_id, a.i)
    SELECT vec_id, round(count(*) FILTER (near AND (o > hi + 8 OR o < lo - 8)) / count(*) FILTER (near), 4) AS halo_pct FROM n GROUP BY vec_id""",
)
def a35(t):
    return frames(t).select("vec_id", R.halo_pct(F.col("src"), F.col("sharp"), W, H).alias("halo_pct"))


NINE = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def banding_sql(of: str) -> str:
    """Definitions that end in ``d_<of>(vec_id, d)``: plateau edges in or beside smooth cells, over smooth cells."""
    mean = f"(({' + '.join(at(dy, dx, of) for dy, dx in NINE)}) / 9)"
    squares = f"(({' + '.join(f'{at(dy, dx, of)} * {at(dy, dx, of)}' for dy, dx in NINE)}) / 9)"
    turned = lambda v, k: f"(({v} + {k} + 8) % 8)"  # noqa: E731 - neighbours wrap around, steps stop at the edge
    step = lambda y, x, y1, x1: f"abs({of}[{y1} * 8 + {x1} + 1] - {of}[{y} * 8 + {x} + 1])"
    right = {k: step("y", turned("x", k), "y", f"least(7, {turned('x', k)} + 1)") for k in (-1, 0, 1)}
    down = {k: step(turned("y", k), "x", f"least(7, {turned('y', k)} + 1)", "x") for k in (-1, 0, 1)}
    edge = lambda d: f"({d[0]} > {R.FLAT} AND {d[-1]} <= {R.FLAT} AND {d[1]} <= {R.FLAT})"
    return f"""m_{of} AS (SELECT vec_id, y, x, {squares} - {mean} * {mean} < {R.SMOOTH_VAR} AS smooth, {edge(right)} OR {edge(down)} AS edge FROM c),
    n_{of} AS (SELECT a.vec_id, a.y, a.x, any_value(a.smooth) AS smooth, any_value(a.edge) AND bool_or(b.smooth) AS hit FROM m_{of} a JOIN m_{of} b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY a.vec_id, a.y, a.x),
    d_{of} AS (SELECT vec_id, CASE WHEN count(*) FILTER (smooth) = 0 THEN 0.0::DOUBLE ELSE count(*) FILTER (hit)::DOUBLE / count(*) FILTER (smooth) END AS d FROM n_{of} GROUP BY vec_id)"""


@query(
    "a36_banding_delta",
    f"""WITH {FRAME_SQL}, {banding_sql('post')}, {banding_sql('src')} SELECT p.vec_id, round(p.d - s.d, 6) AS band_delta FROM d_post p JOIN d_src s USING (vec_id)""",
)
def a36(t):
    return frames(t).select("vec_id", F.round(R.banding_delta(F.col("src"), F.col("post"), W, H), 6).alias("band_delta"))


@query(
    "a40_density_keep",
    f"""WITH {FRAME_SQL}, m AS (SELECT vec_id, y, x, {at(0, 0)} > 130 AS b FROM c),
    k AS (SELECT a.vec_id, a.y, a.x, any_value(a.b) AND count(*) FILTER (n.b) >= 4 AS keep FROM m a JOIN m n ON a.vec_id = n.vec_id AND abs(a.y - n.y) <= 1 AND abs(a.x - n.x) <= 1 GROUP BY a.vec_id, a.y, a.x)
    SELECT vec_id, string_agg(CASE WHEN keep THEN '1' ELSE '0' END, '' ORDER BY y, x) AS kept FROM k GROUP BY vec_id""",
)
def a40(t):
    kept = R.density_keep(F.transform("src", lambda v: v > 130), W, H, 3, 4)
    return frames(t).select("vec_id", F.array_join(F.transform(kept, lambda b: F.when(b, "1").otherwise("0")), "").alias("kept"))


HP_SQL = f"""{FRAME_SQL}, hp AS (SELECT vec_id, i, {at(0, 0)} - ({' + '.join(at(dy, dx) for dy in range(-1, 2) for dx in range(-1, 2))}) / 9 AS v FROM c),
    md AS (SELECT i, quantile_cont(v, 0.5) AS med FROM hp GROUP BY i),
    tp AS (SELECT i, med, abs(med) >= greatest((SELECT quantile_cont(abs(med), 0.98) FROM md), 1e-9) AS support FROM md)"""


def _highpassed(t):
    return frames(t).select("vec_id", R.highpass(F.col("src"), W, H, 3).alias("hp"))


@query("a23_median_template", f"WITH {HP_SQL} SELECT i, round(med, 6) AS med, support FROM tp")
def a23(t):
    return R.median_template(_highpassed(t), "hp").withColumn("med", F.round("med", 6))


@query(
    "a37_template_score",
    f"""WITH {HP_SQL}, z AS (SELECT vec_id, greatest(-8, least(8, v)) AS x, med, CASE WHEN support THEN 1.0::DOUBLE ELSE 0.0 END AS m FROM hp JOIN tp USING (i)),
    a AS (SELECT vec_id, sum(m) AS n, sum(med * m) AS st, sum(med * med * m) AS stt, sum(x * m) AS s1, sum(x * x * m) AS s2, sum(x * med * m) AS sxt FROM z GROUP BY vec_id)
    SELECT vec_id, round((sxt - s1 * st / n) / sqrt(greatest(s2 - s1 * s1 / n, 1e-9) * greatest(stt - st * st / n, 1e-9)), 5) AS score FROM a""",
)
def a37(t):
    hp = _highpassed(t)
    s = R.template_scores(hp, "vec_id", "hp", R.median_template(hp, "hp"), W, H)
    return s.select("vec_id", F.round("score", 5).alias("score"))


@query(
    "a37_template_best_shift",
    f"""WITH {HP_SQL}, gs AS (SELECT dy, dx FROM (SELECT unnest(range(-1, 2)) AS dy) a, (SELECT unnest(range(-1, 2)) AS dx) b),
    z AS (SELECT hp.vec_id, dy, dx, greatest(-8, least(8, hp.v)) AS x, med, CASE WHEN support THEN 1.0::DOUBLE ELSE 0.0 END AS m FROM tp, gs JOIN hp ON hp.i = ((tp.i // 8 + dy + 8) % 8) * 8 + (tp.i % 8 + dx + 8) % 8),
    a AS (SELECT vec_id, dy, dx, sum(m) AS n, sum(med * m) AS st, sum(med * med * m) AS stt, sum(x * m) AS s1, sum(x * x * m) AS s2, sum(x * med * m) AS sxt FROM z GROUP BY vec_id, dy, dx),
    s AS (SELECT vec_id, dy, dx, (sxt - s1 * st / n) / sqrt(greatest(s2 - s1 * s1 / n, 1e-9) * greatest(stt - st * st / n, 1e-9)) AS score FROM a),
    b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC) AS r FROM s)
    SELECT vec_id, round(score, 5) AS score FROM b WHERE r = 1""",
)
def a37_shift(t):
    hp = _highpassed(t)
    s = R.template_scores(hp, "vec_id", "hp", R.median_template(hp, "hp"), W, H, shift=1)
    # equal scores may sit at several shifts, so the score alone is compared
    return s.select("vec_id", F.round("score", 5).alias("score"))
