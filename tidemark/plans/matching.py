"""Matching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import matching as M
from tidemark.plans import views
from tidemark.plans.registry import query


def matches(t):
    corpus = views.v_hashes(t).select(F.col("vec_id").alias("path"), "phash", "dhash", F.col("vec_id").alias("ord"))
    return M.consensus_match(views.v_hash_targets(t), corpus)


MATCH_SQL = """p AS (SELECT target, vec_id, CAST(bit_count(xor(t.phash, c.phash)) AS BIGINT) AS p, CAST(bit_count(xor(t.dhash, c.dhash)) AS BIGINT) AS d FROM v_hash_targets t, v_hashes c),
    b AS (SELECT *, greatest(p, d) AS w, row_number() OVER (PARTITION BY target ORDER BY greatest(p, d), vec_id) AS r FROM p),
    m AS (SELECT target, CASE WHEN w <= 8 THEN 'match' WHEN w <= 14 THEN 'review' ELSE 'no_match' END AS decision, CASE WHEN w <= 14 THEN vec_id END AS source, p, d FROM b WHERE r = 1)"""


@query("j01_consensus_match", f"WITH {MATCH_SQL} SELECT * FROM m")
def j01(t):
    return matches(t).withColumns({c: F.col(c).cast("long") for c in ("p", "d")})


@query(
    "j02_intake_dedup",
    """WITH a AS (SELECT DISTINCT source || '-' || doc_id % 10 AS slug, sha FROM v_files), n AS (SELECT doc_id AS seq, source || '-' || doc_id % 7 AS slug, sha FROM v_files),
    f AS (SELECT slug, sha, min(seq) AS seq FROM n WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.slug = n.slug AND a.sha = n.sha) GROUP BY ALL),
    k AS (SELECT seq, slug, row_number() OVER (PARTITION BY slug ORDER BY seq) + (SELECT count(*) FROM a WHERE a.slug = f.slug) AS k FROM f)
    SELECT n.seq, CASE WHEN k IS NULL THEN 'refused' ELSE 'accepted' END AS status, CASE WHEN k IS NULL THEN '' WHEN k = 1 THEN n.slug ELSE n.slug || '-' || k END AS placed_as FROM n LEFT JOIN k USING (seq)""",
)
def j02(t):
    f = views.v_files(t)

    def slug(n):
        return F.concat_ws("-", "source", (F.col("doc_id") % n).cast("string"))

    new = f.select(F.col("doc_id").alias("seq"), slug(7).alias("slug"), "sha")
    return M.dedupe_intake(new, f.select(slug(10).alias("slug"), "sha")).select(
        "seq", "status", F.coalesce("placed_as", F.lit("")).alias("placed_as")
    )


def campaign(t):
    """Four tiers per target: hashes, name token, search answer, manual queue."""
    v = views.v_hash_targets(t).select("target")
    token, hit = F.col("target") % 3 == 0, F.col("target") % 5 == 0
    t0 = matches(t).select("target", F.lit(0).alias("tier"), "decision", (F.col("decision") == "match").alias("ok"), F.col("source").cast("string").alias("source"))
    t1 = v.select(
        "target", F.lit(1).alias("tier"), F.when(token, "inconclusive").otherwise("no_token").alias("decision"), token.alias("ok"),
        F.when(token, F.concat(F.lit("token-"), F.col("target").cast("string"))).alias("source"),
    )
    t2 = v.select(
        "target", F.lit(2).alias("tier"), F.when(hit, "accept").otherwise("not_configured").alias("decision"), hit.alias("ok"),
        F.when(hit, "search").alias("source"),
    )
    t3 = v.select("target", F.lit(3).alias("tier"), F.lit("queued").alias("decision"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("source"))
    return M.waterfall(t0.unionByName(t1).unionByName(t2).unionByName(t3))


WATERFALL_SQL = f"""{MATCH_SQL}, w AS (SELECT target, decision, CASE WHEN decision = 'match' THEN 0 WHEN target % 3 = 0 THEN 1 WHEN target % 5 = 0 THEN 2 ELSE 3 END AS tier, source FROM m),
    r AS (SELECT target, tier, CASE tier WHEN 0 THEN source::VARCHAR WHEN 1 THEN 'token-' || target WHEN 2 THEN 'search' ELSE '' END AS source,
      'T0:' || decision || CASE WHEN tier >= 1 THEN ' T1:' || CASE WHEN tier = 1 THEN 'inconclusive' ELSE 'no_token' END ELSE '' END ||
      CASE WHEN tier >= 2 THEN ' T2:' || CASE WHEN tier = 2 THEN 'accept' ELSE 'not_configured' END ELSE '' END || CASE WHEN tier = 3 THEN ' T3:queued' ELSE '' END AS decisions FROM w)"""


@query("j04_waterfall", f"WITH {WATERFALL_SQL} SELECT * FROM r")
def j04(t):
    return campaign(t).fillna("", ["source"])


@query(
    "a09_campaign_tally",
    f"""WITH {WATERFALL_SQL} SELECT count(*) AS targets, count(*) FILTER (tier = 0) AS matched, count(*) FILTER (tier = 1) AS resolved, count(*) FILTER (tier = 2) AS searched,
      count(*) FILTER (tier = 3) AS queued, count(*) FILTER (decisions LIKE 'T0:review%') AS review FROM r""",
)
def a09(t):
    return M.tally(campaign(t))


@query(
    "s08_manual_queue",
    f"""WITH {WATERFALL_SQL} SELECT 'vec-' || target AS target, replace(decisions, ' T3:queued', '') AS reason, 'reverse-image; manual' AS suggested_tools FROM r WHERE tier = 3""",
)
def s08(t):
    from tidemark.sources.sinks import queue_rows

    parked = campaign(t).filter("tier = 3").select(
        F.concat(F.lit("vec-"), F.col("target").cast("string")).alias("target"),
        F.regexp_replace("decisions", " T3:queued$", "").alias("reason"),
        F.lit("reverse-image; manual").alias("suggested_tools"),
        F.lit("dropped").alias("extra"),
    )
    return queue_rows(parked)


@query(
    "j05_pending_targets",
    """WITH f AS (SELECT page_id, host, CASE page_id % 3 WHEN 0 THEN 'p' || page_id || '-pre.jpg' WHEN 1 THEN 'p' || page_id || '-fullview.png' ELSE CASE WHEN page_id % 4 = 0 THEN 'dabc1234-0a1b2c3d-x.jpg' ELSE 'notes.txt' END END AS name FROM v_paths)
    SELECT page_id, host AS folder, name FROM f WHERE name NOT IN ('dabc1234-0a1b2c3d-x.jpg', 'notes.txt') AND host NOT IN (SELECT host FROM f WHERE name = 'dabc1234-0a1b2c3d-x.jpg')""",
)
def j05(t):
    i, m = F.col("page_id").cast("string"), F.col("page_id") % 3
    name = (
        F.when(m == 0, F.concat(F.lit("p"), i, F.lit("-pre.jpg"))).when(m == 1, F.concat(F.lit("p"), i, F.lit("-fullview.png")))
        .when(F.col("page_id") % 4 == 0, "dabc1234-0a1b2c3d-x.jpg").otherwise("notes.txt")
    )
    return M.pending_targets(views.v_paths(t).select("page_id", F.col("host").alias("folder"), name.alias("name")))


@query(
    "j06_overlap_report",
    f"""WITH {MATCH_SQL} SELECT count(*) AS n_targets, count(*) FILTER (decision = 'match') AS n_matched, count(*) FILTER (decision = 'review') AS n_flagged, count(*) FILTER (decision = 'no_match') AS n_targets_unmatched,
      (SELECT count(*) FROM v_hashes WHERE vec_id NOT IN (SELECT source FROM m WHERE decision = 'match')) AS n_corpus_unmatched FROM m""",
)
def j06(t):
    return M.overlap_report(matches(t), views.v_hashes(t).select(F.col("vec_id").alias("path")))


PAIR_SQL = """x AS (SELECT a.vec_id, CAST(bit_count(xor(a.dhash, b.dhash)) AS BIGINT) AS structure, round(list_aggregate(list_transform(range(1, 65), lambda i: abs(CAST(e.embedding[i] AS DOUBLE))), 'avg') / 4 * (a.vec_id % 3), 6) AS content
      FROM v_hashes a JOIN v_hash_targets b ON a.vec_id = b.target JOIN embeddings e ON e.vec_id = a.vec_id),
    c AS (SELECT *, CASE WHEN structure <= 6 AND content <= 0.03 THEN 'both' WHEN structure <= 6 THEN 'structure_only' WHEN content <= 0.03 THEN 'content_only' ELSE 'neither' END AS class,
      CASE WHEN structure <= 6 THEN 'strong' WHEN structure <= 14 THEN 'grey' ELSE 'far' END AS band FROM x)"""


def _pairs(t):
    """A planted twin per asset: known bit distance, and values scaled toward it."""
    a = views.v_hashes(t)
    b = views.v_hash_targets(t).select(F.col("target").alias("vec_id"), F.col("dhash").alias("d2"))
    e = t("embeddings").select(
        "vec_id",
        (F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + F.abs(x.cast("double"))) / F.size("embedding")).alias("mad"),
    )
    content = F.round(F.col("mad") / 4 * (F.col("vec_id") % 3), 6)
    return a.join(b, "vec_id").join(e, "vec_id").select(
        "vec_id", M.hamming("dhash", "d2").cast("long").alias("structure"), content.alias("content")
    )


@query("j07_two_metric_confirm", f"WITH {PAIR_SQL} SELECT vec_id, structure, content, class, band FROM c")
def j07(t):
    return M.confirm_matches(_pairs(t))


@query(
    "j07_band_report",
    f"""WITH {PAIR_SQL} SELECT band, count(*) AS n, count(*) FILTER (class = 'both') AS confirmed, min(content) AS content_min, max(content) AS content_max, round(quantile_cont(content, 0.5), 6) AS content_median FROM c GROUP BY band""",
)
def j07_bands(t):
    r = M.band_report(M.confirm_matches(_pairs(t)))
    return r.withColumn("content_median", F.round("content_median", 6))


@query(
    "j25_preference_pick",
    """WITH a AS (SELECT p_partkey AS asset, p_brand AS hand, CASE WHEN p_type = 'ECONOMY' AND p_brand <> 'Brand#3' THEN 'side' WHEN p_type = 'SMALL' THEN 'front' WHEN p_type = 'PROMO' THEN 'threequarter' ELSE 'back' END AS view FROM part),
    q AS (SELECT c_custkey AS request, 'Brand#' || c_custkey % 30 AS hand, (c_custkey % 11 - 5) / 5 AS vx FROM customer),
    g AS (SELECT hand, min(asset) AS any_, min(asset) FILTER (view = 'side') AS side, min(asset) FILTER (view IN ('front', 'threequarter')) AS front FROM a GROUP BY hand)
    SELECT request, coalesce(CASE WHEN abs(vx) >= 0.5 THEN side ELSE front END, any_, -1) AS asset FROM q LEFT JOIN g USING (hand)""",
)
def j25(t):
    # one brand has no side view
    view = F.when((F.col("p_type") == "ECONOMY") & (F.col("p_brand") != "Brand#3"), "side").when(F.col("p_type") == "SMALL", "front").when(F.col("p_type") == "PROMO", "threequarter").otherwise("back")
    assets = t("part").select(
        F.col("p_partkey").alias("asset"), F.col("p_brand").alias("hand"), view.alias("view")
    )
    k = F.col("c_custkey")
    req = t("customer").select(
        k.alias("request"), F.concat(F.lit("Brand#"), (k % 30).cast("string")).alias("hand"), ((k % 11 - 5) / 5).alias("vx")
    )
    return M.pick_asset(assets, req).fillna(-1, ["asset"])


@query(
    "j26_source_pick",
    r"""WITH f AS (SELECT host AS slug, 'p/' || CASE WHEN page_id % 2 = 0 THEN upper(path) ELSE path END || ['.jpg', '.PNG', '.webp', '.jpeg', '.gif'][page_id % 5 + 1] AS path, page_id % 4 <> 0 AS decodes,
      CASE WHEN page_id % 6 = 0 THEN 'initial' ELSE 'fullview' END AS kind FROM v_paths),
    k AS (SELECT *, list_position(['.png', '.webp', '.jpeg', '.jpg'], lower(regexp_extract(path, '(\.[^.]*)$', 1))) AS rk FROM f),
    b AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY rk, lower(path), path) AS n FROM k WHERE kind = 'fullview' AND rk > 0),
    i AS (SELECT slug, min(path) AS path FROM k WHERE kind = 'initial' GROUP BY slug)
    SELECT s.slug, CASE WHEN b.decodes THEN b.path ELSE coalesce(i.path, '') END AS path, CASE WHEN b.decodes THEN 'fullview' WHEN i.path IS NOT NULL THEN 'firstinitial' ELSE 'none' END AS kind
    FROM (SELECT DISTINCT slug FROM f) s LEFT JOIN b ON s.slug = b.slug AND n = 1 LEFT JOIN i ON s.slug = i.slug""",
)
def j26(t):
    i = F.col("page_id")
    ext = F.element_at(F.array(*[F.lit(e) for e in (".jpg", ".PNG", ".webp", ".jpeg", ".gif")]), (i % 5 + 1).cast("int"))
    files = views.v_paths(t).select(
        F.col("host").alias("slug"),
        F.concat(F.lit("p/"), F.when(i % 2 == 0, F.upper("path")).otherwise(F.col("path")), ext).alias("path"),
        (i % 4 != 0).alias("decodes"),
        F.when(i % 6 == 0, "initial").otherwise("fullview").alias("kind"),
    )
    return M.select_source(files).fillna("", ["path"])


@query(
    "j27_prefix_resolution",
    """WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN split_part(p_name, ' ', 1) WHEN 2 THEN substr(p_name, 1, 4) ELSE 'zz' || p_name END AS name FROM part),
    k AS (SELECT p_name AS key, min(p_partkey) AS ord FROM part GROUP BY 1)
    SELECT p_partkey, name, CASE WHEN EXISTS (SELECT 1 FROM k WHERE k.key = name) THEN name ELSE coalesce((SELECT arg_min(k.key, ord) FROM k WHERE starts_with(k.key, name)), '') END AS key,
      CASE WHEN EXISTS (SELECT 1 FROM k WHERE k.key = name) THEN 'exact' WHEN EXISTS (SELECT 1 FROM k WHERE starts_with(k.key, name)) THEN 'prefix' ELSE 'unresolved' END AS how FROM n""",
)
def j27(t):
    m = F.col("p_partkey") % 4
    name = (
        F.when(m == 0, F.col("p_name")).when(m == 1, F.substring_index("p_name", " ", 1))
        .when(m == 2, F.substring("p_name", 1, 4)).otherwise(F.concat(F.lit("zz"), "p_name"))
    )
    known = t("part").groupBy(F.col("p_name").alias("key")).agg(F.min("p_partkey").alias("ord"))
    return M.resolve_key(t("part").select("p_partkey", name.alias("name")), known).fillna("", ["key"])
