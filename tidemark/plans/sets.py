"""Set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sets as S
from tidemark.plans import views
from tidemark.plans.registry import query


@query(
    "x01_deck_reconcile",
    """WITH o AS (SELECT doc_id, doc_id % 4 = 0 AS shown FROM documents WHERE doc_id % 3 < 2), p AS (SELECT doc_id FROM documents WHERE doc_id % 5 > 0 OR doc_id % 3 = 2)
    SELECT doc_id, 'shown' AS status FROM o WHERE shown UNION ALL SELECT doc_id, 'owed' FROM o WHERE NOT shown AND doc_id IN (SELECT doc_id FROM p) UNION ALL SELECT doc_id, 'new' FROM p WHERE doc_id NOT IN (SELECT doc_id FROM o)""",
)
def x01(t):
    d = t("documents").select("doc_id")
    return S.reconcile_set(d.filter("doc_id % 3 < 2").withColumn("shown", F.col("doc_id") % 4 == 0), d.filter("doc_id % 5 > 0 or doc_id % 3 = 2"), "doc_id")


@query(
    "x02_live_over_mirror",
    """WITH t AS (SELECT slug, seq, coalesce(ver % 40 = slug % 40, false) AS live FROM v_transitions), l AS (SELECT slug, max(seq) AS last FROM t WHERE live GROUP BY slug), m AS (SELECT slug, max(seq) AS last FROM t WHERE NOT live GROUP BY slug)
    SELECT slug, last, 'live' AS source FROM l UNION ALL SELECT slug, last, 'mirror' FROM m WHERE slug NOT IN (SELECT slug FROM l)""",
)
def x02(t):
    """Every transition is either live or mirrored."""
    tr = views.v_transitions(t).withColumn("live", F.coalesce(F.col("ver") % 40 == F.col("slug") % 40, F.lit(False)))
    last = F.max("seq").alias("last")
    return S.prefer_live(tr.filter("live").groupBy("slug").agg(last), tr.filter("NOT live").groupBy("slug").agg(last), "slug")


EXTS = ("/a.txt", "/logs/x", ".png", "/run.LOG.2", "/b.jsonl", "/deep/.git/c", "")


@query(
    "x03_scope_exclusion",
    """SELECT page_id, path || ['/a.txt', '/logs/x', '.png', '/run.LOG.2', '/b.jsonl', '/deep/.git/c', ''][page_id % 7 + 1] AS path FROM (SELECT page_id, host || '/' || path AS path FROM v_paths) p
    WHERE (page_id % 7 IN (0, 6) OR (page_id % 7 = 2 AND path LIKE '%/')) AND NOT starts_with(path, 'm.')""",
)
def x03(t):
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTS]), (F.col("page_id") % 7 + 1).cast("int"))
    p = views.v_paths(t).select("page_id", F.concat("host", F.lit("/"), "path", ext).alias("path"))
    return S.exclude_paths(p, "path", prefixes=("ops/runtime/", "m."))


@query(
    "x04_population_union",
    """WITH r AS (SELECT doc_id FROM documents WHERE doc_id % 3 = 0), u AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 <> 0)
    SELECT doc_id, 'routed' AS population FROM r UNION ALL SELECT doc_id, 'unrouted' FROM u WHERE doc_id NOT IN (SELECT doc_id FROM r)""",
)
def x04(t):
    d = t("documents").select("doc_id")
    return S.census_population(d.filter("doc_id % 3 = 0"), d.filter("doc_id % 2 = 0 or doc_id % 3 <> 0"), "doc_id")


@query(
    "x05_all_files_ignored",
    r"""SELECT host, bool_and((regexp_matches(p, '^(.*/)?[^/]*\.html$') OR regexp_matches(p, '^en/.*$')) AND (regexp_matches(p, '^[^/][^/]/[^/]*$'))) AS ignored FROM (SELECT host, path AS p FROM v_paths) x GROUP BY host""",
)
def x05(t):
    return S.ignored_by_all(views.v_paths(t), "host", "path", {"push": ["**/*.html", "en/**"], "pull_request": ["??/*"]})


@query(
    "x06_stale_mentions",
    """WITH t AS (SELECT unnest(['the of', 'und der', 'la que']) AS term), d AS (SELECT CASE WHEN doc_id % 9 = 0 THEN 'docs/LEDGER/' ELSE 'docs/' END || doc_id AS path, text FROM documents)
    SELECT path, term FROM d, t WHERE contains(text, term) AND NOT contains(path, 'LEDGER')""",
)
def x06(t):
    folder = F.when(F.col("doc_id") % 9 == 0, "docs/LEDGER/").otherwise("docs/")
    d = t("documents").select(F.concat(folder, F.col("doc_id").cast("string")).alias("path"), "text")
    return S.stale_mentions(d, "path", "text", ["the of", "und der", "la que"])
