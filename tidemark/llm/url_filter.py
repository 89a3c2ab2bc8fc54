"""URL filters: host-suffix and path-prefix expressions against hashed rules.

Every URL is expanded into the expressions that could be rules, joined with the
rules on the first four bytes of SHA-256, confirmed by the whole digest, and the
longest rule wins (ties: the longer host, then block before allow).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, sheltered, table

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Verdict where no rule fits: a URL filter lists what to keep out.
DEFAULT = "allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """Rules as ``(action, host, path)`` in a local relation, whose size the planner knows."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if not rules:
        return spark.sql("SELECT '' AS action, '' AS host, '' AS path WHERE false")
    rows = ", ".join(f"({', '.join(map(quote, r))})" for r in rules)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(action, host, path)")


def hashed(rules: DataFrame) -> DataFrame:
    """Rules with the digest of their expression and its short prefix; the last of equal rules by action is block."""
    rules = rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "action").dropna()
    digest = F.sha2(F.concat("rule_host", "rule_path").cast("binary"), 256)
    return rules.withColumn("digest", digest).withColumn("short", F.substr("digest", F.lit(1), F.lit(8)))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; columns of those names are replaced.

    A null URL, or one without ``://``, has an empty host and path, no rule and the
    default verdict. Repeated URLs are judged once and keep all their rows. An empty
    rule table gives every row the default. Expressions are built only at lengths that
    rules have, so a long host or path costs no more than there are rule lengths; these
    lengths (not rules) come to the driver, at most as many as a URL has characters.
    """
    known = hashed(rules)
    lens = known.agg(F.collect_set(F.length("rule_host")), F.collect_set(F.length("rule_path"))).first()
    hosts_at, paths_at = (F.array(*map(F.lit, sorted(x))).cast("array<int>") for x in lens)
    host, path = split_url(F.col("u"))
    urls = pages.select(F.col(url).alias("u")).dropna().distinct().select("u", host.alias("h"), path.alias("p")).filter("h <> ''")
    fits = F.filter(hosts_at, lambda n: (n == F.length("h")) | ((n < F.length("h")) & (F.substr("h", F.length("h") - n, F.lit(1)) == ".")))
    reach = F.filter(paths_at, lambda n: n <= F.length("p"))
    terms = urls.select("u", "p", F.explode(F.transform(fits, lambda n: F.right(F.col("h"), n))).alias("host_part"), reach.alias("at"))
    terms = terms.select("u", F.explode(F.transform("at", lambda n: F.concat("host_part", F.left(F.col("p"), n)))).alias("term"))
    terms = terms.withColumn("full", F.sha2(F.col("term").cast("binary"), 256)).withColumn("short", F.substr("full", F.lit(1), F.lit(8)))
    hits = terms.join(known, "short").filter("full = digest")
    order = F.struct(F.length("term"), F.length("rule_host"), F.col("action") == "block")
    best = hits.groupBy("u").agg(F.max_by(F.struct("term", "action"), order).alias("_best")).withColumnRenamed("u", "_url")
    host, path = split_url(F.col(url))

    def judged(rows: DataFrame) -> DataFrame:
        out = rows.withColumns({"host": host, "path": path}).join(best, F.col(url) == F.col("_url"), "left")
        return out.withColumns({"rule": F.col("_best.term"), "verdict": F.coalesce("_best.action", F.lit(default))})

    return sheltered(pages, (url,), ("host", "path", "rule", "verdict"), judged)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
), parts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts
), rules(action, rh, rp) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), hits AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(action, length(rh || rp)) AS action
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.action, 'allow') AS verdict FROM parts p LEFT JOIN hits h USING (page_id)
"""


def register(queries: dict, oracles: dict) -> None:
    queries["op2_url_filter"] = op2_url_filter
    oracles["op2_url_filter"] = SQL
