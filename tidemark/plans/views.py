"""The driver tables seen through each operator's own input schema.

``SQL`` holds the same definitions for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import sign_hash
from tidemark.session import Tables

OPS = {
    "signup": "INTAKE",
    "view": "SAVE_WORKING",
    "click": "SUBMIT",
    "error": "REJECT",
    "purchase": "APPROVE_CLEAN",
}


def epoch_us(col) -> F.Column:
    """Microseconds of a zone-free stamp."""
    return F.unix_micros(F.col(col).cast("timestamp"))


def v_transitions(t: Tables) -> DataFrame:
    op = F.create_map(*[F.lit(x) for pair in OPS.items() for x in pair])
    ver = F.get_json_object("props", "$.k").cast("int")
    return t("events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("slug"),
        "ts",
        op[F.col("event_type")].alias("op"),
        ver.alias("ver"),
        "value",
        F.md5(F.concat_ws(":", F.col("user_id").cast("string"), (ver % 10).cast("string")).cast("binary")).alias("sha_out"),
    )


def v_metrics(t: Tables) -> DataFrame:
    return t("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("asset"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("variant"),
        F.when(F.col("l_linestatus") == "F", "downscale-only").otherwise("full").alias("backend"),
        (1 - F.col("l_tax") / 2).alias("msssim"),
        (2.5 * F.col("l_discount")).alias("lpips"),
        (F.col("l_quantity") / 25).alias("lap_ratio"),
        F.col("l_discount").alias("halo_pct"),
        F.col("l_tax").alias("band_delta"),
    )


def v_versions(t: Tables) -> DataFrame:
    m = v_metrics(t)
    return m.groupBy("l_orderkey", "l_linenumber").agg(
        *[F.round(F.avg(c), 6).alias(c) for c in ("msssim", "lpips", "lap_ratio", "halo_pct", "band_delta")]
    )


def v_boxes(t: Tables) -> DataFrame:
    x0, y0 = F.col("l_quantity") * 40, (F.col("l_partkey") % 1200).cast("double")
    return t("lineitem").select(
        F.col("l_orderkey").alias("asset"),
        x0.alias("x0"),
        y0.alias("y0"),
        (x0 + 20 + 30 * F.col("l_linenumber")).alias("x1"),
        (y0 + 60).alias("y1"),
        (10 * F.col("l_discount")).alias("conf"),
    )


def v_rasters(t: Tables) -> DataFrame:
    cells = t("embeddings").select(F.col("vec_id").alias("id"), "label", F.posexplode("embedding").alias("i", "e"))
    return cells.select(
        "id",
        "label",
        F.floor(F.col("i") / 8).cast("int").alias("y"),
        (F.col("i") % 8).alias("x"),
        (127.5 * (1 + F.col("e").cast("double"))).alias("v"),
    )


def v_hashes(t: Tables) -> DataFrame:
    return t("embeddings").select(
        "vec_id",
        "label",
        sign_hash(F.transform("embedding", lambda e: e > 0), 64).alias("phash"),
        sign_hash(
            F.transform(
                "embedding", lambda e, i: F.element_at("embedding", ((i + 1) % 64 + 1).cast("int")) > e
            ),
            64,
        ).alias("dhash"),
    )


def v_hash_targets(t: Tables) -> DataFrame:
    flip = F.expr("shiftleft(1L, cast(vec_id % 20 as int)) - 1")
    return v_hashes(t).select(
        F.col("vec_id").alias("target"),
        F.col("phash").bitwiseXOR(flip).alias("phash"),
        F.col("dhash").bitwiseXOR(flip).alias("dhash"),
    )


JOINTS = ("left_shoulder", "right_shoulder", "left_hip", "right_hip", "nose", "left_ear", "right_ear")


def v_keypoints(t: Tables) -> DataFrame:
    e = [F.element_at("embedding", i + 1).cast("double") for i in range(21)]
    points = [
        x
        for j, name in enumerate(JOINTS)
        for x in (
            F.lit(name),
            F.struct(e[3 * j].alias("x"), e[3 * j + 1].alias("y"), (3 * F.abs(e[3 * j + 2])).alias("conf")),
        )
    ]
    return t("embeddings").select("vec_id", "label", F.create_map(*points).alias("kp"))


def v_intervals(t: Tables) -> DataFrame:
    ship = t("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("e"))
    o = t("orders")
    return (
        o.join(ship, o.o_orderkey == ship.l_orderkey)
        .filter(F.col("e") > F.col("o_orderdate"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.floor(epoch_us("o_orderdate") / 1_000_000).cast("long").alias("s"),
            F.floor(epoch_us("e") / 1_000_000).cast("long").alias("e"),
            F.col("o_orderpriority").alias("owner"),
        )
    )


def file_path() -> Column:
    """Where a document lies as a file."""
    return F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def v_files(t: Tables) -> DataFrame:
    return t("documents").select(
        "doc_id",
        file_path().alias("path"),
        "source",
        "lang",
        F.col("n_chars").alias("size"),
        F.sha2("text", 256).alias("sha"),
    )


def v_entries(t: Tables) -> DataFrame:
    return t("conversations").select(F.col("conv_id").alias("transcript"), F.col("turn").alias("seq"), "role", "text")


def v_paths(t: Tables) -> DataFrame:
    rest = F.regexp_extract("url", r"^[a-z]+://[^/]+/([^?#]*)", 1)
    return t("pages").select(
        "page_id", F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1).alias("host"), rest.alias("path")
    )


SQL: dict[str, str] = {
    "v_transitions": """
  SELECT event_id AS seq, user_id AS slug, ts,
    CASE event_type WHEN 'signup' THEN 'INTAKE' WHEN 'view' THEN 'SAVE_WORKING' WHEN 'click' THEN 'SUBMIT'
      WHEN 'error' THEN 'REJECT' WHEN 'purchase' THEN 'APPROVE_CLEAN' END AS op,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS ver, value,
    md5(user_id || ':' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 10)) AS sha_out
  FROM events""",
    "v_metrics": """
  SELECT l_orderkey * 10 + l_linenumber AS asset, l_orderkey, l_linenumber, l_returnflag AS variant,
    CASE WHEN l_linestatus = 'F' THEN 'downscale-only' ELSE 'full' END AS backend,
    1 - l_tax / 2 AS msssim, 2.5 * l_discount AS lpips, l_quantity / 25 AS lap_ratio,
    l_discount AS halo_pct, l_tax AS band_delta
  FROM lineitem""",
    "v_versions": """
  SELECT l_orderkey, l_linenumber, round(avg(msssim), 6) AS msssim, round(avg(lpips), 6) AS lpips,
    round(avg(lap_ratio), 6) AS lap_ratio, round(avg(halo_pct), 6) AS halo_pct, round(avg(band_delta), 6) AS band_delta
  FROM v_metrics GROUP BY ALL""",
    "v_boxes": """
  SELECT l_orderkey AS asset, l_quantity * 40 AS x0, CAST(l_partkey % 1200 AS DOUBLE) AS y0,
    l_quantity * 40 + 20 + 30 * l_linenumber AS x1, CAST(l_partkey % 1200 AS DOUBLE) + 60 AS y1,
    10 * l_discount AS conf
  FROM lineitem""",
    "v_rasters": """
  SELECT vec_id AS id, label, CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x,
    127.5 * (1 + CAST(embedding[i + 1] AS DOUBLE)) AS v
  FROM embeddings, (SELECT unnest(range(64)) AS i) r""",
    "v_hashes": """
  SELECT vec_id, label,
    CAST(sum(CASE WHEN embedding[i + 1] > 0 AND i < 63 THEN 1::HUGEINT << i ELSE 0::HUGEINT END)
      - max(CASE WHEN i = 63 AND embedding[64] > 0 THEN 1::HUGEINT << 63 ELSE 0::HUGEINT END) AS BIGINT) AS phash,
    CAST(sum(CASE WHEN embedding[(i + 1) % 64 + 1] > embedding[i + 1] AND i < 63 THEN 1::HUGEINT << i ELSE 0::HUGEINT END)
      - max(CASE WHEN i = 63 AND embedding[1] > embedding[64] THEN 1::HUGEINT << 63 ELSE 0::HUGEINT END) AS BIGINT) AS dhash
  FROM embeddings, (SELECT unnest(range(64)) AS i) r GROUP BY vec_id, label""",
    "v_hash_targets": """
  SELECT vec_id AS target, xor(phash, (1::BIGINT << (vec_id % 20)::INT) - 1) AS phash,
    xor(dhash, (1::BIGINT << (vec_id % 20)::INT) - 1) AS dhash
  FROM v_hashes""",
    "v_keypoints": """
  SELECT vec_id, label, j AS joint, CAST(embedding[3 * j + 1] AS DOUBLE) AS x, CAST(embedding[3 * j + 2] AS DOUBLE) AS y,
    3 * abs(CAST(embedding[3 * j + 3] AS DOUBLE)) AS conf
  FROM embeddings, (SELECT unnest(range(7)) AS j) r""",
    "v_intervals": """
  SELECT o_orderkey AS id, CAST(epoch(o_orderdate) AS BIGINT) AS s, CAST(epoch(m) AS BIGINT) AS e, o_orderpriority AS owner
  FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) x ON o_orderkey = l_orderkey
  WHERE m > o_orderdate""",
    "v_files": """
  SELECT doc_id, source || '/' || lang || '/' || doc_id || '.txt' AS path, source, lang, n_chars AS size, sha256(text) AS sha
  FROM documents""",
    "v_entries": """
  SELECT conv_id AS transcript, turn AS seq, role, text FROM conversations""",
    "v_paths": """
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host,
    regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1) AS path
  FROM pages""",
}
