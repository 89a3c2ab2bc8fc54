"""Naming, token, path and time queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import hashing, naming, timing
from tidemark.plans import views
from tidemark.plans.registry import query


@query(
    "p01_slugify",
    r"""WITH n AS (SELECT 'url' AS kind, page_id AS id, regexp_replace(url, '^.*/', '') AS name FROM pages
      UNION ALL SELECT 'line', doc_id, split_part(text, chr(10), 1) FROM documents
      UNION ALL SELECT 'part', p_partkey, ['CON.png', '--Foo---Bar--.png', '???.jpg', 'lpt1', '.hidden', 'a..png'][p_partkey % 6 + 1] FROM part),
    b AS (SELECT kind, id, regexp_replace(name, '(?s)^.*[/\\]', '') AS name FROM n),
    s AS (SELECT kind, id, lower(regexp_replace(strip_accents(CASE WHEN kind = 'line' THEN name ELSE regexp_replace(name, '(?s)^(\.*[^.].*)\.[^.]*$', '\1') END), '[^\x00-\x7F]', '', 'g')) AS a FROM b),
    d AS (SELECT kind, id, regexp_replace(substr(regexp_replace(regexp_replace(a, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 64), '-+$', '') AS c FROM s)
    SELECT kind, id, CASE WHEN c = '' THEN 'img' WHEN regexp_matches(c, '^(con|prn|aux|nul|com[1-9]|lpt[1-9])$') THEN c || '-x' ELSE c END AS slug FROM d""",
)
def p01(t):
    odd = F.array(*[F.lit(x) for x in ("CON.png", "--Foo---Bar--.png", "???.jpg", "lpt1", ".hidden", "a..png")])
    # a document line is no file name: guard it with an extension that is then cut
    names = (
        t("pages").select(F.lit("url").alias("kind"), F.col("page_id").alias("id"), naming.basename(F.col("url")).alias("name"))
        .unionByName(
            t("documents").select(
                F.lit("line").alias("kind"),
                F.col("doc_id").alias("id"),
                F.concat(naming.basename(F.substring_index("text", "\n", 1)), F.lit(".txt")).alias("name"),
            )
        )
        .unionByName(
            t("part").select(
                F.lit("part").alias("kind"),
                F.col("p_partkey").alias("id"),
                F.element_at(odd, (F.col("p_partkey") % 6 + 1).cast("int")).alias("name"),
            )
        )
    )
    return names.select("kind", "id", naming.slugify(F.col("name")).alias("slug"))


NAMES_SQL = """SELECT seq, 's' || slug || '_' || ['first', 'clean', 'final', 'last'][seq % 4 + 1] ||
      CASE op WHEN 'INTAKE' THEN 'initial' WHEN 'SUBMIT' THEN 'needauth' WHEN 'APPROVE_CLEAN' THEN 'done'
        WHEN 'SAVE_WORKING' THEN 'working_' || lpad(ver::VARCHAR, 2, '0') ELSE 'odd' END || '.' ||
      ['png', 'JPG', 'webp', 'gif', 'jpeg'][ver % 5 + 1] AS name FROM v_transitions"""


def milestone_names(t):
    """A file name per transition, some outside the grammar."""
    tr = views.v_transitions(t)
    stage = F.element_at(F.array(*[F.lit(s) for s in ("first", "clean", "final", "last")]), (F.col("seq") % 4 + 1).cast("int"))
    ext = F.element_at(F.array(*[F.lit(s) for s in ("png", "JPG", "webp", "gif", "jpeg")]), F.col("ver") % 5 + 1)
    phase = F.create_map(
        *[F.lit(x) for x in ("INTAKE", "initial", "SUBMIT", "needauth", "APPROVE_CLEAN", "done", "SAVE_WORKING", "working", "REJECT", "odd")]
    )[F.col("op")]
    slug = F.concat(F.lit("s"), F.col("slug").cast("string"))
    return tr.select("*", naming.milestone_name(slug, stage, phase, F.col("ver"), ext).alias("name"))


PARSED_SQL = rf"""SELECT seq, name, regexp_extract(name, '^([a-z0-9][a-z0-9-]*)_', 1) AS slug,
      regexp_extract(name, '_(first|clean|final|last)', 1) AS stage,
      CASE WHEN name LIKE '%working%' THEN 'working' ELSE regexp_extract(name, '(initial|needauth|done)', 1) END AS phase,
      coalesce(TRY_CAST(regexp_extract(name, 'working_([0-9]+)', 1) AS BIGINT), -1) AS ver, lower(regexp_extract(name, '\.([A-Za-z]+)$', 1)) AS ext
    FROM ({NAMES_SQL}) n WHERE name NOT LIKE '%odd.%' AND name NOT LIKE '%.gif'"""


@query("p02_milestone_parse", PARSED_SQL)
def p02(t):
    return (
        milestone_names(t)
        .select("seq", "name", naming.parse_milestone(F.col("name")).alias("m"))
        .filter("m is not null")
        .select("seq", "name", "m.slug", "m.stage", "m.phase", F.coalesce("m.ver", F.lit(-1)).cast("long").alias("ver"), "m.ext")
    )


@query("p03_milestone_name", NAMES_SQL)
def p03(t):
    return milestone_names(t).select("seq", "name")


@query(
    "p04_milestone_key",
    f"""SELECT seq, slug || '/' || stage || '/' || phase || '/' || CASE WHEN ver >= 0 THEN ver::VARCHAR ELSE '-' END AS key FROM ({PARSED_SQL}) p""",
)
def p04(t):
    return milestone_names(t).select("seq", naming.milestone_key(F.concat(F.lit("dir/"), "name")).alias("key")).filter(
        "key is not null"
    )


@query(
    "p05_token_decode",
    """SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN -1 ELSE p_partkey + 2176782336 END AS number FROM part""",
)
def p05(t):
    token = F.concat(F.lit("d"), F.lower(F.conv((F.col("p_partkey") + 2176782336).cast("string"), 10, 36)))
    name = (
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("a_title_by_someone_"), token, F.lit("-pre.jpg")))
        .when(F.col("p_partkey") % 5 == 1, F.concat(token, F.lit("-0a1b2c3d.jpg")))
        .when(F.col("p_partkey") % 5 == 2, token)
        .when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("x_"), token, F.lit("-fullview.png")))
        .otherwise(F.concat(F.col("p_partkey").cast("string"), F.lit(".jpeg")))
    )
    return t("part").select("p_partkey", F.coalesce(naming.decode_token(name), F.lit(-1)).alias("number"))


ARTIST_SQL = """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'pic_by_' || replace(seg, '_', '-') || '_dabc1234-pre.jpg' WHEN 1 THEN 'Pic_BY_a_' || seg || '_dabc1234-pre.jpg'
      WHEN 2 THEN 'dabc1234-' || seg || '.jpg' ELSE 'pic_by_A' || page_id || '_dabc1234-x.png' END AS name, page_id % 4 AS kind, lower(replace(seg, '_', '-')) AS seg
    FROM (SELECT page_id, regexp_extract(host, '^([a-z0-9-]+)', 1) AS seg FROM v_paths) p"""


def _artist_names(t):
    seg = F.regexp_extract("host", "^([a-z0-9-]+)", 1)
    m = F.col("page_id") % 4
    return views.v_paths(t).select(
        "page_id",
        F.when(m == 0, F.concat(F.lit("pic_by_"), F.replace(seg, F.lit("_"), F.lit("-")), F.lit("_dabc1234-pre.jpg")))
        .when(m == 1, F.concat(F.lit("Pic_BY_a_"), seg, F.lit("_dabc1234-pre.jpg")))
        .when(m == 2, F.concat(F.lit("dabc1234-"), seg, F.lit(".jpg")))
        .otherwise(F.concat(F.lit("pic_by_A"), F.col("page_id").cast("string"), F.lit("_dabc1234-x.png")))
        .alias("name"),
    )


@query(
    "p06_artist_segment",
    f"""SELECT page_id, ['recovered', 'ambiguous', 'absent', 'recovered'][kind + 1] AS status,
      CASE kind WHEN 0 THEN seg WHEN 3 THEN 'a' || page_id END AS artist FROM ({ARTIST_SQL}) a""",
)
def p06(t):
    return _artist_names(t).select("page_id", naming.artist_segment(F.col("name")).alias("a")).select(
        "page_id", "a.status", "a.artist"
    )


@query(
    "p07_canonical_url",
    f"""SELECT page_id, CASE kind WHEN 0 THEN 'https://art.example.com/' || seg || '/art/x-' || 22453156048 WHEN 3 THEN 'https://art.example.com/a' || page_id || '/art/x-' || 22453156048 END AS url
    FROM ({ARTIST_SQL}) a""",
)
def p07(t):
    names = _artist_names(t)
    a = naming.artist_segment(F.col("name"))["artist"]
    return names.select("page_id", naming.canonical_url("https://art.example.com", a, naming.decode_token(F.col("name"))).alias("url"))


@query(
    "p11_phase_stage",
    """WITH e AS (SELECT seq, CASE WHEN ver % 5 = 0 THEN ' 0' || (ver % 9) || ' ' WHEN ver % 5 = 1 THEN 'x' END AS stage,
      ['PENDING_INTAKE', 'first_scratch', 'CLEAN_DONE', 'odd', 'PASSED', 'LAST_SCRATCH'][ver % 6 + 1] AS state,
      CASE op WHEN 'SUBMIT' THEN 'NEEDAUTH' WHEN 'SAVE_WORKING' THEN 'editing' WHEN 'APPROVE_CLEAN' THEN 'APPROVED_PENDING_MOVE' END AS sub, ver % 3 AS wm,
      CASE WHEN ver % 7 = 0 THEN '_cleandone' END AS phase FROM v_transitions)
    SELECT seq, CASE WHEN ver0 IS NOT NULL THEN ver0 WHEN upper(state) = 'PENDING_INTAKE' THEN '0' WHEN upper(state) = 'FIRST_SCRATCH' THEN '1'
        WHEN state = 'CLEAN_DONE' THEN '4' WHEN state = 'PASSED' THEN '9' WHEN state = 'LAST_SCRATCH' THEN '7' ELSE '?' END AS stage,
      CASE WHEN phase IS NOT NULL THEN phase WHEN sub = 'NEEDAUTH' THEN '_needauth' WHEN sub = 'APPROVED_PENDING_MOVE' THEN '_done'
        WHEN sub = 'editing' THEN CASE WHEN wm >= 1 THEN '_working' ELSE '_initial' END
        WHEN state IN ('CLEAN_DONE', 'PASSED') THEN '_done' WHEN state IN ('first_scratch', 'LAST_SCRATCH') THEN '_working' ELSE '_initial' END AS phase
    FROM (SELECT *, CASE WHEN stage LIKE ' 0%' THEN CAST(CAST(trim(stage) AS INT) AS VARCHAR) END AS ver0 FROM e) x""",
)
def p11(t):
    v = F.col("ver")
    stage = F.when(v % 5 == 0, F.concat(F.lit(" 0"), (v % 9).cast("string"), F.lit(" "))).when(v % 5 == 1, "x")
    state = F.element_at(
        F.array(*[F.lit(s) for s in ("PENDING_INTAKE", "first_scratch", "CLEAN_DONE", "odd", "PASSED", "LAST_SCRATCH")]), v % 6 + 1
    )
    sub = (
        F.when(F.col("op") == "SUBMIT", "NEEDAUTH")
        .when(F.col("op") == "SAVE_WORKING", "editing")
        .when(F.col("op") == "APPROVE_CLEAN", "APPROVED_PENDING_MOVE")
    )
    phase = F.when(v % 7 == 0, "_cleandone")
    return views.v_transitions(t).select(
        "seq", naming.derive_stage(stage, state).alias("stage"), naming.derive_phase(phase, sub, state, v % 3).alias("phase")
    )


@query(
    "p30_time_and_age",
    """WITH e AS (SELECT event_id, ts, event_id % 5 AS k, epoch_us(ts) / 1000000.0::DOUBLE AS ep FROM events),
    p AS (SELECT event_id, CASE k WHEN 0 THEN ep WHEN 1 THEN ep - 7200 WHEN 4 THEN floor(ep) END AS epoch_s FROM e),
    a AS (SELECT *, CASE WHEN epoch_s IS NOT NULL THEN greatest(0.0, 1705000000.0 - epoch_s) END AS age FROM p)
    SELECT event_id, round(epoch_s, 3) AS epoch_s, round(age, 3) AS age_s, CASE WHEN age IS NULL THEN '-' WHEN age < 90 THEN CAST(floor(age) AS BIGINT) || 's'
      WHEN age < 5400 THEN CAST(floor(age / 60) AS BIGINT) || 'm' WHEN age < 172800 THEN CAST(floor(age / 3600) AS BIGINT) || 'h' ELSE CAST(floor(age / 86400) AS BIGINT) || 'd' END AS human FROM a""",
)
def p30(t):
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    k = F.col("event_id") % 5
    text = (
        F.when(k == 0, F.concat(base, F.lit("Z")))
        .when(k == 1, F.concat(base, F.lit("+02:00")))
        .when(k == 2, base)
        .when(k == 3, F.concat(F.lit("at "), base))
        .otherwise(F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("z")))
    )
    e = t("events").select("event_id", timing.parse_iso(text).alias("ep"))
    age = timing.age_s(F.lit(1705000000.0), F.col("ep"))
    return e.select(
        "event_id", F.round("ep", 3).alias("epoch_s"), F.round(age, 3).alias("age_s"), timing.human_age(age).alias("human")
    )


@query(
    "p31_hamming",
    """SELECT a.vec_id, CAST(bit_count(xor(a.phash, b.phash)) AS BIGINT) AS p_dist, CAST(bit_count(xor(a.dhash, b.dhash)) AS BIGINT) AS d_dist
    FROM v_hashes a JOIN v_hash_targets b ON a.vec_id = b.target""",
)
def p31(t):
    a, b = views.v_hashes(t), views.v_hash_targets(t).withColumnsRenamed({"phash": "p2", "dhash": "d2"})
    return a.join(b, a.vec_id == b.target).select(
        "vec_id",
        hashing.hamming("phash", "p2").cast("long").alias("p_dist"),
        hashing.hamming("dhash", "d2").cast("long").alias("d_dist"),
    )


@query(
    "p32_hash_prefix",
    """WITH h AS (SELECT o_orderkey, sha256(o_orderkey::VARCHAR) AS x, sha256((o_orderkey - o_orderkey % 3)::VARCHAR) AS y FROM orders)
    SELECT o_orderkey, (substr(x, 1, 7) = substr(y, 1, 7)) AS seven, substr(x, 1, 8) = substr(y, 1, 8) AS eight, false AS short FROM h""",
)
def p32(t):
    x = F.sha2(F.col("o_orderkey").cast("string"), 256)
    y = F.sha2((F.col("o_orderkey") - F.col("o_orderkey") % 3).cast("string"), 256)
    return t("orders").select(
        "o_orderkey",
        hashing.sha_match(F.upper(F.substring(x, 1, 7)), F.substring(y, 1, 40)).alias("seven"),
        hashing.sha_match(F.substring(x, 1, 40), F.concat(F.lit(" "), F.substring(y, 1, 8))).alias("eight"),
        hashing.sha_match(F.substring(x, 1, 5), y).alias("short"),
    )


@query(
    "p33_path_key",
    r"""SELECT page_id, CASE WHEN page_id % 7 IN (1, 2, 5) OR path = '' THEN NULL ELSE
      CASE WHEN page_id % 7 = 6 THEN 'docs/' ELSE '' END || lower(trim(regexp_replace(path, '/+', '/', 'g'), '/')) END AS key,
      page_id % 7 = 6 AND path <> '' AS in_docs FROM v_paths""",
)
def p33(t):
    m, p = F.col("page_id") % 7, F.col("path")
    raw = (
        F.when(m == 0, F.concat(F.lit(" ./"), p))
        .when(m == 1, F.concat(F.lit("/"), p))
        .when(m == 2, F.concat(F.lit("a/../../"), p))
        .when(m == 3, F.concat(F.lit("x/../"), F.upper(p)))
        .when(m == 4, F.replace(p, F.lit("/"), F.lit("\\")))
        .when(m == 5, F.concat(F.lit("C:/"), p))
        .otherwise(F.concat(F.lit("docs//"), p))
    )
    key = naming.claim_key(raw)
    return views.v_paths(t).select(
        "page_id", key.alias("key"), F.coalesce(naming.contains(F.lit("docs"), key) & (p != ""), F.lit(False)).alias("in_docs")
    )
