"""Column rules against published expected values."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import gates as G
from tidemark.functions import geometry as geo
from tidemark.functions import naming, text, timing
from tidemark.operators import matching, sets, wording


def one(spark, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])


@pytest.mark.parametrize(
    "name, slug",
    [
        ("Ahri_Star Guardian_fullview.jpg", "ahri-star-guardian-fullview"),
        ("--Foo---Bar--.png", "foo-bar"),
        ("CON.png", "con-x"),
        ("\u30a2\u30ea.png", "img"),
        ("caf\u00e9 \u00e9toile.png", "cafe-etoile"),
    ],
)
def test_slugify(spark, name, slug):
    assert one(spark, n=name).select(naming.slugify(F.col("n"))).first()[0] == slug


@pytest.mark.parametrize(
    "name, number",
    [
        ("dlnxav6", 1309974594),
        ("dark_cosmic_ahri_by_someone_dlnxav6-pre.jpg", 1309974594),
        ("xayah_by_pebano1_dm44iab-fullview.jpg", 1337184659),
        ("1341679.jpeg", None),
    ],
)
def test_token(spark, name, number):
    assert one(spark, n=name).select(naming.decode_token(F.col("n"))).first()[0] == number


BASE = {"msssim": 0.985, "lpips": 0.10, "lap_ratio": 2.0, "halo_pct": 0.0, "band_delta": 0.0}


@pytest.mark.parametrize(
    "change, verdict",
    [
        ({}, "PASS"), ({"msssim": 0.97}, "FLAG"), ({"halo_pct": 0.2}, "FLAG"), ({"band_delta": 0.5}, "FLAG"),
        ({"lap_ratio": 0.8}, "FAIL"), ({"lpips": 0.25}, "FAIL"), ({"msssim": 0.97, "lap_ratio": 0.8}, "FAIL"), ({"msssim": None, "lpips": None}, "PASS"),
    ],
)
def test_gate_verdict(spark, change, verdict):
    m = {k: F.lit(v).cast("double") for k, v in {**BASE, **change}.items()}
    row = spark.range(1).select(G.gate_verdict(m).alias("g")).select("g.*").first()
    assert row.verdict == verdict and (len(row.reasons) == 0) == (verdict == "PASS")


def route(spark, **kw):
    d = dict(n=1, conf=0.8507, credit=False, keep=False, area=1.6414, cx=1241.3, cy=993.3, w=2560.0, h=1440.0, overlay=0.0, faint=0)
    d.update(kw)
    r = spark.range(1).select(G.route(*[F.lit(v) for v in d.values()]).alias("r")).select("r.*").first()
    return r.verdict, r.reason


def test_route(spark):
    assert route(spark, credit=True) == ("auto", "watermark_ocr")
    assert route(spark, n=0) == ("clean", "no_detections")
    assert route(spark, n=0, faint=1) == ("qa", "faint_mark")
    assert route(spark, keep=True) == ("clean", "lol_logo")
    assert route(spark, cy=1300.0) == ("auto", "bottom_banner")
    assert route(spark, n=0, overlay=0.15) == ("qa", "centre_overlay")


def test_credit_and_wordmark(spark):
    rows = [(1, "DBIMANTART"), (2, "@"), (3, "see LEAGUEor LEGENDS now"), (4, "plain words here"), (5, "me@x.com"), (6, "@namakxin")]
    d = spark.createDataFrame(rows, "id long, t string")
    credit = {r.id: r.credit for r in wording.fuzzy_credit(d, "id", "t").collect()}
    keep = {r.id: r.keep for r in wording.keep_wordmark(d, "id", "t").collect()}
    assert credit == {1: True, 2: False, 3: False, 4: False, 5: True, 6: True}
    assert keep == {1: False, 2: False, 3: True, 4: False, 5: False, 6: False}


def test_path_key(spark):
    cases = {"TOOLS\\X.PY": "tools/x.py", "./a//b/": "a/b", "a/../b": "b", "../a": None, "/abs": None, "C:/x": None, "": None, "a/..": None}
    d = spark.createDataFrame(list(cases.items()), "p string, want string")
    for r in d.select("p", "want", naming.claim_key(F.col("p")).alias("got")).collect():
        assert r.got == r.want, r.p


def test_summary_counts(spark):
    t = "1 failed, 9 passed in 2s\n== 3 passed, 1 error, 2 errors in 4s ==\nfree text 99 passed"
    r = one(spark, t=t).select(text.parse_counts(F.col("t")).alias("c")).select("c.*").first()
    assert (r.passed, r.failed, r.errors, r.skipped, r.no_tests) == (3, None, 3, None, False)


def test_mojibake_beside_quotes(spark):
    t = "a\u201cb\u201d \u00e2\u20ac\u201d \u201d\u20ac"
    assert one(spark, t=t).select(text.ascii_punct(F.col("t"))).first()[0] == 'a"b" \u00e2\u20ac\u201d \u201d\u20ac'


def test_times(spark):
    r = one(spark, a="2026-08-01T00:00:00Z", b="2026-08-01T00:00:00", c="junk").select(
        timing.parse_iso(F.col("a")).alias("a"), timing.parse_iso(F.col("b")).alias("b"), timing.parse_iso(F.col("b"), "utc").alias("u"), timing.parse_iso(F.col("c")).alias("c")
    ).first()
    assert r.a == 1785542400.0 and r.b is None and r.u == r.a and r.c is None


def test_globs():
    import re

    assert re.match(sets.glob_regex("**/*.md"), "ROADMAP.md") and re.match(sets.glob_regex("**/*.md"), "docs/a/b.md")
    assert not re.match(sets.glob_regex("*.md"), "docs/a.md") and re.match(sets.glob_regex("a?c"), "abc")


def test_axis_offset(spark):
    kp = {"left_shoulder": (0.0, 0.0), "right_shoulder": (2.0, 0.0), "left_hip": (0.0, 4.0), "right_hip": (2.0, 4.0), "nose": (2.0, -1.0)}
    m = F.create_map(*[x for n, (a, b) in kp.items() for x in (F.lit(n), F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.lit(0.9).alias("conf")))])
    r = spark.range(1).select(geo.axis_offset(m).alias("o")).select("o.*").first()
    assert r.reason is None and abs(abs(r.offset) - 1.0) < 1e-12 and abs(abs(r.offset_norm) - 0.5) < 1e-12


def test_resolve_key_prefers_exact(spark):
    known = spark.createDataFrame([("abc", 1), ("ab", 2)], "key string, ord long")
    names = spark.createDataFrame([("ab",), ("a",), ("zz",)], "name string")
    got = {r.name: (r.key, r.how) for r in matching.resolve_key(names, known).collect()}
    assert got == {"ab": ("ab", "exact"), "a": ("abc", "prefix"), "zz": (None, "unresolved")}


def test_null_groups_have_percentiles(spark):
    from tidemark.operators.quantiles import exact_percentiles

    d = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "k string, v double")
    got = {r.k: r.p50 for r in exact_percentiles(d, ["k"], "v", {"p50": 0.5}).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_keyless_percentiles_have_no_product(spark):
    from tidemark.operators.quantiles import exact_percentiles

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = exact_percentiles(spark.range(1000).selectExpr("double(id) AS v"), [], "v", {"p50": 0.5, "p95": 0.95})
        plan = d._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
        assert [tuple(r) for r in d.collect()] == [(499.5, 949.05)]
        assert exact_percentiles(spark.range(0).selectExpr("double(id) AS v"), [], "v", {"p50": 0.5}).collect()[0].p50 is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_whole_life_is_legal(spark):
    from tidemark.operators import ledger as L

    ops = ["INTAKE", "SAVE_WORKING", "ANNOTATE", "SUBMIT", "REJECT", "SUBMIT", "APPROVE_FIRST"]
    for stage in ("CLEAN", "FINAL", "LAST"):
        ops += [f"START_{stage}", "REPLACE_SOURCE", "SAVE_WORKING", "SUBMIT", f"APPROVE_{stage}"]
    ops += ["FINALIZE"]
    good = [("a", i, i, op) for i, op in enumerate(ops)]
    bad = [("b", 0, 0, "INTAKE"), ("b", 1, 1, "SAVE_WORKING"), ("b", 2, 2, "SUBMIT"), ("b", 3, 3, "APPROVE_CLEAN"), ("c", 0, 0, "SUBMIT"), (None, 0, 0, "INTAKE"), (None, 1, 1, "FINALIZE")]
    d = spark.createDataFrame(good + bad, "slug string, seq long, ts long, op string")
    assert {(r.slug, r.seq) for r in L.illegal_steps(d, "slug").collect()} == {("b", 3), ("c", 0), (None, 1)}
    for n, state in ((1, "FIRST_SCRATCH"), (7, "FIRST_DONE"), (8, "CLEAN_SCRATCH"), (12, "CLEAN_DONE"), (22, "END_REVIEW"), (len(ops), "PASSED")):
        assert L.replayed_state(d.filter(F.col("slug") == "a").filter(F.col("seq") < n), "slug").first().state == state


def test_repeated_commits_keep_their_count(spark):
    from tidemark.operators import runs as R

    commits = spark.createDataFrame([("abcdef1234", 1), ("abcdef1234", 2), ("ABCDEF99", 3), ("abc", 4)], "sha string, n int")
    seen = spark.createDataFrame([("abcdef1", 5, 10), ("abcdef12345678", 7, 11), ("abcdef9", 3, None)], "sha string, passed int, at int")
    got = {r.n: (r.passed, r.observation_count) for r in R.suite_trajectory(commits, seen).collect()}
    assert got == {1: (7, 2), 2: (7, 2), 3: (3, 1), 4: (None, 0)}


def test_boxes_keep_null_and_long_keys(spark):
    from tidemark.operators.boxes import merge_components

    big = 2**53 + 1
    rows = [(None, 0, 0, 2, 2), (None, 1, 1, 3, 3), (big, 0, 0, 1, 1), (big, 5, 5, 5, 9)]
    got = merge_components(spark.createDataFrame([(k, *map(float, b)) for k, *b in rows], "k long, x0 double, y0 double, x1 double, y1 double"), "k")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(None, 0.0, 0.0, 3.0, 3.0), (big, 0.0, 0.0, 1.0, 1.0)], key=repr)


def test_similarity_of_null_is_null(spark):
    from tidemark.functions.text import fuzzy_ratio

    d = spark.createDataFrame([("a", None), ("ab", "ab")], "x string, y string")
    assert [r.r for r in d.select(fuzzy_ratio(F.col("x"), F.col("y")).alias("r")).collect()] == [None, 1.0]


def test_commit_bypass_reads_commands(spark):
    from tidemark.functions import text as X
    from tidemark.operators import runs

    cases = {"git commit -m x": False, "git commit --no-verify -m x": True, "git push -n": False, "HUSKY=0 git commit": True, "git commit -m 'a -n b'": False, 'git commit -m "a -n" -n': True, "git commit -m 'open -n": True, "git -C x commit -n": False, "GIT COMMIT -N": True, "git": False, "": False, None: False, "SKIP=lint git push": True}
    d = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "seq long, command string")
    assert {r.command: r.b for r in d.select("command", X.commit_bypass(F.col("command")).alias("b")).collect()} == cases
    rows = [("a", 1, "git commit -n", None), ("a", 2, "git commit", "husky failed"), ("a", 3, "git commit -n", "ok"), ("b", 1, "git commit -n", "hook  rejected"), (None, 1, "x", "pre-commit"), ("c", 2, None, None)]
    e = spark.createDataFrame(rows, "k string, seq long, command string, output string")
    assert [(r.k, r.seq) for r in runs.hook_bypasses(e, "k").collect()] == [("a", 3)]


def test_short_titles_equal_their_sql_on_odd_lines(spark, tmp_path):
    import __spark_entry__ as entry
    from tests.compare import duck

    lines = ["Only words.***", "**bold**", "a  b\tc", "done (commit 1a2b3c) and more", "## heading *", "x" * 150, "y" * 139 + "  tail", "\n \n", "", None, "é\r"]
    rows = [(3 * k + m, v) for k, v in enumerate(lines) for m in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string").toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["p29_short_title"](spark, str(tmp_path)).collect()
    want = duck(str(tmp_path)).execute(entry.oracle_sql()["p29_short_title"]).fetchall()
    assert {r.doc_id: (r.title, r.clipped) for r in got} == {i: (title, clipped) for i, title, clipped in want}


def test_clip_tidies_headlines(spark):
    known = {"**Gate  opened** ": "Gate opened", "Gate opened (commit 1a2b3c) now": "Gate opened", "z" * 150: "z" * 140 + "...", "w" * 139 + " tail": "w" * 139 + "...", None: None}
    d = spark.createDataFrame([(k,) for k in known], "t string")
    assert {r.t: r.c for r in d.select("t", text.clip(F.col("t")).alias("c")).collect()} == known
