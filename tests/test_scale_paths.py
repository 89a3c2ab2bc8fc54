"""The skew-proof rewrites against plain windows and brute force, with blocks small enough to matter."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import boxes as B
from tidemark.operators import ledger as L
from tidemark.operators import matching as M
from tidemark.operators import rasters as R
from tidemark.operators import runs
from tidemark.operators.ordered import before, latest, numbered, previous
from tidemark.operators.quantiles import exact_percentiles, percentiles


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most rows; values have gaps."""
    rng = random.Random(7)
    rows = [(("a" if rng.random() < 0.8 else f"k{i % 5}"), i * 3, None if rng.random() < 0.3 else rng.randint(0, 9)) for i in range(600)]
    return spark.createDataFrame(rows, "k string, seq long, v int")


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select("k", "seq", *cols).collect())


def test_before_equals_window(hot):
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    want = hot.withColumns({"l": F.last("v", True).over(w), "s": F.coalesce(F.sum("v").over(w), F.lit(0)), "m": F.max("v").over(w)})
    got = before(hot, ["k"], "seq", last={"l": F.col("v")}, sums={"s": F.col("v")}, maxs={"m": F.col("v")}, block=50)
    assert rows_of(got, "l", "s", "m") == rows_of(want, "l", "s", "m")


def test_previous_and_numbered(hot):
    w = Window.partitionBy("k").orderBy("seq")
    assert rows_of(previous(hot, ["k"], "seq", {"p": F.col("v")}, block=30), "p") == rows_of(hot.withColumn("p", F.lag("v").over(w)), "p")
    assert rows_of(numbered(hot, ["k"], "seq", "n", block=30), "n") == rows_of(hot.withColumn("n", F.row_number().over(w)), "n")


def test_latest_ties_go_to_the_later_row(spark):
    d = spark.createDataFrame([("a", "2026-08-01", 1, "new"), ("a", "2026-07-05", 2, "old"), ("b", "x", 1, "p"), ("b", "x", 2, "q")], "k string, ts string, seq long, v string")
    assert {r.k: r.v for r in latest(d, ["k"], ["ts", "seq"]).collect()} == {"a": "new", "b": "q"}


def test_runs_and_gaps_over_blocks(spark):
    d = spark.createDataFrame([(i, v) for i, v in enumerate([1400, None, 1500, 1490, None, None, 1600])], "i long, v int")
    got = [(r.delta, r.broken_by_gap, r.regression) for r in L.delta_with_gaps(d, "i", "v", block=2).orderBy("i").collect()]
    assert got == [(None, False, False), (None, False, False), (None, True, False), (-10, False, True), (None, False, False), (None, False, False), (None, True, False)]


def test_segment_runs_over_blocks(spark):
    d = spark.createDataFrame([("f", i, c, None) for i, c in enumerate([1, 2, None, 3, 1, 1, 2])], "f string, i long, c int, r string")
    got = [r.run_index for r in L.segment_runs(d, ["f"], "i", "c", "r", block=2).orderBy("i").collect()]
    assert got == [1, 1, 1, 1, 2, 3, 3]


@pytest.mark.parametrize("digit", [11, 22])
def test_exact_percentiles(spark, digit):
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(size=4000), np.full(3000, 0.25)])
    pdf = pd.DataFrame({"g": ["hot"] * len(a) + ["tiny"] * 3, "v": [*a, 1.0, 2.0, 9.0]})
    ps = {"p0": 0.0, "p05": 0.05, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p100": 1.0}
    got = {r.g: r for r in exact_percentiles(spark.createDataFrame(pdf), ["g"], "v", ps, digit).collect()}
    for g, vals in (("hot", a), ("tiny", np.array([1.0, 2.0, 9.0]))):
        for n, p in ps.items():
            assert got[g][n] == pytest.approx(np.percentile(vals, p * 100), abs=1e-12), (g, n)


def test_consensus_match_against_brute_force(spark):
    rng = random.Random(11)
    corpus = [(i, rng.getrandbits(64), rng.getrandbits(64)) for i in range(60)]
    corpus += [(100 + i, corpus[0][1], corpus[0][2]) for i in range(40)]  # many copies of one asset

    def flip(h, n):
        for b in rng.sample(range(64), n):
            h ^= 1 << b
        return h

    targets = [(i, flip(corpus[i][1], i % 18), flip(corpus[i][2], (i * 5) % 18)) for i in range(60)]
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    c = spark.createDataFrame([(str(i), signed(p), signed(d), i) for i, p, d in corpus], "path string, phash long, dhash long, ord long")
    t = spark.createDataFrame([(i, signed(p), signed(d)) for i, p, d in targets], "target long, phash long, dhash long")
    got = {r.target: (r.decision, r.source, r.p, r.d) for r in M.consensus_match(t, c).collect()}
    for i, p, d in targets:
        worst, _, ph, dh, src = min((max((p ^ cp).bit_count(), (d ^ cd).bit_count()), j, (p ^ cp).bit_count(), (d ^ cd).bit_count(), j) for j, cp, cd in corpus)
        decision = "match" if worst <= 8 else "review" if worst <= 14 else "no_match"
        assert got[i] == (decision, None if decision == "no_match" else str(src), ph, dh), i
    assert {(r.decision, r.source, r.p, r.d) for r in M.consensus_match(t, c.limit(0)).collect()} == {("no_match", None, None, None)}


def test_clustered_hashes_make_few_candidates(spark):
    """All assets share their first hash up to a few bits; the second hash tells them apart."""
    rng = random.Random(4)
    common = rng.getrandbits(63)
    rows = [(common ^ (1 << rng.randrange(63)), rng.getrandbits(63), i, str(i)) for i in range(2000)]
    corpus = spark.createDataFrame(rows, "cp long, cd long, ord long, path string")
    targets = spark.createDataFrame([(p ^ 1, d ^ 6) for p, d, _, _ in rows[::20]], "tp long, td long")
    met = M.slice_index(targets, "tp", "td").join(M.slice_index(corpus, "cp", "cd"), "_key").count()
    assert met < 100 * 2000 / 50  # of all pairs
    near = {(r.tp, r.td): (r.path, r.worst) for r in M.nearest(targets, corpus, block=150).collect()}
    for p, d, i, path in rows[::20]:
        assert near[(p ^ 1, d ^ 6)] == (path, 2)


def test_blocks_compare_everything(spark):
    rng = random.Random(9)
    signed = lambda: rng.getrandbits(64) - (1 << 63)
    corpus = [(signed(), signed(), i, str(i)) for i in range(300)]
    targets = [(signed(), signed()) for _ in range(90)]
    c, t = spark.createDataFrame(corpus, "cp long, cd long, ord long, path string"), spark.createDataFrame(targets, "tp long, td long")
    bits = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    for block in (40, 4096):
        got = {(r.tp, r.td): (r.worst, r.ord, r.p, r.d) for r in M.compared_whole(t, c, block).collect()}
        for p, d in targets:
            assert got[(p, d)] == min((max(bits(p, cp), bits(d, cd)), i, bits(p, cp), bits(d, cd)) for cp, cd, i, _ in corpus)


def boxes(spark, n=120, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.randint(0, 300), rng.randint(0, 200)
        rows.append(("hot" if i % 3 else f"b{i % 4}", float(x), float(y), float(x + rng.randint(1, 60)), float(y + rng.randint(1, 90))))
    return rows, spark.createDataFrame(rows, "k string, x0 double, y0 double, x1 double, y1 double")


def test_union_area_counts_pixels(spark):
    rows, d = boxes(spark)
    got = {r.k: r.area for r in B.union_area(d, "k").collect()}
    for k in {r[0] for r in rows}:
        m = np.zeros((400, 400), bool)
        for r in rows:
            if r[0] == k:
                m[int(r[2]):int(r[4]), int(r[1]):int(r[3])] = True
        assert got[k] == m.sum()


def test_merge_components(spark):
    rows, d = boxes(spark, 40)
    got = {}
    for r in B.merge_components(d.repartition(4), "k").collect():
        got.setdefault(r.k, []).append((r.x0, r.y0, r.x1, r.y1))
    for k in {r[0] for r in rows}:
        todo = [r[1:] for r in rows if r[0] == k]
        changed = True
        while changed:
            changed = False
            for i in range(len(todo)):
                for j in range(i + 1, len(todo)):
                    a, b = todo[i], todo[j]
                    if a[0] < b[2] and b[0] < a[2] and a[1] < b[3] and b[1] < a[3]:
                        todo[i] = (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))
                        del todo[j]
                        changed = True
                        break
                if changed:
                    break
        assert sorted(got[k]) == sorted(todo)


def test_overlap_summary(spark):
    a = [(1, 1, 10), (2, 20, 30), (3, 0, 100)]
    b = [(1, 5, 12), (2, 10, 20), (3, 25, 26), (4, 30, 40)]
    mk = lambda rows: spark.createDataFrame(rows, "id long, s long, e long")
    got = {r.id: (r.n_overlaps, r.overlap_s) for r in runs.overlap_summary(mk(a), mk(b), block=8).collect()}
    for i, s, e in a:
        pieces = [min(e, y) - max(s, x) for _, x, y in b if min(e, y) > max(s, x)]
        assert got[i] == (len(pieces), sum(pieces))


def banding(src, out):
    def density(a):
        p = np.pad(a, 1, mode="edge")
        win = np.stack([p[dy:dy + 8, dx:dx + 8] for dy in range(3) for dx in range(3)])
        smooth = np.clip((win**2).mean(0) - win.mean(0) ** 2, 0, None) < 4.0
        if not smooth.any():
            return 0.0
        q = np.pad(smooth, 1, mode="edge")
        near = np.any([q[dy:dy + 8, dx:dx + 8] for dy in range(3) for dx in range(3)], axis=0)
        hit = np.zeros_like(smooth)
        for axis in (0, 1):
            d = np.abs(np.diff(a, axis=axis, append=np.take(a, [-1], axis=axis)))
            hit |= (d > 1e-9) & (np.roll(d, 1, axis) <= 1e-9) & (np.roll(d, -1, axis) <= 1e-9)
        return (hit & near).sum() / smooth.sum()

    return density(out) - density(src)


def test_banding_delta(spark):
    y, x = np.mgrid[0:8, 0:8].astype(float)
    ramp = 100 + x * 0.9 + y * 0.05
    steps = np.floor(ramp / 3) * 3
    frames = [(0, ramp, steps), (1, steps, ramp), (2, ramp, np.floor(x / 4) * 1.5 + 50)]
    d = spark.createDataFrame([(i, s.ravel().tolist(), o.ravel().tolist()) for i, s, o in frames], "id int, s array<double>, o array<double>")
    got = {r.id: r.v for r in d.select("id", R.banding_delta(F.col("s"), F.col("o"), 8, 8).alias("v")).collect()}
    for i, s, o in frames:
        assert got[i] == pytest.approx(banding(s, o), abs=1e-9), i
    assert any(abs(v) > 0 for v in got.values())


def test_similarity_identities(spark):
    from tidemark.operators import vectors as V

    d = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [1.0, 1.0]), (3, "b", [0.0, 0.0])], "id long, g string, e array<double>")
    got = {r.g: r.mean_cos for r in V.self_similarity(d, "g", "e").collect()}
    assert got["a"] == pytest.approx(0.5**0.5) and got["b"] is None
    arm = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, e array<double>")
    ref = spark.createDataFrame([([1.0, 0.0],), ([1.0, 0.0],)], "e array<double>")
    vals = [r.mean_cos for r in V.cross_cosines(arm, ref, "id", "e").collect()]
    assert sum(vals) / 2 == pytest.approx(0.5)


def test_run_after_claim_does_not_back_it(spark):
    e = spark.createDataFrame(
        [("t", 1, True, None, "", "12 passed"), ("t", 2, False, "python -m pytest -q", "12 passed in 1s", ""), ("t", 3, True, None, "", "all green"), ("t", 4, True, None, "", "3 failed, 9 passed")],
        "transcript string, seq long, is_claim boolean, command string, output string, text string",
    ).withColumns({"code": F.lit(None).cast("int"), "interrupted": F.lit(False), "user_text": F.lit(None).cast("string")})
    got = {r.seq: r.detector for r in runs.audit_claims(e).collect()}
    assert got == {1: "claim-no-run", 3: "ok"}


def test_nested_order_without_session_settings(spark):
    """The block hand-over must not depend on how Spark partitions unions."""
    d = spark.createDataFrame([("f", i, c, None) for i, c in enumerate([1, 2, None, 3, 1, 1, 2])], "f string, i long, c int, r string")
    spark.conf.set("spark.sql.unionOutputPartitioning", "true")
    try:
        got = [r.run_index for r in L.segment_runs(d, ["f"], "i", "c", "r", block=2).orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    assert got == [1, 1, 1, 1, 2, 3, 3]


def test_large_groups_merge_and_fill_alike():
    """Thousands of boxes of one asset, and groups that no straight cut can part."""
    rng = np.random.default_rng(3)
    low = rng.integers(0, 3000, (4000, 2))
    box = np.column_stack([low, low + rng.integers(1, 40, (4000, 2))]).astype(float)
    pinwheel = np.array([[0, 0, 6, 2], [5, 3, 7, 9], [1, 8, 4, 11], [-3, 1, -1, 10.0], [-9, 4, -4, 20]])
    group, merged = B.envelopes(np.concatenate([np.zeros(4000, int), np.ones(5, int)]), np.concatenate([box, pinwheel]))
    for g, want in ((0, box), (1, pinwheel)):
        done = [list(b) for b in want]
        again = True
        while again:
            again = False
            out = []
            for b in done:
                hit = [m for m in out if b[0] < m[2] and m[0] < b[2] and b[1] < m[3] and m[1] < b[3]]
                again |= bool(hit)
                out = [m for m in out if m not in hit] + [[min(b[0], *[m[0] for m in hit]), min(b[1], *[m[1] for m in hit]), max(b[2], *[m[2] for m in hit]), max(b[3], *[m[3] for m in hit])] if hit else b]
            done = out
        assert sorted(map(tuple, merged[group == g].tolist())) == sorted(map(tuple, done))
    x0, y0, x1, y1 = (np.minimum(c, 256).astype(np.int64) for c in box[:300].T)
    d = np.repeat([1, -1, -1, 1], 300)
    area = B.covered_cells(np.zeros(1200, int), np.concatenate([x0, x1, x0, x1]), np.concatenate([y0, y0, y1, y1]), d)
    pixels = np.zeros((256, 256), bool)
    for a, b, c, e in zip(x0, y0, x1, y1):
        pixels[b:e, a:c] = True
    assert area.tolist() == [pixels.sum()]


def test_owners_are_counted_once(spark):
    rows = [("a", 0, 10), ("a", 5, 15), ("b", 12, 20), (None, 13, 14), ("", 13, 14), ("c", 20, 21), ("a", 30, 31)]
    d = spark.createDataFrame(rows, "who string, s long, e long")
    got = {r.t: (r.n, r.owners) for r in runs.occupancy(d, "who", block=4).collect()}
    for t in {x for _, s, e in rows for x in (s, e)}:
        held = [who for who, s, e in rows if s <= t < e]
        assert got[t] == (len(held), len({w for w in held if w})), t
    assert tuple(runs.peak_concurrency(d, "who").first()) == (4, 11, 3, 2)


def test_percentiles_of_columns_keys_and_total(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": rng.choice(["a", "a", "a", "b", None], 3000), "u": 1.7e9 + rng.random(3000), "w": rng.choice([-0.0, 0.0, -1e-300, -5.5, 3.0, 1e300], 3000)})
    pdf.loc[::7, "w"] = np.nan
    d = spark.createDataFrame(pdf).withColumn("w", F.nanvl("w", F.lit(None).cast("double")))
    wanted = {"u": {"u50": 0.5, "u05": 0.05}, "w": {"w50": 0.5, "w95": 0.95}}
    got = {(r._all, r.k): r for r in percentiles(d, ["k"], wanted, total=True).collect()}
    assert set(got) == {(True, None), (False, None), (False, "a"), (False, "b")}
    for (every, k), r in got.items():
        some = pdf if every else pdf[pdf["k"].isna()] if k is None else pdf[pdf["k"] == k]
        for c, n, p in (("u", "u50", 50), ("u", "u05", 5), ("w", "w50", 50), ("w", "w95", 95)):
            assert r[n] == pytest.approx(np.percentile(some[c].dropna(), p), rel=1e-15), (every, k, n)
    plan = percentiles(d, ["k"], wanted)._jdf.queryExecution().toString()
    assert "percentile_approx" not in plan


def test_raster_windows_against_loops(spark):
    """Frames that aren't square, rows without a whole frame, and windows that reach beyond the edge."""
    rng = np.random.default_rng(12)
    w, h = 7, 5
    frames = [rng.normal(100, 40, (h, w)) for _ in range(4)] + [np.full((h, w), 3.0)]
    sharp = [f + rng.normal(0, 30, (h, w)) for f in frames]
    rows = [(i, f.ravel().tolist(), s.ravel().tolist()) for i, (f, s) in enumerate(zip(frames, sharp))] + [(9, None, [1.0] * (w * h)), (10, [1.0], [1.0] * (w * h))]
    d = spark.createDataFrame(rows, "id long, s array<double>, o array<double>")
    s, o = F.col("s"), F.col("o")
    got = {r.id: r for r in d.select("id", R.laplacian_var(s, w, h).alias("lap"), R.halo_pct(s, o, w, h, pct=0.8, r=1).alias("halo"), R.highpass(s, w, h, 5).alias("hp")).collect()}
    at = lambda f, y, x: f[min(max(y, 0), h - 1), min(max(x, 0), w - 1)]
    square = lambda y, x, r: [(y + dy, x + dx) for dy in range(-r, r + 1) for dx in range(-r, r + 1)]
    for i, (f, out) in enumerate(zip(frames, sharp)):
        lap = [at(f, y - 1, x) + at(f, y + 1, x) + at(f, y, x - 1) + at(f, y, x + 1) - 4 * f[y, x] for y in range(h) for x in range(w)]
        assert got[i].lap == pytest.approx(np.var(lap), abs=1e-9)
        hp = [f[y, x] - np.mean([at(f, *c) for c in square(y, x, 2)]) for y in range(h) for x in range(w)]
        assert np.allclose(got[i].hp, hp)
        conv = lambda y, x, k: sum(c * at(f, y + dy, x + dx) for (dy, dx), c in k.items())
        grad = np.array([[np.hypot(conv(y, x, R.SOBEL_X), conv(y, x, R.SOBEL_Y)) for x in range(w)] for y in range(h)])
        strong = grad >= max(np.percentile(grad, 80), 1e-6)
        near = [(y, x) for y in range(h) for x in range(w) if any(at(strong, *c) for c in square(y, x, 1))]
        rings = [out[y, x] > max(at(f, *c) for c in square(y, x, 1)) + 8 or out[y, x] < min(at(f, *c) for c in square(y, x, 1)) - 8 for y, x in near]
        assert got[i].halo == pytest.approx(sum(rings) / len(rings) if rings else 0.0, abs=6e-5)
    assert {got[i].lap for i in (9, 10)} == {got[i].halo for i in (9, 10)} == {None} and got[9].hp is None
    template = spark.createDataFrame([(i, float(v), bool(v > 100)) for i, v in enumerate(frames[0].ravel())], "i int, med double, support boolean")
    centred = spark.createDataFrame([(0, ((np.roll(frames[0], (1, -1), axis=(0, 1)) - 100) / 20).ravel().tolist()), (1, [0.0] * (w * h)), (2, None)], "id long, p array<double>")
    score = {r.id: (r.score, r.dy, r.dx) for r in R.template_scores(centred, "id", "p", template, w, h, shift=1).collect()}
    assert score[0][1:] == (1, -1) and score[0][0] > 0.9 and score[1] == (0.0, 0, 0) and score[2][0] is None


def test_matching_gathers_no_side_in_the_driver(spark, monkeypatch):
    """Tables this small would be broadcast by estimate; probes outgrow any estimate, so no join may."""
    plans, cut = [], M.cut_lineage
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(M, "cut_lineage", lambda df: plans.append(plan(df)) or cut(df))
    rows = [(i, i * 7919, i * 104729) for i in range(50)]
    assets = spark.createDataFrame(rows, "path long, phash long, dhash long").withColumn("ord", F.col("path"))
    targets = assets.select(F.col("path").alias("target"), F.col("phash").bitwiseXOR(1).alias("phash"), "dhash")
    found = M.consensus_match(targets, assets)
    assert {(r.target, r.decision, r.source, r.p, r.d) for r in found.collect()} == {(i, "match", i, 1, 0) for i, _, _ in rows}
    plans.append(plan(found))
    plans.append(plan(M.overlap_report(found, assets.select("path"))))
    assert sum("SortMergeJoin" in p for p in plans) >= 5
    assert not [p for p in plans if "BroadcastHashJoin" in p]


def test_percentiles_gather_no_values_in_the_driver(spark):
    """Values unfolded from arrays are many more than Spark estimates; what is looked up may be broadcast, they and their counts not."""
    frames = spark.range(200).select(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.sin(k * 1.0 + F.col("id"))).alias("p"))
    cells = frames.select(F.posexplode("p").alias("i", "v"))
    got = exact_percentiles(cells, ["i"], "v", {"med": 0.5})
    for r in got.collect():
        assert r.med == pytest.approx(np.median(np.sin(r.i + np.arange(200.0))), abs=1e-12)
    plan = got._jdf.queryExecution().executedPlan().toString()
    joins = [line.split("BroadcastHashJoin", 1)[1] for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert [j for j in joins if "LeftSemi, BuildRight" not in j] == []
    assert "LeftSemi" in plan


def test_shared_files_give_a_task_a_fixed_share(spark, monkeypatch):
    """No side goes through the driver, and tasks grow in number with the table."""
    import __spark_entry__ as entry
    from tests.compare import canon, duck
    from tidemark.plans import joins

    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(joins, "TASK_ROWS", 500, raising=False)
    got = entry.queries()["j16_shared_files"](spark, folder)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    n = spark.read.parquet(f"{folder}/lineitem.parquet").count() // 500 + 1
    assert plan.count(f", {n}), REPARTITION_BY_NUM") == 3
    assert canon(got.toPandas()) == canon(duck(folder).execute(entry.oracle_sql()["j16_shared_files"]).fetchdf())
