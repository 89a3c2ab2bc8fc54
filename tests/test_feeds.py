"""Files written, read back, repeated and streamed."""

import json

from pyspark.sql import functions as F

from tidemark.sources import golden, jsonl, ledgerdoc, logs, manifests, sinks
from tidemark.streaming import jobs as J


def test_transition_log_round_trip(spark, tmp_path):
    text = "# PIPELINE_LOG - append-only\n\n2026-07-03T21:14:09Z | ahri | APPROVE_CLEAN | 3.Scratch -> 4.Done | actor=operator | sha12=ab12cd34ef56 | ok | note=-\nbroken | line\n"
    (tmp_path / "l.md").write_text(text)
    rows = spark and logs.read_transition_log(spark, str(tmp_path)).collect()
    good = [r for r in rows if r._corrupt is None][0]
    assert (good.op, good.from_stage, good.to_stage, good.actor, good.note) == ("APPROVE_CLEAN", "3.Scratch", "4.Done", "operator", None)
    assert len(rows) == 2 and [r._corrupt for r in rows if r._corrupt] == ["broken | line"]


def test_torn_tail(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n{"x": \n{"x": 3}\n{"x"')
    (tmp_path / "b.jsonl").write_text('{"x": 1}\n\n{"x": 2}\n')
    rows, quality = jsonl.read_jsonl_tolerant(spark, str(tmp_path), "x int")
    assert sorted(r.x for r in rows.collect()) == [1, 1, 2, 3]
    got = {r.file[-7]: (r.parsed, r.corrupt_lines, r.torn_tail) for r in quality.collect()}
    assert got == {"a": (2, 1, True), "b": (2, 0, False)}


def test_manifest_order(spark, tmp_path):
    doc = {"schema": 1, "slug": "s", "transitions": [{"op": "REPLACE_SOURCE", "ts": "2026-08-01"}, {"op": "INTAKE", "ts": "2026-07-05", "params": {"a": "b"}}]}
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=1))
    rows = manifests.read_manifests(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.seq, r.op) for r in rows] == [(0, "REPLACE_SOURCE"), (1, "INTAKE")]


def test_snapshot_shapes(spark, tmp_path):
    (tmp_path / "k.json").write_text('{"images": {"a": {"state": "PASSED"}}}')
    (tmp_path / "l.json").write_text('{"images": [{"id": "b", "working_max": 2}]}')
    (tmp_path / "x.json").write_text('{"images": 3}')
    got = {r.id: (r.state, r.working_max) for r in manifests.read_state_snapshot(spark, str(tmp_path)).collect()}
    assert got == {"a": ("PASSED", None), "b": (None, 2)}


def test_golden_round_trip(spark, tmp_path):
    f = F.struct(F.lit("p").alias("path"), F.lit("h").alias("sha256"))
    m = F.struct(*[F.lit(1.0).alias(c) for c in ("msssim", "lpips", "lap_ratio", "halo_pct", "band_delta")])
    cases = spark.range(3).select(F.col("id").cast("string").alias("slug"), f.alias("input"), f.alias("baseline"), m.alias("metrics"), F.array(F.lit("x")).alias("defect_axes"), F.lit(True).alias("blessed"))
    golden.freeze_baseline(cases, str(tmp_path / "g"), "pv1", "2026-01-01")
    back = golden.read_baseline(spark, str(tmp_path / "g")).collect()
    assert sorted(r.slug for r in back) == ["0", "1", "2"] and {r.pipeline_version for r in back} == {"pv1"}
    assert back[0].metrics.lap_ratio == 1.0


def test_put_is_idempotent(spark, tmp_path):
    d = spark.createDataFrame([(1, "a", "h1"), (2, "a", "h2"), (3, "b", "h1"), (4, "a", "h1")], "seq long, name string, sha string")
    assert sinks.put_if_absent(d, str(tmp_path / "t")) == 3
    assert sinks.put_if_absent(d, str(tmp_path / "t")) == 0
    assert sorted(r.target for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["a", "a~2", "b"]


def test_snapshot_pointer(spark, tmp_path):
    p = str(tmp_path / "s")
    sinks.write_snapshot(spark.range(2), p, 1)
    sinks.write_snapshot(spark.range(5), p, 2)
    spark.range(9).write.parquet(f"{p}/v=3")  # written, not yet pointed to
    assert sinks.read_snapshot(spark, p).count() == 5


def test_queue_columns(spark, tmp_path):
    d = spark.createDataFrame([("t", "extra")], "target string, other string")
    sinks.append_queue(d, str(tmp_path / "q"))
    sinks.append_queue(d, str(tmp_path / "q"))
    back = spark.read.option("header", True).csv(str(tmp_path / "q"))
    assert back.columns == ["target", "reason", "suggested_tools"] and back.count() == 2


def test_ledger_and_blocks(spark):
    t = "intro\n12. x **2026-08-01 - First thing** body\n13. y **2026-08-02 - Second** more"
    items = ledgerdoc.ledger_items(spark.createDataFrame([(t,)], "t string"), "t", []).orderBy("number").collect()
    assert [(r.number, r.date, r.title) for r in items] == [(12, "2026-08-01", "First thing"), (13, "2026-08-02", "Second")]


def test_late_rows_by_batches(spark, tmp_path):
    base = tmp_path / "late"
    for n, rows in enumerate([["2026-01-01 10:00:00", "2026-01-01 12:00:00"], ["2026-01-01 09:00:00", "2026-01-01 11:30:00", "2026-01-01 13:00:00"]]):
        spark.createDataFrame([(r,) for r in rows], "ts string").select(F.to_timestamp("ts").alias("ts")).coalesce(1).write.mode("append").parquet(str(base / "in"))
        J.late_split(spark.readStream.schema("ts timestamp").parquet(str(base / "in")), str(base), "ts", 3600)
    assert spark.read.parquet(str(base / "late")).count() == 1 and spark.read.parquet(str(base / "main")).count() == 4


def test_stream_over_a_folder_loses_nothing(spark, tmp_path):
    """Three part files with rows out of order: every row is counted or in the dead-letter table."""
    table, gate = tmp_path / "events.parquet", str(tmp_path / "gate")
    (tmp_path / "events_old.parquet").mkdir()
    hour = 3600
    parts = [[(0, 10), (1, 12)], [(2, 20), (3, 9), (4, 19)], [(5, 30), (6, 5), (7, 30)]]
    for rows in parts:
        one = spark.createDataFrame([(i, "u", h * hour) for i, h in rows], "id long, user string, s long")
        one.select("id", "user", F.timestamp_seconds("s").alias("at")).coalesce(1).write.mode("append").parquet(str(table))
        taken = J.accept(J.table_stream(spark, str(tmp_path), "events"), gate, "at", 2 * hour)
        out = J.run_available(J.quiet_sessions(taken, "user", "at", "1 hour", delay="2 hours"), str(tmp_path / "job"))
    late = spark.read.parquet(f"{gate}/late")
    main = spark.read.parquet(f"{gate}/main")
    assert sorted(r.id for r in late.collect()) == [3, 6]
    assert main.count() + late.count() == 8
    assert out.agg(F.sum("n")).first()[0] == 4  # 10, 12, 19 and 20 h have ended; 30 h is still open


def test_liveness_ladder(spark):
    now = 100_000_000_000
    rows = [("stop", now, True, False, now), ("stop-finish", now, True, True, now), ("finish only", now, False, True, now), ("fresh", now, False, False, now), ("no lock", now, False, False, None), ("old lock", now, False, False, 1), ("quiet", 1, False, False, now)]
    d = spark.createDataFrame(rows, "id string, last_us long, stopped boolean, finished boolean, lock_us long")
    got = {r.id: r.state for r in J.liveness(d, F.lit(now), lock_us=F.col("lock_us")).collect()}
    assert got == {"stop": "STOPPED", "stop-finish": "FINISHED", "finish only": "LIVE", "fresh": "LIVE", "no lock": "DEAD", "old lock": "DEAD", "quiet": "DEAD"}


def test_fields_of_another_type_are_null(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": "abc", "y": [1]}\n{"x": 3.7}\n{"x": 4, "y": "no"}\nnull\n{"x"')
    rows, quality = jsonl.read_jsonl_tolerant(spark, str(tmp_path), "x int, y array<int>")
    assert sorted((r.x is None, r.y) for r in rows.filter("y is not null").collect()) == [(True, [1])]
    assert [(r.parsed, r.corrupt_lines, r.torn_tail) for r in quality.collect()] == [(3, 1, True)]


def test_commit_log_from_files(spark, tmp_path):
    (tmp_path / "c.log").write_text("abc123\x1fFix it\x1f2026-01-02\nbroken line\n \x1fno sha\x1f2026-01-02\n")
    assert [tuple(r) for r in logs.read_commit_log(spark, str(tmp_path)).select("sha", "subject", "date").collect()] == [("abc123", "Fix it", "2026-01-02")]


def test_lock_events_and_samples_from_files(spark, tmp_path):
    (tmp_path / "l.log").write_text("2026-01-01T00:00:10 winmutex: ACQUIRED by x\nnoise\n2026-01-01T00:00:12 winmutex: RELEASED\n2026-01-01T00:00:13 slots: 2 busy - waiting\n")
    assert [r.marker for r in logs.read_lock_events(spark, str(tmp_path / "l.log")).collect()] == ["ACQUIRED", "RELEASED", "busy"]
    (tmp_path / "s.jsonl").write_text('{"t": 1, "n": 2, "owners": [{"repo": "a"}, {"repo": "b"}]}\nnot json\n{"t": 2, "n": 1, "owners": [{"repo": "a"}]}\n')
    got = logs.shared_samples(logs.read_slot_samples(spark, str(tmp_path / "s.jsonl"))).first()
    assert (got.samples, got.peak, got.shared) == (2, 2, 1)


def test_ledger_from_a_file(spark, tmp_path):
    (tmp_path / "ledger.md").write_text("# Title\n\n1. [x] **2026-01-02 - First**\nbody\n2. [-] **2026-02-03 - Second** more\n3. no date\n")
    got = [(r.number, r.date, r.title) for r in ledgerdoc.read_ledger(spark, str(tmp_path)).orderBy("number").collect()]
    assert got == [(1, "2026-01-02", "First"), (2, "2026-02-03", "Second")]


def test_only_changed_assets_take_a_new_hash(spark, tmp_path):
    import hashlib

    for name in "abc":
        (tmp_path / f"{name}.png").write_text(name)
    listing, hashed = manifests.list_assets(spark, str(tmp_path)), manifests.hash_assets(spark, str(tmp_path))
    none = spark.createDataFrame([], "path string, mtime long, size long, sha string")
    first = manifests.scan_assets(listing, none, hashed)
    assert {r.path[-5:]: (r.sha, r.cached) for r in first.collect()} == {f"{n}.png": (hashlib.sha256(n.encode()).hexdigest(), False) for n in "abc"}
    cache = spark.createDataFrame(first.select("path", "mtime", "size", "sha").collect(), none.schema)
    (tmp_path / "b.png").write_text("longer")
    again = {r.path[-5:]: r.cached for r in manifests.scan_assets(manifests.list_assets(spark, str(tmp_path)), cache, manifests.hash_assets(spark, str(tmp_path))).collect()}
    assert again == {"a.png": True, "b.png": False, "c.png": True}


def test_triage_round_trip_takes_the_last_row(spark, tmp_path):
    rows = spark.createDataFrame([("a", "i", [[0.0, 1.0]], 0.5, 1.0, "qa", 1), ("a", "i", [], 0.9, 2.0, "auto", 2), ("b", "j", None, None, None, "clean", 1)], manifests.TRIAGE)
    for half in (rows.filter("seq = 2"), rows.filter("seq = 1")):
        manifests.write_triage(half, str(tmp_path / "t"))
    assert {r.slug: r.verdict for r in manifests.read_triage(spark, str(tmp_path / "t")).collect()} == {"a": "auto", "b": "clean"}


def test_only_changed_files_are_opened(spark, tmp_path):
    import hashlib

    folder, seen = tmp_path / "in", tmp_path / "seen"
    folder.mkdir(), seen.mkdir()
    for name in ("a", "b", "c d%20", "e"):
        (folder / f"{name}.png").write_bytes(name.encode() * 700_000)

    def opener(path, log=str(seen)):
        import os
        import uuid

        with open(os.path.join(log, uuid.uuid4().hex), "w") as out:
            out.write(path)
        if path.endswith("e.png"):
            raise OSError("unreadable")
        return manifests.open_file(path)

    def scan(cache):
        rows = manifests.scan_changed(manifests.list_assets(spark, str(folder)), cache, lambda d: manifests.hash_files(d, opener)).collect()
        opened = sorted(p.read_text().rsplit("/", 1)[1] for p in seen.iterdir())
        for p in seen.iterdir():
            p.write_text("/")
        return rows, [o for o in opened if o]

    none = spark.createDataFrame([], "path string, mtime long, size long, sha string")
    rows, opened = scan(none)
    assert len(opened) == 4 and {r.sha for r in rows} == {hashlib.sha256(n.encode() * 700_000).hexdigest() for n in ("a", "b", "c d%20")}
    cache = spark.createDataFrame([(r.path, r.mtime, r.size, r.sha) for r in rows], none.schema)
    (folder / "b.png").write_text("longer")
    rows, opened = scan(cache)
    assert opened == ["b.png", "e.png"]
    assert sorted((r.path.rsplit("/", 1)[1][:1], r.cached) for r in rows) == [("a", True), ("b", False), ("c", True)]
