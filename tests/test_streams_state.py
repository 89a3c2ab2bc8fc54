"""Keyed state over growing folders, against the same rules over all rows at once."""

import random

from pyspark.sql import functions as F

from tidemark.streaming import jobs as J
from tidemark.streaming import keyed as K
from tidemark.streaming import mirror as M

SEC = 1_000_000


def appended(spark, folder, batches, schema):
    """The folder grows batch by batch; yields it as a stream after each append."""
    for rows in batches:
        d = spark.createDataFrame(rows, schema)
        if "us" in d.columns:
            d = d.withColumn("at", F.timestamp_micros("us"))
        d.repartition(3).write.mode("append").parquet(f"{folder}/in")
        yield spark.readStream.schema(d.schema).parquet(f"{folder}/in")


def plain_stalls(events, limit, end):
    """Raised where the last op was work and nothing followed for more than the limit, the log's end included."""
    out = []
    for key in {e[0] for e in events}:
        mine = sorted((us, op) for k, us, op in events if k == key)
        for (us, op), (after, _) in zip(mine, [*mine[1:], (end, "")]):
            if op == "work" and after - us > limit:
                out.append((key, us))
    return sorted(out)


def test_stalls_of_three_appends(spark, tmp_path):
    rng = random.Random(1)
    limit, delay, path = 100, 30, str(tmp_path)
    times = sorted(rng.randint(0, 4000) * SEC + rng.choice([0, 0, 7]) for _ in range(240))
    events = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 5)}", us, rng.choice(["work", "rest", "done"])) for us in times]
    events += [("edge", 1000 * SEC, "work"), ("edge", 1100 * SEC, "rest"), ("edge2", 1000 * SEC, "work"), ("edge2", 1100 * SEC + 1, "rest")]
    events.sort(key=lambda e: e[1])
    batches = [events[:90], events[90:180], events[180:]]
    batches[1].append(batches[0].pop())  # a row that is in time, if the delay allows it
    batches[2] += [("late", 5 * SEC, "work"), ("hot", 6 * SEC, "work")]
    for stream in appended(spark, path, batches, "k string, us long, op string"):
        taken = J.accept(stream, f"{path}/gate", "at", delay)
        raised = K.stalls(taken, "k", "at", F.col("op"), "work", path, limit, delay)
    late = [(r.k, r.us, r.op) for r in spark.read.parquet(f"{path}/gate/late").collect()]
    main = [(r.k, r.us, r.op) for r in spark.read.parquet(f"{path}/gate/main").collect()]
    assert len(late) + len(main) == sum(map(len, batches)) and ("late", 5 * SEC, "work") in late
    end = max(e[1] for e in main) + limit * SEC
    said = sorted((r.k, r.since_us) for r in raised.collect())
    still = sorted((r.k, r.since_us) for r in K.open_stalls(spark, path, "k", "work", F.lit(end), limit).collect())
    assert len(said) == len(set(said)) and not set(said) & set(still)
    assert sorted(said + still) == plain_stalls(main, limit * SEC, end)
    assert ("edge2", 1000 * SEC) in said and ("edge", 1000 * SEC) not in said + still


T, STALE = 1_000_000, 16200


def test_liveness_cases_over_a_growing_folder(spark, tmp_path):
    """Locks and writes arrive in two appends; the states at T are those of the rules."""
    locks = [("live", T - 30, True), ("recycled", T - 423000, True), ("inside", T - (STALE - 60), True), ("gone", T - 10, False), ("frozen", T - 60, True), ("stopped", T - 10, True), ("finished", T - 423000, True), ("taken over", T - 500, True), ("taken over", T - 20, False)]
    writes = [("live", T - 10, "write"), ("recycled", T - 423000, "write"), ("inside", T - 30, "write"), ("gone", T - 5, "write"), ("frozen", T - (STALE + 600), "write"), ("stopped", T - 5, "write"), ("stopped", T - 5, "stop"), ("finished", T - 423000, "write"), ("finished", T - 422999, "stop"), ("finished", T - 422999, "finish"), ("no work", T - 100, "stop"), ("no work", T - 100, "finish"), ("only writes", T - 5, "write"), ("finish mark", T - 9, "write"), ("finish mark", T - 9, "finish"), ("taken over", T - 20, "write")]
    rows = sorted([(r, s, "lock", "alive" if a else "dead") for r, s, a in locks] + [(r, s, k, None) for r, s, k in writes], key=lambda e: e[1])
    path = str(tmp_path)
    cut = [e for e in rows if e[1] < T - 1000], [e for e in rows if e[1] >= T - 1000]
    batches = [[(r, s * SEC, k, m) for r, s, k, m in part] for part in cut]
    for stream in appended(spark, path, batches, "run string, us long, kind string, mark string"):
        locked = stream.filter("kind = 'lock'").select("run", "at", (F.col("mark") == "alive").alias("alive"))
        changes = K.run_liveness(locked, stream.filter("kind <> 'lock'").select("run", "at", "kind"), "run", path)
    want = {"live": "LIVE", "recycled": "DEAD", "inside": "LIVE", "gone": "DEAD", "frozen": "DEAD", "stopped": "STOPPED", "finished": "FINISHED", "no work": "FINISHED", "only writes": "DEAD", "finish mark": "DEAD", "taken over": "DEAD"}
    assert {r.run: r.state for r in K.liveness_now(spark, path, "run", F.lit(T * SEC)).collect()} == want
    assert K.liveness_now(spark, path, "run", F.lit((T + STALE + 10) * SEC)).filter("state = 'LIVE'").count() == 0
    said = {}
    for r in changes.orderBy("at_us").collect():
        assert said.get(r.run) != r.state  # only changes are said
        said[r.run] = r.state
    assert said["finished"] == "FINISHED" and said["recycled"] == "DEAD"


def test_liveness_goes_stale_by_timer(spark, tmp_path):
    path = str(tmp_path)
    batches = [[("a", 0, "lock"), ("a", 1, "write"), ("b", 0, "lock")], [("b", 50, "write"), ("b", 51, "lock")], [("a", 300, "write"), ("c", 400, "write")]]
    batches = [[(r, (9000 + s) * SEC, k) for r, s, k in part] for part in batches]
    for stream in appended(spark, path, batches, "run string, us long, kind string"):
        locked = stream.filter("kind = 'lock'").select("run", "at", F.lit(True).alias("alive"))
        changes = K.run_liveness(locked, stream.filter("kind = 'write'").select("run", "at", "kind"), "run", path, 100, 100)
    got = sorted((r.run, r.at_us // SEC - 9000, r.state) for r in changes.collect())
    assert got == [("a", 0, "DEAD"), ("a", 1, "LIVE"), ("a", 100, "DEAD"), ("b", 0, "DEAD"), ("b", 50, "LIVE"), ("b", 150, "DEAD")]


def test_markers_pair_across_appends(spark, tmp_path):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 3)}", i, rng.choice("ooccx"), i * 10) for i in range(150)]
    late = [("hot", 3, "o", 1), ("new", 60, "c", 1)]
    path = str(tmp_path)
    for stream in appended(spark, path, [rows[:50], rows[50:51], rows[51:], [*late, ("hot", 900, "c", 9000)]], "k string, seq long, m string, t long"):
        out = K.pair_markers(stream, path, "k", "seq", F.col("m") == "o", F.col("m") == "c", "t", buckets=3)
    want, last = [], {}
    for k, _, m, t in [*rows, ("hot", 900, "c", 9000)]:
        if m in "oc":
            if m == "c" and last.get(k, ("", 0))[0] == "o":
                want.append((k, last[k][1], t))
            last[k] = (m, t)
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert spark.read.parquet(f"{path}/late").count() == 2


SUMMARY = "agent string, kind string, events long, output_tokens long, last_event long, start long, first_seen long"


def table(spark, path, **kw):
    return M.KeyedTable(spark, path, SUMMARY, "agent", lambda rows, order: M.fold_monotone(rows, "agent", ["kind"], order), buckets=4, **kw)


def test_mirror_costs_what_a_batch_brings(spark, tmp_path):
    """A large mirror, then small batches: what they write does not grow with it, and no key is lost."""
    path = str(tmp_path / "m")
    t = table(spark, path)
    first = spark.range(20_000).selectExpr("concat('a', id) AS agent", "'x' AS kind", "id AS events", "id AS output_tokens", "id AS last_event", "id AS start", "id AS first_seen")
    t.append(first, 0)
    whole = t.folder.bytes("base") + t.folder.bytes("delta")
    for n in range(1, 6):
        t.append(spark.createDataFrame([(f"a{n}", None, 5, 90_000, 7, -n, 99), (f"new{n}", "y", 1, 1, 1, 1, n)], SUMMARY), n)
        assert t.folder.bytes(f"delta/batch={n}") < whole / 20 and not t.folder.has(f"base/upto={n}")
    got = {r.agent: tuple(r)[1:] for r in t.read().collect()}
    assert len(got) == 20_005
    assert got["a3"] == ("x", 5, 90_000, 7, -3, 3) and got["new5"] == ("y", 1, 1, 1, 1, 5)


def test_mirror_compacts_and_survives_a_retry(spark, tmp_path):
    path = str(tmp_path / "m")
    t = table(spark, path, slack=0.5)
    row = lambda k, n: (f"a{k}", f"k{n}", n, n, n, 10 - n, n)
    for n in range(5):
        t.append(spark.createDataFrame([row(k, n) for k in range(n, n + 4)], SUMMARY), n)
    before = sorted(map(tuple, t.read(before=4).collect()))
    whole = sorted(map(tuple, t.read().collect()))
    assert len(whole) == 8 and {r[0]: r[1] for r in whole}["a3"] == "k3"
    t.append(spark.createDataFrame([row(k, 4) for k in range(4, 8)], SUMMARY), 4)  # the last batch once more
    assert sorted(map(tuple, t.read().collect())) == whole and sorted(map(tuple, t.read(before=4).collect())) == before
    for n in range(5, 9):
        t.append(spark.createDataFrame([row(k, n) for k in range(8)], SUMMARY), n)
    live = t.folder.buckets("delta", "batch")
    assert all(len(ns) < 6 for ns in live.values()), "old versions are removed"
    assert {r.agent: (r.kind, r.events, r.start, r.first_seen) for r in t.read().collect()}["a0"] == ("k8", 8, 2, 0)


def test_many_keys_share_a_row_of_state(spark, monkeypatch):
    """A call to the state serves a slot, not a key or an event; nothing is lost on the way there."""
    monkeypatch.setattr(K, "SLOTS", 4)
    rows = spark.range(0, 3000, 1, 1).select((F.col("id") % 1000).alias("run"), F.timestamp_seconds(F.col("id")).alias("at"))
    thin = K.thinned(rows, "run", "at", F.lit("write"), F.lit(None), 1)
    got = thin.collect()
    assert len(got) <= 4
    assert sorted((k, us) for r in got for k, us in zip(r["run"], r["us"])) == sorted((i % 1000, i * 1_000_000) for i in range(3000))
