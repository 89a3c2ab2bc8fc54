"""Streaming queries: the events table read as a growing log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import views
from tidemark.plans.registry import query
from tidemark.streaming import jobs as J
from tidemark.streaming import keyed as K
from tidemark.streaming import mirror as M


def events(t):
    s = J.table_stream(t.spark, t.folder, "events")
    return s.withColumn("at", F.col("ts").cast("timestamp"))


@query("st01_stream_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def st01(t):
    out = J.run_available(J.stream_counts(events(t), "event_type"), J.job_dir(t.spark, "st01"), "update")
    return J.current(out, ["event_type"])


@query(
    "st02_tumbling_counts",
    "SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS start_s, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def st02(t):
    path = J.job_dir(t.spark, "st02")
    taken = J.accept(events(t), f"{path}/gate", "at", 3600)
    out = J.run_available(J.window_counts(taken, "at", "event_type", "1 day", delay="1 hour"), path, "update")
    return J.current(out, ["start_s", "event_type"])


@query(
    "st02_sliding_counts",
    """SELECT CAST(epoch(time_bucket(INTERVAL 6 HOUR, ts)) AS BIGINT) - 21600 * k AS start_s, event_type, count(*) AS n FROM events, (SELECT unnest(range(4)) AS k) r GROUP BY ALL""",
)
def st02_sliding(t):
    path = J.job_dir(t.spark, "st02s")
    taken = J.accept(events(t), f"{path}/gate", "at", 3600)
    out = J.run_available(J.window_counts(taken, "at", "event_type", "1 day", "6 hours", delay="1 hour"), path, "update")
    return J.current(out, ["start_s", "event_type"])


SESSION_SQL = """g AS (SELECT user_id, event_type, ts, epoch_us(ts) AS us, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < {gap} THEN 0 ELSE 1 END AS fresh FROM events),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS isl FROM g),
    s AS (SELECT user_id, min(us) AS start_us, max(us) + {gap} AS end_us, count(*) AS n, arg_max(event_type, ts) AS last_op FROM i GROUP BY user_id, isl),
    w AS (SELECT (max(epoch_us(ts)) // 1000) * 1000 AS mark FROM events)"""


@query(
    "st03_quiet_sessions",
    f"""WITH {SESSION_SQL.format(gap=21600000000)} SELECT user_id, start_us, end_us, n FROM s, w WHERE end_us <= mark""",
)
def st03(t):
    path = J.job_dir(t.spark, "st03")
    taken = J.accept(events(t), f"{path}/gate", "at", 0)
    return J.run_available(J.quiet_sessions(taken, "user_id", "at", "6 hours", delay="0 seconds"), path).drop("batch")


@query(
    "st04_stuck_timer",
    """WITH g AS (SELECT user_id, event_type, epoch_us(ts) AS us, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS after, max(epoch_us(ts)) OVER () AS top FROM events)
    SELECT user_id, us AS since_us FROM g WHERE event_type = 'view' AND coalesce(after, top + 900000000) - us > 900000000""",
)
def st04(t):
    """Stalls of the log, and those open at its end: the clock stops one limit after the last event."""
    path = J.job_dir(t.spark, "st04")
    taken = J.accept(events(t), f"{path}/gate", "at", 0)
    raised = K.stalls(taken, "user_id", "at", F.col("event_type"), "view", path, J.STUCK_S)
    top = t("events").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0] or 0
    still = K.open_stalls(t.spark, path, "user_id", "view", F.lit(top + J.STUCK_S * 1_000_000), J.STUCK_S)
    return raised.select("user_id", "since_us").unionByName(still)


@query(
    "st05_run_liveness",
    """WITH s AS (SELECT user_id, max(epoch_us(ts)) AS last_us, max(epoch_us(ts)) FILTER (event_type = 'view') AS lock_us, bool_or(event_type = 'error' AND value > 100) AS st, bool_or(event_type = 'purchase' AND value > 200) AS fi FROM events GROUP BY user_id),
    n AS (SELECT max(epoch_us(ts)) AS now FROM events)
    SELECT user_id, CASE WHEN st AND fi THEN 'FINISHED' WHEN st THEN 'STOPPED' WHEN now - last_us < 16200000000 AND coalesce(now - lock_us < 16200000000, false) THEN 'LIVE' ELSE 'DEAD' END AS state FROM s, n""",
)
def st05(t):
    """Views are a run's lock being touched; every event is a write."""
    path = J.job_dir(t.spark, "st05")
    taken = J.accept(events(t), f"{path}/gate", "at", 0)
    stop = (F.col("event_type") == "error") & (F.col("value") > 100)
    done = (F.col("event_type") == "purchase") & (F.col("value") > 200)
    kinds = F.array_compact(F.array(F.lit("write"), F.when(stop, "stop"), F.when(done, "finish")))
    locks = taken.filter("event_type = 'view'").select("user_id", "at", F.lit(True).alias("alive"))
    K.run_liveness(locks, taken.select("user_id", "at", F.explode(kinds).alias("kind")), "user_id", path)
    top = t("events").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0] or 0
    return K.liveness_now(t.spark, path, "user_id", F.lit(top))


@query("st06_dedup_stream", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def st06(t):
    e = events(t).select("event_id", "user_id", "at")
    path = J.job_dir(t.spark, "st06")
    twice = J.accept(e.union(e), f"{path}/gate", "at", 3600)
    once = J.run_available(J.dedup_stream(twice, ["event_id"], "at", "1 hour"), path)
    return once.groupBy("user_id").agg(F.count("*").alias("n"))


def landing(t, name, parts):
    """A folder that grows: the events table arrives in several appends."""
    path = J.job_dir(t.spark, name)
    for rows in parts:
        rows.write.mode("append").parquet(f"{path}/in")
        yield path, t.spark.readStream.schema(rows.schema).parquet(f"{path}/in")


@query(
    "st07_late_rows",
    """WITH c AS (SELECT *, CASE WHEN event_id % 20 = 0 THEN 1 WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END AS part FROM events), h AS (SELECT max(ts) AS hi FROM c WHERE part = 0)
    SELECT part = 1 AND ts < hi - INTERVAL 1 HOUR AS late, count(*) AS n FROM c, h GROUP BY 1""",
)
def st07(t):
    e = t("events").select("event_id", "ts")
    second = (F.col("event_id") % 20 == 0) | (F.col("ts") >= F.expr("timestamp_ntz'2024-01-15 00:00:00'"))
    for path, stream in landing(t, "st07", [e.filter(~second), e.filter(second)]):
        J.late_split(stream, path, "ts", 3600)
    main, late = (t.spark.read.schema(e.schema).parquet(f"{path}/{x}") for x in ("main", "late"))
    both = main.select(F.lit(False).alias("late")).unionByName(late.select(F.lit(True).alias("late")))
    return both.groupBy("late").agg(F.count("*").alias("n"))


@query(
    "st08_spend_ceiling",
    """WITH c AS (SELECT event_id, value, event_id % 2 AS part, sum(value) OVER (ORDER BY event_id % 2, event_id) AS run FROM events), t AS (SELECT sum(value) AS total FROM events)
    SELECT round(max(total), 2) AS total, min(event_id) FILTER (part = 1 AND run >= 0.75 * total) AS stop_at FROM c, t""",
)
def st08(t):
    e = t("events").select("event_id", "value")
    limit = 0.75 * e.agg(F.sum("value")).first()[0]
    odd = F.col("event_id") % 2 == 1
    for path, stream in landing(t, "st08", [e.filter(~odd), e.filter(odd)]):
        ledger = J.spend_ceiling(stream, path, F.col("value"), "event_id", limit)
    return ledger.agg(F.round(F.max("total"), 2).alias("total"), F.min("stop_at").alias("stop_at"))


@query(
    "st09_monotone_mirror",
    """SELECT user_id, arg_max(event_type, (event_id % 2) * 1000000000 + event_id) AS kind, greatest(count(*) FILTER (event_id % 2 = 0), count(*) FILTER (event_id % 2 = 1)) AS events, min(epoch_us(ts)) AS start, max(epoch_us(ts)) AS last_event FROM events GROUP BY user_id""",
)
def st09(t):
    e = t("events").select("event_id", "user_id", "event_type", "ts")

    def summarise(batch):
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        return batch.groupBy("user_id").agg(
            F.max_by("event_type", "event_id").alias("kind"), F.count("*").alias("events"), F.count("*").alias("output_tokens"),
            F.max(us).alias("last_event"), F.min(us).alias("start"), F.min("event_id").alias("first_seen"),
        )

    schema = "user_id long, kind string, events long, output_tokens long, last_event long, start long, first_seen long"
    merge = lambda rows, order: M.fold_monotone(rows, "user_id", ["kind"], order)
    odd = F.col("event_id") % 2 == 1
    for path, stream in landing(t, "st09", [e.filter(~odd), e.filter(odd)]):
        out = M.mirror_stream(stream, path, summarise, M.KeyedTable(t.spark, f"{path}/mirror", schema, "user_id", merge))
    return out.select("user_id", "kind", "events", "start", "last_event")


@query(
    "st10_stream_pairing",
    """SELECT o.event_id AS open_id, c.event_id AS close_id FROM events o JOIN events c ON o.user_id = c.user_id AND c.ts > o.ts AND c.ts <= o.ts + INTERVAL 1 HOUR WHERE o.event_type = 'signup' AND c.event_type = 'error'""",
)
def st10(t):
    o = events(t).filter("event_type = 'signup'").select("user_id", F.col("at").alias("open_at"), F.col("event_id").alias("open_id"))
    c = events(t).filter("event_type = 'error'").select("user_id", F.col("at").alias("close_at"), F.col("event_id").alias("close_id"))
    out = J.run_available(J.pair_stream(o, c, "user_id", "1 HOUR"), J.job_dir(t.spark, "st10"))
    return out.select("open_id", "close_id")


@query(
    "st10_next_marker",
    """WITH m AS (SELECT slug, seq, op, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "at" FROM v_transitions WHERE op IN ('INTAKE', 'REJECT')),
    l AS (SELECT *, lag(op) OVER w AS po, lag("at") OVER w AS pa FROM m WINDOW w AS (PARTITION BY slug ORDER BY seq))
    SELECT slug, pa AS s, "at" AS e FROM l WHERE op = 'REJECT' AND po = 'INTAKE'""",
)
def st10_next(t):
    """The log arrives in three appends; each close meets the marker right before it, also across appends."""
    rows = views.v_transitions(t).select("slug", "seq", "op", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("at"))
    top = rows.agg(F.max("seq")).first()[0] or 0
    third = F.floor(F.col("seq") * 3 / (top + 1))
    for path, stream in landing(t, "st10n", [rows.filter(third == k) for k in range(3)]):
        out = K.pair_markers(stream, path, "slug", "seq", F.col("op") == "INTAKE", F.col("op") == "REJECT", "at")
    return out
