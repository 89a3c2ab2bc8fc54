"""Structured Streaming jobs over growing logs.

Every job keeps its state in Spark (aggregations, watermarks, joins) and writes
through an idempotent sink, so a restarted batch replaces its own output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import before, latest
from tidemark.session import shared_dir

STUCK_S = 900
STALE_S = 16200


def table_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table's parquet files as an unbounded input, be the table one file or a folder of part files."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    # A stream's path must be a folder or a pattern; this pattern matches the one name, file or folder.
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]")


def job_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def run_available(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Process all input there is into ``path``; one folder per batch, rewritten on retry."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    job = (
        stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    job.awaitTermination()
    spark = stream.sparkSession
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{path}/out")


def current(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Newest state per key of an update-mode change log."""
    return latest(changes, keys, ["batch"]).drop("batch")


def stream_counts(stream: DataFrame, key: str) -> DataFrame:
    return stream.groupBy(key).agg(F.count("*").alias("n"))


def window_counts(stream: DataFrame, at: str, key: str, size: str, slide: str | None = None, *, delay: str) -> DataFrame:
    """Counts per window. Rows more than ``delay`` late are not counted: see ``accept``."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    g = stream.withWatermark(at, delay).groupBy(w.alias("w"), key).agg(F.count("*").alias("n"))
    return g.select(F.unix_seconds("w.start").alias("start_s"), key, "n")


def quiet_sessions(stream: DataFrame, key: str, at: str, gap: str, extra: dict[str, Column] | None = None, *, delay: str) -> DataFrame:
    """Bursts of a key that ended: nothing followed for ``gap`` of event time.

    Rows more than ``delay`` behind the newest of earlier batches are not counted; put
    the stream through ``accept`` first, which keeps them in a dead-letter table.
    """
    g = stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("w"), key).agg(
        F.count("*").alias("n"), *[e.alias(n) for n, e in (extra or {}).items()]
    )
    cols = [F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us")]
    return g.select(key, *cols, "n", *(extra or {}))


def liveness(state: DataFrame, now_us: Column, stale_s: int = STALE_S, lock_us: Column | None = None, lock_stale_s: int = STALE_S) -> DataFrame:
    """A stop outranks all and reads FINISHED on its marker; LIVE needs fresh writes and, where locks are known, a fresh lock.

    A finish mark without a stop decides nothing. ``lock_us`` is the lock's last touch, null without a lock.
    """
    fresh = (now_us - F.col("last_us")) < stale_s * 1_000_000
    if lock_us is not None:
        fresh = fresh & F.coalesce((now_us - lock_us) < lock_stale_s * 1_000_000, F.lit(False))
    status = F.when(F.col("stopped") & F.col("finished"), "FINISHED").when(F.col("stopped"), "STOPPED").when(fresh, "LIVE").otherwise("DEAD")
    return state.withColumn("state", status)


def dedup_stream(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def pair_stream(opened: DataFrame, closed: DataFrame, key: str, within: str, delay: str = "1 hour") -> DataFrame:
    """Each open event with the closes of its key inside the time bound.

    ``opened``: key, open_at, open_id. ``closed``: key, close_at, close_id.
    """
    o = opened.withWatermark("open_at", delay).withColumnRenamed(key, "_k")
    c = closed.withWatermark("close_at", delay)
    on = (F.col("_k") == F.col(key)) & (F.col("close_at") > F.col("open_at")) & (F.col("close_at") <= F.col("open_at") + F.expr(f"INTERVAL {within}"))
    return o.join(c, on).drop("_k")


def feed(stream: DataFrame, path: str, handle) -> None:
    """Run ``handle(batch, batch_id)`` over what has arrived; the checkpoint remembers what was done."""
    job = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    job.awaitTermination()


def late_split(stream: DataFrame, path: str, at: str, delay_s: int) -> None:
    """Rows older than the newest stamp of EARLIER batches minus the delay go to the dead-letter table, the rest to main."""
    spark = stream.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        marks = spark.read.schema("high_us long, batch long").parquet(f"{path}/marks") if batch_id else None
        # one number decides the cut, as a stream's own watermark would
        high = marks.filter(F.col("batch") < batch_id).agg(F.max("high_us")).first()[0] if marks is not None else None
        us = F.unix_micros(F.col(at).cast("timestamp"))
        late = us < F.lit(high) - delay_s * 1_000_000 if high is not None else F.lit(False)
        tagged = batch.withColumn("_late", late)
        tagged.filter("not _late").drop("_late").write.mode("overwrite").parquet(f"{path}/main/batch={batch_id}")
        tagged.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        batch.agg(F.max(us).alias("high_us")).write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")

    feed(stream, path, handle)


def accept(stream: DataFrame, path: str, at: str, delay_s: int) -> DataFrame:
    """The rows a watermark of this delay would take, as a stream; the others land in ``path/late``.

    Every input row is in exactly one of the two tables. Call it for each run over a
    growing folder with the same ``path``, then read on from the returned stream.
    """
    late_split(stream, path, at, delay_s)
    return stream.sparkSession.readStream.schema(stream.schema.add("batch", "long")).parquet(f"{path}/main").drop("batch")


def spend_ceiling(stream: DataFrame, path: str, amount: Column, seq: str, limit: float) -> DataFrame:
    """Running spend per batch with the row at which the ceiling was reached: (batch, spent, total, stop_at)."""
    spark = stream.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        past = (
            spark.read.schema("spent double, total double, stop_at long, batch long").parquet(f"{path}/ledger").filter(F.col("batch") < batch_id)
            .agg(F.coalesce(F.sum("spent"), F.lit(0.0))).first()[0] if batch_id else 0.0
        )
        run = before(batch.select(F.col(seq).alias("_s"), amount.alias("_a")), [], "_s", sums={"_b": F.col("_a")})
        reached = F.col("_b") + F.col("_a") + past >= limit
        out = run.agg(
            F.coalesce(F.sum("_a"), F.lit(0.0)).alias("spent"), (F.coalesce(F.sum("_a"), F.lit(0.0)) + past).alias("total"), F.min(F.when(reached, F.col("_s"))).alias("stop_at")
        )
        out.write.mode("overwrite").parquet(f"{path}/ledger/batch={batch_id}")

    feed(stream, path, handle)
    return spark.read.schema("spent double, total double, stop_at long, batch long").parquet(f"{path}/ledger")
