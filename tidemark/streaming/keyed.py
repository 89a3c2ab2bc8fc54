"""Keyed state over growing logs: stalls and liveness by event-time timers, markers paired across batches.

A processor sees each key's events in the order of their stamps, whatever batch brought
them: an event waits in the state until the watermark has passed it. Timers on the same
clock raise what happens because nothing happens. Rows are thinned inside their partition
before they move (first and last per key, kind and stretch of time), so a key with a third
of all rows sends a few rows per stretch to its state, not all of them. Keys share
slots, and a slot's events travel and wait as arrays: a call to the state costs about a
millisecond, so it must serve many keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import batched

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.ledger import pair_windows
from tidemark.streaming import jobs
from tidemark.streaming.jobs import STALE_S, STUCK_S, feed, run_available
from tidemark.streaming.mirror import KeyedTable

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Events of a slot, in arrays side by side: key, stamp in microseconds, what happened, and a mark of it.
EVENTS = "{key} array<{type}>, us array<long>, kind array<string>, mark array<string>"
#: State keys that all keys are dealt to. What waits for the watermark in one slot is in a task's memory at once.
SLOTS = 4096
#: Arrow batches (10,000 rows) that are thinned and packed at once.
TOGETHER = 32


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """State with timers needs this store; the session's own is put back afterwards."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


class Ordered(StatefulProcessor):
    """Folds each key's events in time order; see ``fold``. State of a slot: ``held`` events still ahead of the watermark, ``kept`` of its keys' folds."""

    KEPT = ""

    def __init__(self, key: str, columns: list[str]):
        self.key, self.type, self.said = key, "", Row(key, *columns)

    def fold(self, kept: tuple | None, events: list[tuple], now: int) -> tuple[list[tuple], tuple | None, int | None]:
        """What to say of events up to ``now``, the new state, and when to look again though nothing comes."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", EVENTS.format(key=self.key, type=self.type))
        self.kept = handle.getListState("kept", f"{self.key} {self.type}, {self.KEPT}")

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802 - Spark's name
        held = [(r[self.key], r.us, r.kind, r.mark) for r in rows]
        self.held.appendList(held)
        self._wake(min(min(us) for _, us, _, _ in held))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802 - Spark's name
        now = timerValues.getCurrentWatermarkInMs() * 1000
        events = sorted((e for some in self.held.get() for e in zip(*some)), key=lambda e: (e[1], e[2] or "", e[3] or ""))
        rest = [e for e in events if e[1] > now]
        kept = {k: values for k, *values in self.kept.get()}
        ready = {k: [] for k in kept}
        for k, *event in events[: len(events) - len(rest)]:
            ready.setdefault(k, []).append(tuple(event))
        wake = [rest[0][1]] if rest else []
        for k, own in ready.items():
            out, new, due = self.fold(tuple(kept[k]) if k in kept else None, own, now)
            if new is not None:
                kept[k] = new
            if due is not None and due > now:
                wake.append(due)
            for o in out:
                yield self.said(k, *o)
        if kept:
            self.kept.put([(k, *values) for k, values in kept.items()])
        if rest:
            self.held.put([tuple(list(column) for column in zip(*rest))])
        elif events:
            self.held.clear()
        if wake:
            self._wake(min(wake))


def thinned(stream: DataFrame, key: str, at: str, kind: Column, mark: Column, stretch_s: int) -> DataFrame:
    """``slot, key, us, kind, mark, seen``: each partition's first and last event per key, kind, mark and stretch of time.

    A row holds events of a slot in arrays, and the latest stamp among them. Between the two, events of a kind follow each other within the stretch, so a gap of more
    than the stretch is never lost.
    """
    stretch = stretch_s * 1_000_000
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int").alias("slot")
    rows = stream.select(slot, F.col(key), F.unix_micros(F.col(at).cast("timestamp")).alias("us"), kind.cast("string").alias("kind"), mark.cast("string").alias("mark"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for several in batched(batches, TOGETHER):
            some = pa.Table.from_batches(several).filter(pc.field("us").is_valid())
            part = pa.array(some.column("us").to_numpy() // stretch)
            ends = some.append_column("part", part).group_by(["slot", key, "kind", "mark", "part"]).aggregate([("us", "min"), ("us", "max")])
            first = ends.select(["slot", key, "us_min", "kind", "mark"]).rename_columns(["slot", key, "us", "kind", "mark"])
            last = ends.filter(pc.field("us_max") > pc.field("us_min")).select(["slot", key, "us_max", "kind", "mark"]).rename_columns(first.column_names)
            packed = pa.concat_tables([first, last]).cast(some.schema).group_by("slot").aggregate([(key, "list"), ("us", "list"), ("kind", "list"), ("mark", "list"), ("us", "max")])
            yield from packed.rename_columns(["slot", key, "us", "kind", "mark", "last"]).to_batches()

    thin = rows.mapInArrow(run, f"slot int, {EVENTS.format(key=key, type=dict(rows.dtypes)[key])}, last long")
    return thin.select("slot", key, "us", "kind", "mark", F.timestamp_micros("last").alias("seen"))


def run_ordered(events: DataFrame, processor: Ordered, schema: str, path: str, delay_s: int) -> DataFrame:
    """All there is of ``events`` (see ``thinned``) through the processor; what it said, so far, as a table.

    The watermark stays a millisecond behind ``delay_s``, as Spark takes a stamp equal to it for late.
    """
    spark = events.sparkSession
    processor.type = events.schema[processor.key].dataType.elementType.simpleString()
    said = events.withWatermark("seen", f"{delay_s * 1000 + 1} milliseconds").groupBy("slot").transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="eventTime"
    )
    with rocks(spark):
        return run_available(said, path)


def state_of(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One state variable of a job that isn't running, as a table of the variable's own columns."""
    with rocks(spark):
        reader = spark.read.format("statestore").option("path", f"{path}/checkpoint").option("stateVarName", name)
        return reader.load().select("list_element.*")


def held_of(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Events of a job that isn't running which still wait for the watermark, one per row: ``key, us, kind, mark``."""
    return state_of(spark, path, "held").select(F.explode(F.arrays_zip(key, "us", "kind", "mark")).alias("e")).select("e.*")


# ---- stalls ---------------------------------------------------------------------


class Stalls(Ordered):
    """Raised once per stall: the last event was ``working`` and nothing followed for more than the limit."""

    KEPT = "us long, kind string, raised boolean"

    def __init__(self, key: str, working: str, limit_s: int):
        super().__init__(key, ["since_us"])
        self.working, self.limit = working, limit_s * 1_000_000

    def fold(self, kept, events, now):
        us, kind, raised = kept or (None, None, False)
        out = []

        def check(until: int) -> None:
            nonlocal raised
            if us is not None and kind == self.working and not raised and until - us > self.limit:
                out.append((us,))
                raised = True

        for at, what, _ in events:
            check(at)
            if us is None or at >= us:
                us, kind, raised = at, what, False
        check(now)
        due = us + self.limit + 1 if us is not None and kind == self.working and not raised else None
        return out, None if us is None else (us, kind, raised), due


def stalls(stream: DataFrame, key: str, at: str, op: Column, working: str, path: str, limit_s: int = STUCK_S, delay_s: int = 0) -> DataFrame:
    """``key, since_us``: each stall that more than ``limit_s`` of event time has shown so far.

    Call it again with the same ``path`` as the folder grows. Rows more than ``delay_s``
    behind earlier batches must have been set aside by ``jobs.accept``. Of events with one
    stamp the op that sorts last counts.
    """
    events = thinned(stream, key, at, op, F.lit(None), limit_s)
    schema = f"{key} {dict(stream.dtypes)[key]}, since_us long"
    return run_ordered(events, Stalls(key, working, limit_s), schema, path, delay_s)


def open_stalls(spark: SparkSession, path: str, key: str, working: str, now_us: Column, limit_s: int = STUCK_S) -> DataFrame:
    """Stalls that the log's end leaves open: ``key, since_us`` of keys whose last event is ``working`` and older than the limit at ``now_us``.

    Those that ``stalls`` has raised already are not among them.
    """
    kept = state_of(spark, path, "kept").select(key, "us", "kind", "raised")
    held = held_of(spark, path, key).select(key, "us", "kind", F.lit(False).alias("raised"))
    last = kept.union(held).groupBy(key).agg(F.max(F.struct("us", "kind", "raised")).alias("l"))
    quiet = (F.col("l.kind") == working) & ~F.col("l.raised") & (now_us - F.col("l.us") > limit_s * 1_000_000)
    return last.filter(quiet).select(key, F.col("l.us").alias("since_us"))


# ---- liveness -------------------------------------------------------------------


class Liveness(Ordered):
    """Says a run's state whenever it changes. Kinds: ``lock`` (mark: ``dead`` if its holder is gone), ``write``, ``stop``, ``finish``."""

    KEPT = "lock_us long, holder boolean, write_us long, stopped boolean, finished boolean, state string"

    def __init__(self, key: str, stale_s: int, lock_stale_s: int):
        super().__init__(key, ["at_us", "state"])
        self.stale, self.lock_stale = stale_s * 1_000_000, lock_stale_s * 1_000_000

    def state(self, lock, holder, write, stopped, finished, now) -> str:
        if stopped:
            return "FINISHED" if finished else "STOPPED"
        fresh = lock is not None and holder and now - lock < self.lock_stale and write is not None and now - write < self.stale
        return "LIVE" if fresh else "DEAD"

    def fold(self, kept, events, now):
        lock, holder, write, stopped, finished, state = kept or (None, False, None, False, False, None)
        out = []

        def say(at: int) -> None:
            nonlocal state
            new = self.state(lock, holder, write, stopped, finished, at)
            if new != state:
                out.append((at, new))
                state = new

        def ends() -> int | None:
            """When a live run goes stale."""
            return min(lock + self.lock_stale, write + self.stale) if state == "LIVE" else None

        for i, (at, kind, mark) in enumerate(events):
            end = ends()
            if end is not None and end <= at:
                say(end)
            if kind == "lock":
                lock, holder = at, mark != "dead"
            elif kind == "write":
                write = at
            elif kind == "stop":
                stopped = True
            elif kind == "finish":
                finished = True
            if i + 1 == len(events) or events[i + 1][0] != at:
                say(at)
        end = ends()
        if end is not None and end <= now:
            say(end)
        return out, (lock, holder, write, stopped, finished, state), ends()


def run_liveness(locks: DataFrame, writes: DataFrame, run: str, path: str, stale_s: int = STALE_S, lock_stale_s: int = STALE_S, delay_s: int = 0) -> DataFrame:
    """``run, at_us, state`` of every change of state, from two inputs.

    ``locks``: run, at, alive (is the lock's holder there). ``writes``: run, at, kind (``write``,
    ``stop`` or ``finish``). A stop outranks all, and reads FINISHED once a finish was marked.
    LIVE needs a fresh lock of a living holder and fresh writes; what was fresh goes stale by a
    timer on the events' clock, as Spark's own time-to-live follows the wall clock.
    """
    mark = F.when(F.coalesce(F.col("alive"), F.lit(False)), "alive").otherwise("dead")
    least = min(stale_s, lock_stale_s)
    both = thinned(locks, run, "at", F.lit("lock"), mark, least).union(thinned(writes, run, "at", F.col("kind"), F.lit(None), least))
    schema = f"{run} {dict(locks.dtypes)[run]}, at_us long, state string"
    return run_ordered(both, Liveness(run, stale_s, lock_stale_s), schema, path, delay_s)


def liveness_now(spark: SparkSession, path: str, run: str, now_us: Column, stale_s: int = STALE_S, lock_stale_s: int = STALE_S) -> DataFrame:
    """``run, state`` at ``now_us`` from what ``run_liveness`` keeps, with what still waits for the watermark."""
    kept = state_of(spark, path, "kept").select(run, F.struct("lock_us", "holder").alias("lock"), "write_us", "stopped", "finished")
    is_ = lambda kind: F.col("kind") == kind
    held = held_of(spark, path, run).groupBy(run).agg(
        F.max(F.when(is_("lock"), F.struct("us", F.col("mark") != "dead"))).alias("lock"), F.max(F.when(is_("write"), F.col("us"))).alias("write_us"),
        F.bool_or(is_("stop")).alias("stopped"), F.bool_or(is_("finish")).alias("finished"),
    )
    every = kept.union(held).groupBy(run).agg(F.max("lock").alias("lock"), F.max("write_us").alias("last_us"), F.bool_or("stopped").alias("stopped"), F.bool_or("finished").alias("finished"))
    lock = F.when(F.col("lock.holder"), F.col("lock.lock_us"))
    return jobs.liveness(every, now_us, stale_s, lock, lock_stale_s).select(run, "state")


# ---- markers --------------------------------------------------------------------


def pair_markers(stream: DataFrame, path: str, key: str, seq: str, opened: Column, closed: Column, at: str, buckets: int = 16) -> DataFrame:
    """Open/close markers paired as they arrive: a close meets the marker right before it, if that is an open one.

    ``stream`` is a log in the order of ``seq``, an integer unique per key; a row at or below
    what earlier batches have brought is late and goes to ``path/late``. Between batches a key
    is one row, its last marker, in a table that grows with its keys; within a batch keys are
    cut into blocks (``operators.ordered``), so a hot key is spread and the output is linear.
    """
    spark = stream.sparkSession
    schema = f"{key} {dict(stream.dtypes)[key]}, {seq} long, _op string, _at long"
    newest = lambda rows, by: rows.groupBy(key).agg(F.max_by(F.struct(seq, "_op", "_at"), by).alias("m")).select(key, "m.*")
    lasts = KeyedTable(spark, f"{path}/last", schema, key, newest, buckets)
    highs = "high long, batch long"

    def handle(batch: DataFrame, batch_id: int) -> None:
        past = spark.read.schema(highs).parquet(f"{path}/highs").filter(F.col("batch") < batch_id).agg(F.max("high")).first()[0] if batch_id else None
        rows = batch.withColumn("_late", F.lit(False) if past is None else F.col(seq) <= past)
        rows.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        markers = rows.filter("NOT _late").select(key, F.col(seq).cast("long").alias(seq), F.when(opened, "o").when(closed, "c").alias("_op"), F.col(at).cast("long").alias("_at")).filter("_op IS NOT NULL")
        # Only keys that this batch brings are looked up.
        carried = lasts.read(before=batch_id).join(markers.select(key).distinct(), key, "left_semi")
        pairs = pair_windows(carried.unionByName(markers), [key], seq, F.col("_op") == "o", F.col("_op") == "c", "_at")
        pairs.write.mode("overwrite").parquet(f"{path}/pairs/batch={batch_id}")
        lasts.append(newest(markers, seq), batch_id)
        batch.agg(F.max(F.col(seq).cast("long")).alias("high")).write.mode("overwrite").parquet(f"{path}/highs/batch={batch_id}")

    feed(stream, path, handle)
    return spark.read.schema(f"{key} {dict(stream.dtypes)[key]}, s long, e long, batch long").parquet(f"{path}/pairs").drop("batch")
