"""Line-oriented logs: transitions, lock markers, occupancy samples, commits, diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Log grammar.
FIELDS = 8
STAMP = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})"
SAMPLE = "t double, n int, owners array<struct<slot string, repo string, run_id string, cycle int>>"
SEP = "\x1f"
HUNK = r"^@@ -\d+(?:,\d+)? \+(\d+)(?:,\d+)? @@"


def render_transition(ts, slug, op, frm, to, actor, sha12, status, note) -> Column:
    return F.concat_ws(
        " | ", ts, slug, op, F.concat(frm, F.lit(" -> "), to), F.concat(F.lit("actor="), actor), F.concat(F.lit("sha12="), sha12), status,
        F.concat(F.lit("note="), F.coalesce(note, F.lit("-"))),
    )


def parse_transitions(lines: DataFrame, line: str = "value") -> DataFrame:
    """Fields of each log line; header and blank lines are skipped, bad ones kept in ``_corrupt``."""
    kept = lines.filter(F.col(line).rlike(r"\S") & ~F.col(line).startswith("#"))
    p = kept.withColumn("_f", F.split(line, r" \| ", FIELDS))
    move = F.split(F.get("_f", F.lit(3)), " -> ", 2)
    good = (F.size("_f") == FIELDS) & (F.size(move) == 2) & F.get("_f", F.lit(4)).startswith("actor=") & F.get("_f", F.lit(5)).startswith("sha12=") & F.get("_f", F.lit(7)).startswith("note=")

    def field(i, prefix=""):
        return F.when(good, F.substring(F.get("_f", F.lit(i)), len(prefix) + 1, 1 << 30))

    note = field(7, "note=")
    return p.withColumns(
        {
            "ts": field(0), "slug": field(1), "op": field(2), "from_stage": F.when(good, F.get(move, F.lit(0))), "to_stage": F.when(good, F.get(move, F.lit(1))),
            "actor": field(4, "actor="), "sha12": field(5, "sha12="), "status": field(6), "note": F.when(note != "-", note),
            "_corrupt": F.when(~good, F.col(line)),
        }
    ).drop("_f")


def read_transition_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_transitions(spark.read.text(path)).drop("value")


def parse_lock_events(lines: DataFrame, line: str = "value") -> DataFrame:
    """Marker and epoch seconds of controller lines; other lines are dropped."""
    v = F.col(line)
    kind = (
        F.when(F.contains(v, F.lit("winmutex: ACQUIRED")), "ACQUIRED").when(F.contains(v, F.lit("winmutex: RELEASED")), "RELEASED")
        .when(F.contains(v, F.lit("winmutex: UNSERIALIZED")), "UNSERIALIZED")
        .when(F.contains(v, F.lit("slots:")) & F.contains(v, F.lit("busy - waiting")), "busy")
        .when(F.contains(v, F.lit("slots: acquired")), "acquired")
    )
    at = F.unix_timestamp(F.try_to_timestamp(F.regexp_extract(v, STAMP, 1), F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    return lines.withColumns({"marker": kind, "at": at}).filter("marker is not null")


def read_lock_events(spark: SparkSession, path: str) -> DataFrame:
    return parse_lock_events(spark.read.text(path))


def read_slot_samples(spark: SparkSession, path: str) -> DataFrame:
    """Occupancy samples; lines that do not parse are skipped."""
    return spark.read.schema(SAMPLE).option("mode", "DROPMALFORMED").json(path)


def shared_samples(samples: DataFrame) -> DataFrame:
    """Samples, peak occupancy, and samples in which several owners hold a slot."""
    owners = F.array_distinct(F.filter(F.transform("owners", lambda o: o["repo"]), lambda r: r.isNotNull() & (r != "")))
    return samples.agg(F.count("*").alias("samples"), F.max("n").alias("peak"), F.count_if(F.size(owners) > 1).alias("shared"))


def parse_commits(lines: DataFrame, line: str = "value") -> DataFrame:
    f = F.split(line, SEP)
    ok = lines.filter((F.size(f) == 3) & F.get(f, F.lit(0)).rlike(r"\S"))
    return ok.select(*[c for c in lines.columns if c != line], *[F.trim(F.get(f, F.lit(i))).alias(n) for i, n in enumerate(("sha", "subject", "date"))])


def read_commit_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_commits(spark.read.text(path))


def parse_numstat(lines: DataFrame, line: str = "value") -> DataFrame:
    """added, deleted, path; rows without numbers (binary files) are skipped."""
    f = F.split(line, "\t")
    rows = lines.select(*[c for c in lines.columns if c != line], F.get(f, F.lit(0)).try_cast("long").alias("added"), F.get(f, F.lit(1)).try_cast("long").alias("deleted"), F.get(f, F.lit(2)).alias("path"), F.size(f).alias("_n"))
    return rows.filter("_n = 3 and added is not null and deleted is not null").drop("_n")


def diff_added_lines(diffs: DataFrame, key: str, text: str) -> DataFrame:
    """File, new-line number and text of every added line; a hunk header resets the count."""
    lines = diffs.select(key, F.posexplode(F.split(text, "\n")).alias("i", "line"))
    w = Window.partitionBy(key).orderBy("i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    head = F.col("line").startswith("+++ ")
    name = F.regexp_replace(F.trim(F.substring("line", 5, 1 << 30)), "^b/", "")
    start = F.regexp_extract("line", HUNK, 1).try_cast("long")
    added = F.col("line").startswith("+") & ~F.col("line").startswith("+++")
    seen = lines.withColumns(
        {
            "file": F.last(F.when(head, F.struct(F.when(name != "/dev/null", name).alias("n"))), ignorenulls=True).over(upto)["n"],
            "_start": F.last(start, ignorenulls=True).over(upto),
            "_hunk": F.sum(F.when(start.isNotNull() | head, 1).otherwise(0)).over(upto),
            "_add": added.cast("int"),
        }
    )
    nth = F.sum("_add").over(Window.partitionBy(key, "_hunk").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    return seen.withColumn("line_no", F.col("_start") + F.coalesce(nth, F.lit(0))).filter("_add = 1 and file is not null").select(
        key, "file", "line_no", F.substring("line", 2, 1 << 30).alias("added")
    )
