"""Mixing sources to target weights: Sainte-Lague quotas of equal-token blocks, then seeded blocks.

1. Targets: weights share the budget; no source takes more than ``repeat`` times its
   size, and the excess is shared again by weight (one water level, found by running totals).
2. Quotas: blocks of ``block`` words go to the sources by the highest quotients
   ``target / (2k + 1)``, and each source's blocks to its shards in the same way.
   Rounding at the common divisor leaves a few blocks to settle; only their quotients are listed.
3. Blocks: a shard is a seeded order of its documents, cut into blocks of equal size.
   A quota of q takes q div n whole passes and q mod n blocks by a seeded step permutation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import on_disk, sheltered, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEAT = 2
BLOCK = 8
SHARD_ROWS = 2000
SEED = "tidemark"
#: A prime above any number of blocks in a shard, so that steps of it meet every block once.
STEP = 1_000_000_007


def sainte_lague(rows: DataFrame, seats: Column, votes: str, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Add ``out``: the seats of each row of its group ``keys`` by highest quotients ``votes / (2k + 1)``.

    ``seats`` is the group's total. Ties go to the row first in ``order`` (numbers). Groups
    without votes get none. A group is one row per source or shard, not per document.
    """
    group = W.partitionBy(*keys)
    total = F.sum(votes).over(group)
    base = rows.withColumns({"_seats": seats, "_total": total})
    ideal = F.when(F.col("_total") > 0, F.col(votes) * F.col("_seats") / F.col("_total")).otherwise(F.lit(0.0))
    base = base.withColumn("_first", F.floor(ideal + 0.5)).withColumn("_gap", F.when(F.col("_total") > 0, F.col("_seats") - F.sum("_first").over(group)).otherwise(0))
    # The gap is at most half the rows of the group; a row can move by its share of it and one more.
    reach = F.least(F.abs("_gap"), F.ceil(F.abs("_gap") * F.col(votes) / F.col("_total")) + 2)
    steps = F.when((F.col("_gap") == 0) | (F.col(votes) <= 0), F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(0).cast("long"), reach.cast("long")))
    k = F.when(F.col("_gap") > 0, F.col("_first") + F.col("_k")).otherwise(F.col("_first") - 1 - F.col("_k"))
    listed = base.select(*keys, *order, "_gap", votes, "_first", F.explode(steps).alias("_k")).withColumn("_at", k).filter("_at >= 0")
    quotient = F.col(votes) / (2 * F.col("_at") + 1)
    turn = F.when(F.col("_gap") > 0, -quotient).otherwise(quotient)
    # Of equal quotients the later one is the first to be given back.
    ties = [F.when(F.col("_gap") > 0, F.col(o)).otherwise(-F.col(o)) for o in order]
    rank = F.row_number().over(group.orderBy(turn, *ties))
    moved = listed.withColumn("_turn", turn).withColumn("_rank", rank).filter("_rank <= abs(_gap)")
    moved = moved.groupBy(*[F.col(c).alias(f"_{c}") for c in keys + order]).agg(F.sum(F.signum("_gap")).alias("_move"))
    same = None
    for c in keys + order:
        same = F.col(c).eqNullSafe(F.col(f"_{c}")) if same is None else same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = base.join(moved, same, "left")
    return joined.withColumn(out, (F.col("_first") + F.coalesce("_move", F.lit(0))).cast("long")).drop("_seats", "_total", "_first", "_gap", "_move", *[f"_{c}" for c in keys + order])


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """``sources(source, source_size, n_docs)`` with ``target``; weights repeat in code-point order, null last."""
    every = W.partitionBy(F.lit(1))
    place = F.row_number().over(every.orderBy(F.col("source").cast("binary").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("place", place).withColumn("weight", weight).withColumn("most", F.col("source_size") * float(repeat))
    rows = rows.withColumn("budget", F.sum("source_size").over(every) * share)
    line = every.orderBy(F.col("most") / F.col("weight"), "place")
    rows = rows.withColumn("full_before", F.coalesce(F.sum("most").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    rows = rows.withColumn("weight_from", F.sum("weight").over(line.rowsBetween(W.currentRow, W.unboundedFollowing)))
    rows = rows.withColumn("level", (F.col("budget") - F.col("full_before")) / F.col("weight_from"))
    # Along the line the level rises while sources overflow it and falls after: its peak is the water level.
    rows = rows.withColumn("level", F.max("level").over(every))
    return rows.withColumn("target", F.least(F.col("most"), F.col("level") * F.col("weight"))).select(*sources.columns, "place", "target")


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the words of its text, in place of the text."""
    return docs.withColumn("size", word_count(F.col("text"))).drop("text")


def mix(docs: DataFrame, block: int = BLOCK, shard_rows: int = SHARD_ROWS, seed: str = SEED, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """``docs(doc_id, source, size, ...)`` with ``source_size, target, taken``.

    Documents of size 0 (null or empty texts) take 0. A null source is a source of its
    own, last in order. Equal rows are interchangeable: their ``taken`` values are the
    same as a multiset on every run. Rows without ``doc_id`` are drawn by their size. An
    empty table gives no rows. Other columns stay; those named like results are replaced.
    """
    new = ("source_size", "target", "taken")
    return sheltered(docs, ("doc_id", "source", "size"), new, lambda rows: _mixed(rows, block, shard_rows, seed, weights, share, repeat))


def _mixed(rows: DataFrame, block: int, shard_rows: int, seed: str, weights, share: float, repeat: int) -> DataFrame:
    """All columns of ``rows``, working ones too, with the results."""
    who = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("size").cast("string"))))
    rows = on_disk(rows.withColumn("_draw", F.md5(who.cast("binary"))))  # sizes are counted once, not once a branch
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = targets(sizes, weights, share, repeat).withColumn("_group", F.lit(1))
    plan = sainte_lague(plan, F.floor(F.sum("target").over(W.partitionBy("_group")) / block + 0.5), "target", ["_group"], ["place"], "blocks")
    plan = plan.withColumn("n_shards", F.ceil(F.col("n_docs") / shard_rows)).select(F.col("source").alias("_source"), "source_size", "target", "blocks", "place", "n_shards")
    # One row per source: the planner broadcasts it only below its size threshold.
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("shard", F.pmod(F.conv(F.substr("_draw", F.lit(1), F.lit(8)), 16, 10).cast("long"), F.col("n_shards")))
    stream = W.partitionBy("place", "shard").orderBy("_draw", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum("size").over(stream), F.lit(0)))
    shards = rows.groupBy("place", "shard").agg(F.sum("size").alias("shard_size"), F.max("blocks").alias("blocks"))
    shards = sainte_lague(shards, F.col("blocks"), "shard_size", ["place"], ["shard"], "quota")
    shards = shards.select(F.col("place").alias("_place"), F.col("shard").alias("_shard"), "shard_size", "quota")
    rows = rows.drop("blocks").join(shards, (F.col("place") == F.col("_place")) & (F.col("shard") == F.col("_shard")))
    rows = rows.withColumn("_n", F.greatest(F.ceil(F.col("shard_size") / block), F.lit(1).cast("long"))).withColumn("_quota", F.least("quota", F.col("_n") * repeat))
    rows = rows.withColumns({"_end": F.col("_start") + F.col("size"), "_pass": F.floor(F.col("_quota") / F.col("_n")), "_some": F.col("_quota") % F.col("_n")})
    # Block b is [b * shard_size div n, (b + 1) * shard_size div n); a document meets a run of blocks.
    some = F.expr(f"""aggregate(sequence(_start * _n div shard_size, least(_end * _n div shard_size, _n - 1)), 0L, (acc, b) -> acc +
        CASE WHEN pmod(b * {STEP} + place * 7919 + shard * 104729, _n) < _some
             THEN greatest(0L, least(_end, (b + 1) * shard_size div _n) - greatest(_start, b * shard_size div _n)) ELSE 0L END)""")
    taken = F.when(F.col("size") == 0, 0).otherwise(F.col("size") * F.col("_pass") + F.when(F.col("_some") > 0, some).otherwise(0)).cast("long")
    return rows.withColumn("taken", taken)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mix(sized(docs)).select("doc_id", "size", "source_size", "target", "taken")


#: The same mix by the definitions: every quotient is listed and ranked. White space is spelled out for RE2.
SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5('tidemark:' || doc_id) AS draw FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM docs GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM src
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(place % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM placed
), line AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
         sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_from FROM weighed
), lev AS (
  SELECT max((budget - full_before) / weight_from) AS level FROM line
), tgt AS (
  SELECT source, place, source_size, n_docs, least(most, level * weight)::DOUBLE AS target FROM weighed, lev
), n AS (SELECT floor(sum(target) / 8 + 0.5)::BIGINT AS blocks FROM tgt
), quotients AS (
  SELECT place, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place) AS r
  FROM (SELECT place, target, unnest(range(0, (target / 8)::BIGINT + 100)) AS k FROM tgt WHERE target > 0)
), won AS (SELECT place, count(*) AS blocks FROM quotients, n WHERE r <= n.blocks GROUP BY place
), dealt AS (
  SELECT d.*, t.place, t.source_size, t.target, coalesce(w.blocks, 0) AS blocks,
         ('0x' || substr(draw, 1, 8))::BIGINT % ceil(t.n_docs / 2000.0)::BIGINT AS shard
  FROM docs d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN won w USING (place)
), laid AS (
  SELECT *, (coalesce(sum(size) OVER (PARTITION BY place, shard ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start FROM dealt
), shards AS (
  SELECT place, shard, sum(size)::BIGINT AS shard_size, max(blocks) AS blocks FROM dealt GROUP BY place, shard
), squot AS (
  SELECT place, shard, blocks, row_number() OVER (PARTITION BY place ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard) AS r
  FROM (SELECT *, unnest(range(0, blocks)) AS k FROM shards WHERE shard_size > 0)
), quota AS (
  SELECT place, shard, count(*) AS quota FROM squot WHERE r <= blocks GROUP BY place, shard
), sized AS (
  SELECT l.*, s.shard_size, ceil(s.shard_size / 8.0)::BIGINT AS n, least(coalesce(q.quota, 0), 2 * ceil(s.shard_size / 8.0)::BIGINT) AS quota
  FROM laid l JOIN shards s USING (place, shard) LEFT JOIN quota q USING (place, shard)
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE size * (quota // n) + coalesce((
    SELECT sum(greatest(0, least(start + size, (b + 1) * shard_size // n) - greatest(start, b * shard_size // n)))
    FROM (SELECT unnest(range(start * n // shard_size, least((start + size) * n // shard_size, n - 1) + 1)) AS b)
    WHERE (b * 1000000007 + place * 7919 + shard * 104729) % n < quota % n), 0) END::BIGINT AS taken
FROM sized
"""


def register(queries: dict, oracles: dict) -> None:
    queries["op4_mixing"] = op4_mixing
    oracles["op4_mixing"] = SQL
