"""Row-order state (previous value, running totals) that survives hot keys.

A plain window sorts all rows of a key in one task. Here each key is cut into
blocks of its integer order column; a block holds at most ``block`` distinct
positions, and the state handed from block to block is one small row per
(key, block). A key with a third of all rows is then spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 20


def before(
    df: DataFrame,
    keys: list[str],
    seq: str,
    *,
    last: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    maxs: dict[str, Column] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Add columns folded over the rows strictly before each row of its key.

    ``last``: latest non-null value; ``sums``: total (0 when none);
    ``maxs``: maximum (null when none). ``seq`` is an integer, unique per key.
    """
    last, sums, maxs = last or {}, sums or {}, maxs or {}
    values = {f"_v_{n}": e for n, e in [*last.items(), *sums.items(), *maxs.items()]}
    staged = df.withColumns(values).withColumn("_blk", F.expr(f"`{seq}` div {block}"))
    on = [*keys, "_blk"]

    # what each block hands on, then what each block receives: one small row per block
    given = staged.groupBy(*on).agg(
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(seq))).alias(f"_v_{n}") for n in last],
        *[F.sum(f"_v_{n}").alias(f"_v_{n}") for n in sums],
        *[F.max(f"_v_{n}").alias(f"_v_{n}") for n in maxs],
    )
    earlier = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    received = given.select(
        *on,
        *[F.last(f"_v_{n}", ignorenulls=True).over(earlier).alias(f"_v_{n}") for n in last],
        *[F.sum(f"_v_{n}").over(earlier).alias(f"_v_{n}") for n in sums],
        *[F.max(f"_v_{n}").over(earlier).alias(f"_v_{n}") for n in maxs],
        F.lit(True).alias("_head"),
    )

    # the received row leads its block, so one window over blocks gives the answer
    rows = staged.withColumn("_head", F.lit(False)).unionByName(received, allowMissingColumns=True)
    # the shuffle the window needs, asked for outright: a union's own partitioning is not to be trusted
    rows = rows.repartition(*on)
    inner = Window.partitionBy(*on).orderBy(F.col("_head").desc(), seq).rowsBetween(Window.unboundedPreceding, -1)
    found = {n: F.last(f"_v_{n}", ignorenulls=True).over(inner) for n in last}
    found |= {n: F.coalesce(F.sum(f"_v_{n}").over(inner), F.lit(0)) for n in sums}
    found |= {n: F.max(f"_v_{n}").over(inner) for n in maxs}
    return rows.withColumns(found).filter("not _head").drop("_head", "_blk", *values)


def previous(df: DataFrame, keys: list[str], seq: str, cols: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """Values of the row just before (null values stay null, unlike ``last``)."""
    packed = before(df, keys, seq, last={"_prev": F.struct(*[c.alias(n) for n, c in cols.items()])}, block=block)
    return packed.withColumns({n: F.col(f"_prev.{n}") for n in cols}).drop("_prev")


def numbered(df: DataFrame, keys: list[str], seq: str, out: str, block: int = BLOCK) -> DataFrame:
    """Position of each row inside its key, from 1."""
    return before(df, keys, seq, sums={out: F.lit(1).cast("long")}, block=block).withColumn(out, F.col(out) + 1)


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``; partial aggregation, no sort per key."""
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return packed.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key. The rank filter is pushed below the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("long")).filter(F.col(rank) <= n)


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys are equal; the key columns of the right side are dropped."""
    other = right.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_on_{k}"))
    return left.join(other, on, how).drop(*[f"_on_{k}" for k in keys])
