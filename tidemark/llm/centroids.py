"""Centroid clustering over a LAESA pivot table: exact integer k-means that computes few distances.

Components become integers, so every distance, sum and centroid is exact. The distances of
each vector to a few fixed pivots are computed once and stored beside it. In every round a
centroid's own distances to the pivots are known too, and by the triangle inequality the
largest difference of the two is a lower bound of its distance to the vector. Only centroids
whose bound is not above the distance to the most promising one get an exact distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table

DIM = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
PIVOTS = 16
SEED = 2
#: Integer components from here on would take squared distances past 64 bits.
LARGEST = 1 << 27
#: Rounding of square roots is far below this; bounds are lowered by it, so none rules out too much.
SLACK = 1e-9


def whole_vectors(rows: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)``: vectors as ``dim`` integers ``floor(scale * component)``, little-endian 32 bit in one binary.

    Null vectors, other lengths and vectors with a null or non-finite component take no part;
    nor do those whose integers reach 2^27, as their squared distances would pass 64 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            fits = pc.fill_null(pc.equal(pc.list_value_length(lists), dim), False)
            ids, lists = pc.filter(batch.column(0), fits), pc.filter(lists, fits)
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # a null becomes NaN
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(x * scale)
                good = (np.abs(x) < LARGEST).all(axis=1)
            x = x[good].astype("<i4")
            yield pa.RecordBatch.from_arrays([pc.filter(ids, pa.array(good)), pa.array([v.tobytes() for v in x], pa.binary())], names=["vec_id", "x"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, "vec_id long, x binary")


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, exact."""
    out = np.empty((len(a), len(b)), np.int64)
    for k, row in enumerate(b):
        d = a - row
        out[:, k] = np.einsum("ij,ij->i", d, d)
    return out


class Seeds(NamedTuple):
    centroids: np.ndarray
    pivots: np.ndarray


def seeds(vectors: DataFrame, clusters: int = CLUSTERS, pivots: int = PIVOTS, seed: int = SEED, dim: int = DIM) -> Seeds:
    """The first centroids, by ascending SHA-256 of ``seed:vec_id``; the first of these are the pivots too.

    Ties (rows that share an id) go by the vector; rows without an id come last.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select(key.alias("_key"), "x").orderBy(F.col("_key").asc_nulls_last(), "x").limit(clusters).collect()  # as many rows as clusters
    first = np.array([np.frombuffer(bytes(r.x), "<i4") for r in rows], np.int64).reshape(-1, dim)
    return Seeds(first, first[:pivots])


def pivot_table(vectors: DataFrame, pivots: np.ndarray, dim: int = DIM) -> DataFrame:
    """``(vec_id, x, far)`` with the distances to the pivots (64-bit floats in one binary), stored in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = np.sqrt(_squares(_integers(batch.column(1), dim), pivots).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f.tobytes() for f in far], pa.binary())], names=["vec_id", "x", "far"])

    return kept(vectors.mapInArrow(run, "vec_id long, x binary, far binary"))


def nearest(x: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of every vector's nearest centroid, and how many exact distances that took.

    Of equally near ones the smaller number counts.
    """
    reach = np.sqrt(_squares(centroids, pivots).astype(np.float64))
    bound = np.zeros((len(x), len(centroids)))
    for j in range(len(pivots)):
        np.maximum(bound, np.abs(far[:, j, None] - reach[None, :, j]), out=bound)
    bound = np.maximum(bound * (1 - SLACK) - 1e-6, 0.0) ** 2
    rows = np.arange(len(x))
    likely = bound.argmin(axis=1)
    step = x - centroids[likely]
    best = np.einsum("ij,ij->i", step, step)
    number = likely.copy()
    asked = len(x)
    for k in range(len(centroids)):
        at = rows[(bound[:, k] * (1 - SLACK) <= best) & (likely != k)]
        step = x[at] - centroids[k]
        d = np.einsum("ij,ij->i", step, step)
        asked += len(at)
        closer = (d < best[at]) | ((d == best[at]) & (k < number[at]))
        at = at[closer]
        best[at], number[at] = d[closer], k
    return number, best, asked


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    x = _integers(batch.column(1), centroids.shape[1])
    far = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(-1, len(pivots))
    return x, *nearest(x, far, centroids, pivots)


def step(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: every vector to its nearest centroid, then the centroids' exact floored means; empty ones stay."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x, number, _, _ = _assigned(batch, centroids, pivots)
            n += np.bincount(number, minlength=k)
            for c in np.unique(number):
                sums[c] += x[number == c].sum(axis=0)
        some = np.flatnonzero(n)
        flat = pa.array(sums[some].ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * dim), flat)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), lists], names=["cluster", "n", "sums"])

    parts = stored.mapInArrow(run, "cluster int, n long, sums array<long>")
    # A row per task and cluster; totals past 64 bits are an error under ANSI, never wrong.
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dim)]).alias("sums")).collect()
    out = centroids.copy()
    for r in rows:
        out[r.cluster] = np.array(r.sums, np.int64) // r.n
    return out


def cluster(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` of every vector that takes part, and the final centroids.

    ``rows`` has ``vec_id`` and ``embedding``; other columns, however named, are not read. See
    ``whole_vectors`` for what takes part; repeated rows each count. With fewer vectors than
    ``clusters`` there are as many clusters as vectors, and without any the result is empty.
    Only centroids (``clusters`` x ``dim`` numbers) ever meet in the driver.
    """
    vectors = whole_vectors(rows, dim, scale)
    first = seeds(vectors, clusters, pivots, seed, dim)
    stored = pivot_table(vectors, first.pivots, dim)
    centroids = first.centroids
    if len(centroids):
        for _ in range(rounds):
            centroids = step(stored, centroids, first.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, number, best, _ = _assigned(batch, centroids, first.pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return stored.mapInArrow(run, "vec_id long, cluster int, distance long"), centroids


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole 64-component embedding in one of 40 clusters, with the digests of its cluster."""
    said, centroids = cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    said = kept(said)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    names = spark.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    per = said.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia").alias("inertia"))
    # One row a cluster, and one row: at most 40.
    per = per.join(F.broadcast(total)).join(F.broadcast(names), "cluster")
    return said.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """Rounds written out: every round's centroids come from the assignment to those before."""
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, i, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM embeddings, (SELECT unnest(range(1, {DIM + 1})) AS i) r WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)",
        f"s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM (SELECT DISTINCT vec_id FROM v) ORDER BY k LIMIT {CLUSTERS})",
        "c0 AS MATERIALIZED (SELECT k, i, x AS y FROM v JOIN s USING (vec_id))",
    ]
    for r in range(ROUNDS + 1):
        parts += [
            f"d{r} AS (SELECT vec_id, k, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d FROM v JOIN c{r} USING (i) GROUP BY vec_id, k)",
            f"a{r} AS MATERIALIZED (SELECT vec_id, arg_min(k, d * 64 + k) AS k, min(d) AS d FROM d{r} GROUP BY vec_id)",
        ]
        if r < ROUNDS:
            parts += [
                f"m{r} AS (SELECT k, i, sum(x) AS t, count(*) AS n FROM v JOIN a{r} USING (vec_id) GROUP BY k, i)",
                f"c{r + 1} AS MATERIALIZED (SELECT c.k, c.i, CASE WHEN n IS NULL THEN c.y ELSE CAST((t - ((t % n) + n) % n) // n AS BIGINT) END AS y FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k AND c.i = m.i)",
            ]
    last = f"a{ROUNDS}"
    return f"""WITH {", ".join(parts)},
h AS (SELECT k, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, CAST(k AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM {last} JOIN h USING (k)"""


SQL = _sql()


def register(queries: dict, oracles: dict) -> None:
    queries["op12_centroids"] = op12_centroids
    oracles["op12_centroids"] = SQL
