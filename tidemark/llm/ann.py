"""Approximate nearest neighbours: a navigable small-world graph per shard, merged.

1. Equal vectors meet first: of each only the smallest ids are carried, one more than
   an answer can name, so copies neither swell a graph nor cut it apart.
2. Distinct vectors are dealt over shards by hash. Each shard becomes one row: vectors
   and, per level, fixed-width neighbour arrays, all flat.
3. Queries travel in blocks, each block to every shard; the best of all shards are ranked.

Graphs are built in rising batches: a batch searches the graph so far, links to diverse
neighbours (a candidate stays if it is nearer to the node than to any neighbour kept),
and neighbours whose lists overflow choose anew by the same rule. Searches of a batch
advance together, so that all arithmetic is on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import on_disk, table

K = 10
SHARD_ROWS = 8192
LINKS, BEAM_BUILD, BEAM = 16, 64, 128
#: Queries that one row carries to a shard.
BLOCK = 256


def _distance(x: np.ndarray, to: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of ``x[i]`` to ``to[at[i, j]]``; missing (-1) is infinite."""
    picked = to[np.maximum(at, 0)]
    d = np.einsum("ijk,ijk->ij", picked, picked) - 2 * np.einsum("ijk,ik->ij", picked, x) + np.einsum("ik,ik->i", x, x)[:, None]
    return np.where(at < 0, np.inf, np.maximum(d, 0))


def beam_search(x: np.ndarray, vectors: np.ndarray, links: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``beam`` nodes ``(ids, squared distances)`` of each query, nearest first; all queries step together."""
    n = len(x)
    rows = np.arange(n)
    seen = np.zeros((n, len(vectors) + 1), bool)
    ids = np.full((n, beam), -1, np.int32)
    dist = np.full((n, beam), np.inf, np.float32)
    done = np.ones((n, beam), bool)
    ids[:, : start.shape[1]] = start
    dist[:, : start.shape[1]] = _distance(x, vectors, start)
    done[:, : start.shape[1]] = start < 0
    seen[rows[:, None], start] = True
    seen[:, -1] = True
    live = rows
    while len(live):
        open_at = np.where(done[live], np.inf, dist[live])
        pick = open_at.argmin(axis=1)
        going = np.isfinite(open_at[np.arange(len(live)), pick])
        live, pick = live[going], pick[going]
        if not len(live):
            break
        done[live, pick] = True
        near = links[ids[live, pick]]
        near = np.where(seen[live[:, None], near], -1, near)
        seen[live[:, None], near] = True  # -1 marks the spare last place
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_dist = np.concatenate([dist[live], _distance(x[live], vectors, near)], axis=1)
        all_done = np.concatenate([done[live], near < 0], axis=1)
        best = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        ids[live], dist[live], done[live] = (np.take_along_axis(v, best, 1) for v in (all_ids, all_dist, all_done))
    order = np.lexsort((ids, dist), axis=1)
    return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)


def diverse(x: np.ndarray, ids: np.ndarray, vectors: np.ndarray, width: int) -> np.ndarray:
    """Of candidates sorted by distance, those nearer to the node than to any kept one; rest of the width by distance."""
    n, m = ids.shape
    own = _distance(x, vectors, ids)
    picked = vectors[np.maximum(ids, 0)]
    square = np.einsum("ijk,ijk->ij", picked, picked)
    between = square[:, :, None] + square[:, None, :] - 2 * picked @ picked.transpose(0, 2, 1)
    keep = np.zeros((n, m), bool)
    for j in range(m):
        nearest = np.where(keep, between[:, :, j], np.inf).min(axis=1)
        keep[:, j] = (ids[:, j] >= 0) & (own[:, j] < nearest) & (keep.sum(axis=1) < width)
    # Kept ones first, then the passed-over by distance: the graph stays well connected.
    order = np.argsort(np.where(ids < 0, 2, np.where(keep, 0, 1)) * np.int64(m) + np.arange(m), axis=1)[:, :width]
    return np.take_along_axis(ids, order, 1)


def build(vectors: np.ndarray, links: int = LINKS, beam: int = BEAM_BUILD, seed: int = 11) -> list[np.ndarray]:
    """Neighbour arrays by level, lowest first; nodes not on a level have none there.

    Rows are taken in random order, so node levels follow from their place: each level
    holds the first ``1 / links`` of the level below.
    """
    n = len(vectors)
    sizes = [n]
    while sizes[-1] > 4 * links:
        sizes.append(-(-sizes[-1] // links))
    levels = [np.full((size, links * 2 if i == 0 else links), -1, np.int32) for i, size in enumerate(sizes)]
    at = 1
    while at < n:
        stop = min(n, at + max(1, min(at, 256)))
        x = vectors[at:stop]
        entry = np.zeros((len(x), 1), np.int32)
        for level in range(len(levels) - 1, -1, -1):
            size, graph = sizes[level], levels[level]
            known = min(at, size)
            joins = max(0, min(stop, size) - at)
            width = beam if joins else 1
            ids, dist = beam_search(x, vectors[:known], graph, entry, max(width, entry.shape[1]))
            if joins:
                new = np.arange(at, at + joins, dtype=np.int32)
                # Those that arrive together see each other too.
                own = x[:joins]
                among = np.tile(new, (joins, 1))
                apart = _distance(own, vectors, among)
                apart[np.arange(joins), np.arange(joins)] = np.inf
                near = np.argsort(apart, axis=1)[:, : min(joins, beam // 4)]
                cand = np.concatenate([ids[:joins], np.take_along_axis(among, near, 1)], axis=1)
                cdist = np.concatenate([dist[:joins], np.take_along_axis(apart, near, 1)], axis=1)
                cand = np.where(np.isinf(cdist), -1, cand)
                cand = np.take_along_axis(cand, np.argsort(cdist, axis=1, kind="stable"), 1)
                chosen = diverse(own, cand, vectors, min(links, graph.shape[1]))
                graph[new, : chosen.shape[1]] = chosen
                _link_back(graph, vectors, new, chosen)
            entry = ids[:, : 1 if level else beam]
            entry = np.where(entry < 0, entry[:, :1], entry)[:, :1]
        at = stop
    return levels


def _link_back(graph: np.ndarray, vectors: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Add the new nodes to their neighbours' lists; a full list chooses anew."""
    to, frm = chosen.ravel(), np.repeat(new, chosen.shape[1])
    frm, to = frm[to >= 0], to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, frm = to[order], frm[order]
    nodes, first, count = np.unique(to, return_index=True, return_counts=True)
    width = graph.shape[1]
    most = int(count.max()) if len(count) else 0
    for low in range(0, len(nodes), 512):
        part = slice(low, low + 512)
        extra = np.full((len(nodes[part]), most), -1, np.int32)
        for i, (f, c) in enumerate(zip(first[part], count[part])):
            extra[i, :c] = frm[f : f + c]
        held = np.concatenate([graph[nodes[part]], extra], axis=1)
        held = np.where((held[:, :, None] == held[:, None, :]) & np.tri(held.shape[1], k=-1, dtype=bool)[None] & (held[:, :, None] >= 0), -2, held[:, :, None]).min(axis=2)
        held = np.where(held < 0, -1, held)
        own = vectors[nodes[part]]
        held = np.take_along_axis(held, np.argsort(_distance(own, vectors, held), axis=1, kind="stable"), 1)
        full = (held >= 0).sum(axis=1) > width
        out = held[:, :width].copy()
        if full.any():
            out[full] = diverse(own[full], held[full], vectors, width)
        graph[nodes[part]] = out


def search(x: np.ndarray, vectors: np.ndarray, levels: list[np.ndarray], beam: int) -> np.ndarray:
    """Ids of the ``beam`` best nodes of each query, through the levels from the top."""
    entry = np.zeros((len(x), 1), np.int32)
    for graph in levels[:0:-1]:
        entry = beam_search(x, vectors[: len(graph)], graph, entry, 8)[0][:, :1]
    return beam_search(x, vectors, levels[0], entry, beam)[0]


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and every component finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


INDEX = "shard long, n int, ids array<array<long>>, vectors binary, levels array<binary>, dim int"


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS, copies: int = K + 1, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """One row per shard ``(shard, n, ids, vectors, levels, dim)``, and how many shards; every usable vector is in it.

    ``ids`` are, per node, the smallest ``copies`` ids that share its vector. Vectors of
    another dimension get shards of their own.
    """
    good = rows.select(F.col(vec_id).cast("long").alias("id"), F.transform(F.col(vector), lambda v: v.cast("double")).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    # The rank limit is applied before the shuffle as well, so a hot vector sends few rows.
    first = good.withColumn("rank", F.row_number().over(W.partitionBy("v").orderBy("id"))).filter(F.col("rank") <= copies)
    nodes = on_disk(first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    shards = max(1, -(-nodes.count() // shard_rows))
    draw = F.xxhash64(F.lit(17), F.col("ids")[0])
    dealt = nodes.select("ids", "v", draw.alias("draw"), F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).alias("slot"), F.size("v").alias("dim"))

    def one(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        part = part.sort_by("draw")
        dim = key[1].as_py()
        vectors = part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        levels = build(np.ascontiguousarray(vectors, np.float32))
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([len(vectors)], pa.int32()),
            "ids": pa.array([part.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.array([np.ascontiguousarray(vectors, np.float64).tobytes()], pa.binary()),
            "levels": pa.array([[g.tobytes() for g in levels]], pa.list_(pa.binary())), "dim": pa.array([dim], pa.int32()),
        })

    return dealt.groupBy("slot", "dim").applyInArrow(one, INDEX), shards


def _graphs(n: int, packed: list[bytes]) -> list[np.ndarray]:
    sizes = [n]
    while sizes[-1] > 4 * LINKS:
        sizes.append(-(-sizes[-1] // LINKS))
    return [np.frombuffer(b, np.int32).reshape(size, -1) for b, size in zip(packed, sizes)]


def nearest(rows: DataFrame, queries: DataFrame, k: int = K, beam: int = BEAM, shard_rows: int = SHARD_ROWS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each query, its own id aside.

    ``score`` is the Euclidean distance of the original vectors in double precision;
    ties go to the smaller id. Vectors that are null, empty, zero or hold a null or
    non-finite component take no part on either side, nor do rows without id. A query
    meets vectors of its own dimension only. Repeated rows count once. Fewer candidates
    than ``k`` are all returned; an empty table gives no rows.
    """
    graphs, shards = index(rows, shard_rows, k + 1, vec_id, vector)
    asked = queries.select(F.col(vec_id).cast("long").alias("query_id"), F.transform(F.col(vector), lambda v: v.cast("double")).alias("v")).filter(F.col("query_id").isNotNull() & usable(F.col("v"))).distinct()
    asked = asked.withColumn("dim", F.size("v"))
    blocks = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-asked.count() // BLOCK)))))
    blocks = blocks.groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "v")).alias("asked"))
    sent = blocks.select(F.col("dim").alias("d"), "asked", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("s"))
    pairs = graphs.join(sent, F.expr("shard = s AND dim = d"))
    pairs = pairs.select("n", "dim", "vectors", "levels", "ids", F.col("asked.query_id").alias("q"), F.flatten("asked.v").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n, dim, raw, packed, ids, q, x = (batch.column(i)[row] for i in range(7))
                dim = dim.as_py()
                exact = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, dim)
                q = q.values.to_numpy(zero_copy_only=False)
                x = x.values.to_numpy(zero_copy_only=False).reshape(-1, dim)
                found = search(x.astype(np.float32), exact.astype(np.float32), _graphs(n.as_py(), packed.as_py()), max(beam, 2 * k))
                gap = exact[np.maximum(found, 0)] - x[:, None, :]
                far = np.where(found < 0, np.inf, np.sqrt((gap * gap).sum(axis=2)))
                order = np.argsort(far, axis=1, kind="stable")[:, : k + 1 + 8]
                out_q, out_id, out_s = [], [], []
                names = ids.as_py()
                for i, line in enumerate(order):
                    best = sorted((far[i, j], v) for j in line if np.isfinite(far[i, j]) for v in names[found[i, j]] if v != q[i])[:k]
                    out_q += [q[i]] * len(best)
                    out_id += [v for _, v in best]
                    out_s += [s for s, _ in best]
                yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_id, pa.int64()), pa.array(out_s, pa.float64())], names=["query_id", "vec_id", "score"])

    hits = pairs.mapInArrow(run, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.filter(F.col("vec_id") % 100 == 0))


def register(queries: dict, oracles: dict) -> None:
    queries["op1_nearest"] = op1_nearest
