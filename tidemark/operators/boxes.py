"""Boxes per asset: envelopes, merged areas, centroids and coverage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions import geometry as geo


def envelope(df: DataFrame, key: str, w: Column, h: Column, pad: int = geo.REGION_PAD) -> DataFrame:
    """Padded, clamped envelope of all boxes of an asset."""
    g = df.groupBy(key).agg(*[f.alias(n) for n, f in (
        ("x0", F.min("x0")), ("y0", F.min("y0")), ("x1", F.max("x1")), ("y1", F.max("y1")))])
    return g.select(key, geo.region(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), w, h, pad).alias("r")).select(key, "r.*")


def centroid(df: DataFrame, key: str) -> DataFrame:
    """Area-weighted centre; a box without area weighs one."""
    area = F.greatest(F.lit(0.0), F.col("x1") - F.col("x0")) * F.greatest(F.lit(0.0), F.col("y1") - F.col("y0"))
    weight = F.when(area <= 0, 1.0).otherwise(area)
    return df.groupBy(key).agg(
        (F.sum(weight * (F.col("x0") + F.col("x1")) / 2.0) / F.sum(weight)).alias("cx"),
        (F.sum(weight * (F.col("y0") + F.col("y1")) / 2.0) / F.sum(weight)).alias("cy"),
    )


TILE = 64


def _tiles(df: DataFrame) -> DataFrame:
    """Each box once per tile it touches, so overlap is tested tile by tile."""
    xs = F.sequence(F.floor(F.col("x0") / TILE), F.floor(F.col("x1") / TILE))
    ys = F.sequence(F.floor(F.col("y0") / TILE), F.floor(F.col("y1") / TILE))
    return df.withColumn("tx", F.explode(xs)).withColumn("ty", F.explode(ys))


def faint_regions(boxes: DataFrame, key: str, w: Column, h: Column) -> DataFrame:
    """Region of the faint boxes, widened by every OCR box that overlaps one.

    ``boxes``: key, kind ('faint' | 'ocr'), x0..y1. An OCR box needs only one
    overlapping faint box: a semi join on tiles, which emits no pairs.
    """
    cols = ["x0", "y0", "x1", "y1"]
    faint = boxes.filter("kind = 'faint'").select(key, *cols).distinct()
    ocr = boxes.filter("kind = 'ocr'").select(key, *cols).distinct()
    f = _tiles(faint).select(key, "tx", "ty", *[F.col(c).alias(f"f{c}") for c in cols])
    o = _tiles(ocr)
    touch = [
        o[key] == f[key], o["tx"] == f["tx"], o["ty"] == f["ty"],
        o["x0"] < f["fx1"], f["fx0"] < o["x1"], o["y0"] < f["fy1"], f["fy0"] < o["y1"],
    ]
    owned = o.join(f, touch, "left_semi").select(key, *cols).distinct().withColumn("kind", F.lit("ocr"))
    both = faint.withColumn("kind", F.lit("faint")).unionByName(owned)
    g = both.groupBy(key).agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.count_if(F.col("kind") == "faint").alias("n_faint"), F.count_if(F.col("kind") == "ocr").alias("n_ocr"),
    ).filter("n_faint > 0")
    zero = F.lit(0).cast("long")
    return g.select(
        key,
        F.greatest(F.col("x0").cast("long"), zero).alias("x0"),
        F.greatest(F.col("y0").cast("long"), zero).alias("y0"),
        F.least(F.col("x1").cast("long"), w.cast("long")).alias("x1"),
        F.least(F.col("y1").cast("long"), h.cast("long")).alias("y1"),
        "n_faint",
        "n_ocr",
    )


def residual(boxes: DataFrame, regions: DataFrame, key: str) -> DataFrame:
    """Faint boxes that still overlap the cleaned region of their asset."""
    r = regions.select(key, F.struct("x0", "y0", "x1", "y1").alias("_r"))
    hit = geo.boxes_overlap(F.struct("x0", "y0", "x1", "y1"), F.col("_r"))
    return boxes.filter("kind = 'faint'").join(r, key).filter(hit).drop("_r")


AREA_TILE = 256
#: Grid cells that are folded at a time.
CELLS = 1 << 22


def union_area(df: DataFrame, key: str) -> DataFrame:
    """Pixels covered by at least one whole-pixel box; overlaps count once.

    A box is cut by the tiles it touches, and equal cuts are dropped before they move. In its
    tile a cut is four signed corner events; two running totals, across and down, turn them
    into the number of boxes over each cell. A tile has a fixed number of corners, so a task's
    memory is bounded however many boxes an asset has.
    """
    whole = df.select(key, *[F.col(c).cast("long").alias(c) for c in ("x0", "y0", "x1", "y1")]).filter("x1 > x0 and y1 > y0")
    for c, low, high in (("_tx", "x0", "x1"), ("_ty", "y0", "y1")):
        whole = whole.withColumn(c, F.explode(F.sequence(F.floor(F.col(low) / AREA_TILE), F.floor((F.col(high) - 1) / AREA_TILE))))
    inside = lambda c, t: F.least(F.greatest(F.col(c) - F.col(t) * AREA_TILE, F.lit(0)), F.lit(AREA_TILE))
    cuts = [inside(c, t).cast("int").alias(c) for c, t in (("x0", "_tx"), ("y0", "_ty"), ("x1", "_tx"), ("y1", "_ty"))]
    # Two hashes name a tile: 128 bits, so no two are taken for one.
    marks = F.xxhash64(key, "_tx", "_ty").alias("_g"), F.xxhash64(F.lit(1), "_ty", "_tx", key).alias("_h")
    cut = whole.select(key, *marks, *cuts).distinct()
    areas = cut.repartition("_g").sortWithinPartitions("_g", "_h").mapInArrow(_tile_areas, StructType([cut.schema[key], StructField("area", LongType())]))
    return areas.groupBy(key).agg(F.sum("area").alias("area"))


def _whole_groups(batches: Iterator[pa.RecordBatch], column: int, rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole groups: rows of one group have one value of the column and follow each other."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        g = table.column(column).to_numpy()
        ends = np.flatnonzero(g[1:] != g[:-1])
        if len(ends):
            yield table.slice(0, ends[-1] + 1)
            held = table.slice(ends[-1] + 1).to_batches()
            size = sum(b.num_rows for b in held)
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _ranks(group: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's rank among its group's distinct values; the distinct values group by group; how many each group has."""
    order = np.lexsort((values, group))
    g, v = group[order], values[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    place = np.cumsum(fresh) - 1
    sizes = np.bincount(g[fresh], minlength=group.max() + 1)
    rank = np.empty(len(v), np.int64)
    rank[order] = place - (np.cumsum(sizes) - sizes)[g]
    return rank, v[fresh], sizes


def covered_cells(group: np.ndarray, x: np.ndarray, y: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Area under the signed corner events of every group (numbered from 0).

    Grids of distinct edges lie one after the other. Every line of a grid sums to nothing, so
    one running total over all of them is the running total of each line.
    """
    ix, xs, nx = _ranks(group, x)
    iy, ys, ny = _ranks(group, y)
    size = nx * ny
    start, sx, sy = (np.cumsum(n) - n for n in (size, nx, ny))
    across = np.bincount(start[group] + iy * nx[group] + ix, weights=d, minlength=size.sum()).cumsum()
    g = np.repeat(np.arange(len(size)), size)
    cell = np.arange(size.sum()) - start[g]  # down the columns: cell = column * ny + row
    col, row = cell // ny[g], cell % ny[g]
    over = across[start[g] + row * nx[g] + col].cumsum()
    hit = over > 0.5
    g, col, row = g[hit], sx[g[hit]] + col[hit], sy[g[hit]] + row[hit]
    return np.bincount(g, weights=(xs[col + 1] - xs[col]) * (ys[row + 1] - ys[row]), minlength=len(size)).astype(np.int64)


def _tile_areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _whole_groups(batches, 1):
        g, h, x0, y0, x1, y1 = (table.column(c).to_numpy().astype(np.int64) for c in range(1, 7))
        first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])]))
        sizes = np.diff(np.append(first, len(g)))
        group = np.repeat(np.arange(len(first)), sizes)
        # No grid has more cells than the square of its edges, or than a tile has.
        load = np.cumsum(np.minimum(4 * sizes.astype(np.int64) ** 2, (AREA_TILE + 1) ** 2)) // CELLS
        area = np.zeros(len(first), np.int64)
        for part in np.unique(load):
            low = np.searchsorted(load, part)
            use = slice(first[low], np.append(first, len(g))[np.searchsorted(load, part, "right")])
            own = np.tile(group[use] - low, 4)
            d = np.repeat([1, -1, -1, 1], use.stop - use.start)
            some = covered_cells(own, np.concatenate([x0[use], x1[use], x0[use], x1[use]]), np.concatenate([y0[use], y0[use], y1[use], y1[use]]), d)
            area[low : low + len(some)] = some
        yield pa.RecordBatch.from_arrays([table.column(0).take(pa.array(first)).combine_chunks(), pa.array(area)], names=[table.column_names[0], "area"])


def dilated_area_pct(df: DataFrame, key: str, w: int, h: int, px: int = geo.DILATE_PX) -> DataFrame:
    """Share of the frame, in percent, under the dilated boxes of an asset."""
    d = geo.dilate_box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.lit(w), F.lit(h), px)
    grown = df.select(key, d.alias("d")).select(key, "d.*")
    share = union_area(grown, key).select(key, (F.col("area") / (w * h) * 100.0).alias("area_pct"))
    return df.select(key).distinct().join(share, key, "left").fillna(0.0, ["area_pct"])


def coverage(df: DataFrame, key: str, target: tuple[int, int, int, int]) -> DataFrame:
    """Covered share of one target box, 0 to 1; a target without area is never covered."""
    tx0, tx1 = sorted((target[0], target[2]))
    ty0, ty1 = sorted((target[1], target[3]))
    area = (tx1 - tx0) * (ty1 - ty0)
    if area <= 0:
        return df.select(key).distinct().withColumn("coverage", F.lit(0.0))
    cut = df.select(
        key,
        F.greatest(F.floor("x0"), F.lit(tx0)).alias("x0"),
        F.greatest(F.floor("y0"), F.lit(ty0)).alias("y0"),
        F.least(F.ceil("x1"), F.lit(tx1)).alias("x1"),
        F.least(F.ceil("y1"), F.lit(ty1)).alias("y1"),
    )
    share = union_area(cut, key).select(key, F.least(F.lit(1.0), F.col("area") / area).alias("coverage"))
    return df.select(key).distinct().join(share, key, "left").fillna(0.0, ["coverage"])


SALTS = 32
#: Pairs of boxes that are compared at a time.
PAIRS = 1 << 22


def merge_components(df: DataFrame, key: str) -> DataFrame:
    """Transitively overlapping boxes of an asset merged into their envelopes.

    Merging is order-free, so it runs as a combine tree: inside each input
    partition, then per (asset, salt), then per asset. What a step hands on for
    an asset is pairwise disjoint, so the frame bounds it, not the box count.
    Keys keep their own type; null is a key like any other.
    """
    cols = [F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")]
    # Boxes without area overlap nothing and would never merge; boxes with a missing edge are none.
    boxes = df.select(key, *cols).filter("x0 < x1 AND y0 < y1")
    schema = boxes.schema
    salt = F.pmod(F.xxhash64("x0", "y0", "x1", "y1"), F.lit(SALTS))
    for spread in (None, [F.col(key), salt], [F.col(key)]):
        if spread is not None:
            boxes = boxes.repartition(*spread)
        marked = boxes.select(key, F.xxhash64(key, F.col(key).isNull()).alias("_g"), "x0", "y0", "x1", "y1")
        boxes = marked.sortWithinPartitions(key).mapInArrow(_merged, schema)
    return boxes


def _split(group: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Groups cut where no box reaches from what lies lower to what lies higher."""
    order = np.lexsort((low, group))
    g, a, b = group[order], low[order], high[order]
    # A running maximum that starts anew in each group: ranks of the ends, lifted above those of earlier groups.
    ends, rank = np.unique(b, return_inverse=True)
    new = np.concatenate([[True], g[1:] != g[:-1]])
    lift = (np.cumsum(new) - 1) * np.int64(len(ends))
    reach = ends[np.maximum.accumulate(rank + lift) - lift]
    cut = new.copy()
    cut[1:] |= a[1:] >= reach[:-1]
    out = np.empty(len(g), np.int64)
    out[order] = np.cumsum(cut) - 1
    return out


def _linked(group: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Per box the least box of its group that it is linked to by overlaps; groups follow each other."""
    n = len(group)
    link = np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(first, n))
    begin, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    for part in np.split(np.arange(n), np.flatnonzero(np.diff(np.cumsum(size) // PAIRS)) + 1):
        i = np.repeat(part, size[part])
        ends = np.cumsum(size[part])
        j = begin[i] + np.arange(len(i)) - np.repeat(ends - size[part], size[part])
        a, b = box[i], box[j]
        hit = (a[:, 0] < b[:, 2]) & (b[:, 0] < a[:, 2]) & (a[:, 1] < b[:, 3]) & (b[:, 1] < a[:, 3])
        np.minimum.at(link, i[hit], j[hit])
    while (link[link] != link).any():
        link = link[link]
    return link


def envelopes(group: np.ndarray, box: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boxes (x0, y0, x1, y1) of each group merged until they are disjoint: the groups and the envelopes."""
    while True:
        part, parts = group, 0
        while True:  # what can be told apart by a straight cut never merges
            part = _split(_split(part, box[:, 0], box[:, 2]), box[:, 1], box[:, 3])
            if part.max(initial=-1) + 1 == parts:
                break
            parts = part.max(initial=-1) + 1
        order = np.argsort(part, kind="stable")
        group, box, part = group[order], box[order], part[order]
        link = _linked(part, box)
        some = np.argsort(link, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], link[some][1:] != link[some][:-1]])) if len(some) else some
        if len(first) == len(box):
            return group, box
        low, high = np.minimum.reduceat(box[some], first), np.maximum.reduceat(box[some], first)
        group, box = group[some][first], np.column_stack([low[:, :2], high[:, 2:]])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _whole_groups(batches, 1):
        g = table.column(1).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(g))))
        group, box = envelopes(group, np.column_stack([table.column(c).to_numpy() for c in range(2, 6)]))
        keys = table.column(0).take(pa.array(first[group])).combine_chunks()
        yield pa.RecordBatch.from_arrays([keys, *[pa.array(np.ascontiguousarray(box[:, c])) for c in range(4)]], names=[table.column_names[0], "x0", "y0", "x1", "y1"])
