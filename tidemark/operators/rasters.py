"""Rasters as one array per asset: every metric stays in its row, without a shuffle.

Windows over a frame are array operations on all frames of an Arrow batch at once; sums and
extrema run along rows and then along columns. Only the median template looks across
assets; it groups by cell.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quantiles import exact_percentiles

# Kernel weights, windows and limits of the metrics.
LAPLACIAN = {(-1, 0): 1.0, (0, -1): 1.0, (0, 0): -4.0, (0, 1): 1.0, (1, 0): 1.0}
SOBEL_X = {(-1, -1): -1.0, (-1, 1): 1.0, (0, -1): -2.0, (0, 1): 2.0, (1, -1): -1.0, (1, 1): 1.0}
SOBEL_Y = {(-1, -1): -1.0, (-1, 0): -2.0, (-1, 1): -1.0, (1, -1): 1.0, (1, 0): 2.0, (1, 1): 1.0}
HALO_T = 8.0
SMOOTH_VAR = 4.0
FLAT = 1e-9
CLIP_LEVELS = 8.0
HP_WIN = 9
SUPPORT_PCT = 0.98


def let(expr: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``expr`` once per row and use it many times in ``body``."""
    return F.transform(F.array(expr), body)[0]


def _clamped(i: Column, w: int, h: int, dy: int, dx: int) -> Column:
    y = F.greatest(F.lit(0), F.least(F.lit(h - 1), F.floor(i / w).cast("int") + dy))
    x = F.greatest(F.lit(0), F.least(F.lit(w - 1), (i % w) + dx))
    return (y * w + x + 1).cast("int")


def _window(p: Column, w: int, h: int, r: int, fold) -> Column:
    """Square window of radius r; replicated edges add no new values to max or min."""
    offsets = [(dy, dx) for dy in range(-r, r + 1) for dx in range(-r, r + 1)]
    return F.transform(p, lambda _, i: fold(F.array(*[F.element_at(p, _clamped(i, w, h, dy, dx)) for dy, dx in offsets])))


def _box(p: Column, w: int, h: int, r: int, fold) -> Column:
    """As ``_window`` for folds that may run along rows first and columns after."""
    across = F.transform(p, lambda _, i: fold(F.array(*[F.element_at(p, _clamped(i, w, h, 0, d)) for d in range(-r, r + 1)])))
    return let(
        across,
        lambda a: F.transform(a, lambda _, i: fold(F.array(*[F.element_at(a, _clamped(i, w, h, d, 0)) for d in range(-r, r + 1)]))),
    )


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def _mean(a: Column) -> Column:
    return _sum(a) / F.size(a)


def _count(a: Column) -> Column:
    return F.size(F.filter(a, lambda x: x))


def _frames(pixels: pd.Series, w: int, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a whole frame, and those frames as one array (rows, h, w)."""
    whole = np.array([p is not None and len(p) == w * h for p in pixels], bool)
    some = [np.asarray(p, float) for p, use in zip(pixels, whole) if use]
    return whole, np.stack(some).reshape(-1, h, w) if some else np.zeros((0, h, w))


def _moved(a: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """Each cell's neighbour at an offset; beyond the frame its edge goes on."""
    h, w = a.shape[1:]
    return a[:, np.clip(np.arange(h) + dy, 0, h - 1)][:, :, np.clip(np.arange(w) + dx, 0, w - 1)]


def _around(a: np.ndarray, r: int, fold: np.ufunc) -> np.ndarray:
    """Fold over the square of radius ``r`` about each cell, along rows and then along columns."""
    for axis in (2, 1):
        a = functools.reduce(fold, [_moved(a, *((0, d) if axis == 2 else (d, 0))) for d in range(-r, r + 1)])
    return a


def _kernel(a: np.ndarray, weights: dict) -> np.ndarray:
    return sum(c * _moved(a, dy, dx) for (dy, dx), c in weights.items())


def _scattered(whole: np.ndarray, values: np.ndarray) -> pd.Series:
    """Values of the rows that hold a frame; null elsewhere."""
    out = np.full(len(whole), np.nan)
    out[whole] = values
    return pd.Series(out).where(whole, None)


def laplacian_var(p: Column, w: int, h: int) -> Column:
    """Population variance of the 4-neighbour Laplacian."""

    @F.pandas_udf(T.DoubleType())
    def var(pixels: pd.Series) -> pd.Series:
        whole, a = _frames(pixels, w, h)
        return _scattered(whole, _kernel(a, LAPLACIAN).var(axis=(1, 2)))

    return var(p)


def laplacian_ratio(src: Column, out: Column, w: int, h: int) -> Column:
    """Output over source; a flat source reads as infinitely sharpened, or as unchanged."""
    s, o = laplacian_var(src, w, h), laplacian_var(out, w, h)
    return F.when(s == 0, F.when(o > 0, float("inf")).otherwise(1.0)).otherwise(o / s)


def mad_outside(a: Column, b: Column, mask: Column) -> Column:
    """Mean absolute difference over the cells outside a mask; 0 when nothing is outside."""
    d = F.filter(
        F.transform(F.arrays_zip(a.alias("a"), b.alias("b"), mask.alias("m")), lambda z: F.when(~z["m"], F.abs(z["a"] - z["b"]))), lambda x: x.isNotNull()
    )
    return let(d, lambda v: F.when(F.size(v) == 0, 0.0).otherwise(_mean(v)))


def halo_pct(src: Column, out: Column, w: int, h: int, pct: float = 0.95, limit: float = HALO_T, r: int = 2) -> Column:
    """Share of near-edge cells outside the source's local range by more than ``limit``; 4 places."""

    @F.pandas_udf(T.DoubleType())
    def ringing(source: pd.Series, output: pd.Series) -> pd.Series:
        whole = _frames(source, w, h)[0] & _frames(output, w, h)[0]
        s, o = (_frames(x[whole], w, h)[1] for x in (source, output))
        if not len(s):
            return _scattered(whole, np.zeros(0))
        grad = np.hypot(_kernel(s, SOBEL_X), _kernel(s, SOBEL_Y))
        order = np.sort(grad.reshape(len(s), w * h), axis=1)
        rank = pct * (w * h - 1)
        low, high = (order[:, min(int(rank) + k, w * h - 1)] for k in (0, 1))
        edge = np.maximum(low + (high - low) * (rank - int(rank)), 1e-6)
        near = _around(grad >= edge[:, None, None], r, np.logical_or)
        rings = near & ((o > _around(s, r, np.maximum) + limit) | (o < _around(s, r, np.minimum) - limit))
        n = near.sum(axis=(1, 2))
        return _scattered(whole, np.where(n == 0, 0.0, rings.sum(axis=(1, 2)) / np.maximum(n, 1)))

    return F.round(ringing(src, out), 4)


def _band_density(p: Column, w: int, h: int) -> Column:
    def density(a):
        def local_var(win):
            return let(win, lambda x: let(_mean(x), lambda m: F.greatest(F.lit(0.0), _mean(F.transform(x, lambda v: v * v)) - m * m)))

        smooth = F.transform(_window(a, w, h, 1, local_var), lambda v: v < SMOOTH_VAR)
        right = F.transform(a, lambda v, i: F.abs(F.element_at(a, _clamped(i, w, h, 0, 1)) - v))
        down = F.transform(a, lambda v, i: F.abs(F.element_at(a, _clamped(i, w, h, 1, 0)) - v))

        def plateau(d, along_x):
            def neighbour(i, step):
                y, x = F.floor(i / w).cast("int"), (i % w).cast("int")
                if along_x:
                    return F.element_at(d, (y * w + F.pmod(x + step, F.lit(w)) + 1).cast("int"))
                return F.element_at(d, (F.pmod(y + step, F.lit(h)) * w + x + 1).cast("int"))

            return F.transform(d, lambda v, i: (v > FLAT) & (neighbour(i, -1) <= FLAT) & (neighbour(i, 1) <= FLAT))

        px = let(right, lambda d: plateau(d, True))
        py = let(down, lambda d: plateau(d, False))

        def share(s):
            near = _box(s, w, h, 1, lambda x: F.exists(x, lambda v: v))
            hit = F.transform(F.arrays_zip(px.alias("a"), py.alias("b"), near.alias("n")), lambda z: (z["a"] | z["b"]) & z["n"])
            return F.when(_count(s) == 0, 0.0).otherwise(_count(hit) / _count(s))

        return let(smooth, share)

    return let(p, density)


def banding_delta(src: Column, out: Column, w: int, h: int) -> Column:
    """Plateau-edge density in smooth zones, output minus source."""
    return _band_density(out, w, h) - _band_density(src, w, h)


def highpass(p: Column, w: int, h: int, win: int = HP_WIN) -> Column:
    """Value minus its local mean, edges replicated."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def centred(pixels: pd.Series) -> pd.Series:
        whole, a = _frames(pixels, w, h)
        rest = (a - _around(a, win // 2, np.add) / (win * win)).reshape(len(a), w * h)
        some = iter(rest)
        return pd.Series([next(some) if use else None for use in whole], dtype=object)

    return centred(p)


def density_keep(mark: Column, w: int, h: int, win: int, least: int) -> Column:
    """Marked cells with at least ``least`` marked cells in their window; outside the frame nothing is marked."""
    r = (max(win | 1, 3)) // 2

    def keep(m):
        def cell(v, i):
            y, x = F.floor(i / w).cast("int"), (i % w).cast("int")
            rows = F.sequence(F.greatest(F.lit(0), y - r), F.least(F.lit(h - 1), y + r))
            width = F.least(F.lit(w - 1), x + r) - F.greatest(F.lit(0), x - r) + 1
            n = F.aggregate(
                rows, F.lit(0), lambda acc, yy: acc + F.size(F.filter(F.slice(m, yy * w + F.greatest(F.lit(0), x - r) + 1, width), lambda b: b))
            )
            return v & (n >= least)

        return F.transform(m, cell)

    return let(mark, keep)


def median_template(df: DataFrame, pixels: str) -> DataFrame:
    """Median of every cell over all rasters, and whether it belongs to the support: (i, med, support)."""
    cells = df.select(F.posexplode(pixels).alias("i", "v"))
    med = exact_percentiles(cells, ["i"], "v", {"med": 0.5})
    # one row per cell of a single frame from here on
    cut = med.agg(F.percentile(F.abs("med"), F.lit(SUPPORT_PCT)).alias("cut"))
    return med.join(cut).select("i", "med", (F.abs("med") >= F.greatest("cut", F.lit(1e-9))).alias("support"))


def template_scores(df: DataFrame, key: str, pixels: str, template: DataFrame, w: int, h: int, shift: int = 0) -> DataFrame:
    """Best masked correlation with the template over whole-cell shifts: (key, score, dy, dx).

    Frames stay whole: one array product per shift scores all frames of a batch. The template,
    the cells of one frame, travels with the tasks. Rows without a whole frame have no score.
    """
    cells = template.select("i", "med", "support").collect()  # one frame
    med, mask = np.zeros(w * h), np.zeros(w * h)
    for c in cells:
        med[c.i], mask[c.i] = c.med, float(c.support)
    grid = [(dy, dx) for dy in range(-shift, shift + 1) for dx in range(-shift, shift + 1)]
    # equal scores go to the smallest shift
    grid.sort(key=lambda s: (abs(s[0]) + abs(s[1]), s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, st, stt = mask.sum(), (med * mask).sum(), (med * med * mask).sum()
        for batch in batches:
            whole, x = _frames(batch.column(1).to_pandas(), w, h)
            x = np.clip(x, -CLIP_LEVELS, CLIP_LEVELS)
            score, at = np.full(len(x), -np.inf), np.zeros((len(x), 2), np.int32)
            for dy, dx in grid:
                v = np.roll(x, (-dy, -dx), axis=(1, 2)).reshape(len(x), w * h)
                s1, s2, sxt = v @ mask, (v * v) @ mask, v @ (med * mask)
                with np.errstate(all="ignore"):
                    ncc = (sxt - s1 * st / n) / np.sqrt(np.maximum(s2 - s1 * s1 / n, 1e-9) * max(stt - st * st / n, 1e-9)) if n > 0 else np.zeros(len(x))
                ncc = np.where(np.abs(v).max(axis=1, initial=0.0) <= 1e-9, 0.0, ncc)
                better = ncc > score
                score[better], at[better] = ncc[better], (dy, dx)
            shifts = [pd.Series(0, index=range(len(whole)), dtype="int32") for _ in range(2)]
            for k in range(2):
                shifts[k][whole] = at[:, k]
            columns = [batch.column(0), pa.array(_scattered(whole, score), pa.float64(), from_pandas=True), *[pa.array(s, pa.int32()) for s in shifts]]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "score", "dy", "dx"])

    schema = T.StructType([df.schema[key], T.StructField("score", T.DoubleType()), T.StructField("dy", T.IntegerType()), T.StructField("dx", T.IntegerType())])
    return df.select(key, pixels).mapInArrow(run, schema)
