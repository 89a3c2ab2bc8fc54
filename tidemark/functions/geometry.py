"""Frames, crops and boxes as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Target frame, tolerances and pads.
TARGET_ASPECT = 2560 / 1440
ASPECT_TOL = 0.02
AREA_LOSS_MAX = 0.08
MAX_COMMON_PIXELS = 3840 * 2160
DILATE_PX = 15
REGION_PAD = 24
SPINE_POINTS = ("left_shoulder", "right_shoulder", "left_hip", "right_hip")
HEAD_POINTS = ("nose", "left_ear", "right_ear")
MIN_CONF = 0.3
MIN_SHOULDER_SPINE_RATIO = 0.35


def _half_even(x: Column) -> Column:
    return F.bround(x, 0).cast("long")


def _sides(w: Column, h: Column):
    wide = w / h > TARGET_ASPECT
    tall = w / h < TARGET_ASPECT
    new_w = F.when(wide, F.least(_half_even(h * 16 / 9), w.cast("long"))).otherwise(w.cast("long"))
    new_h = F.when(tall, F.least(_half_even(w * 9 / 16), h.cast("long"))).otherwise(h.cast("long"))
    return wide, tall, new_w, new_h


def aspect_class(w: Column, h: Column) -> Column:
    """Struct(cls, left, top, right, bottom, area_loss) against the 16:9 target."""
    _, _, new_w, new_h = _sides(w, h)
    left, top = F.floor((w - new_w) / 2), F.floor((h - new_h) / 2)
    loss = 1.0 - (new_w * new_h) / (w * h)
    ok = F.abs(w / h - TARGET_ASPECT) <= ASPECT_TOL
    return F.struct(
        F.when(ok, "ok").when(loss <= AREA_LOSS_MAX, "crop_ok").otherwise("crop_heavy").alias("cls"),
        F.when(~ok, left).alias("left"),
        F.when(~ok, top).alias("top"),
        F.when(~ok, left + new_w).alias("right"),
        F.when(~ok, top + new_h).alias("bottom"),
        F.when(ok, 0.0).otherwise(loss).alias("area_loss"),
    )


def anchored_crop(w: Column, h: Column, sides: Column) -> Column:
    """Struct(left, top, right, bottom, error): loss only from the permitted sides."""
    wide, _, new_w, new_h = _sides(w, h)
    near = F.abs(w / h - TARGET_ASPECT) <= ASPECT_TOL
    has = {s: F.array_contains(sides, s) for s in ("left", "right", "top", "bottom")}
    unknown = F.size(F.array_except(sides, F.array(*[F.lit(s) for s in has]))) > 0
    error = (
        F.when(unknown, "unknown_side")
        .when(F.size(sides) == 0, "no_side")
        .when(near, None)
        .when(wide & ~has["left"] & ~has["right"], "needs_left_or_right")
        .when(~wide & ~has["top"] & ~has["bottom"], "needs_top_or_bottom")
    )
    cut_w, cut_h = w.cast("long") - new_w, h.cast("long") - new_h
    left = F.when(has["left"] & has["right"], F.floor(cut_w / 2)).when(has["left"], cut_w).otherwise(0)
    top = F.when(has["top"] & has["bottom"], F.floor(cut_h / 2)).when(has["top"], cut_h).otherwise(0)
    left = F.when(near | ~wide, 0).otherwise(left)
    top = F.when(near | wide, 0).otherwise(top)
    good = error.isNull()
    return F.struct(
        F.when(good, left).alias("left"),
        F.when(good, top).alias("top"),
        F.when(good, left + F.when(near, w.cast("long")).otherwise(new_w)).alias("right"),
        F.when(good, top + F.when(near, h.cast("long")).otherwise(new_h)).alias("bottom"),
        error.alias("error"),
    )


def common_scale(w: Column, h: Column, budget: int = MAX_COMMON_PIXELS) -> Column:
    """Struct(w, h, capped): shrink by area only when over the pixel budget."""
    pixels = w.cast("long") * h.cast("long")
    over = pixels > budget
    ratio = F.sqrt(F.lit(float(budget)) / pixels)

    def side(x):
        return F.when(over, F.greatest(F.lit(1).cast("long"), (x * ratio).cast("long"))).otherwise(x.cast("long"))

    return F.struct(side(w).alias("w"), side(h).alias("h"), over.alias("capped"))


def dilate_box(x0, y0, x1, y1, w, h, px: int = DILATE_PX) -> Column:
    """Box grown by ``px`` on every side, clamped to the frame, in whole pixels."""
    return F.struct(
        F.greatest(F.lit(0).cast("long"), F.floor(x0) - px).alias("x0"),
        F.greatest(F.lit(0).cast("long"), F.floor(y0) - px).alias("y0"),
        F.least(w.cast("long"), F.ceil(x1) + px).alias("x1"),
        F.least(h.cast("long"), F.ceil(y1) + px).alias("y1"),
    )


def pad_box(x0, y0, x1, y1, frac, w, h) -> Column:
    """Box padded by a share of its own size, clamped to the frame."""
    dx, dy = _half_even((x1 - x0) * frac), _half_even((y1 - y0) * frac)
    zero = F.lit(0).cast("long")
    return F.struct(
        F.greatest(zero, x0.cast("long") - dx).alias("x0"),
        F.greatest(zero, y0.cast("long") - dy).alias("y0"),
        F.least(w.cast("long"), x1.cast("long") + dx).alias("x1"),
        F.least(h.cast("long"), y1.cast("long") + dy).alias("y1"),
    )


def boxes_overlap(a: Column, b: Column) -> Column:
    """Shared area; a shared edge does not count."""
    return (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])


def region(x0, y0, x1, y1, w, h, pad: int = REGION_PAD) -> Column:
    """Padded, clamped envelope from already aggregated corner bounds; null when empty."""
    zero = F.lit(0).cast("long")
    left, top = F.greatest(zero, x0.cast("long") - pad), F.greatest(zero, y0.cast("long") - pad)
    right = F.least(w.cast("long"), x1.cast("long") + pad + 1)
    bottom = F.least(h.cast("long"), y1.cast("long") + pad + 1)
    box = F.struct(left.alias("x0"), top.alias("y0"), right.alias("x1"), bottom.alias("y1"))
    return F.when((right > left) & (bottom > top), box)


def low_conf_joints(kp: Column, names, floor: float = MIN_CONF) -> Column:
    """Names that are absent or under the confidence floor, in the given order."""
    return F.filter(
        F.array(*[F.lit(n) for n in names]),
        lambda n: F.coalesce(F.element_at(kp, n)["conf"] < floor, F.lit(True)),
    )


def _mid(kp, a, b, axis):
    return (kp[a][axis] + kp[b][axis]) / 2.0


def figure_geometry(kp: Column) -> Column:
    """Struct(shoulder, spine, ratio) of raw points, blind to confidence."""
    ls, rs = kp["left_shoulder"], kp["right_shoulder"]
    shoulder = F.hypot(rs["x"] - ls["x"], rs["y"] - ls["y"])
    ax = _mid(kp, "left_shoulder", "right_shoulder", "x") - _mid(kp, "left_hip", "right_hip", "x")
    ay = _mid(kp, "left_shoulder", "right_shoulder", "y") - _mid(kp, "left_hip", "right_hip", "y")
    spine = F.hypot(ax, ay)
    return F.struct(
        shoulder.alias("shoulder"), spine.alias("spine"), F.when(spine > 0, shoulder / spine).alias("ratio")
    )


def axis_offset(kp: Column, floor: float = MIN_CONF) -> Column:
    """Struct(reason, detail, offset, offset_norm): signed head distance from the spine line.

    The first refusal in order wins; an offset is null exactly when there is one.
    """
    first_bad = F.coalesce(
        *[F.when(F.coalesce(F.element_at(kp, F.lit(n))["conf"] < floor, F.lit(True)), F.lit(n)) for n in SPINE_POINTS]
    )
    absent = F.element_at(kp, first_bad).isNull()
    g = figure_geometry(kp)
    used = F.filter(
        F.array(*[F.element_at(kp, F.lit(n)) for n in HEAD_POINTS]), lambda p: p.isNotNull() & (p["conf"] >= floor)
    )

    def centre(axis):
        total = F.aggregate(used, F.lit(0.0), lambda acc, p: acc + p[axis])
        return total / F.size(used)

    reason = (
        F.when(first_bad.isNotNull() & absent, "spine_point_missing")
        .when(first_bad.isNotNull(), "spine_point_low_conf")
        .when(g["shoulder"] <= 0, "degenerate_shoulders")
        .when(g["spine"] <= 0, "degenerate_spine")
        .when(g["ratio"] < MIN_SHOULDER_SPINE_RATIO, "implausible_geometry")
        .when(F.size(used) == 0, "no_head_points")
    )
    hx, hy = _mid(kp, "left_hip", "right_hip", "x"), _mid(kp, "left_hip", "right_hip", "y")
    ax = _mid(kp, "left_shoulder", "right_shoulder", "x") - hx
    ay = _mid(kp, "left_shoulder", "right_shoulder", "y") - hy
    offset = (ax * (centre("y") - hy) - ay * (centre("x") - hx)) / g["spine"]
    good = reason.isNull()
    return F.struct(
        reason.alias("reason"),
        first_bad.alias("detail"),
        F.when(good, offset).alias("offset"),
        F.when(good, offset / g["shoulder"]).alias("offset_norm"),
    )
