"""Metric gates, verdicts and ordered routing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gate thresholds and the rule each metric follows.
THRESHOLDS = {
    "msssim": {"pass": 0.98, "fail": 0.96},
    "lpips": {"pass": 0.12, "fail": 0.20},
    "lap_ratio": {"fail": 1.0},
    "halo_pct": {"flag": 0.05},
    "band_delta": {"flag": 0.05},
}
RULES = {
    "msssim": "higher_better",
    "lpips": "lower_better",
    "lap_ratio": "floor",
    "halo_pct": "flag_over",
    "band_delta": "flag_over",
}
GRADE_DEFAULTS = {"T_subj": 0.26, "T_margin": 0.05, "T_aes": 0.45, "T_blur": 100.0}
GRADE4_DEFAULTS = {"T_weapon": 0.22, "T_wmargin": 0.03, "T_wblur": 150.0}
DETECT_CONF = 0.35
FAINT_CONF_MIN = 0.05
FAINT_MIN_W_FRAC = 0.05
CONF_AUTO = 0.5
AREA_MAX_PCT = 2.0
AREA_MAX_WM = 8.0
BOTTOM_BAND_FRAC = 0.80
OVERLAY_SCORE_MIN = 0.15
OUTSIDE_SSIM_MIN = 0.995
MAD_MAX = 1.0
CHANGE_SSIM_MAX = 0.90
SEAM_SSIM_MIN = 0.92
RESIDUE_KEEP = 0.45
RESIDUE_FLOOR = 4.0
VISION_GATES = ("vision-anat",)
BLOCKING_PREFIX = "anat_"

PASS, FLAG, FAIL = 0, 1, 2


def tri_rank(kind: str, value: Column, limits: dict[str, float]) -> Column:
    """0 pass, 1 flag, 2 fail for one metric; an absent value passes."""
    lo = {k: F.lit(float(v)) for k, v in limits.items()}
    if kind == "higher_better":
        ladder = F.when(value >= lo["pass"], PASS).when(value < lo["fail"], FAIL).otherwise(FLAG)
    elif kind == "lower_better":
        ladder = F.when(value <= lo["pass"], PASS).when(value > lo["fail"], FAIL).otherwise(FLAG)
    elif kind == "floor":
        ladder = F.when(value < lo["fail"], FAIL).otherwise(PASS)
    elif kind == "flag_over":
        ladder = F.when(value > lo["flag"], FLAG).otherwise(PASS)
    elif kind == "fail_over":
        ladder = F.when(value > lo["fail"], FAIL).otherwise(PASS)
    else:
        raise ValueError(f"unknown rule {kind}")
    return F.when(value.isNull(), PASS).otherwise(ladder)


def state_name(rank: Column) -> Column:
    return F.element_at(F.array(F.lit("PASS"), F.lit("FLAG"), F.lit("FAIL")), rank + 1)


def tri(kind: str, value: Column, limits: dict[str, float]) -> Column:
    return state_name(tri_rank(kind, value, limits))


def gate_verdict(metrics: dict[str, Column], thresholds=THRESHOLDS) -> Column:
    """Struct(verdict, reasons): the worst state wins, one ``metric:STATE`` per non-pass."""
    ranks = {m: tri_rank(RULES[m], metrics[m], thresholds[m]) for m in RULES if m in metrics and m in thresholds}
    worst = F.greatest(*ranks.values()) if len(ranks) > 1 else next(iter(ranks.values()))
    reasons = F.filter(
        F.array(*[F.when(r > PASS, F.concat(F.lit(f"{m}:"), state_name(r))) for m, r in ranks.items()]),
        lambda x: x.isNotNull(),
    )
    return F.struct(state_name(worst).alias("verdict"), reasons.alias("reasons"))


def gated_metrics(metrics: dict[str, Column], backend: Column) -> dict[str, Column]:
    """The metrics a backend is judged on: a pure downscale has no sharpness floor."""
    named = {"msssim" if k == "ms_ssim" else k: v for k, v in metrics.items()}
    if "lap_ratio" in named:
        named["lap_ratio"] = F.when(backend != "downscale-only", named["lap_ratio"])
    return named


def in_border_band(cx: Column, cy: Column, w: Column, h: Column, frac: float = 0.10) -> Column:
    bx, by = w * frac, h * frac
    return (cx <= bx) | (cx >= w - bx) | (cy <= by) | (cy >= h - by)


def is_faint(conf: Column, x0: Column, x1: Column, w: Column) -> Column:
    """A sub-floor box wide enough to be a credit line; never when the width is unknown."""
    return (w > 0) & (conf >= FAINT_CONF_MIN) & (conf < DETECT_CONF) & ((x1 - x0) / w >= FAINT_MIN_W_FRAC)


def route(n, conf, credit, keep, area, cx, cy, w, h, overlay, faint_n) -> Column:
    """Struct(verdict, reason): first matching rule wins, faint marks lift clean to qa."""

    def out(verdict, reason):
        return F.struct(F.lit(verdict).alias("verdict"), F.lit(reason).alias("reason"))

    ladder = (
        F.when((n > 0) & credit & (area <= AREA_MAX_WM), out("auto", "watermark_ocr"))
        .when(overlay >= OVERLAY_SCORE_MIN, out("qa", "centre_overlay"))
        .when((n <= 0) & (faint_n > 0), out("qa", "faint_mark"))
        .when(n <= 0, out("clean", "no_detections"))
        .when(keep & ~credit & (faint_n > 0), out("qa", "faint_mark"))
        .when(keep & ~credit, out("clean", "lol_logo"))
        .when((cy > BOTTOM_BAND_FRAC * h) & (conf >= CONF_AUTO) & (area <= AREA_MAX_WM), out("auto", "bottom_banner"))
        .when(in_border_band(cx, cy, w, h) & (conf >= CONF_AUTO) & (area <= AREA_MAX_PCT), out("auto", "corner_mark"))
        .when(area > AREA_MAX_WM, out("qa", "area_too_large"))
        .when(conf < CONF_AUTO, out("qa", "low_conf"))
        .otherwise(out("qa", "not_border"))
    )
    return ladder


def residue(before: Column, after: Column) -> Column:
    """Energy that stayed: judged on the drop, with a floor on both sides."""
    return (before >= RESIDUE_FLOOR) & (after > RESIDUE_KEEP * before) & (after >= RESIDUE_FLOOR)


def verify(outside, mad, change, text_left, seam) -> Column:
    """Struct(verdict, detail) after an edit: discard, fail, or pass with a seam flag."""
    broken = F.concat_ws(
        ";", F.when(outside < OUTSIDE_SSIM_MIN, "outside_ssim"), F.when(mad > MAD_MAX, "mad_outside")
    )

    def out(verdict, detail):
        return F.struct(F.lit(verdict).alias("verdict"), detail.alias("detail"))

    return (
        F.when((outside < OUTSIDE_SSIM_MIN) | (mad > MAD_MAX), out("discard", broken))
        .when(change > CHANGE_SSIM_MAX, out("fail", F.lit("no_op")))
        .when(text_left, out("fail", F.lit("text_residue")))
        .otherwise(out("pass", F.when(seam < SEAM_SSIM_MIN, "seam").otherwise("")))
    )


def grade(subject, off, aesthetic, blur, th: dict[str, Column]) -> Column:
    """Struct(verdict, reason, stage_a, stage_b): the second stage only runs after the first."""
    margin = subject - off

    def out(verdict, reason, a, b):
        return F.struct(
            F.lit(verdict).alias("verdict"),
            F.lit(reason).cast("string").alias("reason"),
            F.lit(a).alias("stage_a"),
            F.lit(b).cast("boolean").alias("stage_b"),
        )

    return (
        F.when((subject < th["T_subj"]) | (subject <= off), out("REJECT", "wrong_subject", False, None))
        .when(margin < th["T_margin"], out("REJECT", "weak_margin", False, None))
        .when(aesthetic < th["T_aes"], out("REJECT", "degenerate", True, False))
        .when(blur < th["T_blur"], out("REJECT", "blurry", True, False))
        .otherwise(out("PASS", None, True, True))
    )


def grade4(weapon, off, blur, th=GRADE4_DEFAULTS) -> Column:
    """Struct(verdict, reason) for the crop gate: off-class, weak margin, mush."""

    def out(verdict, reason):
        return F.struct(F.lit(verdict).alias("verdict"), F.lit(reason).cast("string").alias("reason"))

    return (
        F.when((weapon < th["T_weapon"]) | (weapon <= off), out("REJECT", "weapon_offclass"))
        .when(weapon - off < th["T_wmargin"], out("REJECT", "weapon_weak_margin"))
        .when(blur < th["T_wblur"], out("REJECT", "weapon_mush"))
        .otherwise(out("PASS", None))
    )


def blocking_flags(reasons: Column, prefix: str = BLOCKING_PREFIX) -> Column:
    return F.array_sort(F.array_distinct(F.filter(reasons, lambda r: r.startswith(prefix))))


def clamp(gate: Column, verdict: Column) -> Column:
    """Struct(verdict, clamped_from): a vision gate may flag but never fail."""
    hit = gate.isin(*VISION_GATES) & verdict.isin("REJECT", "FAIL")
    return F.struct(
        F.when(hit, "FLAG").otherwise(verdict).alias("verdict"), F.when(hit, verdict).alias("clamped_from")
    )


def approval(verdict: Column, reasons: Column, actor: Column) -> Column:
    """Struct(gate_check, override, blocking, refused) for a promotion."""
    clean = (verdict == "PASS") & (F.size(reasons) == 0)
    blocking = blocking_flags(F.coalesce(reasons, F.array().cast("array<string>")))
    none = verdict.isNull()
    return F.struct(
        F.when(none, "no_audit").when(clean, "pass").otherwise("override").alias("gate_check"),
        F.when(none, False).otherwise(~clean).alias("override"),
        F.when(none, "").otherwise(F.array_join(blocking, ";")).alias("blocking"),
        (~none & (actor != "operator") & (F.size(blocking) > 0)).alias("refused"),
    )


def dispose(verdict: Column, pass_failed: Column, has_commands: Column, first_rc: Column) -> Column:
    """Resting place of an asset: the first failing step decides."""
    steps = F.when(first_rc == 3, "refused").when(first_rc != 0, "failed").otherwise("done")
    return (
        F.when((verdict != "clean") & pass_failed, "error")
        .when(verdict == "qa", "queued-qa")
        .when(verdict == "clean", steps)
        .when(~has_commands, "queued-qa")
        .otherwise(steps)
    )


def band_distance(level: Column, ratio: Column, offset: float = 24.3, target: float = 0.83) -> Column:
    """Weighted distance from the corpus; unmeasured is infinitely far."""
    d = F.abs(level - offset) + 30.0 * F.abs(ratio - target)
    return F.coalesce(d, F.lit(float("inf")))


def triage_band(x: Column, p90: Column, p95: Column) -> Column:
    m = F.abs(x)
    return F.when(m >= p95, "ABOVE_P95").when(m >= p90, "ABOVE_P90").otherwise("TYPICAL")
