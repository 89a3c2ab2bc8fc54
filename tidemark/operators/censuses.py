"""Censuses over a corpus: crossings, distributions, cross-tabs, precision, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import exact_percentiles, percentiles

# Regression tolerances, metric direction, band fallback.
EPSILON = {"msssim": 0.01, "lpips": 0.02, "halo_pct": 0.02}
LAP_REL = 0.05
HIGHER_IS_BETTER = ("ssim", "ms_ssim", "msssim")
BUILT_IN_LEVEL, BUILT_IN_RATIO = 24.3, 0.83
Z95 = 1.96


def crossings(df: DataFrame, variant: str, value: str, threshold: float) -> DataFrame:
    """Over, measured, max and min per variant; what is not a number is not measured."""
    v = F.col(value).try_cast("double")
    return df.groupBy(variant).agg(
        F.count_if(v > threshold).alias("over_line"), F.count(v).alias("measured"), F.max(v).alias("max"), F.min(v).alias("min")
    )


def fidelity_summary(df: DataFrame, variant: str, metrics: list[str]) -> DataFrame:
    """Long form: min, max and mean of each metric per variant, and which end is the worse."""
    long = df.select(variant, F.explode(F.create_map(*[x for m in metrics for x in (F.lit(m), F.col(m))])).alias("metric", "v")).filter("v is not null")
    worse = F.when(F.col("metric").isin(*HIGHER_IS_BETTER), "min").otherwise("max")
    return long.groupBy(variant, "metric").agg(
        F.count("*").alias("measured"), F.min("v").alias("min"), F.max("v").alias("max"), F.round(F.avg("v"), 6).alias("mean")
    ).withColumn("worse_is", worse)


def detector_census(df: DataFrame) -> DataFrame:
    return df.withColumn("false_positive", (F.col("label") == "needs_none") & (F.col("verdict") == "auto"))


def cross_tab(df: DataFrame, verdicts=("auto", "qa", "clean")) -> DataFrame:
    """Counts per label and verdict, one pass, fixed columns; ``other`` holds every verdict not named."""
    known = F.coalesce(F.col("verdict").isin(*verdicts), F.lit(False))
    return df.groupBy("label").agg(
        *[F.count_if(F.col("verdict") == v).alias(v) for v in verdicts], F.count_if(~known).alias("other"), F.count_if("false_positive").alias("false_positives")
    )


def precision_by(df: DataFrame, group: str, hit: Column, z: float = Z95) -> DataFrame:
    """Precision with its Wilson interval."""
    g = df.groupBy(group).agg(F.count("*").alias("n"), F.count_if(hit).alias("tp"))
    n, p = F.col("n"), F.col("tp") / F.col("n")
    mid = p + z * z / (2 * n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    return g.select(group, "n", "tp", p.alias("precision"), ((mid - half) / scale).alias("lo"), ((mid + half) / scale).alias("hi"))


def recall_by_stratum(reviewed: DataFrame, sizes: DataFrame, stratum: str, miss: Column) -> DataFrame:
    """Misses seen in the reviewed part of a stratum, extrapolated to its size."""
    g = reviewed.groupBy(stratum).agg(F.count("*").alias("reviewed"), F.count_if(miss).alias("misses"))
    j = sizes.join(g, stratum, "left").fillna(0, ["reviewed", "misses"])
    rate = F.when(F.col("reviewed") > 0, F.col("misses") / F.col("reviewed")).otherwise(0.0)
    return j.withColumns({"rate": rate, "estimated": rate * F.col("size")})


def regress(baseline: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """ok and reasons per case against frozen metrics; a missing candidate fails."""
    metrics = [*EPSILON, "lap_ratio"]
    c = candidates.select(key, *[F.col(m).alias(f"c_{m}") for m in metrics], F.lit(True).alias("_there"))
    j = baseline.join(c, key, "left")
    moved = [F.when(F.abs(F.col(f"c_{m}") - F.col(m)) > eps, m) for m, eps in EPSILON.items()]
    rel = F.abs(F.col("c_lap_ratio") - F.col("lap_ratio")) / F.col("lap_ratio")
    why = F.concat_ws(";", *moved, F.when((F.col("lap_ratio") != 0) & (rel > LAP_REL), "lap_ratio"))
    missing = F.col("_there").isNull()
    return j.select(key, (~missing & (why == "")).alias("ok"), F.when(missing, "missing candidate").otherwise(why).alias("reasons"))


def build_bands(df: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Median and band of level and ratio per key, plus a ``_default`` row over all keys."""
    wanted = {c: {f"{c}_median": 0.5, f"{c}_lo": low, f"{c}_hi": high} for c in ("level", "ratio")}
    marks = percentiles(df, ["key"], wanted, total=True).withColumn("_key", F.when(F.col("_all"), "_default").otherwise(F.col("key"))).drop("key", "_all")
    per = df.groupBy("key").agg(F.count("*").alias("n"))
    n = per.unionByName(per.agg(F.sum("n").alias("n")).filter("n IS NOT NULL").withColumn("key", F.lit("_default")))
    return n.join(marks, F.col("key").eqNullSafe(F.col("_key")), "left").drop("_key")


def band_for(requests: DataFrame, bands: DataFrame, min_n: int = 5) -> DataFrame:
    """A key's own band when it rests on enough rows, else the default, else the built-in."""
    own = bands.filter((F.col("key") != "_default") & (F.col("n") >= min_n)).select(
        "key", F.col("n").alias("_n"), F.col("level_median").alias("_l"), F.col("ratio_median").alias("_r")
    )
    # the default is one row; an empty table leaves the built-in values
    default = bands.filter("key = '_default'").agg(
        F.max("n").alias("_dn"), F.max("level_median").alias("_dl"), F.max("ratio_median").alias("_dr")
    )
    j = requests.join(own, "key", "left").join(default)
    source = (
        F.when(F.col("_n").isNotNull(), F.concat(F.lit("group:"), "key", F.lit(" (n="), F.col("_n").cast("string"), F.lit(")")))
        .when(F.col("_dn").isNotNull(), F.concat(F.lit("default (n="), F.col("_dn").cast("string"), F.lit(")")))
        .otherwise("built-in")
    )
    return j.withColumns(
        {
            "level_median": F.coalesce("_l", "_dl", F.lit(BUILT_IN_LEVEL)),
            "ratio_median": F.coalesce("_r", "_dr", F.lit(BUILT_IN_RATIO)),
            "band_source": source,
        }
    ).drop("_n", "_l", "_r", "_dn", "_dl", "_dr")


def retry_compare(versions: DataFrame) -> DataFrame:
    """Each later version against version 1 of its slug, summed per version."""
    good = versions.filter("not excluded")
    base = good.filter("version = 1").select("slug", F.col("seam").alias("b_seam"), F.col("change").alias("b_change"), F.col("edit_pct").alias("b_edit"))
    j = good.filter("version > 1").join(base, "slug")
    return j.groupBy("version").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("seam") > F.col("b_seam")).alias("better"),
        F.count_if(F.col("seam") < F.col("b_seam")).alias("worse"),
        F.count_if(F.col("seam") == F.col("b_seam")).alias("tie"),
        F.avg(F.when(F.col("b_edit") > 0, F.col("edit_pct") / F.col("b_edit"))).alias("area_ratio"),
        F.count_if(F.col("change") < F.col("b_change")).alias("moved_further"),
    )


def phrase_counts(blocks: DataFrame, group: Column, item: str, text: Column, patterns: dict[str, str]) -> DataFrame:
    """Per ``group``: hits of every pattern, the latest item (largest) that holds it, and the blocks read; one pass."""
    hits = {n: F.regexp_count(text, F.lit(p)) for n, p in patterns.items()}
    counts = [F.coalesce(F.sum(h), F.lit(0)).cast("long").alias(n) for n, h in hits.items()]
    last = [F.max(F.when(h > 0, F.col(item))).alias(f"latest_{n}") for n, h in hits.items()]
    return blocks.groupBy(group).agg(*counts, *last, F.max(item).alias("latest_item"), F.count("*").alias("blocks"))


def profile(df: DataFrame, value: str) -> DataFrame:
    """Exact distribution of one column in one row."""
    ps = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
    v = F.col(value)
    base = df.agg(F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stdev"))
    return base.join(exact_percentiles(df, [], value, ps))
