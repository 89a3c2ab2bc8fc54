"""Stamps and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(text: Column, naive: str = "refuse") -> Column:
    """Epoch seconds of an ISO stamp; null on junk. ``naive``: refuse or utc."""
    s = F.regexp_replace(F.trim(text), "[Zz]$", "+00:00")
    shaped = s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([+-]\d{2}:\d{2})?)?$")
    zoned = s.rlike(r"[+-]\d{2}:\d{2}$") & s.rlike(r"[T ]\d{2}:\d{2}")
    ok = shaped & zoned if naive == "refuse" else shaped
    full = F.when(zoned, s).otherwise(F.concat(s, F.lit("+00:00")))
    full = F.when(F.length(s) == 10, F.concat(s, F.lit("T00:00:00+00:00"))).otherwise(full)
    return F.when(ok, F.unix_micros(full.try_cast("timestamp")) / 1_000_000)


def age_s(now: Column, epoch: Column) -> Column:
    """Seconds since; a future stamp is clock skew and reads as zero."""
    return F.when(epoch.isNotNull(), F.greatest(F.lit(0.0), now - epoch))


def human_age(seconds: Column) -> Column:
    s = F.greatest(F.lit(0.0), seconds)

    def unit(n, suffix):
        return F.concat(F.floor(s / n).cast("string"), F.lit(suffix))

    return (
        F.when(seconds.isNull(), "-")
        .when(s < 90, unit(1, "s"))
        .when(s < 5400, unit(60, "m"))
        .when(s < 172800, unit(3600, "h"))
        .otherwise(unit(86400, "d"))
    )
