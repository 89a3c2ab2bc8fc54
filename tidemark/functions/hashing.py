"""Columns over 64-bit perceptual hashes and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(a: Column | str, b: Column | str) -> Column:
    """Number of differing bits."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.bit_count(a.bitwiseXOR(b))


def sign_hash(bits: Column, width: int) -> Column:
    """Pack an array of booleans into one long, element i as bit i."""
    return F.aggregate(
        F.transform(bits, lambda b, i: F.when(b, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"),
        lambda acc, x: acc.bitwiseOR(x),
    )


def sha_match(a: Column, b: Column, floor: int = 6) -> Column:
    """Two abbreviations of one content hash: equal on the shorter width."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    width = F.least(F.length(x), F.length(y))
    return F.coalesce((width >= floor) & (F.substring(x, F.lit(1), width) == F.substring(y, F.lit(1), width)), F.lit(False))
