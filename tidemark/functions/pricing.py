"""Spend of token usage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price per million tokens (input, output, cache write, cache read).
RATES = {
    "opus": (15.0, 75.0, 18.75, 1.5),
    "sonnet": (3.0, 15.0, 3.75, 0.3),
    "haiku": (1.0, 5.0, 1.25, 0.1),
    "default": (15.0, 75.0, 18.75, 1.5),
}


def token_price(model: Column, inp: Column, out: Column, cache_write: Column, cache_read: Column) -> Column:
    """Price of one usage row; an unknown model pays the default rate."""
    name = F.lower(F.coalesce(model, F.lit("")))
    usage = [inp, out, cache_write, cache_read]

    def cost(rates):
        total = None
        for used, rate in zip(usage, rates):
            part = F.coalesce(used, F.lit(0)) * F.lit(rate)
            total = part if total is None else total + part
        return total / 1_000_000

    ladder = None
    for key in ("opus", "sonnet", "haiku"):
        hit = name.contains(key)
        ladder = F.when(hit, cost(RATES[key])) if ladder is None else ladder.when(hit, cost(RATES[key]))
    return ladder.otherwise(cost(RATES["default"]))
