"""Numeric helpers: rounding as JavaScript does it, and distribution summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def js_round(c, digits: int = 2) -> Column:
    """Half-up rounding on binary doubles, ``floor(x * 10^d + 0.5) / 10^d``; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    k = float(10**digits)
    return F.floor(c.cast("double") * k + F.lit(0.5)) / F.lit(k)


def summary(c: str, digits: int = 2, deviation: bool = False) -> list[Column]:
    """n, mean, p10, p25, p50, p75, p90, min, max of a column: exact type-7 quantiles, nulls left out.

    The column holds values of two decimals; the mean is taken over whole
    hundredths, so it doesn't depend on the order of the additions.
    """
    whole = F.sum(F.floor(F.col(c) * 100 + 0.5)) / F.count(c) / float(10 ** (2 - digits))
    out = [F.count(c).alias("n"), (F.floor(whole + 0.5) / float(10**digits)).alias("mean")]
    at = (10, 25, 50, 75, 90)
    every = F.percentile(c, F.array(*[F.lit(p / 100) for p in at]))  # one sorted map of the values serves all
    out += [js_round(every[i], digits).alias(f"p{p}") for i, p in enumerate(at)]
    out += [js_round(F.min(c), digits).alias("min"), js_round(F.max(c), digits).alias("max")]
    return out + ([js_round(F.stddev_samp(c), digits).alias("std_dev")] if deviation else [])


def percent(n: Column, of: Column) -> Column:
    """Whole percent, half up; null where the base is zero."""
    return F.when(of > 0, F.floor(100.0 * n / of + 0.5).cast("long"))
