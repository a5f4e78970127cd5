"""Cohort aggregates, privacy filters, bands, period series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.num import js_round, summary

#: Half-open bands; the last includes 100.
BANDS = (("0-20", 0, 20), ("20-40", 20, 40), ("40-60", 40, 60), ("60-80", 60, 80), ("80-100", 80, 101))

#: Periods of a series: 250 years of quarters.
MAX_PERIODS = 1000


def slices(df: DataFrame, key: str, value: str, k: int = 5, digits: int = 1) -> DataFrame:
    """Summary per key, groups under ``k`` and null or "unknown" keys left out."""
    return df.where(F.col(key).isNotNull() & ~F.col(key).isin("", "unknown")).groupBy(key).agg(*summary(value, digits, True)).where(F.col("n") >= k)


def axes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Summaries overall and along each axis by itself, in one pass of grouping sets."""
    g = df.groupingSets([[]] + [[k] for k in keys], *keys).agg(F.grouping_id().alias("_gid"), *summary(value))
    full = (1 << len(keys)) - 1
    axis, val = F.lit("overall"), F.lit("all")
    for i, k in enumerate(keys):
        at = F.col("_gid") == full - (1 << (len(keys) - 1 - i))
        axis, val = F.when(at, k).otherwise(axis), F.when(at, F.coalesce(F.col(k), F.lit("null"))).otherwise(val)
    return g.select(axis.alias("axis"), val.alias("value"), "n", "mean", "p10", "p25", "p50", "p75", "p90", "min", "max")


def bands(df: DataFrame, value: str) -> DataFrame:
    """(band, n, share): every band appears, empty ones with 0."""
    frame = df.sparkSession.createDataFrame([(b,) for b, _, _ in BANDS], "band string")
    label = F.coalesce(*[F.when((F.col(value) >= lo) & (F.col(value) < hi), b) for b, lo, hi in BANDS])
    n = df.where(F.col(value).isNotNull()).groupBy(label.alias("band")).agg(F.count("*").alias("n"))
    out = F.broadcast(frame).join(n, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # over the five bands
    return out.select("band", "n", F.when(total > 0, js_round(F.col("n") / total, 4)).alias("share"))


def k_filter(df: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """Rows of groups of at least ``k``; null keys count as one group. Counts are aggregated first, so large groups are no task of their own."""
    marked = [F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(f"_k{i}") for i, c in enumerate(keys)]
    rows = df.select("*", *marked)
    names = [f"_k{i}" for i in range(len(keys))]
    big = rows.groupBy(*names).count().where(F.col("count") >= k).select(*names)
    return rows.join(big, names, "left_semi").drop(*names)


def k_report(df: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """(keys, n, suppressed, reason) of every stratum."""
    low = F.col("n") < k
    return df.groupBy(*keys).agg(F.count("*").alias("n")).select(*keys, "n", low.alias("suppressed"), F.when(low, F.concat(F.lit("n<"), F.lit(str(k)))).alias("reason"))


def period_series(df: DataFrame, key: str, period: str, value: str, k: int = 5) -> DataFrame:
    """One row per key and period of the full grid: n, p75, the previous period's, the change, why it is withheld, how reliable it is.

    Reasons: category_absent_current or no_previous_period (nothing to compare
    with) alone; else current_sample_below_k, previous_sample_below_k,
    delta_below_absolute_threshold (3 points), delta_below_relative_threshold
    (3 % of the previous, which counts as 1 at least).
    """
    per = df.groupBy(key, period).agg(F.count("*").alias("n"), js_round(F.round(F.percentile(value, F.lit(0.75)), 9), 1).alias("p75"))
    known = [r[0] for r in per.select(period).where(F.col(period).isNotNull()).distinct().limit(MAX_PERIODS + 1).collect()]
    if len(known) > MAX_PERIODS:
        raise ValueError(f"more than {MAX_PERIODS} periods")
    every = F.array(*[F.lit(x) for x in sorted(known)]) if known else F.array().cast("array<string>")
    grid = per.select(key).distinct().select(key, F.explode(every).alias(period))  # the complete universe of keys and periods
    w = Window.partitionBy(key).orderBy(period)
    full = grid.join(per, [key, period], "left").select("*", F.lag("n").over(w).alias("prev_n"), F.lag("p75").over(w).alias("prev_p75"))
    delta = js_round(F.col("p75") - F.col("prev_p75"), 1)
    full = full.withColumn("delta", delta)
    size = F.abs("delta")
    compared = F.col("n").isNotNull() & F.col("prev_n").isNotNull()
    reasons = F.array_compact(F.array(
        F.when(F.col("n").isNull(), "category_absent_current"),
        F.when(F.col("n").isNotNull() & F.col("prev_n").isNull(), "no_previous_period"),
        F.when(compared & (F.col("n") < k), "current_sample_below_k"), F.when(compared & (F.col("prev_n") < k), "previous_sample_below_k"),
        F.when(size < 3, "delta_below_absolute_threshold"), F.when(size / F.greatest(F.abs("prev_p75"), F.lit(1.0)) < 0.03, "delta_below_relative_threshold"),
    ))
    full = full.withColumn("reasons", F.array_join(reasons, ";"))
    reliability = F.when(F.col("reasons") != "", "suppressed").when((F.col("n") < 30) | (F.col("prev_n") < 30) | (size < 3), "caution").otherwise("reliable")
    return full.select(key, period, "n", "p75", "prev_p75", "delta", "reasons", reliability.alias("reliability"))
