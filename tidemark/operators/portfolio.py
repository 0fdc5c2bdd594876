"""Two-asset risk and return mixes. Everything after the statistics is one row."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.bars import align_series
from tidemark.operators.risk import TRADING_DAYS

# Weight step of the curve, tolerance of its upper branch, axis padding.
WEIGHT_STEP = 5
BRANCH_TOLERANCE = 1e-6
RANGE_PADDING = 0.06


def annualised_stats(returns: DataFrame, first: str, second: str) -> DataFrame:
    """Yearly mean and deviation of both assets and their correlation, on shared dates."""
    both = align_series(returns, [first, second], "ret").select(
        F.col(f"`{first}`").alias("a"), F.col(f"`{second}`").alias("b")
    ).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    year = math.sqrt(TRADING_DAYS)
    raw = both.agg(
        (F.avg("a") * TRADING_DAYS).alias("mean_a"),
        (F.avg("b") * TRADING_DAYS).alias("mean_b"),
        F.stddev_samp("a").alias("sd_a"),
        F.stddev_samp("b").alias("sd_b"),
        F.covar_samp("a", "b").alias("cov"),
    )
    return raw.select(
        "mean_a", "mean_b",
        (F.col("sd_a") * year).alias("risk_a"), (F.col("sd_b") * year).alias("risk_b"),
        F.try_divide(F.col("cov"), F.col("sd_a") * F.col("sd_b")).alias("rho"),
    )


def mix_return(weight: Column) -> Column:
    """Return in percent with `weight` in the first asset."""
    mean = weight * F.col("mean_a") + (1 - weight) * F.col("mean_b")
    return F.round(mean * 100, 2)


def mix_risk(weight: Column) -> Column:
    """Risk in percent with `weight` in the first asset."""
    a, b = weight * F.col("risk_a"), (1 - weight) * F.col("risk_b")
    variance = a * a + b * b + 2 * a * b * F.col("rho")
    return F.round(F.sqrt(F.when(variance < 0, 0.0).otherwise(variance)) * 100, 2)


def min_variance_weight() -> Column:
    """Share of the first asset with the least risk, kept within [0, 1]."""
    shared = F.col("risk_a") * F.col("risk_b") * F.col("rho")
    bottom = F.pow("risk_a", F.lit(2.0)) + F.pow("risk_b", F.lit(2.0)) - 2 * shared
    weight = F.when(bottom == 0, 0.5).otherwise(
        F.try_divide(F.pow("risk_b", F.lit(2.0)) - shared, bottom)
    )
    return F.when(weight < 0, 0.0).when(weight > 1, 1.0).otherwise(weight)


def frontier_points(stats: DataFrame, step: int = WEIGHT_STEP) -> DataFrame:
    """Return and risk for weights 0, step, … 100 percent."""
    spread = stats.withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(100), F.lit(step))))
    share = F.col("w") / 100
    return spread.select("w", mix_return(share).alias("ret"), mix_risk(share).alias("risk"))


def min_variance_mix(stats: DataFrame) -> DataFrame:
    best = stats.withColumn("share", min_variance_weight())
    return best.select(
        F.round(F.col("share") * 100, 1).alias("w"),
        mix_return(F.col("share")).alias("ret"),
        mix_risk(F.col("share")).alias("risk"),
    )


def frontier_document(stats: DataFrame, first: str, second: str, step: int = WEIGHT_STEP) -> DataFrame:
    """One row: correlation, both assets alone, the curve and its least-risk mix, display-rounded."""
    share = min_variance_weight()
    assets = F.create_map(*[
        value for name, s in ((first, "a"), (second, "b")) for value in (
            F.lit(name), F.struct(F.round(F.col(f"mean_{s}") * 100, 2).alias("ret"), F.round(F.col(f"risk_{s}") * 100, 2).alias("risk")))
    ])
    points = F.transform(F.sequence(F.lit(0), F.lit(100), F.lit(step)), lambda w: F.struct(
        w.alias("w"), mix_return(w / 100).alias("ret"), mix_risk(w / 100).alias("risk")))
    least = F.struct(F.round(share * 100, 1).alias("w"), mix_return(share).alias("ret"), mix_risk(share).alias("risk"))
    return stats.select(F.round("rho", 3).alias("corr"), assets.alias("assets"), points.alias("points"), least.alias("min_var"))


def efficient_branch(stats: DataFrame, step: int = WEIGHT_STEP) -> DataFrame:
    """The points that return more than the least-risk mix, compared after rounding."""
    floor = stats.withColumn("floor", mix_return(min_variance_weight()))
    spread = floor.withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(100), F.lit(step))))
    share = F.col("w") / 100
    points = spread.select(
        "w", mix_return(share).alias("ret"), mix_risk(share).alias("risk"), "floor"
    )
    return points.where(F.col("ret") > F.col("floor") + BRANCH_TOLERANCE).drop("floor")


def diversification_gain(stats: DataFrame) -> DataFrame:
    """Risk saved in percent and return gained in points against the second asset alone."""
    share = min_variance_weight()
    alone_risk = F.round(F.col("risk_b") * 100, 2)
    return stats.select(
        (F.try_divide(alone_risk - mix_risk(share), alone_risk) * 100).alias("risk_cut_pct"),
        (mix_return(share) - F.round(F.col("mean_b") * 100, 2)).alias("return_gain_pp"),
    )


def price_range_padded(bars: DataFrame, padding: float = RANGE_PADDING) -> DataFrame:
    """Shared price axis: lowest and highest rounded close, padded, never below zero."""
    close = F.round("close", 2)
    ends = bars.agg(F.min(close).alias("lo"), F.max(close).alias("hi"))
    pad = (F.col("hi") - F.col("lo")) * padding
    return ends.select(
        F.greatest(F.lit(0.0), F.col("lo") - pad).alias("range_lo"),
        (F.col("hi") + pad).alias("range_hi"),
    )
