"""Rolling market-risk metrics per ticker, one shuffle and one sort for all of them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions import scores
from tidemark.functions.numbers import percent

# Window lengths in sessions.
TRADING_DAYS = 252
VOL_WINDOW, YEAR_WINDOW, YEAR_MIN_OBS, CORR_WINDOW = 21, 252, 20, 63
SHORT_MA, LONG_MA = 50, 200


def _series() -> WindowSpec:
    return Window.partitionBy("ticker").orderBy("date")


def _last(n: int) -> WindowSpec:
    return _series().rowsBetween(1 - n, 0)


def _guarded(value: Column, counted: str, n: int, at_least: int | None = None) -> Column:
    """A rolling value, NULL until the frame holds enough non-null entries."""
    return F.when(F.count(counted).over(_last(n)) >= (at_least or n), value)


def daily_return(bars: DataFrame) -> DataFrame:
    change = F.try_divide(F.col("close"), F.lag("close").over(_series())) - 1
    return bars.withColumn("ret", change).withColumn("ret_pct", F.col("ret") * 100)


def rolling_vol(returns: DataFrame, n: int = VOL_WINDOW) -> DataFrame:
    """Annualised sample deviation of the last `n` returns."""
    spread = F.stddev_samp("ret").over(_last(n)) * math.sqrt(TRADING_DAYS)
    return returns.withColumn("vol_21d", _guarded(spread, "ret", n))


def drawdown(bars: DataFrame) -> DataFrame:
    """Distance below the running peak."""
    peak = F.max("close").over(_series().rowsBetween(Window.unboundedPreceding, 0))
    return bars.withColumn("drawdown", F.try_divide(F.col("close"), peak) - 1)


def range_52w(bars: DataFrame, n: int = YEAR_WINDOW, at_least: int = YEAR_MIN_OBS) -> DataFrame:
    return bars.withColumns({
        "high_52w": _guarded(F.max("close").over(_last(n)), "close", n, at_least),
        "low_52w": _guarded(F.min("close").over(_last(n)), "close", n, at_least),
    })


def pct_from_high(ranged: DataFrame) -> DataFrame:
    return ranged.withColumn("pct_from_high", F.try_divide("close", "high_52w") - 1)


def moving_averages(bars: DataFrame, short: int = SHORT_MA, long: int = LONG_MA) -> DataFrame:
    return bars.withColumns({
        "ma50": _guarded(F.avg("close").over(_last(short)), "close", short),
        "ma200": _guarded(F.avg("close").over(_last(long)), "close", long),
    })


def risk_metrics(
    bars: DataFrame, warn: float = scores.VOL_WARN, breach: float = scores.VOL_BREACH
) -> DataFrame:
    """Bars with return, volatility, drawdown, 52-week range, averages and risk flag."""
    out = moving_averages(range_52w(drawdown(daily_return(bars))))
    out = rolling_vol(pct_from_high(out))
    return out.withColumn("risk_flag", scores.risk_flag(F.col("vol_21d"), warn, breach))


def rolling_corr(
    returns: DataFrame, pairs: list[tuple[str, str]], n: int = CORR_WINDOW
) -> DataFrame:
    """Rolling correlation of daily returns per pair; dates without a full window are dropped.

    The pair list is the caller's, a handful of names, so it rides along as a literal.
    """
    legs = F.explode(F.array(*[
        F.struct(
            F.lit(f"{a}/{b}").alias("pair"), F.lit(t).alias("leg"), F.lit(first).alias("is_first")
        )
        for a, b in pairs for t, first in ((a, True), (b, False))
    ]))
    members = returns.select("ticker", "date", "ret", legs.alias("_leg")).where(
        F.col("ticker") == F.col("_leg.leg")
    )
    # a pair names its legs separately, so the same ticker may serve several pairs
    joint = members.groupBy(F.col("_leg.pair").alias("pair"), "date").agg(
        F.max(F.when(F.col("_leg.is_first"), F.col("ret"))).alias("a"),
        F.max(F.when(~F.col("_leg.is_first"), F.col("ret"))).alias("b"),
    )
    frame = Window.partitionBy("pair").orderBy("date").rowsBetween(1 - n, 0)
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    spread = F.stddev_samp("a").over(frame) * F.stddev_samp("b").over(frame)
    rho = F.try_divide(F.covar_samp("a", "b").over(frame), spread)
    full = F.count(F.when(both, 1)).over(frame) == n
    return (
        joint.withColumn("corr_63d", F.when(full, rho))
        .where(F.col("corr_63d").isNotNull())
        .select("pair", "date", "corr_63d")
    )


def kpi_snapshot(
    metrics: DataFrame,
    instruments: DataFrame,
    correlation: DataFrame,
    lot_divisor: int = 100,
) -> DataFrame:
    """One row of key figures per instrument, at its latest bar.

    `instruments` has ticker, name, pt, unit, contract_lbs, exchange. One aggregate
    picks the latest bar; the day change is that bar's return, 0 for a first bar.
    """
    kept = ("close", "ret_pct", "vol_21d", "drawdown", "pct_from_high",
            "high_52w", "low_52w", "risk_flag")
    latest = metrics.groupBy("ticker").agg(
        F.max("date").alias("last_date"), F.max_by(F.struct(*kept), "date").alias("b")
    )
    last_corr = correlation.agg(F.max_by("corr_63d", "date")).scalar()
    return instruments.join(latest, "ticker").select(
        "ticker",
        F.col("name").alias("commodity"),
        F.col("pt").alias("commodity_pt"),
        "unit",
        "exchange",
        "contract_lbs",
        "last_date",
        F.round("b.close", 2).alias("last_close"),
        F.round(F.coalesce("b.ret_pct", F.lit(0.0)), 2).alias("day_change_pct"),
        percent(F.col("b.vol_21d")).alias("vol_21d_annual_pct"),
        percent(F.col("b.drawdown")).alias("drawdown_pct"),
        percent(F.col("b.pct_from_high")).alias("pct_from_high_pct"),
        F.round("b.high_52w", 2).alias("high_52w"),
        F.round("b.low_52w", 2).alias("low_52w"),
        F.col("b.risk_flag").alias("risk_flag"),
        F.round(F.col("b.close") / lot_divisor * F.col("contract_lbs"), 0)
        .alias("contract_notional_usd"),
        F.round(last_corr, 2).alias("corr_63d"),
    )


def latest_sessions(bars: DataFrame, tickers: list[str], n: int = 10) -> DataFrame:
    """The last `n` dates of the first ticker, every ticker's close and day change in percent.

    Series are matched by date.
    """
    changes = daily_return(bars).where(F.col("ticker").isin(tickers))
    columns = []
    for t in tickers:
        own = F.col("ticker") == t
        columns.append(F.max(F.when(own, F.round("close", 2))).alias(f"{t}_close"))
        columns.append(F.max(F.when(own, F.round("ret_pct", 2))).alias(f"{t}_change_pct"))
    side_by_side = changes.groupBy("date").agg(*columns)
    return (
        side_by_side.where(F.col(f"{tickers[0]}_close").isNotNull())
        .orderBy(F.col("date").desc()).limit(n)
    )
