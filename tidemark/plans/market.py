"""Market-risk run: tables, views and the ten reports on them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scores
from tidemark.functions.dates import month_key, month_of_year, year_key
from tidemark.functions.numbers import percent
from tidemark.operators import portfolio, risk
from tidemark.sources import tables

PRICE_COLUMNS = ("date", "ticker", "commodity", "open", "high", "low", "close", "volume")
METRIC_COLUMNS = ("date", "ticker", "ret_pct", "vol_21d", "drawdown", "pct_from_high",
                  "ma50", "ma200", "risk_flag")
EXPORT_COLUMNS = PRICE_COLUMNS + METRIC_COLUMNS[2:]


class MarketRun:
    """Every table derived from one set of bars; each plan is built when first asked for."""

    def __init__(self, bars: DataFrame, pair: tuple[str, str], warn: float, breach: float):
        self.bars, self.pair, self.warn, self.breach = bars, pair, warn, breach

    @cached_property
    def metrics(self) -> DataFrame:
        return risk.risk_metrics(self.bars, self.warn, self.breach)

    @cached_property
    def returns(self) -> DataFrame:
        return risk.daily_return(self.bars).select("ticker", "date", "ret")

    @cached_property
    def prices(self) -> DataFrame:
        return self.bars.select(*[c for c in PRICE_COLUMNS if c in self.bars.columns])

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return self.metrics.select(*METRIC_COLUMNS)

    @cached_property
    def correlation(self) -> DataFrame:
        return risk.rolling_corr(self.returns, [self.pair])

    @cached_property
    def stats(self) -> DataFrame:
        return portfolio.annualised_stats(self.returns, *self.pair)

    def kpis(self, instruments: DataFrame, lot_divisor: int = 100) -> DataFrame:
        return risk.kpi_snapshot(self.metrics, instruments, self.correlation, lot_divisor)


def run(
    bars: DataFrame,
    pair: tuple[str, str],
    warn: float = scores.VOL_WARN,
    breach: float = scores.VOL_BREACH,
) -> MarketRun:
    return MarketRun(bars, pair, warn, breach)


def register_views(spark: SparkSession, market: MarketRun) -> None:
    """Temp views `prices`, `daily_metrics`, `correlation` and `v_latest_risk` for SQL users."""
    market.prices.createOrReplaceTempView("prices")
    market.daily_metrics.createOrReplaceTempView("daily_metrics")
    market.correlation.createOrReplaceTempView("correlation")
    latest_risk(market).createOrReplaceTempView("v_latest_risk")


def join_metrics_prices(market: MarketRun) -> DataFrame:
    """Bars with their metrics, equal ticker and date."""
    return market.prices.join(market.daily_metrics, ["ticker", "date"])


def latest_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows at each key's own last `order` value."""
    newest = df.groupBy(key).agg(F.max(order).alias(order))
    return df.join(newest, [key, order], "left_semi")


def latest_global(df: DataFrame, order: str) -> DataFrame:
    """Rows at the last `order` value of the whole table."""
    return df.where(F.col(order) == df.agg(F.max(order)).scalar())


def latest_risk(market: MarketRun) -> DataFrame:
    """Risk summary at each ticker's latest bar; the metrics carry their bar, so bars are read once."""
    columns = [c for c in ("ticker", "commodity", "date", "close") if c in market.metrics.columns]
    days = market.metrics.select(*columns, "vol_21d", "drawdown", "risk_flag")
    rest = [c for c in days.columns if c != "ticker"]
    newest = days.groupBy("ticker").agg(F.max_by(F.struct(*rest), "date").alias("r"))
    return newest.select("ticker", "r.*").select(*days.columns)


def q1_latest_risk(latest: DataFrame) -> DataFrame:
    """Where every ticker stands now, most volatile first."""
    return latest.orderBy(F.col("vol_21d").desc_nulls_last(), "ticker").select(
        "ticker", "date",
        F.round("close", 2).alias("close"),
        percent(F.col("vol_21d")).alias("vol_annual_pct"),
        percent(F.col("drawdown")).alias("drawdown_pct"),
        "risk_flag",
    )


def q2_top_drops(market: MarketRun, ticker: str, n: int = 10) -> DataFrame:
    """A ticker's `n` worst days with the close."""
    days = market.metrics.where(F.col("ticker") == ticker)
    worst = days.orderBy(F.col("ret_pct").asc_nulls_first(), "date").limit(n)
    return worst.select(
        "date", F.round("close", 2).alias("close"), F.round("ret_pct", 2).alias("change_pct")
    )


def q3_breach_days_by_month(metrics: DataFrame) -> DataFrame:
    breached = metrics.where(F.col("risk_flag") == "BREACH")
    return (
        breached.groupBy("ticker", month_key(F.col("date")).alias("month"))
        .agg(F.count("*").alias("days_in_breach"))
        .orderBy(F.col("month").desc(), "ticker")
    )


def q4_vol_by_year(metrics: DataFrame) -> DataFrame:
    known = metrics.where(F.col("vol_21d").isNotNull())
    return known.groupBy("ticker", year_key(F.col("date")).alias("year")).agg(
        percent(F.avg("vol_21d")).alias("vol_avg_pct"),
        percent(F.max("vol_21d")).alias("vol_max_pct"),
    ).orderBy("year", "ticker")


def q5_price_stats(prices: DataFrame, by: str = "commodity") -> DataFrame:
    low, high = F.min("close"), F.max("close")
    return prices.groupBy(by).agg(
        F.count("*").alias("sessions"),
        F.round(low, 2).alias("minimum"),
        F.round(F.avg("close"), 2).alias("average"),
        F.round(high, 2).alias("maximum"),
        F.round(high - low, 2).alias("range"),
    )


def q6_max_drawdown(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("ticker").agg(
        percent(F.min("drawdown")).alias("max_drawdown_pct")
    ).orderBy("max_drawdown_pct", "ticker")


def q7_trend_signal(market: MarketRun) -> DataFrame:
    """Moving-average cross at the last date of the whole table; a ticker without a bar there is left out."""
    at_end = latest_global(market.prices, "date").select("ticker", "date")
    known = market.daily_metrics.where(F.col("ma200").isNotNull())
    crossed = F.when(F.col("ma50") >= F.col("ma200"), "Uptrend (golden cross)")
    return at_end.join(known, ["ticker", "date"]).select(
        "ticker", "date",
        F.round("ma50", 2).alias("ma50"),
        F.round("ma200", 2).alias("ma200"),
        crossed.otherwise("Downtrend (death cross)").alias("signal"),
    )


def q8_corr_by_year(correlation: DataFrame) -> DataFrame:
    return correlation.groupBy(year_key(F.col("date")).alias("year")).agg(
        F.round(F.avg("corr_63d"), 2).alias("avg_correlation"),
        F.count("*").alias("observations"),
    ).orderBy("year")


def q9_seasonality(metrics: DataFrame, ticker: str) -> DataFrame:
    days = metrics.where((F.col("ticker") == ticker) & F.col("ret_pct").isNotNull())
    return days.groupBy(month_of_year(F.col("date")).alias("month")).agg(
        F.round(F.avg("ret_pct"), 2).alias("avg_return_pct"),
        F.count("*").alias("days"),
    ).orderBy(F.col("avg_return_pct").desc(), "month")


def q10_moving_average(prices: DataFrame, ticker: str, span: int = 20, n: int = 15) -> DataFrame:
    """The newest closes with their average over up to `span` sessions."""
    frame = Window.partitionBy("ticker").orderBy("date").rowsBetween(1 - span, 0)
    smooth = prices.where(F.col("ticker") == ticker).select(
        "ticker", "date", F.round("close", 2).alias("close"),
        F.round(F.avg("close").over(frame), 2).alias("moving_avg_20d"),
    )
    return smooth.orderBy(F.col("date").desc()).limit(n)


def dashboard_header(market: MarketRun, names: DataFrame) -> DataFrame:
    """One row: the thresholds the flags were made with, and the instruments by ticker."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("ticker", "name"))))
    return names.agg(entries.alias("commodities")).select(
        F.lit(market.warn).alias("vol_warn"), F.lit(market.breach).alias("vol_breach"), "commodities")


def export_dashboard(market: MarketRun, instruments: DataFrame, folder: str) -> None:
    """The series, key figures, whole frontier and correlation, with the thresholds, as JSON lines."""
    frontier = portfolio.frontier_document(market.stats, *market.pair)
    tables.export_series_json(
        market.metrics, market.kpis(instruments), frontier, market.correlation, folder,
        dashboard_header(market, instruments.select("ticker", "name")))
