"""Daily price bars: reshaping, building from ticks, completeness, alignment.

A bar table holds one row per (ticker, date). A ticker's series is therefore
bounded by the calendar, about 25 000 rows for a century, whatever the volume of
ticks behind it; the per-ticker windows in `risk` rest on that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("open", "high", "low", "close", "volume")


def bars_unpivot(wide: DataFrame, names: dict[str, str], separator: str = "|") -> DataFrame:
    """Columns `<field>|<ticker>` per date to one row per (ticker, date) with a close."""

    def bar(ticker: str, name: str) -> Column:
        cells = [F.col(f"`{f}{separator}{ticker}`").cast("double").alias(f) for f in FIELDS]
        return F.struct(F.lit(ticker).alias("ticker"), F.lit(name).alias("commodity"), *cells)

    long = wide.select(
        F.to_date("date").alias("date"), F.inline(F.array(*[bar(t, n) for t, n in names.items()]))
    )
    return long.where(F.col("close").isNotNull())


def bars_from_ticks(ticks: DataFrame, key: str, ts: str, price: str, tie: str) -> DataFrame:
    """Open, high, low, close and tick count per key and day; `tie` orders equal times."""
    when = F.struct(F.col(ts), F.col(tie))
    return ticks.groupBy(F.col(key).alias("ticker"), F.to_date(ts).alias("date")).agg(
        F.min_by(price, when).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, when).alias("close"),
        F.count(price).alias("volume"),
    )


def missing_tickers(bars: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected tickers without a single close."""
    present = bars.where(F.col("close").isNotNull()).select("ticker").distinct()
    return expected.select("ticker").distinct().join(present, "ticker", "left_anti")


def require_complete(bars: DataFrame, expected: DataFrame) -> DataFrame:
    """The bars, or an error with the number of expected tickers that are absent and the first of them."""
    absent = missing_tickers(bars, expected).orderBy("ticker")
    first = [r.ticker for r in absent.take(20)]
    if first:
        raise ValueError(f"no price rows for {absent.count()} tickers, first {first}")
    return bars


def align_series(bars: DataFrame, tickers: list[str], value: str) -> DataFrame:
    """One row per date with a `value` column per ticker, NULL where it has no bar."""
    columns = [F.max(F.when(F.col("ticker") == t, F.col(value))).alias(t) for t in tickers]
    return bars.where(F.col("ticker").isin(tickers)).groupBy("date").agg(*columns)
