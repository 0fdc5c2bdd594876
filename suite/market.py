"""Price bars, risk metrics, reports, portfolio mixes and market exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.registry import half_up, oracle, query, table, view
from suite.views import BREACH, PAIR, WARN
from tidemark.functions import dates
from tidemark.operators import bars, ordering, portfolio, risk
from tidemark.plans import market
from tidemark.session import scratch_path
from tidemark.sources import tables

A, R = PAIR
TICKERS = ("A", "N", "R")


def _market(spark: SparkSession, sf: str) -> market.MarketRun:
    named = view(spark, sf, "f1_bars").withColumn("commodity", F.concat(F.lit("Flag "), "ticker"))
    return market.run(named, PAIR, WARN, BREACH)


def _r6(*columns: str) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


def _d6(*columns: str) -> str:
    return ", ".join(f"{half_up(c, 6)} AS {c}" for c in columns)


def _instruments(spark: SparkSession) -> DataFrame:
    rows = [(t, f"Flag {t}", f"F{t}", "USD", 1000, "X") for t in TICKERS]
    return spark.createDataFrame(
        rows, "ticker string, name string, pt string, unit string, contract_lbs int, exchange string"
    )


# -- bars ------------------------------------------------------------------------------------

_WIDE = "SELECT date" + "".join(
    f", MAX(close) FILTER (WHERE ticker = '{t}') AS close_{t}" for t in TICKERS
) + " FROM f1_bars GROUP BY date"


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """Fields by ticker, the shape a price feed delivers; NULL where a ticker has no bar."""
    day = view(spark, sf, "f1_bars").groupBy("date")
    cells = []
    for field in bars.FIELDS:
        source = "close" if field == "open" else field
        cells += [F.max(F.when(F.col("ticker") == t, F.col(source))).alias(f"{field}|{t}") for t in TICKERS]
    return day.agg(*cells)


@query("bars_unpivot", oracle("f1_bars", sql="""
    SELECT ticker, 'Flag ' || ticker AS commodity, date, close AS open, high, low, close, volume
    FROM f1_bars WHERE close IS NOT NULL"""))
def bars_unpivot(spark, sf):
    return bars.bars_unpivot(_wide(spark, sf), {t: f"Flag {t}" for t in TICKERS})


@query("bars_from_ticks", """
    SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
      ARG_MIN(value, (ts, event_id)) AS open, MAX(value) AS high, MIN(value) AS low,
      ARG_MAX(value, (ts, event_id)) AS close, CAST(COUNT(value) AS BIGINT) AS volume
    FROM events GROUP BY ALL""")
def bars_from_ticks(spark, sf):
    return bars.bars_from_ticks(table(spark, sf, "events"), "event_type", "ts", "value", "event_id")


@query("bars_completeness", oracle("f1_bars", sql="""
    SELECT e.ticker FROM (SELECT DISTINCT l_returnflag AS ticker FROM lineitem
                          UNION SELECT DISTINCT o_orderstatus FROM orders) e
    WHERE NOT EXISTS (SELECT 1 FROM f1_bars b WHERE b.ticker = e.ticker AND b.close IS NOT NULL)"""))
def bars_completeness(spark, sf):
    flags = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("ticker"))
    states = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("ticker"))
    return bars.missing_tickers(view(spark, sf, "f1_bars"), flags.unionByName(states))


@query("align_series", oracle("f1_bars", sql="""
    SELECT date, MAX(CASE WHEN ticker = 'A' THEN close END) AS "A",
      MAX(CASE WHEN ticker = 'R' THEN close END) AS "R"
    FROM f1_bars WHERE ticker IN ('A', 'R') GROUP BY date"""))
def align_series(spark, sf):
    return bars.align_series(view(spark, sf, "f1_bars"), [A, R], "close")


# -- windows ---------------------------------------------------------------------------------

_RET = ("f1_bars", "f1_ret")
_MET = ("f1_bars", "f1_ret", "f1_rolled", "f1_metrics")


@query("daily_return", oracle(*_RET, sql=f"""
    SELECT ticker, date, {half_up('ret', 6)} AS ret, {half_up('ret * 100', 6)} AS ret_pct FROM f1_ret"""))
def daily_return(spark, sf):
    return risk.daily_return(view(spark, sf, "f1_bars")).select("ticker", "date", *_r6("ret", "ret_pct"))


@query("rolling_vol", oracle(*_MET, sql=f"SELECT ticker, date, {_d6('vol_21d')} FROM f1_metrics"))
def rolling_vol(spark, sf):
    rolled = risk.rolling_vol(risk.daily_return(view(spark, sf, "f1_bars")))
    return rolled.select("ticker", "date", *_r6("vol_21d"))


@query("drawdown", oracle(*_MET, sql=f"SELECT ticker, date, {_d6('drawdown')} FROM f1_metrics"))
def drawdown(spark, sf):
    return risk.drawdown(view(spark, sf, "f1_bars")).select("ticker", "date", *_r6("drawdown"))


@query("range_52w", oracle(*_MET, sql=f"SELECT ticker, date, {_d6('high_52w', 'low_52w')} FROM f1_metrics"))
def range_52w(spark, sf):
    return risk.range_52w(view(spark, sf, "f1_bars")).select("ticker", "date", *_r6("high_52w", "low_52w"))


@query("pct_from_high", oracle(*_MET, sql=f"SELECT ticker, date, {_d6('pct_from_high')} FROM f1_metrics"))
def pct_from_high(spark, sf):
    ranged = risk.pct_from_high(risk.range_52w(view(spark, sf, "f1_bars")))
    return ranged.select("ticker", "date", *_r6("pct_from_high"))


@query("moving_averages", oracle(*_MET, sql=f"SELECT ticker, date, {_d6('ma50', 'ma200')} FROM f1_metrics"))
def moving_averages(spark, sf):
    return risk.moving_averages(view(spark, sf, "f1_bars")).select("ticker", "date", *_r6("ma50", "ma200"))


@query("risk_flag", oracle(*_MET, sql="""
    SELECT ticker, risk_flag, CAST(COUNT(*) AS BIGINT) AS days FROM f1_metrics GROUP BY ALL"""))
def risk_flag(spark, sf):
    return _market(spark, sf).daily_metrics.groupBy("ticker", "risk_flag").agg(F.count("*").alias("days"))


_RISK = ("ret_pct", "vol_21d", "drawdown", "pct_from_high", "high_52w", "low_52w", "ma50", "ma200")


@query("risk_metrics", oracle(*_MET, sql=f"SELECT ticker, date, risk_flag, {_d6(*_RISK)} FROM f1_metrics"))
def risk_metrics(spark, sf):
    metrics = risk.risk_metrics(view(spark, sf, "f1_bars"), WARN, BREACH)
    return metrics.select("ticker", "date", "risk_flag", *_r6(*_RISK))


_CORR = ("f1_bars", "f1_ret", "f1_joint", "f1_corr")


@query("rolling_corr", oracle(*_CORR, sql=f"""
    SELECT 'A/R' AS pair, date, {_d6('corr_63d')} FROM f1_corr"""))
def rolling_corr(spark, sf):
    return _market(spark, sf).correlation.select("pair", "date", *_r6("corr_63d"))


@query("latest_sessions", oracle(*_RET, sql=f"""
    SELECT date, {half_up("MAX(CASE WHEN ticker = 'A' THEN close END)", 2)} AS "A_close",
      {half_up("MAX(CASE WHEN ticker = 'A' THEN ret END) * 100", 2)} AS "A_change_pct",
      {half_up("MAX(CASE WHEN ticker = 'R' THEN close END)", 2)} AS "R_close",
      {half_up("MAX(CASE WHEN ticker = 'R' THEN ret END) * 100", 2)} AS "R_change_pct"
    FROM f1_ret GROUP BY date HAVING COUNT(*) FILTER (WHERE ticker = 'A') > 0 ORDER BY date DESC LIMIT 10"""))
def latest_sessions(spark, sf):
    return risk.latest_sessions(view(spark, sf, "f1_bars"), [A, R])


@query("last_n_sessions_slice", oracle("f1_bars", sql="""
    SELECT ticker, date, close FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM f1_bars)
    WHERE rn <= 63"""))
def last_n_sessions_slice(spark, sf):
    newest = ordering.last_n_per_key(view(spark, sf, "f1_bars"), ["ticker"], "date", 63)
    return newest.select("ticker", "date", "close")


# -- tables, views, joins --------------------------------------------------------------------

@query("write_tables", oracle(*_MET, "f1_joint", "f1_corr", sql="""
    SELECT 'prices' AS name, CAST(COUNT(*) AS BIGINT) AS n_rows, ROUND(SUM(close), 4) AS total FROM f1_bars
    UNION ALL SELECT 'daily_metrics', CAST(COUNT(*) AS BIGINT), ROUND(SUM(drawdown), 4) FROM f1_metrics
    UNION ALL SELECT 'correlation', CAST(COUNT(*) AS BIGINT), ROUND(SUM(corr_63d), 4) FROM f1_corr
    UNION ALL SELECT 'kpi_snapshot', CAST(COUNT(DISTINCT ticker) AS BIGINT), 1000.0 * COUNT(DISTINCT ticker) FROM f1_bars"""))
def write_tables(spark, sf):
    run, folder = _market(spark, sf), scratch_path(spark, "market")
    tables.write_tables({
        "prices": run.prices, "daily_metrics": run.daily_metrics,
        "correlation": run.correlation, "kpi_snapshot": run.kpis(_instruments(spark)),
    }, folder)
    sums = {"prices": "close", "daily_metrics": "drawdown", "correlation": "corr_63d",
            "kpi_snapshot": "contract_lbs"}
    parts = [
        spark.read.parquet(f"{folder}/{name}").agg(
            F.count("*").alias("n_rows"), F.round(F.sum(F.col(c).cast("double")), 4).alias("total")
        ).select(F.lit(name).alias("name"), "n_rows", "total")
        for name, c in sums.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_LATEST = """
    SELECT ticker, 'Flag ' || ticker AS commodity, date, close, vol_21d, drawdown, risk_flag FROM f1_metrics m
    WHERE date = (SELECT MAX(date) FROM f1_bars p WHERE p.ticker = m.ticker)"""


@query("view_latest_risk", oracle(*_MET, v=_LATEST, sql=f"""
    SELECT ticker, commodity, date, risk_flag, {_d6('close', 'vol_21d', 'drawdown')} FROM v"""))
def view_latest_risk(spark, sf):
    market.register_views(spark, _market(spark, sf))
    latest = spark.table("v_latest_risk")
    return latest.select("ticker", "commodity", "date", "risk_flag", *_r6("close", "vol_21d", "drawdown"))


@query("join_metrics_prices", oracle(*_MET, sql=f"""
    SELECT ticker, date, volume, risk_flag, {_d6('close', 'drawdown')} FROM f1_metrics"""))
def join_metrics_prices(spark, sf):
    joined = market.join_metrics_prices(_market(spark, sf))
    return joined.select("ticker", "date", "volume", "risk_flag", *_r6("close", "drawdown"))


@query("latest_by_key_subquery", oracle("f1_bars", sql="""
    SELECT ticker, date, close FROM f1_bars b
    WHERE date = (SELECT MAX(date) FROM f1_bars p WHERE p.ticker = b.ticker)"""))
def latest_by_key_subquery(spark, sf):
    return market.latest_by_key(view(spark, sf, "f1_bars"), "ticker", "date").select("ticker", "date", "close")


@query("latest_global_subquery", oracle("f1_bars", sql="""
    SELECT ticker, date, close FROM f1_bars WHERE date = (SELECT MAX(date) FROM f1_bars)"""))
def latest_global_subquery(spark, sf):
    return market.latest_global(view(spark, sf, "f1_bars"), "date").select("ticker", "date", "close")


# -- the ten reports -------------------------------------------------------------------------

@query("q1_latest_risk", oracle(*_MET, v=_LATEST, sql=f"""
    SELECT ticker, date, {half_up('close', 2)} AS close, {half_up('vol_21d * 100', 1)} AS vol_annual_pct,
      {half_up('drawdown * 100', 1)} AS drawdown_pct, risk_flag FROM v"""))
def q1_latest_risk(spark, sf):
    market.register_views(spark, _market(spark, sf))
    return market.q1_latest_risk(spark.table("v_latest_risk"))


@query("q2_top_drops", oracle(*_MET, sql=f"""
    SELECT date, {half_up('close', 2)} AS close, {half_up('ret_pct', 2)} AS change_pct FROM f1_metrics
    WHERE ticker = 'A' ORDER BY ret_pct ASC NULLS FIRST, date LIMIT 10"""))
def q2_top_drops(spark, sf):
    return market.q2_top_drops(_market(spark, sf), A)


@query("q3_breach_days_by_month", oracle(*_MET, sql="""
    SELECT ticker, STRFTIME(date, '%Y-%m') AS month, CAST(COUNT(*) AS BIGINT) AS days_in_breach
    FROM f1_metrics WHERE risk_flag = 'BREACH' GROUP BY ALL"""))
def q3_breach_days_by_month(spark, sf):
    return market.q3_breach_days_by_month(_market(spark, sf).daily_metrics)


@query("q4_vol_by_year", oracle(*_MET, sql=f"""
    SELECT ticker, STRFTIME(date, '%Y') AS year, {half_up('AVG(vol_21d) * 100', 1)} AS vol_avg_pct,
      {half_up('MAX(vol_21d) * 100', 1)} AS vol_max_pct
    FROM f1_metrics WHERE vol_21d IS NOT NULL GROUP BY 1, 2"""))
def q4_vol_by_year(spark, sf):
    return market.q4_vol_by_year(_market(spark, sf).daily_metrics)


@query("q5_price_stats", oracle("f1_bars", sql=f"""
    SELECT 'Flag ' || ticker AS commodity, CAST(COUNT(*) AS BIGINT) AS sessions,
      {half_up('MIN(close)', 2)} AS minimum, {half_up('AVG(close)', 2)} AS average,
      {half_up('MAX(close)', 2)} AS maximum, {half_up('MAX(close) - MIN(close)', 2)} AS "range"
    FROM f1_bars GROUP BY ticker"""))
def q5_price_stats(spark, sf):
    return market.q5_price_stats(_market(spark, sf).prices)


@query("q6_max_drawdown", oracle(*_MET, sql=f"""
    SELECT ticker, {half_up('MIN(drawdown) * 100', 1)} AS max_drawdown_pct FROM f1_metrics GROUP BY ticker"""))
def q6_max_drawdown(spark, sf):
    return market.q6_max_drawdown(_market(spark, sf).daily_metrics)


@query("q7_trend_signal", oracle(*_MET, sql=f"""
    SELECT ticker, date, {half_up('ma50', 2)} AS ma50, {half_up('ma200', 2)} AS ma200,
      IF(ma50 >= ma200, 'Uptrend (golden cross)', 'Downtrend (death cross)') AS signal
    FROM f1_metrics WHERE ma200 IS NOT NULL AND date = (SELECT MAX(date) FROM f1_bars)"""))
def q7_trend_signal(spark, sf):
    return market.q7_trend_signal(_market(spark, sf))


@query("q8_corr_by_year", oracle(*_CORR, sql=f"""
    SELECT STRFTIME(date, '%Y') AS year, {half_up('AVG(corr_63d)', 2)} AS avg_correlation,
      CAST(COUNT(*) AS BIGINT) AS observations FROM f1_corr GROUP BY 1"""))
def q8_corr_by_year(spark, sf):
    return market.q8_corr_by_year(_market(spark, sf).correlation)


@query("q9_seasonality", oracle(*_MET, sql=f"""
    SELECT STRFTIME(date, '%m') AS month, {half_up('AVG(ret_pct)', 2)} AS avg_return_pct,
      CAST(COUNT(*) AS BIGINT) AS days FROM f1_metrics WHERE ticker = 'A' AND ret_pct IS NOT NULL GROUP BY 1"""))
def q9_seasonality(spark, sf):
    return market.q9_seasonality(_market(spark, sf).daily_metrics, A)


@query("q10_sql_moving_avg", oracle("f1_bars", sql=f"""
    SELECT ticker, date, {half_up('close', 2)} AS close, {half_up('avg20', 2)} AS moving_avg_20d FROM (
      SELECT *, AVG(close) OVER (PARTITION BY ticker ORDER BY date ROWS 19 PRECEDING) AS avg20
      FROM f1_bars WHERE ticker = 'A') ORDER BY date DESC LIMIT 15"""))
def q10_sql_moving_avg(spark, sf):
    return market.q10_moving_average(view(spark, sf, "f1_bars"), A)


# -- snapshot and portfolio ------------------------------------------------------------------

@query("kpi_snapshot", oracle(*_MET, "f1_joint", "f1_corr", v=_LATEST.replace("date, close", "date, close, ret_pct, pct_from_high, high_52w, low_52w"), sql=f"""
    SELECT ticker, commodity, 'F' || ticker AS commodity_pt, 'USD' AS unit, 'X' AS exchange,
      CAST(1000 AS INTEGER) AS contract_lbs, date AS last_date, {half_up('close', 2)} AS last_close,
      {half_up('COALESCE(ret_pct, 0)', 2)} AS day_change_pct, {half_up('vol_21d * 100', 1)} AS vol_21d_annual_pct,
      {half_up('drawdown * 100', 1)} AS drawdown_pct, {half_up('pct_from_high * 100', 1)} AS pct_from_high_pct,
      {half_up('high_52w', 2)} AS high_52w, {half_up('low_52w', 2)} AS low_52w, risk_flag,
      {half_up('close / 100 * 1000', 0)} AS contract_notional_usd,
      {half_up('(SELECT ARG_MAX(corr_63d, date) FROM f1_corr)', 2)} AS corr_63d
    FROM v"""))
def kpi_snapshot(spark, sf):
    return _market(spark, sf).kpis(_instruments(spark))


_STATS = ("f1_bars", "f1_ret", "f1_joint", "f1_stats")
_MIX = half_up("({w} * mean_a + (1 - {w}) * mean_b) * 100", 2)
_MIX_RISK = half_up("SQRT(({w} * risk_a)**2 + ((1 - {w}) * risk_b)**2 "
                    "+ 2 * {w} * (1 - {w}) * risk_a * risk_b * rho) * 100", 2)
_WMV = ("GREATEST(0.0, LEAST(1.0, CASE WHEN risk_a**2 + risk_b**2 - 2 * risk_a * risk_b * rho = 0 THEN 0.5 "
        "ELSE (risk_b**2 - risk_a * risk_b * rho) / (risk_a**2 + risk_b**2 - 2 * risk_a * risk_b * rho) END))")
_POINTS = (f"SELECT CAST(i * 5 AS INTEGER) AS w, {_MIX.format(w='(i * 5 / 100)')} AS ret, "
           f"{_MIX_RISK.format(w='(i * 5 / 100)')} AS risk FROM f1_stats, RANGE(21) AS g(i)")
_MV = (f"SELECT {half_up('wmv * 100', 1)} AS w, {_MIX.format(w='wmv')} AS ret, {_MIX_RISK.format(w='wmv')} AS risk, "
       f"{half_up('risk_b * 100', 2)} AS alone_risk, {half_up('mean_b * 100', 2)} AS alone_ret "
       f"FROM (SELECT *, {_WMV} AS wmv FROM f1_stats)")


def _stats(spark, sf):
    return _market(spark, sf).stats


@query("annualised_stats", oracle(*_STATS, sql=f"SELECT {_d6('mean_a', 'mean_b', 'risk_a', 'risk_b', 'rho')} FROM f1_stats"))
def annualised_stats(spark, sf):
    return _stats(spark, sf).select(*_r6("mean_a", "mean_b", "risk_a", "risk_b", "rho"))


@query("frontier_points", oracle(*_STATS, sql=_POINTS))
def frontier_points(spark, sf):
    return portfolio.frontier_points(_stats(spark, sf))


@query("min_variance_mix", oracle(*_STATS, mv=_MV, sql="SELECT w, ret, risk FROM mv"))
def min_variance_mix(spark, sf):
    return portfolio.min_variance_mix(_stats(spark, sf))


@query("efficient_branch", oracle(*_STATS, mv=_MV, points=_POINTS, sql="""
    SELECT * FROM points WHERE ret > (SELECT ret FROM mv) + 1e-6"""))
def efficient_branch(spark, sf):
    return portfolio.efficient_branch(_stats(spark, sf))


@query("diversification_gain", oracle(*_STATS, mv=_MV, sql=f"""
    SELECT {half_up('(alone_risk - risk) / alone_risk * 100', 6)} AS risk_cut_pct,
      {half_up('ret - alone_ret', 6)} AS return_gain_pp FROM mv"""))
def diversification_gain(spark, sf):
    return portfolio.diversification_gain(_stats(spark, sf)).select(*_r6("risk_cut_pct", "return_gain_pp"))


@query("price_range_padded", oracle("f1_bars", ends=f"""
    SELECT MIN({half_up('close', 2)}) AS lo, MAX({half_up('close', 2)}) AS hi FROM f1_bars""", sql=f"""
    SELECT {half_up('GREATEST(0.0, lo - (hi - lo) * 0.06)', 6)} AS range_lo,
      {half_up('hi + (hi - lo) * 0.06', 6)} AS range_hi FROM ends"""))
def price_range_padded(spark, sf):
    return portfolio.price_range_padded(view(spark, sf, "f1_bars")).select(*_r6("range_lo", "range_hi"))


# -- calendar keys, display, exports ---------------------------------------------------------

@query("calendar_keys", oracle("f1_bars", sql="""
    SELECT STRFTIME(date, '%Y-%m') AS month, STRFTIME(date, '%Y') AS year, STRFTIME(date, '%m') AS month_of_year,
      STRFTIME(date, '%b/%y') AS label, CAST(COUNT(*) AS BIGINT) AS bars FROM f1_bars GROUP BY ALL"""))
def calendar_keys(spark, sf):
    day = F.col("date")
    return view(spark, sf, "f1_bars").groupBy(
        dates.month_key(day).alias("month"), dates.year_key(day).alias("year"),
        dates.month_of_year(day).alias("month_of_year"), dates.short_month_label(day).alias("label"),
    ).agg(F.count("*").alias("bars"))


def _calendar(name: str, key, pattern: str) -> None:
    @query(name, oracle("f1_bars", sql=f"""
        SELECT ticker, STRFTIME(date, '{pattern}') AS label, CAST(COUNT(*) AS BIGINT) AS bars FROM f1_bars GROUP BY ALL"""))
    def run(spark, sf):
        labelled = view(spark, sf, "f1_bars").groupBy("ticker", key(F.col("date")).alias("label"))
        return labelled.agg(F.count("*").alias("bars"))


_calendar("month_key", dates.month_key, "%Y-%m")
_calendar("year_key", dates.year_key, "%Y")
_calendar("month_of_year", dates.month_of_year, "%m")
_calendar("short_month_label", dates.short_month_label, "%b/%y")

# the reports' row filters, as rows rather than as the reports built on them
_FILTERS = {
    "q2_filter": ("ticker = 'A'", lambda: F.col("ticker") == A),
    "q3_filter": ("risk_flag = 'BREACH'", lambda: F.col("risk_flag") == "BREACH"),
    "q4_filter": ("vol_21d IS NOT NULL", lambda: F.col("vol_21d").isNotNull()),
    "q7_filter": ("ma200 IS NOT NULL AND date = (SELECT MAX(date) FROM f1_bars)", None),
    "q9_filter": ("ticker = 'A' AND ret_pct IS NOT NULL", lambda: (F.col("ticker") == A) & F.col("ret_pct").isNotNull()),
    "q10_filter": ("ticker = 'A'", lambda: F.col("ticker") == A),
}


def _filter(name: str, condition: str, column) -> None:
    @query(name, oracle(*_MET, sql=f"SELECT ticker, date, risk_flag FROM f1_metrics WHERE {condition}"))
    def run(spark, sf):
        metrics = _market(spark, sf).metrics
        if column is None:
            kept = market.latest_global(metrics, "date").where(F.col("ma200").isNotNull())
        else:
            kept = metrics.where(column())
        return kept.select("ticker", "date", "risk_flag")


for _name, (_condition, _column) in _FILTERS.items():
    _filter(_name, _condition, _column)


@query("display_rounding", oracle(*_MET, sql=f"""
    SELECT ticker, date, {half_up('close', 2)} AS close, {half_up('vol_21d * 100', 1)} AS vol_pct,
      {half_up('ma50', 2)} AS ma50 FROM f1_metrics"""))
def display_rounding(spark, sf):
    return _market(spark, sf).metrics.select(
        "ticker", "date", F.round("close", 2).alias("close"),
        F.round(F.col("vol_21d") * 100, 1).alias("vol_pct"), F.round("ma50", 2).alias("ma50"))


@query("export_csv", oracle(*_MET, sql=f"""
    SELECT ticker, date, risk_flag, {_d6('close', 'drawdown', 'vol_21d')} FROM f1_metrics"""))
def export_csv(spark, sf):
    run, folder = _market(spark, sf), scratch_path(spark, "csv")
    wanted = [c for c in market.EXPORT_COLUMNS if c in run.metrics.columns]
    tables.export_csv({"prices": run.metrics.select(*wanted), "correlation": run.correlation,
                       "kpi_snapshot": run.kpis(_instruments(spark))}, folder)
    schema = T.StructType([run.metrics.schema[c] for c in wanted])
    back = spark.read.schema(schema).option("header", True).csv(f"{folder}/prices")
    return back.select("ticker", "date", "risk_flag", *_r6("close", "drawdown", "vol_21d"))


@query("export_series_json", oracle(*_MET, sql=f"""
    SELECT ticker, CAST(date AS VARCHAR) AS date, {half_up('close', 2)} AS close,
      {half_up('vol_21d * 100', 1)} AS vol_21d, {half_up('ma50', 2)} AS ma50, {half_up('ma200', 2)} AS ma200
    FROM f1_metrics"""))
def export_series_json(spark, sf):
    run, folder = _market(spark, sf), scratch_path(spark, "json")
    tables.export_series_json(run.metrics, run.kpis(_instruments(spark)),
                              portfolio.frontier_points(run.stats), run.correlation, folder)
    back = spark.read.schema("ticker string, document string").json(f"{folder}/series")
    arrays = ("dates array<string>, close array<double>, vol_21d array<double>, "
              "ma50 array<double>, ma200 array<double>")
    doc = F.from_json("document", arrays)
    zipped = F.arrays_zip(*[F.col(f"d.{c}") for c in ("dates", "close", "vol_21d", "ma50", "ma200")])
    points = back.select("ticker", doc.alias("d")).select("ticker", F.explode(zipped).alias("p"))
    return points.select("ticker", F.col("p.dates").alias("date"),
                         *[F.col(f"p.{c}").alias(c) for c in ("close", "vol_21d", "ma50", "ma200")])


@query("export_csv_tables", oracle(*_MET, "f1_joint", "f1_corr", v=_LATEST, sql=f"""
    SELECT 'correlation' AS name, 'A/R' AS key, date, {half_up('corr_63d', 6)} AS value FROM f1_corr
    UNION ALL SELECT 'kpi_snapshot', ticker, date, {half_up('close', 2)} FROM v"""))
def export_csv_tables(spark, sf):
    """The two smaller files, read back by their own schemas."""
    run, folder = _market(spark, sf), scratch_path(spark, "csv")
    out = {"correlation": run.correlation, "kpi_snapshot": run.kpis(_instruments(spark))}
    tables.export_csv(out, folder)
    back = {n: spark.read.schema(df.schema).option("header", True).csv(f"{folder}/{n}") for n, df in out.items()}
    corr = back["correlation"].select(F.lit("correlation").alias("name"), F.col("pair").alias("key"), "date", F.round("corr_63d", 6).alias("value"))
    kpis = back["kpi_snapshot"].select(
        F.lit("kpi_snapshot").alias("name"), F.col("ticker").alias("key"), F.col("last_date").alias("date"), F.col("last_close").alias("value"))
    return corr.unionByName(kpis)


@query("frontier_document", oracle(*_STATS, mv=_MV, points=_POINTS, sql=f"""
    SELECT {half_up('rho', 3)} AS corr, {half_up('mean_a * 100', 2)} AS ret_a, {half_up('risk_a * 100', 2)} AS risk_a,
      {half_up('mean_b * 100', 2)} AS ret_b, {half_up('risk_b * 100', 2)} AS risk_b, mv.w AS w_min, mv.ret AS ret_min, mv.risk AS risk_min,
      points.w, points.ret, points.risk, {WARN} :: DOUBLE AS vol_warn, {BREACH} :: DOUBLE AS vol_breach, 'Flag A' AS name_a
    FROM f1_stats, mv, points"""))
def frontier_document(spark, sf):
    """The written frontier and header, read back and spread by point."""
    run, folder = _market(spark, sf), scratch_path(spark, "dashboard")
    market.export_dashboard(run, _instruments(spark), folder)
    pair = "struct<ret: double, risk: double>"
    schema = f"corr double, assets map<string, {pair}>, points array<struct<w: int, ret: double, risk: double>>, min_var struct<w: double, ret: double, risk: double>"
    doc = spark.read.schema(schema).json(f"{folder}/frontier")
    head = spark.read.schema("vol_warn double, vol_breach double, commodities map<string, string>").json(f"{folder}/header")
    both = doc.unionByName(head, allowMissingColumns=True)  # one row each
    spread = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns]).select("*", F.explode("points").alias("p"))
    return spread.select(
        "corr", F.col("assets")[A]["ret"].alias("ret_a"), F.col("assets")[A]["risk"].alias("risk_a"),
        F.col("assets")[R]["ret"].alias("ret_b"), F.col("assets")[R]["risk"].alias("risk_b"),
        F.col("min_var.w").alias("w_min"), F.col("min_var.ret").alias("ret_min"), F.col("min_var.risk").alias("risk_min"),
        F.col("p.w").alias("w"), F.col("p.ret").alias("ret"), F.col("p.risk").alias("risk"),
        "vol_warn", "vol_breach", F.col("commodities")[A].alias("name_a"))
