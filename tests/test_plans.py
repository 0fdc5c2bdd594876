"""Physical plans: what is shuffled, pushed down and kept off single tasks."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tests.conftest import SMALL
from tidemark.operators import explore, history, ordering, risk
from tidemark.plans import market

ROOT = Path(__file__).resolve().parent.parent
QUERIES = entry_module.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    spark = df.sparkSession
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_all_risk_windows_share_one_shuffle_and_sort(spark):
    bars = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(
        F.col("l_returnflag").alias("ticker"), F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("close"))
    text = plan_of(risk.risk_metrics(bars))
    assert text.count("Exchange") == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_one_ticker_report_reads_one_ticker(spark):
    bars = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(
        F.col("l_returnflag").alias("ticker"), F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("close"))
    text = formatted(market.q10_moving_average(bars, "A"))
    assert "EqualTo(l_returnflag,A)" in text
    assert re.search(r"ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp(_ntz)?>", text)


def test_facet_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    text = formatted(explore.facet_filter(orders, {"o_orderpriority": ["1-URGENT"], "o_orderstatus": []}).select("o_orderkey"))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text or "In(o_orderpriority" in text
    assert "o_totalprice" not in text.split("ReadSchema")[1]


def test_facet_counts_scan_once(spark):
    text = plan_of(explore.facet_counts(QUERIES["facet_filter"](spark, SMALL), ("source", "area")))
    assert text.count("FileScan parquet") <= 4  # orders, customer, nation, region
    assert "partial_count" in text


def test_caps_run_before_the_shuffle(spark):
    text = plan_of(ordering.cap_per_key(spark.range(1000).selectExpr("id", "id % 3 AS k"), ["k"], "id", 120))
    assert text.count("WindowGroupLimit") == 2


def test_first_per_key_is_a_partial_aggregate(spark):
    text = plan_of(ordering.first_per_key(spark.range(100).selectExpr("id", "id % 3 AS k"), ["k"], "id"))
    assert "partial_min_by" in text and "Window" not in text


def test_change_log_windows_see_days_not_sightings(spark):
    text = plan_of(history.change_log(spark.range(10).selectExpr("id", "id % 3 AS k", "current_date() AS d", "id AS v"), "k", "d", "id", "v"))
    window, aggregate = text.index("Window"), text.index("partial_")
    assert window < aggregate  # plans print top-down: the aggregate feeds the window


def _code(folder: str) -> str:
    return "\n".join(p.read_text() for p in (ROOT / folder).rglob("*.py"))


def test_library_cuts_lineage_only_in_the_shared_folder():
    code = _code("tidemark")
    for word in ("localCheckpoint", ".toPandas(", ".collect()", ".crossJoin(", "monotonically_increasing_id() <"):
        assert word not in code, word


def test_windows_name_their_partitions():
    """`Window.orderBy` alone is one task; it is only used on one row per shuffle partition."""
    lines = [line for line in _code("tidemark").splitlines() if "Window.orderBy" in line or "Window.partitionBy()" in line]
    assert len(lines) == 2, lines
