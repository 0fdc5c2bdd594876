"""The registry the driver reads, and the shared input views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suite.views import CTES, TABLES_OF, VIEWS
from tidemark.sources.tables import scan

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, folder, name)


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the shared input views, built by Spark from the given tables."""
    for base in TABLES_OF[name]:
        scan(spark, folder, base).createOrReplaceTempView(base)
    return spark.sql(VIEWS[name])


def oracle(*names: str, sql: str, **extra: str) -> str:
    """`sql` under the named shared views and any extra ones, in the order given."""
    parts = {n: CTES[n] for n in names} | extra
    if not parts:
        return sql
    return "WITH " + ", ".join(f"{n} AS ({body})" for n, body in parts.items()) + "\n" + sql


def half_up(value: str, digits: int) -> str:
    """DuckDB text rounding a double on its printed digits, ties away from 0, as Spark's round does."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"
