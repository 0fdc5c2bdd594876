"""Parquet tables in and out, flat files and JSON documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Replace each named table under `folder`. Never a folder the same plan reads from."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store a keyed base clustered on its key, so a later upsert only shuffles the batch."""
    (
        df.repartition(buckets, key).write.mode("overwrite")
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )


def export_csv(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def series_documents(metrics: DataFrame) -> DataFrame:
    """Per ticker one JSON document of date-ordered, display-rounded arrays.

    An array holds one entry per bar of its ticker, so the calendar bounds it.
    """
    point = F.struct(
        F.col("date").cast("string").alias("date"),
        F.round("close", 2).alias("close"),
        F.round(F.col("vol_21d") * 100, 1).alias("vol_21d"),
        F.round("ma50", 2).alias("ma50"),
        F.round("ma200", 2).alias("ma200"),
    )
    rows = metrics.groupBy("ticker").agg(F.sort_array(F.collect_list(point)).alias("points"))
    return rows.select(
        "ticker",
        F.to_json(
            F.struct(*[
                F.col(f"points.{c}").alias("dates" if c == "date" else c)
                for c in ("date", "close", "vol_21d", "ma50", "ma200")
            ]),
            {"ignoreNullFields": "false"},
        ).alias("document"),
    )


def export_series_json(
    metrics: DataFrame,
    kpis: DataFrame,
    frontier: DataFrame,
    correlation: DataFrame,
    folder: str,
    header: DataFrame | None = None,
) -> None:
    """Series, key figures, frontier and correlation (3 decimals), and a header if given, as JSON lines."""
    if header is not None:
        header.write.mode("overwrite").json(f"{folder}/header")
    series_documents(metrics).write.mode("overwrite").json(f"{folder}/series")
    kpis.write.mode("overwrite").json(f"{folder}/kpis")
    frontier.write.mode("overwrite").json(f"{folder}/frontier")
    rounded = correlation.select("pair", "date", F.round("corr_63d", 3).alias("value"))
    rounded.write.mode("overwrite").json(f"{folder}/corr")
