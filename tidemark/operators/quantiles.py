"""Exact order statistics per group without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_statistics(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, Column],
    cells: tuple[float, ...],
) -> DataFrame:
    """One row per key with the values at the given 1-based ranks of the non-null values.

    `ranks` maps an output name to a column over `n`, the group's count. Values are
    first counted per distinct value (map-side combined, so a hot group arrives as
    counts). The rank is then narrowed cell by cell: `cells` are falling cell widths,
    and every running total spans one group's cells inside one cell of the level
    above, not the group's rows.
    """
    counts = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    )
    for level, width in enumerate(cells):
        # never NULL, so no level adds a null filter and all share one shuffle of the counts
        cell = F.coalesce(F.floor(F.col(value) / F.lit(width)), F.lit(0))
        counts = counts.withColumn(f"_c{level}", cell)
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("_stat"), rank.cast("bigint").alias("_rank"))
        for name, rank in ranks.items()
    ]))
    totals = Window.partitionBy(*keys) if keys else Window.partitionBy()
    scope = None
    for level in range(len(cells) + 1):
        path = [f"_c{i}" for i in range(level)]
        step = f"_c{level}" if level < len(cells) else value
        if scope is None:
            hist = counts.groupBy(*keys, step).agg(F.sum("_n").alias("_n"))
            hist = hist.withColumn("n", F.sum("_n").over(totals))
            hist = hist.select("*", wanted.alias("_w")).select(*keys, step, "_n", "_w.*")
        else:
            inside = counts.join(scope, [*keys, *path])
            hist = inside.groupBy(*keys, *path, "_stat", step).agg(
                F.sum("_n").alias("_n"), F.first("_rank").alias("_rank")
            )
        run = (
            Window.partitionBy(*keys, *path, "_stat").orderBy(step)
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        hist = hist.withColumn("_upto", F.sum("_n").over(run))
        before = F.col("_upto") - F.col("_n")
        scope = hist.where((before < F.col("_rank")) & (F.col("_rank") <= F.col("_upto"))).select(
            *keys, *path, step, "_stat", (F.col("_rank") - before).alias("_rank")
        )
    picks = [F.max(F.when(F.col("_stat") == name, F.col(value))).alias(name) for name in ranks]
    return scope.groupBy(*keys).agg(*picks)


def exact_median(
    df: DataFrame, keys: list[str], value: str, cells: tuple[float, ...], name: str
) -> DataFrame:
    """Median per key, the mean of the middle pair for even counts."""
    n = F.col("n")
    pair = order_statistics(
        df, keys, value,
        {"_low": F.floor((n + 1) / 2), "_high": F.floor(n / 2) + 1}, cells,
    )
    return pair.select(*keys, ((F.col("_low") + F.col("_high")) / 2).alias(name))


def upper_middle(
    df: DataFrame, keys: list[str], value: str, cells: tuple[float, ...], name: str
) -> DataFrame:
    """The upper of the middle pair, the entry at index n // 2 of the sorted values."""
    return order_statistics(df, keys, value, {name: F.floor(F.col("n") / 2) + 1}, cells)
