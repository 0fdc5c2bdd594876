"""First, latest and top rows per key, global positions and pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

_LOCAL_BITS = 33  # low bits of monotonically_increasing_id count rows inside a partition


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest `order` per key.

    Keys and orders alone are aggregated, one row per key and order from each map task however hot
    the key is. Whole rows then pass a hash join with the first orders and are never sorted; only
    where rows share a key's first order is one of them picked by an aggregate over whole rows.
    """
    counted = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"))
    first = counted.groupBy(*keys).agg(F.min(order).alias("_first"), F.min_by("_n", order).alias("_n"))
    first = first.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first", "_n").hint("shuffle_hash")
    same = reduce(Column.__and__, [F.col(f"_k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)])
    # a key without any order keeps its row, with nothing else in it
    met = first.join(df, same & (F.col("_first") == F.col(order)), "left")
    row = [F.col(f"_k{keys.index(c)}").alias(c) if c in keys else F.col(c) for c in df.columns]
    once = met.where(F.coalesce("_n", F.lit(1)) == 1).select(*row)
    rest = [c for c in df.columns if c not in keys]
    tied = met.where(F.col("_n") > 1).select(*row)
    tied = tied.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
    return once.unionByName(tied.select(*keys, "_row.*").select(*df.columns))


def last_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row with the largest `order` per key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def cap_per_key(df: DataFrame, keys: list[str], order: str, limit: int) -> DataFrame:
    """The first `limit` rows per key; the rank filter also runs before the shuffle."""
    ranked = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(ranked)).where(F.col("_rn") <= limit).drop("_rn")


def with_position(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """0-based place of every row in a total order, without a one-partition window.

    Range-partitioned sort, settled in the shared folder; a row's place is its
    offset in its partition plus the sizes of the partitions before it. Only the
    partition sizes, one row per shuffle partition, pass through a single task.
    """
    stable = settle(df.orderBy(*order))
    marked = stable.withColumn("_mark", F.monotonically_increasing_id())
    part = F.shiftright("_mark", _LOCAL_BITS).alias("_part")
    local = F.col("_mark").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    sizes = marked.groupBy(part).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    placed = marked.select("*", part, local.alias("_local")).join(F.broadcast(starts), "_part")
    return placed.select(*df.columns, (F.col("_start") + F.col("_local")).alias(name))


def page_slice(df: DataFrame, order: list[Column], page: int, size: int = 40) -> DataFrame:
    """Page `page` (from 0) of the ordered rows; meant for the bounded served rows."""
    return df.orderBy(*order).offset(page * size).limit(size)


def last_n_per_key(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The newest `n` rows per key."""
    ranked = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(ranked)).where(F.col("_rn") <= n).drop("_rn")
