"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stage


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(a long, b long) to (node, root): root is the smallest node that the node can reach.

    Nodes without an edge to another are left out. Large and small star steps take turns until
    the edges stop changing; every step ends in the shared folder. A node's neighbours are only
    reduced to their minimum, never gathered, so one node may hold any share of the edges.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now = stage(now, "edges")
    seen = _summary(now)
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: every larger neighbour of a node is tied to the smallest one around it
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.filter("a <> b").distinct(), "edges")
        # small star: a node and its smaller neighbours are tied to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        ties = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(ties.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        was, seen = seen, _summary(now)
        if was == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
