"""Joining rows to a lookup table whose size is measured first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settle

MAX_BROADCAST_BYTES = 64 << 20
#: What a value that is no text, and each row, may take in a hash table.
VALUE_BYTES, ROW_BYTES = 16, 32


def _row_bytes(table: DataFrame) -> Column:
    texts = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if isinstance(f.dataType, T.StringType | T.BinaryType)
        else F.octet_length(F.to_json(F.array(F.col(f.name)))) if isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType)
        else F.lit(0)
        for f in table.schema.fields
    ]
    return reduce(lambda a, b: a + b, texts, F.lit(ROW_BYTES + VALUE_BYTES * len(texts)).cast("bigint"))


def byte_size(table: DataFrame) -> int:
    """Bytes of all rows, as an upper estimate of what a broadcast of them holds."""
    return table.agg(F.coalesce(F.sum(_row_bytes(table)), F.lit(0)).alias("n")).first()["n"]


def sized(table: DataFrame, n_bytes: int, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The table, marked for broadcast when its measured bytes allow it.

    Beyond the limit the join shuffles both sides and adaptive execution splits
    the partition of a hot key.
    """
    return F.broadcast(table) if n_bytes <= limit else table


def measured(table: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Settles a lookup table, measures it and marks it accordingly.

    Knowing the size before planning spares the large side the shuffle that
    adaptive execution would only find unnecessary afterwards.
    """
    stable = settle(table)
    return sized(stable, byte_size(stable), limit)
