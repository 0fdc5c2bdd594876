"""What several operators share: table access, written stages and Arrow helpers."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space of all word and normalisation rules: blank and the control range tab to return.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of rows that `short_batches` lets a Python step have at once.
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read again: lineage ends here, nothing is cached."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Python steps that are run inside get Arrow batches of about `ARROW_BYTES`, and all rows as before.

    Spark counts rows alone unless told otherwise: 10 000 texts, or pairs of shingle sets, are tens of MB,
    which a task holds several times in the JVM, outside its heap, and again in Python. What the
    session itself has set stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, ARROW_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(name)


def sweep(spark: SparkSession) -> None:
    """Shuffle files of plans that are done and let go are removed: else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def swept(df: DataFrame, name: str) -> DataFrame:
    """`stage`, without what stages before it have shuffled."""
    sweep(df.sparkSession)
    return stage(df, name)


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id and whole text; a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every value of a string column."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batches(rows: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes, so that long texts do not pile up."""
    for batch in rows:
        n = batch.num_rows
        if n == 0:
            continue
        step = max(1, int(n * limit / max(batch.nbytes, 1)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of unsigned 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pieces(raw: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The whole text in parts of about `size` bytes that end before white space."""
    at, n = 0, len(raw)
    while n - at > size:
        end = min((x for x in (raw.find(w, at + size) for w in (b" ", b"\n", b"\t", b"\r")) if x >= 0), default=n)
        yield raw[at:end]
        at = end
    yield raw[at:] if at else raw


def bit_filter(slots: DataFrame, bits: int) -> bytes:
    """A bit for each value of the long column `slot`, all in 0 .. 2^bits - 1.

    Tasks build the words of the filter; the driver gets at most 2^bits / 32768 rows of 4 KB,
    whatever the size of the input.
    """
    # bitmap functions count from one
    shifted = slots.select((F.col("slot") + 1).alias("slot"))
    words = shifted.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = bytearray(((1 << bits) // 8) + 8192)
    for row in words.toLocalIterator():
        at = (row.bucket - 1) * 4096
        out[at : at + 4096] = row.bits
    return bytes(out)


def _kept() -> dict:
    """What this Python worker keeps: functions reach a task as copies of their own, so the place must be one that outlives them."""
    return vars(sys.modules.setdefault("_tidemark_worker", ModuleType("_tidemark_worker")))


def let_go() -> None:
    """Drop what an earlier stage's `per_worker` keeps."""
    kept = _kept()
    if others := [x for x in kept if not x.startswith("__")]:
        for other in others:
            del kept[other]
        gc.unfreeze()
        gc.collect()  # what is let go may refer to itself


def per_worker(name: str, make: Callable, large: bool = False):
    """What `make` returns, once for each Python worker: a cache that its later tasks find filled.

    A worker keeps one such thing: it lives on with later stages, which have memory of their own to fill.
    Python's garbage collection, which Spark asks for after each task, leaves out what is kept if that is
    `large`: it would go through all of it.
    """
    kept = _kept()
    if name not in kept:
        let_go()
        kept[name] = make()
        if large:
            gc.freeze()
    return kept[name]
