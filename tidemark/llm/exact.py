"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks whose polynomial hashes are computed side by side and joined by
length-shifted arithmetic: hash(a + b) = hash(a) * B^len(b) + hash(b). Texts with one fingerprint
and length are then compared chunk by chunk, so a collision never merges different texts.

Rows are dealt by ranges of (fingerprint, doc_id): a group of any size is spread over as many
tasks as it needs, each task streams its rows in order holding one text per class, and what the
tasks found for a group that crosses their borders is settled by the first text of each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batches, bit_filter, doc_texts, raw_texts, stage

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 742_938_285)
CHUNK = 4096  # bytes; 2^12 * 2^8 * 2^31 stays below 2^53, so float dot products are exact
COMPARE = 1 << 16
FILTER_BITS = 26  # a filter of 8 MB at any size of input

_SPACES = bytes(32 if b in b" \t\n\v\f\r" else b for b in range(256))


def _powers() -> np.ndarray:
    out = np.empty((CHUNK, len(BASES)))
    for k, base in enumerate(BASES):
        value = 1
        for i in range(CHUNK - 1, -1, -1):
            out[i, k] = value
            value = value * base % PRIME
    return out


_POWERS = _powers()
_SHIFT = tuple(pow(base, CHUNK, PRIME) for base in BASES)


def normalise(raw: bytes) -> bytes:
    """Every run of white space becomes one blank."""
    text = raw.translate(_SPACES)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def fingerprint(raw: bytes) -> tuple[int, int]:
    """Both polynomial hashes of the bytes; zero for none."""
    n = len(raw)
    if n == 0:
        return 0, 0
    count = -(-n // CHUNK)
    cells = np.zeros(count * CHUNK)
    cells[count * CHUNK - n :] = np.frombuffer(raw, np.uint8)  # leading zeros add nothing
    parts = (cells.reshape(count, CHUNK) @ _POWERS) % PRIME
    if count == 1:
        return int(parts[0, 0]), int(parts[0, 1])
    out = [0, 0]
    for row in parts.astype(np.int64).tolist():
        for k in (0, 1):
            out[k] = (out[k] * _SHIFT[k] + row[k]) % PRIME
    return out[0], out[1]


def join_prints(left: tuple[int, int], right: tuple[int, int], right_length: int) -> tuple[int, int]:
    """The fingerprint of two texts in a row, from theirs and the length of the second."""
    a, b = (
        (x * pow(base, right_length, PRIME) + y) % PRIME
        for x, y, base in zip(left, right, BASES, strict=True)
    )
    return a, b


def combine(parts: DataFrame) -> DataFrame:
    """Fingerprints of documents that come in pieces: (key, part_no, body) to (key, n_bytes, h1, h2).

    Each piece is hashed where it lies; only lengths and hashes are shuffled, and the shifted
    hashes add up in any order. Pieces without rows count as empty; a null body is empty.
    """
    schema = "key long, part_no long, n long, h1 long, h2 long"

    def hashes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            bodies = [x or b"" for x in b.column(2).to_pylist()]
            prints = [fingerprint(x) for x in bodies]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(list(map(len, bodies)), pa.int64())]
                + [pa.array([p[k] for p in prints], pa.int64()) for k in (0, 1)],
                names=["key", "part_no", "n", "h1", "h2"],
            )

    chosen = parts.select(
        F.col("key").cast("long"), F.col("part_no").cast("long"), F.col("body").cast("binary")
    )
    hashed = stage(chosen.mapInArrow(hashes, schema), "parts")
    # the hash of the whole is a fold from the left over (length, hash); one short array a document
    folded = hashed.groupBy("key").agg(
        F.sum("n").alias("n_bytes"), F.sort_array(F.collect_list(F.struct("part_no", "n", "h1", "h2"))).alias("p")
    )

    def fold(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            out = []
            for pieces in b.column(2).to_pylist():
                whole = (0, 0)
                for p in pieces:
                    whole = join_prints(whole, (p["h1"], p["h2"]), p["n"])
                out.append(whole)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1)] + [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)],
                names=["key", "n_bytes", "h1", "h2"],
            )

    return folded.mapInArrow(fold, "key long, n_bytes long, h1 long, h2 long")


def _slot(n, a, b):
    """The bit of the filter that a fingerprint falls on; the same rule in tasks and columns."""
    return (a * 31 + b * 7 + n) % (1 << FILTER_BITS)


def _repeated(docs: DataFrame) -> bytes:
    """A bit for each fingerprint that several rows share (others may share a bit: no harm)."""

    def prints(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            bodies = [normalise(x) for x in raw_texts(b.column(0))]
            found = [fingerprint(x) for x in bodies]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(len, bodies)), pa.int64())]
                + [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)],
                names=["n", "h1", "h2"],
            )

    counted = docs.select("text").mapInArrow(prints, "n long, h1 long, h2 long").groupBy("n", "h1", "h2").count()
    slot = _slot(F.col("n"), F.col("h1"), F.col("h2"))
    return bit_filter(counted.filter("count > 1").select(slot.alias("slot")), FILTER_BITS)


_ROW = "doc_id long, n long, h1 long, h2 long, sha string, body binary"
_CLASS = "doc_id long, n long, h1 long, h2 long, sha string, leader long, nth long, body binary"


def _equal(a: bytes, b: bytes) -> bool:
    left, right = memoryview(a), memoryview(b)
    return len(a) == len(b) and all(
        left[i : i + COMPARE] == right[i : i + COMPARE] for i in range(0, len(a), COMPARE)
    )


def _classes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (fingerprint, doc_id): each gets the first row with the same text.

    Of the first and the last fingerprint of a task the leaders keep their text, since their
    groups may go on in other tasks; of one fingerprint only different texts are held.
    """
    key, leaders, first = None, [], True
    # rows of the open group that lead a class, held back until it is known whether the task ends here
    held: list[tuple] = []
    out: list[tuple] = []

    def table_of(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.int64()] * 2 + [pa.binary()]
        names = ["doc_id", "n", "h1", "h2", "sha", "leader", "nth", "body"]
        columns = zip(*found, strict=True) if found else [[]] * 8
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for b in batches(rows):
        for doc, n, h1, h2, sha, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if body is None:  # nothing shares its fingerprint
                out.append((doc, n, h1, h2, sha, doc, 0, None))
                continue
            if key != (n, h1, h2):
                out += held if first else [(*x[:7], None) for x in held]
                first = first and key is None
                key, leaders, held = (n, h1, h2), [], []
            for x in leaders:
                if _equal(x[1], body):
                    x[2] = x[2] + 1 if x[3] == doc else 0
                    x[3] = doc
                    out.append((doc, n, h1, h2, sha, x[0], x[2], None))
                    break
            else:
                leaders.append([doc, body, 0, doc])
                held.append((doc, n, h1, h2, sha, doc, 0, body))
        if out:
            yield table_of(out)
            out = []
    yield table_of(out + held)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, n_bytes, text_sha256.

    Texts are equal when their bytes agree after each run of white space became one blank. The
    row with the smallest doc_id stays. Rows that repeat a doc_id with an equal text count in the
    group; one of them is kept. A null text is empty, a null doc_id comes after all others, an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = doc_texts(docs)
    wanted = spark.sparkContext.broadcast(_repeated(texts))

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for b in batches(source):
            out = []
            for doc, raw in zip(b.column(0).to_pylist(), raw_texts(b.column(1)), strict=True):
                body = normalise(raw)
                n, (h1, h2) = len(body), fingerprint(body)
                at = _slot(n, h1, h2)
                shared = bits[at >> 3] >> (at & 7) & 1
                out.append((doc, n, h1, h2, hashlib.sha256(body).hexdigest(), body if shared else None))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                names=["doc_id", "n", "h1", "h2", "sha", "body"],
            )

    order = [F.col("n"), F.col("h1"), F.col("h2"), F.col("doc_id").asc_nulls_last()]
    dealt = texts.mapInArrow(rows, _ROW).repartitionByRange(*order).sortWithinPartitions(*order)
    classes = stage(dealt.mapInArrow(_classes, _CLASS), "classes")

    # leaders of groups at the border of a task: at most two groups a task
    edge = classes.filter("body IS NOT NULL").select("doc_id", "n", "h1", "h2", "sha", "body")
    merged = edge.repartition("n", "h1", "h2").sortWithinPartitions(*order).mapInArrow(_classes, _CLASS)
    moved = merged.select("n", "h1", "h2", F.col("doc_id").alias("leader"), F.col("leader").alias("first_id")).filter(
        "NOT (leader <=> first_id)"
    )
    same = (F.col("c.n") == F.col("m.n")) & (F.col("c.h1") == F.col("m.h1")) & (F.col("c.h2") == F.col("m.h2"))
    settled = (
        classes.drop("body")
        .alias("c")
        .join(F.broadcast(moved).alias("m"), same & F.col("c.leader").eqNullSafe(F.col("m.leader")), "left")
        .select(
            "c.doc_id", "c.n", "c.h1", "c.h2", "c.sha", "c.nth",
            F.when(F.col("m.n").isNull(), F.col("c.leader")).otherwise(F.col("m.first_id")).alias("keep_id"),
        )
    )
    sizes = settled.groupBy("n", "h1", "h2", "keep_id").agg(F.count(F.lit(1)).alias("group_size"))
    both = [F.col(f"s.{c}").eqNullSafe(F.col(f"g.{c}")) for c in ("n", "h1", "h2", "keep_id")]
    return (
        settled.alias("s")
        .join(sizes.alias("g"), both, "left")
        .select(
            "s.doc_id", "s.keep_id", "g.group_size",
            (F.col("s.doc_id").eqNullSafe(F.col("s.keep_id")) & (F.col("s.nth") == 0)).alias("kept"),
            F.col("s.n").alias("n_bytes"), F.col("s.sha").alias("text_sha256"),
        )
    )
