"""Near-duplicate groups by SimHash, with pigeonring filtering before the Hamming check.

The 64 bits lie on a ring of 16 segments. If two fingerprints differ in at most 3 bits, some
chain of consecutive segments starts with cumulative differences that stay within l * 3 / 16 for
every length l: none in the first five segments, one at most in the first ten, two at most in the
first fifteen. So each fingerprint is listed under its 16 chains of five segments (20 bits), and
only pairs of one list whose longer chains also stay within their budgets are compared in full.

Equal fingerprints are one node from the start. A list of any size is cut into blocks, and each
pair of blocks returns the spanning links of what it finds, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import batches, doc_texts, raw_texts, stage
from ._graph import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 16
WIDTH = 64 // SEGMENTS
EXACT = 5  # segments whose budget is below one difference
BLOCK = 2048  # fingerprints of one list that a task compares with those of one other block

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(raw: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """A hash of every run of `shingle` lower-cased words, repeats included; of all words if they are fewer."""
    words = raw.translate(_LOWER).split()
    if not words:
        return np.zeros(0, "<u8")
    text = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(text[a:b], SEED) for a, b in spans], "<u8")


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased words' shingles, repeats included; zero without words."""
    return print_of(shingle_hashes(raw, shingle))


def print_of(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes; zero without any."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and its fingerprint, a long with the unsigned value's bits."""

    def prints(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            found = np.array([fingerprint(x) for x in raw_texts(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found)], names=["doc_id", "fp"])

    return doc_texts(docs).mapInArrow(prints, "doc_id long, fp long")


def _budgets(max_bits: int) -> list[tuple[np.uint64, int]]:
    """For each whole budget below max_bits, the bits of the longest chain that has it."""
    out = []
    for budget in range(max_bits):
        length = max(l for l in range(1, SEGMENTS + 1) if l * max_bits // SEGMENTS == budget)
        out.append((np.uint64((1 << (length * WIDTH)) - 1), budget))
    return out


def ring(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The values turned so that segment `start` comes first."""
    by = (np.asarray(start) * WIDTH).astype(np.uint64)
    return np.where(by == 0, values, (values >> by) | (values << (np.uint64(64) - np.maximum(by, np.uint64(1)))))


def chains_hold(turned: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Whether the chains of differences from the first segment on stay within their budgets.

    Sums along a chain only grow, so the longest chain of each budget decides for all of them.
    """
    fits = np.ones(turned.shape, bool)
    for mask, budget in _budgets(max_bits):
        fits &= np.bitwise_count(turned & mask) <= budget
    return fits


def _near(turned: np.ndarray, max_bits: int) -> np.ndarray:
    fits = chains_hold(turned, max_bits)
    fits[fits] = np.bitwise_count(turned[fits]) <= max_bits
    return fits


def _spanning(values: np.ndarray, start: int, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over the values of one list that are near each other."""
    turned = ring(values, np.full(len(values), start))
    unseen, found = np.arange(len(values)), []
    while len(unseen) > 1:
        front, unseen = [int(unseen[0])], unseen[1:]
        while front and len(unseen):
            at = front.pop()
            near = _near(turned[unseen] ^ turned[at], max_bits)
            if near.any():
                new = unseen[near].tolist()
                unseen = unseen[~near]
                front += new
                found += [(int(values[at]), int(values[x])) for x in new]
    return found


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within `max_bits` of each other.

    `prints` has one long column fp. Pairs that other links already connect may be left out.
    """
    nodes = prints.select("fp").distinct()
    # the chain that starts at segment s: 20 bits of the ring, rotated to the front
    keys = [
        F.struct(
            F.lit(s).alias("start"),
            F.when(F.lit(s == 0), F.col("fp"))
            .otherwise(F.shiftrightunsigned("fp", s * WIDTH).bitwiseOR(F.shiftleft("fp", 64 - s * WIDTH)))
            .bitwiseAND(F.lit((1 << (EXACT * WIDTH)) - 1))
            .alias("chain"),
        )
        for s in range(SEGMENTS)
    ]
    listed = stage(nodes.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.start", "k.chain", "fp"), "lists")
    sizes = listed.groupBy("start", "chain").count().filter("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    member = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # block i of n meets every block j: the task (min, max) holds both
    partners = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.expr("filter(sequence(0, blocks - 1), j -> j <> own)")
    )
    met = (
        listed.join(sizes.select("start", "chain", blocks.alias("blocks")), ["start", "chain"])
        .withColumn("own", member)
        .withColumn("other", F.explode(partners))
        .select("start", "chain", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    key = ["start", "chain", "i", "j"]

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of their list; the last list of a batch waits for the next one."""
        ids, values = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)

        def search(ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            first = np.concatenate([[0], cuts]).astype(np.int64) if len(ids) else cuts
            spans = np.diff(np.append(first, len(ids)))
            at = first[spans == 2]  # by far the most lists
            x = ring(values[at] ^ values[at + 1], ids[at, 0]) if len(at) else values[at]
            at = at[_near(x, max_bits)]
            found = list(zip(values[at].tolist(), values[at + 1].tolist(), strict=True))
            for a, n in zip(first[spans > 2].tolist(), spans[spans > 2].tolist(), strict=True):
                found += _spanning(values[a : a + n], int(ids[a, 0]), max_bits)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, k]) for k in (0, 1)], names=["a", "b"])

        for b in rows:
            if not b.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]
            ids = np.concatenate([ids, np.stack(columns[:4], axis=1)])
            values = np.concatenate([values, columns[4].view(np.uint64)])
            changes = np.flatnonzero((ids != ids[-1]).any(axis=1))
            done = int(changes[-1]) + 1 if len(changes) else 0
            yield search(ids[:done], values[:done])
            ids, values = ids[done:], values[done:]
        yield search(ids, values)

    dealt = met.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def group_labels(prints: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """(doc_id, fp) to one row a fingerprint: fp, root, component_id; `near`: links (a, b), else those of `links`."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(prints) if near is None else near)
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id for each row of `docs`.

    component_id is the smallest doc_id that links of at most 3 differing bits reach, the row's
    own included; it is null only where all of them are null. Texts without words, null ones
    too, have fingerprint zero and are linked like any other. An empty table gives no rows.
    """
    prints = stage(fingerprints(docs), "prints")
    return prints.join(group_labels(prints), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, with one row of each group: that of the smallest doc_id.

    Of rows that repeat this doc_id in the group one stays, as of a group without any id. An empty
    table gives an empty one.
    """
    place = docs.columns.index("text")
    mark = "fp"
    while mark in docs.columns:
        mark += "_"
    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.LongType())])

    def marked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            found = np.array([fingerprint(x) for x in raw_texts(b.column(place))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found)], names=[*b.schema.names, mark])

    rows = stage(docs.mapInArrow(marked, schema), "marked")
    return one_a_group(rows, mark, docs.columns)


def one_a_group(rows: DataFrame, mark: str, columns: list[str], near: DataFrame | None = None) -> DataFrame:
    """`columns` of one row of each group of `rows`, whose column `mark` holds the nodes of the links `near`."""
    prints = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(mark).alias("fp"))
    labels = stage(group_labels(prints, near), "labels")
    stays = prints.join(labels, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = stage(stays.groupBy("root").agg(F.min("fp").alias("fp"), F.count(F.lit(1)).alias("n"), F.first("doc_id").alias("id")), "chosen")
    kept = rows.alias("r").join(
        chosen.alias("c"), (F.col(f"r.{mark}") == F.col("c.fp")) & F.col("r.doc_id").cast("long").eqNullSafe(F.col("c.id"))
    )
    own = [F.col(f"r.{c}") for c in columns]
    once = kept.filter("c.n = 1").select(*own)
    again = kept.filter("c.n > 1").dropDuplicates([mark]).select(*own)
    return once.union(again)


def fingerprint_hex(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
