"""Near copies by the exact similarity of their word shingles, candidates by SimHash and banded minimum hashes.

Two texts are near copies if the Jaccard similarity of their sets of five-word shingles is 0.8 or
more. Texts whose SimHash fingerprints of these shingles differ in at most 3 of 64 bits are
candidates: pigeonring filtering finds links that connect them all (`simhash.links`). At 0.8 about 10
bits differ, so texts that agree in the minima of all hashes of one band are candidates too: with 32 bands of
5, a pair of similarity s is none with a chance of (1 - s^5)^32, 3e-6 at 0.8 and 5e-13 at 0.9.
Every candidate pair is confirmed by the whole sets of 64-bit shingle hashes, so no pair below the
bound is linked.

Texts of the same words are one node from the start. A list of candidates is first compared with
one member a turn, which joins most of a large group; then all pairs of the lists that
still hold several groups are compared, by blocks, and only spanning links are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import batches, let_go, mix64, raw_texts, short_batches, stage
from ._graph import components
from .simhash import _LOWER, MAX_BITS, links, one_a_group, print_of, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
DEPTH = 5
PIVOTS = 2  # turns in which a list is compared with one of its members
BLOCK = 512  # members of one list that a task compares with those of one other block
SLICE = 4096  # shingles whose holders are multiplied at once

_FACTORS = mix64(np.arange(1, BANDS * DEPTH + 1)) | np.uint64(1)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key of each band; a set of shingles alone decides it."""
    lows = np.full(BANDS * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        lows = np.minimum(lows, (hashes[at : at + 512, None].astype(np.uint64) * _FACTORS).min(axis=0))
    lows = lows.reshape(BANDS, DEPTH)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(DEPTH):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + lows[:, k])
    return keys.view(np.int64)


def words_hash(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(raw.translate(_LOWER).split()))


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Of two sets of hashes, each in order and without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets, by (node, hashes), are as similar."""

    def check(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            left, right = (c.to_numpy(zero_copy_only=False) for c in b.columns[:2])
            both = zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)
            near = np.array([similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), similarity) for x, y in both], bool)
            yield pa.RecordBatch.from_arrays([pa.array(c[near]) for c in (left, right)], names=["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a"))
    two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "hashes_a", "hashes_b").mapInArrow(check, "a long, b long")


def spanning(nodes: list[int], roots: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that connect all similar sets of one list which `roots` does not connect yet."""
    sizes = np.array([len(x) for x in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(flat, return_inverse=True, return_counts=True)
    # what one set alone has is in no intersection
    shared = held[column] > 1
    row, column = row[shared], (np.cumsum(held > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = int((held > 1).sum())
    for at in range(0, width, SLICE):
        part = slice(*np.searchsorted(column, [at, at + SLICE]))
        has = np.zeros((len(sets), min(SLICE, width - at)), np.float32)
        has[row[part], column[part] - at] = 1
        both += has @ has.T
    near = np.triu(both >= similarity * (sizes[:, None] + sizes - both.astype(np.float64)) - 1e-9, 1)
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    found = []
    for x, y in np.argwhere(near).tolist():
        p, q = top(roots[x]), top(roots[y])
        if p != q:
            up[p] = q
            found.append((nodes[x], nodes[y]))
    return found


def compared(lists: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) within lists of (key, n, node, root), n being the list's length; every pair meets in some cell of blocks."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    partners = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.expr("filter(sequence(0, blocks - 1), j -> j <> own)"))
    dealt = lists.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(partners)).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root"
    )
    cell = ["key", "i", "j"]

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of their cell."""
        now, nodes, roots, held = None, [], [], []

        def search() -> pa.RecordBatch:
            pairs = np.array(spanning(nodes, roots, held, similarity) if len(nodes) > 1 else [], np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, k]) for k in (0, 1)], names=["a", "b"])

        for b in batches(rows):
            for *at, node, root, hashes in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != now:
                    yield search()
                    now, nodes, roots, held = at, [], [], []
                nodes.append(node)
                roots.append(root)
                held.append(np.frombuffer(hashes, "<u8"))
        yield search()

    met = dealt.join(sets, "node").select(*cell, "node", "root", "hashes")
    return met.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(compare, "a long, b long").distinct()


def near_links(members: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(key, node) of the lists to links (a, b) that connect all similar pairs that share a list."""
    found = members.sparkSession.createDataFrame([], "a long, b long")
    for turn in range(PIVOTS + 1):
        now = members.withColumn("root", F.col("node"))
        if turn:
            roots = stage(components(found), "roots")
            now = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        # a list whose members are all in one group has nothing left to find
        order = F.xxhash64("node", F.lit(turn))
        lists = now.groupBy("key").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"),
            F.min_by(F.struct("node", "root"), order).alias("p"),
        ).filter("low < high")
        # of two members the first turn has compared both
        lists = lists.filter("n > 2") if turn else lists
        met = now.join(lists.select("key", "n", F.col("p.node").alias("other"), F.col("p.root").alias("other_root")), "key")
        if turn == PIVOTS:
            near = compared(met.select("key", "n", "node", "root"), sets, similarity)
        else:
            pairs = met.filter("root <> other_root").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            near = confirmed(pairs.distinct(), sets, similarity)
        found = found.union(stage(near, "near"))
    return found


def print_pairs(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(node, fp) to pairs (a, b) of nodes that connect all whose fingerprints differ in at most `max_bits`."""
    heads = stage(prints.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    same = prints.join(heads, "fp").filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    near = links(heads, max_bits).join(heads.select(F.col("fp").alias("a"), F.col("head").alias("one")), "a")
    near = near.join(heads.select(F.col("fp").alias("b"), F.col("head").alias("two")), "b")
    return same.union(near.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"))).distinct()


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs`, all columns, with one row of each group: that of the smallest doc_id.

    Groups are what links of at least `similarity` connect; texts without words, null ones too,
    are one group. Of rows that repeat the smallest doc_id in the group one stays, as of a group
    without any id. An empty table gives an empty one.
    """
    place = docs.columns.index("text")
    mark, bands, fp = "node", "bands", "fp"
    while {mark, bands, fp} & set(docs.columns):
        mark, bands, fp = mark + "_", bands + "_", fp + "_"
    schema = T.StructType([
        *docs.schema.fields, T.StructField(mark, T.LongType()), T.StructField(bands, T.ArrayType(T.LongType())), T.StructField(fp, T.LongType())
    ])

    def marked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # of a model's caches, say
        for b in batches(rows):
            raws = raw_texts(b.column(place))
            nodes = np.array([words_hash(x) for x in raws], np.uint64).view(np.int64)
            hashes = [shingle_hashes(x, shingle) for x in raws]
            keys = [band_keys(h) if len(h) else np.zeros(0, np.int64) for h in hashes]
            prints = np.array([print_of(h) for h in hashes], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(nodes), pa.array(keys, pa.list_(pa.int64())), pa.array(prints)], names=[*b.schema.names, mark, bands, fp]
            )

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            found = [np.unique(shingle_hashes(x, shingle)).tobytes() for x in raw_texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["node", "hashes"])

    with short_batches(docs.sparkSession):
        rows = stage(docs.mapInArrow(marked, schema), "marked")
        listed = rows.select(F.col(mark).alias("node"), F.explode(bands).alias("key"))
        shared = listed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("key")
        members = stage(listed.join(shared, "key").select("key", "node").distinct(), "members")
        pairs = stage(print_pairs(rows.select(F.col(mark).alias("node"), F.col(fp).alias("fp"))), "pairs")
        nodes = members.select("node").union(pairs.select("a")).union(pairs.select("b"))
        asked = nodes.select(F.col("node").alias(mark)).distinct()
        texts = rows.select(mark, "text").join(asked, mark, "left_semi").dropDuplicates([mark])
        sets = stage(texts.mapInArrow(hashed, "node long, hashes binary"), "sets")
        near = near_links(members, sets, similarity).union(stage(confirmed(pairs, sets, similarity), "near-prints"))
    return one_a_group(rows, mark, docs.columns, near)
