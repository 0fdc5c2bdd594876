"""Repeated passages by longest-previous-factor arrays.

A byte belongs to a repeat if a string of `LENGTH` bytes around it starts elsewhere too: if the
longest previous factor of that start (the most bytes that also start further ahead in the corpus)
has `LENGTH` bytes, or its longest following factor. In suffix order, equal strings in order of
position, a start shares its longest previous factor with the previous or the next smaller
position (`factors`). Keeping the first copy removes only the starts with a previous factor.

Sorting every suffix of a corpus would shuffle it many times over. Strings of `LENGTH` bytes are
first grouped by an anchor: the `GRAM` bytes in them with the least hash. Equal strings have equal
anchors, and neighbouring starts share theirs, so a run of starts is one row and an anchor's runs
hold all that can equal each other. Runs whose bytes are all equal are settled together by two
64-bit hashes (of the anchor, and of the run); of those that share an anchor but not all bytes the
suffixes are put in order, byte by byte, and their factors computed. Anchors with more than `HOT`
different runs are cut into slices that the cluster groups, by two 64-bit hashes a string. Two
different strings are taken for equal with a chance of about pairs / 2^128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batches, bit_filter, raw_texts, short_batches, sweep, swept

LENGTH = 200
GRAM = 32
SEGMENT = 1 << 18  # starts looked at together
HOT = 512  # different runs of one anchor, beyond which they are cut into slices
SLICE = 8  # starts
FILTER_BITS = 27  # a filter of 16 MB at any size of input
DOC_BITS = 26

_rng = np.random.default_rng(20240229)
#: Two random words for each byte value, and an odd multiplier for each of the two hashes.
_BYTES = _rng.integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLIER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_INVERSE = np.array([pow(int(m), -1, 1 << 64) for m in _MULTIPLIER], np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Prefixes:
    """Hashes of any substring of some bytes, from prefix sums modulo 2^64.

    prefix[i] is the sum of value(byte j) * base^j for j < i; a difference times base^-start does
    not depend on where the substring stands.
    """

    up = [_powers(m, SEGMENT + 4 * LENGTH) for m in _MULTIPLIER]
    down = [_powers(m, SEGMENT + 4 * LENGTH) for m in _INVERSE]

    def __init__(self, raw: np.ndarray, which: int = 0):
        self.which = which
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[which][raw] * self.up[which][: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.down[self.which][start]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return x

    def all(self, length: int) -> np.ndarray:
        """Of every substring of `length` bytes."""
        x = (self.sums[length:] - self.sums[:-length]) * self.down[self.which][: len(self.sums) - length]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return x


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by running minima of blocks from both sides."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs(raw: np.ndarray) -> list[np.ndarray]:
    """Runs of starts with one anchor: anchor hash, hash of the run's bytes, first start, number of starts.

    `raw` holds the bytes of one segment; starts are those with LENGTH bytes in it. The run's
    bytes go from its first start to LENGTH behind the last; the hash also covers their number
    and where the anchor stands among them.
    """
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    prefix = Prefixes(raw)
    grams = prefix.all(GRAM)
    # the place in the low bits: of equal high bits the leftmost wins, whatever stands around
    low = np.uint64((1 << 22) - 1)
    keys = grams & ~low | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least(keys, LENGTH - GRAM + 1) & low).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    count = np.diff(np.append(first, n))
    at = anchor[first]
    place = (at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    size = count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return [grams[at], prefix.of(first, first + count - 1 + LENGTH) ^ place ^ size, first, count]


def document_runs(raw: bytes) -> list[np.ndarray]:
    """The runs of a whole text, segment by segment; starts count from its first byte."""
    data, out = np.frombuffer(raw, np.uint8), []
    for at in range(0, max(1, len(data) - LENGTH + 1), SEGMENT):
        found = runs(data[at : at + SEGMENT + LENGTH - 1])
        found[2] = found[2] + at
        out.append(found)
    return [np.concatenate(x) for x in zip(*out, strict=True)] if len(out) > 1 else out[0]


def suffix_order(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at `starts` in order of their first LENGTH bytes, equal ones by place.

    `starts` ascend and have LENGTH bytes behind them. Returned are the numbers of the starts in
    that order, and how many bytes (at most LENGTH) each shares with the one before it. Ranks of
    the first 8 bytes come from the bytes themselves, ranks of twice as many from pairs of ranks,
    so what is found equal is equal byte by byte.
    """
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(2 * LENGTH, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + n]
    levels: dict[int, np.ndarray] = {}
    width = 8
    while True:
        rank = np.zeros(n + LENGTH, np.uint32)  # what lies behind the end is never decisive
        rank[:n] = np.unique(key, return_inverse=True)[1]
        levels[width] = rank
        if 2 * width > LENGTH:
            break
        key = rank[:n].astype(np.uint64) << np.uint64(32) | rank[width : width + n]
        width *= 2
    whole = rank[starts].astype(np.uint64) << np.uint64(32) | rank[starts + LENGTH - width]
    order = np.argsort(whole, kind="stable")
    shared = np.zeros(len(starts), np.int64)
    if len(starts) < 2:
        return order, shared
    one, two = starts[order[:-1]], starts[order[1:]]
    length = np.zeros(len(one), np.int64)
    for width in sorted(levels, reverse=True):
        length += width * (levels[width][one + length] == levels[width][two + length])
    for _ in range(7):
        length += padded[one + length] == padded[two + length]
    shared[1:] = np.where(whole[order[:-1]] == whole[order[1:]], LENGTH, length)
    return order, shared


def _smaller(place: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """Bytes shared with the nearest suffix ahead, in suffix order, that has a smaller place.

    Each suffix points one ahead and jumps along the pointers until the place there is smaller;
    all that is jumped over has greater places. Below `least` shared bytes it stops: no more
    will be shared further ahead.
    """
    at, got = np.arange(len(place)) - 1, shared.copy()
    got[:1] = 0
    going = np.flatnonzero(got >= max(least, 1))
    while len(going := going[place[at[going]] > place[going]]):
        via = at[going]
        at[going], got[going] = at[via], np.minimum(got[going], got[via])
        going = going[(at[going] >= 0) & (got[going] >= max(least, 1))]
    return got


def factors(order: np.ndarray, shared: np.ndarray, later: bool = False, least: int = 0) -> np.ndarray:
    """Longest previous factor of each start: bytes, at most LENGTH, that also start further ahead.

    They are shared with the previous or with the next smaller position in suffix order. With
    `later` the longest following factor: smaller positions counted from the end. Lengths below
    `least` may be given as any number below it.
    """
    place = -order if later else order
    behind = np.append(shared[1:], 0)[::-1]
    longest = np.maximum(_smaller(place, shared, least), _smaller(place[::-1], behind, least)[::-1])
    out = np.zeros(len(order), np.int64)
    out[order] = longest
    return out


def _flagged(bodies: list[bytes], first_copy: bool) -> list[tuple[int, int, int]]:
    """(number of the body, first start, last start) of stretches of starts that are repeats."""
    sizes = np.array(list(map(len, bodies)), np.int64)
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    inside = np.concatenate([np.arange(a, z - LENGTH + 1) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)])
    order, shared = suffix_order(flat, inside)
    hit = factors(order, shared, least=LENGTH) >= LENGTH
    if not first_copy:
        hit |= factors(order, shared, later=True, least=LENGTH) >= LENGTH
    owner = np.repeat(np.arange(len(bodies)), sizes - LENGTH + 1)
    at = np.flatnonzero(hit)
    if not len(at):
        return []
    cut = np.flatnonzero((np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])) + 1
    begin, end = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
    own = owner[begin]
    return list(zip(own.tolist(), (inside[begin] - starts[own]).tolist(), (inside[end] - starts[own]).tolist(), strict=True))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tag and text: rows with one doc_id but different texts differ in their tag."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        F.hash("doc_id", "text").alias("tag"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _repeated_anchors(texts: DataFrame) -> bytes:
    """A filter of the anchors that occur more than once (and of others that share their bits)."""

    def anchors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            found, n = np.unique(np.concatenate([document_runs(x)[0] for x in raw_texts(b.column(0))]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    counted = texts.select("text").mapInArrow(anchors, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    slot = F.shiftrightunsigned("anchor", 64 - FILTER_BITS)
    return bit_filter(counted.filter("n > 1").select(slot.alias("slot")), FILTER_BITS)


def _shared_runs(texts: DataFrame) -> DataFrame:
    """doc_id, tag, anchor, body, start, n of the runs whose anchor passes that filter."""
    wanted = texts.sparkSession.sparkContext.broadcast(_repeated_anchors(texts))

    def rows_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, np.uint8)
        for b in batches(rows):
            found = [document_runs(x) for x in raw_texts(b.column(2))]
            anchor, body, start, n = (np.concatenate(x) for x in zip(*found, strict=True))
            row = np.repeat(np.arange(b.num_rows), [len(x[0]) for x in found])
            slot = (anchor >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            at = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            ids = [c.to_numpy(zero_copy_only=False)[row[at]] for c in b.columns[:2]]
            columns = [*ids, anchor[at].view(np.int64), body[at].view(np.int64), start[at], n[at].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "tag", "anchor", "body", "start", "n"])

    kind = "doc_id long, tag int, anchor long, body long, start long, n int"
    return texts.mapInArrow(rows_of, kind)


_OPEN = "hot boolean, anchor long, body long, doc_id long, tag int, start long, bytes binary, hashes array<long>"


def _slices(anchor: int, body: bytes) -> list[tuple]:
    """(core, body, start, hashes) of a run cut into slices of SLICE starts, counted from its anchor.

    All starts of a slice hold its core, so equal ones have equal cores; `hashes` has both hashes
    of each start in turn.
    """
    data = np.frombuffer(body, np.uint8)
    first, second = Prefixes(data, 0), Prefixes(data, 1)
    at = int(np.flatnonzero(first.all(GRAM).view(np.int64) == anchor)[0])
    n = len(data) - LENGTH + 1
    away = (at - np.arange(n)) // SLICE
    begin = np.concatenate([[0], np.flatnonzero(np.diff(away)) + 1])
    end = np.append(begin[1:], n) - 1
    place = (away[begin] + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    # of the whole slice, also where the run has only some of its starts: every one of them holds it
    latest = at - away[begin] * SLICE
    core = (first.of(latest, latest - SLICE + 1 + LENGTH) ^ place).view(np.int64).tolist()
    whole = (first.of(begin, end + LENGTH) ^ (end - begin + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64).tolist()
    pairs = np.stack([first.all(LENGTH), second.all(LENGTH)], axis=1).view(np.int64)
    return [(c, w, a, pairs[a : z + 1].ravel().tolist()) for c, w, a, z in zip(core, whole, begin.tolist(), end.tolist(), strict=True)]


def _extract(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted runs, or for runs of a hot anchor their slices."""

    def bytes_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hot", "anchor", "body", "doc_id", "tag", "start", "bytes", "hashes"]
        kinds = [pa.bool_(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        for b in batches(rows):
            cold, hot = [], []
            for doc, tag, raw, asked in zip(*(b.column(k).to_pylist() for k in (0, 1)), raw_texts(b.column(2)), b.column(3).to_pylist(), strict=True):
                for run in asked:
                    start, anchor = run["start"], run["anchor"]
                    body = raw[start : start + run["n"] - 1 + LENGTH]
                    if not run["hot"]:
                        cold.append((False, anchor, None, doc, tag, start, body, None))
                        continue
                    hot += [(True, core, whole, doc, tag, start + a, None, pairs) for core, whole, a, pairs in _slices(anchor, body)]
                if len(hot) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*hot, strict=True), kinds, strict=True)], names=names)
                    hot = []
            if found := cold + hot:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    asked = wanted.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n", "anchor", "hot")).alias("asked"))
    joined = _only(texts, _doc_bits(asked)).join(asked, ["doc_id", "tag"]).select("doc_id", "tag", "text", "asked")
    return swept(joined.mapInArrow(bytes_of, _OPEN), "open-runs")


def _doc_slot():
    return F.pmod(F.xxhash64("doc_id", "tag"), F.lit(1 << DOC_BITS))


def _doc_bits(rows: DataFrame) -> Broadcast:
    """A filter of the texts that have a row in `rows`."""
    return rows.sparkSession.sparkContext.broadcast(bit_filter(rows.select(_doc_slot().alias("slot")), DOC_BITS))


def _slotted(texts: DataFrame) -> DataFrame:
    return texts.select("doc_id", "tag", "text", _doc_slot().alias("slot"))


def _keep(bits: Broadcast, inside: bool = True) -> Callable:
    """Of batches of `_slotted`, the texts that may have (or surely have no) row behind the filter."""

    def keep(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.frombuffer(bits.value, np.uint8)
        for b in source:
            slot = b.column(3).to_numpy(zero_copy_only=False)
            hit = (have[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
            yield b.filter(pa.array(hit == inside)).select([0, 1, 2])

    return keep


def _only(texts: DataFrame, bits: Broadcast) -> DataFrame:
    """Texts that may have a row behind the filter, so that the others are not shuffled."""
    return _slotted(texts).mapInArrow(_keep(bits), "doc_id long, tag int, text string")


def repeated_starts(texts: DataFrame, first_copy: bool = False) -> DataFrame:
    """doc_id, tag, first, last: stretches of starts whose LENGTH bytes start elsewhere too.

    With `first_copy` only those that also start earlier (by doc_id, tag and place).
    """
    shared = swept(_shared_runs(texts), "runs")
    where = F.struct("doc_id", "tag", "start")
    bodies = shared.groupBy("anchor", "body").agg(F.count(F.lit(1)).alias("copies"), F.min(where).alias("w"), F.first("n").alias("n"))
    bodies = swept(bodies, "bodies")
    # runs that agree in all bytes settle each other
    equal = shared.join(bodies.filter("copies > 1").select("anchor", "body", "w"), ["anchor", "body"])
    if first_copy:
        equal = equal.filter(where > F.col("w"))
    settled = equal.select("doc_id", "tag", F.col("start").alias("first"), (F.col("start") + F.col("n") - 1).alias("last"))
    # of the others one run stands for each body, and anchors with one body need no more
    several = bodies.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    open_ = bodies.join(several, "anchor").select("w.doc_id", "w.tag", "w.start", "n", "anchor", (F.col("kinds") > HOT).alias("hot"))
    extracted = _extract(texts, swept(open_, "open"))

    def order(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs in order of (anchor, position); the last anchor of a batch waits for the next one."""
        ids, held = np.zeros((0, 4), np.int64), []

        def out(ids: np.ndarray, held: list[bytes]) -> Iterator[pa.RecordBatch]:
            sizes = np.cumsum([len(x) for x in held])
            edges = np.concatenate([[0], np.flatnonzero(ids[1:, 0] != ids[:-1, 0]) + 1, [len(ids)]]).astype(np.int64)
            at = 0
            while at < len(edges) - 1:  # whole anchors, about SEGMENT bytes at once
                base = sizes[edges[at] - 1] if edges[at] else 0
                to = max(at + 1, int(np.searchsorted(sizes[edges[1:] - 1], base + SEGMENT // 2)))
                a, z = int(edges[at]), int(edges[to])
                found = _flagged(held[a:z], first_copy)
                own = a + np.array([x[0] for x in found], np.int64)
                begin, end = (ids[own, 3] + np.array([x[k] for x in found], np.int64) for k in (1, 2))
                columns = [pa.array(ids[own, 1]), pa.array(ids[own, 2].astype(np.int32)), pa.array(begin), pa.array(end)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tag", "first", "last"])
                at = to

        for b in rows:
            if not b.num_rows:
                continue
            ids = np.concatenate([ids, np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], axis=1)])
            held += b.column(4).to_pylist()
            done = int(np.searchsorted(ids[:, 0], ids[-1, 0]))
            if done:
                yield from out(ids[:done], held[:done])
                ids, held = ids[done:], held[done:]
        if held:
            yield from out(ids, held)

    key = ["anchor", "doc_id", "tag", "start"]
    kind = "doc_id long, tag int, first long, last long"
    cold = extracted.filter("NOT hot").select(*key, "bytes").repartition("anchor").sortWithinPartitions(*key)
    ordered = cold.mapInArrow(order, kind)
    # a hot anchor's runs are settled slice by slice, and only what is left of them start by start
    slices = extracted.filter("hot").select("anchor", "body", "doc_id", "tag", "start", "hashes")
    found = slices.groupBy("anchor", "body").agg(F.count(F.lit(1)).alias("copies"), F.min(where).alias("w"), F.first("hashes").alias("hashes"))
    found = swept(found, "slices")
    twins = slices.join(found.filter("copies > 1").select("anchor", "body", "w"), ["anchor", "body"])
    cores = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("anchor")
    left = found.join(cores, "anchor", "left_semi").select("w.*", "hashes", F.explode(F.sequence(F.lit(0), (F.size("hashes") / 2).cast("int") - 1)).alias("k"))
    starts = left.select(
        F.get("hashes", F.col("k") * 2).alias("one"), F.get("hashes", F.col("k") * 2 + 1).alias("two"),
        "doc_id", "tag", (F.col("start") + F.col("k")).alias("start"),
    )
    classes = starts.groupBy("one", "two").agg(F.count(F.lit(1)).alias("copies"), F.min(where).alias("w")).filter("copies > 1")
    met = starts.join(classes, ["one", "two"])
    if first_copy:
        twins, met = (x.filter(where > F.col("w")) for x in (twins, met))
    length = (F.size("hashes") / 2).cast("long")
    spread = twins.select("doc_id", "tag", F.col("start").alias("first"), (F.col("start") + length - 1).alias("last")).union(
        met.select("doc_id", "tag", F.col("start").alias("first"), F.col("start").alias("last"))
    )
    return settled.union(ordered).union(spread)


def remove_repeats(docs: DataFrame, first_copy: bool = False) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_bytes, spans, n_removed, n_spans, kept, kept_sha256.

    spans: maximal removed runs of bytes as (start, end); kept: the remaining bytes. A byte goes
    if a string of 200 bytes around it starts anywhere else, in the same text or another; with
    `first_copy` the first copy of each string (by doc_id and place) stays. Strings are judged on
    the input and never cross texts. A null text is empty, a text below 200 bytes stays whole; rows
    with one doc_id and equal texts are copies of each other, all of them are treated alike. A
    null doc_id is an id of its own; an empty table gives no rows.
    """
    texts = _keyed(docs)
    with short_batches(docs.sparkSession):
        found = repeated_starts(texts, first_copy)
        spans = found.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("first", "last")).alias("found"))
        spans = swept(spans, "spans")  # as many as a text has runs
    bits = _doc_bits(spans)

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "spans", "n_removed", "n_spans", "kept", "kept_sha256"]
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pair, pa.int64(), pa.int64(), pa.binary(), pa.string()]
        for b in batches(rows):
            out = []
            for doc, raw, hits in zip(b.column(0).to_pylist(), raw_texts(b.column(1)), b.column(2).to_pylist(), strict=True):
                runs, kept, at = [], [], 0
                for x in sorted((h["first"], h["last"] + LENGTH) for h in hits or ()):
                    if runs and x[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], x[1])
                    else:
                        runs.append(list(x))
                for a, z in runs:
                    kept.append(raw[at:a])
                    at = z
                kept = b"".join([*kept, raw[at:]])
                out.append((doc, len(raw), [{"start": a, "end": z} for a, z in runs], len(raw) - len(kept), len(runs), kept, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def uncut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In one step with the filter, so that a task has one Python worker."""
        kept = _keep(bits, inside=False)(rows)
        return cut(pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.nulls(b.num_rows)], names=["doc_id", "text", "found"]) for b in kept)

    kind = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, n_removed long, n_spans long, kept binary, kept_sha256 string"
    whole = _slotted(texts).mapInArrow(uncut, kind)
    touched = _only(texts, bits).join(spans, ["doc_id", "tag"], "left").select("doc_id", "text", "found")
    result = whole.union(touched.mapInArrow(cut, kind))
    del found
    sweep(docs.sparkSession)
    return result.withColumn("doc_id", F.nullif("doc_id", F.lit(-(1 << 63))))
