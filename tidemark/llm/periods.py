"""Periodic runs of words: every maximal stretch that repeats with some smallest period.

A run is a stretch of consecutive words whose smallest period is q (words q apart are identical),
of max(12, 2 * q) words or more, that no neighbouring word extends with the same period.

Periods are searched by octave, [P, 2P). Boundaries lie P / 2 words apart, so each run of the octave
holds a boundary m, in its first half period, with at least P / 2 further words that equal those
q later. Fingerprints of P / 2 words, doubled from one octave to the next, tell which (m, q) can
be such; there the two Z-values of the boundary, the agreement with the words q later to the
right and to the left, give the stretch whole.

A long document is exploded into tiles for every octave, each overlapping the next by four times
P, so that a run lies whole in a tile or shows in neighbouring tiles with 2 * q shared words.
Tiles are dealt over the cluster and solved on their own; what they find is shuffled by document
and period, where fragments that share a period's length are stitched. A document that fills no
more than one tile is solved where it is read: its fragments are its runs.

Null and empty texts have no words and no runs. Repeated rows each get their row, an empty table
gives none, ties of the longest run go to the smallest start and then period, extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import batches, doc_texts, raw_texts, stage
from ._texts import distinct_texts, to_documents

LEAST = 12  # words of the shortest run
SMALL = 8  # periods below are one octave, whose runs have LEAST words or more
TILE_BYTES = 1 << 15  # a text of more bytes is exploded into tiles
TILE = 1 << 12  # words of a tile at least
TOGETHER = 1 << 18  # words of short documents that are solved in one go

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _agree(x: np.ndarray, at: int, q: int, ahead: bool) -> int:
    """The Z-value at a boundary: how many words from `at` on (or before it) equal those q later."""
    got, size = 0, 16
    limit = len(x) - q - at if ahead else at
    while got < limit:
        n = min(size, limit - got)
        if ahead:
            same = x[at + got : at + got + n] == x[at + q + got : at + q + got + n]
        else:
            same = (x[at - got - n : at - got] == x[at + q - got - n : at + q - got])[::-1]
        if not same.all():
            return got + int(same.argmin())
        got += n
        size *= 4
    return got


def _octaves(most: int) -> Iterator[tuple[int, int, int]]:
    """(first period, last period, boundary step), up to the longest period."""
    if most >= 1:
        yield 1, min(SMALL - 1, most), 2
    low = SMALL
    while low <= most:
        yield low, min(2 * low - 1, most), low // 2
        low *= 2


def _room(ends: np.ndarray, sizes: np.ndarray, q: int) -> int:
    """Where the documents of 2 * q words or more end; they come first."""
    n = int(np.searchsorted(-sizes, -2 * q, side="right"))
    return int(ends[n - 1]) if n else 0


def _matches(prints: np.ndarray, first: int, last: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries m, `step` apart, and periods q, by q and then m, where the prints at m and m + q agree."""
    marks = max(len(prints) - first + step - 1, 0) // step
    at, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if last - first < marks:
        for q in range(first, min(last, len(prints) - 1) + 1):
            hit = np.flatnonzero(prints[: len(prints) - q : step] == prints[q::step]) * step
            if len(hit):
                at.append(hit)
                periods.append(np.full(len(hit), q))
        return np.concatenate(at), np.concatenate(periods)
    for m in range(0, marks * step, step):
        hit = np.flatnonzero(prints[m + first : m + last + 1] == prints[m]) + first
        if len(hit):
            at.append(np.full(len(hit), m))
            periods.append(hit)
    m, q = np.concatenate(at), np.concatenate(periods)
    order = np.lexsort((m, q))
    return m[order], q[order]


def find_runs(x: np.ndarray, low: int = 1, high: int | None = None, ends: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of x with periods from low to high.

    Smaller periods are searched too, so that their multiples are known as such.
    `ends` cuts x into documents, the longest first, each ending in a mark found nowhere else; a
    period is only tried on the documents that have room for it.
    """
    n = len(x)
    ends = np.array([n]) if ends is None else ends
    sizes = np.diff(ends, prepend=0)
    most = int(sizes[0]) // 2 if len(sizes) else 0
    high = most if high is None else min(high, most)
    prints, width = x.astype(np.uint64) * _STEP, 1
    prints ^= prints >> np.uint64(29)
    found: list[tuple[int, int, int]] = []
    multiples: dict[int, list[tuple[int, int]]] = {}  # of a period: the stretches that also repeat with it
    for first, last, step in _octaves(high):
        window = 4 if first == 1 else first // 2
        scale = _STEP | np.uint64(1)
        while width < window:  # a print of twice as many words
            factor = np.uint64(pow(int(scale), width, 1 << 64))
            prints = prints[: max(len(prints) - width, 0)] * factor + prints[width:]
            width *= 2
        at, periods = _matches(prints[: max(_room(ends, sizes, first) - width + 1, 0)], first, last, step)
        owner = np.searchsorted(ends, at, side="right")
        inside = (at + periods < ends[owner]) & (2 * periods <= sizes[owner])
        at, periods = at[inside], periods[inside]
        cuts = np.flatnonzero(np.diff(periods, prepend=-1, append=-1))
        for k, q in enumerate(periods[cuts[:-1]].tolist()):
            here = at[cuts[k] : cuts[k + 1]]
            known = sorted(multiples.pop(q, ()))
            if known:
                starts, stops = np.array(known).T
                place = np.searchsorted(starts, here, side="right") - 1
                here = here[(place < 0) | (here + q + width > stops[np.maximum(place, 0)])]
            done = 0
            while done < len(here):
                m = int(here[done])
                right, left = _agree(x, m, q, True), _agree(x, m, q, False)
                start, stop = m - left, m + q + right
                if right + left >= q and stop - start >= LEAST:
                    if q >= low:
                        found.append((start, stop - start, q))
                    for multiple in range(2 * q, (stop - start) // 2 + 1, q):
                        multiples.setdefault(multiple, []).append((start, stop))
                done = max(done + 1, int(np.searchsorted(here, m + right + 1)))
    return found


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal words of this list."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that some run holds after its first period, joined by a blank."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)


_FOUND = pa.schema([
    ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])
_FOUND_DDL = "n_runs long, start long, length long, period long, runs_sha256 string, collapsed_sha256 string"


def _measures(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    runs = sorted(runs, key=lambda r: (r[0], r[2]))
    longest = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    listed = "".join([f"{start},{length},{period}\n" for start, length, period in runs])
    body = collapse(words, runs) if runs else b" ".join(words)
    return len(runs), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(body).hexdigest()


def _solved(texts: list[list[bytes]]) -> list[tuple]:
    """Measures of short documents, all solved in one array, the longest first."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    known: dict[bytes, int] = {}
    flat: list[int] = []
    ends = []
    for k in order:
        flat.extend([known.setdefault(w, len(known)) for w in texts[k]])
        flat.append(-1 - k)  # a mark of its own ends a document
        ends.append(len(flat))
    runs: list[list] = [[] for _ in texts]
    bounds = np.array(ends, np.int64)
    for start, length, period in find_runs(np.array(flat, np.int64), ends=bounds):
        place = int(np.searchsorted(bounds, start, side="right"))
        runs[order[place]].append((start - (ends[place - 1] if place else 0), length, period))
    return [_measures(words, found) for words, found in zip(texts, runs, strict=True)]


def _solve_short(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), *_FOUND])
    for batch in batches(rows):
        ids, texts, held = batch["doc_id"].to_pylist(), [], 0
        out: list[tuple] = []
        for raw in raw_texts(batch["text"]):
            words = raw.split()
            texts.append(words)
            held += len(words)
            if held > TOGETHER:
                out += _solved(texts)
                texts, held = [], 0
        out += _solved(texts) if texts else []
        columns = [pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _FOUND, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], schema=schema)


def tiles_of(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """(first period, last period, start, stop): the tiles of n words for every octave.

    Octaves whose overlap a tile of the least size has room for share their tiles.
    """
    low, size = 1, tile
    while 2 * low <= n:
        high = size // 8  # the next tile starts 4 * high before this one ends, twice what a run needs
        overlap = 4 * high
        at = 0
        while True:
            yield low, high, at, min(at + size, n)
            if at + size >= n:
                break
            at += size - overlap
        low, size = high + 1, 2 * size


_TILES = pa.schema([
    ("key", pa.binary()), ("low", pa.int64()), ("high", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()),
])


def _explode(tile: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            for key, raw in zip(batch["key"].to_pylist(), raw_texts(batch["text"]), strict=True):
                ids = word_ids(raw.split()).astype("<i4")
                for low, high, start, stop in tiles_of(len(ids), tile):
                    values = [key, low, high, start, ids[start:stop].tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _TILES, strict=True)], schema=_TILES)

    return run


def _solve_tiles(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.binary()), ("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
    for batch in rows:
        for tile in batch.to_pylist():
            ids = np.frombuffer(tile["ids"], "<i4").astype(np.int64)
            found = find_runs(ids, tile["low"], tile["high"])
            if found:
                start, length, period = (np.array(x, np.int64) for x in zip(*found, strict=True))
                start = start + tile["start"]
                arrays = [pa.array([tile["key"]] * len(found), pa.binary()), pa.array(period), pa.array(start), pa.array(start + length)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def stitch(fragments: DataFrame) -> DataFrame:
    """(key, period, start, stop) of whole runs: fragments that share `period` words or more are one.

    Equal fragments count once. Sorted by document and period, a fragment starts a new run if it
    shares fewer words with all before it.
    """
    by = W.partitionBy("key", "period").orderBy("start", "stop")
    before = F.max("stop").over(by.rowsBetween(W.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > before - F.col("period"), F.lit(True)).cast("int")
    numbered = fragments.distinct().withColumn("opens", opens).withColumn("run", F.sum("opens").over(by))
    return numbered.groupBy("key", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def runs_by_tiles(texts: DataFrame, tile: int = TILE) -> DataFrame:
    """(key, start, length, period): the runs of texts (key, text), found tile by tile."""
    tiles = texts.select("key", "text").mapInArrow(_explode(tile), "key binary, low long, high long, start long, ids binary")
    dealt = tiles.repartition("key", "low", "start")
    fragments = dealt.mapInArrow(_solve_tiles, "key binary, period long, start long, stop long")
    return stitch(fragments).select("key", "start", (F.col("stop") - F.col("start")).alias("length"), "period")


def _assemble(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.binary()), ("copies", pa.int64()), *_FOUND])
    for batch in batches(rows):
        runs = [[(r["start"], r["length"], r["period"]) for r in x or ()] for x in batch["runs"].to_pylist()]
        out = [_measures(raw.split(), found) for raw, found in zip(raw_texts(batch["text"]), runs, strict=True)]
        columns = [pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _FOUND, strict=True)]
        yield pa.RecordBatch.from_arrays([batch["key"].cast(pa.binary()), batch["copies"], *columns], schema=schema)


def long_documents(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """The measures of every row of docs, by tiles, each distinct text once.

    A text's runs are fewer than its words, so they are gathered beside it.
    """
    texts = stage(distinct_texts(docs), "long-texts")
    runs = runs_by_tiles(texts, tile).groupBy("key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    whole = texts.join(runs, "key", "left").select("key", "copies", "text", "runs")
    return to_documents(docs, stage(whole.mapInArrow(_assemble, f"key binary, copies long, {_FOUND_DDL}"), "long-runs"))


def periodic_runs(docs: DataFrame, tile_bytes: int = TILE_BYTES, tile: int = TILE) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period) and two digests, for each row of docs.

    runs_sha256 is that of `start,length,period` lines by start and period; collapsed_sha256 that
    of the words kept by `collapse`.
    """
    texts = doc_texts(docs)
    size = F.octet_length("text")
    short = texts.filter(size <= tile_bytes).mapInArrow(_solve_short, f"doc_id long, {_FOUND_DDL}")
    return short.unionByName(long_documents(texts.filter(size > tile_bytes), tile))
