"""Toxicity by class-conditional Kneser-Ney models.

For toxic and for ordinary text a bigram model is counted. Its lower order is Kneser-Ney too: a
word's weight in a class is the number of different words it follows there, and that backs off to
counts which both classes share, so an expression that neither class has seen often says little.
The share of a word in the backed-off mass follows its stem (its first letters) in the class.
A text is scored by the difference of its length-normalised log-likelihoods, over the whole text
and over its most toxic stretch of words, and by how many words speak strongly for toxic. A small
logistic fit on documents that the counts leave out turns this into a probability.

All admitted labelled texts are counted, and the shared counts go over all documents, labelled or
not, in the same pass: each task packs the distinct pairs of its texts into buckets that list their
words once, and buckets are added up behind the shuffle. Pairs are a table that grows with the texts;
a pair seen once counts for its context and its word, and is discounted whole. The table is sent to
the workers only if its counted rows are at most `SENT`, and joined by the pairs of each text otherwise. Only the
logistic fit is bounded: to a quarter of at most `bound` labelled documents a class, by a hash of
the id, which the counts leave out. Words are hashed into a fixed number of slots. Every document is
scored on its whole text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import batches, bit_filter, doc_texts, mix64, per_worker, pieces, raw_texts, stage

BOUND = 6144
SLOTS = 1 << 20
STEM = 4
STEM_PRIOR = 8.0
SENT = (64 << 20) // 12  # pairs that a broadcast may hold: 64 MB, 12 bytes each at most
AT_ONCE = 1 << 19  # pairs that the driver takes in at once
TOGETHER = 2 << 20  # bytes of texts that a task has in hand, beside the model or the gathered words
GATHERED = 1 << 21  # words of texts whose pairs a task packs at once
MOST_ROWS = 64  # of buckets
PAIR, WORD, STEM_OF, AHEAD = range(4)  # kinds of counts
FILTER_BITS = 26  # 8 MB that keep pairs which are not in a joined table from being shuffled
IDS = 500_000  # labelled ids that a broadcast may hold
DISCOUNT = 0.75
RARE = 2.0  # different words before it, up to which a word says what the shared counts say
STRETCH = 6
STRONG = 2.5
THRESHOLD = 0.7
CACHE = 300_000
FEATURES = ("mean", "stretch", "strong", "strongest", "evidence", "length")

_EDGE = ".,;:!?\"'()[]{}|*_-<>"


def _code(word: bytes) -> int:
    """44 bits of the word's hash, a gap, and its stem's slot in the low bits."""
    w = word.decode("utf-8", "replace")
    w = w.strip(_EDGE) or w
    return xxhash.xxh64_intdigest(w, 7) & ~0xFFFFF | xxhash.xxh64_intdigest(w[:STEM], 9) & (SLOTS - 1)


class Hasher:
    """Codes of a text's lower-cased words without edge punctuation."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, raw: bytes) -> np.ndarray:
        return np.concatenate([self._part(x) for x in pieces(raw)])

    def _part(self, raw: bytes) -> np.ndarray:
        words, known = raw.decode("utf-8", "replace").lower().encode().split(), self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for w in set(words).difference(known):
                known[w] = _code(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _pair_hash(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix64(before * np.uint64(0x9E3779B97F4A7C15) + words)


def _pair_keys(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the one before it (0 at the start of a text) and a hash of both."""
    before = np.concatenate([np.zeros(1, np.uint64), words[:-1]]) if len(words) else words
    before[firsts] = 0
    return before, _pair_hash(before, words).view(np.int64)


def _slots(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(24) & np.uint64(SLOTS - 1)).astype(np.int32)


def _stems(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(SLOTS - 1)).astype(np.int32)


@dataclass
class Model:
    """Arrays by slot and, for pairs, by sorted hash; index 0 is ordinary, 1 toxic.

    With a `table` of (pair, d0, d1) the arrays by pair are empty, and each text brings its own.
    """

    own: np.ndarray  # (2, SLOTS) probability of a word by the class's counts
    rest: np.ndarray  # (2, SLOTS) probability by the shared counts and what the class leaves to them
    stem: np.ndarray  # (2, SLOTS) how much more of the rest a stem has in the class
    backoff: np.ndarray  # (2, SLOTS) weight that a preceding word leaves to the lower order
    pairs: np.ndarray
    kind: np.ndarray  # (pairs) where in `kinds` a pair's counts are
    kinds: np.ndarray  # (2, different counts) what the discount leaves of them
    seen: np.ndarray  # (2, SLOTS) pairs that a word is the first of
    direct: np.ndarray | None = None  # (2, pairs) probability by the pair itself, where a text brings its own
    weights: np.ndarray | None = None  # intercept and one weight a feature
    table: DataFrame | None = None


def _flatten(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in texts], np.int64)
    flat = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    return flat, sizes, np.cumsum(sizes) - sizes


def ratios(model: Model, words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """log P(word | before, toxic) - log P(word | before, ordinary) of every word."""
    before, keys = _pair_keys(words, firsts)
    at, ahead, stem = _slots(words), _slots(before), _stems(words)
    place = np.minimum(np.searchsorted(model.pairs, keys), max(len(model.pairs) - 1, 0))
    known = model.pairs[place] == keys if len(model.pairs) else np.zeros(len(keys), bool)
    out = []
    for c in (0, 1):
        p = model.backoff[c][ahead] * (model.own[c][at] + model.rest[c][at] * model.stem[c][stem])
        if known.any():
            if model.direct is None:
                p[known] += (model.kinds[c][model.kind[place[known]]] / (model.seen[c][ahead[known]] + 1.0)).astype(np.float32)
            else:
                p[known] += model.direct[c][place[known]]
        out.append(np.log(p))
    return out[1] - out[0]


def features(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """One row a text, zeros for a text without words."""
    flat, sizes, starts = _flatten(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    if not len(flat):
        return out
    some = sizes > 0
    firsts = starts[some]
    r = ratios(model, flat, firsts).astype(np.float64)
    n = sizes[some]
    out[some, 0] = np.add.reduceat(r, firsts) / n
    # the best run of STRETCH words that ends at each word, cut at the start of its text
    total = np.concatenate([[0.0], np.cumsum(r)])
    begin = np.maximum(np.arange(len(r)) + 1 - STRETCH, np.repeat(firsts, n))
    run = (total[1:] - total[begin]) / STRETCH
    out[some, 1] = np.maximum.reduceat(run, firsts)
    # a word that a text repeats speaks once
    strong = np.flatnonzero(r > STRONG)
    text = np.repeat(np.arange(len(n)), n)[strong]
    _, once = np.unique(np.stack([text.astype(np.uint64), flat[strong]]), axis=1, return_index=True)
    text, worth = text[once], r[strong[once]]
    out[some, 2] = np.log1p(100 * np.bincount(text, minlength=len(n)) / n)
    out[some, 3] = np.maximum.reduceat(r, firsts)
    out[some, 4] = np.log1p(np.bincount(text, worth, minlength=len(n)))
    out[some, 5] = np.log(n)
    return out


def probabilities(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))


def fit_weights(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0, steps: int = 100) -> np.ndarray:
    """Weighted logistic regression; one class alone gives its smoothed share.

    Newton steps on standardised features, halved until the penalised loss falls: the loss is
    convex, so they settle even where the classes can be told apart completely.
    """
    share = (float((w * y).sum()) + 0.5) / (float(w.sum()) + 1)
    out = np.zeros(x.shape[1] + 1)
    out[0] = np.log(share / (1 - share))
    if len(set(y.tolist())) < 2:
        return out
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / spread])
    penalty = np.diag([0.0] + [ridge] * x.shape[1])

    def loss(v: np.ndarray) -> float:
        z = a @ v
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + v @ penalty @ v / 2)

    now = loss(out)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ out, -30, 30)))
        gradient = a.T @ (w * (p - y)) + penalty @ out
        curve = (a * (w * p * (1 - p))[:, None]).T @ a + penalty + 1e-6 * np.eye(len(out))
        step, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-6 and loss(out - size * step) > now:
            size /= 2
        out = out - size * step
        was, now = now, loss(out)
        if was - now < 1e-9 * max(1.0, abs(now)):
            break
    out[1:] /= spread
    out[0] -= float(out[1:] @ mean)
    return out


def labelled(labels: DataFrame, allowed: Column) -> DataFrame:
    """(doc_id, toxic): one row for each admitted id with a label."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & allowed)
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    return one.filter("toxic IN (0, 1)")


def training_rows(labels: DataFrame, allowed: Column, bound: int = BOUND) -> DataFrame:
    """(doc_id, toxic, weight, checks): at most `bound` ids of each class, in order of a hash.

    Ids with several labels count as toxic if one of them says so; null ids and labels are left
    out. weight: labelled rows of the class for each one chosen; checks: kept out of the counts.
    """
    one = labelled(labels, allowed)
    # the hash falls into 4096 cells in order; only the cell that crosses the bound needs a ranking
    one = one.withColumn("hash", F.xxhash64("doc_id", F.lit(11))).withColumn("cell", F.shiftright("hash", 52))
    of_class = W.partitionBy("toxic")
    cells = one.groupBy("toxic", "cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("before", F.sum("n").over(of_class.orderBy("cell")) - F.col("n"))
    cells = cells.withColumn("all", F.sum("n").over(of_class)).filter(F.col("before") < bound).drop("n")
    order = W.partitionBy("toxic", "cell").orderBy("hash", "doc_id")
    reached = one.join(F.broadcast(cells), ["toxic", "cell"])  # at most 4096 rows a class
    chosen = reached.withColumn("place", F.col("before") + F.row_number().over(order)).filter(F.col("place") <= bound)
    weight = F.col("all") / F.least(F.col("all"), F.lit(bound))
    return chosen.select(
        "doc_id", "toxic", weight.alias("weight"), (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0).alias("checks")
    )


def _planes(x: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones: small numbers leave planes of zeros."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _steps(x: np.ndarray) -> bytes:
    """Numbers in ascending order, by their differences."""
    return _planes(np.diff(x.astype(np.uint64), prepend=np.uint64(0)))


def _packed(texts: list[np.ndarray], kinds: list[int], side: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, pairs) of some texts: each distinct pair and kind of text once, with its count.

    Words fall into `side` rows by their hash and a pair into the bucket of its two rows, so no word
    has one bucket to itself. A bucket lists its words once, and its pairs as steps in their numbers.
    """
    flat, sizes, starts = _flatten(texts)
    texts.clear()  # what is done with is let go: a worker has little memory
    if not len(flat):
        return
    words = np.concatenate([np.zeros(1, np.uint64), np.unique(flat)])  # 0 stands before a text
    row, total = ((words >> np.uint64(44)) % np.uint64(side)).astype(np.int8), len(words)
    at = np.empty(len(flat), np.int32)
    for k in range(0, len(flat), 1 << 17):
        at[k : k + (1 << 17)] = np.searchsorted(words[1:], flat[k : k + (1 << 17)]) + 1
    del flat
    ahead = np.concatenate([np.zeros(1, np.int32), at[:-1]])
    ahead[starts[sizes > 0]] = 0
    keys = row[ahead].astype(np.int64)
    for factor, more in ((side, row[at]), (total, ahead), (total, at), (3, np.repeat(np.array(kinds, np.int8), sizes))):
        keys *= factor
        keys += more
    del at, ahead, more
    keys.sort()
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), keys[1:] != keys[:-1]]))
    n = np.diff(first, append=len(keys))
    keys = keys[first]
    kind = (keys % 3).astype(np.int8)
    n[kind == 2] = 0  # of other texts it is known that they have the pair
    keys //= 3
    word = (keys % total).astype(np.int32)
    keys //= total
    ahead = (keys % total).astype(np.int32)
    bucket = (keys // total).astype(np.int32)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
        (a, i), (w, j) = (np.unique(x[lo:hi], return_inverse=True) for x in (ahead, word))
        parts = np.array([len(a), len(w), hi - lo], "<i8").tobytes(), _steps(words[a]), _steps(words[w])
        yield int(bucket[lo]), zlib.compress(b"".join([*parts, _steps((i * len(w) + j) * 3 + kind[lo:hi]), _planes(n[lo:hi])]), 1)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The word before, the word, the kind of text and the count of each pair of a bucket."""
    raw = zlib.decompress(blob)
    sizes = np.frombuffer(raw, "<i8", 3).tolist()
    ends = np.cumsum([24, *(8 * x for x in [*sizes, sizes[2]])]).tolist()
    planes = (np.frombuffer(raw[lo:hi], np.uint8).reshape(8, -1).T for lo, hi in zip(ends, ends[1:], strict=False))
    ahead, word, keys, n = (np.ascontiguousarray(x).view("<u8").ravel() for x in planes)
    ahead, word, keys = (np.cumsum(x, dtype=np.uint64) for x in (ahead, word, keys))
    keys, kind = np.divmod(keys.astype(np.int64), 3)
    i, j = np.divmod(keys, sizes[1])
    return ahead[i], word[j], kind, n.astype(np.int64)


def _tally(kind: int, slots: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """The columns n0, n1 and n of the counts' table, added up by slot; slots where all are 0 are left out."""
    found, at = np.unique(slots, return_inverse=True)
    sums = [np.bincount(at, x, minlength=len(found)).astype(np.int64) for x in columns]
    some = np.any(sums, axis=0)
    return [np.full(some.sum(), kind), found[some], np.zeros(some.sum()), *(x[some] for x in sums)]


def _count(docs: DataFrame) -> DataFrame:
    """(toxic, text), toxic null where a text is not counted for a class, to (kind, key, ahead, n0, n1, n).

    Kind PAIR: a pair that is there more than once in counted texts, the slot of its first word, and its
    counts by class. WORD: a word's slot, and how many different words it follows by class and in all
    texts. STEM: the same of a stem, by class. AHEAD: how often a word is the first of a pair, by class.
    The last three are sums over one bucket and are to be added up.
    """
    # a bucket for each partition of a shuffle
    side = min(MOST_ROWS, math.isqrt(max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1) - 1) + 1)

    def pairs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = per_worker("word codes", Hasher)
        texts, kinds, n = [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            if found := list(_packed(texts, kinds, side)):
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["bucket", "blob"])

        for b in batches(rows, TOGETHER):
            for kind, raw in zip(b.column(0).to_pylist(), raw_texts(b.column(1)), strict=True):
                texts.append(hasher(raw))
                kinds.append(2 if kind is None else kind)
                n += len(texts[-1])
                if n > GATHERED:
                    yield from packed()
                    kinds, n = [], 0
        yield from packed()

    def added(bucket: pa.Table) -> pa.Table:
        ahead, word, kind, n = (np.concatenate(x) for x in zip(*map(_unpacked, bucket.column("blob").to_pylist()), strict=True))
        pair, first, at = np.unique(_pair_hash(ahead, word), return_index=True, return_inverse=True)
        ahead, word = ahead[first], word[first]
        n0, n1 = (np.bincount(at, n * (kind == c), minlength=len(pair)).astype(np.int64) for c in (0, 1))
        twice, none = n0 + n1 > 1, np.zeros(len(pair), np.int64)
        rows = [
            [np.full(twice.sum(), PAIR), pair[twice].view(np.int64), _slots(ahead[twice]), n0[twice], n1[twice], none[twice]],
            _tally(WORD, _slots(word), n0 > 0, n1 > 0, none + 1),
            _tally(STEM_OF, _stems(word), n0 > 0, n1 > 0, none),
            _tally(AHEAD, _slots(ahead), n0, n1, none),
        ]
        return pa.table([np.concatenate(x).astype(t) for x, t in zip(zip(*rows, strict=True), "i4 i8 i4 i8 i8 i8".split(), strict=True)], names=["kind", "key", "ahead", "n0", "n1", "n"])

    blobs = docs.select("toxic", "text").mapInArrow(pairs, "bucket int, blob binary")
    return blobs.groupBy("bucket").applyInArrow(added, "kind int, key long, ahead int, n0 long, n1 long, n long")


def _arrays(df: DataFrame, columns: list[str]) -> list[np.ndarray]:
    found = df.select(*columns).toArrow()
    return [found.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in columns]


def _listed_pairs(pairs: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs in order, of each the place of its counts, and all different counts, discounted.

    They come to the driver range by range, so that it holds little but what it keeps.
    """
    pairs = pairs.select("key", *[F.col(c).cast("int").alias(c) for c in ("n0", "n1")])
    n0, n1 = _arrays(pairs.select("n0", "n1").distinct(), ["n0", "n1"])
    codes = np.sort(n0.astype(np.int64) << 32 | n1)
    listed, kind, at = np.empty(count, np.int64), np.empty(count, np.min_scalar_type(len(codes))), 0
    ranges = -(-count // AT_ONCE)
    ends = [(k << 64) // max(ranges, 1) - (1 << 63) for k in range(ranges + 1)]
    for lo, hi in zip(ends, ends[1:], strict=False):
        key, n0, n1 = _arrays(pairs.filter(F.col("key").between(lo, hi - 1)), ["key", "n0", "n1"])
        order = np.argsort(key)
        listed[at : at + len(key)] = key[order]
        kind[at : at + len(key)] = np.searchsorted(codes, (n0.astype(np.int64) << 32 | n1)[order])
        at += len(key)
    return listed, kind, np.maximum(np.stack([codes >> 32, codes & 0xFFFFFFFF]) - DISCOUNT, 0.0)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, bound: int = BOUND) -> Model:
    """A model from the labelled documents that `allowed`, a condition on labels.doc_id, admits.

    What reaches the driver: two rows a slot at most, the pairs if they are at most `SENT`, and the
    features of each document of the fit.
    """
    known = stage(labelled(labels, allowed), "known")
    fit = stage(training_rows(labels, allowed, bound).filter("checks").select("doc_id", "toxic", "weight"), "fit")
    fit = F.broadcast(fit)  # at most 2 * bound ids
    texts = doc_texts(docs)
    counts = known.join(fit, "doc_id", "left_anti")
    counts = F.broadcast(counts) if known.count() <= IDS else counts
    counted = stage(_count(texts.join(counts, "doc_id", "left").select("toxic", "text")), "pairs")

    def summed(kind: int) -> list[np.ndarray]:
        sums = counted.filter(F.col("kind") == kind).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "n")])
        return _arrays(sums, ["key", "n0", "n1", "n"])

    follow, stems, seen = np.zeros((2, SLOTS)), np.zeros((2, SLOTS)), np.zeros((2, SLOTS), np.int64)
    everywhere = np.zeros(SLOTS)
    at, *found, n = summed(WORD)
    follow[:, at], everywhere[at] = found, n
    for kind, into in ((STEM_OF, stems), (AHEAD, seen)):
        at, *found, _ = summed(kind)
        into[:, at] = found
    shared = (everywhere + 0.5) / (everywhere.sum() + 0.5 * SLOTS)
    own, rest, stem = (np.empty((2, SLOTS), np.float32) for _ in range(3))
    for c in (0, 1):
        total = follow[c].sum() + 1
        own[c] = np.maximum(follow[c] - RARE, 0) / total
        rest[c] = (np.minimum(follow[c], RARE).sum() + 1) / total * shared
        expected = stems.sum(axis=0) * (stems[c].sum() + 1) / (stems.sum() + 2)
        stem[c] = (stems[c] + STEM_PRIOR) / (expected + STEM_PRIOR)
    del follow, stems, everywhere, shared, expected, at, found, n, into  # the driver has little memory, too

    # one smoothing observation a context keeps words after rare ones close to the lower order
    aheads = counted.filter(F.col("kind") == AHEAD).groupBy(F.col("key").cast("int").alias("ahead"))  # a row a slot at most
    aheads = aheads.agg(*[F.sum(f"n{c}").alias(f"s{c}") for c in (0, 1)])
    # a pair seen once leaves its whole count to the lower order, so it has no row of its own
    high = [F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0)) / (F.col(f"s{c}") + 1) for c in (0, 1)]
    high = [high[c].cast("float").alias(f"d{c}") for c in (0, 1)]
    pairs = counted.filter(F.col("kind") == PAIR)
    count = pairs.count()
    few = count <= SENT
    table = pairs.join(F.broadcast(aheads), "ahead").select(F.col("key").alias("pair"), "ahead", *high)
    table = table if few else stage(table, "direct")
    spent = np.zeros((2, SLOTS))
    at, *found = _arrays(table.groupBy("ahead").agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1")), ["ahead", "d0", "d1"])
    spent[:, at] = found
    low = np.maximum(1 - spent, 1e-3).astype(np.float32)
    del spent, at, found
    by_pair = _listed_pairs(*(pairs, count) if few else (pairs.limit(0), 0))
    seen = seen.astype(np.min_scalar_type(seen.max()))
    model = Model(own, rest, stem, low, *by_pair, seen, table=None if few else table.select("pair", "d0", "d1"))

    kind = "toxic int, weight double, " + ", ".join(f"{x} double" for x in FEATURES)

    def check(b: pa.RecordBatch, x: np.ndarray, _) -> pa.RecordBatch:
        values = [pa.array(x[:, k]) for k in range(len(FEATURES))]
        return pa.RecordBatch.from_arrays([b.column(1), b.column(2), *values], names=["toxic", "weight", *FEATURES])

    checks = texts.join(fit, "doc_id").select("text", "toxic", "weight")
    y, w, *x = _arrays(_with_features(checks, model, check, kind), ["toxic", "weight", *FEATURES])
    x = np.stack([v.astype(np.float64) for v in x], axis=1) if len(y) else np.zeros((0, len(FEATURES)))
    model.weights = fit_weights(x, y.astype(np.float64), w.astype(np.float64))
    return model


def _text_hashes(raws: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in raws], np.uint64).view(np.int64)


def _listed(keys: np.ndarray, known: bytes, mask: int) -> np.ndarray:
    """The different keys whose low bits are set in the filter, in order."""
    low = keys & mask
    return np.unique(keys[np.frombuffer(known, np.uint8)[low >> 3] >> (low & 7) & 1 == 1])


def _own_pairs(rows: DataFrame, table: DataFrame) -> DataFrame:
    """`rows` after two more columns: a hash of the text, and (pair, d0, d1) of its pairs that are in the table.

    A filter of a bit for some low bits of each pair in the table keeps most others out of the shuffle.
    """
    mask = (1 << FILTER_BITS) - 1
    known = rows.sparkSession.sparkContext.broadcast(bit_filter(table.select(F.col("pair").bitwiseAND(F.lit(mask)).alias("slot")), FILTER_BITS))
    place, names = rows.columns.index("text"), ["_hash", *rows.columns]
    schema = T.StructType([T.StructField("_hash", T.LongType()), *rows.schema.fields])

    def hashed(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(part):
            yield pa.RecordBatch.from_arrays([pa.array(_text_hashes(raw_texts(b.column(place)))), *b.columns], names=names)

    def asked(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = per_worker("word codes", Hasher)
        for b in batches(part):
            raws = raw_texts(b.column(0))
            sets = [_listed(_pair_keys(w, np.zeros(min(1, len(w)), np.int64))[1], known.value, mask) for w in map(hasher, raws)]
            hashes = np.repeat(_text_hashes(raws), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.concatenate(sets))], names=["_hash", "pair"])

    wanted = rows.select("text").mapInArrow(asked, "_hash long, pair long").distinct()
    found = wanted.join(table, "pair").groupBy("_hash").agg(F.collect_list(F.struct("pair", "d0", "d1")).alias("_pairs"))
    return rows.mapInArrow(hashed, schema).join(found, "_hash", "left").select("_hash", "_pairs", *[F.col(f"`{c}`") for c in rows.columns])


def _sent(rows: DataFrame, model: Model) -> Broadcast:
    """The model's arrays, sent once: for the fit and for all texts. The weights come later and are small."""
    if not hasattr(model, "sent"):
        model.sent = rows.sparkSession.sparkContext.broadcast({k: v for k, v in vars(model).items() if k not in ("table", "weights")})
    return model.sent


def _with_features(rows: DataFrame, model: Model, emit: Callable, schema: T.StructType | str) -> DataFrame:
    """What `emit` makes of each batch of `rows`, the features of its column `text`, and the model."""
    place, table = rows.columns.index("text"), model.table
    sent, weights = _sent(rows, model), model.weights

    def run(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, own = per_worker("word codes", Hasher), Model(**sent.value, weights=weights)
        for b in batches(part, TOGETHER):
            if brings:
                flat = b.column(1).flatten()
                pair, first = np.unique(flat.field(0).to_numpy(zero_copy_only=False), return_index=True)
                direct = np.stack([flat.field(k).to_numpy(zero_copy_only=False)[first] for k in (1, 2)])
                own = replace(own, pairs=pair.astype(np.int64), direct=direct.astype(np.float32))
                b = pa.RecordBatch.from_arrays(b.columns[2:], names=b.schema.names[2:])
            yield emit(b, features(own, [hasher(t) for t in raw_texts(b.column(place))]), own)

    brings = table is not None
    return (_own_pairs(rows, table) if brings else rows).mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for each row of `docs`, from its whole text alone.

    A text without words, a null one too, gets what the fit gives for features of zero. An empty
    table gives no rows; repeated rows get the same score.
    """

    def scores(b: pa.RecordBatch, x: np.ndarray, own: Model) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(probabilities(own.weights, x))], names=["doc_id", "score"])

    found = _with_features(doc_texts(docs), model, scores, "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores below the threshold; order and repeats stay."""

    def clean(b: pa.RecordBatch, x: np.ndarray, own: Model) -> pa.RecordBatch:
        return b.filter(pa.array(probabilities(own.weights, x) < threshold))

    return _with_features(docs, model, clean, docs.schema)


def held_out(doc_id: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))
