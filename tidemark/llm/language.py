"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams (one to five characters of a word,
with a blank at either end). A document's own list is compared with each profile: every n-gram
adds the difference of its two ranks, or the profile's length if the profile lacks it, and the
language with the least sum wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import batches

LONGEST = 5
PROFILE = 400
PART = 1 << 20  # characters counted at once
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_STEP = np.uint64(0x100000001B3)


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART:
        cut = _OTHER.search(text, at + PART)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the text's n-grams, ascending, and their counts."""
    found, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for part in _parts(text):
        words = f" {_OTHER.sub(' ', part.lower()).strip()} "
        codes = np.frombuffer(words.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        if len(codes) < 3:
            continue
        blank = codes == 32
        rolled, good, keys = np.zeros(len(codes), np.uint64), np.ones(len(codes), bool), []
        for n in range(1, LONGEST + 1):
            m = len(codes) - n + 1
            if m <= 0:
                break
            if n > 2:  # the character that is no longer last must be a letter
                good = good[:m] & ~blank[n - 2 : n - 2 + m]
            rolled = (rolled[:m] + codes[n - 1 :] + np.uint64(n)) * _STEP
            rolled ^= rolled >> np.uint64(29)
            if n == 1:
                keys.append(rolled[~blank])
            elif n == 2:
                keys.append(rolled[~(blank[:m] & blank[1:])])
            else:
                keys.append(rolled[good])
        a, b = np.unique(np.concatenate(keys), return_counts=True)
        if len(found):
            a, at = np.unique(np.concatenate([found, a]), return_inverse=True)
            b = np.bincount(at, np.concatenate([counts, b])).astype(np.int64)
        found, counts = a, b
    return found, counts


def ranked(found: np.ndarray, counts: np.ndarray, length: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, ties by hash."""
    if len(found) > length:
        least = np.partition(counts, len(counts) - length)[len(counts) - length]
        keep = counts >= least
        found, counts = found[keep], counts[keep]
    return found[np.lexsort((found, -counts))][:length]


@dataclass
class Profiles:
    languages: list[str]
    known: np.ndarray  # all n-grams of the profiles, ascending
    ranks: np.ndarray  # (n-grams + 1, languages); PROFILE times two where the profile lacks it

    def distances(self, own: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        rank = np.where((self.known[at] == own)[:, None], self.ranks[at], -1)
        out = np.abs(rank - np.arange(len(own))[:, None])
        return np.where(rank < 0, PROFILE, out).sum(axis=0)


def train(docs: DataFrame, allowed: Column, length: int = PROFILE) -> Profiles:
    """Profiles of the non-null languages of the documents that `allowed` admits.

    N-grams of all of them are counted; `length` rows a language reach the driver.
    """

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out(lang: str) -> pa.RecordBatch:
            a, at = np.unique(np.concatenate([x[0] for x in held[lang]]), return_inverse=True)
            b = np.bincount(at, np.concatenate([x[1] for x in held[lang]])).astype(np.int64)
            held[lang] = [(a, b)]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a)), pa.array(a.view(np.int64)), pa.array(b)], names=["lang", "gram", "n"]
            )

        for b in batches(rows, 4 << 20):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text:
                    held.setdefault(lang, []).append(grams(text))
            for lang, lists in list(held.items()):
                if sum(len(x[0]) for x in lists) > 2_000_000:
                    made = out(lang)
                    if made.num_rows > 500_000:
                        yield made
                        del held[lang]
        for lang in list(held):
            yield out(lang)

    chosen = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & allowed).select(
        F.col("lang").cast("string"), F.col("text").cast("string")
    )
    counted = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= length)
    lists: dict[str, list[tuple[int, int]]] = {}
    for row in top.toLocalIterator():
        lists.setdefault(row.lang, []).append((row.gram, row.place - 1))
    languages = sorted(lists)
    known = np.unique(np.array([g for x in lists.values() for g, _ in x], np.int64).view(np.uint64))
    ranks = np.full((len(known), len(languages)), -1, np.int64)
    for k, lang in enumerate(languages):
        own = np.array([g for g, _ in lists[lang]], np.int64).view(np.uint64)
        ranks[np.searchsorted(known, own), k] = [r for _, r in lists[lang]]
    return Profiles(languages, known, ranks)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred, score for each row of `docs`, from its whole text.

    `und` with score 0 if the text is null or has no letter, or if nothing was learned. The score
    is the second distance's share of the two least ones; of equal distances the language that
    sorts first wins. With one language it is the share of the greatest distance not reached.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(profiles).copy())

    def best(model: Profiles, text: str | None) -> tuple[str, float]:
        found, counts = grams(text) if text else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        if not len(found) or not model.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        own = ranked(found, counts)
        d = model.distances(own)
        if len(d) == 1:
            return model.languages[0], float(1 - d[0] / (PROFILE * len(own)))
        first = int(d.argmin())
        second = float(np.delete(d, first).min())
        return model.languages[first], second / (second + float(d[first])) if second else 0.5

    def predictions(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(**sent.value)
        for b in batches(rows):
            found = [best(model, x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(predictions, "doc_id long, lang_pred string, score double")
