"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages and weighed by TF-IDF, with document frequencies counted
over the whole corpus. A randomised SVD gives the latent space: Spark tasks add every passage of
every document, with a random sign, to one of `ROWS` rows, whose products are on average those of
all passages. Every passage of every document (two neighbouring blocks of words) is compared with
the items there by cosine; what passes is checked by the longest common subsequence of words and,
for paraphrases, by whether the item's answer is there too.

The vocabulary is that of the benchmark, since a word no item has cannot add to a cosine. The
benchmark is worked through in blocks of `ITEMS` items; what is broadcast is bounded by that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batches, doc_texts, mix64, stage

ITEMS = 1024  # of a block
ITEM_WORDS = 32  # of a passage of an item: some passage of a text that copies it holds it whole
BLOCK = 32  # words; a document's passage is two blocks
RANK = 320
ROWS = 1024  # of the sketch of all documents' passages in the SVD
SLICE = 64  # of these rows that are added up together
ADDERS = 16  # tasks that each make a sketch of their documents
CORPUS = 1024  # documents that all documents weigh as much as in the SVD, if they are more
ITEM_WEIGHT = 8.0  # of the benchmark's passages in the SVD
COSINE = 0.5
LCS = 0.9  # of the item's words, in order, make a copy
PARAPHRASE = 0.7  # and with the answer a paraphrase
ANSWER = 0.5
SLACK = 1.3  # words of a text that may hold one item

_WORD = re.compile(r"\w+")
_END = re.compile(r"[.!?]\s+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def answer_of(text: str) -> list[str]:
    """Words of the last sentence that has any: what a paraphrase must keep."""
    parts = [w for w in map(words_of, _END.split(text)) if w]
    return parts[-1] if parts else []


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, one bit a place of `a`."""
    places: dict = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _numbered(text: str, vocabulary: dict[str, int]) -> np.ndarray:
    """Vocabulary numbers of the text's words, 0 for words no item has."""
    found = words_of(text)
    return np.fromiter(map(vocabulary.get, found, repeat(0)), np.int32, len(found))


def _blocks(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, word) of each distinct known word of each block, in order, and each text's first block and the end.

    Blocks are numbered through all texts, with an empty one behind each text.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(-(-sizes // BLOCK) + 1)])
    flat = np.concatenate(texts) if texts else np.zeros(0, np.int32)
    at = np.flatnonzero(flat)
    text = np.repeat(np.arange(len(sizes)), sizes)[at]
    block = starts[text] + (at - (np.cumsum(sizes) - sizes)[text]) // BLOCK
    keys = np.sort(block << 32 | flat[at])
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    return keys >> 32, keys & 0xFFFFFFFF, starts


def numbered(texts: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(doc_id, numbers): the vocabulary numbers of each text's words, written once for all passes over them."""
    sent = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def number(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _width(sent.value)
        for b in batches(rows):
            found = [_numbered(t, sent.value).astype(kind).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["doc_id", "numbers"])

    return stage(texts.select("doc_id", "text").mapInArrow(number, "doc_id long, numbers binary"), "numbers")


def _width(vocabulary: dict[str, int]) -> str:
    return "<u2" if len(vocabulary) < 1 << 16 else "<u4"


def _read(column: pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind).astype(np.int32) for x in column.to_pylist()]


def document_frequencies(numbers: DataFrame, vocabulary: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many documents each known word occurs, and how many documents there are."""
    size, kind = len(vocabulary) + 1, _width(vocabulary)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches(rows):
            for found in _read(b.column(0), kind):
                total[np.unique(found)] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["word", "n"])

    counted = numbers.select("numbers").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in counted.toLocalIterator():  # a row a word of the benchmark's block
        out[row.word] = row.n
    return out, numbers.count()


def sketch_of(ids: list[int | None], texts: list[np.ndarray], idf: np.ndarray, out: np.ndarray) -> None:
    """Adds each passage, two blocks of a text at unit length, to the row of `out` that its hash names, with the hash's sign."""
    block, word, starts = _blocks(texts)
    if not len(block):
        return
    n, weight = int(starts[-1]), idf[word]
    # the empty block behind a text begins no passage, nor does the last of several
    begins = np.ones(n, bool)
    begins[starts[1:] - 1] = False
    several = np.diff(starts) > 2
    begins[starts[1:][several] - 2] = False
    keys = block << 32 | word
    twice = np.minimum(np.searchsorted(keys, keys + (1 << 32)), len(keys) - 1)
    twice = keys[twice] == keys + (1 << 32)
    mass = np.bincount(block, weight**2, minlength=n + 1)
    norm = mass[:-1] + mass[1:] + 2 * np.bincount(block[twice], weight[twice] ** 2, minlength=n)
    text = np.repeat(np.arange(len(texts)), np.diff(starts))
    own = np.array([-1 if x is None else x for x in ids], np.int64).astype(np.uint64)
    hashes = mix64(mix64(own)[text] + (np.arange(n) - starts[text]).astype(np.uint64))
    row = (hashes % np.uint64(len(out))).astype(np.int64)
    share = np.where(hashes >> np.uint64(63), -1.0, 1.0) / np.maximum(np.sqrt(norm), 1e-9) * begins
    np.add.at(out, (row[block], word), share[block] * weight)
    # the passage that began one block earlier holds this one too; no block is before a text's first
    later = block > starts[text[block]]
    before = block[later] - 1
    np.add.at(out, (row[before], word[later]), share[before] * weight[later])


def corpus_sketch(numbers: DataFrame, vocabulary: dict[str, int], idf: np.ndarray) -> np.ndarray:
    """(ROWS, words + 1): sums of all passages of all documents with random signs.

    Each row product is that of the passages it holds plus products of random sign, so that the
    products of two words over all rows are on average those over all passages.
    """
    size, kind, sent = len(vocabulary) + 1, _width(vocabulary), numbers.sparkSession.sparkContext.broadcast(idf)

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ROWS, size))
        for b in batches(rows):
            sketch_of(b.column(0).to_pylist(), _read(b.column(1), kind), sent.value, total)
        for at in range(0, ROWS, SLICE):
            part = total[at : at + SLICE].astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part], pa.binary())], names=["at", "part"])

    def united(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in rows:
            for at, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                totals[at] = totals.get(at, 0) + np.frombuffer(part, "<f4").astype(np.float64)
        for at, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.astype("<f4").tobytes()], pa.binary())], names=["at", "part"])

    parts = numbers.coalesce(ADDERS).mapInArrow(add, "at int, part binary").repartition("at").mapInArrow(united, "at int, part binary")
    out = np.zeros((ROWS, size), np.float32)
    for row in parts.toLocalIterator():  # ROWS / SLICE rows
        out[row.at : row.at + SLICE] = np.frombuffer(row.part, "<f4").reshape(-1, size)
    return out


def latent_space(
    numbers: DataFrame, documents: int, items: list[tuple[np.ndarray, np.ndarray]], vocabulary: dict[str, int], idf: np.ndarray, rank: int
) -> np.ndarray:
    """(words + 1, rank or less): an orthonormal basis of the passages' leading right singular vectors.

    The matrix stacks the weighted passages of the benchmark and the sketch of those of all
    `documents`; these weigh no more together than `CORPUS` of them, lest a large corpus leave no
    room for the items.
    """
    rows = np.zeros((len(items), len(vocabulary) + 1), np.float32)
    for row, (w, v) in zip(rows, items, strict=True):
        row[w] = ITEM_WEIGHT * v / max(float(np.linalg.norm(v)), 1e-9)
    share = np.float32(np.sqrt(min(1.0, CORPUS / max(documents, 1))))
    matrix = np.vstack([share * corpus_sketch(numbers, vocabulary, idf), rows]).astype(np.float64)
    values, turn = np.linalg.eigh(matrix @ matrix.T)
    first = np.argsort(values)[::-1][:rank]
    first = first[values[first] > 1e-9 * max(float(values.max(initial=0)), 1e-9)]
    return np.linalg.qr(matrix.T @ (turn[:, first] / np.sqrt(values[first])))[0].astype(np.float32)


def _item_parts(words: list[str], vocabulary: dict[str, int], idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    count = max(1, -(-len(words) // ITEM_WORDS))
    cuts = np.linspace(0, len(words), count + 1).astype(int)
    out = []
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        w = np.unique(np.array([vocabulary[x] for x in words[a:z]], np.int64))
        out.append((w, idf[w]))
    return out


def _prepare(texts: DataFrame, block: list[tuple[int, str]], cosine: float, rank: int) -> tuple[tuple, DataFrame]:
    """What a task needs to search a text for one block of items, bounded by the block; and the texts' numbers."""
    items = [(i, words_of(t), answer_of(t)) for i, t in block]
    items = [x for x in items if x[1]]
    names = sorted({w for _, words, _ in items for w in words})
    vocabulary = {w: k + 1 for k, w in enumerate(names)}
    numbers = numbered(texts, vocabulary)
    frequency, total = document_frequencies(numbers, vocabulary)
    idf = np.log((total + 1) / (frequency + 1)) + 0.1
    idf[0] = 0
    parts, owner = [], []
    for k, (_, words, _) in enumerate(items):
        for part in _item_parts(words, vocabulary, idf):
            parts.append(part)
            owner.append(k)
    space = latent_space(numbers, total, parts, vocabulary, idf, rank)
    wanted = np.stack([v @ space[w] for w, v in parts]) if parts else np.zeros((0, space.shape[1]))
    norms = np.maximum(np.linalg.norm(wanted, axis=1), 1e-6)
    # cosine * |passage| / |item|: a short item in a long passage cannot reach more than the quotient
    scaled = (wanted / (norms**2)[:, None]).astype(np.float32)
    coded = [([vocabulary[w] for w in words], [vocabulary[w] for w in answer]) for _, words, answer in items]
    ids = [x[0] for x in items]
    weighted = space * idf[:, None].astype(np.float32)
    # few items: what a word adds to the product with each of them, instead of its place in the space
    weighted, queries = (weighted @ scaled.T, None) if len(parts) <= space.shape[1] else (weighted, scaled)
    return (vocabulary, idf, weighted, queries, float(norms.min(initial=1e9)), np.array(owner), coded, ids, cosine), numbers


def _best_match(item: list[int], answer: list[int], region: np.ndarray) -> tuple[float, float, int]:
    """Longest common subsequence over stretches of the region, the answer's share there, and the place.

    Stretches with fewer of the item's words than a paraphrase needs are passed over.
    """
    span, best = max(1, int(np.ceil(len(item) * SLACK))), (0.0, 0.0, 0)
    step = max(1, len(item) // 6)
    starts = np.arange(0, max(1, len(region) - span + step), step)
    held = np.concatenate([[0], np.cumsum(np.isin(region, item))])
    most = held[np.minimum(starts + span, len(region))] - held[np.minimum(starts, len(region))]
    for at in starts[most / len(item) >= PARAPHRASE].tolist():
        part = region[at : at + span].tolist()
        share = common_subsequence(item, part) / len(item)
        if share > best[0]:
            kept = common_subsequence(answer, part) / len(answer) if answer else 1.0
            best = (share, kept, at)
    return best


def _hits(model: tuple, texts: list[np.ndarray]) -> list[tuple]:
    """(text, item_id, cosine, lcs, answer, first_word, item_words) of each item that a text holds; texts by place, in numbers."""
    _, weights, space, queries, least, owners, coded, ids, cosine = model
    block, word, starts = _blocks(texts)
    if not len(block):
        return []
    mass = np.bincount(block, weights[word] ** 2, minlength=int(starts[-1]) + 1)
    # a passage holds each word at most twice, so this bounds its norm from above
    heavy = np.flatnonzero(np.sqrt(2 * (mass[:-1] + mass[1:])) >= cosine * least)
    found: dict[tuple[int, int], list] = {}
    for at in range(0, len(heavy), 256):
        part = heavy[at : at + 256]
        needed = np.union1d(part, part + 1)
        low, high = np.searchsorted(block, needed), np.searchsorted(block, needed, side="right")
        some = high > low
        sizes = (high - low)[some]
        firsts = np.cumsum(sizes) - sizes
        sums = np.zeros((len(needed), space.shape[1]), np.float32)
        if len(sizes):
            picked = np.repeat(low[some] - firsts, sizes) + np.arange(int(sizes.sum()))
            sums[some] = np.add.reduceat(space[word[picked]], firsts, axis=0)
        score = sums[np.searchsorted(needed, part)] + sums[np.searchsorted(needed, part + 1)]
        score = score if queries is None else score @ queries.T
        rows, columns = np.nonzero(score >= cosine)
        texts_of = np.searchsorted(starts, part[rows], side="right") - 1
        for text, b, c, x in zip(texts_of.tolist(), part[rows].tolist(), columns.tolist(), score[rows, columns].tolist(), strict=True):
            found.setdefault((text, int(owners[c])), []).append((b - int(starts[text]), x))
    out = []
    for (text, k), places in sorted(found.items()):
        item, answer = coded[k]
        best, done = None, -1
        for at, score in sorted(set(places)):
            begin, end = max(0, at * BLOCK - len(item)), (at + 2) * BLOCK + len(item)
            if best and best[0] >= LCS and begin < done:
                continue
            share, kept, place = _best_match(item, answer, texts[text][begin:end])
            done = end
            if best is None or share > best[0]:
                best = (share, kept, begin + place, score)
        if best[0] >= LCS or best[0] >= PARAPHRASE and best[1] >= ANSWER:
            out.append((text, ids[k], best[3], best[0], best[1], best[2], len(item)))
    return out


def _models(texts: DataFrame, benchmark: DataFrame, cosine: float, rank: int) -> Iterator:
    """A broadcast model for each block of items, and the numbers of all texts by its vocabulary."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    items = stage(benchmark.select(F.col("item_id").cast("long").alias("item_id"), text).distinct(), "items")
    blocks = max(1, -(-items.count() // ITEMS))
    for k in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        block = sorted((r.item_id if r.item_id is not None else -1, r.text, r.item_id) for r in mine.toLocalIterator())
        model, numbers = _prepare(texts, [(x[2], x[1]) for x in block], cosine, rank)
        yield texts.sparkSession.sparkContext.broadcast(model), numbers


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, rank: int = RANK) -> DataFrame:
    """Pairs (doc_id, item_id) of documents that hold an item or a paraphrase of it.

    One row for each row of `docs` and item found in it: cosine (scaled by the lengths' quotient),
    lcs (share of the item's words found in order within 1.3 times its length), answer (that
    share of its last sentence), first_word (where that stretch begins) and item_words. Clean
    documents give no row. Null texts and items without words match nothing; rows that repeat an
    item_id with another text are items of their own; empty tables give no rows. Where several
    stretches of a document share the most words with an item in order, the first one counts.
    """
    texts, found = doc_texts(docs), None
    kind = "doc_id long, item_id long, cosine double, lcs double, answer double, first_word long, item_words long"
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in kind.split(", ")]
    for model, numbers in _models(texts, benchmark, cosine, rank):

        def search(rows: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            own = _width(model.value[0])
            for b in batches(rows):
                docs = b.column(0).to_pylist()
                out = [(docs[place], *hit) for place, *hit in _hits(model.value, _read(b.column(1), own))]
                columns = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=names)

        pairs = numbers.mapInArrow(search, kind)
        found = pairs if found is None else found.union(pairs)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, rank: int = RANK) -> DataFrame:
    """The rows of `docs`, all columns, that hold no item of the benchmark and no paraphrase of one."""
    place, left = docs.columns.index("text"), docs
    for model, _ in _models(doc_texts(docs), benchmark, cosine, rank):

        def clean(rows: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            for b in batches(rows):
                texts = [_numbered(t or "", model.value[0]) for t in b.column(place).to_pylist()]
                stays = np.ones(len(texts), bool)
                stays[[x[0] for x in _hits(model.value, texts)]] = False
                yield b.filter(pa.array(stays))

        left = left.mapInArrow(clean, docs.schema)
    return left
