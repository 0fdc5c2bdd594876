"""Tokens of two tokenizers aligned on the bytes of each text, and how often their ids meet.

Equal texts are brought together by a shuffle on the whole text; each distinct text is encoded and
aligned once and counts as often as it occurs. Two tokens are linked where their byte ranges
overlap. Links are kept as distinct id pairs of a text with their number, so counting them over
the corpus, and reading the counts back, are sums over those rows.

Nulls and empty texts, texts that are not UTF-8 and texts that either tokenizer does not give back
byte for byte have no tokens: all measures 0, an empty digest. Repeated rows each get their row,
an empty table gives none, and extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batches, per_worker, raw_texts, stage
from ._texts import distinct_texts, to_documents

CHUNKS = 200_000  # entries after which a worker's cache starts anew; the ones before are kept beside it
TOGETHER = 1 << 20  # bytes of texts whose new chunks are encoded in one go
LONG = 64  # longer chunks are not kept in the cache
FREQUENT = 1 << 18  # at most so many id pairs are sent to every task; links of the others are joined
GATHER = 1 << 20  # id pairs that a task holds before it adds equal ones up

_PLAIN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
#: Byte-level vocabularies show each byte as a character: printable ones as themselves, the others from 256 on.
_BYTE = {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}
_SHOWN = {b: c for c, b in _BYTE.items()}
_BLANK_INSIDE = re.compile("[^▁]▁")
_RAW_BYTE = re.compile("<0x([0-9A-F]{2})>")
_NOT_SINGLE = re.compile(r"\s |^ ")
_MARKS = np.array([",", "|", ";", "\n"], object)  # between ids, sides, groups and chunks
_CUT = re.compile(r"(?<=\S)(?= )")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Part(NamedTuple):
    """What the alignment of one chunk adds to its text."""

    n_a: int
    n_b: int
    n_groups: int
    groups: bytes
    links: bytes  # codes of linked id pairs, in order, as unsigned 64-bit integers


class Aligner:
    """Both tokenizers on one text.

    Neither joins across a blank that follows another character: the byte-level one cuts there
    before it merges, and no piece of the other holds such a place. Texts are therefore cut there,
    and a chunk is encoded and aligned once a worker. Where a tokenizer lacks that property, the
    whole text is one chunk.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        with open(a_path) as f:
            config = json.load(f)
        cut = config.get("pre_tokenizer") or {}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.base = len(pieces)
        self.by_chunk = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
            and config.get("normalizer") is None and not any(map(_BLANK_INSIDE.search, pieces))
        )
        names = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(_BYTE[c] for c in name) if all(c in _BYTE for c in name) else name.encode() for name, i in names.items()}
        self.b_bytes = [self._piece_bytes(p) for p in pieces]
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.decimal = np.array([str(i) for i in range(max(len(self.a_size), self.base))], object)
        # what was met since the cache was last full, and what the time before
        self.known: dict[str, Part] = {}
        self.older: dict[str, Part] = {}

    @staticmethod
    def _piece_bytes(piece: str) -> bytes:
        raw = _RAW_BYTE.fullmatch(piece)
        return bytes([int(raw[1], 16)]) if raw else piece.replace("▁", " ").encode()

    def _encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of blank + chunk by the first tokenizer, of chunk by the second, which adds the blank."""
        # letters alone are one word to the byte-level pre-tokenizer, so its model is asked at once
        word = self.a.model.tokenize if self.by_chunk else None
        a = [
            [x.id for x in word("".join([_SHOWN[x] for x in (" " + c).encode()]))] if word and c.isalpha()
            else self.a.encode(" " + c, add_special_tokens=False).ids
            for c in chunks
        ]
        b = self.b.encode(chunks, num_threads=1)
        for k, chunk in enumerate(chunks):
            if not chunk:  # a blank that ends a text
                b[k] = self.b.encode("x ")[len(self.b.encode("x")) :]
        return a, b

    def parts(self, chunks: list[str]) -> list[Part | None]:
        """The alignment of blank + chunk for each chunk; None if its bytes do not come back."""
        a, b = self._encode(chunks)
        out: list[Part | None] = [None] * len(chunks)
        good = []
        for k, chunk in enumerate(chunks):
            whole = (" " + chunk).encode()
            if b"".join([self.a_bytes[i] for i in a[k]]) == whole == b"".join([self.b_bytes[i] for i in b[k]]):
                good.append(k)
        if not good:
            return out
        n_a, n_b = np.array([len(a[k]) for k in good]), np.array([len(b[k]) for k in good])
        a_ids, b_ids = np.array([i for k in good for i in a[k]]), np.array([i for k in good for i in b[k]])
        # all chunks behind one another: both sides end together where a chunk ends
        a_ends, b_ends = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        last = a_ends[np.cumsum(n_a) - 1]
        # between two neighbouring ends of either side lies one token of each: a link
        shared = b_ends[np.searchsorted(b_ends, a_ends)] == a_ends
        cuts = a_ends[shared]
        ends = np.sort(np.concatenate([a_ends[~shared], b_ends]), kind="stable")
        links = (a_ids[np.searchsorted(a_ends, ends)] * self.base + b_ids[np.searchsorted(b_ends, ends)]).astype("<u8").tobytes()
        link_cuts = [0, *((np.searchsorted(ends, last) + 1) * 8).tolist()]
        n_groups = np.diff(np.searchsorted(cuts, last) + 1, prepend=0)
        listed = self._listed(a_ids, b_ids, np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends), np.searchsorted(cuts, last))
        rows = zip(good, n_a.tolist(), n_b.tolist(), n_groups.tolist(), listed, link_cuts[:-1], link_cuts[1:], strict=True)
        for k, x, y, groups, text, start, stop in rows:
            out[k] = Part(x, y, groups, text, links[start:stop])
        return out

    def _listed(self, a_ids, b_ids, a_group, b_group, last_groups) -> list[bytes]:
        """The groups of each chunk as text: ids by comma, sides by bar, groups by semicolon."""
        group = np.concatenate([a_group, b_group])
        side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
        order = np.argsort(group * 2 + side, kind="stable")
        place = (group * 2 + side)[order]
        ends_side = np.append(place[1:] != place[:-1], True)
        mark = np.where(ends_side, 1 + (place & 1), 0)
        mark[np.searchsorted(place, last_groups * 2 + 1, side="right") - 1] = 3
        words = np.empty(2 * len(order), object)
        words[::2] = self.decimal[np.concatenate([a_ids, b_ids])[order]]
        words[1::2] = _MARKS[mark]
        return "".join(words.tolist()).encode().split(b"\n")[:-1]

    def _chunks(self, text: str) -> list[str]:
        if not self.by_chunk:
            return [text]
        if _NOT_SINGLE.search(text):
            return [c[1:] for c in _CUT.split(" " + text)]
        return text.split(" ")

    def align(self, texts: list[str]) -> list[list[Part] | None]:
        """For each text the parts of blank + text in order; None if it has no tokens."""
        cut = [self._chunks(t) if t else [] for t in texts]
        wanted = set().union(*cut)
        if len(self.known) > CHUNKS:
            self.older, self.known = self.known, {}
        known, older, unseen = self.known, self.older, []
        for chunk in wanted.difference(known):
            if chunk in older:
                known[chunk] = older[chunk]
            else:
                unseen.append(chunk)
        found = dict(zip(unseen, self.parts(unseen), strict=True)) if unseen else {}
        known.update((c, p) for c, p in found.items() if p is not None and len(c) <= LONG)
        out: list[list[Part] | None] = []
        for chunks in cut:
            parts = [known.get(c) or found[c] for c in chunks]
            out.append(None if not parts or None in parts else parts)
        return out


_TEXTS = pa.schema([
    ("key", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary()),
])


def _decoded(raw: bytes) -> str:
    """The text; empty, so without tokens, if it is not UTF-8."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return ""


def _texts_aligned(a_path: str, b_path: str):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = per_worker(f"aligner {a_path} {b_path}", lambda: Aligner(a_path, b_path))
        for batch in batches(rows, TOGETHER):
            out = []
            for parts in tool.align([_decoded(raw) for raw in raw_texts(batch["text"])]):
                if parts is None:
                    out.append((0, 0, 0, 0, "", b"", b""))
                    continue
                links = np.frombuffer(b"".join([p.links for p in parts]), "<u8")
                codes, times = np.unique(links, return_counts=True)
                digest = hashlib.sha256(b";".join([p.groups for p in parts])).hexdigest()
                out.append((
                    sum([p.n_a for p in parts]), sum([p.n_b for p in parts]), sum([p.n_groups for p in parts]),
                    len(links), digest, codes.tobytes(), times.astype("<u4").tobytes(),
                ))
            columns = [pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), list(_TEXTS)[2:], strict=True)]
            key = batch["key"].cast(pa.binary())
            yield pa.RecordBatch.from_arrays([key, batch["copies"], *columns], schema=_TEXTS)

    return run


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and times of all texts of a batch behind one another, and where each text ends."""
    raw = batch["codes"].cast(pa.binary()).to_pylist()
    codes = np.frombuffer(b"".join(raw), "<u8").astype(np.int64)
    times = np.frombuffer(b"".join(batch["times"].cast(pa.binary()).to_pylist()), "<u4").astype(np.int64)
    return codes, times, np.cumsum([len(x) // 8 for x in raw])


def _added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return found, total


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n): links of the task's texts, each text as often as it occurs, equal pairs added up."""
    schema = pa.schema([("code", pa.int64()), ("n", pa.int64())])
    codes, counts, held = [], [], 0
    for batch in batches(rows):
        found, times, ends = _links(batch)
        copies = np.repeat(np.asarray(batch["copies"]), np.diff(ends, prepend=0))
        codes.append(found)
        counts.append(times * copies)
        held += len(found)
        if held > GATHER:
            found, total = _added(codes, counts)
            if len(found) > GATHER // 2:
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], schema=schema)
                codes, counts, held = [], [], 0
            else:
                codes, counts, held = [found], [total], len(found)
    if codes:
        found, total = _added(codes, counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], schema=schema)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[ends] - upto[np.concatenate([[0], ends[:-1]])]


def _read_frequent(sent):
    """n_best and count_sum of each text over the frequent pairs."""
    schema = pa.schema([*list(_TEXTS)[:7], ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = sent.value
        for batch in batches(rows):
            codes, times, ends = _links(batch)
            at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            hit = known[at] == codes if len(known) else np.zeros(len(codes), bool)
            at = at[hit]
            worth, top = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
            worth[hit], top[hit] = times[hit] * n[at], times[hit] * best[at]
            arrays = [batch[x] for x in schema.names[:7]] + [pa.array(_sums(top, ends)), pa.array(_sums(worth, ends))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def _rare_links(sent):
    """(key, code, times) of the links whose pair is not among the frequent ones."""
    schema = pa.schema([("key", pa.binary()), ("code", pa.int64()), ("times", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value[0]
        for batch in batches(rows):
            codes, times, ends = _links(batch)
            rare = ~np.isin(codes, known)
            text = np.repeat(np.arange(batch.num_rows), np.diff(ends, prepend=0))[rare]
            yield pa.RecordBatch.from_arrays([batch["key"].take(pa.array(text)), pa.array(codes[rare]), pa.array(times[rare])], schema=schema)

    return run


_DDL = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


@dataclass(frozen=True)
class Alignment:
    """`texts`: one row per distinct text; `pairs`: code = a id * `base` + b id, n links, best of its b id."""

    texts: DataFrame
    pairs: DataFrame
    base: int

    def id_pairs(self) -> DataFrame:
        """(a_id, b_id, n, best): the links of the corpus by id pair."""
        base = F.lit(self.base).cast("long")
        return self.pairs.select(F.expr(f"code div {self.base}L").alias("a_id"), (F.col("code") % base).alias("b_id"), "n", "best")

    def text_measures(self, frequent: int = FREQUENT) -> DataFrame:
        """The measures of each distinct text.

        Pairs from some power of two of links on, at most `frequent` of them, reach every task by
        broadcast. No other pair holds more than one in `frequent` of all links, so the join that
        settles those has no hot key.
        """
        spark = self.texts.sparkSession
        powers = self.pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("n"))
        sizes = {row.power: row.n for row in powers.toLocalIterator()}  # one row a power of two
        floor, held = 64, 0
        while floor > 0 and held + sizes.get(floor - 1, 0) <= frequent:
            floor -= 1
            held += sizes.get(floor, 0)
        frequent_pairs = self.pairs.filter(F.floor(F.log2("n")) >= floor).toArrow()
        order = np.argsort(frequent_pairs["code"].to_numpy())
        sent = spark.sparkContext.broadcast(tuple(frequent_pairs[x].to_numpy()[order].astype(np.int64) for x in ("code", "n", "best")))
        found = self.texts.mapInArrow(_read_frequent(sent), f"{_DDL}, n_best long, count_sum long")
        if held == sum(sizes.values()):
            return found
        rare = self.texts.select("key", "codes", "times").mapInArrow(_rare_links(sent), "key binary, code long, times long")
        worth = (
            rare.join(self.pairs.filter(F.floor(F.log2("n")) < floor), "code").groupBy("key")
            .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_sum"))
        )
        return found.join(worth, "key", "left").select(
            *[x for x in found.columns if x not in ("n_best", "count_sum")],
            (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
        )


def align_texts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> Alignment:
    """Every distinct text of docs aligned once, written to the shared folder, and the counts of its id pairs."""
    import sentencepiece

    if a_path is None or b_path is None:
        first, second = default_paths()
        a_path, b_path = a_path or first, b_path or second
    base = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    texts = distinct_texts(docs).mapInArrow(_texts_aligned(a_path, b_path), f"{_DDL}, codes binary, times binary")
    texts = stage(texts, "aligned")
    counts = texts.select("copies", "codes", "times").mapInArrow(_count, "code long, n long")
    counts = stage(counts.groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    # one row a b id: bounded by the vocabulary
    tops = counts.groupBy((F.col("code") % base).alias("b_id")).agg(F.max("n").alias("top"))
    pairs = counts.join(F.broadcast(tops), F.col("code") % base == F.col("b_id")).select("code", "n", (F.col("n") == F.col("top")).alias("best"))
    return Alignment(texts, pairs, base)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum: one row for each row of docs.

    n_best counts the links whose pair is the most frequent of its b id in the corpus, ties
    included; count_sum adds up, over the links, how many links of the corpus hold their pair.
    """
    found = align_texts(docs, a_path, b_path)
    return to_documents(docs, stage(found.text_measures(), "text-measures"))
