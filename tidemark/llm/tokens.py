"""Token files: patched frame-of-reference blocks, written and read by Spark.

A file holds segments of whole documents in ascending doc_id order. A segment's ids are cut into
blocks of 256. A block stores its minimum, the differences packed at the width that covers
`PERCENTILE` of them, and an exception list (place, high bits) for the rest. The segment starts
with an index of its block starts, so one block can be read without the others.

The container is Parquet, one row a segment: Spark's commit protocol then covers task retries,
lost executors and any store that Spark can reach.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import batches, doc_texts, per_worker

BLOCK = 256
PERCENTILE = 90
SEGMENT_IDS = 1 << 16
PIECES, WORDS = 700_000, 100_000  # entries of a worker's two caches, after which they are emptied into their older part


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_PLAIN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
_OTHERS = [b for b in range(256) if b not in set(_PLAIN)]
#: Byte-level tokenizers show each byte as a character: printable ones as themselves, the others from 256 on.
_SHOWN = {b: chr(b) for b in _PLAIN} | {b: chr(256 + k) for k, b in enumerate(_OTHERS)}
_BLANK, _BREAK = _SHOWN[32], _SHOWN[10]
_MARKS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())


def _visible(text: str) -> str:
    return text if text.isascii() else text.encode().decode("latin-1").translate(_SHOWN)


_FORMATS = [f"<{n}I" for n in range(64)]


class _Kept(dict):
    """What `make` returns for a key, made when the key is first asked for.

    Beyond `most` keys all go to an older part, in place of those that were there; what is asked for
    again comes back from it. So keys that are often asked for stay, and at most twice `most` are held.
    """

    def __init__(self, make: Callable[[str], bytes], most: int = PIECES):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def turn(self) -> None:
        if len(self) > self.most:
            self.older = {}
            self.older = dict(self)
            self.clear()


class Encoder:
    """Ids of whole texts by the tokenizers library, which reads special strings in a text as such.

    Texts that hold one are encoded whole. A byte-level tokenizer that cuts by its own pattern never joins across a blank that follows
    another character, so a text without double blanks is cut there and each piece is encoded
    once a worker; other texts and other tokenizers are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        with open(path) as f:
            config = json.load(f)
        cut = config.get("pre_tokenizer") or {}
        self.by_piece = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
            and config.get("normalizer") is None and config.get("truncation") is None and config.get("padding") is None
        )
        self.model = self.tool.model
        self.pieces = _Kept(self._piece, PIECES)  # what stands between two blanks
        self.words = _Kept(self._word, WORDS)  # what the pre-tokenizer cuts, but for letters behind a blank

    def _ids(self, text: str) -> bytes:
        return np.array(self.tool.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        found = [x.id for x in self.model.tokenize(word)]
        return pack(_FORMATS[len(found)], *found) if len(found) < len(_FORMATS) else np.array(found, "<u4").tobytes()

    def _cut(self, text: str) -> bytes:
        """Ids by the library's own two steps: its pre-tokenizer, then its model."""
        return b"".join([self.words[word] for word, _ in self.tool.pre_tokenizer.pre_tokenize_str(text)])

    def _piece(self, text: str) -> bytes:
        """Ids of a blank and what follows it up to the next one.

        Letters alone are one word, and marks behind them are another: for these, and for
        lines of them, the pre-tokenizer need not be asked.
        """
        if text.isalpha():
            return self._word(_BLANK + (text if text.isascii() else _visible(text)))
        if (head := text.rstrip(_MARKS)).isalpha():
            return self.pieces[head] + self.words[text[len(head) :]]
        if "\n" not in text:
            return self._cut(" " + text)
        words, out = self.words, []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(words[_BREAK])
            if not (head := line.rstrip(_MARKS)).isalpha():
                return self._cut(" " + text)
            out.append(words[_visible(head)] if k else self.pieces[head])
            if len(head) < len(line):
                out.append(words[line[len(head) :]])
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if not self.by_piece or "  " in text or any(x in text for x in self.special):
            return self._ids(text)
        head, *rest = text.split(" ")
        self.pieces.turn()
        self.words.turn()
        body = b"".join(map(self.pieces.__getitem__, rest))
        return (self.words[_visible(head)] if head.isalpha() else self._cut(head) if head else b"") + body


def pack_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """Count, minimum, width, exceptions, packed low bits, exception places and high bits."""
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint64)
    width = int(np.partition(rest, k := (len(rest) - 1) * percentile // 100)[k]).bit_length()
    odd = np.flatnonzero(rest >> np.uint64(width))
    bits = (rest[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    head = np.array([len(ids), low, width, len(odd)], "<u4").tobytes()
    return head + packed + odd.astype("<u4").tobytes() + (rest[odd] >> np.uint64(width)).astype("<u4").tobytes()


def unpack_block(raw: bytes) -> np.ndarray:
    n, low, width, odd = np.frombuffer(raw, "<u4", 4).tolist()
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, size, 16), bitorder="little")[: n * width]
    weights = np.uint64(1) << np.arange(width, dtype=np.uint64)
    rest = (bits.reshape(n, width).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
    places = np.frombuffer(raw, "<u4", odd, 16 + size)
    rest[places] |= np.frombuffer(raw, "<u4", odd, 16 + size + 4 * odd).astype(np.uint64) << np.uint64(width)
    return (rest + np.uint64(low)).astype(np.uint32)


def pack_segment(ids: np.ndarray) -> bytes:
    """Blocks of all ids after an index: number of blocks, then each block's start and the end.

    All full blocks of one width are packed together; the bytes are those of `pack_block`.
    """
    n = len(ids)
    full = n // BLOCK
    blocks: list[bytes] = [b""] * -(-n // BLOCK)
    if full:
        cells = ids[: full * BLOCK].reshape(full, BLOCK)
        low = cells.min(axis=1)
        rest = (cells - low[:, None]).astype(np.uint32)
        cut = np.partition(rest, k := (BLOCK - 1) * PERCENTILE // 100, axis=1)[:, k]
        widths = np.ceil(np.log2(cut.astype(np.float64) + 1)).astype(np.int64)
        for width in np.unique(widths).tolist():
            which = np.flatnonzero(widths == width)
            part = rest[which]
            wide = part.astype(np.uint64) >> np.uint64(width)
            narrow = part.astype("<u2" if width <= 16 else "<u4").view(np.uint8).reshape(len(which), BLOCK, -1)
            bits = np.unpackbits(narrow, axis=2, bitorder="little")[:, :, :width].reshape(len(which), BLOCK * width)
            packed = np.packbits(bits, axis=1, bitorder="little")
            row, place = np.nonzero(wide)
            count = np.bincount(row, minlength=len(which))
            heads = np.stack([np.full(len(which), BLOCK), low[which], np.full(len(which), width), count], axis=1).astype("<u4").tobytes()
            body, size = packed.tobytes(), packed.shape[1]
            places, high = place.astype("<u4").tobytes(), wide[row, place].astype("<u4").tobytes()
            ends = np.cumsum(4 * count).tolist()
            for k, (at, lo, hi) in enumerate(zip(which.tolist(), [0, *ends], ends, strict=False)):
                blocks[at] = heads[16 * k : 16 * k + 16] + body[size * k : size * k + size] + places[lo:hi] + high[lo:hi]
    if n % BLOCK:
        blocks[-1] = pack_block(ids[full * BLOCK :])
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    return np.array([len(blocks)], "<u8").tobytes() + starts.tobytes() + b"".join(blocks)


def segment_blocks(raw: bytes) -> tuple[np.ndarray, int]:
    """The block starts of a segment, and where the first block lies."""
    count = int(np.frombuffer(raw, "<u8", 1)[0])
    return np.frombuffer(raw, "<u8", count + 1, 8).astype(np.int64), 8 * (count + 2)


def read_block(raw: bytes, number: int) -> np.ndarray:
    """Ids number * 256 and on, without reading other blocks."""
    starts, base = segment_blocks(raw)
    return unpack_block(raw[base + starts[number] : base + starts[number + 1]])


def unpack_segment(raw: bytes) -> np.ndarray:
    """All ids of a segment; blocks of one width are unpacked together."""
    starts, base = segment_blocks(raw)
    count = len(starts) - 1
    if not count:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(raw, np.uint8)
    at = base + starts[:-1]
    heads = data[at[:, None] + np.arange(16)].copy().view("<u4").reshape(count, 4).astype(np.int64)
    out = np.empty(int(heads[:, 0].sum()), np.uint32)
    whole = heads[:, 0] == BLOCK
    for width in np.unique(heads[whole, 2]).tolist():
        which = np.flatnonzero(whole & (heads[:, 2] == width))
        values = np.zeros((len(which), BLOCK), np.uint64)
        bit = np.arange(BLOCK) * width
        for k in range((width + 14) // 8 if width else 0):  # bytes that a value may reach into
            byte = np.minimum((bit >> 3) + k, BLOCK * width // 8 - 1)
            values |= data[(at[which] + 16)[:, None] + byte].astype(np.uint64) << np.uint64(8 * k)
        values = (values >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)
        values += heads[which, 1].astype(np.uint64)[:, None]
        out[(which * BLOCK)[:, None] + np.arange(BLOCK)] = values
    which = np.flatnonzero(whole & (heads[:, 3] > 0))
    odd = heads[which, 3]
    total = int(odd.sum())
    if total:
        nth = np.arange(total) - np.repeat(np.cumsum(odd) - odd, odd)
        place = np.repeat(at[which] + 16 + BLOCK * heads[which, 2] // 8, odd) + 4 * nth
        four = np.arange(4)
        places = data[place[:, None] + four].copy().view("<u4").ravel().astype(np.int64)
        high = data[(place + 4 * np.repeat(odd, odd))[:, None] + four].copy().view("<u4").ravel()
        out[np.repeat(which * BLOCK, odd) + places] += high << np.repeat(heads[which, 2], odd).astype(np.uint32)
    if not whole[-1]:
        out[(count - 1) * BLOCK :] = unpack_block(raw[base + starts[-2] : base + starts[-1]])
    return out


SEGMENTS = "file int, segment int, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Encode every whole text, append `end_id`, and write segments in ascending doc_id order.

    Rows with one doc_id are ordered by a hash of their texts; a null doc_id comes first, as in
    an ascending sort. A null or empty text gives the end id alone. No rows give empty files.
    """
    where = tokenizer or default_tokenizer()

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, end = per_worker(f"encoder {where}", lambda: Encoder(where), large=True), np.array([end_id], "<u4").tobytes()
        file, segment = TaskContext.get().partitionId(), 0
        ids, lengths, parts, held = [], [], [], 0
        names = ["file", "segment", "n_ids", "doc_ids", "lengths", "payload"]

        def flush() -> pa.RecordBatch:
            body = pack_segment(np.frombuffer(b"".join(parts), "<u4"))
            columns = [
                pa.array([file], pa.int32()), pa.array([segment], pa.int32()), pa.array([held], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([body], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for b in batches(rows):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = tool.encode(text) + end
                ids.append(doc)
                lengths.append(len(found) // 4)
                parts.append(found)
                held += len(found) // 4
                if held >= SEGMENT_IDS:
                    yield flush()
                    segment, ids, lengths, parts, held = segment + 1, [], [], [], 0
        if ids:
            yield flush()

    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = doc_texts(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(encode, SEGMENTS).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """One row a document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids, file, segment.

    `ids` are little-endian unsigned 32-bit integers, and ids_crc32 is their unsigned crc32. Without
    `ids` they are decoded and summed up as well, but stay in the workers.
    """

    def decode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for file, segment, _, docs, lengths, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                flat = unpack_segment(body).astype("<u4", copy=False)
                ends = np.cumsum(lengths).tolist()
                raw = [flat[e - n : e].tobytes() for e, n in zip(ends, lengths, strict=True)]
                count = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * count, pa.int32()), pa.array([segment] * count, pa.int32()),
                        pa.array([e - n for e, n in zip(ends, lengths, strict=True)], pa.int64()),
                        pa.array(docs, pa.int64()), pa.array(lengths, pa.int64()),
                        pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array(raw if ids else [None] * count, pa.binary()),
                    ],
                    names=["file", "segment", "within", "doc_id", "n_tokens", "ids_crc32", "ids"],
                )

    kind = "file int, segment int, within long, doc_id long, n_tokens long, ids_crc32 long, ids binary"
    segments = spark.read.schema(SEGMENTS).parquet(path)
    documents = segments.mapInArrow(decode, kind)
    return documents.join(segment_starts(spark, path), ["file", "segment"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids, "file", "segment"
    )


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """file, segment, base: ids before each segment. Running totals go over a file's segments and
    over one sum a file; a file is what one task wrote."""
    sizes = spark.read.schema(SEGMENTS).parquet(path).select("file", "segment", "n_ids")
    files = sizes.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    files = files.select("file", F.coalesce(before, F.lit(0)).alias("file_start"))
    within = W.partitionBy("file").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return (
        sizes.select("file", "segment", inside.alias("inside"))
        .join(F.broadcast(files), "file")  # one row a file
        .select("file", "segment", (F.col("file_start") + F.col("inside")).alias("base"))
    )
