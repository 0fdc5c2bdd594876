"""Tokenizer alignment, exact top-k and periodic runs against plain witnesses."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import SMALL, docs, mixed_rows, prose
from tidemark.llm import alignment, periods, queries, topk

# alignment


def tokens_witness(text):
    """((id, first byte, past last byte), ...) by both tokenizers on the whole text; None without tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = alignment.default_paths()
    a_tool = Tokenizer.from_file(a_path)
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=b_path)
    shown = {c: bytes([b]) for c, b in alignment._BYTE.items()}
    if not text:
        return None
    sides = []
    a = [(i, b"".join(shown[c] for c in a_tool.id_to_token(i))) for i in a_tool.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in b_tool.encode(text):
        piece = b_tool.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if b_tool.is_byte(i) else piece.replace("▁", " ").encode()))
    for side in (a, b):
        if b"".join(raw for _, raw in side) != (" " + text).encode():
            return None
        at, spans = 0, []
        for i, raw in side:
            spans.append((i, at, at + len(raw)))
            at += len(raw)
        sides.append(spans)
    return sides


def links_of(a, b):
    """All pairs whose byte ranges overlap; both sides are in order, so the search starts where it last ended."""
    out, first = [], 0
    for i, lo, hi in a:
        while b[first][2] <= lo:
            first += 1
        k = first
        while k < len(b) and b[k][1] < hi:
            out.append((i, b[k][0]))
            k += 1
    return out


def align_witness(rows):
    sides = [tokens_witness(t) for _, t, *_ in rows]
    links = [links_of(*s) if s else [] for s in sides]
    count = Counter(pair for x in links for pair in x)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(n, top.get(b, 0))
    out = []
    for (doc, *_), side, found in zip(rows, sides, links, strict=True):
        if side is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = side
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, _, hi in s if low < hi <= cut) for s in side))
            low = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc, len(a), len(b), len(cuts), len(found), sum(count[p] == top[p[1]] for p in found), sum(count[p] for p in found), digest))
    return sorted(out, key=str)


ODD = [" starts blank", "ends blank ", "  ", " ", "\n \n a  b\n c", "▁x", "a▁ b", "<0x41> <s> <unk>", "a\x00b\x1c d", "é 　x", "it's 3,000 km…"]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 20, 0])
def test_alignment(spark, monkeypatch, frequent):
    rows = [r for r in mixed_rows() if len(r[1] or "") < 5000] + [(100 + k, t) for k, t in enumerate(ODD)]
    rows += [(200 + k, "the same short text") for k in range(9)]
    monkeypatch.setattr(alignment.Alignment.text_measures, "__defaults__", (frequent,))
    found = alignment.align(docs(spark, rows).repartition(4))
    got = found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted(map(tuple, got), key=str) == align_witness(rows)
    assert any(r.n_a == 0 for r in got) and any(r.n_best < r.n_links for r in got)


def test_alignment_of_a_long_text_and_pairs(spark):
    rows = [(1, prose(2, 4000)), (2, "x" * 3000), (3, prose(2, 4000))]
    found = alignment.align_texts(docs(spark, rows))
    links = Counter(p for _, t in rows for p in links_of(*tokens_witness(t)))
    assert {(r.a_id, r.b_id): r.n for r in found.id_pairs().collect()} == links
    assert found.texts.count() == 2


def test_alignment_without_cuts_is_the_same():
    tool, whole = alignment.Aligner(*alignment.default_paths()), alignment.Aligner(*alignment.default_paths())
    whole.by_chunk = False
    pick = random.Random(3)
    parts = ["a", "ing", " ", " ", "\n", "\t", "é", "漢", "😀", "<|endoftext|>", "1", "▁", "\x1c", "\xa0", "'s", ".", "​", "᠎"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(1, 14)))
        a, b = tool.align([text])[0], whole.align([text])[0]
        assert (a is None) == (b is None), text
        if a is not None:
            assert b";".join(p.groups for p in a) == b";".join(p.groups for p in b), text
            assert b"".join(p.links for p in a) == b"".join(p.links for p in b), text


def test_hot_texts_join_apart(spark):
    rows = [(k, "hot text" if k % 3 else f"text {k}") for k in range(600)]
    got = alignment.align(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == list(range(600))
    assert len({r.count_sum for r in got if r.doc_id % 3}) == 1


# exact top-k


def top_k_witness(rows, k=5, every=50):
    whole = []
    for n, (vec_id, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v):
            whole.append((n, vec_id, [int(np.floor(256.0 * x)) for x in v]))
    out = []
    for n, vec_id, q in whole:
        if vec_id is None or vec_id % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v, strict=True)), i is None, i or 0) for m, i, v in whole if m != n and len(v) == len(q)]
        out += [(vec_id, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def vectors(spark, rows):
    full = [(i, v, 1, 7) for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, score int")


def vector_rows(n, dim=6):
    make = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in make.normal(size=dim) * make.choice([0.1, 0.4])]) for i in range(n)]
    rows += [(n + k, rows[7][1]) for k in range(40)]  # copies, so ties
    rows += [(50, rows[3][1]), (50, rows[3][1]), (None, rows[3][1]), (None, rows[9][1]), (-50, [0.0] * dim)]
    rows += [(9000, None), (9050, []), (9100, [None] * dim), (9150, [float("nan")] + [0.1] * (dim - 1)), (9200, [float("inf")] * dim)]
    return rows + [(10000 + 50 * k, [0.5, -0.25 * k]) for k in range(4)]  # another length


@pytest.mark.parametrize("block, pivots", [(2048, 32), (37, 4), (64, 0)])
def test_top_k(spark, block, pivots):
    rows = vector_rows(300)
    found = topk.top_k(vectors(spark, rows), F.col("id") % 50 == 0, block=block, query_block=3, n_pivots=pivots)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == top_k_witness(rows)


def test_top_k_of_large_components_and_few_rows(spark):
    rows = [(0, [1e12, -3.5]), (1, [2e12, 1.0]), (2, [-1e12, 0.3])]
    found = topk.top_k(vectors(spark, rows), F.col("id") % 50 == 0)
    want = [(q, r, i, min(max(s, -(2**63)), 2**63 - 1)) for q, r, i, s in top_k_witness(rows)]
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert topk.top_k(vectors(spark, rows[:1]), F.col("id") % 50 == 0).count() == 0
    assert topk.top_k(vectors(spark, []), F.col("id") % 50 == 0).count() == 0


def test_bounds_stop_early():
    """Clustered rows: most of a block is not evaluated, and the result is that of all rows."""
    make = np.random.default_rng(5)
    centres = make.normal(size=(40, 16)) * 200
    v = np.floor(np.repeat(centres, 100, 0) + make.normal(size=(4000, 16)) * 4)
    pivots = np.vstack([np.zeros((1, 16)), np.floor(centres[:32])])
    far, ids = topk._to_pivots(v, pivots), np.arange(4000)
    rows = (ids, ids, np.zeros(4000, bool), v, far)
    seen = 0
    for n in range(0, 4000, 50):
        places, scores, done = topk.best_of_block(v[n], far[n], ids == n, rows, 5, -np.inf)
        every = np.lexsort((ids, -(v @ v[n])))
        every = every[every != n][:5]
        assert list(places) == list(every) and list(scores) == list((v @ v[n])[every])
        seen += done
    assert seen < 80 * 4000 / 4


# periodic runs


def runs_witness(words):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, stop = i, j + q
            if j > i and stop - start >= max(12, 2 * q):
                part = words[start:stop]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((start, stop - start, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def row_witness(doc, text):
    words = (text or "").encode().split()
    runs = runs_witness(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def repetitive(seed, n, letters):
    pick = random.Random(seed)
    words = [chr(97 + pick.randrange(letters)) for _ in range(n)]
    for _ in range(pick.randint(0, 3)):
        a, p = pick.randrange(n), pick.randint(1, max(1, n // 3))
        for i in range(a + p, min(n, a + pick.randint(0, n))):
            words[i] = words[i - p]
    return " ".join(words)


def test_find_runs():
    for seed in range(400):
        words = repetitive(seed, 1 + seed % 150, (1, 2, 3, 20)[seed % 4]).split()
        x = periods.word_ids([w.encode() for w in words])
        assert sorted(periods.find_runs(x), key=lambda r: (r[0], r[2])) == runs_witness(words), words


def test_tiles_cover_every_run():
    for n in (1, 31, 32, 33, 100, 1000):
        tiles = list(periods.tiles_of(n, 32))
        for low in {t[0] for t in tiles}:
            _, highs, starts, stops = zip(*[t for t in tiles if t[0] == low], strict=True)
            assert starts[0] == 0 and stops[-1] == n
            assert all(stop - start >= max(12, 2 * highs[0]) for stop, start in zip(stops, starts[1:]))  # noqa: B905
        assert n < 2 or max(t[1] for t in tiles) >= n // 2


@pytest.mark.parametrize("tile_bytes", [periods.TILE_BYTES, 40, 0])
def test_periodic_runs(spark, tile_bytes):
    rows = [r for r in mixed_rows() if len(r[1] or "") < 5000]
    rows += [(300 + k, repetitive(k, 20 + 9 * k, (1, 2, 3, 20)[k % 4])) for k in range(40)]
    rows += [(500 + k % 3, "x y z " * 30) for k in range(20)] + [(600, "a " * 500), (601, "\x0b \r\n\t "), (602, "\x1c " * 30)]
    found = periods.periodic_runs(docs(spark, rows).repartition(3), tile_bytes, 32)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([row_witness(*r) for r in rows], key=str)


def test_periodic_runs_of_a_long_text(spark):
    body = prose(8, 3000).split()
    words = body + body + ["tail"] + ["ha"] * 9000 + prose(9, 2000).split()
    for tile in (periods.TILE, 64):
        row = periods.periodic_runs(docs(spark, [(1, " ".join(words))]), tile=tile).first()
        assert (row.n_runs, row.start, row.length, row.period) == (2, 6001, 9000, 1)
        kept = " ".join(body + ["tail", "ha"] + words[15001:])
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def planted_witness(doc, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        return " ".join(w.decode() for w in words)
    return text


def test_planted_query(spark):
    rows = [(k, prose(k, 1 + k * 3)) for k in range(60)] + [(None, "a b"), (61, None), (62, ""), (63, " \t")]
    rows += [(k, " ") for k in range(64, 90)]
    got = {r.doc_id: r.text for r in queries.planted_runs(docs(spark, rows)).collect()}
    assert got == {d: planted_witness(d, t) for d, t in rows}
    assert any(got[d] != t for d, t in rows if d is not None)


def test_op13_on_the_small_table(spark):
    source = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, SMALL).collect()}
    assert len(found) == len(source)
    for doc, text in source:
        text = planted_witness(doc, text)
        if len(text.split()) < 1500:
            r = found[doc]
            want = row_witness(doc, text)
            assert (r.doc_id, r.n_runs, r.start, r.length, r.period, r.runs_sha256, r.collapsed_sha256) == want
            assert r.exponent_milli == (want[3] * 1000 // want[4] if want[1] else None)


def test_empty_tables_of_the_three(spark):
    none = docs(spark, [])
    assert alignment.align(none).count() == 0
    assert periods.periodic_runs(none).count() == 0
