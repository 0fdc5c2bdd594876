"""Each operator against a plain witness on small tables with nulls, repeats, ties and long texts."""

from __future__ import annotations

import gc
import hashlib
import random
import re
import weakref
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from tidemark.llm._common import bit_filter, per_worker
from tidemark.llm import _common, copies, decontaminate, exact, language, licences, mixing, queries, quotes, repeats, simhash, tokens, toxicity

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, fp string"


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(2, 7))) for _ in range(n))


def docs(spark, rows):
    """Rows of (doc_id, text[, source]) in a table with extra columns whose names clash."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, 2, "x", "y") for r in rows]
    return spark.createDataFrame(full, DOCS)


def mixed_rows():
    shared, long = prose(1, 90), prose(2, 30_000)
    return [
        (1, f"{prose(3, 40)} {shared} {prose(4, 30)}"),
        (2, f"{prose(5, 10)} {shared}\n{prose(6, 50)}"),
        (3, long),
        (4, long + " tail"),
        (5, None),
        (6, ""),
        (7, "Mixed  CASE\ttext here"),
        (8, "Mixed CASE text here"),
        (8, "Mixed CASE text here"),
        (8, "another text of the same id"),
        (None, "Mixed CASE text here"),
        (None, None),
        (9, "ab " * 400),
        (10, "é漢😀 <|endoftext|>  two blanks"),
    ]


def test_empty_tables(spark):
    none = docs(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert exact.exact_dedup(none).count() == 0
    assert simhash.near_groups(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    assert repeats.remove_repeats(none).count() == 0
    assert mixing.mix(none, labels).count() == 0
    assert mixing.mixed_rows(none).count() == 0
    assert licences.licence_scan(none).count() == 0
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(docs(spark, mixed_rows()), bench).count() == 0
    assert language.predict(none, language.train(none, F.lit(True))).count() == 0
    model = toxicity.train(none, labels, F.lit(True))
    assert toxicity.score(none, model).count() == 0
    assert quotes.link_quotes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# exact deduplication


def test_fingerprints_compose():
    text = bytes(random.Random(1).randbytes(10_000))
    whole = exact.fingerprint(text)
    for cut in (0, 1, 4095, 4096, 4097, 9999, 10_000):
        assert exact.join_prints(exact.fingerprint(text[:cut]), exact.fingerprint(text[cut:]), len(text) - cut) == whole


def test_pieces_combine(spark):
    text = random.Random(2).randbytes(9000)
    rows = [(1, 0, text[:10]), (1, 1, None), (1, 2, text[10:5000]), (1, 3, text[5000:]), (2, 0, b"")]
    found = {r.key: r for r in exact.combine(spark.createDataFrame(rows, "key long, part_no long, body binary")).collect()}
    assert (found[1].n_bytes, found[1].h1, found[1].h2) == (9000, *exact.fingerprint(text))
    assert (found[2].n_bytes, found[2].h1, found[2].h2) == (0, 0, 0)


def exact_witness(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in rows]
    out = []
    for (doc, *_), text in zip(rows, norm, strict=True):
        ids = [d for (d, *_), t in zip(rows, norm, strict=True) if t == text]
        keep = min((d for d in ids if d is not None), default=None)
        out.append((doc, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup(spark, monkeypatch, collide):
    if collide:  # every text of one length has the same fingerprint: the comparison must part them
        monkeypatch.setattr(exact, "fingerprint", lambda raw: (7, 7))
    rows = mixed_rows() + [(20, "same length a"), (21, "same length b"), (22, "same length a")]
    found = exact.exact_dedup(docs(spark, rows).repartition(5)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == exact_witness(rows)
    kept = [(r.text_sha256) for r in found if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in found})


# repeated passages


def repeats_witness(rows, first_copy=False):
    raws = [(t or "").encode() for _, t, *_ in rows]
    seen = {}
    for k, raw in enumerate(raws):
        for p in range(len(raw) - 199):
            seen.setdefault(raw[p : p + 200], []).append((k, p))
    out = []
    for k, raw in enumerate(raws):
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 199):
            at = seen[raw[p : p + 200]]
            if len(at) > 1 and (not first_copy or at[0] != (k, p)):
                gone[p : p + 200] = True
        edges = np.diff(np.concatenate([[False], gone, [False]]).astype(int))
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((rows[k][0], len(raw), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [512, 1])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    shared = prose(50, 120)
    rows = [r for r in mixed_rows() if r[0] not in (3, 4)]
    rows += [(100 + k, prose(60 + k, 12) + shared[k * 7 :] + prose(90 + k, 9)) for k in range(12)]
    rows += [(200, prose(201, 3000)), (201, prose(201, 1500))]
    found = repeats.remove_repeats(docs(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found], key=str) == repeats_witness(rows)


@pytest.mark.parametrize("hot", [512, 1])
def test_first_copy_stays(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    shared = prose(50, 120)
    rows = [(100 + k, prose(60 + k, 12) + shared[k * 7 :] + prose(90 + k, 9)) for k in range(8)] + [(300, "ab " * 300)]
    found = repeats.remove_repeats(docs(spark, rows), first_copy=True).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found], key=str) == repeats_witness(rows, True)


def test_segments_of_long_texts_agree(monkeypatch):
    raw = (prose(7, 900) + prose(8, 100) + prose(7, 900)).encode()
    whole = {(int(b), int(n)) for _, b, _, n in zip(*repeats.document_runs(raw), strict=True)}
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    cut = repeats.document_runs(raw)
    covered = sorted((int(s), int(s + n)) for s, n in zip(cut[2], cut[3], strict=True))
    assert covered[0][0] == 0 and covered[-1][1] == len(raw) - 199
    assert all(a[1] == b[0] for a, b in zip(covered, covered[1:], strict=False)) and whole


@pytest.mark.parametrize("alphabet", [1, 2, 4])
def test_factor_arrays(alphabet):
    pick = np.random.default_rng(alphabet)
    for n in (200, 201, 320, 700):
        block = pick.integers(0, alphabet, 230, np.uint8)
        raw = np.concatenate([pick.integers(0, alphabet, n, np.uint8), block, pick.integers(0, alphabet, 40, np.uint8), block])
        starts = np.flatnonzero(pick.random(len(raw) - 199) < 0.8)
        order, shared = repeats.suffix_order(raw, starts)
        text = raw.tobytes()
        cut = [text[a : a + 200] for a in starts]
        want = sorted(range(len(starts)), key=lambda k: (cut[k], k))
        assert order.tolist() == want

        def common(a, b):
            return next((k for k in range(200) if a[k] != b[k]), 200)

        assert shared[1:].tolist() == [common(cut[a], cut[b]) for a, b in zip(want, want[1:], strict=False)]
        for later in (False, True):
            some = range(0, len(starts), 7)
            longest = [max((common(cut[k], x) for x in (cut[k + 1 :] if later else cut[:k])), default=0) for k in some]
            assert repeats.factors(order, shared, later)[::7].tolist() == longest
            cheap = repeats.factors(order, shared, later, least=200) >= 200
            assert cheap[::7].tolist() == [x == 200 for x in longest]


# SimHash


def simhash_witness(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_groups(spark):
    base = prose(11, 400).split()
    near = [(30 + k, " ".join(base[:k] + ["changed"] + base[k + 1 :])) for k in range(0, 200, 10)]
    rows = mixed_rows() + near
    found = simhash.near_groups(docs(spark, rows)).withColumn("hex", simhash.fingerprint_hex()).collect()
    prints = [simhash_witness(t) for _, t, *_ in rows]
    assert sorted(r.hex for r in found) == sorted("%016x" % p for p in prints)
    group = {p: {p} for p in prints}
    for a in group:
        for b in list(group):
            if (a ^ b).bit_count() <= 3 and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[a]:
                    group[x] = group[a]
    low = lambda g: min((d for (d, *_), p in zip(rows, prints, strict=True) if p in g and d is not None), default=None)
    want = sorted([(d, low(group[p])) for (d, *_), p in zip(rows, prints, strict=True)], key=str)
    assert sorted([(r.doc_id, r.component_id) for r in found], key=str) == want
    kept = simhash.keep_one(docs(spark, rows)).collect()
    assert len(kept) == len({id(g) for g in group.values()})
    assert set(kept[0].asDict()) == set(docs(spark, []).columns)


def test_chains_lose_no_pair_within_three_bits():
    pick = np.random.default_rng(3)
    for _ in range(300):
        x = np.uint64(sum(1 << int(b) for b in pick.choice(64, 3, replace=False)))
        turned = simhash.ring(np.full(simhash.SEGMENTS, x), np.arange(simhash.SEGMENTS))
        assert simhash.chains_hold(turned).any()


@pytest.mark.parametrize("block", [2048, 16])
def test_links_of_large_lists(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    pick = random.Random(5)
    base = pick.getrandbits(64)
    values = {base ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)) for _ in range(120)} | {pick.getrandbits(64) for _ in range(200)}
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    pairs = simhash.links(spark.createDataFrame(rows, "fp long")).collect()
    found, want = ({v: v for v in values} for _ in range(2))

    def root(tree, x):
        while tree[x] != x:
            x = tree[x]
        return x

    for a, b in pairs:
        found[root(found, a % (1 << 64))] = root(found, b % (1 << 64))
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                want[root(want, a)] = root(want, b)
    same = lambda tree: {frozenset(v for v in values if root(tree, v) == r) for r in {root(tree, v) for v in values}}
    assert same(found) == same(want)


# mixing


def changed(words, places):
    return [f"new{k}" if k in places else w for k, w in enumerate(words)]


def test_stage_drops_copies_from_similarity_0_8(spark, monkeypatch):
    import corpus_pipeline

    rows, want, sims = [], [], []
    for k in range(160):
        pick = random.Random(k)
        words = prose(3000 + k, pick.randint(40, 400)).split()
        other = changed(words, set(pick.sample(range(len(words)), pick.randint(1, max(1, len(words) // 30)))))
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (words, other))
        sims.append(len(a & b) / len(a | b))
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other).upper())]
        want += [2 * k] if sims[-1] >= 0.8 else [2 * k, 2 * k + 1]
    assert sum(0.8 <= s < 0.85 for s in sims) > 5 and sum(s < 0.8 for s in sims) > 5 and sum(s > 0.95 for s in sims) > 5
    # a chain: neighbours are near, its ends are not; a group larger than a turn joins; texts without words
    words = prose(9000, 100).split()
    rows += [(1000 + k, " ".join(changed(words, set(range(3, 3 + 10 * k, 10))))) for k in range(9)]
    rows += [(2000, None), (2001, ""), (2002, "few words"), (2003, "Few  words"), (2003, "few words"), (None, "few words")]
    kept = corpus_pipeline.near_copies_out(spark, docs(spark, rows).repartition(3), SMALL)
    assert kept.columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*want, 1000, 2000, 2002])
    monkeypatch.setattr(copies, "PIVOTS", 0)  # all pairs at once find the same
    assert sorted(r.doc_id for r in copies.keep_one(docs(spark, rows)).collect()) == sorted([*want, 1000, 2000, 2002])


def test_the_pipeline_takes_pairs_from_fingerprints(spark, monkeypatch):
    """Without any candidate of the minimum hashes, near texts of fingerprints within three bits are still found."""
    rows, want = [], []
    for k in range(30):
        words = prose(3000 + k, 200).split()
        rows += [(k, " ".join(words)), (1000 + k, " ".join([*words[:100], "changed", *words[101:]]))]
        one, two = (simhash.fingerprint(t.encode(), copies.SHINGLE) for _, t in rows[-2:])
        want += [k] if (one ^ two).bit_count() <= simhash.MAX_BITS else [k, 1000 + k]
    assert 30 < len(want) < 60
    rows += [(5000, None), (5001, ""), (5001, " ")]
    monkeypatch.setattr(copies, "near_links", lambda members, *_: members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    kept = corpus_pipeline.near_copies_out(spark, docs(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*want, 5000])


def test_targets_fill_like_water(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 2000), (None, 5), ("d", 0)]
    frame = spark.createDataFrame(sizes, "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    order = ["a", "b", "c", "d", None]
    weight, size = dict(zip(order, [5, 2, 1, 5, 2], strict=True)), dict(sizes)
    left, open_, want = float(sum(size.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * size[s]}
        for s in full or open_:
            want[s] = 3.0 * size[s] if full else level * weight[s]
        left -= sum(want[s] for s in full)
        open_ = open_ - full if full else set()
    assert found == pytest.approx(want)


def lands_near(found):
    """No source is further off than half its smallest document outside the sample; rows of one id count together."""
    units = {}
    for r in found:
        unit = units.setdefault((r.source, r.doc_id), [0, r.copies > r.epochs])
        unit[0] += r["size"]
        assert unit[1] == (r.copies > r.epochs)
    for source in {r.source for r in found}:
        [target] = {r.target for r in found if r.source == source}
        taken = sum(r.taken for r in found if r.source == source)
        out = [size for (s, _), (size, drawn) in units.items() if s == source and not drawn]
        assert not out or abs(int(target) - taken) <= min(out) / 2, (source, target, taken, min(out))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_mix_of_the_tables(spark, folder):
    read = lambda name: spark.read.parquet(f"/root/testdata/{folder}/{name}.parquet")
    lands_near(mixing.mix(read("documents"), read("labels")).collect())


def test_mix(spark):
    rows = [(k, prose(k, 5 + k % 50), "abc"[k % 3]) for k in range(600)] + [(None, None, None), (1, prose(1, 6), "b"), (700, prose(9, 4000), "c")]
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (2, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = mixing.mix(docs(spark, rows), labels)
    found = out.collect()
    assert len(found) == len(rows) and all(r.taken == r.copies * r["size"] <= 3 * r["size"] for r in found)
    by = {}
    for r in found:
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(a - b) <= 50 for s, (a, b) in by.items() if s != "c")
    lands_near(found)
    assert sorted(map(str, out.collect())) == sorted(map(str, found))
    whole = mixing.mixed_rows(docs(spark, rows), labels)
    assert whole.columns == docs(spark, []).columns and whole.count() == sum(r.copies for r in found)


def test_a_plan_of_the_mix_does_not_grow_with_its_steps(spark, monkeypatch):
    joins, steps, write = [], [], mixing.stage

    def counted(df, name):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        steps.append(name)
        return write(df, name)

    monkeypatch.setattr(mixing, "stage", counted)
    rows = [(k, prose(k, 5 + k % 50), "abc"[k % 3]) for k in range(600)] + [(700, prose(9, 4000), "c"), (701, prose(8, 900), "a")]
    found = mixing.mix(docs(spark, rows))
    joins.append(found._jdf.queryExecution().optimizedPlan().toString().count("Join "))
    assert steps.count("step") > 1 and max(joins) <= 2  # before, one more for each step in the last plan, and five in the plan of a step
    lands_near(found.collect())


def test_sampling_prefers_quality(spark):
    rows = [(k, "one two three four", "ab"[k % 2]) for k in range(4000)]
    labels = spark.createDataFrame([(k, k // 2 % 2, 0) for k in range(4000)], "doc_id long, quality int, toxic int")
    drawn = {r.doc_id for r in mixing.mix(docs(spark, rows), labels).collect() if r.copies > r.epochs}
    good = sum(k // 2 % 2 for k in drawn)
    assert good > 1.5 * (len(drawn) - good)


# token files


def test_blocks_round_trip():
    pick = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 5000):
        for most in (1, 3, 300, 50257, (1 << 32) - 1):
            ids = pick.integers(0, most, n, np.uint32, endpoint=True)
            raw = tokens.pack_segment(ids)
            assert (tokens.unpack_segment(raw) == ids).all()
            if n:
                last = (n - 1) // tokens.BLOCK
                assert (tokens.read_block(raw, last) == ids[last * tokens.BLOCK :]).all()


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = mixed_rows()
    path = f"file://{tmp_path}/tokens"
    tokens.write_token_files(docs(spark, rows), path)
    found = sorted(tokens.read_token_files(spark, path).collect(), key=lambda r: r.start)
    tool = Tokenizer.from_file(tokens.default_tokenizer())
    # special strings in a text are read as such, the default of the library that the contract names
    want = sorted([(d is not None, d or 0, tuple(tool.encode(t or "", add_special_tokens=False).ids + [2])) for d, t, *_ in rows])
    assert sorted([(r.doc_id is not None, r.doc_id or 0, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found]) == want
    assert [r.doc_id for r in found] == sorted([r.doc_id for r in found], key=lambda d: (d is not None, d or 0))
    at = 0
    for r in found:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        at += r.n_tokens


@pytest.mark.parametrize("text", ["a  b", " lead", "x\n\ny z", "it's 3.5%, ok", "a \t b", "é. Ünd", "tail ", "one\ntwo. three!", "²½ a1b2"])
def test_pieces_equal_the_library(text):
    tool = tokens.Encoder(tokens.default_tokenizer())
    assert np.frombuffer(tool.encode(text), "<u4").tolist() == tool.tool.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["x ab$$$", "x AB!!\nÄb,%%% c", "x a'", "x a's b't", "x a''s", "x ab.\n\nc", "x a²!", "x a\n", "x !\n?", "äb c", "x a_-b", "x (a)\nb)"])
def test_letters_with_marks_equal_the_library(text):
    tool = tokens.Encoder(tokens.default_tokenizer())
    assert np.frombuffer(tool.encode(text), "<u4").tolist() == tool.tool.encode(text, add_special_tokens=False).ids


def test_the_encoder_keeps_what_it_is_asked_for_again(monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 40)
    monkeypatch.setattr(tokens, "WORDS", 10)
    tool, made = tokens.Encoder(tokens.default_tokenizer()), []
    make = tool.pieces.make
    tool.pieces.make = lambda text: made.append(text) or make(text)
    for k in range(60):
        text = f"x often {prose(k, 12)} again, one\ntwo{k}. three!\n"
        assert np.frombuffer(tool.encode(text), "<u4").tolist() == tool.tool.encode(text, add_special_tokens=False).ids
        assert len(tool.pieces) <= 40 + 40 and len(tool.pieces.older) <= 40 + 40
    assert made.count("often") == made.count("again,") == 1


def test_the_reader_can_leave_the_ids_in_the_workers(spark, tmp_path):
    path = f"file://{tmp_path}/tokens"
    tokens.write_token_files(docs(spark, mixed_rows()), path)
    whole = tokens.read_token_files(spark, path)
    assert sorted(map(str, tokens.read_token_files(spark, path, ids=False).collect())) == sorted(map(str, whole.drop("ids").collect()))


# models


def test_language(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op9_language_id"](spark, SMALL).collect()}
    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()
    held = [found[r.doc_id].lang_pred == r.lang for r in truth if found[r.doc_id].held_out]
    assert len(found) == len(truth) and sum(held) / len(held) > 0.95
    table = docs(spark, [(1, "der die das und"), (2, "the of and that"), (3, None), (4, "12 ?!"), (None, "der das die")]).withColumn(
        "lang", F.when(F.col("doc_id") == 1, "de").when(F.col("doc_id") == 2, "en")
    )
    out = {r.doc_id: r for r in language.predict(table, language.train(table, F.lit(True))).collect()}
    assert [out[k].lang_pred for k in (1, 2, 3, 4, None)] == ["de", "en", "und", "und", "de"]
    assert all(0 <= r.score <= 1 for r in out.values())


def test_grams_against_slices():
    text = "Abc, def-g 12 hij"
    want = {}
    for word in ("abc", "def", "g", "hij"):
        padded = f" {word} "
        for n in range(1, 6):
            for k in range(len(padded) - n + 1):
                if padded[k : k + n].strip():
                    want[padded[k : k + n]] = want.get(padded[k : k + n], 0) + 1
    found, counts = language.grams(text)
    assert len(found) == len(want) and sorted(counts.tolist()) == sorted(want.values())


def test_toxicity(spark):
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        words = prose(k, 30).split()
        if bad:
            words[5:5] = ["vile", "scoundrel" + "xyz"[k % 3]]
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(bad)))
    labels += [(None, 1, 1), (401, 1, None), (0, 1, 0)]
    rows += [(500, None), (501, ""), (502, "vile " * 50_000), (None, "fine words")]
    table = docs(spark, rows)
    model = toxicity.train(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), ~toxicity.held_out())
    found = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found.values())
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 3 == 1]
    right = [found[k].predicted == (k % 4 == 0) for k in held]
    assert sum(right) / len(right) > 0.9
    clean = toxicity.keep_clean(table, model)
    assert clean.columns == table.columns and clean.count() == sum(1 - r.predicted for r in found.values())


def test_the_model_is_sent_once(spark, monkeypatch):
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(1) or send(self, value))
    table = docs(spark, [(k, f"{prose(k, 20)} {'vile' if k % 4 == 0 else 'fine'}") for k in range(80)])
    model = toxicity.train(table, spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(80)], "doc_id long, quality int, toxic int"), F.lit(True))
    assert toxicity.score(table, model).count() == 80 >= toxicity.keep_clean(table, model).count()
    assert len(sent) == 1  # before, one for the fit and one for each use


def test_toxicity_counts_all_texts(spark, monkeypatch):
    rows = [(k, f"{prose(k, 30)} {'vile scoundrel' if k % 4 == 0 else 'fine fellow'}") for k in range(400)]
    table = docs(spark, [*rows, (500, None), (501, "vile " * 3000), (502, "unlabelled vile scoundrel"), (502, "unlabelled vile scoundrel")])
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    model = toxicity.train(table, labels, F.lit(True), bound=40)
    fit = {r.doc_id for r in toxicity.training_rows(labels, F.lit(True), 40).filter("checks").collect()}
    seen = []
    for k, text in rows:
        words = toxicity.Hasher()(text.encode())
        seen += toxicity._pair_keys(words, np.zeros(1, np.int64))[1].tolist() if k not in fit else []
    assert 0 < len(fit) <= 80 and set(model.pairs.tolist()) == {x for x in seen if seen.count(x) > 1}  # of all texts
    scored = toxicity.score(table, model).collect()
    monkeypatch.setattr(toxicity, "SENT", 0)  # the join of a table too large to send gives the same
    joined = toxicity.train(table, labels, F.lit(True), bound=40)
    assert joined.table is not None and not len(joined.pairs)
    key = lambda r: (r.doc_id, r.score)
    found = toxicity.score(table, joined).collect()
    assert [r.doc_id for r in sorted(found, key=key)] == [r.doc_id for r in sorted(scored, key=key)]
    assert np.allclose([r.score for r in sorted(found, key=key)], [r.score for r in sorted(scored, key=key)])
    assert toxicity.keep_clean(table, joined).count() == sum(1 - r.predicted for r in scored)


# licences


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Some text.\nReleased under the MIT License.\nMore.", "MIT"),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted.\n"
         "# Redistributions of source code must retain the above copyright notice.\n"
         "# Redistributions in binary form must reproduce the above copyright notice.\n"
         "# Neither the name of X nor its contributors may be used to endorse or promote products.", "BSD-3-Clause"),
        ("Redistribution and use in source and binary forms are permitted. Redistributions of source code must retain the above "
         "copyright notice. Redistributions in binary form must reproduce the above copyright notice.", "BSD-2-Clause"),
        ("A poetic licence was granted.", ""),
        (None, ""),
    ],
)
def test_licence_rules(spark, text, want):
    [row] = licences.licence_scan(docs(spark, [(1, text)])).collect()
    assert row.licences == want
    assert row.n_unknown == row.sentence_ids.split(",").count("unknown")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT"),
        ("/* SPDX-License-Identifier: Apache-2.0 */\nint x;", "Apache-2.0"),
        ("#!/bin/sh\n# SPDX-License-Identifier: GPL-2.0-only\nset -e", "GPL-2.0"),
        ("# Copyright 2020 X\n# SPDX-License-Identifier:\tGPL-3.0-or-later\n\nimport os", "GPL-3.0"),
        ("<!-- SPDX-License-Identifier: BSD-2-Clause -->", "BSD-2-Clause"),
        (" * SPDX-License-Identifier:BSD-3-Clause\r\n * more", "BSD-3-Clause"),
        ("// spdx-license-identifier: MIT\nreleased under the MIT License: see the file.", "MIT"),
        ("Licence: see below.\nReleased under the Apache License, Version 2.0.", "Apache-2.0"),
    ],
)
def test_spdx_tags(spark, text, want):
    [row] = licences.licence_scan(docs(spark, [(1, text)])).collect()
    assert row.licences == want


@pytest.mark.parametrize(
    ("tag", "want"),
    [
        ("MIT-0", "MIT-0"),
        ("BSD-3-Clause-Clear", "BSD-3-Clause-Clear"),
        ("Apache-2.0 OR MIT", "Apache-2.0,MIT"),
        ("(MIT AND (apache-2.0 or isc)) -- see LICENSE", "MIT,Apache-2.0,ISC"),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0", "GPL-2.0 WITH Classpath-exception-2.0"),
        ("GPL-2.0+ OR MPL-2.0.", "GPL-2.0,MPL-2.0"),
        ("LGPL-2.1-only", "LGPL-2.1"),
        ("LicenseRef-Own-1", "LicenseRef-Own-1"),
        ("MITX", ""),
        ("", ""),
    ],
)
def test_spdx_expressions(spark, tag, want):
    [row] = licences.licence_scan(docs(spark, [(1, f"// SPDX-License-Identifier: {tag}\nint x;")])).collect()
    assert row.licences == want and row.n_unknown == (not want)
    assert row.expressions == tag.split(" --")[0].rstrip(".")


#: Pieces of text and the licences they grant.
GRANTS = [
    ("Released under the MIT License.", ["MIT"]),
    ("This is not licensed under the MIT license.", []),
    ("It is no longer released under the Apache License, Version 2.0 but under the Eclipse Public License v2.0.", ["EPL-2.0"]),
    ("It is not only licensed under the MIT License.", ["MIT"]),
    ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", ["MPL-2.0"]),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software "
     "Foundation, Inc.\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.", ["GPL-2.0"]),
    ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", ["LGPL-3.0"]),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\n  Version 3, 19 November 2007", ["AGPL-3.0"]),
    ("                                 Apache License\n                           Version 2.0, January 2004", ["Apache-2.0"]),
    ("Eclipse Public License - v 2.0", ["EPL-2.0"]),
    ("MIT No Attribution", ["MIT-0"]),
    ("This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable. "
     "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications.", ["Zlib"]),
    ("# SPDX-License-Identifier: ISC OR Zlib", ["ISC", "Zlib"]),
    ("A word on the weather.", []),
]


def test_licences_of_random_texts(spark):
    rows, want = [], {}
    for k in range(120):
        pick = random.Random(k)
        chosen = [GRANTS[k]] if k < len(GRANTS) else [pick.choice(GRANTS) for _ in range(pick.randint(1, 6))]
        rows.append((k, "\n\n".join(f"{prose(k + 7, pick.randint(1, 30))}\n\n{piece}" for piece, _ in chosen)))
        want[k] = {x for _, names in chosen for x in names}
    rows += [(500, prose(1, 100_000) + "\n\n" + GRANTS[0][0] + "\n\n" + prose(2, 100_000)), (501, GRANTS[0][0]), (501, GRANTS[0][0]), (None, None)]
    want |= {500: {"MIT"}, 501: {"MIT"}, None: set()}
    found = licences.licence_scan(docs(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(k) for k, _ in rows)
    for r in found:
        assert set(r.licences.split(",")) - {""} == want[r.doc_id], r


def test_pairs_outside_the_table_are_not_asked_for(spark):
    hasher, texts = toxicity.Hasher(), [(k, prose(4000 + k, 80)) for k in range(6)] + [(9, None), (9, "")]
    keys = [np.unique(toxicity._pair_keys(w, np.zeros(min(1, len(w)), np.int64))[1]) for w in (hasher((t or "").encode()) for _, t in texts)]
    kept = keys[0][::2].tolist() + keys[3][::3].tolist()
    table = spark.createDataFrame([(k, 0.5, 0.25) for k in set(kept)], "pair long, d0 float, d1 float")
    slots = table.select(F.col("pair").bitwiseAND(F.lit((1 << 26) - 1)).alias("slot"))
    known = bit_filter(slots, 26)
    for own in keys:
        passed = toxicity._listed(own[::-1], known, (1 << 26) - 1).tolist()
        assert set(kept) & set(own.tolist()) <= set(passed) <= set(own.tolist()) and passed == sorted(passed)
        assert len(passed) <= len(set(kept) & set(own.tolist())) + 2
    found = {r.doc_id: r._pairs for r in toxicity._own_pairs(docs(spark, texts), table).collect()}
    for k, own in enumerate(keys[:6]):
        assert sorted(x.pair for x in found[k] or []) == sorted(set(kept) & set(own.tolist()))


def test_pairs_are_counted_once_in_packed_buckets(spark, monkeypatch):
    hasher = toxicity.Hasher()
    texts = [f"{prose(k % 37, 60)} once{k} {'vile ' * (k % 5)}" for k in range(150)] + ["", "vile", None]
    kinds = [(0, 1, None)[k % 3] for k in range(len(texts))]
    words = [hasher((t or "").encode()) for t in texts]
    pairs = [toxicity._pair_keys(w, np.zeros(min(1, len(w)), np.int64)) for w in words]
    want = {}  # pair: slots of its words, counts by class
    for w, (before, keys), kind in zip(words, pairs, kinds, strict=True):
        slots = zip(toxicity._slots(before).tolist(), toxicity._slots(w).tolist(), toxicity._stems(w).tolist(), strict=True)
        for key, at in zip(keys.tolist(), slots, strict=True):
            n = want.setdefault(key, (at, [0, 0]))[1]
            if kind is not None:
                n[kind] += 1
    blobs = list(toxicity._packed(list(words), [2 if k is None else k for k in kinds], 3))
    assert sum(len(x) for _, x in blobs) < 24 * len(want)  # a row of its own took 16 bytes, and 8 for the shared counts
    found = [np.concatenate(x) for x in zip(*(toxicity._unpacked(x) for _, x in blobs), strict=True)]
    got = Counter(zip(toxicity._pair_hash(found[0], found[1]).view(np.int64).tolist(), found[2].tolist(), strict=True))
    assert max(got.values()) == 1 and {k for k, _ in got} == set(want)
    monkeypatch.setattr(toxicity, "GATHERED", 900)  # several packages a task
    rows = toxicity._count(spark.createDataFrame(list(zip(kinds, texts, strict=True)), "toxic int, text string")).collect()
    assert {r.key: [r.n0, r.n1] for r in rows if r.kind == toxicity.PAIR} == {k: n for k, (_, n) in want.items() if sum(n) > 1}
    assert all(r.ahead == want[r.key][0][0] for r in rows if r.kind == toxicity.PAIR)
    for kind, place in ((toxicity.WORD, 1), (toxicity.STEM_OF, 2), (toxicity.AHEAD, 0)):
        sums, due = {}, {}
        for r in rows:
            if r.kind == kind:
                sums[r.key] = [a + b for a, b in zip(sums.get(r.key, [0, 0, 0]), (r.n0, r.n1, r.n), strict=True)]
        for at, (a, b) in want.values():
            more = (a, b, 0) if kind == toxicity.AHEAD else (a > 0, b > 0, kind == toxicity.WORD)
            due[at[place]] = [x + y for x, y in zip(due.get(at[place], [0, 0, 0]), more, strict=True)]
        assert sums == {k: n for k, n in due.items() if any(n)}


def test_the_driver_takes_pairs_in_by_ranges(spark, monkeypatch):
    draw = random.Random(3)
    rows = {draw.randrange(-(1 << 63), 1 << 63): (draw.randrange(4), draw.choice([2, 3, 70_000])) for _ in range(300)}
    rows |= {-(1 << 63): (5, 0), (1 << 63) - 1: (0, 5), 0: (1, 1)}
    table = spark.createDataFrame([(k, a, b) for k, (a, b) in rows.items()], "key long, n0 long, n1 long")
    taken, arrays = [], toxicity._arrays
    monkeypatch.setattr(toxicity, "AT_ONCE", 50)
    monkeypatch.setattr(toxicity, "_arrays", lambda df, names: (x := arrays(df, names), taken.append(len(x[0])))[0])
    listed, kind, kinds = toxicity._listed_pairs(table, len(rows))
    assert listed.tolist() == sorted(rows) and max(taken) < 100
    assert kinds[:, kind].T.tolist() == [[max(n - toxicity.DISCOUNT, 0) for n in rows[k]] for k in sorted(rows)]
    assert len(toxicity._listed_pairs(table.limit(0), 0)[0]) == 0


def test_a_worker_keeps_one_cache():
    made = per_worker("first", list)
    assert per_worker("first", list) is made
    per_worker("second", list)  # what an earlier stage kept is let go
    assert per_worker("first", list) is not made


def test_a_cache_that_is_kept_costs_no_collection():
    class Cache(dict):
        pass

    def make():
        found = Cache()
        found["itself"] = found
        return found

    gone = weakref.ref(per_worker("third", make, large=True))
    assert not any(x is gone() for x in gc.get_objects())
    per_worker("fourth", list)
    assert gone() is None


def test_kept_pieces_are_made_once():
    asked = []
    kept = tokens._Kept(lambda x: asked.append(x) or x.encode())
    assert b"".join(map(kept.__getitem__, ["a", "b", "a"])) == b"aba" and asked == ["a", "b"]


# benchmark leaks


def test_leaks(spark):
    items = [(k, prose(900 + k, 20 + k)) for k in range(30)] + [(99, None), (98, "")]
    words = items[3][1].split()
    para = " ".join(words[:4] + ["other"] + words[5:12] + ["new", "words"] + words[12:])
    rows = [(k, f"{prose(k, 100)} {items[k][1].upper()}, {prose(k + 50, 60 + k)}") for k in range(10)]
    rows += [(20, prose(77, 40) + " " + para + " " + prose(78, 40)), (21, prose(79, 5000)), (22, None), (23, items[5][1]), (23, items[5][1])]
    table, bench = docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(table, bench).collect())
    assert found == sorted([(k, k) for k in range(10)] + [(20, 3), (23, 5), (23, 5)])
    left = decontaminate.drop_leaks(table, bench)
    assert left.columns == table.columns and sorted(r.doc_id for r in left.collect()) == [21, 22]


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 4)
    items = [(k, prose(900 + k, 30)) for k in range(10)]
    table = docs(spark, [(k, f"{prose(k, 50)} {items[k][1]}") for k in range(10)])
    found = decontaminate.find_leaks(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(k, k) for k in range(10)]


def test_the_space_is_of_all_documents(spark):
    """More documents than the SVD lets weigh; each passage is in it at unit length, none is left out."""
    count = decontaminate.CORPUS + 300
    vocabulary = {f"word{k}": k + 1 for k in range(count)}
    rows = [(k, f"word{k} none none") for k in range(count)] + [(None, None), (count, "")]
    numbers = decontaminate.numbered(decontaminate.doc_texts(docs(spark, rows)), vocabulary)
    frequency, total = decontaminate.document_frequencies(numbers, vocabulary)
    assert total == count + 2 and (frequency[1:] == 1).all()
    sketch = decontaminate.corpus_sketch(numbers, vocabulary, np.ones(count + 1))
    assert sketch.shape == (decontaminate.ROWS, count + 1) and np.allclose((sketch**2).sum(axis=0)[1:], 1)
    assert not sketch[:, 0].any()


def test_passages_are_two_neighbouring_blocks_of_a_text():
    n = decontaminate.BLOCK
    idf, pick = np.arange(8) / 4.0, random.Random(3)
    for size in (0, 1, n, n + 1, 2 * n, 2 * n + 1, 5 * n - 3):
        first, second = (np.array([pick.randrange(8) for _ in range(k)], np.int32) for k in (size, 3 * n))
        both, alone = np.zeros((2, 1 << 16, 8))
        decontaminate.sketch_of([5, 6], [first, second], idf, both)
        decontaminate.sketch_of([6], [second], idf, alone)
        want = []
        for k in range(max(1, -(-size // n) - 1)):
            v = np.zeros(8)
            for half in (first[k * n : (k + 1) * n], first[(k + 1) * n : (k + 2) * n]):
                v[np.unique(half)] += idf[np.unique(half)]
            v[0] = 0
            want += [v / np.linalg.norm(v)] if v.any() else []
        found = (both - alone)[np.abs(both - alone).sum(axis=1) > 1e-12]
        assert np.allclose(sorted(np.abs(found).tolist()), sorted(map(list, want))), size


def test_common_subsequence():
    pick = random.Random(4)
    for _ in range(50):
        a, b = ([pick.randrange(5) for _ in range(pick.randrange(12))] for _ in range(2))
        grid = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                grid[i + 1][j + 1] = grid[i][j] + 1 if x == y else max(grid[i][j + 1], grid[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == grid[-1][-1]


# quotations


def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nThanks a lot."),
        (1, 1, "assistant", "> how do I   sort?\nUse sorted."),
        (1, 2, "user", ">> How do I sort?\n> Use sorted.\nAnd reversed?"),
        (1, 3, "user", "> Nobody said this\nhm"),
        (1, 4, "user", "> And\n> reversed?\nyes"),
        (1, 5, "user", "plain"),
        (2, 0, "user", "> How do I sort?\nother conversation"),
        (None, 0, "user", "> plain"),
        (3, None, None, None),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash"))
    found = {(r.conv_id, r.turn): r for r in quotes.link_quotes(table).collect()}
    assert len(found) == len(rows)
    got = {k: (r.text, r.n_quotes, r.n_linked, r.parent_turn, r.thread_turn, r.depth) for k, r in found.items()}
    assert got[1, 0] == ("How do I sort?\nThanks a lot.", 0, 0, None, 0, 0)
    assert got[1, 1] == ("Use sorted.", 1, 1, 0, 0, 1)
    assert got[1, 2] == ("And reversed?", 2, 2, 1, 0, 2)
    assert got[1, 3] == ("hm", 1, 0, None, 3, 0)
    assert got[1, 4] == ("yes", 1, 1, 2, 0, 3)
    assert got[2, 0][2:] == (0, None, 0, 0)
    assert got[None, 0][2] == 0 and got[3, None][0] == ""


def test_quotes_of_sentences(spark):
    first = "Sorting is easy. Use the sorted\nfunction on any list. Does \"it\" copy? Yes it does."
    rows = [
        (1, 0, "user", first),
        (1, 1, "assistant", "Another line. Nothing else."),
        (1, 2, "user", "> Does \"it\" copy?\nI think so."),  # a part of a line
        (1, 3, "user", "> Use the sorted function on\n> any list.\nWhich one?"),  # wrapped anew
        (1, 4, "user", "> Use the sorted function on\n> any list. Does \"it\" copy?\nboth"),
        (1, 5, "user", "> sorted function on\nno whole sentence"),
        (1, 6, "user", "> Nothing else.\nright"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.turn: (r.n_linked, r.parent_turn, r.thread_turn) for r in quotes.link_quotes(table).collect()}
    assert found == {0: (0, None, 0), 1: (0, None, 1), 2: (1, 0, 0), 3: (1, 0, 0), 4: (1, 0, 0), 5: (0, None, 5), 6: (1, 1, 1)}


# queries and pipeline


def test_native_query_runs_no_python(spark):
    plan = queries.QUERIES["op3_quotation_links"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_pipeline(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    rows = corpus_pipeline.run(spark, SMALL).collect()
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert rows and isinstance(rows[0].asDict()["doc_id"], int)
    assert isinstance(spark.read.parquet(f"{SMALL}/documents.parquet").schema["doc_id"].dataType, T.LongType)


def test_fit_settles_on_separable_classes():
    pick = np.random.default_rng(2)
    y = (np.arange(2000) % 10 == 0).astype(float)
    x = pick.standard_normal((2000, 6)) + 9 * y[:, None]
    weights = toxicity.fit_weights(x, y, np.where(y == 1, 1.0, 3.0))
    p = toxicity.probabilities(weights, x)
    assert ((p > 0.7) == (y == 1)).all()


def test_python_steps_of_texts_get_short_batches(spark, monkeypatch):
    """op2 and the stage of near duplicates let no task hold thousands of texts at once, whatever they are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = [(k, prose(4000 + k // 2, 200)) for k in range(400)]
    texts = docs(spark, rows).repartition(1)

    def sizes(parts):
        for b in parts:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    monkeypatch.setattr(_common, "ARROW_BYTES", 1 << 16)
    with _common.short_batches(spark):
        found = [r.n for r in texts.select("text").mapInArrow(sizes, "n long").collect()]
    assert len(found) > 5 and max(found) < 1 << 17
    seen = []
    for module, step in ((repeats, "swept"), (copies, "stage")):
        monkeypatch.setattr(module, step, lambda df, kind, own=getattr(module, step): seen.append(spark.conf.get(name, None)) or own(df, kind))
    result = repeats.remove_repeats(docs(spark, rows))
    assert {r.n_removed == r.n_bytes for r in result.collect()} == {True}
    # of the filter and the cut of whole texts one Python step is made, beside the filter and the cut of the others
    assert result._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 3
    assert sorted(r.doc_id for r in copies.keep_one(docs(spark, rows)).collect()) == list(range(0, 400, 2))
    assert set(seen) == {str(1 << 16)} and spark.conf.get(name, None) is None
    spark.conf.set(name, "1m")  # the session's own stays
    with _common.short_batches(spark):
        assert spark.conf.get(name) == "1m"
    assert spark.conf.get(name) == "1m"
    spark.conf.unset(name)


def test_an_earlier_stage_s_cache_is_let_go():
    _common.per_worker("some cache", lambda: {})["a"] = 1
    assert _common.per_worker("some cache", lambda: {}) == {"a": 1}
    _common.let_go()
    assert _common.per_worker("some cache", lambda: {}) == {}
    _common.let_go()


def test_swept_stages_leave_no_shuffle_behind(spark):
    """op2's shuffle files do not wait for the driver to collect its garbage."""
    import time

    kept = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ").count(".data")
    _common.sweep(spark)  # of earlier tests
    assert _common.swept(spark.range(1000).select((F.col("id") % 10).alias("k")).groupBy("k").count(), "some").collect()
    before = kept()
    _common.sweep(spark)
    for _ in range(50):
        if kept() < before:
            break
        time.sleep(0.1)
    assert kept() < before
