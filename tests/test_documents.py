"""Served documents: one JSON text in pieces, its manifest, and the way back."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import document, lookup, quality, snapshot
from tidemark.session import scratch_path

ROWS = "position bigint, uid string, city string, price int, km double, tags array<string>"


def shot(spark, rows):
    frame = spark.createDataFrame(rows, ROWS)
    return snapshot.dictionary_encode(frame, "position", {"city": "ct"}, {"tags": ("tg", "tag")})


def served(spark, rows):
    header = spark.createDataFrame([("2024-01-30", len(rows))], "generated string, count bigint")
    return document.Document(header, shot(spark, rows), "cards", {"city": "city", "tag": "label"})


AWKWARD = ['quo"te', "back\\slash", "line\nbreak", "tab\t", "ação – 😀", "", None, "a,b]}", "\x01", "null"]


def awkward_rows(n):
    return [
        (i, f"u{i}", AWKWARD[i % len(AWKWARD)], None if i % 7 == 0 else i, i / 8, [AWKWARD[(i * k) % 10] for k in range(i % 4)])
        for i in range(n)
    ]


def witness(rows):
    """The document by a plain loop."""
    codes = {"city": {}, "tag": {}}

    def code(kind, value):
        return codes[kind].setdefault(value, len(codes[kind]))

    cards = {c: [] for c in ("uid", "price", "km", "ct", "tg")}
    for _, uid, city, price, km, tags in rows:
        cards["uid"].append(uid)
        cards["price"].append(price)
        cards["km"].append(km)
        cards["ct"].append(code("city", city or ""))
        cards["tg"].append([code("tag", t) for t in tags if t is not None])
    return {"generated": "2024-01-30", "count": len(rows), "dict": {"city": list(codes["city"]), "label": list(codes["tag"])}, "cards": cards}


def text_of(path):
    files = sorted(Path(path.removeprefix("file:"), "document").glob("part-*"))
    return b"".join(f.read_bytes() for f in files)


@pytest.mark.parametrize("n, size", [(0, 4), (1, 4), (9, 4), (64, 16), (64, 4096)])
def test_document_is_one_json_text(spark, n, size):
    rows = awkward_rows(n)
    path = scratch_path(spark, "document")
    manifest = document.write_document(served(spark, rows), path, size=size).collect()
    raw = text_of(path)
    want = witness(rows)
    assert json.loads(raw) == want
    whole = [r for r in manifest if r.section is None]
    assert [r.n_bytes for r in whole] == [len(raw)]
    lengths = {(r.section, r.name): r.n_values for r in manifest if r.name}
    assert lengths == {(1, k): len(v) for k, v in want["dict"].items()} | {(2, k): len(v) for k, v in want["cards"].items()}
    parts = {r.name: r.n_parts for r in manifest if r.section == 2}
    assert set(parts.values()) == {-(-n // size)}


def test_document_reads_back(spark):
    rows = awkward_rows(50)
    doc = served(spark, rows)
    path = scratch_path(spark, "document")
    document.write_document(doc, path, size=8)
    back = document.read_rows(spark, path, doc.shot.rows.schema, 8)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, doc.shot.rows.select(back.columns).collect()))
    words = {(r.column, r.code): r.value for r in document.read_dictionary(spark, path, 8).collect()}
    assert words == {("label" if r.column == "tag" else r.column, r.code): r.value for r in doc.shot.dictionary.collect()}


def test_guard_refuses_and_writes_nothing(spark):
    doc = served(spark, awkward_rows(40))
    size = document.document_bytes(document.pieces(doc))
    path = scratch_path(spark, "document")
    with pytest.raises(ValueError, match="exceeds"):
        document.write_document(doc, path, max_mb=(size - 1) / snapshot.BYTES_PER_MB)
    assert not Path(path.removeprefix("file:")).exists()
    document.write_document(doc, path, max_mb=size / snapshot.BYTES_PER_MB)


def test_encoding_joins_once(spark):
    frame = spark.createDataFrame(awkward_rows(30), ROWS).withColumns({f"c{i}": F.col("uid") for i in range(6)})
    names = {"city": "ct"} | {f"c{i}": f"d{i}" for i in range(6)}
    plan = snapshot.dictionary_encode(frame, "position", names).rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # with the dictionary, and with the rows


def test_lookup_is_judged_by_its_bytes(spark):
    wide = spark.range(50).select(F.repeat(F.lit("x"), 1000).alias("value"))
    assert 50_000 < lookup.byte_size(wide) < 60_000
    hint = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hint(lookup.sized(wide, lookup.byte_size(wide), 60_000)) and not hint(lookup.sized(wide, lookup.byte_size(wide), 50_000))


def test_key_checks(spark):
    bodies = ['{"a": 1, "b": null}', '{"a": 1}', "{}", "[1]", "{broken", None, '{"a": 1, "a": 2, "b": 3, "description": "x"}']
    frame = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert {r.key: r.n_rows for r in quality.key_census(frame, "body").collect()} == {"a": 3, "b": 2, "description": 1}
    assert {r.missing: r.n_rows for r in quality.missing_keys(frame, "body", ("a", "b")).collect()} == {"a": 4, "b": 5}
    assert quality.dq_columns(frame, "body", ("a", "b")).first().n_bad == 5
    assert quality.dq_no_description(frame, "body").first().n_bad == 1
    none = frame.where("false")
    assert quality.dq_columns(none, "body").first().ok and quality.missing_keys(none, "body", ("a",)).count() == 0


def test_manifest_check(spark):
    counted = document.manifest(document.pieces(served(spark, awkward_rows(20)), 8))
    checks = quality.dq_manifest(counted, 20, ("uid", "km", "gone"), ("city", "label"))
    assert [tuple(r) for r in checks.collect()] == [("document_arrays", False, 1), ("document_lengths", True, 0)]
    assert quality.dq_manifest(counted, 21, ("uid",)).where("check = 'document_lengths'").first().n_bad == 5


def test_threshold_check(spark):
    rule = {"rent_min": 1, "land_min": 2}
    heads = ['{"match_rule":{"rent_min":1,"land_min":2}}', '{"match_rule":{"rent_min":1,"land_min":3}}', '{"match_rule":{}}', "{}", None]
    frame = spark.createDataFrame([(h,) for h in heads], "header string")
    assert quality.dq_rule_thresholds(frame, "header", rule).first().n_bad == 4
