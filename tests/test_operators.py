"""Operators against brute force, on skewed and awkward inputs."""

from __future__ import annotations

import json
import random
import statistics
from collections import defaultdict
from itertools import groupby, pairwise
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import (bars, catalog, explore, geo, history, listings, lookup, ordering, postings,
                                quality, quantiles, risk, snapshot)
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming import ingest

START = date(2024, 1, 1)


def days(n):
    return START + timedelta(days=n)


# -- order and quantiles ---------------------------------------------------------------------

def test_positions_are_the_sorted_order(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aab"), rng.random()) for i in range(2000)]
    frame = spark.createDataFrame(rows, "i int, k string, x double").repartition(7)
    placed = ordering.with_position(frame, [F.col("k").desc(), "x", "i"])
    got = [r.i for r in sorted(placed.collect(), key=lambda r: r.position)]
    want = [r[0] for r in sorted(rows, key=lambda r: (-ord(r[1]), r[2], r[0]))]
    assert got == want
    assert sorted(r.position for r in placed.collect()) == list(range(2000))


def test_exact_median_with_a_hot_group(spark):
    rng = random.Random(2)
    rows = [("hot", rng.choice([-47.0, -47.0000001, rng.uniform(-50, -40)])) for _ in range(3000)]
    rows += [(f"k{i % 40}", round(rng.uniform(-90, 90), rng.choice([0, 3, 8]))) for i in range(900)]
    rows += [("none", None), ("one", 3.5), ("two", -1.0), ("two", 2.0)]
    frame = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: r.m for r in quantiles.exact_median(frame, ["k"], "x", geo.DEGREE_CELLS, "m").collect()}
    groups = defaultdict(list)
    for k, x in rows:
        if x is not None:
            groups[k].append(x)
    assert got == pytest.approx({k: statistics.median(v) for k, v in groups.items()}, abs=0)


def test_upper_middle(spark):
    for rents in ([1, 2, 3, 4], [5], [7, 7, 1_000_000, 2_000_001, 3], list(range(100, 0, -1))):
        frame = spark.createDataFrame([(x,) for x in rents], "rent int")
        got = listings.rent_stats(frame).first()
        assert (got["median"], got.lowest, got.highest) == (sorted(rents)[len(rents) // 2], min(rents), max(rents))


def test_cap_and_first_per_key(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "ord int, k string")
    capped = ordering.cap_per_key(frame, ["k"], "ord", 120)
    assert [r.ord for r in capped.where("k = 'hot'").orderBy("ord").collect()] == [i for i, k in rows if k == "hot"][:120]
    assert ordering.first_per_key(frame, ["k"], "ord").where("k = 'hot'").first().ord == 1


# -- bars and risk ---------------------------------------------------------------------------

def _series(spark, closes, ticker="T"):
    return spark.createDataFrame([(ticker, days(i), float(c)) for i, c in enumerate(closes)],
                                 "ticker string, date date, close double")


def test_warm_up_windows(spark):
    rng = random.Random(3)
    closes = [100.0]
    for _ in range(299):
        closes.append(closes[-1] * (1 + rng.uniform(-0.05, 0.05)))
    rows = risk.risk_metrics(_series(spark, closes)).orderBy("date").collect()
    known = lambda c: [i for i, r in enumerate(rows) if r[c] is not None]
    assert known("ret")[0] == 1
    assert known("vol_21d")[0] == 21 and known("ma50")[0] == 49 and known("ma200")[0] == 199
    assert known("high_52w")[0] == 19
    assert all(r.drawdown <= 0 for r in rows)
    returns = [closes[i] / closes[i - 1] - 1 for i in range(1, 22)]
    assert rows[21].vol_21d == pytest.approx(statistics.stdev(returns) * 252 ** 0.5)
    assert rows[299].high_52w == max(closes[48:]) and rows[299].low_52w == min(closes[48:])
    assert {r.risk_flag for r in rows[:21]} == {"OK"}


def test_zero_price_and_flat_series_do_not_fail(spark):
    rows = risk.risk_metrics(_series(spark, [0.0, 5.0] + [7.0] * 80)).orderBy("date").collect()
    assert rows[1].ret is None and rows[0].drawdown is None
    flat = _series(spark, [7.0] * 80, "A").unionByName(_series(spark, range(1, 81), "B"))
    assert risk.rolling_corr(risk.daily_return(flat), [("A", "B")]).count() == 0


def test_rolling_corr_needs_a_joint_window_and_serves_shared_legs(spark):
    rng = random.Random(4)
    frames = [_series(spark, [50 + rng.random() for _ in range(70)], t) for t in "ABC"]
    gap = frames[1].where(F.col("date") != days(30))
    returns = risk.daily_return(frames[0].unionByName(gap).unionByName(frames[2]))
    got = risk.rolling_corr(returns, [("A", "B"), ("A", "C")])
    counts = {r.pair: r["count"] for r in got.groupBy("pair").count().collect()}
    assert counts == {"A/C": 7}  # the gap leaves A/B no run of 63 joint returns
    assert got.where("abs(corr_63d) > 1").count() == 0


def test_kpi_notional_keeps_its_evaluation_order(spark):
    lots = spark.createDataFrame([("K", "Kay", "K", "c", 37500, "X"), ("C", "Cee", "C", "c", 50000, "X")],
                                 "ticker string, name string, pt string, unit string, contract_lbs int, exchange string")
    metrics = risk.risk_metrics(_series(spark, [324.9], "K").unionByName(_series(spark, [88.6], "C")))
    empty = risk.rolling_corr(metrics, [("K", "C")])
    got = {r.ticker: r for r in risk.kpi_snapshot(metrics, lots, empty).collect()}
    assert got["C"].contract_notional_usd == 44300.0 and got["K"].contract_notional_usd in (121837.0, 121838.0)
    assert got["K"].day_change_pct == 0.0 and got["K"].corr_63d is None


def test_completeness(spark):
    expected = spark.createDataFrame([("A",), ("B",)], "ticker string")
    with pytest.raises(ValueError, match="B"):
        bars.require_complete(_series(spark, [1], "A"), expected)
    assert bars.require_complete(_series(spark, [1], "A"), expected.where("ticker = 'A'")).count() == 1


# -- history ---------------------------------------------------------------------------------

def _python_upserts(batches, mutable):
    """Row-by-row upserts, the way the history is defined."""
    base = {}
    for today, rows in batches:
        for r in rows:
            old = base.get(r["k"])
            if old is None:
                base[r["k"]] = {**r, "first_seen_date": today, "last_seen_date": today}
            else:
                old.update({c: r[c] for c in mutable}, last_seen_date=today)
    return base


def test_upsert_equals_row_by_row(spark):
    rng = random.Random(5)
    schema = "k string, price int, title string, seq int"
    batches, seq = [], 0
    for d in range(5):
        rows = []
        for _ in range(60):
            key = "hot" if rng.random() < 0.35 else f"k{rng.randrange(25)}"
            rows.append({"k": key, "price": rng.choice([None, 1, 2, 3]), "title": f"t{seq}", "seq": seq})
            seq += 1
        batches.append((days(d), rows))
    base = spark.createDataFrame([], "k string, price int, title string, first_seen_date date, last_seen_date date")
    for today, rows in batches:
        batch = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
        base = history.upsert_keyed(base, batch, "k", ["price"], today.isoformat(), "seq")
        again = history.upsert_keyed(base, batch, "k", ["price"], today.isoformat(), "seq")
        base = spark.createDataFrame(base.collect(), base.schema)
        assert sorted(map(str, again.collect())) == sorted(map(str, base.collect()))
    want = _python_upserts(batches, ["price"])
    got = {r.k: r for r in base.collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        assert (got[k].price, got[k].title, got[k].first_seen_date, got[k].last_seen_date) == (
            w["price"], w["title"], w["first_seen_date"], w["last_seen_date"])


def _sightings(spark, n=800, seed=6):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(9)}", days(i * 12 // n), i,
             rng.choice([None, 1, 1, 2])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, d date, seq long, v int")


def test_change_log_and_counts_equal_neighbours(spark):
    rows, frame = _sightings(spark)
    log, inserted, changes = {}, defaultdict(int), defaultdict(int)
    for _, group in groupby(sorted(rows, key=lambda r: (r[0], r[2])), key=lambda r: r[0]):
        own = list(group)
        inserted[own[0][1]] += 1
        log[own[0][:2]] = own[0][3]
        for before, now in pairwise(own):
            if before[3] != now[3]:
                changes[now[1]] += 1
                log[now[:2]] = now[3]
    got = {(r.k, r.d): r.v for r in history.change_log(frame, "k", "d", "seq", "v").collect()}
    assert got == log
    for chunk in (7, 100_000):
        counts = history.change_counts(frame, "k", "d", "seq", "v", chunk).collect()
        assert {r.d: (r.inserted, r.changes) for r in counts} == {d: (inserted[d], changes[d]) for d in {r[1] for r in rows}}


def test_states_merge_in_any_order(spark):
    rows, frame = _sightings(spark)
    whole = history.collapse_sightings(frame, "k", ["v"], "d", "seq")
    parts = [history.collapse_sightings(frame.where(F.col("seq") % 3 == i), "k", ["v"], "d", "seq") for i in (2, 0, 1)]
    merged = history.merge_states(postings.union_sources([*parts, parts[0]]), "k", ["v"])
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_ingest_processes_each_file_once_and_survives_compaction(spark):
    _, frame = _sightings(spark)
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "state")
    want = sorted(map(str, history.collapse_sightings(frame, "k", ["v"], "d", "seq").collect()))
    for part, (low, high) in enumerate(((0, 300), (300, 500), (500, 800))):
        frame.where(F.col("seq").between(low, high - 1)).coalesce(2).write.mode("append").parquet(landing)
        for _ in range(2):  # the second call finds nothing new
            ingest.ingest(spark, landing, frame.schema, root, "k", ["v"], "d", "seq", files_per_batch=1)
        if part == 1:
            ingest.compact(spark, root, "k", ["v"])
    assert sorted(map(str, ingest.current(spark, root, "k", ["v"]).collect())) == want
    # a retried batch replaces its own delta
    epochs = spark.read.parquet(f"{root}/delta").select("epoch").distinct().count()
    assert epochs >= 3


def test_opening_value(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 5), ("c", 0), ("d", 5), ("e", None)], "k string, v int")
    log = spark.createDataFrame([("a", days(0), 7), ("a", days(1), 5), ("b", days(0), 5), ("c", days(0), 9),
                                 ("d", days(0), None), ("d", days(1), 8), ("e", days(0), 4)], "k string, day date, v int")
    got = {r.k: r.o for r in history.attach_opening(rows, log, "k", "day", "v", "o").collect()}
    assert got == {"a": 7, "b": None, "c": None, "d": None, "e": None}


def test_bucketed_base_is_not_shuffled_by_an_upsert(spark):
    base = spark.range(2000).select(
        F.col("id").cast("string").alias("k"), F.lit(1).alias("v"),
        F.lit(START).alias("first_seen_date"), F.lit(START).alias("last_seen_date"))
    tables.write_bucketed(base, "bucketed_base", "k", 2)
    batch = spark.range(1500, 2500).select(F.col("id").cast("string").alias("k"), F.lit(2).alias("v"), F.col("id").alias("seq"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = history.upsert_keyed(spark.table("bucketed_base"), batch, "k", ["v"], "2024-02-01", "seq")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 2500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 1  # the batch's own aggregate
    spark.sql("DROP TABLE bucketed_base")


# -- listings and geo ------------------------------------------------------------------------

def _merged(rows):
    """Of each id the row with most photos, the earliest of them, and all portals that any row names."""
    out = {}
    for key in {r["id"] for r in rows}:
        group = sorted((r for r in rows if r["id"] == key), key=lambda r: (-len(r["photos"]), r["ord"]))
        portals = group[0]["portals"] if len(group) == 1 else sorted({p for r in group for p in r["portals"]})
        out[key] = {**group[0], "portals": portals}
    return out


def test_merge_duplicates_equals_sorted_groups(spark):
    rng = random.Random(7)
    rows = [{"id": 0 if rng.random() < 0.4 else rng.randrange(40), "portals": rng.choice([["Z", "V"], ["V"], [], ["Z", "Z", "O"]]),
             "photos": ["p"] * rng.randrange(4), "ord": i} for i in range(150)]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], "id int, portals array<string>, photos array<string>, ord int")
    got = listings.merge_duplicates(frame, ["id"], "portals", F.size("photos"), "ord")
    assert {r.id: (r.portals, r.photos, r.ord) for r in got.collect()} == {
        k: (w["portals"], w["photos"], w["ord"]) for k, w in _merged(rows).items()}


def test_resolve_fills_from_run_then_store_and_cuts_before_rounding(spark):
    rows = [("a", "Itu ", "sp", -23.0, -47.0), ("b", "itu", "SP", None, None), ("c", "Far", "SP", -10.0, -47.0),
            ("d", "Old", "SP", 0.0, 0.0), ("e", "New", "SP", 95.0, 1.0), ("f", "", "SP", None, None)]
    frame = spark.createDataFrame(rows, "uid string, city string, state string, lat double, lon double")
    stored = spark.createDataFrame([("old", "sp", -22.9, -47.06), ("itu", "sp", 1.0, 1.0)], "city_key string, state_key string, lat double, lon double")
    centroids = geo.upsert_centroids(stored, geo.city_centroids(frame))
    located = geo.locate(frame, centroids)
    assert geo.geo_stats(located).first().asDict() == {"no_geo_resolved": 2, "dropped_no_geo": 2, "dropped_far": 1}
    kept = {r.uid: r for r in geo.within_radius(located).collect()}
    assert set(kept) == {"a", "b", "d"} and kept["b"].distance_km == kept["a"].distance_km
    assert (kept["a"].geo_approx, kept["b"].geo_approx, kept["d"].geo_approx) == (0, 1, 1)
    edge = spark.createDataFrame([("x", 200.04), ("y", 200.0)], "uid string, km double")
    assert [r.uid for r in geo.within_radius(edge).collect()] == ["y"]


def test_cluster_count_ignores_the_empty_key(spark):
    rows = spark.createDataFrame([("a", "k"), ("b", "k"), ("c", ""), ("d", ""), ("e", None)], "uid string, dedupe_key string")
    got = {r.uid: r.n_ads for r in listings.attach_cluster_count(rows).collect()}
    assert got == {"a": 2, "b": 2, "c": 1, "d": 1, "e": 1}


def test_versions_keep_frozen_columns_and_drop_what_is_superseded(spark):
    rng = random.Random(12)
    folder = scratch_path(spark, "versions")
    landing, root = f"{folder}/landing", f"{folder}/state"
    fields, rows, names = "k string, d date, seq int, v int, f int", [], lambda path: sorted(p.name for p in Path(path.removeprefix("file:")).iterdir())
    assert ingest.current_version(spark, root) == ingest.Version()
    for run in range(4):
        batch = [(rng.choice("abcde"), days(rng.randint(0, 20)), run * 100 + i, rng.randint(0, 9), rng.randint(0, 9)) for i in range(25)]
        rows += batch
        frame = spark.createDataFrame(batch, fields)
        frame.write.mode("append").parquet(landing)
        ingest.ingest(spark, landing, frame.schema, root, "k", ["v"], "d", "seq", frozen=("f",))
        if run != 2:
            version = ingest.compact(spark, root, "k", ["v"], ("f",))
            assert version == ingest.current_version(spark, root) == ingest.compact(spark, root, "k", ["v"], ("f",))
        at = lambda r: (r[1], r[2])
        want = set()
        for k in {r[0] for r in rows}:
            mine = [r for r in rows if r[0] == k]
            want.add((k, min(r[1] for r in mine), max(r[1] for r in mine), max(mine, key=at)[3], min(mine, key=at)[4]))
        got = ingest.current(spark, root, "k", ["v"], ("f",)).drop("_order", "_opened")
        assert set(map(tuple, got.collect())) == want
    assert version == ingest.Version(3, 3, 1)
    assert names(f"{root}/base") == ["version=2", "version=3"]
    assert names(f"{root}/delta") == ["epoch=2", "epoch=3"]
    assert not [n for n in names(root) if n.startswith("current-")]
    # a micro-batch that is run again after it was folded in changes nothing
    before = ingest.current(spark, root, "k", ["v"], ("f",)).collect()
    spark.read.parquet(f"{root}/delta/epoch=3").write.mode("overwrite").parquet(f"{root}/delta/epoch=1")
    assert sorted(ingest.current(spark, root, "k", ["v"], ("f",)).collect()) == sorted(before)


# -- snapshots -------------------------------------------------------------------------------

def test_encoding_decodes_back_and_numbers_by_first_appearance(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["x", "x", "x", "y", None, "", f"c{i % 50}"]), rng.choice("pqr")) for i in range(500)]
    frame = spark.createDataFrame(rows, "position int, a string, b string").repartition(5)
    shot = snapshot.dictionary_encode(frame, "position", {"a": "ca", "b": "cb"})
    names = defaultdict(dict)
    for r in shot.dictionary.collect():
        names[r.column][r.code] = r.value
    got = sorted(shot.rows.collect(), key=lambda r: r.position)
    assert [(names["a"][r.ca], names["b"][r.cb]) for r in got] == [(a or "", b) for _, a, b in rows]
    assert list(dict.fromkeys(r.ca for r in got)) == list(range(len(names["a"])))


def test_array_encoding(spark):
    frame = spark.createDataFrame([(0, ["b", "a"]), (1, []), (2, ["a", "c", "b"]), (3, None)], "position int, f array<string>")
    shot = snapshot.dictionary_encode_array(frame, "position", "f", "codes", "feature")
    assert {r.position: r.codes for r in shot.rows.collect()} == {0: [0, 1], 1: [], 2: [1, 2, 0], 3: []}


def test_payload_bytes_are_those_of_the_document(spark):
    rows = [(2, "é\"x", None, 1.5, [1, 2]), (0, "b", 3, None, []), (1, "", 4, 2.0, None)]
    frame = spark.createDataFrame(rows, "position int, t string, n int, x double, codes array<int>")
    document = snapshot.columnar_document(frame, 1).first().document
    assert json.loads(document) == {"t": ["b", "", "é\"x"], "n": [3, 4, None], "x": [None, 2.0, 1.5], "codes": [[], None, [1, 2]]}
    assert snapshot.payload_bytes(frame).first().payload_bytes == len(document.encode())
    with pytest.raises(ValueError, match="exceeds"):
        snapshot.size_guard(frame, 1e-6)


# -- explorer, catalogue, checks -------------------------------------------------------------

def test_empty_labels_still_count(spark):
    frame = spark.createDataFrame([("a", ""), ("a", None), ("b", "x"), (None, "?")], "source string, company string")
    assert {(r.label, r.n_rows) for r in explore.tally_top_n(frame, "company", 9).collect()} == {("n/a", 2), ("x", 1), ("?", 1)}
    assert [r.label for r in explore.top_companies(frame).collect()] == ["x"]
    report = {(r.report, r.value): r.n_rows for r in postings.run_report(frame, ["source"]).collect()}
    assert report == {("source", "a"): 2, ("source", "b"): 1, ("source", "?"): 1}


def test_crosstab_shares_sum_to_one(spark):
    frame = spark.range(500).select((F.col("id") % 7).cast("string").alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    shares = explore.crosstab_share(frame, "a", "b").groupBy("a").agg(F.sum("row_share").alias("s")).collect()
    assert [r.s for r in shares] == pytest.approx([1.0] * 7)


def test_basket_labels(spark):
    products = spark.createDataFrame([(1, 10.0), (2, None)], "product_id int, price double")
    variants = spark.createDataFrame([(1, 1, 12.0), (2, 1, None), (2, 2, 5.0)], "product_id int, variant int, variant_price double")
    cart = spark.createDataFrame([("x", 1, 1, 2.0), ("x", 1, 1, 1.0), ("x", 9, 1, 4.0), ("y", 2, 1, 1.0), ("z", 2, 1, 1.0), ("z", 2, 2, 2.0)],
                                 "basket string, product_id int, variant int, qty double")
    got = {r.basket: (r.total, r.has_open_price, r.label) for r in catalog.basket_totals(cart, products, variants).collect()}
    assert got == {"x": (36.0, False, "R$\u00a036,00"), "y": (0.0, True, "A combinar"), "z": (10.0, True, "R$\u00a010,00 + a combinar")}
    shown = {r.product_id: r.showcase_price for r in catalog.showcase_price(products, variants).collect()}
    assert shown == {1: 12.0, 2: 5.0}


def test_quality_report(spark):
    rows = spark.createDataFrame([("(19) 3232-1010", "https://www.vivareal.com.br/imovel/id-12/", 10.0),
                                  ("Casa 123456789012", "https://x/", None), ("WhatsApp", None, 201.0)], "title string, url string, km double")
    cards = rows.select(F.to_json(F.struct("*")).alias("body"))
    checks = quality.report([quality.dq_pii(rows, ["title"]), quality.dq_url_form(rows), quality.dq_geo(rows),
                             quality.dq_no_description(cards, "body"), quality.dq_columns(cards, "body", ("title", "km"))])
    assert {r.check: r.n_bad for r in checks.collect()} == {"pii": 2, "url_form": 2, "geo": 2, "no_description": 0, "columns": 1}
    with pytest.raises(ValueError, match="pii"):
        quality.require_ok(checks)


def test_empty_run_is_an_error(spark):
    with pytest.raises(ValueError, match="postings"):
        postings.require_rows(spark.range(0), "postings")


def test_lookup_is_broadcast_only_within_its_limit(spark):
    table = spark.range(100).withColumnRenamed("id", "k")
    n_bytes = lookup.byte_size(table)
    small, large = lookup.measured(table, limit=n_bytes), lookup.measured(table, limit=n_bytes - 1)
    hint = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hint(small) and not hint(large)
    rows = spark.range(300).selectExpr("id % 120 AS k")
    assert rows.join(small, "k").count() == rows.join(large, "k").count() == 260


def test_dq_lengths_has_no_cap(spark, monkeypatch):
    from suite import rentals

    monkeypatch.setattr(snapshot, "BYTES_PER_MB", 1)  # any table exceeds the export's cap
    rows = rentals._shot(spark, "/root/testdata/sf0.001").rows.select("position", "uid", "km", "title")
    whole = quality.dq_lengths(snapshot.columnar_parts(rows, 8), "document", ["uid", "km", "title"])
    assert [tuple(r) for r in whole.collect()] == [("lengths", True, 0)]
    rows = spark.range(10).select(F.col("id").alias("position"), F.when(F.col("id") != 4, F.col("id")).alias("a"))
    parts = snapshot.columnar_parts(rows, 4).orderBy("part").collect()
    assert [r.document for r in parts] == ['{"a":[0,1,2,3]}', '{"a":[null,5,6,7]}', '{"a":[8,9]}']


def test_first_rows_are_not_sorted_whole(spark):
    """Keys and orders may repeat or be null; only rows that share a key's first order are sorted."""
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), ("b", 5, "z"), (None, 3, "n"), (None, 4, "m"),
            ("c", None, "lost"), ("d", None, "lost"), ("d", 7, "kept"), ("e", 1, None), ("a", 9, "x")]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    got = ordering.first_per_key(df, ["k"], "o")
    assert got.columns == df.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        ("a", 1, "y"), ("b", 5, "z"), (None, 3, "n"), ("c", None, None), ("d", 7, "kept"), ("e", 1, None)]))
    two = ordering.first_per_key(df, ["v", "k"], "o")
    assert two.columns == df.columns and two.count() == 9
    tied, untied = (ordering.first_per_key(df.where(c), ["k"], "o").collect() for c in ("k = 'b'", "false"))
    assert len(tied) == 1 and untied == []
    # before the join, whole rows meet no sort and no aggregate
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan and plan.count("min_by(struct") == 2
