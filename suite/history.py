"""Keyed history on daily price sightings."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import oracle, query, view
from tidemark.operators import history, listings
from tidemark.session import scratch_path
from tidemark.streaming import ingest

TODAY = "2024-01-30"
KEEP, ACTIVE = 2, 1


def _obs(spark, sf):
    return view(spark, sf, "f4_observations")


def _split(spark, sf):
    """Base as of the day before, and the last day's batch."""
    obs = _obs(spark, sf)
    earlier = obs.where(F.col("run_date") < TODAY)
    state = earlier.groupBy("uid").agg(
        F.max_by("price", F.struct("run_date", "seq")).alias("price"),
        F.min_by("price", F.struct("run_date", "seq")).alias("first_price"),
        F.min("run_date").alias("first_seen_date"), F.max("run_date").alias("last_seen_date"))
    batch = obs.where(F.col("run_date") == TODAY).select(
        "uid", "price", F.col("price").alias("first_price"), "seq")
    return state, batch


_STATE = """SELECT uid, ARG_MAX(price, (run_date, seq)) AS price, ARG_MIN(price, (run_date, seq)) AS first_price,
    MIN(run_date) AS first_seen_date, MAX(run_date) AS last_seen_date FROM f4_observations GROUP BY uid"""
_LOG = """SELECT uid, run_date, price FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY uid, run_date ORDER BY seq DESC) AS rn FROM (
        SELECT *, LAG(price) OVER w AS prev, ROW_NUMBER() OVER w AS nth
        FROM f4_observations WINDOW w AS (PARTITION BY uid ORDER BY run_date, seq))
      WHERE nth = 1 OR price IS DISTINCT FROM prev) WHERE rn = 1"""


@query("upsert_keyed", oracle("f4_observations", sql=_STATE))
def upsert_keyed(spark, sf):
    base, batch = _split(spark, sf)
    return history.upsert_keyed(base, batch, "uid", ["price"], TODAY, "seq")


@query("count_inserts", oracle("f4_observations", sql="""
    SELECT CAST(COUNT(*) AS BIGINT) AS inserted FROM (
      SELECT uid FROM f4_observations GROUP BY uid HAVING MIN(run_date) = DATE '2024-01-30')"""))
def count_inserts(spark, sf):
    base, batch = _split(spark, sf)
    return history.new_keys(base, batch, "uid").agg(F.count("*").alias("inserted"))


@query("first_last_seen", oracle("f4_observations", sql="""
    SELECT uid, MIN(run_date) AS first_seen_date, MAX(run_date) AS last_seen_date
    FROM f4_observations GROUP BY uid"""))
def first_last_seen(spark, sf):
    return history.first_last_seen(_obs(spark, sf), "uid", "run_date")


def _seen(spark, sf):
    return history.first_last_seen(_obs(spark, sf), "uid", "run_date")


@query("active_filter", oracle("f4_observations", sql="""
    SELECT uid FROM f4_observations GROUP BY uid HAVING MAX(run_date) >= DATE '2024-01-29'"""))
def active_filter(spark, sf):
    return history.active(_seen(spark, sf), TODAY, ACTIVE).select("uid")


@query("prune", oracle("f4_observations", sql="""
    SELECT uid, MIN(run_date) AS first_seen_date, MAX(run_date) AS last_seen_date
    FROM f4_observations GROUP BY uid HAVING MAX(run_date) >= DATE '2024-01-28'"""))
def prune(spark, sf):
    return history.prune(_seen(spark, sf), TODAY, KEEP)


@query("pruned_count", oracle("f4_observations", s=_STATE, sql="""
    SELECT CAST(COUNT(*) FILTER (WHERE last_seen_date < DATE '2024-01-28') AS BIGINT) AS pruned,
      CAST(COUNT(*) FILTER (WHERE last_seen_date >= DATE '2024-01-28') AS BIGINT) AS kept FROM s"""))
def pruned_count(spark, sf):
    return history.pruned_count(_seen(spark, sf), TODAY, KEEP)


def _log(spark, sf):
    return history.change_log(_obs(spark, sf), "uid", "run_date", "seq", "price")


@query("rent_change_log", oracle("f4_observations", sql=_LOG))
def rent_change_log(spark, sf):
    return _log(spark, sf)


@query("rent_changes", oracle("f4_observations", sql="""
    SELECT run_date, CAST(COUNT(*) FILTER (WHERE nth = 1) AS BIGINT) AS inserted,
      CAST(COUNT(*) FILTER (WHERE nth > 1 AND price IS DISTINCT FROM prev) AS BIGINT) AS changes
    FROM (SELECT *, LAG(price) OVER w AS prev, ROW_NUMBER() OVER w AS nth
          FROM f4_observations WINDOW w AS (PARTITION BY uid ORDER BY run_date, seq)) GROUP BY run_date"""))
def rent_changes(spark, sf):
    return history.change_counts(_obs(spark, sf), "uid", "run_date", "seq", "price", chunk=1000)


@query("prune_orphans", oracle("f4_observations", l=_LOG, s=_STATE, sql="""
    SELECT * FROM l WHERE uid IN (SELECT uid FROM s WHERE last_seen_date >= DATE '2024-01-28')"""))
def prune_orphans(spark, sf):
    kept = history.prune(_seen(spark, sf), TODAY, KEEP)
    return history.prune_orphans(_log(spark, sf), kept, "uid")


@query("tuple_in_min", oracle("f4_observations", l=_LOG, sql="""
    SELECT uid, run_date, price FROM l WHERE (uid, run_date) IN (SELECT (uid, MIN(run_date)) FROM l GROUP BY uid)"""))
def tuple_in_min(spark, sf):
    return history.at_first_date(_log(spark, sf), "uid", "run_date").select("uid", "run_date", "price")


_OPEN = """SELECT s.uid, s.price, CASE WHEN f.price <> 0 AND s.price <> 0 AND f.price <> s.price THEN f.price END AS opening
    FROM s JOIN (SELECT uid, ARG_MIN(price, run_date) AS price FROM l GROUP BY uid) f ON f.uid = s.uid"""


def _opening(spark, sf):
    now = _obs(spark, sf).groupBy("uid").agg(F.max_by("price", F.struct("run_date", "seq")).alias("price"))
    return history.attach_opening(now, _log(spark, sf), "uid", "run_date", "price", "opening")


@query("attach_opening_rent", oracle("f4_observations", l=_LOG, s=_STATE, sql=_OPEN))
def attach_opening_rent(spark, sf):
    return _opening(spark, sf)


@query("price_drop_count", oracle("f4_observations", l=_LOG, s=_STATE, o=_OPEN, sql="""
    SELECT CAST(COUNT(*) FILTER (WHERE opening > price) AS BIGINT) AS price_drops FROM o"""))
def price_drop_count(spark, sf):
    return listings.price_drop_count(_opening(spark, sf), "opening", "price")


@query("ingest_incremental", oracle("f4_observations", sql="""
    SELECT uid, MIN(run_date) AS first_seen_date, MAX(run_date) AS last_seen_date,
      ARG_MAX(price, (run_date, seq)) AS price FROM f4_observations GROUP BY uid"""))
def ingest_incremental(spark, sf):
    obs = _obs(spark, sf)
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "sightings")
    for low, high in (("2024-01-01", "2024-01-15"), ("2024-01-15", "9999-12-31")):
        part = obs.where((F.col("run_date") >= low) & (F.col("run_date") < high))
        part.write.mode("append").parquet(landing)
        ingest.ingest(spark, landing, obs.schema, root, "uid", ["price"], "run_date", "seq")
    return ingest.current(spark, root, "uid", ["price"]).drop("_order")


@query("ingest_versions", oracle("f4_observations", sql="""
    SELECT uid, MIN(run_date) AS first_seen_date, MAX(run_date) AS last_seen_date, ARG_MAX(price, (run_date, seq)) AS price,
      ARG_MIN(price, (run_date, seq)) AS opening FROM f4_observations GROUP BY uid"""))
def ingest_versions(spark, sf):
    """Three runs, the first ones compacted: the opening price stays, the price moves on."""
    obs = view(spark, sf, "f4_observations").withColumn("opening", F.col("price"))
    folder = scratch_path(spark, "versions")
    landing, root = f"{folder}/landing", f"{folder}/state"
    for run in (2, 0, 1):  # the oldest sightings do not come first
        obs.where(F.col("seq") % 3 == run).write.mode("append").parquet(landing)
        ingest.ingest(spark, landing, obs.schema, root, "uid", ["price"], "run_date", "seq", frozen=("opening",))
        if run != 1:
            ingest.compact(spark, root, "uid", ["price"], ("opening",))
    return ingest.current(spark, root, "uid", ["price"], ("opening",)).drop("_order", "_opened")
