"""Rentals run: landed feed to updated base, rent history, centroids and snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import snippet
from tidemark.operators import document, geo, history, listings, snapshot
from tidemark.session import settle
from tidemark.sources import rentals

BASE_COLUMNS = (
    "listing_uid", "source", "portals", "title", "url", "property_type", "city", "state", "lat",
    "lon", "distance_km", "distance_band", "geo_approx", "rent", "condo_fee", "iptu",
    "total_area", "usable_area", "price_per_m2", "bedrooms", "suites", "bathrooms", "parking",
    "features", "photos", "advertiser", "is_match", "published_date", "description", "dedupe_key",
)


# What a daily run keeps of a listing.
MAX_PHOTOS, FEATURE_TEXT_LENGTH = 8, 2500


@dataclass(frozen=True)
class RentalsRun:
    batch: DataFrame
    located: DataFrame
    centroids: DataFrame


def collect(landing: DataFrame, stored: DataFrame | None = None, endpoint: str = "vivareal") -> RentalsRun:
    """The run's listings inside the radius, classified and keyed.

    Normalised rows are settled once: the centroids and the rows both read them.
    Saved centroids come from the kept rows, filled ones included.
    """
    rows = rentals.normalise(landing, endpoint, MAX_PHOTOS)
    merged = settle(listings.merge_duplicates(
        rows, ["source", "native_id"], "portals", F.size("photos"), "ord"
    ))
    current = geo.city_centroids(merged)
    known = current if stored is None else geo.upsert_centroids(stored, current)
    located = geo.locate(merged, known)
    kept = listings.with_identity(listings.classify_listing(geo.within_radius(located), FEATURE_TEXT_LENGTH))
    batch = kept.withColumn("description", snippet(F.col("description")))
    kept_centroids = geo.city_centroids(batch)
    saved = kept_centroids if stored is None else geo.upsert_centroids(stored, kept_centroids)
    return RentalsRun(batch.select(*BASE_COLUMNS, "ord"), located, saved)


def update_base(base: DataFrame, batch: DataFrame, today: str) -> DataFrame:
    """The base after the run: everything but source and first sighting refreshed, then pruned."""
    mutable = [c for c in BASE_COLUMNS if c not in ("listing_uid", *history.LISTING_FROZEN)]
    merged = history.upsert_keyed(base, batch, "listing_uid", mutable, today, "ord")
    return history.prune(merged, today, history.KEEP_LISTING_DAYS)


def update_rents(
    rents: DataFrame, base_before: DataFrame, base_after: DataFrame, batch: DataFrame, today: str
) -> DataFrame:
    """Rent history after the run: a row per new listing or moved rent, orphans dropped."""
    day = F.lit(today).cast("date")
    before = base_before.select("listing_uid", F.struct("rent").alias("_old"))
    moved = batch.select("listing_uid", "rent").join(before, "listing_uid", "left").where(
        F.col("_old").isNull() | ~F.col("_old.rent").eqNullSafe(F.col("rent"))
    ).select("listing_uid", day.alias("date"), "rent")
    # a second run on the same day replaces that day's row
    kept = rents.join(moved.select("listing_uid", "date"), ["listing_uid", "date"], "left_anti")
    return history.prune_orphans(kept.unionByName(moved), base_after, "listing_uid")


def serve(base: DataFrame, rents: DataFrame, today: str) -> snapshot.Snapshot:
    shot = snapshot.snapshot_listings(base, rents, today)
    snapshot.size_guard(shot.rows, snapshot.MAX_LISTINGS_MB)
    return shot


def publish(
    base: DataFrame, rents: DataFrame, today: str, path: str, max_mb: float | None = snapshot.MAX_LISTINGS_MB
) -> DataFrame:
    """Writes the served document under `path`, header and dictionaries included, and returns its manifest."""
    return document.write_document(document.listing_document(base, rents, today), path, max_mb)
