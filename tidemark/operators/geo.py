"""Placing listings: city centroids, filling missing points, the radius cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import ORIGIN, RADIUS_KM, distance_band, distance_km, usable_point
from tidemark.operators.lookup import measured
from tidemark.operators.quantiles import exact_median

# Cell widths in degrees the exact median narrows through: at most 360 cells, then 10 000 of
# about 11 m, then the distinct positions inside one of those.
DEGREE_CELLS = (1.0, 1e-4)
PLACE = ["city_key", "state_key"]


def _place_key(column: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(column), F.lit(""))))


def with_place(listings: DataFrame) -> DataFrame:
    return listings.withColumns({"city_key": _place_key("city"), "state_key": _place_key("state")})


def city_centroids(listings: DataFrame, approx: bool = False) -> DataFrame:
    """Median latitude and longitude per city, over usable points."""
    points = with_place(listings).where(
        usable_point(F.col("lat"), F.col("lon")) & (F.col("city_key") != "")
    ).select(*PLACE, "lat", "lon")
    if approx:
        return points.groupBy(*PLACE).agg(
            F.percentile_approx("lat", 0.5).alias("lat"), F.percentile_approx("lon", 0.5).alias("lon")
        )
    axes = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("at")) for a in ("lat", "lon")])
    middle = exact_median(
        points.select(*PLACE, F.inline(axes)), [*PLACE, "axis"], "at", DEGREE_CELLS, "middle"
    )
    return middle.groupBy(*PLACE).agg(*[
        F.max(F.when(F.col("axis") == a, F.col("middle"))).alias(a) for a in ("lat", "lon")
    ])


def upsert_centroids(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Stored centroids, replaced where this run has its own."""
    both = stored.alias("s").join(current.alias("c"), PLACE, "full_outer")
    return both.select(
        *PLACE, F.coalesce("c.lat", "s.lat").alias("lat"), F.coalesce("c.lon", "s.lon").alias("lon")
    )


def locate(
    listings: DataFrame, centroids: DataFrame, origin: tuple[float, float] = ORIGIN
) -> DataFrame:
    """Adds `km` (unrounded) and `geo_approx`; rows without a usable point take their city's centroid.

    The centroids, one row per city, are settled and counted before the join.
    """
    places = centroids.select(*PLACE, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    joined = with_place(listings).join(measured(places), PLACE, "left")
    usable = usable_point(F.col("lat"), F.col("lon"))
    filled = ~usable & F.col("_lat").isNotNull()
    placed = joined.withColumn("geo_approx", filled.cast("int")).withColumns({
        "lat": F.when(filled, F.col("_lat")).otherwise(F.col("lat")),
        "lon": F.when(filled, F.col("_lon")).otherwise(F.col("lon")),
    })
    return placed.withColumn("km", distance_km(F.col("lat"), F.col("lon"), origin)).drop(
        "_lat", "_lon", *PLACE
    )


def within_radius(located: DataFrame, radius_km: float = RADIUS_KM) -> DataFrame:
    """Rows inside the radius with rounded distance and band; cut and band use the unrounded one."""
    return located.where(F.col("km") <= radius_km).withColumns({
        "distance_km": F.round("km", 1), "distance_band": distance_band(F.col("km")),
    }).drop("km")


def geo_stats(located: DataFrame, radius_km: float = RADIUS_KM) -> DataFrame:
    """How many rows were placed by centroid, have no point, or lie too far."""
    return located.agg(
        F.count_if(F.col("geo_approx") == 1).alias("no_geo_resolved"),
        F.count_if(F.col("km").isNull()).alias("dropped_no_geo"),
        F.count_if(F.col("km") > radius_km).alias("dropped_far"),
    )


def resolve(
    listings: DataFrame,
    stored: DataFrame | None = None,
    origin: tuple[float, float] = ORIGIN,
    radius_km: float = RADIUS_KM,
) -> DataFrame:
    """Listings inside the radius, missing points filled from this run's or stored centroids.

    The listings are read twice, so hand in a stored or settled table, not a long lineage.
    """
    centroids = city_centroids(listings)
    if stored is not None:
        centroids = upsert_centroids(stored, centroids)
    return within_radius(locate(listings, centroids, origin), radius_km)
