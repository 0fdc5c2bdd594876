"""Great-circle distance, coordinate checks and distance bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius, search origin, radius and band labels.
EARTH_RADIUS_KM = 6371.0
ORIGIN = (-22.9099, -47.0626)
RADIUS_KM = 200
BANDS = ((25, "até 25 km"), (50, "25–50 km"), (100, "50–100 km"),
         (150, "100–150 km"), (200, "150–200 km"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    )
    # rounding may push the chord past 1; `least` would turn a NULL into 1
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord)))


def usable_point(lat: Column, lon: Column) -> Column:
    """True for a coordinate pair in range that is not the (0, 0) placeholder."""
    return F.coalesce(
        ~((lat == 0) & (lon == 0)) & lat.between(-90, 90) & lon.between(-180, 180), F.lit(False)
    )


def distance_km(lat: Column, lon: Column, origin: tuple[float, float] = ORIGIN) -> Column:
    """Kilometres from the origin, NULL where the point is unusable."""
    return F.when(
        usable_point(lat, lon), haversine_km(F.lit(origin[0]), F.lit(origin[1]), lat, lon)
    )


def distance_band(km: Column, bands=BANDS) -> Column:
    """Label of the first band whose upper bound (inclusive) holds the distance, else ''."""
    label = F.when(km.isNull(), "")
    for upper, name in bands:
        label = label.when(km <= upper, name)
    return label.otherwise("")
