"""Property listings: duplicate merge, classification, copies and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scores, taxonomy
from tidemark.functions.keys import listing_dedupe_key, listing_uid
from tidemark.operators.quantiles import upper_middle

# Filter buckets, the rental in hand and the plot's domain.
RENT_BUCKETS = ((0, 4000), (4000, 6000), (6000, 10000), (10000, 14000), (14000, None))
LAND_BUCKETS = ((3000, 5000), (5000, 10000), (10000, 20000), (20000, 100000), (100000, None))
BEDROOM_BUCKETS = ((1, 2), (3, 3), (4, 4), (5, None))
CURRENT_RENT, CURRENT_LAND = 10000, 6000
DOMAIN_LAND_MIN, DOMAIN_LAND_MAX, DOMAIN_RENT_MAX = 3000, 100000, 30000

# Cell widths the exact rent median narrows through.
RENT_CELLS = (1_000_000.0, 1_000.0)


def merge_duplicates(
    rows: DataFrame, keys: list[str], portals: str, n_photos: Column, order: str
) -> DataFrame:
    """One row per listing: the one with most photos, first on ties, with all portals sorted.

    A listing seen once keeps its portal list as it came. Portals are exploded
    before the aggregate, so its buffer holds each portal name once and a hot
    listing leaves every map task as a single row.
    """
    rest = [c for c in rows.columns if c not in keys]
    tagged = rows.withColumn("_best", F.struct(n_photos.alias("n"), (-F.col(order)).alias("o")))
    spread = tagged.withColumn("_portal", F.explode_outer(portals))
    merged = spread.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), "_best").alias("_row"),
        F.array_sort(F.collect_set("_portal")).alias("_all"),
        (F.min(order) < F.max(order)).alias("_several"),
    )
    union = F.when(F.col("_several"), F.col("_all")).otherwise(F.col(portals)).alias(portals)
    return merged.select(*keys, "_row.*", "_all", "_several").select(
        *[union if c == portals else F.col(c) for c in rows.columns]
    )


def classify_listing(rows: DataFrame, text_length: int | None = None) -> DataFrame:
    """Adds property type, features (of the whole text, if not cut), match flag and rent per square metre."""
    rent, land = F.col("rent"), F.col("total_area")
    return rows.withColumns({
        "property_type": taxonomy.property_type(F.col("title"), F.col("unit_type_raw")),
        "features": taxonomy.features(F.col("title"), F.col("description"), F.col("amenities_raw"), text_length),
        "is_match": scores.is_match(rent, land),
        "price_per_m2": scores.price_per_m2(rent, land),
    })


def with_identity(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "listing_uid": listing_uid(F.col("source"), F.col("native_id")),
        "dedupe_key": listing_dedupe_key(
            F.col("lat"), F.col("lon"), F.col("total_area"), F.col("rent"), F.col("geo_approx")
        ),
    })


def cluster_count(rows: DataFrame, key: str = "dedupe_key") -> DataFrame:
    """Ads per fuzzy key; rows without a key belong to no cluster."""
    return rows.where(F.col(key) != "").groupBy(key).agg(F.count("*").alias("n_ads"))


def attach_cluster_count(rows: DataFrame, key: str = "dedupe_key") -> DataFrame:
    """Ads of the same property per row, 1 without a key."""
    # keyless rows join on NULL, so they neither match nor pile up on one key
    counted = cluster_count(rows, key).withColumnRenamed(key, "_key")
    joined = rows.withColumn("_own", F.nullif(F.col(key), F.lit(""))).join(
        counted, F.col("_own") == F.col("_key"), "left"
    )
    return joined.withColumn("n_ads", F.coalesce("n_ads", F.lit(1))).drop("_own", "_key")


def portal_count(rows: DataFrame, key: str = "dedupe_key", source: str = "source") -> DataFrame:
    return rows.groupBy(key).agg(F.count_distinct(source).alias("n_portals"))


def attach_portal_count(rows: DataFrame, key: str = "dedupe_key", source: str = "source") -> DataFrame:
    return rows.join(portal_count(rows, key, source), key, "left")


def rent_stats(rows: DataFrame, rent: str = "rent") -> DataFrame:
    """Upper-middle, lowest and highest of the known rents."""
    known = rows.where(F.col(rent) != 0)
    middle = upper_middle(known, [], rent, RENT_CELLS, "median")
    ends = known.agg(F.min(rent).alias("lowest"), F.max(rent).alias("highest"))
    return ends.select(middle.scalar().alias("median"), "lowest", "highest")


def match_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.sum("is_match").alias("matches"))


def price_drop_count(rows: DataFrame, opening: str, current: str) -> DataFrame:
    drop = (F.col(opening) != 0) & (F.col(current) != 0) & (F.col(opening) > F.col(current))
    return rows.agg(F.count_if(drop).alias("price_drops"))


def numeric_buckets(rows: DataFrame) -> DataFrame:
    """Rows per filter bucket: rent and land half-open, bedrooms closed; all in one aggregate."""

    def inside(column: str, low: int, high: int | None, closed: bool) -> Column:
        value = F.col(column)
        if high is None:
            return value >= low
        return (value >= low) & ((value <= high) if closed else (value < high))

    counted = []
    for filter_name, column, buckets, closed in (
        ("rent", "rent", RENT_BUCKETS, False),
        ("land", "total_area", LAND_BUCKETS, False),
        ("bedrooms", "bedrooms", BEDROOM_BUCKETS, True),
    ):
        for low, high in buckets:
            counted.append(F.struct(
                F.lit(filter_name).alias("filter"), F.lit(low).alias("low"),
                F.count_if(inside(column, low, high, closed)).alias("n_rows"),
            ))
    return rows.agg(F.array(*counted).alias("b")).select(F.inline("b"))


def plotted(rows: DataFrame) -> DataFrame:
    """Rows inside the plot's domain."""
    return rows.where(in_domain())


def in_domain() -> Column:
    rent, land = F.col("rent"), F.col("total_area")
    return (rent != 0) & land.between(DOMAIN_LAND_MIN, DOMAIN_LAND_MAX) & (rent <= DOMAIN_RENT_MAX)


def cheaper_with_more_land(
    rows: DataFrame, rent: int = CURRENT_RENT, land: int = CURRENT_LAND
) -> DataFrame:
    better = (F.col("rent") < rent) & (F.col("total_area") >= land)
    return plotted(rows).agg(F.count_if(better).alias("cheaper"), F.count("*").alias("plotted"))
