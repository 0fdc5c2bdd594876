"""The rental portals' shared feed, projected to the listing schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import feed_date
from tidemark.functions.numbers import as_int, first_int
from tidemark.functions.text import strip_html, trim_space
from tidemark.operators.ordering import first_per_key
from tidemark.sources.feeds import unpack

# Source name, sites per endpoint, photo limits, tags and periods.
SOURCE = "grupozap"
SITES = {"vivareal": "https://www.vivareal.com.br", "zap": "https://www.zapimoveis.com.br"}
MAX_PHOTO_ID = 40
RENTAL, MONTHLY, RESIDENTIAL, ACTIVE, IMAGE = "RENTAL", "MONTHLY", "RESIDENTIAL", "ACTIVE", "IMAGE"
VIVAREAL = "VIVAREAL"


def _blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def rental_price(pricing: Column) -> Column:
    """First monthly rental entry with a positive price, as struct(rent, condo_fee, iptu)."""

    def fits(p: Column) -> Column:
        period = F.upper(F.coalesce(F.nullif(p["rentalInfo"]["period"], F.lit("")), F.lit(MONTHLY)))
        return (p["businessType"] == RENTAL) & (period == MONTHLY) & as_int(p["price"]).isNotNull()

    entry = F.get(F.filter(pricing, fits), F.lit(0))
    return F.struct(
        as_int(entry["price"]).alias("rent"),
        as_int(entry["monthlyCondoFee"]).alias("condo_fee"),
        F.coalesce(as_int(entry["iptu"]), as_int(entry["yearlyIptu"])).alias("iptu"),
    )


def photo_ids(medias: Column, limit: int | None = None) -> Column:
    """Ids of the image media, all or the first few; other media and malformed ids are skipped."""

    def usable(m: Column) -> Column:
        kind_ok = _blank(m["type"]) | (m["type"] == IMAGE)
        return kind_ok & m["id"].rlike(r"\A[\p{L}\p{N}]{1," + str(MAX_PHOTO_ID) + r"}\z")

    images = F.filter(medias, usable)
    ids = F.transform(images if limit is None else F.slice(images, 1, limit), lambda m: m["id"])
    return F.coalesce(ids, F.array().cast("array<string>"))


def usage_allowed(usage_types: Column) -> Column:
    """Untagged, or tagged residential."""
    tags = F.filter(usage_types, lambda u: ~_blank(u))
    return F.coalesce((F.size(tags) == 0) | F.array_contains(tags, RESIDENTIAL), F.lit(True))


def canonical_url(listing_id: Column, portals: Column, endpoint: str) -> Column:
    """Bare listing url on a portal that carries the ad."""
    site = F.when(F.array_contains(portals, VIVAREAL), SITES["vivareal"]).otherwise(SITES[endpoint])
    return F.concat(site, F.lit("/imovel/id-"), listing_id, F.lit("/"))


def normalise(landing: DataFrame, endpoint: str = "vivareal", max_photos: int | None = None) -> DataFrame:
    """Listings of one endpoint: first record per id, active, residential, with a monthly rent."""
    entry = F.col("r.listing")
    records = unpack(landing, "rentals").where(~_blank(entry["id"]))
    unique = first_per_key(records.withColumn("_id", entry["id"]), ["_id"], "ord")
    usable = unique.where(
        (_blank(entry["status"]) | (entry["status"] == ACTIVE)) & usage_allowed(entry["usageTypes"])
    )
    priced = usable.withColumn("_price", rental_price(entry["pricingInfos"])).where(
        F.col("_price.rent").isNotNull()
    )
    portals = F.coalesce(
        F.filter(entry["portals"], lambda p: ~_blank(p)), F.array().cast("array<string>")
    )
    amenities = F.when(F.size(entry["mergedAmenities"]) > 0, entry["mergedAmenities"])

    def text(value: Column) -> Column:
        return trim_space(F.coalesce(value, F.lit("")))

    return priced.select(
        F.lit(SOURCE).alias("source"),
        entry["id"].alias("native_id"),
        text(entry["title"]).alias("title"),
        canonical_url(entry["id"], portals, endpoint).alias("url"),
        strip_html(entry["description"], scrub=True).alias("description"),
        text(entry["address"]["city"]).alias("city"),
        text(entry["address"]["state"]).alias("state"),
        entry["displayAddressGeolocation"]["lat"].try_cast("double").alias("lat"),
        entry["displayAddressGeolocation"]["lon"].try_cast("double").alias("lon"),
        "_price.rent", "_price.condo_fee", "_price.iptu",
        first_int(entry["totalAreas"]).alias("total_area"),
        first_int(entry["usableAreas"]).alias("usable_area"),
        first_int(entry["bedrooms"]).alias("bedrooms"),
        first_int(entry["suites"]).alias("suites"),
        first_int(entry["bathrooms"]).alias("bathrooms"),
        first_int(entry["parkingSpaces"]).alias("parking"),
        F.coalesce(amenities, entry["amenities"], F.array().cast("array<string>")).alias("amenities_raw"),
        photo_ids(F.col("r.medias"), max_photos).alias("photos"),
        text(F.col("r.account.name")).alias("advertiser"),
        feed_date(entry["createdAt"]).alias("published_date"),
        F.coalesce(F.get(entry["unitTypes"], F.lit(0)), F.lit("")).alias("unit_type_raw"),
        portals.alias("portals"),
        "ord",
    )
