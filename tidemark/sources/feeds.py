"""Landed feed payloads: their fields, and unpacking pages to one row per record.

A landing table holds one response per row: feed, company_slug, page, body.
Record fields are declared, never inferred; text is used wherever a feed is known
to mix types, because the reader turns any JSON value into its text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import let

LANDING_SCHEMA = "feed string, company_slug string, page bigint, body string"
RECORDS_PER_PAGE = 1 << 20  # `ord` is page * this + place in the page


@dataclass(frozen=True)
class Feed:
    """Record fields (DDL), and the envelope field holding the records, if any."""

    fields: str
    envelope: str | None = None
    xml: bool = False


# The fields each feed delivers.
FEEDS = {
    "gupy": Feed(
        "id string, name string, careerPageName string, jobUrl string, isRemoteWork boolean, "
        "workplaceType string, city string, state string, publishedDate string, "
        "skills array<string>, description string", "data"),
    "themuse": Feed(
        "id string, name string, company struct<name string>, locations array<struct<name string>>, "
        "levels array<struct<name string>>, categories array<struct<name string>>, "
        "refs struct<landing_page string>, publication_date string, contents string", "results"),
    "remotive": Feed(
        "id string, url string, title string, company_name string, "
        "candidate_required_location string, publication_date string, tags array<string>, "
        "description string, category string", "jobs"),
    "jobicy": Feed(
        "id string, url string, jobTitle string, companyName string, jobGeo string, "
        "pubDate string, jobExcerpt string, jobIndustry string", "jobs"),
    "remoteok": Feed(
        "id string, position string, company string, url string, salary_min double, "
        "salary_max double, date string, tags array<string>, description string"),
    "himalayas": Feed(
        "guid string, title string, companyName string, applicationLink string, "
        "locationRestrictions string, pubDate string, categories array<string>, excerpt string",
        "jobs"),
    "workingnomads": Feed(
        "url string, title string, company_name string, location string, pub_date string, "
        "description string, category_name string"),
    "arbeitnow": Feed(
        "slug string, url string, title string, company_name string, remote boolean, "
        "location string, created_at string, tags array<string>, description string", "data"),
    "weworkremotely": Feed(
        "link string, title string, region string, country string, category string, "
        "pubDate string, description string", "channel", xml=True),
    "greenhouse": Feed(
        "id string, title string, absolute_url string, location struct<name string>, "
        "departments array<struct<name string>>, updated_at string, first_published string",
        "jobs"),
    "lever": Feed(
        "id string, text string, hostedUrl string, createdAt string, "
        "categories struct<location string, commitment string, department string, team string>"),
    "ashby": Feed(
        "id string, jobId string, title string, jobUrl string, applyUrl string, location string, "
        "locationName string, isRemote boolean, publishedAt string, department string, "
        "teamName string", "jobs"),
    "rentals": Feed(
        "listing struct<id string, status string, usageTypes array<string>, "
        "unitTypes array<string>, title string, description string, "
        "pricingInfos array<struct<businessType string, price string, monthlyCondoFee string, "
        "iptu string, yearlyIptu string, rentalInfo struct<period string>>>, "
        "address struct<city string, state string>, "
        "displayAddressGeolocation struct<lat string, lon string>, totalAreas array<string>, "
        "usableAreas array<string>, bedrooms array<string>, suites array<string>, "
        "bathrooms array<string>, parkingSpaces array<string>, mergedAmenities array<string>, "
        "amenities array<string>, portals array<string>, createdAt string>, "
        "account struct<name string>, medias array<struct<id string, type string>>", "listings"),
}


def write_landing(pages: DataFrame, path: str) -> None:
    """Adds pages to a landing folder, one subfolder per feed, so an adapter reads only its own."""
    pages.write.mode("append").partitionBy("feed").json(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING_SCHEMA).json(path)


def _record_texts(feed: str) -> Column:
    """The page's records as JSON texts, whatever they are; NULL where the list itself cannot be read."""
    spec = FEEDS[feed]
    if spec.envelope:
        return F.from_json("body", f"{spec.envelope} array<string>")[spec.envelope]
    return F.from_json("body", "array<string>")


def _record(feed: str, raw: Column) -> Column:
    """One record; NULL if it is no object. A field that cannot be read is NULL and leaves the others be."""
    return F.when(F.get_json_object(raw, "$").startswith("{"), F.from_json(raw, f"struct<{FEEDS[feed].fields}>"))


def _records(feed: str) -> Column:
    """The page's records; NULL where it does not parse or lacks the feed's envelope.

    A page is read whole; only where that fails, or a record in it does, each record is read on its own.
    """
    spec = FEEDS[feed]
    listed = f"array<struct<{spec.fields}>>"
    if spec.xml:
        return F.from_xml("body", f"{spec.envelope} struct<item {listed}>")[spec.envelope]["item"]
    whole = F.from_json("body", f"{spec.envelope} {listed}")[spec.envelope] if spec.envelope else F.from_json("body", listed)
    return let(whole, lambda w: F.when(w.isNotNull() & ~F.exists(w, lambda r: r.isNull()), w).otherwise(
        F.transform(_record_texts(feed), lambda raw: _record(feed, raw))))


def _judged(landing: DataFrame, feed: str) -> DataFrame:
    """Every page of a feed with its number of records, and why it has none to read."""
    blank = F.trim(F.coalesce("body", F.lit(""))) == ""
    # only a whole JSON value can be copied; XML is judged by its records
    readable = F.lit(True) if FEEDS[feed].xml else F.get_json_object("body", "$").isNotNull()
    records = _records(feed)
    reason = (
        F.when(blank, "empty").when(~readable, "unreadable").when(records.isNull(), "no records field")
    )
    pages = landing.where(F.col("feed") == feed)
    return pages.select(
        "feed", "company_slug", "page", F.coalesce(F.size(records), F.lit(0)).alias("n_records"), reason.alias("reason"))


def lost_pages(landing: DataFrame, feed: str) -> DataFrame:
    """feed, company_slug, page and reason of the pages that `unpack` reads nothing from by fault.

    A page whose list of records is there but empty is not lost.
    """
    return _judged(landing, feed).where(F.col("reason").isNotNull()).drop("n_records")


def feed_report(landing: DataFrame, feeds: list[str]) -> DataFrame:
    """One row per feed: its pages, lost pages and records, and whether it failed.

    A feed has failed when no page of it could be read, or none was landed.
    """
    counts = [
        _judged(landing, feed).agg(
            F.lit(feed).alias("feed"), F.count(F.lit(1)).alias("n_pages"), F.count("reason").alias("n_lost"),
            F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("n_records"))
        for feed in feeds
    ]
    every = reduce(DataFrame.unionByName, counts)
    return every.withColumn("failed", F.col("n_lost") == F.col("n_pages"))


def unpack(landing: DataFrame, feed: str) -> DataFrame:
    """Records of one feed as company_slug, ord (arrival order) and the fields under `r`.

    A page that does not parse yields no records, so a broken one never stops a run; `lost_pages`
    lists it. A record that is no object is left out and the others of its page are kept;
    `quarantine` lists it.
    """
    pages = landing.where(F.col("feed") == feed)
    rows = pages.select("company_slug", "page", F.posexplode(_records(feed)).alias("_i", "r"))
    return rows.where(F.col("r").isNotNull()).select(
        "company_slug", (F.col("page") * RECORDS_PER_PAGE + F.col("_i")).alias("ord"), "r"
    )


def quarantine(landing: DataFrame, feed: str) -> DataFrame:
    """company_slug, page, place, reason, fields and raw text of the records that are not read in full.

    `not a record`: no JSON object, so left out by `unpack`. `unreadable fields`: kept, with NULL for
    each field of `fields`, whose value is there but not of the declared type. Records of an XML feed
    have text fields only and are not judged.
    """
    declared = [f.name for f in T.StructType.fromDDL(FEEDS[feed].fields).fields]
    pages = landing.where((F.col("feed") == feed) & F.lit(not FEEDS[feed].xml))
    texts = F.lit(None).cast("array<string>") if FEEDS[feed].xml else _record_texts(feed)
    rows = pages.select("company_slug", "page", F.posexplode(texts).alias("place", "raw"))
    rows = rows.withColumn("r", F.from_json("raw", f"struct<{FEEDS[feed].fields}>"))
    lost = F.array_compact(F.array(*[
        F.when(F.get_json_object("raw", f"$.{name}").isNotNull() & F.col("r")[name].isNull(), name) for name in declared]))
    whole = F.coalesce(F.get_json_object("raw", "$").startswith("{"), F.lit(False))
    judged = rows.select(
        "company_slug", "page", "place", F.when(whole, lost).otherwise(F.array().cast("array<string>")).alias("fields"),
        F.when(~whole, "not a record").alias("reason"), "raw")
    reason = F.coalesce("reason", F.when(F.size("fields") > 0, "unreadable fields"))
    return judged.withColumn("reason", reason).where(F.col("reason").isNotNull())
