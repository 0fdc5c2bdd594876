"""Business leads: digital score, tier and tracking pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scores
from tidemark.functions.taxonomy import PIXEL_SIGNATURES, pixels

# What the site probe reports.
HAS_PIXEL, NO_PIXEL, NO_SITE, PROBE_FAILED = "sim", "não", "sem site", "erro"


def score_leads(leads: DataFrame) -> DataFrame:
    """Adds score and tier from website, phone, rating and review signals."""
    points = scores.digital_score(
        F.col("has_website"), F.col("has_phone"), F.col("rating"), F.col("reviews")
    )
    return leads.withColumn("digital_score", points).withColumn(
        "digital_tier", scores.digital_tier(F.col("digital_score"))
    )


def pixel_detect(
    sites: DataFrame, url: str, page: str, signatures: dict[str, str] = PIXEL_SIGNATURES
) -> DataFrame:
    """Adds the trackers found in a site's page; a site without a page is a failed probe."""
    found = F.array_join(pixels(F.col(page), signatures), ";")
    return sites.withColumn("pixels", F.coalesce(found, F.lit(""))).withColumn(
        "has_pixel",
        F.when(F.coalesce(F.col(url), F.lit("")) == "", NO_SITE)
        .when(F.col(page).isNull(), PROBE_FAILED)
        .when(F.col("pixels") != "", HAS_PIXEL)
        .otherwise(NO_PIXEL),
    )
