"""Labels read off short texts: work model, market, company and title parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import title_case

# Keywords per label.
REMOTE_WORDS = ("remote", "remoto", "anywhere", "home office", "home-office")
HYBRID_WORDS = ("hybrid", "híbrido", "hibrido")
ON_SITE_WORDS = ("on-site", "onsite", "presencial", "in office", "in-office")
BRAZIL_WORDS = ("bras", "brazil", "são paulo", "sao paulo", "rio de janeiro",
                "belo horizonte", "curitiba", "porto alegre")
REMOTE_MARKET_WORDS = ("remote", "anywhere", "distributed")
ANYWHERE_WORDS = ("remote", "flexible")
SLUG_NAMES = {"wildlifestudios": "Wildlife Studios"}


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def work_model_label(text: Column, remote_flag: Column | None = None) -> Column:
    """remote, hybrid, on-site or '' — a true flag wins, then keywords in that order."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    flag = F.lit(False) if remote_flag is None else F.coalesce(remote_flag, F.lit(False))
    return (
        F.when(flag | contains_any(lowered, REMOTE_WORDS), "remote")
        .when(contains_any(lowered, HYBRID_WORDS), "hybrid")
        .when(contains_any(lowered, ON_SITE_WORDS), "on-site")
        .otherwise("")
    )


def country_from_location(location: Column) -> Column:
    lowered = F.lower(F.coalesce(location, F.lit("")))
    return F.when(contains_any(lowered, BRAZIL_WORDS), "BR").otherwise(location)


def market_from_location(location: Column) -> Column:
    lowered = F.lower(F.coalesce(location, F.lit("")))
    return (
        F.when(contains_any(lowered, BRAZIL_WORDS), "BR")
        .when(contains_any(lowered, REMOTE_MARKET_WORDS), "Global remote")
        .otherwise("Global")
    )


def company_from_slug(slug: Column) -> Column:
    for raw, name in SLUG_NAMES.items():
        slug = F.replace(slug, F.lit(raw), F.lit(name))
    return title_case(slug)


def company_of(text: Column) -> Column:
    """The part before the first `": "` of "Company: Title"; '' without a title after it."""
    at = F.locate(": ", text)
    return F.when((at > 0) & (F.length(text) > at + 1), F.substr(text, F.lit(1), at - 1)).otherwise("")


def title_of(text: Column) -> Column:
    """The part after the first `": "`, or the whole text without one."""
    at = F.locate(": ", text)
    return F.when((at > 0) & (F.length(text) > at + 1), F.substr(text, at + 2)).otherwise(text)
