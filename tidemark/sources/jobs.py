"""The twelve posting feeds, each projected to one common schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import labels
from tidemark.functions.dates import feed_date, rfc822_date
from tidemark.functions.numbers import none_if_zero
from tidemark.functions.text import strip_html, trim_space
from tidemark.operators.ordering import cap_per_key, first_per_key
from tidemark.operators.postings import union_sources
from tidemark.sources.feeds import unpack

# Fixed value: the market of the remote boards.
REMOTE_MARKET = "Global remote"

TEXT_COLUMNS = ("source", "native_id", "title", "company", "url", "work_model", "city", "state",
                "country", "market", "description")
LIST_COLUMNS = ("skills", "levels", "categories")
COLUMN_TYPES = {
    "source": "string", "native_id": "string", "title": "string", "company": "string",
    "url": "string", "work_model": "string", "city": "string", "state": "string",
    "country": "string", "market": "string", "salary_min": "double", "salary_max": "double",
    "salary_currency": "string", "published_date": "date", "skills": "array<string>",
    "description": "string", "levels": "array<string>", "categories": "array<string>",
}


def job_columns(source: str, **given: Column) -> list[Column]:
    """The common columns in order; unset texts are '', unset lists empty, the rest NULL."""
    given = {"source": F.lit(source), **given}
    out = []
    for name, kind in COLUMN_TYPES.items():
        value = given.get(name, F.lit(None)).cast(kind)
        if name in ("title", "company"):
            value = trim_space(F.coalesce(value, F.lit("")))
        elif name in TEXT_COLUMNS:
            value = F.coalesce(value, F.lit(""))
        elif name in LIST_COLUMNS:
            value = F.coalesce(value, F.array().cast(kind))
        out.append(value.alias(name))
    return [*out, F.col("ord")]


def _filled(texts: Column, limit: int | None = None) -> Column:
    """Non-empty entries, optionally only the first few."""
    kept = F.filter(texts, lambda t: F.coalesce(t, F.lit("")) != "")
    return kept if limit is None else F.slice(kept, 1, limit)


def _names(objects: Column) -> Column:
    return F.transform(objects, lambda o: F.coalesce(o["name"], F.lit("")))


def _either(*values: Column) -> Column:
    """First value that is neither NULL nor ''."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def _one(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) != "", F.array(text))


def _listed(text: Column) -> Column:
    """A field that holds either one text or a JSON list of texts, as an array."""
    return F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(_one(text))


def _first_by(records: DataFrame, key: Column) -> DataFrame:
    """First record per native key, in arrival order."""
    return first_per_key(records.withColumn("_key", key), ["_key"], "ord").drop("_key")


def gupy(records: DataFrame) -> DataFrame:
    r = F.col("r")
    # a skill is either a text or an object with a name
    skills = F.transform(
        r["skills"], lambda s: F.when(s.startswith("{"), F.get_json_object(s, "$.name")).otherwise(s)
    )
    return _first_by(records, r["id"]).select(job_columns(
        "gupy", native_id=r["id"], title=r["name"], company=r["careerPageName"], url=r["jobUrl"],
        work_model=labels.work_model_label(r["workplaceType"], r["isRemoteWork"]),
        city=r["city"], state=r["state"], country=F.lit("BR"), market=F.lit("BR"),
        published_date=feed_date(r["publishedDate"]), skills=_filled(skills),
        description=strip_html(r["description"]),
    ))


def themuse(records: DataFrame) -> DataFrame:
    r = F.col("r")
    places = F.coalesce(_names(r["locations"]), F.array().cast("array<string>"))
    remote = F.exists(places, lambda p: labels.contains_any(F.lower(p), labels.ANYWHERE_WORDS))
    first = F.coalesce(F.get(places, F.lit(0)), F.lit(""))
    return records.select(job_columns(
        "themuse", native_id=r["id"], title=r["name"], company=r["company"]["name"],
        url=r["refs"]["landing_page"],
        work_model=labels.work_model_label(F.array_join(places, ", "), remote),
        city=first, country=F.when(remote, "Remote").otherwise(first),
        market=F.when(remote, REMOTE_MARKET).otherwise("Global"),
        published_date=feed_date(r["publication_date"]), description=strip_html(r["contents"]),
        levels=_filled(_names(r["levels"])), categories=_filled(_names(r["categories"])),
    ))


def remotive(records: DataFrame, max_tags: int | None = None) -> DataFrame:
    r = F.col("r")
    native = _either(r["id"], r["url"])
    return _first_by(records, native).select(job_columns(
        "remotive", native_id=native, title=r["title"], company=r["company_name"], url=r["url"],
        work_model=F.lit("remote"), country=r["candidate_required_location"],
        market=F.lit(REMOTE_MARKET), published_date=feed_date(r["publication_date"]),
        skills=_filled(r["tags"], max_tags), description=strip_html(r["description"]),
        categories=_one(r["category"]),
    ))


def jobicy(records: DataFrame) -> DataFrame:
    r = F.col("r")
    native = _either(r["id"], r["url"])
    return _first_by(records, native).select(job_columns(
        "jobicy", native_id=native, title=r["jobTitle"], company=r["companyName"], url=r["url"],
        work_model=F.lit("remote"), country=r["jobGeo"], market=F.lit(REMOTE_MARKET),
        published_date=feed_date(r["pubDate"]), description=strip_html(r["jobExcerpt"]),
        categories=_filled(_listed(r["jobIndustry"])),
    ))


def remoteok(records: DataFrame, max_tags: int | None = None) -> DataFrame:
    r = F.col("r")
    low, high = none_if_zero(r["salary_min"]), none_if_zero(r["salary_max"])
    own = F.concat(F.lit("https://remoteok.com/remote-jobs/"), r["id"])
    kept = records.where(F.coalesce(r["id"], F.lit("")) != "")
    return kept.select(job_columns(
        "remoteok", native_id=r["id"], title=r["position"], company=r["company"],
        url=_either(r["url"], own), work_model=F.lit("remote"), market=F.lit(REMOTE_MARKET),
        salary_min=low, salary_max=high,
        salary_currency=F.when(low.isNotNull() | high.isNotNull(), "USD"),
        published_date=feed_date(r["date"]), skills=_filled(r["tags"], max_tags),
        description=strip_html(r["description"]),
    ))


def himalayas(records: DataFrame, max_tags: int | None = None) -> DataFrame:
    r = F.col("r")
    limits = r["locationRestrictions"]
    joined = F.when(
        limits.startswith("["), F.array_join(F.from_json(limits, "array<string>"), ", ")
    ).otherwise(limits)
    return records.select(job_columns(
        "himalayas", native_id=_either(r["guid"], r["title"]), title=r["title"],
        company=r["companyName"], url=_either(r["applicationLink"], r["guid"]),
        work_model=F.lit("remote"), country=joined, market=F.lit(REMOTE_MARKET),
        published_date=feed_date(r["pubDate"]), skills=_filled(r["categories"], max_tags),
        description=strip_html(r["excerpt"]),
    ))


def workingnomads(records: DataFrame) -> DataFrame:
    r = F.col("r")
    return records.select(job_columns(
        "workingnomads", native_id=r["url"], title=r["title"], company=r["company_name"],
        url=r["url"], work_model=labels.work_model_label(r["location"]), country=r["location"],
        market=F.lit(REMOTE_MARKET), published_date=feed_date(r["pub_date"]),
        description=strip_html(r["description"]), categories=_one(r["category_name"]),
    ))


def arbeitnow(records: DataFrame, max_tags: int | None = None) -> DataFrame:
    r = F.col("r")
    return records.select(job_columns(
        "arbeitnow", native_id=_either(r["slug"], r["url"]), title=r["title"],
        company=r["company_name"], url=r["url"],
        work_model=labels.work_model_label(r["location"], r["remote"]), country=r["location"],
        market=F.lit(REMOTE_MARKET), published_date=feed_date(r["created_at"]),
        skills=_filled(r["tags"], max_tags), description=strip_html(r["description"]),
    ))


def weworkremotely(records: DataFrame) -> DataFrame:
    r = F.col("r")
    link = trim_space(F.coalesce(r["link"], F.lit("")))
    headline = trim_space(F.coalesce(r["title"], F.lit("")))
    linked = records.where(link != "")
    return _first_by(linked, link).select(job_columns(
        "weworkremotely", native_id=link, title=labels.title_of(headline),
        company=labels.company_of(headline), url=link, work_model=F.lit("remote"),
        country=_either(trim_space(r["region"]), r["country"]), market=F.lit(REMOTE_MARKET),
        published_date=rfc822_date(r["pubDate"]).try_cast("date"),
        description=strip_html(r["description"]),
        categories=_one(trim_space(r["category"])),
    ))


def _capped(records: DataFrame, cap: int | None) -> DataFrame:
    return records if cap is None else cap_per_key(records, ["company_slug"], "ord", cap)


def greenhouse(records: DataFrame, cap: int | None = None) -> DataFrame:
    r = F.col("r")
    place = F.coalesce(r["location"]["name"], F.lit(""))
    return _capped(records, cap).select(job_columns(
        "greenhouse", native_id=r["id"], title=r["title"],
        company=labels.company_from_slug(F.col("company_slug")), url=r["absolute_url"],
        work_model=labels.work_model_label(place), city=place,
        country=labels.country_from_location(place), market=labels.market_from_location(place),
        published_date=feed_date(_either(r["updated_at"], r["first_published"])),
        categories=_filled(_names(r["departments"])),
    ))


def lever(records: DataFrame, cap: int | None = None, epoch_unit: str = "s") -> DataFrame:
    r = F.col("r")
    hints = r["categories"]
    place = F.coalesce(hints["location"], F.lit(""))
    return _capped(records, cap).select(job_columns(
        "lever", native_id=r["id"], title=r["text"],
        company=labels.company_from_slug(F.col("company_slug")), url=r["hostedUrl"],
        work_model=labels.work_model_label(
            F.concat_ws(" ", F.coalesce(hints["commitment"], F.lit("")), place)
        ),
        city=place, country=labels.country_from_location(place),
        market=labels.market_from_location(place),
        published_date=feed_date(r["createdAt"], epoch_unit),
        categories=F.array(F.coalesce(_either(hints["department"], hints["team"]), F.lit(""))),
    ))


def ashby(records: DataFrame, cap: int | None = None) -> DataFrame:
    r = F.col("r")
    place = F.coalesce(_either(r["location"], r["locationName"]), F.lit(""))
    remote = F.coalesce(r["isRemote"], F.lit(False))
    return _capped(records, cap).select(job_columns(
        "ashby", native_id=_either(r["id"], r["jobId"]), title=r["title"],
        company=labels.company_from_slug(F.col("company_slug")),
        url=_either(r["jobUrl"], r["applyUrl"]),
        work_model=labels.work_model_label(place, remote), city=place,
        country=labels.country_from_location(place),
        market=F.when(remote, REMOTE_MARKET).otherwise(labels.market_from_location(place)),
        published_date=feed_date(r["publishedAt"]),
        categories=F.array(F.coalesce(_either(r["department"], r["teamName"]), F.lit(""))),
    ))


ADAPTERS: dict[str, Callable[..., DataFrame]] = {
    "gupy": gupy, "themuse": themuse, "remotive": remotive, "jobicy": jobicy,
    "remoteok": remoteok, "himalayas": himalayas, "workingnomads": workingnomads,
    "arbeitnow": arbeitnow, "weworkremotely": weworkremotely, "greenhouse": greenhouse,
    "lever": lever, "ashby": ashby,
}


def normalise(landing: DataFrame, feed: str, **limits: int) -> DataFrame:
    """One feed's postings; whole, unless its adapter is given a limit."""
    return ADAPTERS[feed](unpack(landing, feed), **limits)


def normalise_all(landing: DataFrame) -> DataFrame:
    """Every feed's postings under the common schema."""
    return union_sources([normalise(landing, feed) for feed in ADAPTERS])
