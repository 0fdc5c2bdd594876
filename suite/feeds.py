"""Feed adapters on payloads derived from the documents and customers tables.

Every document becomes one landed page of each feed, written the way the feed
writes it; the twins compute the expected record from the plain columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suite.registry import oracle, query, table, view
from suite.text import _BR, _MARKET, _SENIORITY, _WORK, _duck_area
from tidemark.functions import taxonomy
from tidemark.operators import postings
from tidemark.plans import jobs as jobs_plan
from tidemark.sources import feeds, jobs, rentals

DAY = "CAST(DATE '2024-01-01' + CAST(doc_id % 120 AS INTEGER) AS VARCHAR)"


def _day() -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 120).cast("int")).cast("string")


def _id(step: int = 1) -> Column:
    return F.floor(F.col("doc_id") / step).cast("bigint")


def _html() -> Column:
    return F.concat(F.lit("<b>"), "company", F.lit("</b>  &amp; more&#33;"))


def _named(value: Column) -> Column:
    return F.struct(value.alias("name"))


def _landing(spark, sf, feed: str) -> DataFrame:
    n, title, company = F.col("doc_id"), F.col("title"), F.col("company")
    place, lang = F.col("location"), F.col("lang")
    url = F.concat(F.lit("https://x.example/"), _id(2))
    records = {
        "gupy": {"id": _id(2), "name": title, "careerPageName": company, "jobUrl": url,
                 "isRemoteWork": n % 10 == 0, "workplaceType": place, "city": lang, "state": F.lit(None).cast("string"),
                 "publishedDate": _day(), "description": _html()},
        "themuse": {"id": n, "name": title, "company": _named(company),
                    "locations": F.when(n % 4 == 0, F.array(_named(place), _named(F.lit("Flexible / Remote"))))
                    .otherwise(F.array(_named(place))),
                    "levels": F.array(_named(F.col("level_hint")), _named(F.lit("Management"))),
                    "categories": F.array(_named(F.col("category_hint"))),
                    "refs": F.struct(url.alias("landing_page")), "publication_date": F.concat(_day(), F.lit("T01:02:03Z")),
                    "contents": _html()},
        "remotive": {"id": F.when(n % 3 != 0, _id(2)), "url": url, "title": title, "company_name": company,
                     "candidate_required_location": place, "publication_date": _day(),
                     "tags": F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.concat(F.lit("t"), i)),
                     "description": _html(), "category": F.col("category_hint")},
        "remoteok": {"id": F.when(n % 7 != 0, n), "position": title, "company": company,
                     "url": F.when(n % 2 == 0, url), "salary_min": n % 5 * 1000, "salary_max": n % 3 * 9000,
                     "date": _day(), "tags": F.array(lang, F.lit("")), "description": _html()},
        "workingnomads": {"url": url, "title": title, "company_name": company, "location": place,
                          "pub_date": _day(), "description": _html(), "category_name": F.col("category_hint")},
        "arbeitnow": {"slug": F.when(n % 3 != 0, F.concat(F.lit("s-"), n)), "url": url, "title": title, "company_name": company,
                      "remote": n % 4 == 0, "location": place, "created_at": F.lit(1704067200) + n % 120 * 86400 + 3600,
                      "tags": F.array(lang), "description": _html()},
        "greenhouse": {"id": n, "title": title, "absolute_url": url, "location": _named(place),
                       "departments": F.array(_named(F.col("category_hint")), _named(F.lit(""))),
                       "updated_at": F.when(n % 2 == 0, _day()), "first_published": _day()},
        "lever": {"id": n.cast("string"), "text": title, "hostedUrl": url,
                  "createdAt": (F.lit(1704067200) + n % 120 * 86400) * F.when(n % 2 == 0, 1).otherwise(1000),
                  "categories": F.struct(place.alias("location"), F.when(n % 3 == 0, "Remote").alias("commitment"),
                                         F.col("category_hint").alias("department"), F.lit("Team").alias("team"))},
        "ashby": {"id": F.when(n % 2 == 0, n), "jobId": F.concat(F.lit("j"), n), "title": title,
                  "jobUrl": F.when(n % 3 == 0, url), "applyUrl": F.concat(url, F.lit("/apply")), "location": F.when(n % 2 == 0, place),
                  "locationName": place, "isRemote": n % 5 == 0, "publishedAt": _day(),
                  "department": F.lit(""), "teamName": F.col("category_hint")},
    }
    raw = view(spark, sf, "f2_roles")
    envelope = feeds.FEEDS[feed].envelope
    if feed == "jobicy":
        industry = F.when(n % 3 == 0, F.lit('["Design","Sales"]')).when(n % 3 == 1, F.lit('"Finance"')).otherwise(F.lit("null"))
        record = F.to_json(F.struct(_id(2).alias("id"), url.alias("url"), title.alias("jobTitle"), company.alias("companyName"),
                                    place.alias("jobGeo"), _day().alias("pubDate"), _html().alias("jobExcerpt")))
        body = F.concat(F.lit('{"jobs":['), F.regexp_replace(record, r"\}\z", ""), F.lit(',"jobIndustry":'), industry, F.lit("}]}"))
    elif feed == "himalayas":
        limits = F.when(n % 3 == 0, F.lit('["Brazil","Chile"]')).when(n % 3 == 1, F.lit('"Peru"')).otherwise(F.lit("[]"))
        record = F.to_json(F.struct(F.when(n % 2 == 0, url).alias("guid"), title.alias("title"), company.alias("companyName"),
                                    F.when(n % 4 == 0, F.concat(url, F.lit("/apply"))).alias("applicationLink"), _day().alias("pubDate"),
                                    F.array(lang, F.lit("")).alias("categories"), _html().alias("excerpt")))
        body = F.concat(F.lit('{"jobs":['), F.regexp_replace(record, r"\}\z", ""), F.lit(',"locationRestrictions":'), limits, F.lit("}]}"))
    elif feed == "gupy":
        record = F.to_json(F.struct(*[v.alias(k) for k, v in records["gupy"].items()]))
        skills = F.concat(F.lit(',"skills":[{"name":"sql"},"'), lang, F.lit('",{"x":1},""]'))
        body = F.concat(F.lit('{"data":['), F.regexp_replace(record, r"\}\z", ""), skills, F.lit("}]}"))
    elif feed == "weworkremotely":
        def xml(text: Column) -> Column:
            # characters XML 1.0 cannot carry do not occur in a feed
            safe = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
            for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
                safe = F.replace(safe, F.lit(char), F.lit(entity))
            return safe

        item = {"link": url, "title": F.when(n % 3 == 0, xml(title)).otherwise(F.concat(xml(company), F.lit(": "), xml(title))),
                "region": F.when(n % 2 == 0, place).otherwise(""), "country": F.lit("Anywhere"), "category": F.coalesce("category_hint", F.lit("")),
                "pubDate": F.date_format(F.to_date(_day()), "E, dd MMM yyyy") , "description": xml(_html())}
        item["pubDate"] = F.concat(item["pubDate"], F.lit(" 23:30:00 -0800"))
        tags = [F.concat(F.lit(f"<{k}>"), v, F.lit(f"</{k}>")) for k, v in item.items()]
        body = F.concat(F.lit("<rss><channel><item>"), *tags, F.lit("</item></channel></rss>"))
    else:
        record = F.array(F.struct(*[v.alias(k) for k, v in records[feed].items()]))
        body = F.to_json(F.struct(record.alias(envelope)) if envelope else record)
    slug = F.when(n % 2 == 0, "wildlifestudios").otherwise("open-ai")
    return raw.select(F.lit(feed).alias("feed"), slug.alias("company_slug"), n.alias("page"), body.alias("body"))


# expected values shared by the feeds
_URL = "'https://x.example/' || doc_id // 2"
_COMMON = {
    "native_id": "CAST(doc_id AS VARCHAR)", "title": "TRIM(title)", "company": "company", "url": _URL, "work_model": "'remote'",
    "city": "''", "state": "''", "country": "location", "market": "'Global remote'", "salary_min": "CAST(NULL AS DOUBLE)",
    "salary_max": "CAST(NULL AS DOUBLE)", "salary_currency": "CAST(NULL AS VARCHAR)", "published_date": f"CAST({DAY} AS DATE)",
    "skills": "''", "description": "TRIM(company || ' & more!')", "levels": "''", "categories": "COALESCE(category_hint, '')",
}
_FIRST = " QUALIFY ROW_NUMBER() OVER (PARTITION BY {} ORDER BY doc_id) = 1"


def _expected(feed: str, tail: str = "", **other: str) -> str:
    columns = {"source": f"'{feed}'", **_COMMON, **other}
    picks = ", ".join(f"{v} AS {k}" for k, v in columns.items())
    return oracle("f2_roles", sql=f"SELECT {picks} FROM f2_roles{tail}")


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(*[
        F.array_join(c, "|").alias(c) if c in jobs.LIST_COLUMNS else c for c in jobs.COLUMN_TYPES])


_PLACE_WORK = _WORK.format("location")
_BOARD = {
    "company": "CASE WHEN doc_id % 2 = 0 THEN 'Wildlife Studios' ELSE 'Open-Ai' END", "work_model": _PLACE_WORK, "city": "location",
    "country": f"CASE WHEN {_BR.format('location')} THEN 'BR' ELSE location END", "market": _MARKET.format("location"), "description": "''",
}
_NATIVE = f"CASE WHEN doc_id % 3 <> 0 THEN CAST(doc_id // 2 AS VARCHAR) ELSE {_URL} END"
_ANY = "doc_id % 4 = 0 OR REGEXP_MATCHES(LOWER(location), 'remote|flexible')"

EXPECTED = {
    "gupy": _expected(
        "gupy", _FIRST.format("doc_id // 2"), native_id="CAST(doc_id // 2 AS VARCHAR)", country="'BR'", market="'BR'", city="lang",
        work_model=f"CASE WHEN doc_id % 10 = 0 THEN 'remote' ELSE {_PLACE_WORK} END", skills="'sql|' || lang", categories="''"),
    "themuse": _expected(
        "themuse", city="location", country=f"CASE WHEN {_ANY} THEN 'Remote' ELSE location END",
        market=f"CASE WHEN {_ANY} THEN 'Global remote' ELSE 'Global' END",
        work_model=f"CASE WHEN {_ANY} THEN 'remote' ELSE {_PLACE_WORK} END", levels="CONCAT_WS('|', level_hint, 'Management')"),
    "remotive": _expected(
        "remotive", _FIRST.format(_NATIVE), native_id=_NATIVE, skills="'t1|t2|t3|t4|t5|t6|t7|t8|t9|t10'"),
    "jobicy": _expected(
        "jobicy", _FIRST.format("doc_id // 2"), native_id="CAST(doc_id // 2 AS VARCHAR)",
        categories="CASE doc_id % 3 WHEN 0 THEN 'Design|Sales' WHEN 1 THEN 'Finance' ELSE '' END"),
    "remoteok": _expected(
        "remoteok", " WHERE doc_id % 7 <> 0", country="''", url=f"CASE WHEN doc_id % 2 = 0 THEN {_URL} ELSE 'https://remoteok.com/remote-jobs/' || doc_id END",
        salary_min="CAST(NULLIF(doc_id % 5 * 1000, 0) AS DOUBLE)", salary_max="CAST(NULLIF(doc_id % 3 * 9000, 0) AS DOUBLE)",
        salary_currency="CASE WHEN doc_id % 15 <> 0 THEN 'USD' END", skills="lang", categories="''"),
    "himalayas": _expected(
        "himalayas", native_id=f"CASE WHEN doc_id % 2 = 0 THEN {_URL} ELSE title END",
        url=f"CASE WHEN doc_id % 4 = 0 THEN {_URL} || '/apply' WHEN doc_id % 2 = 0 THEN {_URL} ELSE '' END",
        country="CASE doc_id % 3 WHEN 0 THEN 'Brazil, Chile' WHEN 1 THEN 'Peru' ELSE '' END", skills="lang", categories="''"),
    "workingnomads": _expected("workingnomads", native_id=_URL, work_model=_PLACE_WORK),
    "arbeitnow": _expected(
        "arbeitnow", native_id=f"CASE WHEN doc_id % 3 <> 0 THEN 's-' || doc_id ELSE {_URL} END", skills="lang", categories="''",
        work_model=f"CASE WHEN doc_id % 4 = 0 THEN 'remote' ELSE {_PLACE_WORK} END"),
    "weworkremotely": _expected(
        "weworkremotely", _FIRST.format("doc_id // 2"), native_id=_URL,
        company="CASE WHEN doc_id % 3 = 0 THEN '' ELSE company END",
        country="CASE WHEN doc_id % 2 = 0 AND location <> '' THEN location ELSE 'Anywhere' END"),
    "greenhouse": _expected("greenhouse", **_BOARD),
    "lever": _expected(
        "lever", **_BOARD | {
            "work_model": f"CASE WHEN doc_id % 3 = 0 THEN 'remote' ELSE {_PLACE_WORK} END", "categories": "COALESCE(category_hint, 'Team')",
            "published_date": f"CASE WHEN doc_id % 2 = 0 THEN CAST({DAY} AS DATE) END"}),
    "ashby": _expected(
        "ashby", **_BOARD | {
            "native_id": "CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE 'j' || doc_id END",
            "url": f"CASE WHEN doc_id % 3 = 0 THEN {_URL} ELSE {_URL} || '/apply' END",
            "work_model": f"CASE WHEN doc_id % 5 = 0 THEN 'remote' ELSE {_PLACE_WORK} END",
            "market": f"CASE WHEN doc_id % 5 = 0 THEN 'Global remote' ELSE {_MARKET.format('location')} END"}),
}
NAMES = {"weworkremotely": "norm_wwr_rss"}


def _register(feed: str) -> None:
    @query(NAMES.get(feed, f"norm_{feed}"), EXPECTED[feed])
    def run(spark, sf):
        return _flat(jobs.normalise(_landing(spark, sf, feed), feed))


for _feed in jobs.ADAPTERS:
    _register(_feed)


def _all_landed(spark, sf) -> DataFrame:
    return postings.union_sources([_landing(spark, sf, feed) for feed in jobs.ADAPTERS])


@query("norm_job_schema", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT source, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(published_date) AS BIGINT) AS dated, "
    f"CAST(SUM(LENGTH(title)) AS BIGINT) AS title_chars FROM ({sql}) GROUP BY source" for sql in EXPECTED.values()) + ")")
def norm_job_schema(spark, sf):
    return jobs.normalise_all(_all_landed(spark, sf)).groupBy("source").agg(
        F.count("*").alias("n_rows"), F.count("published_date").alias("dated"),
        F.sum(F.length("title")).cast("bigint").alias("title_chars"))


def _damaged(spark, sf) -> DataFrame:
    """Pages cut off, blank or of another shape by key, several records on others; all of lever's are cut off."""
    n = F.col("page")
    cut = F.expr("substring(body, 1, length(body) - 3)")
    whole = F.when(n % 5 == 0, F.regexp_replace("body", r"(?s)\A(\{\"\w+\":\[)(.*)(\]\})\z", "$1$2,$2$3")).otherwise(F.col("body"))
    body = (F.when(n % 7 == 0, cut).when(n % 11 == 0, " ").when(n % 13 == 0, '{"other":[]}').otherwise(whole))
    bodies = [_landing(spark, sf, feed).withColumn("body", body) for feed in ("gupy", "arbeitnow")]
    return postings.union_sources([*bodies, _landing(spark, sf, "lever").withColumn("body", cut)])


_FAULT = """CASE WHEN doc_id % 7 = 0 THEN 'unreadable' WHEN doc_id % 11 = 0 THEN 'empty'
      WHEN doc_id % 13 = 0 THEN 'no records field' END"""


@query("feed_report", f"""
    SELECT feed, CAST(COUNT(*) AS BIGINT) AS n_pages, CAST(COUNT(fault) AS BIGINT) AS n_lost,
      CAST(SUM(CASE WHEN fault IS NOT NULL THEN 0 WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n_records,
      COUNT(*) = COUNT(fault) AS failed
    FROM (SELECT 'gupy' AS feed, doc_id, {_FAULT} AS fault FROM documents
      UNION ALL SELECT 'arbeitnow', doc_id, {_FAULT} FROM documents
      UNION ALL SELECT 'lever', doc_id, 'unreadable' FROM documents) GROUP BY feed""")
def feed_report(spark, sf):
    return feeds.feed_report(_damaged(spark, sf), ["gupy", "arbeitnow", "lever"])


@query("lost_pages", f"""
    SELECT 'gupy' AS feed, CASE WHEN doc_id % 2 = 0 THEN 'wildlifestudios' ELSE 'open-ai' END AS company_slug, doc_id AS page,
      {_FAULT} AS reason FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 13 = 0""")
def lost_pages(spark, sf):
    return feeds.lost_pages(_damaged(spark, sf), "gupy")


# both runs' records of greenhouse and arbeitnow
_RUNS = """
    SELECT 'greenhouse' AS source, doc_id, title, '' AS lead, COALESCE(category_hint, '') AS hint, run FROM (
      SELECT *, CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 2 END AS run FROM f2_roles)
    UNION ALL
    SELECT 'arbeitnow', doc_id, title, TRIM(company || ' & more!'), '', CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 2 END FROM f2_roles"""
_LABELLED = f"""
    SELECT source, CASE WHEN hint = 'DevOps and Sysadmin' THEN 'software engineering' WHEN hint = 'Business' THEN 'other'
        WHEN best.s >= 3 THEN best.a ELSE 'other' END AS area, {_SENIORITY} AS seniority, run
    FROM (SELECT *, {_duck_area(taxonomy.AREA_KEYWORDS, 'spaced', 'lead')} AS best FROM (
      SELECT *, ' ' || TRIM(title) || ' ' AS spaced, ' ' || LOWER(TRIM(title)) || ' ' AS padded FROM first_runs))"""


@query("jobs_run", oracle("f2_roles", runs=_RUNS, first_runs="""
    SELECT source, doc_id, ANY_VALUE(title) AS title, ANY_VALUE(lead) AS lead, ANY_VALUE(hint) AS hint, MIN(run) AS run
    FROM runs GROUP BY source, doc_id""", labelled=_LABELLED, sql="""
    SELECT source, area, seniority, CASE WHEN run = 1 THEN DATE '2024-05-01' ELSE DATE '2024-05-03' END AS first_seen_date,
      CAST(COUNT(*) AS BIGINT) AS n_rows FROM labelled GROUP BY ALL"""))
def jobs_run(spark, sf):
    """Landed feeds to an updated base, two runs apart."""
    landed = _landing(spark, sf, "greenhouse").unionByName(_landing(spark, sf, "arbeitnow"))
    first = jobs_plan.collect(landed.where(F.col("page") % 3 != 0), ["greenhouse", "arbeitnow"], {}, None)
    second = jobs_plan.collect(landed, ["greenhouse", "arbeitnow"], {}, None)
    base = jobs_plan.update_base(jobs_plan.empty_base(spark), first, "2024-05-01")
    return jobs_plan.update_base(base, second, "2024-05-03").groupBy(
        "source", "area", "seniority", "first_seen_date").agg(F.count("*").alias("n_rows"))


# -- rentals ---------------------------------------------------------------------------------

def _rental_landing(spark, sf) -> DataFrame:
    n = F.col("c_custkey")
    text = lambda c: c.cast("string")
    other = F.struct(F.lit("SALE").alias("businessType"), F.lit("290000").alias("price"), F.lit(None).cast("string").alias("monthlyCondoFee"),
                     F.lit(None).cast("string").alias("iptu"), F.lit(None).cast("string").alias("yearlyIptu"),
                     F.struct(F.lit(None).cast("string").alias("period")).alias("rentalInfo"))
    rental = F.struct(F.lit("RENTAL").alias("businessType"), F.when(n % 23 == 0, "0").otherwise(text(2000 + n * 131 % 16000)).alias("price"),
                      F.when(n % 2 == 0, "1.250,90").alias("monthlyCondoFee"), F.when(n % 3 == 0, "300").alias("iptu"),
                      F.lit("3600").alias("yearlyIptu"),
                      F.struct(F.when(n % 10 == 0, "DAILY").when(n % 10 == 1, "monthly").alias("period")).alias("rentalInfo"))
    usage = F.when(n % 6 == 0, F.array(F.lit("COMMERCIAL"))).when(n % 6 == 1, F.array(F.lit("COMMERCIAL"), F.lit("RESIDENTIAL")))
    one = lambda c: F.array(text(c))
    listing = F.struct(
        text(F.floor((n + 1) / 2)).alias("id"), F.when(n % 8 == 0, "INACTIVE").when(n % 8 == 1, "ACTIVE").alias("status"), usage.alias("usageTypes"),
        F.array(F.lit("FARM")).alias("unitTypes"), F.concat(F.lit("  Sítio "), n).alias("title"),
        F.concat(F.lit("<p>Fone (19) 3232-1010, mail a.b@c.com.br</p>"), n % 10).alias("description"), F.array(other, rental).alias("pricingInfos"),
        F.struct(F.col("c_mktsegment").alias("city"), F.lit(" SP ").alias("state")).alias("address"),
        F.struct(F.lit(-22.5).alias("lat"), F.when(n % 5 != 0, -47.25).alias("lon")).alias("displayAddressGeolocation"),
        one(50 + n * 977 % 30000).alias("totalAreas"), F.array().cast("array<string>").alias("usableAreas"), one(n % 6).alias("bedrooms"),
        F.array(F.lit("POOL")).alias("mergedAmenities"),
        F.when(n % 4 == 0, F.array(F.lit("ZAP"))).otherwise(F.array(F.lit("ZAP"), F.lit("VIVAREAL"))).alias("portals"),
        F.lit("2024-03-04T05:06:07Z").alias("createdAt"))
    # a listing has up to eleven media; an id is damaged and a video stands among them where the key says so
    medias = F.transform(F.sequence(F.lit(0), n.cast("int") % 11), lambda i: F.struct(
        F.when((i + n) % 9 == 2, "bad-id").otherwise(F.concat(F.lit("p"), n, F.lit("x"), i)).alias("id"),
        F.when((i + n) % 7 == 4, "VIDEO").when(i % 2 == 0, "IMAGE").alias("type")))
    row = F.struct(listing.alias("listing"), _named(F.concat(F.lit(" "), F.col("c_name"))).alias("account"), medias.alias("medias"))
    body = F.to_json(F.struct(F.array(row).alias("listings")))
    return table(spark, sf, "customer").select(
        F.lit("rentals").alias("feed"), F.lit(None).cast("string").alias("company_slug"), n.alias("page"), body.alias("body"))


_RENTALS = """
    SELECT * FROM customer QUALIFY ROW_NUMBER() OVER (PARTITION BY (c_custkey + 1) // 2 ORDER BY c_custkey) = 1"""
_KEPT = "c_custkey % 8 <> 0 AND c_custkey % 6 <> 0 AND c_custkey % 10 <> 0 AND c_custkey % 23 <> 0"


_PHOTOS = """COALESCE((SELECT STRING_AGG('p' || c_custkey || 'x' || i, '|' ORDER BY i) FROM RANGE(11) AS g(i)
      WHERE i <= c_custkey % 11 AND (i + c_custkey) % 9 <> 2 AND (i + c_custkey) % 7 <> 4), '')"""


@query("norm_listing", oracle(r=_RENTALS, sql=f"""
    SELECT CAST((c_custkey + 1) // 2 AS VARCHAR) AS native_id, 'Sítio ' || c_custkey AS title,
      CASE WHEN c_custkey % 4 = 0 THEN 'https://www.zapimoveis.com.br' ELSE 'https://www.vivareal.com.br' END
        || '/imovel/id-' || (c_custkey + 1) // 2 || '/' AS url,
      'Fone [phone], mail [email] ' || c_custkey % 10 AS description, c_mktsegment AS city, 'SP' AS state,
      CAST(-22.5 AS DOUBLE) AS lat, CASE WHEN c_custkey % 5 <> 0 THEN CAST(-47.25 AS DOUBLE) END AS lon,
      CAST(2000 + c_custkey * 131 % 16000 AS BIGINT) AS rent, CASE WHEN c_custkey % 2 = 0 THEN CAST(1250 AS BIGINT) END AS condo_fee,
      CAST(CASE WHEN c_custkey % 3 = 0 THEN 300 ELSE 3600 END AS BIGINT) AS iptu, CAST(50 + c_custkey * 977 % 30000 AS BIGINT) AS total_area,
      CAST(NULL AS BIGINT) AS usable_area, CAST(NULLIF(c_custkey % 6, 0) AS BIGINT) AS bedrooms, {_PHOTOS} AS photos,
      c_name AS advertiser, DATE '2024-03-04' AS published_date,
      CASE WHEN c_custkey % 4 = 0 THEN 'ZAP' ELSE 'ZAP|VIVAREAL' END AS portals, 'FARM' AS unit_type_raw
    FROM r WHERE {_KEPT}"""))
def norm_listing(spark, sf):
    rows = rentals.normalise(_rental_landing(spark, sf), "zap")
    return rows.select(
        "native_id", "title", "url", "description", "city", "state", "lat", "lon", "rent", "condo_fee", "iptu", "total_area",
        "usable_area", "bedrooms", F.array_join("photos", "|").alias("photos"), "advertiser", "published_date",
        F.array_join("portals", "|").alias("portals"), "unit_type_raw")


def _entries(spark, sf) -> DataFrame:
    return feeds.unpack(_rental_landing(spark, sf), "rentals")


@query("rental_price", """
    SELECT c_custkey AS page, CASE WHEN ok THEN CAST(2000 + c_custkey * 131 % 16000 AS BIGINT) END AS rent,
      CASE WHEN ok AND c_custkey % 2 = 0 THEN CAST(1250 AS BIGINT) END AS condo_fee,
      CASE WHEN ok THEN CAST(CASE WHEN c_custkey % 3 = 0 THEN 300 ELSE 3600 END AS BIGINT) END AS iptu
    FROM (SELECT *, c_custkey % 10 <> 0 AND c_custkey % 23 <> 0 AS ok FROM customer)""")
def rental_price(spark, sf):
    price = rentals.rental_price(F.col("r.listing.pricingInfos"))
    page = F.floor(F.col("ord") / feeds.RECORDS_PER_PAGE).alias("page")
    return _entries(spark, sf).select(page, price.alias("p")).select("page", "p.*")


@query("photo_ids", f"SELECT c_custkey AS page, {_PHOTOS} AS photos FROM customer")
def photo_ids(spark, sf):
    ids = rentals.photo_ids(F.col("r.medias"))
    page = F.floor(F.col("ord") / feeds.RECORDS_PER_PAGE).alias("page")
    return _entries(spark, sf).select(page, F.array_join(ids, "|").alias("photos"))


@query("usage_filter", "SELECT c_custkey AS page FROM customer WHERE c_custkey % 6 <> 0")
def usage_filter(spark, sf):
    page = F.floor(F.col("ord") / feeds.RECORDS_PER_PAGE).alias("page")
    return _entries(spark, sf).where(rentals.usage_allowed(F.col("r.listing.usageTypes"))).select(page)


def _mixed_pages(spark, sf):
    """Pages of four records each; one is no object, and one has fields of the wrong type, where the key says so."""
    n = F.col("c_custkey")
    good = F.concat(F.lit('{"id":"a'), n, F.lit('","name":"Dev","isRemoteWork":true,"skills":["x"]}'))
    broken = F.when(n % 3 == 0, F.lit('"oops"')).when(n % 3 == 1, F.lit("17")).otherwise(F.lit('{"id":"b","name":"Ops"}'))
    odd = F.when(n % 4 == 0, F.concat(F.lit('{"id":"c","name":"QA '), n, F.lit('","isRemoteWork":"maybe","skills":5}'))).otherwise(
        F.lit('{"id":"c","name":"QA","isRemoteWork":false}'))
    body = F.concat(F.lit('{"data":['), good, F.lit(","), broken, F.lit(","), odd, F.lit(',{"id":"d"}]}'))
    return table(spark, sf, "customer").select(
        F.lit("gupy").alias("feed"), F.lit(None).cast("string").alias("company_slug"), n.alias("page"), body.alias("body"))


@query("quarantine", """
    SELECT c_custkey AS page, 1 AS place, 'not a record' AS reason, '' AS fields FROM customer WHERE c_custkey % 3 <> 2
    UNION ALL SELECT c_custkey, 2, 'unreadable fields', 'isRemoteWork,skills' FROM customer WHERE c_custkey % 4 = 0""")
def quarantine(spark, sf):
    found = feeds.quarantine(_mixed_pages(spark, sf), "gupy")
    return found.select("page", "place", "reason", F.array_join("fields", ",").alias("fields"))


@query("unpack_mixed_pages", """
    SELECT c_custkey AS page, CAST(4 - CAST(c_custkey % 3 <> 2 AS INTEGER) AS BIGINT) AS n_records,
      CASE WHEN c_custkey % 4 = 0 THEN 'QA ' || c_custkey ELSE 'QA' END AS third FROM customer""")
def unpack_mixed_pages(spark, sf):
    """A page keeps its other records, and a record its other fields."""
    rows = feeds.unpack(_mixed_pages(spark, sf), "gupy")
    page = F.floor(F.col("ord") / feeds.RECORDS_PER_PAGE).alias("page")
    third = F.max(F.when(F.col("r.id") == "c", F.col("r.name"))).alias("third")
    return rows.groupBy(page).agg(F.count("*").alias("n_records"), third)
