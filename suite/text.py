"""Text, label, key and taxonomy functions over the documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import oracle, query, table, view
from tidemark.functions import dates, keys, labels, numbers, taxonomy, text
from tidemark.operators import leads, ordering, postings, quality

# RE2 has no Unicode \b, so the twins spell word boundaries out.
_W = r"[\p{L}\p{N}_]"
_B, _E = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
_SP = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _duck_fold(expr: str) -> str:
    """Accent folding for the Latin texts at hand."""
    return (f"LOWER(REGEXP_REPLACE(STRIP_ACCENTS(NFC_NORMALIZE({expr})), '[^\\x00-\\x7F]', '', 'g'))")


def _duck_scrub(expr: str) -> str:
    email = rf"{_W}[\p{{L}}\p{{N}}_.+-]*@[\p{{L}}\p{{N}}_-]+\.[\p{{L}}\p{{N}}_.]*{_W}"
    link = r"(?i)\b(?:https?://|www\.)[^\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
    phone = (r"(?:\(?\d{2}\)?[\s.-]*)?(?:9[\s.-]*)?\d{4}[\s.-]?\d{4}"
             r"|\+?55[\s.-]?\d{2}[\s.-]?\d{4,5}[\s.-]?\d{4}")
    out = expr
    for pattern, mask in ((email, "[email]"), (link, "[link]"), (phone, "[phone]")):
        out = f"REGEXP_REPLACE({out}, {_quoted(pattern)}, '{mask}', 'g')"
    return out


def _duck_strip(expr: str, scrub: bool = False) -> str:
    out = f"REGEXP_REPLACE({expr}, '<[^>]+>', ' ', 'g')"
    # these names also count without their semicolon, as cut-off pages have them
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        out = f"REGEXP_REPLACE({out}, '&{name};?', {_quoted(char)}, 'g')"
    if scrub:
        out = _duck_scrub(out)
    out = f"REGEXP_REPLACE({out}, '{_SP}{{2,}}', ' ', 'g')"
    return f"REGEXP_REPLACE({out}, '^{_SP}+|{_SP}+$', '', 'g')"


@query("strip_html", f"SELECT page_id, {_duck_strip('html')} AS body FROM pages")
def strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_html(F.col("html")).alias("body"))


@query("strip_html_scrubbed", f"SELECT page_id, {_duck_strip('html', True)} AS body FROM pages")
def strip_html_scrubbed(spark, sf):
    body = text.strip_html(F.col("html"), scrub=True)
    return table(spark, sf, "pages").select("page_id", body.alias("body"))


@query("scrub_contacts", f"SELECT doc_id, {_duck_scrub('text')} AS scrubbed FROM documents")
def scrub_contacts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.scrub_contacts(F.col("text")).alias("scrubbed"))


@query("fold_accents", f"SELECT doc_id, {_duck_fold('text')} AS folded FROM documents")
def fold_accents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.fold_accents(F.col("text")).alias("folded"))


@query("snippet", "SELECT doc_id, SUBSTRING(text, 1, 400) AS snippet FROM documents")
def snippet(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.snippet(F.col("text")).alias("snippet"))


@query("skills_join", """
    SELECT doc_id, ARRAY_TO_STRING(LIST_SLICE(STRING_SPLIT(text, ' '), 1, 6), ' · ') AS skills FROM documents""")
def skills_join(spark, sf):
    words = F.split("text", " ")
    return table(spark, sf, "documents").select("doc_id", text.skills_join(words).alias("skills"))


# -- dates and numbers -----------------------------------------------------------------------

_STAMPS = f"""
    SELECT event_id, CAST(ts AS DATE) AS day, CASE event_id % 7
      WHEN 0 THEN CAST(CAST(FLOOR(EPOCH(ts)) AS BIGINT) AS VARCHAR) WHEN 1 THEN STRFTIME(ts, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 2 THEN '2024' WHEN 3 THEN CAST(CAST(FLOOR(EPOCH(ts)) AS BIGINT) * 1000 AS VARCHAR) WHEN 4 THEN NULL
      WHEN 5 THEN '  ' || CAST(CAST(ts AS DATE) AS VARCHAR) || ' x' ELSE 'May 2024' END AS raw FROM events"""


@query("iso_date", oracle(s=_STAMPS, sql="""
    SELECT event_id, CASE WHEN event_id % 7 IN (0, 1, 5) THEN CAST(day AS VARCHAR) ELSE '' END AS iso FROM s"""))
def iso_date(spark, sf):
    n, ts = F.col("event_id") % 7, F.col("ts")
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    raw = (
        F.when(n == 0, seconds.cast("string")).when(n == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(n == 2, "2024").when(n == 3, (seconds * 1000).cast("string")).when(n == 4, None)
        .when(n == 5, F.concat(F.lit("  "), F.to_date(ts).cast("string"), F.lit(" x"))).otherwise("May 2024")
    )
    return table(spark, sf, "events").select("event_id", dates.iso_date(raw).alias("iso"))


@query("rfc822_date", """
    SELECT event_id, CASE WHEN event_id % 4 = 3 THEN '' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS iso FROM events""")
def rfc822_date(spark, sf):
    n, ts = F.col("event_id") % 4, F.col("ts")
    raw = (
        F.when(n == 0, F.concat(F.date_format(ts, "E, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")))
        .when(n == 1, F.concat(F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(n == 2, F.concat(F.date_format(ts, "E, d MMM yy HH:mm"), F.lit(" -0930")))
        .otherwise(F.date_format(ts, "MMM d, yyyy"))
    )
    return table(spark, sf, "events").select("event_id", dates.rfc822_date(raw).alias("iso"))


_MONEY = """CASE l_linenumber % 5 WHEN 0 THEN 'R$ ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.600,50'
    WHEN 1 THEN CAST(l_orderkey AS VARCHAR) WHEN 2 THEN '' WHEN 3 THEN '-' || CAST(l_suppkey AS VARCHAR) ELSE NULL END"""


@query("as_int", """
    SELECT l_linenumber, n, CAST(COUNT(*) AS BIGINT) AS n_rows FROM (
      SELECT l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN CAST(l_quantity AS BIGINT) * 1000 + 600
        WHEN 1 THEN NULLIF(l_orderkey, 0) WHEN 3 THEN NULLIF(l_suppkey, 0) END AS n FROM lineitem) GROUP BY ALL""")
def as_int(spark, sf):
    raw = F.expr(_MONEY.replace("VARCHAR", "STRING"))
    rows = table(spark, sf, "lineitem").select("l_linenumber", numbers.as_int(raw).alias("n"))
    return rows.groupBy("l_linenumber", "n").agg(F.count("*").alias("n_rows"))


@query("first_int", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE NULLIF(o_custkey, 0) END AS n FROM orders""")
def first_int(spark, sf):
    listed = F.when(F.col("o_orderkey") % 3 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit("no. "), "o_custkey"), F.lit("7")))
    return table(spark, sf, "orders").select("o_orderkey", numbers.first_int(listed).alias("n"))


# -- labels on role postings -----------------------------------------------------------------

def _roles(spark, sf):
    return view(spark, sf, "f2_roles")


_WORK = """CASE WHEN REGEXP_MATCHES(LOWER({0}), 'remote|remoto|anywhere|home office|home-office') THEN 'remote'
    WHEN REGEXP_MATCHES(LOWER({0}), 'hybrid|híbrido|hibrido') THEN 'hybrid'
    WHEN REGEXP_MATCHES(LOWER({0}), 'on-site|onsite|presencial|in office|in-office') THEN 'on-site' ELSE '' END"""
_BR = """REGEXP_MATCHES(LOWER({0}), 'bras|brazil|são paulo|sao paulo|rio de janeiro|belo horizonte|curitiba|porto alegre')"""
_MARKET = f"CASE WHEN {_BR} THEN 'BR' WHEN REGEXP_MATCHES(LOWER({{0}}), 'remote|anywhere|distributed') THEN 'Global remote' ELSE 'Global' END"


@query("work_model_label", oracle("f2_roles", sql=f"""
    SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'remote' ELSE {_WORK.format('location')} END AS work_model FROM f2_roles"""))
def work_model_label(spark, sf):
    flag = F.when(F.col("doc_id") % 10 == 0, True)
    return _roles(spark, sf).select("doc_id", labels.work_model_label(F.col("location"), flag).alias("work_model"))


@query("market_from_location", oracle("f2_roles", sql=f"""
    SELECT doc_id, CASE WHEN {_BR.format('location')} THEN 'BR' ELSE location END AS country,
      {_MARKET.format('location')} AS market FROM f2_roles"""))
def market_from_location(spark, sf):
    place = F.col("location")
    return _roles(spark, sf).select(
        "doc_id", labels.country_from_location(place).alias("country"),
        labels.market_from_location(place).alias("market"))


@query("company_title_split", oracle("f2_roles", h="""
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN title ELSE company || ': ' || title || ': Lead' END AS line FROM f2_roles""", sql="""
    SELECT doc_id, CASE WHEN CONTAINS(line, ': ') THEN SPLIT_PART(line, ': ', 1) ELSE '' END AS company,
      CASE WHEN CONTAINS(line, ': ') THEN SUBSTR(line, STRPOS(line, ': ') + 2) ELSE line END AS title FROM h"""))
def company_title_split(spark, sf):
    rows = _roles(spark, sf)
    headline = F.when(F.col("doc_id") % 3 == 0, F.col("title")).otherwise(
        F.concat("company", F.lit(": "), "title", F.lit(": Lead")))
    return rows.select("doc_id", labels.company_of(headline).alias("company"), labels.title_of(headline).alias("title"))


@query("company_from_slug", """
    SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Wildlife Studios' WHEN doc_id % 4 = 1 THEN 'Open-Ai' || doc_id % 10
      ELSE UPPER(source[1]) || source[2:] END AS company FROM documents""")
def company_from_slug(spark, sf):
    n = F.col("doc_id") % 4
    slug = F.when(n == 0, "wildlifestudios").when(n == 1, F.concat(F.lit("open-ai"), F.col("doc_id") % 10)).otherwise(F.col("source"))
    return table(spark, sf, "documents").select("doc_id", labels.company_from_slug(slug).alias("company"))


def _duck_key(expr: str) -> str:
    bounded = _quoted(keys.STOP_WORDS.removeprefix("(?i)"))
    return (f"TRIM(REGEXP_REPLACE(REGEXP_REPLACE({_duck_fold(expr)}, {bounded}, ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))")


@query("job_dedupe_key", oracle("f2_roles", sql=f"""
    SELECT doc_id, {_duck_key('title')} || '|' || {_duck_key('company')} AS dedupe_key FROM f2_roles"""))
def job_dedupe_key(spark, sf):
    return _roles(spark, sf).select("doc_id", keys.job_dedupe_key(F.col("title"), F.col("company")).alias("dedupe_key"))


@query("job_uid", """
    SELECT doc_id, source || ':' || CASE WHEN doc_id % 3 = 0 THEN 'http://x/' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS job_uid
    FROM documents""")
def job_uid(spark, sf):
    n = F.col("doc_id")
    native = F.when(n % 3 == 0, "").otherwise(n.cast("string"))
    uid = keys.job_uid(F.col("source"), native, F.concat(F.lit("http://x/"), n))
    return table(spark, sf, "documents").select("doc_id", uid.alias("job_uid"))


def _bounded(pattern: str) -> str:
    """Each alternative's leading or trailing \\b as a Unicode class."""
    import re

    parts = []
    for alt in re.split(r"\|(?![^(]*\))", pattern):
        starts, ends = alt.startswith(r"\b"), alt.endswith(r"\b")
        core = alt[2 if starts else 0: -2 if ends else None]
        core = core.replace(r"\b", _E)  # an inner boundary before `\s*$`
        parts.append((_B if starts else "") + core + (_E if ends else ""))
    return "|".join(parts)


def _duck_match(expr: str, pattern: str) -> str:
    return f"REGEXP_MATCHES({expr}, {_quoted('(?i)' + _bounded(pattern))})"


_SENIORITY = "CASE " + " ".join(
    f"WHEN {_duck_match('padded', p)} THEN '{n}'" for n, p in reversed(taxonomy.SENIORITY_PATTERNS)
) + " ELSE 'n/a' END"


@query("seniority", oracle("f2_roles", r="SELECT *, ' ' || LOWER(title) || ' ' AS padded FROM f2_roles", sql=f"""
    SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN 'mid-level' WHEN 1 THEN 'lead/management' ELSE {_SENIORITY} END AS seniority FROM r"""))
def seniority(spark, sf):
    hints = F.array_compact(F.array("level_hint"))
    return _roles(spark, sf).select("doc_id", taxonomy.seniority(F.col("title"), hints).alias("seniority"))


def _duck_area(keywords: dict, title: str, lead: str | None) -> str:
    """Scores as a list of (score, order, area); the best, earliest on ties."""
    entries = []
    for i, (name, patterns) in enumerate(keywords.items()):
        hits = [f"3 * CAST({_duck_match(title, p)} AS INTEGER)" for p in patterns]
        if lead:
            hits += [f"CAST({_duck_match(lead, p)} AS INTEGER)" for p in patterns]
        entries.append(f"{{'s': {' + '.join(hits)}, 'o': {-i}, 'a': '{name}'}}")
    return f"LIST_MAX([{', '.join(entries)}])"


_AREA_ROWS = f"""SELECT doc_id, category_hint, {_duck_area(taxonomy.AREA_KEYWORDS, 'padded', 'lead')} AS best FROM (
    SELECT *, ' ' || title || ' ' AS padded, text AS lead FROM f2_roles)"""


@query("area", oracle("f2_roles", b=_AREA_ROWS, sql="""
    SELECT doc_id, CASE WHEN category_hint = 'DevOps and Sysadmin' THEN 'software engineering' WHEN category_hint = 'Business' THEN 'other'
      WHEN best.s >= 3 THEN best.a ELSE 'other' END AS area FROM b"""))
def area(spark, sf):
    hints = F.array_compact(F.array("category_hint"))
    return _roles(spark, sf).select("doc_id", taxonomy.area(F.col("title"), F.col("text"), hints).alias("area"))


_GOODS = {"hardware": ("bolt", "gear", "rod", "plate"), "toy": ("gizmo", "widget"), "jewel": ("ring",)}


@query("area_custom", oracle("f7_products", sql=f"""
    SELECT product_id, CASE WHEN best.s >= 3 THEN best.a ELSE 'other' END AS area FROM (
      SELECT product_id, {_duck_area(_GOODS, 'name', None)} AS best FROM f7_products)"""))
def area_custom(spark, sf):
    return view(spark, sf, "f7_products").select("product_id", taxonomy.area(F.col("name"), keywords=_GOODS).alias("area"))


@query("classify_job", oracle("f2_roles", b=_AREA_ROWS, r="SELECT *, ' ' || LOWER(title) || ' ' AS padded FROM f2_roles", sql=f"""
    SELECT CASE WHEN b.category_hint = 'DevOps and Sysadmin' THEN 'software engineering' WHEN b.category_hint = 'Business' THEN 'other'
        WHEN best.s >= 3 THEN best.a ELSE 'other' END AS area,
      CASE r.doc_id % 9 WHEN 0 THEN 'mid-level' WHEN 1 THEN 'lead/management' ELSE {_SENIORITY} END AS seniority,
      CAST(COUNT(*) AS BIGINT) AS n_rows FROM r JOIN b ON b.doc_id = r.doc_id GROUP BY 1, 2"""))
def classify_job(spark, sf):
    rows = _roles(spark, sf).withColumns({
        "description": F.col("text"), "categories": F.array_compact(F.array("category_hint")),
        "levels": F.array_compact(F.array("level_hint"))})
    return postings.classify_job(rows).groupBy("area", "seniority").agg(F.count("*").alias("n_rows"))


@query("cap_per_company", oracle("f2_postings", sql="""
    SELECT doc_id, company FROM f2_postings QUALIFY ROW_NUMBER() OVER (PARTITION BY company ORDER BY doc_id) <= 20"""))
def cap_per_company(spark, sf):
    rows = view(spark, sf, "f2_postings").select("doc_id", "company")
    return ordering.cap_per_key(rows, ["company"], "doc_id", 20)


@query("dedupe_within_run", oracle("f2_postings", sql="""
    SELECT doc_id, title FROM f2_postings QUALIFY ROW_NUMBER() OVER (PARTITION BY title ORDER BY doc_id) = 1"""))
def dedupe_within_run(spark, sf):
    return ordering.first_per_key(view(spark, sf, "f2_postings").select("doc_id", "title"), ["title"], "doc_id")


@query("union_sources", """
    SELECT 'documents' AS source, doc_id AS native_id, text AS title, lang FROM documents
    UNION ALL SELECT 'benchmark', item_id, text, NULL FROM benchmark""")
def union_sources(spark, sf):
    docs = table(spark, sf, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("native_id"), F.col("text").alias("title"), "lang")
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("native_id"), F.col("text").alias("title"), F.lit("benchmark").alias("source"))
    return postings.union_sources([docs, items])


# -- property texts --------------------------------------------------------------------------

def _texts(spark, sf):
    return view(spark, sf, "f5_texts")


_PTYPE = "CASE " + " ".join(
    f"WHEN {_duck_match('folded', p)} THEN '{n}'" for n, p in taxonomy.PROPERTY_PATTERNS
) + """ WHEN UPPER(unit_type) IN ('ALLOTMENT_LAND', 'RESIDENTIAL_ALLOTMENT_LAND') THEN 'Terreno'
    WHEN UPPER(unit_type) = 'HOME' THEN 'Casa com terreno' ELSE 'Chácara' END"""


@query("property_type", oracle("f5_texts", sql=f"""
    SELECT doc_id, {_PTYPE} AS property_type FROM (SELECT *, {_duck_fold('title')} AS folded FROM f5_texts)"""))
def property_type(spark, sf):
    return _texts(spark, sf).select("doc_id", taxonomy.property_type(F.col("title"), F.col("unit_type")).alias("property_type"))


def _duck_feature(label: str) -> str:
    codes = ", ".join(f"'{c}'" for c, n in taxonomy.AMENITY_LABELS.items() if n == label)
    tests = [f"COALESCE(UPPER(amenity_1) IN ({codes}), FALSE) OR COALESCE(UPPER(amenity_2) IN ({codes}), FALSE)"] if codes else []
    if label in taxonomy.FEATURE_PATTERNS:
        tests.append(_duck_match("folded", taxonomy.FEATURE_PATTERNS[label]))
    return f"CASE WHEN {' OR '.join(tests)} THEN '{label}' END"


@query("features", oracle("f5_texts", sql=f"""
    SELECT doc_id, CONCAT_WS('|', {', '.join(_duck_feature(f) for f in taxonomy.FEATURE_ORDER)}) AS features FROM (
      SELECT *, {_duck_fold('title')} || ' ' || {_duck_fold('description')} AS folded FROM f5_texts)"""))
def features(spark, sf):
    amenities = F.array_compact(F.array("amenity_1", "amenity_2"))
    found = taxonomy.features(F.col("title"), F.col("description"), amenities)
    return _texts(spark, sf).select("doc_id", F.array_join(found, "|").alias("features"))


# -- leads -----------------------------------------------------------------------------------

_SCORE = """(CASE WHEN has_website THEN 30 ELSE 0 END + CASE WHEN has_phone THEN 25 ELSE 0 END
    + CASE WHEN rating >= 4.0 THEN 30 ELSE 0 END + CASE WHEN reviews >= 50 THEN 15 ELSE 0 END)"""


@query("digital_score", oracle("f8_leads", sql=f"SELECT business_id, CAST({_SCORE} AS INTEGER) AS digital_score FROM f8_leads"))
def digital_score(spark, sf):
    return leads.score_leads(view(spark, sf, "f8_leads")).select("business_id", "digital_score")


@query("digital_tier", oracle("f8_leads", sql=f"""
    SELECT CASE WHEN s >= 71 THEN 'benchmark' WHEN s >= 41 THEN 'established' ELSE 'hot lead' END AS digital_tier,
      CAST(COUNT(*) AS BIGINT) AS businesses FROM (SELECT {_SCORE} AS s FROM f8_leads) GROUP BY 1"""))
def digital_tier(spark, sf):
    scored = leads.score_leads(view(spark, sf, "f8_leads"))
    return scored.groupBy("digital_tier").agg(F.count("*").alias("businesses"))


_SITES = """
    SELECT page_id, CASE WHEN page_id % 6 = 5 THEN '' ELSE url END AS url, CASE WHEN page_id % 7 = 6 THEN NULL ELSE html || CASE page_id % 5
      WHEN 0 THEN '<script src="https://www.googletagmanager.com/gtm.js?id=GTM-X"></script><script>fbq("init", "1")</script>'
      WHEN 1 THEN '<script async src="https://www.googletagmanager.com/gtag/js?id=AW-1"></script><p>Hotjar</p>'
      WHEN 2 THEN '<script src="https://static.hotjar.com/c/hotjar-1.js"></script><i src="https://www.clarity.ms/tag/x">'
      WHEN 3 THEN '<p>Google Analytics and TikTok Pixel</p>' ELSE '' END END AS html FROM pages"""


@query("pixel_detect", oracle(s=_SITES, sql="""
    SELECT page_id, pixels, CASE WHEN url = '' THEN 'sem site' WHEN html IS NULL THEN 'erro' WHEN pixels <> '' THEN 'sim' ELSE 'não' END AS has_pixel
    FROM (SELECT *, CASE WHEN html IS NULL THEN '' ELSE CASE page_id % 5 WHEN 0 THEN 'Meta Pixel;Google Tag Manager' WHEN 1 THEN 'Google Ads'
      WHEN 2 THEN 'Hotjar;Microsoft Clarity' ELSE '' END END AS pixels FROM s)"""))
def pixel_detect(spark, sf):
    table(spark, sf, "pages").createOrReplaceTempView("pages")
    sites = spark.sql(_SITES)
    return leads.pixel_detect(sites, "url", "html").select("page_id", "pixels", "has_pixel")


@query("pixel_detect_custom", "SELECT page_id, 'Page track' AS pixels FROM pages WHERE CONTAINS(html, 'track(')")
def pixel_detect_custom(spark, sf):
    found = leads.pixel_detect(table(spark, sf, "pages"), "url", "html", {"Page track": r"\btrack\(", "Beacon": "sendBeacon"})
    return found.where(F.col("has_pixel") == leads.HAS_PIXEL).select("page_id", "pixels")


# -- checks on texts -------------------------------------------------------------------------

@query("dq_url_form", r"""
    SELECT 'url_form' AS "check", n = 0 AS ok, CAST(n AS BIGINT) AS n_bad FROM (
      SELECT COUNT(*) FILTER (WHERE NOT REGEXP_FULL_MATCH(url, 'https?://[a-z.]+/[a-z]+/\d+')) AS n FROM pages)""")
def dq_url_form(spark, sf):
    return quality.dq_url_form(table(spark, sf, "pages"), "url", r"\Ahttps?://[a-z.]+/[a-z]+/\d+\z")


# look-around spelled as a neighbour that is no digit: the same texts match
_SHAPE = r"(?:^|\P{Nd})(?:\(?\p{Nd}{2}\)?[\s\p{Z}.-]*)?9?[\s\p{Z}.-]?\p{Nd}{4}[\s\p{Z}.-]?\p{Nd}{4}(?:$|\P{Nd})"
_LEAKS = " OR ".join(
    f"REGEXP_MATCHES({c}, {_quoted(_SHAPE)}) OR CONTAINS(LOWER({c}), 'whatsapp')" for c in ("title", "company", "description"))


@query("dq_pii", oracle("f2_postings", sql=f"""
    SELECT 'pii' AS "check", n = 0 AS ok, CAST(n AS BIGINT) AS n_bad FROM (
      SELECT COUNT(*) FILTER (WHERE {_LEAKS}) AS n FROM f2_postings)"""))
def dq_pii(spark, sf):
    rows = view(spark, sf, "f2_postings").select("title", "company", "description")
    return quality.dq_pii(rows, ["title", "company", "description"])


@query("dq_no_description", oracle("f2_postings", sql="""
    SELECT 'no_description' AS "check", n = 0 AS ok, CAST(n AS BIGINT) AS n_bad FROM (
      SELECT COUNT(*) FILTER (WHERE doc_id % 53 = 0 AND description IS NOT NULL) AS n FROM f2_postings)"""))
def dq_no_description(spark, sf):
    kept = F.when(F.col("doc_id") % 53 == 0, F.col("description")).alias("description")  # to_json leaves NULLs out
    body = F.to_json(F.struct("job_uid", "title", "company", kept)).alias("body")
    return quality.dq_no_description(view(spark, sf, "f2_postings").select(body), "body")
