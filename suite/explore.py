"""Explorer queries: facets, tallies, cross-tabulation, timeline, sorting, paging, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import half_up, oracle, query, view
from suite.text import _duck_key
from tidemark.functions import keys
from tidemark.operators import explore, snapshot
from tidemark.operators.ordering import page_slice, with_position

GENERATED = "2001-08-01"      # for f9_facets
TODAY = "2024-05-03"          # for f2_postings
CHOSEN = {"source": ["1-URGENT", "2-HIGH"], "area": ["BUILDING"], "market": []}


def _facets(spark, sf):
    return view(spark, sf, "f9_facets")


def _postings(spark, sf):
    return view(spark, sf, "f2_postings")


@query("facet_filter", oracle("f9_facets", sql="""
    SELECT id, source, area FROM f9_facets WHERE source IN ('1-URGENT', '2-HIGH') AND area = 'BUILDING'"""))
def facet_filter(spark, sf):
    return explore.facet_filter(_facets(spark, sf), CHOSEN).select("id", "source", "area")


@query("recency_filter", oracle("f2_postings", sql="""
    SELECT job_uid FROM f2_postings
    WHERE COALESCE(published_date, first_seen_date) >= DATE '2024-05-03' - 30"""))
def recency_filter(spark, sf):
    rows = explore.recency_filter(_postings(spark, sf), TODAY, 30, "published_date", "first_seen_date")
    return rows.select("job_uid")


@query("search_text", oracle("f2_postings", sql="""
    SELECT job_uid, LOWER(title || ' ' || company) AS searchable FROM f2_postings"""))
def search_text(spark, sf):
    return _postings(spark, sf).select(
        "job_uid", explore.search_text(F.col("title"), F.col("company")).alias("searchable"))


@query("text_search", oracle("f2_postings", sql="""
    SELECT job_uid FROM f2_postings WHERE CONTAINS(LOWER(title || ' ' || company), 'company 1')"""))
def text_search(spark, sf):
    return explore.text_search(_postings(spark, sf), "  Company 1 ").select("job_uid")


@query("explorer_query", oracle("f9_facets", sql="""
    SELECT id FROM f9_facets WHERE source IN ('1-URGENT', '2-HIGH') AND area = 'BUILDING'
      AND pub >= DATE '2001-08-01' - 30 AND CONTAINS(LOWER(market || ' ' || company), '#0000')"""))
def explorer_query(spark, sf):
    return explore.explorer_query(
        _facets(spark, sf), GENERATED, CHOSEN, 30, "#0000", title="market").select("id")


@query("facet_counts", oracle("f9_facets", sql=" UNION ALL ".join(
    f"""SELECT '{f}' AS facet, {f} AS value, CAST(COUNT(*) AS BIGINT) AS n_rows,
        CASE WHEN {f} = '' THEN 'n/a' ELSE {f} END AS label FROM f9_facets GROUP BY {f}"""
    for f in ("source", "area", "seniority", "work_model", "market"))))
def facet_counts(spark, sf):
    return explore.facet_counts(_facets(spark, sf))


@query("tally_top_n", oracle("f9_facets", sql="""
    SELECT market AS label, CAST(COUNT(*) AS BIGINT) AS n_rows FROM f9_facets
    WHERE source IN ('1-URGENT', '2-HIGH') AND area = 'BUILDING' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 11"""))
def tally_top_n(spark, sf):
    return explore.tally_top_n(
        explore.facet_filter(_facets(spark, sf), CHOSEN), "market", explore.TOP_AREAS)


@query("top_companies", oracle("f9_facets", sql="""
    SELECT company AS label, CAST(COUNT(*) AS BIGINT) AS n_rows FROM f9_facets
    WHERE company <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""))
def top_companies(spark, sf):
    return explore.top_companies(_facets(spark, sf))


@query("crosstab_share", oracle("f9_facets", c="""
    SELECT source, area, CAST(COUNT(*) AS BIGINT) AS n_rows FROM f9_facets GROUP BY 1, 2""", sql=f"""
    SELECT c.source, c.area, c.n_rows, CAST(r.t AS BIGINT) AS row_total, CAST(k.t AS BIGINT) AS column_total,
      {half_up('c.n_rows / r.t', 6)} AS row_share, {half_up('c.n_rows / k.t', 6)} AS column_share
    FROM c JOIN (SELECT source, SUM(n_rows) AS t FROM c GROUP BY 1) r ON r.source = c.source
    JOIN (SELECT area, SUM(n_rows) AS t FROM c GROUP BY 1) k ON k.area = c.area"""))
def crosstab_share(spark, sf):
    table = explore.crosstab_share(_facets(spark, sf), "source", "area")
    return table.withColumns({c: F.round(c, 6) for c in ("row_share", "column_share")})


@query("timeline_daily", oracle("f2_postings", sql="""
    SELECT published_date AS day, CAST(COUNT(*) AS BIGINT) AS n_rows FROM f2_postings
    WHERE published_date BETWEEN DATE '2024-05-03' - 90 AND DATE '2024-05-03' GROUP BY 1"""))
def timeline_daily(spark, sf):
    return explore.timeline_daily(_postings(spark, sf), TODAY, published="published_date")


@query("kpi_totals", oracle("f9_facets", sql="""
    SELECT CAST(COUNT(*) AS BIGINT) AS total,
      CAST(COUNT(*) FILTER (WHERE pub = DATE '2001-08-01') AS BIGINT) AS today,
      CAST(COUNT(*) FILTER (WHERE pub >= DATE '2001-08-01' - 7) AS BIGINT) AS last_7_days,
      CAST(COUNT(DISTINCT source) AS BIGINT) AS portals, CAST(COUNT(DISTINCT company) AS BIGINT) AS companies,
      CAST(COUNT(DISTINCT area) AS BIGINT) AS areas FROM f9_facets"""))
def kpi_totals(spark, sf):
    return explore.kpi_totals(_facets(spark, sf), GENERATED)


_COUNTED = """SELECT *, 1 + doc_id % 4 AS n_portals, COALESCE(published_date, first_seen_date) AS dated FROM f2_postings"""


def _sorted(spark, sf, mode):
    rows = _postings(spark, sf).withColumn("n_portals", 1 + F.col("doc_id") % 4)
    order = explore.sort_order(mode, "job_uid", "published_date", "first_seen_date")
    return rows, order


@query("sort_modes", oracle("f2_postings", p=_COUNTED, sql=" UNION ALL ".join(
    f"SELECT '{m}' AS mode, job_uid, CAST(ROW_NUMBER() OVER (ORDER BY {o}, job_uid) - 1 AS BIGINT) AS position FROM p"
    for m, o in (("recent", "dated DESC"), ("oldest", "dated"), ("portals", "n_portals DESC, dated DESC"),
                 ("company", "LOWER(company), dated DESC")))))
def sort_modes(spark, sf):
    out = None
    for mode in ("recent", "oldest", "portals", "company"):
        rows, order = _sorted(spark, sf, mode)
        keyed = rows.select("job_uid", "company", "n_portals", "published_date", "first_seen_date")
        placed = with_position(keyed, order).select(F.lit(mode).alias("mode"), "job_uid", "position")
        out = placed if out is None else out.unionByName(placed)
    return out


@query("page_slice", oracle("f2_postings", p=_COUNTED, sql="""
    SELECT job_uid FROM p ORDER BY LOWER(company), dated DESC, job_uid LIMIT 40 OFFSET 80"""))
def page(spark, sf):
    rows, order = _sorted(spark, sf, "company")
    return page_slice(rows, order, 2, explore.PAGE_SIZE).select("job_uid")


# -- snapshot of postings --------------------------------------------------------------------

_FRESH = """SELECT *, GREATEST(COALESCE(published_date, first_seen_date), first_seen_date) AS fresh FROM f2_postings"""
_SERVED = """
    SELECT *, ROW_NUMBER() OVER (ORDER BY fresh DESC, job_uid) - 1 AS position FROM (
      SELECT * FROM fresh WHERE fresh >= DATE '2024-05-03' - 90)"""


@query("window_filter", oracle("f2_postings", fresh=_FRESH, sql="""
    SELECT job_uid FROM fresh WHERE fresh >= DATE '2024-05-03' - 90"""))
def window_filter(spark, sf):
    return snapshot.window_filter(_postings(spark, sf), TODAY).select("job_uid")


@query("snapshot_limit", oracle("f2_postings", fresh=_FRESH, sql="""
    SELECT job_uid, fresh FROM fresh ORDER BY fresh DESC, job_uid LIMIT 200"""))
def snapshot_limit(spark, sf):
    return snapshot.snapshot_limit(_postings(spark, sf), 200).select(
        "job_uid", snapshot.freshness().alias("fresh"))


@query("base_totals", oracle("f2_postings", fresh=_FRESH, sql="""
    SELECT CAST(COUNT(*) FILTER (WHERE fresh >= DATE '2024-05-03' - 90) AS BIGINT) AS total_window,
      CAST(COUNT(*) AS BIGINT) AS total_base FROM fresh"""))
def base_totals(spark, sf):
    return snapshot.base_totals(_postings(spark, sf), TODAY)


def _base(spark, sf):
    """f2_postings in the shape of the postings base."""
    return _postings(spark, sf).select(
        "job_uid", "source", "title", "company", F.concat(F.lit("area "), F.col("doc_id") % 5).alias("area"),
        F.when(F.col("doc_id") % 3 == 0, "senior").otherwise("").alias("seniority"),
        F.when(F.col("doc_id") % 4 == 0, None).otherwise("remote").alias("work_model"),
        F.lit("").alias("city"), F.col("market").alias("state"), F.upper("market").alias("country"), "market",
        F.when(F.col("doc_id") % 10 == 0, F.lit(0.0)).otherwise(F.col("doc_id") * 10.5).alias("salary_min"),
        F.lit(None).cast("double").alias("salary_max"), "published_date", "first_seen_date",
        F.concat(F.lit("https://example.com/"), F.col("doc_id")).alias("url"), F.lit("a · b").alias("skills"),
        keys.job_dedupe_key(F.col("title"), F.col("company")).alias("dedupe_key"))


_KEY = f"{_duck_key('title')} || '|' || {_duck_key('company')}"
_DUCK_BASE = """
    SELECT job_uid, source, title, company, 'area ' || doc_id % 5 AS area,
      CASE WHEN doc_id % 3 = 0 THEN 'senior' ELSE '' END AS seniority,
      CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'remote' END AS work_model, UPPER(market) AS country, market,
      CASE WHEN doc_id % 10 = 0 OR doc_id = 0 THEN NULL ELSE CAST(ROUND(doc_id * 10.5) AS BIGINT) END AS smin,
      published_date, first_seen_date, 'https://example.com/' || doc_id AS url, """ + _KEY + """ AS dk,
      position FROM served"""
_CODES = " UNION ALL ".join(
    f"""SELECT '{c}' AS col, {c} AS value, ROW_NUMBER() OVER (ORDER BY MIN(position)) - 1 AS code
        FROM b GROUP BY {c}""" for c in snapshot.POSTING_CODES)


_SHOT = """
    SELECT CAST(b.position AS BIGINT) AS position, title, market AS city,
      CAST(COALESCE(published_date, first_seen_date) AS VARCHAR) AS pub, CAST(first_seen_date AS VARCHAR) AS seen,
      url, CAST(np AS BIGINT) AS np, 'a · b' AS sk, smin, CAST(NULL AS BIGINT) AS smax, """ + ", ".join(
    f"CAST((SELECT code FROM codes WHERE col = '{c}' AND value = b.{c}) AS INTEGER) AS {n}"
    for c, n in snapshot.POSTING_CODES.items()) + """
    FROM b JOIN (SELECT dk, COUNT(DISTINCT source) AS np FROM b GROUP BY dk) p ON p.dk = b.dk"""
_BASE_TWINS = {"fresh": _FRESH, "served": _SERVED, "b": _DUCK_BASE, "codes": _CODES}


@query("snapshot_jobs", oracle("f2_postings", **_BASE_TWINS, sql=_SHOT))
def snapshot_jobs(spark, sf):
    return snapshot.snapshot_postings(_base(spark, sf), TODAY).rows


@query("portal_count", oracle("f2_postings", sql="""
    SELECT """ + _KEY + """ AS dedupe_key, CAST(COUNT(DISTINCT source) AS BIGINT) AS n_portals
    FROM f2_postings GROUP BY 1"""))
def portal_count(spark, sf):
    return snapshot.listings.portal_count(_base(spark, sf))


@query("attach_portal_count", oracle("f2_postings", fresh=_FRESH, served=_SERVED, b=_DUCK_BASE, sql="""
    SELECT job_uid, CAST((SELECT COUNT(DISTINCT source) FROM b x WHERE x.dk = b.dk) AS BIGINT) AS n_portals FROM b"""))
def attach_portal_count(spark, sf):
    return snapshot.serve_postings(_base(spark, sf), TODAY).select("job_uid", "n_portals")


_F9_DICT = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(ROW_NUMBER() OVER (ORDER BY MIN(id)) - 1 AS INTEGER) AS code, {c} AS value
        FROM f9_facets GROUP BY {c}""" for c in ("source", "area", "company"))


@query("dictionary_encode", oracle("f9_facets", d=_F9_DICT, sql="""
    SELECT f.id, s.code AS src, a.code AS area, c.code AS cmp FROM f9_facets f
    JOIN d s ON s."column" = 'source' AND s.value = f.source
    JOIN d a ON a."column" = 'area' AND a.value = f.area
    JOIN d c ON c."column" = 'company' AND c.value = f.company"""))
def dictionary_encode(spark, sf):
    rows = _facets(spark, sf).select("id", "source", "area", "company")
    return snapshot.dictionary_encode(rows, "id", {"source": "src", "area": "area", "company": "cmp"}).rows


@query("dictionary_values", oracle("f9_facets", sql=_F9_DICT))
def dictionary_values(spark, sf):
    rows = _facets(spark, sf).select("id", "source", "area", "company")
    return snapshot.dictionary_encode(rows, "id", {"source": "src", "area": "area", "company": "cmp"}).dictionary


@query("size_guard", oracle("f2_postings", sql="""
    SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
      CAST(STRLEN(CAST(TO_JSON({'job_uid': LIST(job_uid), 'company': LIST(company),
        'title': LIST(title), 'doc_id': LIST(doc_id)}) AS VARCHAR)) AS BIGINT) AS payload_bytes
    FROM f2_postings"""))
def size_guard(spark, sf):
    return snapshot.payload_bytes(_postings(spark, sf).select("job_uid", "company", "title", "doc_id"))


@query("run_report", oracle("f9_facets", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS report, {c} AS value, CAST(COUNT(*) AS BIGINT) AS n_rows FROM f9_facets GROUP BY {c}"""
    for c in ("source", "market", "area", "seniority"))))
def run_report(spark, sf):
    from tidemark.operators.postings import run_report as report

    return report(_facets(spark, sf), ["source", "market", "area", "seniority"])
