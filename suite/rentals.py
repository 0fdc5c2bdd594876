"""Listing queries: duplicates, distances, centroids, copies, buckets, snapshot, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import half_up, oracle, query, view
from tidemark.functions import geo as points
from tidemark.functions import scores
from tidemark.functions.keys import listing_dedupe_key, listing_uid
from tidemark.operators import document, geo, listings, quality, snapshot
from tidemark.session import settle

TODAY = "2024-01-30"

# -- DuckDB twins of the derived tables ------------------------------------------------------

_MERGED = """
    SELECT * EXCLUDE (rn, portal), portals FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY source, native_id ORDER BY n_photos DESC, ord) AS rn FROM f5_listings)
    JOIN (SELECT native_id AS nid, STRING_AGG(DISTINCT portal, ' · ' ORDER BY portal) AS portals
          FROM f5_listings GROUP BY 1) ON nid = native_id
    WHERE rn = 1"""
_CENTROIDS = """
    SELECT LOWER(TRIM(city)) AS city_key, LOWER(TRIM(state)) AS state_key, MEDIAN(lat) AS lat, MEDIAN(lon) AS lon
    FROM merged WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0) GROUP BY 1, 2"""
_KM = """12742.0 * ASIN(SQRT(POW(SIN(RADIANS({lat} + 22.9099) / 2), 2)
    + COS(RADIANS(-22.9099)) * COS(RADIANS({lat})) * POW(SIN(RADIANS({lon} + 47.0626) / 2), 2)))"""
_LOCATED = f"""
    SELECT *, {_KM.format(lat='lat', lon='lon')} AS km FROM (
      SELECT m.* EXCLUDE (lat, lon), IF(bad, c.lat, m.lat) AS lat, IF(bad, c.lon, m.lon) AS lon,
        CASE WHEN bad AND c.lat IS NOT NULL THEN 1 ELSE 0 END AS geo_approx
      FROM (SELECT *, lat IS NULL OR (lat = 0 AND lon = 0) AS bad FROM merged) m
      LEFT JOIN centroids c ON c.city_key = LOWER(m.city) AND c.state_key = LOWER(m.state))"""
_RESOLVED = f"""
    SELECT *, {half_up('km', 1)} AS distance_km,
      CASE WHEN km <= 25 THEN 'até 25 km' WHEN km <= 50 THEN '25–50 km' WHEN km <= 100 THEN '50–100 km'
           WHEN km <= 150 THEN '100–150 km' ELSE '150–200 km' END AS distance_band,
      CASE WHEN geo_approx = 1 THEN '' ELSE {half_up('lat', 3)} || ',' || {half_up('lon', 3)} || '|' ||
           COALESCE(total_area, 0) // 1000 || '|' || COALESCE(rent, 0) // 1000 END AS dedupe_key,
      CASE WHEN rent BETWEEN 6000 AND 14000 AND total_area >= 4000 THEN 1 ELSE 0 END AS is_match,
      CASE WHEN total_area >= 100 AND rent <> 0 THEN {half_up('rent / total_area', 3)} END AS price_per_m2
    FROM located WHERE km <= 200"""
_TWINS = {"merged": _MERGED, "centroids": _CENTROIDS, "located": _LOCATED, "resolved": _RESOLVED}


def _duck(sql: str, upto: str = "resolved", **extra: str) -> str:
    names = list(_TWINS)
    return oracle("f5_listings", sql=sql, **{n: _TWINS[n] for n in names[: names.index(upto) + 1]}, **extra)


def _raw(spark, sf):
    return view(spark, sf, "f5_listings")


def _merged(spark, sf):
    rows = _raw(spark, sf).withColumn("portals", F.array("portal")).drop("portal")
    return listings.merge_duplicates(rows, ["source", "native_id"], "portals", F.col("n_photos"), "ord")


def _located(spark, sf):
    merged = settle(_merged(spark, sf))  # the centroids and the rows both read it
    return geo.locate(merged, geo.city_centroids(merged))


def _resolved(spark, sf):
    rows = geo.resolve(settle(_merged(spark, sf)))
    return listings.with_identity(rows).withColumns({
        "is_match": scores.is_match(F.col("rent"), F.col("total_area")),
        "price_per_m2": scores.price_per_m2(F.col("rent"), F.col("total_area")),
    })


# -- duplicates and arrival order ------------------------------------------------------------

@query("merge_duplicates", _duck("""
    SELECT native_id, ord, rent, n_photos, portals FROM merged""", "merged"))
def merge_duplicates(spark, sf):
    return _merged(spark, sf).select(
        "native_id", "ord", "rent", "n_photos", F.array_join("portals", " · ").alias("portals"))


@query("union_portals", _duck("""
    SELECT portals, CAST(COUNT(*) AS BIGINT) AS n_rows FROM merged GROUP BY 1""", "merged"))
def union_portals(spark, sf):
    return _merged(spark, sf).groupBy(F.array_join("portals", " · ").alias("portals")).agg(
        F.count("*").alias("n_rows"))


@query("rent_stats", oracle("f5_listings", sql="""
    SELECT CAST(LIST_SORT(LIST(rent))[COUNT(*) // 2 + 1] AS INTEGER) AS median, MIN(rent) AS lowest, MAX(rent) AS highest
    FROM f5_listings WHERE rent <> 0"""))
def rent_stats(spark, sf):
    return listings.rent_stats(_raw(spark, sf))


# -- distances -------------------------------------------------------------------------------

@query("haversine_km", oracle("f5_listings", sql=f"""
    SELECT ord, ROUND({_KM.format(lat='lat', lon='lon')}, 6) AS km FROM f5_listings"""))
def haversine_km(spark, sf):
    km = points.haversine_km(F.lit(points.ORIGIN[0]), F.lit(points.ORIGIN[1]), F.col("lat"), F.col("lon"))
    return _raw(spark, sf).select("ord", F.round(km, 6).alias("km"))


@query("distance_valid", oracle("f5_listings", sql="""
    SELECT ord, lat IS NOT NULL AND lon IS NOT NULL AND NOT (lat = 0 AND lon = 0)
      AND ABS(lat) <= 90 AND ABS(lon) <= 180 AS usable FROM f5_listings"""))
def distance_valid(spark, sf):
    return _raw(spark, sf).select("ord", points.usable_point(F.col("lat"), F.col("lon")).alias("usable"))


@query("distance_band", _duck("""
    SELECT native_id, CASE WHEN km IS NULL OR km > 200 THEN '' WHEN km > 150 THEN '150–200 km'
      WHEN km > 100 THEN '100–150 km' WHEN km > 50 THEN '50–100 km' WHEN km > 25 THEN '25–50 km'
      ELSE 'até 25 km' END AS band FROM located""", "located"))
def distance_band(spark, sf):
    return _located(spark, sf).select("native_id", points.distance_band(F.col("km")).alias("band"))


@query("city_centroids", _duck("""
    SELECT city_key, state_key, ROUND(lat, 9) AS lat, ROUND(lon, 9) AS lon FROM centroids""", "centroids"))
def city_centroids(spark, sf):
    return geo.city_centroids(_merged(spark, sf)).select(
        "city_key", "state_key", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@query("centroid_fill", _duck("""
    SELECT native_id, geo_approx, ROUND(lat, 6) AS lat, ROUND(lon, 6) AS lon, ROUND(km, 6) AS km FROM located""", "located"))
def centroid_fill(spark, sf):
    return _located(spark, sf).select(
        "native_id", "geo_approx", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "km")])


@query("upsert_centroids", _duck("""
    SELECT COALESCE(c.city_key, s.city_key) AS city_key, COALESCE(c.state_key, s.state_key) AS state_key,
      ROUND(COALESCE(c.lat, s.lat), 9) AS lat, ROUND(COALESCE(c.lon, s.lon), 9) AS lon
    FROM (SELECT LOWER(city) AS city_key, LOWER(state) AS state_key, MIN(ord * 0.001) AS lat, MAX(ord * 0.001) AS lon
          FROM f5_listings GROUP BY 1, 2 UNION ALL SELECT 'elsewhere', 'nowhere', 1.0, 2.0) s
    FULL JOIN centroids c ON c.city_key = s.city_key AND c.state_key = s.state_key""", "centroids"))
def upsert_centroids(spark, sf):
    stored = geo.with_place(_raw(spark, sf)).groupBy(*geo.PLACE).agg(
        F.min(F.col("ord") * 0.001).alias("lat"), F.max(F.col("ord") * 0.001).alias("lon"))
    extra = spark.createDataFrame([("elsewhere", "nowhere", 1.0, 2.0)], stored.schema)
    merged = geo.upsert_centroids(stored.unionByName(extra), geo.city_centroids(_merged(spark, sf)))
    return merged.select("city_key", "state_key", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@query("geo_stats", _duck("""
    SELECT CAST(SUM(geo_approx) AS BIGINT) AS no_geo_resolved,
      CAST(COUNT(*) FILTER (WHERE km IS NULL) AS BIGINT) AS dropped_no_geo,
      CAST(COUNT(*) FILTER (WHERE km > 200) AS BIGINT) AS dropped_far FROM located""", "located"))
def geo_stats(spark, sf):
    return geo.geo_stats(_located(spark, sf))


@query("geo_resolve", _duck("""
    SELECT native_id, distance_km, distance_band, geo_approx FROM resolved"""))
def geo_resolve(spark, sf):
    return _resolved(spark, sf).select("native_id", "distance_km", "distance_band", "geo_approx")


# -- scores, keys, copies --------------------------------------------------------------------

@query("is_match", _duck("SELECT native_id, is_match FROM resolved"))
def is_match(spark, sf):
    return _resolved(spark, sf).select("native_id", "is_match")


@query("match_count", _duck("SELECT CAST(SUM(is_match) AS BIGINT) AS matches FROM resolved"))
def match_count(spark, sf):
    return listings.match_count(_resolved(spark, sf))


@query("price_per_m2", oracle("f5_listings", sql=f"""
    SELECT ord, CASE WHEN total_area >= 100 AND rent <> 0 THEN {half_up('rent / total_area', 3)} END AS price_per_m2
    FROM f5_listings"""))
def price_per_m2(spark, sf):
    return _raw(spark, sf).select("ord", scores.price_per_m2(F.col("rent"), F.col("total_area")).alias("price_per_m2"))


@query("listing_uid", oracle("f5_listings", sql="SELECT ord, source || ':' || native_id AS listing_uid FROM f5_listings"))
def listing_uids(spark, sf):
    return _raw(spark, sf).select("ord", listing_uid(F.col("source"), F.col("native_id")).alias("listing_uid"))


@query("listing_dedupe_key", oracle("f5_listings", sql=f"""
    SELECT ord, CASE WHEN lat IS NULL OR lon IS NULL OR ord % 5 = 0 THEN '' ELSE
      {half_up('lat', 3)} || ',' || {half_up('lon', 3)} || '|' || COALESCE(total_area, 0) // 1000 || '|' ||
      COALESCE(rent, 0) // 1000 END AS dedupe_key FROM f5_listings"""))
def dedupe_key(spark, sf):
    approx = (F.col("ord") % 5 == 0).cast("int")
    key = listing_dedupe_key(F.col("lat"), F.col("lon"), F.col("total_area"), F.col("rent"), approx)
    return _raw(spark, sf).select("ord", key.alias("dedupe_key"))


@query("cluster_count", _duck("""
    SELECT dedupe_key, CAST(COUNT(*) AS BIGINT) AS n_ads FROM resolved WHERE dedupe_key <> '' GROUP BY 1"""))
def cluster_count(spark, sf):
    return listings.cluster_count(_resolved(spark, sf))


@query("attach_cluster_count", _duck("""
    SELECT native_id, CAST(CASE WHEN dedupe_key = '' THEN 1
      ELSE COUNT(*) OVER (PARTITION BY dedupe_key) END AS BIGINT) AS n_ads FROM resolved"""))
def attach_cluster_count(spark, sf):
    return listings.attach_cluster_count(_resolved(spark, sf)).select("native_id", "n_ads")


# -- buckets and domain ----------------------------------------------------------------------

def _cases(column, buckets, closed):
    out = []
    for low, high in buckets:
        upper = "" if high is None else f" AND {column} {'<=' if closed else '<'} {high}"
        out.append((low, f"COUNT(*) FILTER (WHERE {column} >= {low}{upper})"))
    return out


_BUCKETS = " UNION ALL ".join(
    f"""SELECT '{f}' AS "filter", CAST({low} AS INTEGER) AS low, CAST({n} AS BIGINT) AS n_rows FROM f5_listings"""
    for f, c, b, closed in (("rent", "rent", listings.RENT_BUCKETS, False),
                            ("land", "total_area", listings.LAND_BUCKETS, False),
                            ("bedrooms", "bedrooms", listings.BEDROOM_BUCKETS, True))
    for low, n in _cases(c, b, closed))


@query("numeric_buckets", oracle("f5_listings", sql=_BUCKETS))
def numeric_buckets(spark, sf):
    return listings.numeric_buckets(_raw(spark, sf))


_DOMAIN = "rent <> 0 AND rent <= 30000 AND total_area BETWEEN 3000 AND 100000"


@query("cheaper_with_more_land", oracle("f5_listings", sql=f"""
    SELECT CAST(COUNT(*) FILTER (WHERE rent < 10000 AND total_area >= 6000) AS BIGINT) AS cheaper,
      CAST(COUNT(*) AS BIGINT) AS plotted FROM f5_listings WHERE {_DOMAIN}"""))
def cheaper_with_more_land(spark, sf):
    return listings.cheaper_with_more_land(_raw(spark, sf))


# -- snapshot --------------------------------------------------------------------------------

def _base(spark, sf):
    """Resolved listings in the shape of the listings base, with dates and texts by key.

    Settled, as the base is a stored table in a run.
    """
    rows = settle(_resolved(spark, sf))
    n = F.col("native_id")
    first = F.date_add(F.lit("2024-01-01").cast("date"), (n % 30).cast("int"))
    amenities = F.array_compact(F.array(
        F.when(n % 2 == 0, "Piscina"), F.when(n % 3 == 0, "Pomar"), F.when(n % 5 == 0, "Lareira")))
    blank = F.lit(None).cast("int")
    return rows.select(
        listing_uid(F.col("source"), n).alias("listing_uid"), F.concat(F.lit("Casa "), n).alias("title"),
        F.concat(F.lit("https://www.vivareal.com.br/imovel/id-"), n, F.lit("/")).alias("url"),
        F.when(n % 4 == 0, "Sítio").otherwise("Chácara").alias("property_type"), "city", "state", "lat", "lon",
        "distance_km", "distance_band", "geo_approx", "rent", blank.alias("condo_fee"), "total_area",
        blank.alias("usable_area"), "price_per_m2", "bedrooms", blank.alias("suites"), blank.alias("bathrooms"),
        blank.alias("parking"), amenities.alias("features"), F.array(F.concat(F.lit("p"), n)).alias("photos"),
        F.concat(F.lit("Agency "), n % 7).alias("advertiser"), "is_match", "portals",
        first.alias("published_date"), first.alias("first_seen_date"),
        F.date_add(first, (n % 15).cast("int")).alias("last_seen_date"), "dedupe_key")


def _rents(base):
    step = (F.length("title") % 3 - 1) * 500
    opened = base.select("listing_uid", F.col("first_seen_date").alias("date"), (F.col("rent") + step).alias("rent"))
    return opened.unionByName(base.select("listing_uid", F.date_add("last_seen_date", 1).alias("date"), "rent"))


_BASE = """
    SELECT *, source || ':' || native_id AS uid, 'Casa ' || native_id AS title, 'Agency ' || native_id % 7 AS advertiser,
      CASE WHEN native_id % 4 = 0 THEN 'Sítio' ELSE 'Chácara' END AS property_type,
      DATE '2024-01-01' + CAST(native_id % 30 AS INTEGER) AS seen FROM resolved
    WHERE DATE '2024-01-01' + CAST(native_id % 30 + native_id % 15 AS INTEGER) >= DATE '2024-01-20'"""
_PLACED = """
    SELECT *, ROW_NUMBER() OVER (ORDER BY seen DESC, rent ASC NULLS FIRST, uid) - 1 AS position,
      CASE WHEN dedupe_key = '' THEN 1 ELSE COUNT(*) OVER (PARTITION BY dedupe_key) END AS nads,
      CAST(rent + (LENGTH(title) % 3 - 1) * 500 AS INTEGER) AS opened FROM base"""
_LISTING_CODES = " UNION ALL ".join(
    f"""SELECT '{c}' AS col, {c} AS value, CAST(ROW_NUMBER() OVER (ORDER BY MIN(position)) - 1 AS INTEGER) AS code
        FROM placed GROUP BY {c}""" for c in snapshot.LISTING_CODES)
_FEATURES = """
    SELECT position, i, f FROM (SELECT position, UNNEST([1, 2, 3]) AS i,
      UNNEST([IF(native_id % 2 = 0, 'Piscina', NULL), IF(native_id % 3 = 0, 'Pomar', NULL),
              IF(native_id % 5 = 0, 'Lareira', NULL)]) AS f FROM placed) WHERE f IS NOT NULL"""
_FEATURE_CODES = """
    SELECT f, CAST(ROW_NUMBER() OVER (ORDER BY MIN((position, i))) - 1 AS INTEGER) AS code FROM feats GROUP BY f"""


_SHOT_TWINS = {"base": _BASE, "placed": _PLACED, "codes": _LISTING_CODES, "feats": _FEATURES, "fcodes": _FEATURE_CODES}


@query("snapshot_listings", _duck("""
    SELECT CAST(p.position AS BIGINT) AS position, uid, title, CAST(nads AS BIGINT) AS nads, rent, distance_km AS km,
      total_area AS land, price_per_m2 AS ppm, is_match AS "match", geo_approx AS approx, CAST(seen AS VARCHAR) AS seen,
      CASE WHEN opened <> 0 AND rent <> 0 AND opened <> rent THEN opened END AS rent0,
      (SELECT COALESCE(STRING_AGG(CAST(fc.code AS VARCHAR), ',' ORDER BY i), '') FROM feats x JOIN fcodes fc ON fc.f = x.f
       WHERE x.position = p.position) AS feat, """ + ", ".join(
    f"(SELECT code FROM codes WHERE col = '{c}' AND value = p.{c}) AS {n}"
    for c, n in snapshot.LISTING_CODES.items()) + " FROM placed p",
    base=_BASE, placed=_PLACED, codes=_LISTING_CODES, feats=_FEATURES, fcodes=_FEATURE_CODES))
def snapshot_listings(spark, sf):
    rows = _shot(spark, sf).rows
    codes = F.array_join(F.col("feat").cast("array<string>"), ",").alias("feat")
    return rows.select("position", "uid", "title", "nads", "rent", "km", "land", "ppm", "match", "approx", "seen",
                       "rent0", codes, *snapshot.LISTING_CODES.values())


@query("dictionary_encode_array", _duck("""
    SELECT 'feature' AS "column", code, f AS value FROM fcodes""",
    base=_BASE, placed=_PLACED, feats=_FEATURES, fcodes=_FEATURE_CODES))
def dictionary_encode_array(spark, sf):
    return _shot(spark, sf).dictionary.where(F.col("column") == "feature")


# -- contract checks -------------------------------------------------------------------------

def _shot(spark, sf):
    base = _base(spark, sf)
    return snapshot.snapshot_listings(base, _rents(base), TODAY)


def _verdict(check: str, n_bad: str = "0", source: str = "") -> str:
    return (f"SELECT '{check}' AS \"check\", n_bad = 0 AS ok, CAST(n_bad AS BIGINT) AS n_bad "
            f"FROM (SELECT {n_bad} AS n_bad {source})")


def _cards(spark, sf):
    """Listings as JSON objects: a NULL leaves its key out, and one text in 31 is cut short."""
    body = F.to_json(F.struct(F.col("native_id").alias("uid"), "city", "lat", "lon", "rent", F.col("total_area").alias("land")))
    return _raw(spark, sf).select("ord", F.when(F.col("ord") % 31 == 0, F.substring(body, 1, 12)).otherwise(body).alias("body"))


@query("dq_columns", oracle("f5_listings", sql=_verdict("columns", "COUNT(*)", """
    FROM f5_listings WHERE ord % 31 = 0 OR lat IS NULL OR rent IS NULL OR total_area IS NULL""")))
def dq_columns(spark, sf):
    return quality.dq_columns(_cards(spark, sf), "body", ("uid", "city", "lat", "rent", "land"))


@query("key_census", oracle("f5_listings", sql=" UNION ALL ".join(
    f"""SELECT '{k}' AS key, CAST(COUNT(*) FILTER (WHERE {c} IS NOT NULL AND ord % 31 <> 0) AS BIGINT) AS n_rows FROM f5_listings"""
    for k, c in (("uid", "native_id"), ("city", "city"), ("lat", "lat"), ("lon", "lon"), ("rent", "rent"), ("land", "total_area")))))
def key_census(spark, sf):
    return quality.key_census(_cards(spark, sf), "body")


@query("dq_lengths", _duck(_verdict("lengths", "COUNT(DISTINCT position // 20)", "FROM placed WHERE (position // 20) % 2 = 0"),
       base=_BASE, placed=_PLACED))
def dq_lengths(spark, sf):
    rows = _shot(spark, sf).rows.select("position", "uid", "km", "rent", "rent0", "title")
    documents = snapshot.columnar_parts(rows, 20)  # one text of the whole table is an export, with a cap
    # every second part loses the first of its links: the check must notice each
    short = F.regexp_replace("document", r'"uid":\["[^"]*",?', '"uid":[')
    damaged = documents.select(F.when(F.col("part") % 2 == 0, short).otherwise(F.col("document")).alias("document"))
    return quality.dq_lengths(damaged, "document", ["uid", "km", "rent", "rent0", "title"])


@query("dq_code_range", _duck(_verdict("code_range", "COUNT(*)", "FROM placed WHERE city IN "
       "(SELECT value FROM codes WHERE col = 'city' AND code < 5)"),
       base=_BASE, placed=_PLACED, codes=_LISTING_CODES))
def dq_code_range(spark, sf):
    shot = _shot(spark, sf)  # a dictionary without its first five cities must be noticed
    short = shot.dictionary.where((F.col("column") != "city") | (F.col("code") >= 5))
    return quality.dq_code_range(shot.rows, short, snapshot.LISTING_CODES)


@query("dq_array_code_range", _duck(_verdict("array_code_range", "COUNT(*)", "FROM feats WHERE f = 'Pomar'"),
       base=_BASE, placed=_PLACED, feats=_FEATURES))
def dq_array_code_range(spark, sf):
    shot = _shot(spark, sf)  # each use of an entry that the dictionary lost must be noticed
    short = shot.dictionary.where((F.col("column") != "feature") | (F.col("value") != "Pomar"))
    return quality.dq_array_code_range(shot.rows, short, "feat", "feature")


@query("dq_rule_thresholds", oracle("f5_listings", sql=_verdict("rule_thresholds", "COUNT(*)", """
    FROM (SELECT city, COUNT(*) AS n FROM f5_listings GROUP BY city) WHERE n % 3 <> 0""")))
def dq_rule_thresholds(spark, sf):
    """One header a city: two cities in three serve a land threshold that is off, or no rule."""
    n = F.col("n")
    rule = F.struct(F.lit(6000).alias("rent_min"), F.lit(14000).alias("rent_max"), (F.lit(4000) + n % 3).alias("land_min"))
    header = F.to_json(F.struct("city", F.when(n % 3 != 2, rule).alias("match_rule")))
    cities = _raw(spark, sf).groupBy("city").agg(F.count("*").alias("n")).select(header.alias("header"))
    return quality.dq_rule_thresholds(cities, "header", document.MATCH_RULE)


@query("dq_rule_agreement", oracle("f5_listings", sql=_verdict("rule_agreement", "COUNT(*)", """
    FROM f5_listings WHERE (COALESCE(rent, 0) >= 7000)
      <> COALESCE(rent BETWEEN 6000 AND 14000 AND total_area >= 4000, FALSE)""")))
def dq_rule_agreement(spark, sf):
    flagged = _raw(spark, sf).withColumn("match", (F.coalesce("rent", F.lit(0)) >= 7000).cast("int"))
    return quality.dq_rule_agreement(flagged, "rent", "total_area", "match")


@query("dq_labels", _duck(_verdict("labels", "COUNT(DISTINCT distance_band)", """
    FROM resolved WHERE distance_band NOT IN ('até 25 km', '25–50 km')""")))
def dq_labels(spark, sf):
    bands = _resolved(spark, sf).select(F.lit("band").alias("column"), F.col("distance_band").alias("value")).distinct()
    return quality.dq_labels(bands, "band", ("até 25 km", "25–50 km"))


@query("dq_geo", _duck(_verdict("geo", "COUNT(*)", "FROM located WHERE km IS NULL OR km > 200"), "located"))
def dq_geo(spark, sf):
    return quality.dq_geo(_located(spark, sf))


@query("dq_domain_share", oracle("f5_listings", sql=f"""
    SELECT 'domain_share' AS "check", COUNT(*) FILTER (WHERE {_DOMAIN}) >= 0.6 * COUNT(*) AS ok,
      CAST(COUNT(*) - COUNT(*) FILTER (WHERE {_DOMAIN}) AS BIGINT) AS n_bad FROM f5_listings"""))
def dq_domain_share(spark, sf):
    return quality.dq_domain_share(_raw(spark, sf))


@query("dq_buckets", oracle("f5_listings", b=_BUCKETS, sql=_verdict("buckets", "COUNT(*)", "FROM b WHERE n_rows = 0")))
def dq_buckets(spark, sf):
    return quality.dq_buckets(_raw(spark, sf))


@query("missing_keys", oracle("f5_listings", sql="""
    SELECT * FROM (
      SELECT 'km' AS missing, CAST(COUNT(*) AS BIGINT) AS n_rows FROM f5_listings
      UNION ALL SELECT 'uid', COUNT(*) FILTER (WHERE ord % 31 = 0) FROM f5_listings
      UNION ALL SELECT 'rent', COUNT(*) FILTER (WHERE ord % 31 = 0 OR rent IS NULL) FROM f5_listings) WHERE n_rows > 0"""))
def missing_keys(spark, sf):
    return quality.missing_keys(_cards(spark, sf), "body", ("uid", "km", "rent"))


@query("missing_labels", _duck("""
    SELECT DISTINCT r_name AS distance_band FROM region
    UNION SELECT DISTINCT distance_band FROM resolved WHERE km <= 25
    EXCEPT SELECT distance_band FROM resolved"""))
def missing_labels(spark, sf):
    present = _resolved(spark, sf)
    near = present.where(F.col("distance_km") <= 25).select("distance_band")
    declared = spark.read.parquet(f"{sf}/region.parquet").select(F.col("r_name").alias("distance_band"))
    return quality.missing_labels(present, "distance_band", declared.unionByName(near))
