"""Served documents: every piece of the text, the manifest of a written one, and its rows read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import explore, rentals
from suite.registry import oracle, query
from tidemark.operators import document, quality, snapshot
from tidemark.session import scratch_path, settle

SIZE = 300  # values of a piece: several of them even on small tables


def _json(value: str) -> str:
    return f"COALESCE(CAST(TO_JSON({value}) AS VARCHAR), 'null')"


def _array(section: int, item: int, name: str, value: str, place: str, source: str) -> str:
    """The pieces of one array: its opening, its values in parts and its closing."""
    return f"""
    SELECT {section} AS section, {item} AS item, '{name}' AS name, CAST({place} // {SIZE} AS BIGINT) AS part, COUNT(*) AS n_values,
      CASE WHEN {place} // {SIZE} > 0 THEN ',' ELSE '' END || STRING_AGG({_json(value)}, ',' ORDER BY {place}) AS body
    FROM {source} GROUP BY {place} // {SIZE}"""


def _document(header: str, rows_key: str, entries: dict[str, str], columns: dict[str, str], dictionary: str, rows: str) -> str:
    """All pieces of a document; `entries` maps dictionary columns to served names, `columns` names to values."""
    parts = [f"SELECT 0 AS section, 0 AS item, '' AS name, CAST(0 AS BIGINT) AS part, 0 AS n_values, {header} AS body"]
    frame = []
    for section, names in ((1, list(entries.values())), (2, list(columns))):
        for i, name in enumerate(names):
            lead = "," if i else ("},\"%s\":{" % rows_key if section == 2 else "")
            frame.append(f"""({section}, {i}, '{name}', {document.OPENING}, 0, '{lead}"{name}":[')""")
            frame.append(f"({section}, {i}, '{name}', {document.CLOSING}, 0, ']')")
    frame.append("(3, 0, '', 0, 0, '}}')")
    parts.append("SELECT * FROM (VALUES " + ", ".join(frame) + ") AS f(section, item, name, part, n_values, body)")
    parts += [_array(1, i, n, "value", "code", f"{dictionary} WHERE col = '{c}'") for i, (c, n) in enumerate(entries.items())]
    parts += [_array(2, i, n, v, "position", rows) for i, (n, v) in enumerate(columns.items())]
    return " UNION ALL ".join(parts)


# -- postings --------------------------------------------------------------------------------

_JOB_COLUMNS = ("title", "city", "pub", "seen", "url", "np", "sk", "smin", "smax", *snapshot.POSTING_CODES.values())
_JOB_HEADER = """(SELECT '{"generated":"2024-05-03","window_days":90,"count":' || n || ',"total_window":' || n || ',"total_base":'
    || (SELECT COUNT(*) FROM f2_postings) || ',"dict":{' FROM (SELECT COUNT(*) AS n FROM b))"""
_JOB_PIECES = _document(_JOB_HEADER, "jobs", {c: c for c in snapshot.POSTING_CODES}, {c: c for c in _JOB_COLUMNS}, "codes", "shot")


@query("served_jobs", oracle(
    "f2_postings", **explore._BASE_TWINS, shot=explore._SHOT, pieces=_JOB_PIECES, sql="""
    SELECT CAST(section AS INTEGER) AS section, CAST(item AS INTEGER) AS item, name, CAST(part AS BIGINT) AS part,
      CAST(n_values AS BIGINT) AS n_values, CAST(STRLEN(body) + 1 AS BIGINT) AS n_bytes, MD5(body) AS digest FROM pieces"""))
def served_jobs(spark, sf):
    parts = document.pieces(document.posting_document(explore._base(spark, sf), explore.TODAY), SIZE)
    size = (F.octet_length("body") + 1).cast("bigint").alias("n_bytes")
    return parts.select("section", "item", "name", "part", "n_values", size, F.md5(F.col("body").cast("binary")).alias("digest"))


@query("document_rows", oracle("f2_postings", **explore._BASE_TWINS, sql="""
    SELECT CAST(position AS BIGINT) AS position, title, source, company, COALESCE(work_model, '') AS work_model, smin FROM b"""))
def document_rows(spark, sf):
    """A written document decoded again by its own dictionaries."""
    served = document.posting_document(explore._base(spark, sf), explore.TODAY)
    path = scratch_path(spark, "document")
    document.write_document(served, path, size=SIZE)
    rows = document.read_rows(spark, path, served.shot.rows.schema, SIZE)
    words = document.read_dictionary(spark, path, SIZE)
    for column in ("source", "company", "work_model"):
        known = words.where(F.col("column") == column).select(F.col("code").alias(snapshot.POSTING_CODES[column]), F.col("value").alias(column))
        rows = rows.join(known, snapshot.POSTING_CODES[column])
    return rows.select("position", "title", "source", "company", "work_model", "smin")


# -- listings --------------------------------------------------------------------------------

_LISTING_COLUMNS = {
    "uid": "uid", "title": "title", "url": "'https://www.vivareal.com.br/imovel/id-' || native_id || '/'", "km": "distance_km",
    "lat": "ROUND(lat, 5)", "lon": "ROUND(lon, 5)", "rent": "rent", "condo": "CAST(NULL AS INTEGER)", "land": "total_area",
    "built": "CAST(NULL AS INTEGER)", "ppm": "price_per_m2", "bed": "bedrooms", "suite": "CAST(NULL AS INTEGER)",
    "bath": "CAST(NULL AS INTEGER)", "park": "CAST(NULL AS INTEGER)", "ph": "['p' || native_id]", "match": "is_match",
    "pub": "CAST(seen AS VARCHAR)", "seen": "CAST(seen AS VARCHAR)", "nads": "nads",
    "rent0": "CASE WHEN opened <> 0 AND rent <> 0 AND opened <> rent THEN opened END", "approx": "geo_approx",
} | {n: f"(SELECT code FROM codes WHERE col = '{c}' AND value = p.{c})" for c, n in snapshot.LISTING_CODES.items()} | {
    "feat": """(SELECT COALESCE(LIST(fc.code ORDER BY i), []) FROM feats x JOIN fcodes fc ON fc.f = x.f WHERE x.position = p.position)"""
}
_LISTING_SHOT = "SELECT position, " + ", ".join(f'{v} AS "{n}"' for n, v in _LISTING_COLUMNS.items()) + " FROM placed p"
_LISTING_HEADER = """(SELECT '{"generated":"2024-01-30","count":' || (SELECT COUNT(*) FROM base) || ',"total_base":' || COUNT(*)
    || ',"radius_km":200,"origin":"Campinas","match_rule":{"rent_min":6000,"rent_max":14000,"land_min":4000},"dict":{' FROM resolved)"""
_LISTING_PIECES = _document(
    _LISTING_HEADER, "listings", document.LISTING_ENTRIES, {n: f'"{n}"' for n in _LISTING_COLUMNS}, "entries", "shot")


@query("served_listings", rentals._duck(
    """
    SELECT CAST(section AS INTEGER) AS section, CAST(item AS INTEGER) AS item, name, CAST(SUM(n_values) AS BIGINT) AS n_values,
      CAST(COUNT(*) FILTER (WHERE part BETWEEN 0 AND 1000000) AS BIGINT) AS n_parts, CAST(SUM(STRLEN(body) + 1) AS BIGINT) AS n_bytes
    FROM pieces GROUP BY ROLLUP ((section, item, name))""",
    **rentals._SHOT_TWINS, entries="SELECT * FROM codes UNION ALL SELECT 'feature', f, code FROM fcodes",
    shot=_LISTING_SHOT, pieces=_LISTING_PIECES))
def served_listings(spark, sf):
    """The manifest of a written document."""
    base = rentals._base(spark, sf)
    served = document.listing_document(base, rentals._rents(base), rentals.TODAY)
    return document.write_document(served, scratch_path(spark, "document"), size=SIZE)


@query("dq_manifest", oracle("f2_postings", **explore._BASE_TWINS, sql="""
    SELECT 'document_arrays' AS "check", FALSE AS ok, CAST(2 AS BIGINT) AS n_bad
    UNION ALL SELECT 'document_lengths', n = 0, CAST(n AS BIGINT) FROM (SELECT COUNT(*) AS n FROM (
      SELECT smin FROM b WHERE smin IS NULL LIMIT 1))"""))
def dq_manifest(spark, sf):
    """Two arrays are asked for that nothing serves; one column has lost the values that are null."""
    parts = document.pieces(document.posting_document(explore._base(spark, sf), explore.TODAY), SIZE)
    nulls = F.size(F.regexp_extract_all("body", F.lit("(null)"), 0))
    lost = F.when(F.col("name") == "smin", F.col("n_values") - nulls).otherwise(F.col("n_values"))
    counted = settle(document.manifest(parts.withColumn("n_values", lost)))
    count = counted.where("section = 2").agg(F.max("n_values")).first()[0]
    return quality.dq_manifest(counted, count, ("title", "src", "cmp", "smin", "salary"), ("source", "company", "city"))
