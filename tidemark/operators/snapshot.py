"""Served snapshots: window, dictionary encoding, size guard, JSON document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_before
from tidemark.operators import history, listings
from tidemark.operators.lookup import byte_size, sized
from tidemark.operators.ordering import with_position
from tidemark.session import settle

# Served window, and the row and size caps that the daily runs pass.
WINDOW_DAYS, MAX_POSTINGS = 90, 15_000
MAX_POSTINGS_MB, MAX_LISTINGS_MB = 9, 4
BYTES_PER_MB = 1_048_576
PART_ROWS = 4096

# Dictionary columns and the names their codes are served under.
POSTING_CODES = {"source": "src", "company": "cmp", "area": "area", "seniority": "sen",
                 "work_model": "wm", "market": "mk", "country": "co"}
LISTING_CODES = {"city": "city", "state": "st", "property_type": "pt", "advertiser": "adv",
                 "portals": "por", "distance_band": "band"}
LISTING_ARRAYS = {"features": ("feat", "feature")}

POSITION = "position"


@dataclass(frozen=True)
class Snapshot:
    """Encoded rows with their `position`, and the dictionary (column, code, value)."""

    rows: DataFrame
    dictionary: DataFrame


def _numbered(first_seen: DataFrame) -> DataFrame:
    """Codes per column in order of `_first`, from one global order of all columns' values."""
    placed = with_position(first_seen, ["column", "_first"], "_place")
    starts = placed.groupBy("column").agg(F.min("_place").alias("_start"))
    coded = placed.join(F.broadcast(starts), "column")  # one row per dictionary column
    codes = (F.col("_place") - F.col("_start")).cast("int").alias("code")
    return settle(coded.select("column", codes, "value"))


def _elements(column: str, entry: str) -> Column:
    placed = F.transform(F.col(column), lambda v, i: F.struct(F.lit(entry).alias("column"), v.alias("value"), i.alias("_i")))
    none = F.array().cast("array<struct<column:string,value:string,_i:int>>")
    return F.coalesce(F.filter(placed, lambda e: e["value"].isNotNull()), none)


def _entries(df: DataFrame, order: str, codes: dict[str, str], arrays: dict[str, tuple[str, str]]) -> DataFrame:
    """(order, column, value, _i): every value to encode, one row each; `_i` is its place in an array, else -1."""
    scalars = F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit("")).alias("value"), F.lit(-1).alias("_i"))
        for c in codes
    ])
    lists = [_elements(c, entry) for c, (_, entry) in arrays.items()]
    return df.select(F.col(order), F.inline(F.concat(*([scalars] if codes else []), *lists)))


def dictionary_encode(
    df: DataFrame, order: str, codes: dict[str, str], arrays: dict[str, tuple[str, str]] | None = None
) -> Snapshot:
    """Replaces columns by codes numbered by first appearance along `order`; NULL counts as ''.

    `arrays` names array columns: {column: (name, dictionary entry)}; a row's codes keep the order
    of its elements, NULL elements are left out. All values of all columns are rows of one table,
    so the dictionary is one aggregate and one order of the distinct values, and encoding is one
    join with it and one regroup by row, however many columns there are. The dictionary is
    broadcast when its measured bytes allow it, else both sides are shuffled and a hot value's
    partition is split. `order` must be unique.
    """
    arrays = arrays or {}
    entries = _entries(df, order, codes, arrays)
    first = entries.groupBy("column", "value").agg(F.min(F.struct(F.col(order), F.col("_i"))).alias("_first"))
    dictionary = _numbered(first)
    coded = entries.join(sized(dictionary, byte_size(dictionary)), ["column", "value"])
    one = [F.max(F.when(F.col("column") == c, F.col("code"))).alias(f"_{name}") for c, name in codes.items()]
    many = [
        F.array_sort(F.collect_list(F.when(F.col("column") == entry, F.struct("_i", "code")))).alias(f"_{name}")
        for name, entry in arrays.values()
    ]
    per_row = coded.groupBy(order).agg(*one, *many)
    kept = [c for c in df.columns if c not in codes and c not in arrays]
    empty = F.array().cast("array<int>")
    lists = [F.coalesce(F.col(f"_{name}.code"), empty).alias(name) for name, _ in arrays.values()]
    rows = df.select(*kept).join(per_row, order, "left")
    return Snapshot(rows.select(*kept, *[F.col(f"_{name}").alias(name) for name in codes.values()], *lists), dictionary)


def dictionary_encode_array(
    df: DataFrame, order: str, column: str, name: str, entry: str | None = None
) -> Snapshot:
    """The same for the elements of one array column."""
    return dictionary_encode(df, order, {}, {column: (name, entry or column)})


# -- postings --------------------------------------------------------------------------------

def freshness() -> Column:
    """Later of publication and first sighting."""
    return F.greatest("published_date", "first_seen_date")


def window_filter(base: DataFrame, today: str, days: int = WINDOW_DAYS) -> DataFrame:
    return base.where(freshness() >= days_before(today, days))


def snapshot_limit(base: DataFrame, limit: int) -> DataFrame:
    """The freshest rows."""
    return base.orderBy(freshness().desc(), "job_uid").limit(limit)


def base_totals(base: DataFrame, today: str, days: int = WINDOW_DAYS) -> DataFrame:
    inside = freshness() >= days_before(today, days)
    return base.agg(F.count_if(inside).alias("total_window"), F.count("*").alias("total_base"))


def serve_postings(
    base: DataFrame, today: str, days: int = WINDOW_DAYS, limit: int | None = None
) -> DataFrame:
    """The served rows with portal counts (over the served rows only) and their position."""
    served = window_filter(base, today, days)
    if limit is not None:
        served = snapshot_limit(served, limit)
    placed = with_position(served, [freshness().desc(), F.col("job_uid")], POSITION)
    return listings.attach_portal_count(placed)


def snapshot_postings(
    base: DataFrame, today: str, days: int = WINDOW_DAYS, limit: int | None = None
) -> Snapshot:
    served = serve_postings(base, today, days, limit)
    seen = F.col("first_seen_date")
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("title", "url", "skills")}
    flat = served.select(
        POSITION, *POSTING_CODES,
        text["title"].alias("title"),
        F.coalesce(F.nullif("city", F.lit("")), "state", F.lit("")).alias("city"),
        F.coalesce("published_date", seen).cast("string").alias("pub"),
        seen.cast("string").alias("seen"),
        text["url"].alias("url"),
        F.coalesce("n_portals", F.lit(1)).alias("np"),
        text["skills"].alias("sk"),
        F.round(F.when(F.col("salary_min") != 0, F.col("salary_min"))).cast("bigint").alias("smin"),
        F.round(F.when(F.col("salary_max") != 0, F.col("salary_max"))).cast("bigint").alias("smax"),
    )
    return dictionary_encode(flat, POSITION, POSTING_CODES)


# -- listings --------------------------------------------------------------------------------

def snapshot_listings(
    base: DataFrame, rents: DataFrame, today: str, active_days: int = history.ACTIVE_DAYS
) -> Snapshot:
    """Active listings, newest first then cheapest, with copies counted and opening rents."""
    rows = listings.attach_cluster_count(history.active(base, today, active_days))
    rows = history.attach_opening(rows, rents, "listing_uid", "date", "rent", "rent0")
    order = [F.col("first_seen_date").desc(), F.col("rent").asc_nulls_first(), F.col("listing_uid")]
    placed = with_position(rows, order, POSITION)
    flat = placed.select(
        POSITION, F.col("listing_uid").alias("uid"),
        F.coalesce("title", F.lit("")).alias("title"), F.coalesce("url", F.lit("")).alias("url"),
        "city", "state", "property_type", "advertiser",
        F.array_join("portals", " · ").alias("portals"), "distance_band",
        F.col("distance_km").alias("km"), F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon"),
        "rent", F.col("condo_fee").alias("condo"), F.col("total_area").alias("land"),
        F.col("usable_area").alias("built"), F.col("price_per_m2").alias("ppm"),
        F.col("bedrooms").alias("bed"), F.col("suites").alias("suite"),
        F.col("bathrooms").alias("bath"), F.col("parking").alias("park"),
        "features", F.col("photos").alias("ph"),
        F.coalesce("is_match", F.lit(0)).alias("match"),
        F.coalesce(F.col("published_date").cast("string"), F.lit("")).alias("pub"),
        F.col("first_seen_date").cast("string").alias("seen"),
        F.col("n_ads").alias("nads"), "rent0", F.coalesce("geo_approx", F.lit(0)).alias("approx"),
    )
    return dictionary_encode(flat, POSITION, LISTING_CODES, LISTING_ARRAYS)


# -- size and document -----------------------------------------------------------------------

def _values_bytes(column: str) -> Column:
    """UTF-8 bytes of a column's values as JSON, commas and brackets of its array included."""
    one = F.octet_length(F.to_json(F.array(F.col(column)), {"ignoreNullFields": "false"})) - 1
    return F.coalesce(F.sum(one), F.lit(1)) + 1


def payload_bytes(rows: DataFrame, position: str = POSITION) -> DataFrame:
    """Bytes of the rows written as one JSON object of column arrays, by a plain aggregate."""
    columns = [c for c in rows.columns if c != position]
    names = sum(len(c.encode()) + 3 for c in columns) + len(columns) + 1
    total = F.lit(names)
    for c in columns:
        total = total + _values_bytes(c)
    return rows.agg(F.count("*").alias("n_rows"), total.alias("payload_bytes"))


def size_guard(rows: DataFrame, max_mb: float, position: str = POSITION) -> DataFrame:
    """The rows, or an error when their document would exceed the cap."""
    size = payload_bytes(rows, position).first()["payload_bytes"]
    if size > max_mb * BYTES_PER_MB:
        raise ValueError(f"payload of {size / BYTES_PER_MB:.1f} MB exceeds {max_mb} MB")
    return rows


def columnar_document(rows: DataFrame, max_mb: float, position: str = POSITION) -> DataFrame:
    """One row, one JSON text of column arrays; gathered only after the size guard passed."""
    columns = [c for c in rows.columns if c != position]
    ordered = size_guard(rows, max_mb, position).agg(
        F.array_sort(F.collect_list(F.struct(position, *columns))).alias("_r")
    )
    arrays = F.struct(*[F.col(f"_r.{c}").alias(c) for c in columns])
    return ordered.select(F.to_json(arrays, {"ignoreNullFields": "false"}).alias("document"))


def columnar_parts(rows: DataFrame, size: int = PART_ROWS, position: str = POSITION) -> DataFrame:
    """(part, document): the column arrays of each range of `size` positions, as one JSON text a range."""
    columns = [c for c in rows.columns if c != position]
    part = F.floor(F.col(position) / size).alias("part")
    gathered = rows.groupBy(part).agg(F.array_sort(F.collect_list(F.struct(position, *columns))).alias("_r"))
    arrays = F.struct(*[F.col(f"_r.{c}").alias(c) for c in columns])
    return gathered.select("part", F.to_json(arrays, {"ignoreNullFields": "false"}).alias("document"))
