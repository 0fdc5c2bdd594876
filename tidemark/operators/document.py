"""Served documents: header, dictionaries and column arrays as pieces of one JSON text.

A document is a table of pieces (section, item, name, part, n_values, body). Read in the order of
section, item and part, their bodies are one JSON text, one piece a line:

    {header fields, "dict": {column: [values by code]}, <rows key>: {column: [values by position]}}

A part holds at most `size` values, so no task holds more rows than that whatever the document's
size. The manifest counts values, parts and bytes of every array and of the whole; it is written
after the pieces, so a folder that has one is complete.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scores
from tidemark.functions.dates import days_before
from tidemark.functions.geo import RADIUS_KM
from tidemark.operators import history, snapshot
from tidemark.operators.snapshot import BYTES_PER_MB, PART_ROWS, POSITION, Snapshot
from tidemark.session import settle

# The origin's name, the match rule's thresholds and the names dictionaries are served under.
ORIGIN_NAME = "Campinas"
MATCH_RULE = {"rent_min": scores.MATCH_RENT_MIN, "rent_max": scores.MATCH_RENT_MAX, "land_min": scores.MATCH_LAND_MIN}
LISTING_ENTRIES = {"city": "city", "state": "state", "property_type": "property_type", "advertiser": "advertiser",
                   "portals": "portals", "distance_band": "band", "feature": "feature"}

HEADER, DICTIONARY, ROWS, END = range(4)
OPENING, CLOSING = -1, (1 << 62)  # the parts that open and close an array
PLACE = ("section", "item", "part")
PIECE = "section int, item int, name string, part bigint, n_values bigint, body string"


@dataclass(frozen=True)
class Document:
    """`header`: one row of fields; `rows_key`: the key of the column arrays; `entries`: served dictionaries in order."""

    header: DataFrame
    shot: Snapshot
    rows_key: str
    entries: dict[str, str]

    @property
    def columns(self) -> list[str]:
        return [c for c in self.shot.rows.columns if c != POSITION]


def posting_document(
    base: DataFrame, today: str, days: int = snapshot.WINDOW_DAYS, limit: int | None = None
) -> Document:
    """The served postings: generated, window_days, count, total_window and total_base before the arrays."""
    totals = snapshot.base_totals(base, today, days)
    window = F.col("total_window")
    header = totals.select(
        F.lit(today).alias("generated"), F.lit(days).alias("window_days"),
        (window if limit is None else F.least(window, F.lit(limit).cast("bigint"))).alias("count"), "total_window", "total_base")
    shot = snapshot.snapshot_postings(base, today, days, limit)
    return Document(header, shot, "jobs", {c: c for c in snapshot.POSTING_CODES})


def listing_document(
    base: DataFrame, rents: DataFrame, today: str, active_days: int = history.ACTIVE_DAYS,
    radius_km: float = RADIUS_KM, origin: str = ORIGIN_NAME, match_rule: dict[str, int] = MATCH_RULE,
) -> Document:
    """The served listings; radius, origin and the thresholds of the match column go with them."""
    rule = F.struct(*[F.lit(v).alias(k) for k, v in match_rule.items()])
    header = base.agg(
        F.count_if(F.col("last_seen_date") >= days_before(today, active_days)).alias("count"), F.count("*").alias("total_base")
    ).select(
        F.lit(today).alias("generated"), "count", "total_base", F.lit(radius_km).alias("radius_km"),
        F.lit(origin).alias("origin"), rule.alias("match_rule"))
    shot = snapshot.snapshot_listings(base, rents, today, active_days)
    return Document(header, shot, "listings", LISTING_ENTRIES)


def _quoted(name: str) -> str:
    return json.dumps(name, ensure_ascii=False)


def _json(values: Column) -> Column:
    return F.to_json(values, {"ignoreNullFields": "false"})


def _frame(spark: SparkSession, doc: Document) -> DataFrame:
    """What stands around the values: a row or two for each array, a few for the document."""
    fixed = []
    for section, names in ((DICTIONARY, list(doc.entries.values())), (ROWS, doc.columns)):
        for i, name in enumerate(names):
            lead = "," if i else ("},%s:{" % _quoted(doc.rows_key) if section == ROWS else "")
            fixed.append((section, i, name, OPENING, 0, f"{lead}{_quoted(name)}:["))
            fixed.append((section, i, name, CLOSING, 0, "]"))
    if not doc.columns:
        fixed.append((ROWS, 0, doc.rows_key, OPENING, 0, "},%s:{" % _quoted(doc.rows_key)))
    fixed.append((END, 0, "", 0, 0, "}}"))
    rows = [dict(zip(("section", "item", "name", "part", "n_values", "body"), r, strict=True)) for r in fixed]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{PIECE}>>")))


def _values(values: Column, part: Column) -> Column:
    """The values of an array as JSON, without its brackets and with the comma that joins it to the part before."""
    text = _json(values)
    return F.concat(F.when(part > 0, ",").otherwise(""), F.substring(text, F.lit(2), F.length(text) - 2))


def _header_piece(doc: Document) -> DataFrame:
    text = _json(F.struct(*doc.header.columns))
    body = F.concat(F.regexp_replace(text, r"\}\z", ""), F.lit("," if doc.header.columns else ""), F.lit('"dict":{'))
    return doc.header.select(
        F.lit(HEADER).alias("section"), F.lit(0).alias("item"), F.lit("").alias("name"),
        F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("n_values"), body.alias("body"))


def _dictionary_pieces(doc: Document, size: int) -> DataFrame:
    names = list(doc.entries)
    part = F.floor(F.col("code") / size).alias("part")
    known = doc.shot.dictionary.where(F.col("column").isin(*names))
    gathered = known.groupBy("column", part).agg(F.array_sort(F.collect_list(F.struct("code", "value"))).alias("_v"))
    item = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("column")) - 1
    served = F.get(F.array(*[F.lit(n) for n in doc.entries.values()]), item.cast("int"))
    return gathered.select(
        F.lit(DICTIONARY).alias("section"), item.cast("int").alias("item"), served.alias("name"), "part",
        F.size("_v").cast("bigint").alias("n_values"), _values(F.col("_v.value"), F.col("part")).alias("body"))


def _row_pieces(doc: Document, size: int) -> DataFrame:
    part = F.floor(F.col(POSITION) / size).alias("part")
    gathered = doc.shot.rows.groupBy(part).agg(
        F.array_sort(F.collect_list(F.struct(POSITION, F.struct(*doc.columns).alias("v")))).alias("_r"))
    arrays = F.array(*[
        F.struct(F.lit(i).alias("item"), F.lit(c).alias("name"), _values(F.col("_r.v")[c], F.col("part")).alias("body"))
        for i, c in enumerate(doc.columns)
    ])
    n = F.size("_r").cast("bigint").alias("n_values")
    return gathered.select("part", n, F.inline(arrays)).select(
        F.lit(ROWS).alias("section"), "item", "name", "part", "n_values", "body")


def pieces(doc: Document, size: int = PART_ROWS) -> DataFrame:
    """The document's pieces; arrays hold at most `size` values each."""
    out = _frame(doc.header.sparkSession, doc).unionByName(_header_piece(doc))
    if doc.entries:
        out = out.unionByName(_dictionary_pieces(doc, size))
    return out.unionByName(_row_pieces(doc, size)) if doc.columns else out


def manifest(parts: DataFrame) -> DataFrame:
    """(section, item, name, n_values, n_parts, n_bytes): one row per array, and one with section NULL for all.

    n_bytes is that of the written text, line ends included.
    """
    grouped = parts.rollup(F.struct("section", "item", "name").alias("_of")).agg(
        F.sum("n_values").alias("n_values"), F.count_if((F.col("part") != OPENING) & (F.col("part") != CLOSING)).alias("n_parts"),
        F.sum(F.octet_length("body") + 1).alias("n_bytes"))
    return grouped.select("_of.section", "_of.item", "_of.name", "n_values", "n_parts", "n_bytes")


def document_bytes(parts: DataFrame) -> int:
    """Bytes of the text: header, dictionaries and rows."""
    return parts.agg(F.sum(F.octet_length("body") + 1).alias("n")).first()["n"]


def document_guard(parts: DataFrame, max_mb: float) -> int:
    """The document's bytes, or an error when they exceed the cap."""
    size = document_bytes(parts)
    if size > max_mb * BYTES_PER_MB:
        raise ValueError(f"document of {size / BYTES_PER_MB:.1f} MB exceeds {max_mb} MB")
    return size


def write_document(doc: Document, path: str, max_mb: float | None = None, size: int = PART_ROWS) -> DataFrame:
    """Writes `path/document` (text, whose part files in order are the JSON), `path/pieces` and then `path/manifest`.

    Nothing is written when the document exceeds the cap. Returns the manifest read back.
    """
    spark = doc.header.sparkSession
    parts = settle(pieces(doc, size))
    if max_mb is not None:
        document_guard(parts, max_mb)
    parts.write.parquet(f"{path}/pieces")
    parts.orderBy(*PLACE).select("body").write.text(f"{path}/document")
    counted = manifest(parts)
    counted.coalesce(1).write.parquet(f"{path}/manifest")  # one row an array
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def _parsed(body: str, part: str, kind: str) -> Column:
    bare = F.when(F.col(part) > 0, F.substring(body, 2, 2147483647)).otherwise(F.col(body))
    return F.from_json(F.concat(F.lit("["), bare, F.lit("]")), f"array<{kind}>")


def read_rows(spark: SparkSession, path: str, schema: T.StructType, size: int = PART_ROWS) -> DataFrame:
    """The encoded rows of a written document with their position; `schema` names and types its columns."""
    parts = spark.read.parquet(f"{path}/pieces").where((F.col("section") == ROWS) & F.col("part").between(0, CLOSING - 1))
    fields = [f for f in schema.fields if f.name != POSITION]
    texts = parts.groupBy("part").agg(*[F.max(F.when(F.col("name") == f.name, F.col("body"))).alias(f.name) for f in fields])
    arrays = [_parsed(f.name, "part", f.dataType.simpleString()).alias(f.name) for f in fields]
    spread = texts.select("part", F.arrays_zip(*arrays).alias("_r")).select("part", F.posexplode("_r").alias("_i", "_v"))
    named = [F.col("_v").getField(f.name).alias(f.name) for f in fields]
    return spread.select((F.col("part") * size + F.col("_i")).alias(POSITION), *named)


def read_dictionary(spark: SparkSession, path: str, size: int = PART_ROWS) -> DataFrame:
    """(column, code, value) of a written document, columns by their served names."""
    parts = spark.read.parquet(f"{path}/pieces").where((F.col("section") == DICTIONARY) & F.col("part").between(0, CLOSING - 1))
    spread = parts.select("name", "part", F.posexplode(_parsed("body", "part", "string")).alias("_i", "value"))
    return spread.select(F.col("name").alias("column"), (F.col("part") * size + F.col("_i")).cast("int").alias("code"), "value")
