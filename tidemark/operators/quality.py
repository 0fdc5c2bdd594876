"""Contract checks between a snapshot's producer and its readers.

Each check is a one-row frame (check, ok, n_bad), so any set of them can be
unioned into a report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scores
from tidemark.functions.geo import BANDS, RADIUS_KM
from tidemark.operators import listings

# Required columns, banned word, url form, share of rows the plot must hold.
LISTING_COLUMNS = ("uid", "title", "url", "city", "st", "pt", "adv", "por", "band", "km", "lat",
                   "lon", "rent", "condo", "land", "built", "ppm", "bed", "suite", "bath",
                   "park", "feat", "ph", "match", "pub", "seen", "nads", "rent0", "approx")
PHONE_SHAPE = r"(?U)(?<!\d)(?:\(?\d{2}\)?[\s.-]*)?9?[\s.-]?\d{4}[\s.-]?\d{4}(?!\d)"
BANNED_WORD = "whatsapp"
URL_FORM = r"\Ahttps://www\.(vivareal|zapimoveis)\.com\.br/imovel/id-\d+/\z"
MIN_PLOTTED_SHARE = 0.6


def _verdict(rows: DataFrame, check: str, bad: Column) -> DataFrame:
    counted = rows.agg(F.coalesce(bad, F.lit(0)).cast("bigint").alias("n_bad"))
    return counted.select(F.lit(check).alias("check"), (F.col("n_bad") == 0).alias("ok"), "n_bad")


def _keys(body: str | Column) -> Column:
    """Keys of a JSON object; none for NULL and for what is no object."""
    text = F.col(body) if isinstance(body, str) else body
    return F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))


def key_census(documents: DataFrame, body: str) -> DataFrame:
    """(key, n_rows): in how many JSON documents each key occurs; a key repeated in one counts once."""
    return documents.select(F.explode(F.array_distinct(_keys(body))).alias("key")).groupBy("key").agg(F.count("*").alias("n_rows"))


def missing_keys(documents: DataFrame, body: str, required: tuple[str, ...]) -> DataFrame:
    """(missing, n_rows): the required keys that some document lacks, and how many lack them.

    A text that is no JSON object lacks them all.
    """
    absent = F.array_except(F.array(*[F.lit(k) for k in required]), _keys(body))
    return documents.select(F.explode(absent).alias("missing")).groupBy("missing").agg(F.count("*").alias("n_rows"))


def dq_columns(documents: DataFrame, body: str, required: tuple[str, ...] = LISTING_COLUMNS) -> DataFrame:
    """Documents that lack a required key."""
    present = F.array_intersect(F.array(*[F.lit(k) for k in required]), _keys(body))
    return _verdict(documents, "columns", F.count_if(F.size(present) < len(set(required))))


def dq_no_description(documents: DataFrame, body: str, banned: tuple[str, ...] = ("description",)) -> DataFrame:
    """Documents with a key that must not be served."""
    return _verdict(documents, "no_description", F.count_if(F.arrays_overlap(_keys(body), F.array(*[F.lit(k) for k in banned]))))


def dq_manifest(manifest: DataFrame, count: int, columns: tuple[str, ...], entries: tuple[str, ...] = ()) -> DataFrame:
    """A written document's arrays by its manifest: required ones that are absent, and columns not `count` long."""
    required = [F.struct(F.lit(1).alias("section"), F.lit(n).alias("name")) for n in entries]
    required += [F.struct(F.lit(2).alias("section"), F.lit(n).alias("name")) for n in columns]
    listed = F.collect_set(F.when(F.col("name") != "", F.struct("section", "name")))
    uneven = F.count_if((F.col("section") == 2) & (F.col("n_values") != count))
    found = manifest.agg(F.size(F.array_except(F.array(*required), listed)).alias("absent"), uneven.alias("uneven"))
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check"), (F.col(n) == 0).alias("ok"), F.col(n).cast("bigint").alias("n_bad"))
        for check, n in (("document_arrays", "absent"), ("document_lengths", "uneven"))
    ])))


def dq_lengths(documents: DataFrame, document: str, columns: list[str]) -> DataFrame:
    """All column arrays of a document are equally long."""
    arrays = F.from_json(document, ", ".join(f"`{c}` array<string>" for c in columns))
    sizes = F.array(*[F.coalesce(F.size(arrays[c]), F.lit(-1)) for c in columns])
    uneven = F.size(F.array_distinct(sizes)) > 1
    return _verdict(documents, "lengths", F.count_if(uneven))


def dq_code_range(rows: DataFrame, dictionary: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Codes outside their dictionary (scalar columns), all columns in one pass."""
    pairs = F.array(*[
        F.struct(F.lit(column).alias("column"), F.col(name).alias("code"))
        for column, name in codes.items()
    ])
    used = rows.select(F.inline(pairs)).groupBy("column", "code").agg(F.count("*").alias("n"))
    unknown = used.join(dictionary.select("column", "code"), ["column", "code"], "left_anti")
    return _verdict(unknown, "code_range", F.sum("n"))


def dq_array_code_range(rows: DataFrame, dictionary: DataFrame, name: str, column: str) -> DataFrame:
    used = rows.select(F.explode(name).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    known = dictionary.where(F.col("column") == column).select("code")
    return _verdict(used.join(known, "code", "left_anti"), "array_code_range", F.sum("n"))


def dq_rule_agreement(
    rows: DataFrame, rent: str = "rent", land: str = "land", flag: str = "match"
) -> DataFrame:
    wanted = scores.is_match(F.col(rent), F.col(land))
    return _verdict(rows, "rule_agreement", F.count_if(~F.col(flag).eqNullSafe(wanted)))


def dq_rule_thresholds(headers: DataFrame, header: str, expected: dict[str, int]) -> DataFrame:
    """Served headers whose match rule is not the one applied; a header without one counts too."""
    rule = F.from_json(F.get_json_object(header, "$.match_rule"), "map<string,bigint>")
    same = [F.coalesce(F.try_element_at(rule, F.lit(k)) == v, F.lit(False)) for k, v in expected.items()]
    return _verdict(headers, "rule_thresholds", F.count_if(~reduce(lambda a, b: a & b, same, F.lit(True))))


def dq_labels(
    dictionary: DataFrame, column: str = "distance_band", allowed: tuple[str, ...] = tuple(b for _, b in BANDS)
) -> DataFrame:
    """Dictionary labels a reader does not know; the empty label is always allowed."""
    stray = (F.col("value") != "") & ~F.col("value").isin(*allowed)
    return _verdict(dictionary.where(F.col("column") == column), "labels", F.count_if(stray))


def missing_labels(present: DataFrame, value: str, declared: DataFrame) -> DataFrame:
    """Declared labels that never occur."""
    return declared.select(value).distinct().join(present.select(value).distinct(), value, "left_anti")


def dq_pii(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Values shaped like a phone number or holding the banned word."""
    shaped = [
        F.col(c).rlike(PHONE_SHAPE) | F.lower(F.col(c)).contains(BANNED_WORD) for c in columns
    ]
    leaked = reduce(lambda a, b: a | b, [F.coalesce(s, F.lit(False)) for s in shaped])
    return _verdict(rows, "pii", F.count_if(leaked))


def dq_url_form(rows: DataFrame, url: str = "url", form: str = URL_FORM) -> DataFrame:
    return _verdict(rows, "url_form", F.count_if(~F.coalesce(F.col(url).rlike(form), F.lit(False))))


def dq_geo(rows: DataFrame, km: str = "km", radius_km: float = RADIUS_KM) -> DataFrame:
    """Rows without a distance or beyond the radius."""
    off = F.col(km).isNull() | (F.col(km) > radius_km)
    return _verdict(rows, "geo", F.count_if(off))


def dq_domain_share(rows: DataFrame, share: float = MIN_PLOTTED_SHARE) -> DataFrame:
    """Warns when fewer than `share` of the rows fall into the plot's domain; n_bad are those outside."""
    counted = rows.agg(
        F.count("*").alias("n"), F.count_if(listings.in_domain()).alias("inside")
    )
    return counted.select(
        F.lit("domain_share").alias("check"), (F.col("inside") >= F.col("n") * share).alias("ok"),
        (F.col("n") - F.col("inside")).alias("n_bad"),
    )


def dq_buckets(rows: DataFrame) -> DataFrame:
    """Filter buckets no row falls into."""
    return _verdict(listings.numeric_buckets(rows), "buckets", F.count_if(F.col("n_rows") == 0))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def require_ok(checks: DataFrame) -> None:
    """Error naming the failed checks."""
    failed = [r.check for r in checks.where(~F.col("ok")).select("check").toLocalIterator()]
    if failed:
        raise ValueError(f"contract checks failed: {failed}")
