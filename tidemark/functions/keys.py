"""Identity keys: exact ones for upserts, fuzzy ones for counting copies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import fold_accents

# Words a title key ignores.
STOP_WORDS = (
    r"(?i)\b(pleno|s[eê]nior|j[uú]nior|jr|sr|senior|junior|especialista|"
    r"analista|estagi\w*|trainee|remoto|remote|home\s*office|\d+)\b"
)


def job_uid(source: Column, native_id: Column, url: Column) -> Column:
    """`source:id`, with the url standing in for a missing id."""
    return F.concat(source, F.lit(":"), F.coalesce(F.nullif(native_id, F.lit("")), url, F.lit("")))


def listing_uid(source: Column, native_id: Column) -> Column:
    return F.concat(source, F.lit(":"), native_id.cast("string"))


def _key_part(text: Column) -> Column:
    kept = F.regexp_replace(fold_accents(text), STOP_WORDS, " ")
    return F.trim(F.regexp_replace(kept, r"[^a-z0-9]+", " "))


def job_dedupe_key(title: Column, company: Column) -> Column:
    """`title|company` without accents, seniority words, numbers and punctuation."""
    return F.concat(_key_part(title), F.lit("|"), _key_part(company))


def listing_dedupe_key(
    lat: Column, lon: Column, land: Column, rent: Column, approximate: Column
) -> Column:
    """Position to three decimals plus land and rent in thousands; '' without a true position."""

    def thousands(amount: Column) -> Column:
        return F.floor(F.coalesce(amount, F.lit(0)) / 1000).cast("string")

    place = F.concat(F.round(lat, 3).cast("string"), F.lit(","), F.round(lon, 3).cast("string"))
    unusable = (F.coalesce(approximate, F.lit(0)) != 0) | lat.isNull() | lon.isNull()
    return F.when(unusable, "").otherwise(
        F.concat_ws("|", place, thousands(land), thousands(rent))
    )


def cart_key(product_id: Column, variant: Column) -> Column:
    return F.concat(
        product_id.cast("string"), F.lit("::"), F.coalesce(variant.cast("string"), F.lit(""))
    )
