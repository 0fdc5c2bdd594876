"""Faceted exploration of a served table: filters, tallies, cross-tabulation, sorting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_before
from tidemark.functions.text import search_text

# Facets, label of an empty value, list lengths, page size, timeline span.
FACETS = ("source", "area", "seniority", "work_model", "market")
EMPTY_LABEL = "n/a"
TOP_AREAS, TOP_SENIORITIES, TOP_SOURCES, TOP_COMPANIES = 11, 8, 20, 15
PAGE_SIZE = 40
TIMELINE_DAYS = 90


def _value(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _label(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(EMPTY_LABEL))


def facet_filter(df: DataFrame, chosen: dict[str, list[str]]) -> DataFrame:
    """Any of the chosen values inside a facet, all facets together; an empty choice is no filter."""
    for facet, values in chosen.items():
        if values:
            df = df.where(F.col(facet).isin(list(values)))
    return df


def recency_filter(
    df: DataFrame, generated: str, days: int | None, published: str = "pub", seen: str = "seen"
) -> DataFrame:
    """Rows published (or else first seen) within `days` of the generated date; no upper bound."""
    if days is None:
        return df
    dated = F.coalesce(F.col(published), F.col(seen)) if seen in df.columns else F.col(published)
    return df.where(dated >= days_before(generated, days))


def text_search(df: DataFrame, text: str, title: str = "title", company: str = "company") -> DataFrame:
    wanted = text.strip().lower()
    if not wanted:
        return df
    return df.where(search_text(F.col(title), F.col(company)).contains(wanted))


def explorer_query(
    df: DataFrame,
    generated: str,
    chosen: dict[str, list[str]] | None = None,
    days: int | None = None,
    text: str = "",
    title: str = "title",
) -> DataFrame:
    """All filters together, as one scan."""
    kept = recency_filter(facet_filter(df, chosen or {}), generated, days)
    return text_search(kept, text, title)


def facet_counts(df: DataFrame, facets: tuple[str, ...] = FACETS) -> DataFrame:
    """Rows per value of every facet, in one pass over the rows."""
    pairs = F.array(*[F.struct(F.lit(f).alias("facet"), _value(f).alias("value")) for f in facets])
    long = df.select(F.inline(pairs))
    counts = long.groupBy("facet", "value").agg(F.count("*").alias("n_rows"))
    return counts.withColumn("label", _label(F.col("value")))


def tally_top_n(df: DataFrame, column: str, n: int) -> DataFrame:
    """The `n` commonest values with their counts."""
    counts = df.groupBy(_value(column).alias("value")).agg(F.count("*").alias("n_rows"))
    top = counts.orderBy(F.col("n_rows").desc(), "value").limit(n)
    return top.select(_label(F.col("value")).alias("label"), "n_rows")


def top_companies(df: DataFrame, n: int = TOP_COMPANIES, column: str = "company") -> DataFrame:
    named = df.where(F.col(column).isNotNull() & ~F.col(column).isin("", "?"))
    return tally_top_n(named, column, n)


def crosstab_share(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts per (row, column) value with their share of the row and of the column.

    The totals are aggregates of the counts, joined back, so a row with very many
    columns is not gathered anywhere.
    """
    counts = df.groupBy(_value(row).alias(row), _value(column).alias(column)).agg(
        F.count("*").alias("n_rows")
    )
    row_totals = counts.groupBy(row).agg(F.sum("n_rows").alias("row_total"))
    column_totals = counts.groupBy(column).agg(F.sum("n_rows").alias("column_total"))
    return counts.join(row_totals, row).join(column_totals, column).withColumns({
        "row_share": F.col("n_rows") / F.col("row_total"),
        "column_share": F.col("n_rows") / F.col("column_total"),
    })


def timeline_daily(df: DataFrame, generated: str, days: int = TIMELINE_DAYS, published: str = "pub") -> DataFrame:
    """Rows per publication day in the closed span ending at the generated date."""
    day = F.col(published)
    inside = df.where(day.between(days_before(generated, days), F.lit(generated).cast("date")))
    return inside.groupBy(day.alias("day")).agg(F.count("*").alias("n_rows"))


def kpi_totals(df: DataFrame, generated: str, published: str = "pub") -> DataFrame:
    """Rows, rows published on the date and from a week before on, and distinct values."""
    day = F.col(published)
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(day == F.lit(generated).cast("date")).alias("today"),
        F.count_if(day >= days_before(generated, 7)).alias("last_7_days"),
        F.count_distinct(_value("source")).alias("portals"),
        F.count_distinct(_value("company")).alias("companies"),
        F.count_distinct(_value("area")).alias("areas"),
    )


def sort_order(mode: str, key: str, published: str = "pub", seen: str = "seen") -> list[Column]:
    """Sort columns of a list mode; the unique key comes last so pages never overlap."""
    dated = F.coalesce(F.col(published), F.col(seen))
    newest = dated.desc_nulls_last()
    modes = {
        "recent": [newest],
        "oldest": [dated.asc_nulls_first()],
        "portals": [F.col("n_portals").desc(), newest],
        "company": [F.lower(_value("company")).asc(), newest],
    }
    return [*modes[mode], F.col(key).asc()]
