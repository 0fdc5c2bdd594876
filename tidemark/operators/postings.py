"""Job postings: classification, identity and run reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import taxonomy
from tidemark.functions.keys import job_dedupe_key, job_uid
from tidemark.functions.text import skills_join, snippet


def classify_job(jobs: DataFrame, description_length: int | None = None) -> DataFrame:
    """Adds area and seniority; `description_length` characters of the description count, or all."""
    return jobs.withColumns({
        "area": taxonomy.area(
            F.col("title"), F.col("description"), F.col("categories"), description_length=description_length),
        "seniority": taxonomy.seniority(F.col("title"), F.col("levels")),
    })


def to_base_rows(jobs: DataFrame) -> DataFrame:
    """Normalised, classified postings in the shape the base table keeps."""
    return jobs.select(
        job_uid(F.col("source"), F.col("native_id"), F.col("url")).alias("job_uid"),
        "source", "title", "company", "area", "seniority", "work_model", "city", "state",
        "country", "market", "salary_min", "salary_max", "salary_currency", "published_date",
        "url", skills_join(F.col("skills")).alias("skills"),
        snippet(F.col("description")).alias("description"),
        job_dedupe_key(F.col("title"), F.col("company")).alias("dedupe_key"),
        "ord",
    )


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All sources' rows under one schema, by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def run_report(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of each reported column, in one pass; an unknown value is `?`."""
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("report"),
            F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("?")).alias("value"),
        )
        for c in columns
    ])
    return rows.select(F.inline(pairs)).groupBy("report", "value").agg(F.count("*").alias("n_rows"))


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    """The rows, or an error when a run collected none."""
    if rows.isEmpty():
        raise ValueError(f"no {what} collected")
    return rows
