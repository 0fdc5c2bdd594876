"""Job-market run: landed feeds to an updated base and a served snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import document, history, snapshot
from tidemark.operators.postings import classify_job, to_base_rows, union_sources
from tidemark.sources import jobs

BASE_SCHEMA = (
    "job_uid string, source string, title string, company string, area string, "
    "seniority string, work_model string, city string, state string, country string, "
    "market string, salary_min double, salary_max double, salary_currency string, "
    "published_date date, first_seen_date date, last_seen_date date, url string, "
    "skills string, description string, dedupe_key string"
)


# What a daily run keeps of each source and each posting.
FEED_LIMITS = {
    "remotive": {"max_tags": 8}, "remoteok": {"max_tags": 8}, "himalayas": {"max_tags": 8}, "arbeitnow": {"max_tags": 8},
    "greenhouse": {"cap": 120}, "lever": {"cap": 120}, "ashby": {"cap": 120},
}
CLASSIFIED_LENGTH = 500


def empty_base(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BASE_SCHEMA)


def collect(
    landing: DataFrame, feeds: list[str] | None = None, limits: dict[str, dict[str, int]] = FEED_LIMITS,
    classified_length: int | None = CLASSIFIED_LENGTH,
) -> DataFrame:
    """The run's postings, normalised, classified and keyed; `limits={}` and None keep all."""
    rows = union_sources([jobs.normalise(landing, f, **limits.get(f, {})) for f in feeds or jobs.ADAPTERS])
    return to_base_rows(classify_job(rows, classified_length))


def update_base(base: DataFrame, batch: DataFrame, today: str) -> DataFrame:
    """The base after the run: upserted, then pruned. Write it to a new path, never over its input."""
    merged = history.upsert_keyed(
        base, batch, "job_uid", list(history.POSTING_MUTABLE), today, "ord"
    )
    return history.prune(merged, today, history.KEEP_POSTING_DAYS)


def serve(base: DataFrame, today: str) -> snapshot.Snapshot:
    """The freshest postings, encoded, within the size cap."""
    shot = snapshot.snapshot_postings(base, today, limit=snapshot.MAX_POSTINGS)
    snapshot.size_guard(shot.rows, snapshot.MAX_POSTINGS_MB)
    return shot


def publish(base: DataFrame, today: str, path: str, max_mb: float | None = snapshot.MAX_POSTINGS_MB) -> DataFrame:
    """Writes the served document under `path`, header and dictionaries included, and returns its manifest."""
    served = document.posting_document(base, today, limit=snapshot.MAX_POSTINGS)
    return document.write_document(served, path, max_mb)
