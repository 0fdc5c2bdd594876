"""Keyed history: upserts, sightings, pruning and value changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import days_before

# Days a key is kept or served after its last sighting.
KEEP_POSTING_DAYS, KEEP_LISTING_DAYS, ACTIVE_DAYS = 120, 180, 10
# Posting columns an upsert refreshes; the others stay as first inserted.
POSTING_MUTABLE = ("title", "company", "area", "seniority", "work_model",
                   "salary_min", "salary_max", "url")
# Listing columns an upsert leaves as first inserted.
LISTING_FROZEN = ("source",)

SEEN = ("first_seen_date", "last_seen_date")


def collapse_batch(batch: DataFrame, key: str, mutable: list[str], order: str) -> DataFrame:
    """One row per key: frozen columns of its first row, mutable ones of its last.

    That is what writing the rows one by one leaves behind. Partial aggregation
    keeps a repeated key at one row per map task.
    """
    frozen = [c for c in batch.columns if c not in (key, order, *mutable)]
    picks = []
    if mutable:
        picks.append(F.max_by(F.struct(*mutable), order).alias("_m"))
    if frozen:
        picks.append(F.min_by(F.struct(*frozen), order).alias("_f"))
    rows = batch.groupBy(key).agg(*picks)
    return rows.select(key, *(["_m.*"] if mutable else []), *(["_f.*"] if frozen else []))


def upsert_keyed(
    base: DataFrame, batch: DataFrame, key: str, mutable: list[str], today: str, order: str
) -> DataFrame:
    """The base after a run's batch: new keys stamped, known keys refreshed in `mutable`.

    Base keys are unique and the batch is collapsed first, so no key is skewed in
    the join. A base bucketed by key joins without being shuffled.
    """
    news = collapse_batch(batch, key, mutable, order).withColumn("_hit", F.lit(True))
    old, new = base.alias("o"), news.alias("n")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    hit = F.col("n._hit").isNotNull()
    known = F.col("o.first_seen_date").isNotNull()
    day = F.lit(today).cast("date")

    def merged(c: str) -> Column:
        if c == key:
            return F.coalesce(f"o.{c}", f"n.{c}").alias(c)
        if c == "first_seen_date":
            return F.coalesce(F.col(f"o.{c}"), day).alias(c)
        if c == "last_seen_date":
            return F.when(hit, day).otherwise(F.col(f"o.{c}")).alias(c)
        fresh = hit if c in mutable else ~known
        return F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return joined.select(*[merged(c) for c in base.columns])


def collapse_sightings(
    batch: DataFrame, key: str, mutable: list[str], day: str, order: str, frozen: tuple[str, ...] = ()
) -> DataFrame:
    """One state row per key of a batch that may span several run days.

    First and last sighting, the mutable values of the newest (day, order) and the frozen ones of
    the oldest; `_order` and `_opened` keep those places for later merges.
    """
    at = F.struct(F.col(day), F.col(order))
    picks = [F.max_by(F.struct(*mutable, F.col(order).alias("_order")), at).alias("_v")]
    if frozen:
        picks.append(F.min_by(F.struct(*frozen, F.col(order).alias("_opened")), at).alias("_f"))
    seen = batch.groupBy(key).agg(
        F.min(day).alias("first_seen_date"), F.max(day).alias("last_seen_date"), *picks
    )
    return seen.select(key, *SEEN, "_v.*", *(["_f.*"] if frozen else []))


def merge_states(states: DataFrame, key: str, mutable: list[str], frozen: tuple[str, ...] = ()) -> DataFrame:
    """State rows of any number of batches to one per key; order of the batches is irrelevant."""
    newest = F.struct("last_seen_date", "_order")
    picks = [F.max_by(F.struct(*mutable, "_order"), newest).alias("_v")]
    if frozen:
        picks.append(F.min_by(F.struct(*frozen, "_opened"), F.struct("first_seen_date", "_opened")).alias("_f"))
    merged = states.groupBy(key).agg(
        F.min("first_seen_date").alias("first_seen_date"), F.max("last_seen_date").alias("last_seen_date"), *picks
    )
    return merged.select(key, *SEEN, "_v.*", *(["_f.*"] if frozen else []))


def new_keys(base: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Keys of the batch the base does not hold yet."""
    return batch.select(key).distinct().join(base.select(key), key, "left_anti")


def active(base: DataFrame, today: str, days: int = ACTIVE_DAYS) -> DataFrame:
    return base.where(F.col("last_seen_date") >= days_before(today, days))


def prune(base: DataFrame, today: str, keep_days: int) -> DataFrame:
    """Rows sighted within the window."""
    return base.where(F.col("last_seen_date") >= days_before(today, keep_days))


def pruned_count(base: DataFrame, today: str, keep_days: int) -> DataFrame:
    gone = F.col("last_seen_date") < days_before(today, keep_days)
    return base.agg(F.count_if(gone).alias("pruned"), F.count_if(~gone).alias("kept"))


def prune_orphans(history: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """History of keys still in the base."""
    return history.join(base.select(key), key, "left_semi")


def first_last_seen(sightings: DataFrame, key: str, day: str) -> DataFrame:
    """First and last sighting per key: the upserts of all runs in one aggregate, nothing pruned."""
    return sightings.groupBy(key).agg(
        F.min(day).alias("first_seen_date"), F.max(day).alias("last_seen_date")
    )


def _differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def change_log(sightings: DataFrame, key: str, day: str, order: str, value: str) -> DataFrame:
    """One row per (key, day) on which the value moved, with the day's last value.

    Sightings are reduced to one row per key and day first, so a key's window is
    bounded by the number of days, however often it is sighted. A day counts when
    its first value differs from the day before or any value inside differs.
    """
    cell = F.struct(F.col(value).alias("v"))  # a struct, so NULL values are kept
    daily = sightings.groupBy(key, day).agg(
        F.min_by(cell, order)["v"].alias("_first"),
        F.max_by(cell, order)["v"].alias("_last"),
        (
            _differs(F.min(value), F.max(value))
            | F.count(value).between(F.lit(1), F.count("*") - 1)
        ).alias("_moved"),
    )
    run = Window.partitionBy(key).orderBy(day)
    previous = F.lag(F.struct(F.col("_last").alias("v"))).over(run)
    logged = daily.withColumn("_prev", previous).where(
        F.col("_prev").isNull() | F.col("_moved") | _differs(F.col("_prev")["v"], F.col("_first"))
    )
    return logged.select(key, day, F.col("_last").alias(value))


def change_counts(
    sightings: DataFrame, key: str, day: str, order: str, value: str, chunk: int = 100_000
) -> DataFrame:
    """Per day, keys first sighted and values that moved, each move counted in sequence.

    `order` is unique, so a chunk of `chunk` consecutive orders bounds the rows any
    window sees; the moves between chunks come from their first and last values.
    """
    part = F.floor(F.col(order) / chunk).alias("_chunk")
    rows = sightings.select(key, day, part, order, value)
    inside = Window.partitionBy(key, day, "_chunk").orderBy(order)
    before = F.lag(F.struct(F.col(value).alias("v"))).over(inside)
    stepped = rows.withColumn("_before", before).withColumn(
        "_step", F.col("_before").isNotNull() & _differs(F.col("_before")["v"], F.col(value))
    )
    cell = F.struct(F.col(value).alias("v"))
    chunks = stepped.groupBy(key, day, "_chunk").agg(
        F.count_if("_step").alias("_moves"),
        F.min_by(cell, order).alias("_first"),
        F.max_by(cell, order).alias("_last"),
    )
    run = Window.partitionBy(key).orderBy(day, "_chunk")
    linked = chunks.withColumn("_prev", F.lag("_last").over(run))
    entered = F.col("_prev").isNotNull() & _differs(F.col("_prev")["v"], F.col("_first")["v"])
    return linked.groupBy(day).agg(
        F.count_if(F.col("_prev").isNull()).alias("inserted"),
        F.sum(F.col("_moves") + entered.cast("bigint")).alias("changes"),
    )


def at_first_date(history: DataFrame, key: str, day: str) -> DataFrame:
    """History rows at each key's own first date."""
    firsts = history.groupBy(key).agg(F.min(day).alias(day))
    return history.join(firsts, [key, day], "left_semi")


def attach_opening(
    rows: DataFrame, history: DataFrame, key: str, day: str, value: str, name: str
) -> DataFrame:
    """Adds the first recorded value where it differs from the current one; both must be non-zero."""
    opening = history.groupBy(key).agg(F.min_by(F.struct(F.col(value).alias("v")), day)["v"].alias("_open"))
    current = F.col(value)
    shown = F.when((F.col("_open") != 0) & (current != 0) & (F.col("_open") != current), F.col("_open"))
    return rows.join(opening, key, "left").withColumn(name, shown).drop("_open")
