"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws u from a hash of its id and gets the key -ln(u) / w, w its quality weight.
A source's documents are taken in ascending key order until its token budget is full. Complete
epochs come first; the order decides only the last, fractional one.

A source may hold any share of the rows, so its running total is never one task's work: keys are
counted in 4096 cells a source, the cell in which the budget ends is cut into 4096 again, and only
the documents of that small cell are summed one by one. What comes back is one cut a source. A
document that does not fit into what is left of the budget is passed by, and the search goes on
behind it in key order, among those that do, until none is left: then the gap is smaller than any
document not drawn. The smallest of these goes in too where that lands nearer, so a source ends
at most half of it away from its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import WORD, stage

CELLS = 4096
SEED = 42
MOST_EPOCHS = 3
WEIGHTS = (5, 2, 1)
#: Quality weights by label; documents without one get the last.
QUALITY = {1: 2.0, 0: 0.5, None: 1.0}


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target): shares of the total by weight.

    Sources in code point order, null last, take the weights in turn. A target stops at `most`
    times its source's size; the excess is shared again by weight until none is above. In order
    of size per weight, a source is full while the level of those behind it would exceed it; the
    first that is not sets the level for the rest. One row a source goes through these windows.
    """
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))
    ranked = sizes.withColumn("w", given).withColumn("full", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("place", F.row_number().over(W.orderBy(F.col("full") / F.col("w"), "source")))
    before = W.orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    behind = W.orderBy("place").rowsBetween(0, W.unboundedFollowing)
    whole = W.orderBy("place").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    levels = ranked.withColumn("level", left / F.sum("w").over(behind))
    open_ = F.when(F.col("level") * F.col("w") <= F.col("full"), F.struct("place", "level"))
    first = levels.withColumn("first", F.min(open_).over(whole))
    filled = F.coalesce(F.col("place") < F.col("first.place"), F.lit(True))
    share = F.least(F.col("full"), F.col("first.level") * F.col("w"))
    return first.select("source", "source_size", F.when(filled, F.col("full")).otherwise(share).alias("target"))


def _same_source(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, nulls equal; few sources make the right side small enough to broadcast by itself."""
    right = b.withColumnRenamed("source", "source_")
    return a.join(right, F.col("source").eqNullSafe(F.col("source_")), how).drop("source_")


def _open(step: Column) -> Column:
    """Whether a step may draw a row: it fits, and comes behind `past`, where there is one."""
    fits = (step["budget"] > 0) & (F.col("whole") <= step["budget"])
    return fits & (step["past"].isNull() | (F.struct("pos", "id") > step["past"]))


def _taken(step: Column) -> Column:
    """Whether a step draws a row: it may, and the row comes ahead of `cut`, where there is one."""
    return _open(step) & (step["cut"].isNull() | (F.struct("pos", "id") < step["cut"]))


def _inside(rows: DataFrame, at: DataFrame, width: float) -> DataFrame:
    """The rows that a step may draw, of the cell of its source that begins at `low`; the last one has its end, too."""
    end = F.col("low") + F.lit(width)
    within = (F.col("pos") >= F.col("low")) & ((F.col("pos") < end) | (end >= 1))
    return _same_source(rows, at).filter(_open(F.struct("budget", "past")) & within)


def _edges(rows: DataFrame, width: float) -> DataFrame:
    """Of each source the cell of `width` in which its budget ends, `low` its start, `passed` what lies before it.

    Where there is room for all, both are null, and `got` is the sum of all.
    """
    cell = F.least(F.floor((F.col("pos") - F.col("low")) / F.lit(width)), F.lit(CELLS - 1)).cast("int")
    step = ["source", "budget", "past", "passed", "low"]
    sums = rows.groupBy(*step, cell.alias("cell")).agg(F.sum("size").alias("s"))
    total = sums.withColumn("total", F.col("passed") + F.sum("s").over(W.partitionBy("source").orderBy("cell")))
    over = F.when(F.col("total") > F.col("budget"), F.struct("cell", (F.col("total") - F.col("s")).alias("passed")))
    found = total.groupBy(*step).agg(F.min(over).alias("edge"), F.max("total").alias("got"))
    low = F.col("low") + F.col("edge.cell") * F.lit(width)
    return found.select("source", "budget", "past", F.col("edge.passed").alias("passed"), low.alias("low"), "got")


def _cuts(rows: DataFrame, at: DataFrame) -> DataFrame:
    """(source, budget, past, cut, got): the first (pos, id) that the budget has no room for, and what lies before it."""
    order = W.partitionBy("source").orderBy("pos", "id")  # rows that repeat an id stand together
    sums = F.sum("size").over(order.rangeBetween(W.unboundedPreceding, W.currentRow))
    total = _inside(rows, at, 1 / CELLS**2).withColumn("total", F.col("passed") + sums)
    room = F.col("total") <= F.col("budget")
    return total.groupBy("source", "budget", "past").agg(
        F.min(F.when(~room, F.struct("pos", "id"))).alias("cut"), F.coalesce(F.max(F.when(room, F.col("total"))), F.max("passed")).alias("got")
    )


def _draw(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, steps, got): the steps (budget, past, cut) of each source that draws, and the words they draw.

    A step draws the rows of `_taken`, up to the first that has no room. The next step has what is
    left of the budget and looks behind that row, at those alone that fit by themselves. A source is
    done when a step finds room for all; every step passes one document a source, and leaves out all
    that are longer than the rest of the budget. Each pass over the rows joins one small table, since
    every table that is sent takes memory of the driver.
    """
    place = rows.schema["pos"].dataType.simpleString()
    row = f"struct<pos:{place},id:bigint>"
    none = F.lit(None).cast(row)
    steps = rows.sparkSession.createDataFrame([], f"source string, budget long, past {row}, cut {row}, got long")
    now = budgets.select("source", "budget", none.alias("past"))
    while True:
        now = now.withColumns({"passed": F.lit(0).cast("long"), "low": F.lit(0.0).cast("double")})
        first = stage(_edges(_inside(rows, now, 1.0), 1 / CELLS), "edge")
        if first.isEmpty():
            drawn = F.collect_list(F.struct("budget", "past", "cut"))
            return steps.groupBy("source").agg(drawn.alias("steps"), F.sum("got").alias("got"))
        second = stage(_edges(_inside(rows, first.filter("low IS NOT NULL").drop("got"), 1 / CELLS), 1 / CELLS**2), "edge")
        rest = first.filter("low IS NULL").select("source", "budget", "past", none.alias("cut"), "got")
        step = stage(_cuts(rows, second.drop("got")).unionByName(rest), "step")
        steps = steps.unionByName(step)
        now = step.filter("cut IS NOT NULL").select("source", (F.col("budget") - F.col("got")).alias("budget"), F.col("cut").alias("past"))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row for each row of `docs`: doc_id, source, size, source_size, target, epochs, copies, taken.

    size: words of the whole text (null: 0). epochs: complete passes over the source; copies:
    epochs plus one if the sample holds the document; taken: copies * size. `quality` has
    (doc_id, quality); a doc_id with several labels counts with their mean, rounded. Keys depend
    on doc_id and `seed` alone, so reruns agree; rows that repeat a doc_id are taken together. A
    null doc_id is an id of its own, a null source the last source, an empty table gives no rows.
    """
    base = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count().alias("size"))
    weight = F.lit(QUALITY[None])
    if quality is not None:
        label = quality.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.round(F.avg("quality")).alias("label"))
        base = base.join(label, base.doc_id == label.labelled, "left").drop("labelled")
        weight = F.when(F.col("label") == 1, QUALITY[1]).when(F.col("label") == 0, QUALITY[0]).otherwise(QUALITY[None])
    id_ = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    u = (F.shiftrightunsigned(F.xxhash64(id_, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    # 1 - exp(-key) has the keys' order and lies between 0 and 1
    rows = stage(base.select("doc_id", "source", "size", id_.alias("id"), (1 - F.pow(u, 1 / weight)).alias("pos")), "keys")
    # rows that repeat an id are drawn together, so they have to fit together
    again = rows.groupBy(F.col("source").alias("of"), F.col("id").alias("same")).agg(F.sum("size").alias("sum"), F.count(F.lit(1)).alias("n"))
    again = stage(again.filter("n > 1").drop("n"), "again")
    rows = rows.join(again, F.col("source").eqNullSafe(F.col("of")) & (F.col("id") == F.col("same")), "left")
    rows = stage(rows.select("doc_id", "source", "size", "id", "pos", F.coalesce("sum", "size").alias("whole")), "units")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets(sizes, weights, most).withColumn("epochs", full.cast("long"))
    plan = stage(plan.withColumn("budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size"))), "targets")

    gap = F.col("budget") - F.coalesce("got", F.lit(0))
    plan = stage(_same_source(plan, _draw(rows, plan), "left").withColumn("gap", gap).drop("budget", "got"), "steps")
    known = _same_source(rows, plan).withColumn("drawn", F.coalesce(F.exists("steps", _taken), F.lit(False)))
    off = F.col("whole") - F.col("gap")
    rest = known.filter(~F.col("drawn") & (F.col("gap") > 0)).filter(off < F.col("gap"))
    best = rest.groupBy("source").agg(F.min(F.struct("whole", "pos", "id")).alias("best"))
    best = stage(best.select("source", F.col("best.id").alias("chosen")), "best")
    known = _same_source(known, best, "left").withColumn("drawn", F.col("drawn") | F.coalesce(F.col("id") == F.col("chosen"), F.lit(False)))
    copies = F.col("epochs") + F.when(F.col("drawn"), 1).otherwise(0)
    return known.select(
        "doc_id", "source", "size", "source_size", "target", "epochs", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_rows(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The rows of `docs`, all columns, each as often as the mix takes it."""
    chosen = mix(docs, quality, **options).filter("copies > 0")
    chosen = chosen.select(F.col("doc_id").alias("id"), F.col("source").alias("of"), "copies").distinct()
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("m.id")) & F.col("d.source").cast("string").eqNullSafe(F.col("m.of"))
    met = docs.alias("d").join(chosen.alias("m"), same)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("m.copies").cast("long")))
    return met.select(*[F.col(f"d.{c}") for c in docs.columns], times.alias("pass__")).drop("pass__")
