"""The k rows with the highest inner product of whole-number vectors, exactly.

Each component x becomes floor(scale * x). A few rows, far from one another, and the origin are
pivots; every row's distances to them are kept beside it. For a query q and a row v,
|q - v| >= |d(q, p) - d(v, p)| for every pivot p, and 2 <q, v> = |q|^2 + |v|^2 - |q - v|^2, so the
greatest of these lower bounds gives an upper bound of the score. The rows of a block are evaluated
in the order of their bounds until the next bound is below the k-th score found; it starts from
the scores of the pivots themselves.

Rows are dealt at random into blocks of about BLOCK, queries into blocks of about QUERIES; a task
holds one block of each at a time. Only the k best of a block leave it.

Vectors that are null, empty, or hold a null or non-finite component (also after scaling) take no
part. Vectors are compared with those of their own length. A null id is no query; as a candidate it comes
last among ties. Repeated ids are rows of their own: a query's own row alone is left out, and rows
of one id that are queries are ranked each for itself. Empty tables give no rows; extra columns
are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import stage

BLOCK, QUERIES = 2048, 1024  # rows and queries of a block, about
PIVOTS = 32
SAMPLE = 1024  # rows that pivots are chosen from
TURN = 128  # rows that are evaluated before the stopping rule is asked again
EXACT = 2.0**53  # sums of whole numbers below are exact in double precision


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(row, id, v): a number for each row that takes part, its id and its whole-number components."""
    v = F.transform(F.col(vector_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    usable = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter((F.size("v") > 0) & usable)
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "v")


def _matrix(values: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles that hold whole numbers."""
    return np.floor(np.asarray(values.flatten(), np.float64).reshape(len(values), -1))


def _fits(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all sums that distances and products of these rows need stay exact."""
    most = max(np.abs(a).max(initial=1), np.abs(b).max(initial=1))
    return 4 * a.shape[1] * most * most < EXACT


def choose_pivots(vectors: DataFrame, n: int = PIVOTS) -> dict[int, np.ndarray]:
    """For each length of vectors the origin and up to n rows of a bounded sample, each far from those before."""
    sample = vectors.orderBy(F.xxhash64("row")).limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    by_length: dict[int, list[np.ndarray]] = {}
    for x in sample:
        by_length.setdefault(len(x), []).append(np.floor(np.array(x.as_py(), np.float64)))
    out = {}
    for length, rows in by_length.items():
        m = np.array(rows)
        if not _fits(m, m):
            continue
        picked = [np.zeros(length)]
        far = (m * m).sum(1)
        while len(picked) <= n and far.max() > 0:
            picked.append(m[int(far.argmax())])
            far = np.minimum(far, ((m - picked[-1]) ** 2).sum(1))
        out[length] = np.array(picked)
    return out


def _to_pivots(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (m * m).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (m @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


_PACKED = pa.schema([
    ("block", pa.int64()), ("length", pa.int64()), ("row", pa.binary()), ("id", pa.binary()), ("no_id", pa.binary()),
    ("v", pa.binary()), ("far", pa.binary()),
])
_PACKED_DDL = "block long, length long, row binary, id binary, no_id binary, v binary, far binary"


def _pack(pivots: dict[int, np.ndarray]):
    """A block's rows as one row: ids, components and the table of distances to the pivots."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        block, length = (x.as_py() for x in key)
        m = _matrix(rows["v"].combine_chunks())
        table = _to_pivots(m, pivots[length]) if length in pivots and _fits(m, pivots[length]) else np.zeros((len(m), 0))
        ids = rows["id"].combine_chunks()
        values = [
            block, length, np.asarray(rows["row"], np.int64).tobytes(), np.asarray(ids.fill_null(0), np.int64).tobytes(),
            np.asarray(ids.is_null(), bool).tobytes(), m.tobytes(), table.tobytes(),
        ]
        return pa.table([pa.array([v], f.type) for v, f in zip(values, _PACKED, strict=True)], schema=_PACKED)

    return run


def _blocks(vectors: DataFrame, n: int, pivots: dict[int, np.ndarray]) -> DataFrame:
    block = F.pmod(F.xxhash64("row"), F.lit(n)).alias("block")
    rows = vectors.select(block, F.size("v").cast("long").alias("length"), "row", "id", "v")
    return rows.groupBy("block", "length").applyInArrow(_pack(pivots), _PACKED_DDL)


def _unpack(row: dict, side: str) -> tuple[np.ndarray, ...]:
    length = row["length"]
    v = np.frombuffer(row[f"{side}v"]).reshape(-1, length)
    return (
        np.frombuffer(row[f"{side}row"], np.int64), np.frombuffer(row[f"{side}id"], np.int64),
        np.frombuffer(row[f"{side}no_id"], bool), v, np.frombuffer(row[f"{side}far"]).reshape(len(v), -1),
    )


def best_of_block(q: np.ndarray, q_far: np.ndarray, own: np.ndarray, rows, k: int, floor: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores, rows evaluated) of the k best of a block for one query, ties to the smaller id.

    `own` marks the query's own row; `floor` is a score that k rows of the table are known to reach.
    """
    _, ids, no_id, v, far = rows
    norms = (v * v).sum(1)
    size = float(q @ q)
    lower = np.abs(far - q_far).max(1) if far.shape[1] else np.zeros(len(v))
    # room for the rounding of roots, well above it
    lower = np.maximum(lower - 1e-9 * (np.sqrt(norms) + np.sqrt(size)), 0)
    upper = (norms + size - lower * lower) / 2 + 1e-9 * (norms + size) + 0.5
    open_rows = np.flatnonzero((upper >= floor) & ~own)
    order = open_rows[np.argsort(-upper[open_rows], kind="stable")]
    places, scores, done = np.zeros(0, np.int64), np.zeros(0), 0
    while done < len(order) and upper[order[done]] >= floor:
        turn = order[done : done + TURN]
        done += len(turn)
        places, scores = np.concatenate([places, turn]), np.concatenate([scores, v[turn] @ q])
        best = np.lexsort((ids[places], no_id[places], -scores))[:k]
        places, scores = places[best], scores[best]
        if len(scores) == k:
            floor = max(floor, float(scores[-1]))
    return places, scores, done


def _best_exact(q: np.ndarray, own: np.ndarray, rows, k: int) -> tuple[list[int], list[int]]:
    """The same for components too large for double precision: whole numbers of any size, every row."""
    _, ids, no_id, v, _ = rows
    whole = [int(x) for x in q]
    score = [sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in v]
    best = sorted((i for i in range(len(v)) if not own[i]), key=lambda i: (-score[i], no_id[i], ids[i]))[:k]
    return best, [min(max(score[i], -(2**63)), 2**63 - 1) for i in best]


_FOUND = pa.schema([
    ("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64()),
])


def _search(k: int, pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                queries, rows = _unpack(row, "q_"), _unpack(row, "")
                bounded = queries[4].shape[1] == rows[4].shape[1] and _fits(queries[3], rows[3])
                out = []
                for n, q in enumerate(queries[3]):
                    own = rows[0] == queries[0][n]
                    if bounded:
                        # pivots are rows of the table: k of them other than the query set the first floor
                        known = pivots.get(row["length"], np.zeros((1, row["length"])))[1:]
                        known = np.sort(known[(known != q).any(1)] @ q)
                        floor = float(known[-k]) if len(known) >= k else -np.inf
                        places, scores, _ = best_of_block(q, queries[4][n], own, rows, k, floor)
                    else:
                        places, scores = _best_exact(q, own, rows, k)
                    for i, score in zip(places, scores, strict=True):
                        out.append((queries[0][n], queries[1][n], rows[0][i], None if rows[2][i] else rows[1][i], int(score)))
                if out:
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)

    return run


def top_k(
    table: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
    block: int = BLOCK, query_block: int = QUERIES, n_pivots: int = PIVOTS,
) -> DataFrame:
    """query_id, rank from 1, the id column and score: for each row that `queries`, a condition on `id`, holds for."""
    vectors = stage(whole_vectors(table, id_col, vector_col, scale), "vectors")
    asked = vectors.filter(F.col("id").isNotNull() & queries)
    n_rows, n_asked = vectors.count(), asked.count()
    pivots = choose_pivots(vectors, n_pivots)
    n_blocks, n_asked_blocks = -(-max(n_rows, 1) // block), -(-max(n_asked, 1) // query_block)
    rows = stage(_blocks(vectors, n_blocks, pivots), "blocks")
    sought = stage(_blocks(asked, n_asked_blocks, pivots), "query-blocks")
    sought = sought.select(*[F.col(x).alias(x if x == "length" else f"q_{x}") for x in sought.columns])
    # every block of queries visits every block of rows, which is where it is dealt to
    sought = sought.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    spread = min(n_blocks, 4096)
    pairs = rows.repartition(spread, "block").join(sought.repartition(spread, "block").hint("merge"), ["block", "length"])
    names = [x for x in pairs.columns if x not in ("block", "q_block")]
    found = pairs.select(names).mapInArrow(_search(k, pivots), "query_row long, query_id long, row long, id long, score long")
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
