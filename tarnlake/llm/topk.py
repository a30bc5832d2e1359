"""Exact top-k search by sorted lists alone (Fagin's no-random-access algorithm).

The rows are dealt out in shards. In a shard a block of rows has a list per component, sorted by
value; a query reads a list from the end that its own component favours, since a product falls
with the value from there on. What it knows of a row at some depth is exact where the row was
met and lies between the list's current and its last value where not, which gives an upper and
a lower bound of the score. Half of what is unread of every list is read at a time, for many
queries at once. A query stops when so few rows can still reach the k best known lower bounds
that their scores are resolved; best scores of one block are a bound to the next ones.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import prepare, stored

SCALE = 1024
#: Rows of a shard and queries that meet it in one task, about.
SHARD_ROWS, QUERY_ROWS = 4096, 4096
#: Rows of a block with its own sorted lists, and queries that read them at the same time.
BLOCK, BATCH = 1024, 1024
#: A query's scores are resolved when this part of a block, or fewer rows, can still qualify.
RESOLVE_PART = 32
#: Resolved (query, row) pairs at a time.
PAIRS = 1 << 16

_RESULT = "query_no long, query_id long, vec_id long, score long"


def quantised(vectors: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` as doubles, which hold it exactly."""
    return np.floor(SCALE * vectors)


class Lists:
    """The sorted lists of a block of vectors, read to a depth from both ends.

    ``upper`` holds for either end and every row and component the value that was read, or the
    value reached where the row is still to come; ``lower`` has a list's last value there.
    """

    def __init__(self, x: np.ndarray):
        self.x, self.depth = x, 0
        self.order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, self.order, axis=0)
        first, last = np.broadcast_to(self.sorted[0], x.shape), np.broadcast_to(self.sorted[-1], x.shape)
        self.upper = np.concatenate([last, first], axis=1)
        self.lower = np.concatenate([first, last], axis=1)

    def read(self) -> None:
        """Half of the unread entries of every list (all, if few are left), from either end."""
        n, width = self.x.shape
        end = self.depth + max(n - self.depth >> 1, min(n - self.depth, max(1, n // RESOLVE_PART)))
        at = np.arange(width)
        falling, falling_values = self.order[::-1], self.sorted[::-1]
        for side, (order, values) in enumerate(((falling, falling_values), (self.order, self.sorted))):
            columns = at + side * width
            met, seen = order[self.depth : end], values[self.depth : end]
            self.upper[order[end:], columns] = values[end - 1]
            self.upper[met, columns] = seen
            self.lower[met, columns] = seen
        self.depth = end


def _best(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """Of (query, row, id, score) arrays the ``k`` highest scores of a query, ties by id, null ids (-1 rows) last."""
    query, row, order_id, score = (np.concatenate(c) for c in zip(*found))
    # Object scores (beyond 2^53) sort as such.
    order = np.lexsort((row, order_id, query)) if score.dtype == object else np.lexsort((row, order_id, -score, query))
    if score.dtype == object:
        order = np.array(sorted(order.tolist(), key=lambda i: (query[i], -score[i])), dtype=np.int64)
    query, row, order_id, score = query[order], row[order], order_id[order], score[order]
    starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.empty(0, np.int64)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    keep = place < k
    return query[keep], row[keep], order_id[keep], score[keep]


def shard_top_k(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, row, order of its id, score) of the best ``k`` rows of a shard for every query.

    ``ids`` and ``query_ids`` are numbers that order the ids; a row with the query's own id is
    no candidate, except for -1, which stands for no id in ``query_ids``.
    """
    turn = np.argsort(ids, kind="stable")
    both = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
    floors = np.full(len(queries), -np.inf, dtype=queries.dtype)
    kept: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(x), BLOCK):
        rows = turn[at : at + BLOCK]
        found = _block_top_k(x[rows], ids[rows], queries, both, query_ids, floors, k)
        kept = [_best([*kept, *((q, rows[r], ids[rows[r]], s) for q, r, s in found)], k)]
        full = np.flatnonzero(np.bincount(kept[0][0], minlength=len(queries)) == k)
        last = np.searchsorted(kept[0][0], full, "right") - 1
        floors[full] = kept[0][3][last]
    return kept[0]


def _block_top_k(x, ids, queries, both, query_ids, floors, k):
    """(query, row, score) arrays of all rows of a block that may be among the ``k`` best."""
    lists, found = Lists(x), []
    limit = max(k, len(x) // RESOLVE_PART)
    first, end = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    active, floor = np.arange(len(queries)), floors.copy()
    while len(active):
        lists.read()
        going = []
        for batch in np.array_split(active, math.ceil(len(active) / BATCH)):
            upper = both[batch] @ lists.upper.T
            for i in np.flatnonzero(first[batch] < end[batch]).tolist():
                upper[i, first[batch[i]] : end[batch[i]]] = -np.inf
            if len(x) > k:
                # The lower bounds of any k rows bound the k-th best score; those of the leaders are high.
                leaders = np.argpartition(upper, -k, axis=1)[:, -k:]
                lower = (lists.lower[leaders] * both[batch][:, None, :]).sum(axis=2)
                lower[np.take_along_axis(upper, leaders, 1) == -np.inf] = -np.inf
                floor[batch] = np.maximum(floor[batch], lower.min(axis=1))
            open_ = (upper >= floor[batch][:, None]) & (upper > -np.inf)
            done = (open_.sum(axis=1) <= limit) | (lists.depth == len(x))
            query, row = np.nonzero(open_ & done[:, None])
            query = batch[query]
            for part in range(0, len(query), PAIRS):
                q, r = query[part : part + PAIRS], row[part : part + PAIRS]
                found.append((q, r, (x[r] * queries[q]).sum(axis=1)))
            going.append(batch[~done])
        active = np.concatenate(going)
    return found


def _numbers(column, null: int) -> np.ndarray:
    return column.fill_null(null).to_numpy() if column.null_count else column.to_numpy()


def _search(group: pa.Table, k: int) -> pa.Table:
    """The ``k`` best rows of a shard for each query that meets it."""
    group = group.combine_chunks()
    asks = np.asarray(group.column("query_no").combine_chunks().is_valid())
    width = len(group.column("vector")[0])
    flat = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = quantised(flat.astype(np.float64).reshape(-1, width)) if width else np.zeros((len(group), 1))
    most = np.abs(vectors).max(initial=0)
    if most * most * max(width, 1) >= 2.0**53:
        vectors = np.array([[int(v) for v in row] for row in vectors.tolist()], dtype=object)
    given = np.asarray(group.column("vec_id").combine_chunks().fill_null(0))
    null = ~np.asarray(group.column("vec_id").combine_chunks().is_valid())
    # Ids as ranks: null ids come last, and as a query's id are nobody's.
    known = np.unique(given[~null])
    ranks = np.where(null, len(known), np.searchsorted(known, given))
    rows, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
    if not len(rows) or not len(queries):
        empty = pa.array([], pa.int64())
        return pa.table({"query_no": empty, "query_id": empty, "vec_id": empty, "score": empty})
    query_ids = np.where(null[queries], -1, ranks[queries])
    query, row, _, score = shard_top_k(vectors[rows], ranks[rows], vectors[queries], query_ids, k)
    numbers = group.column("query_no").combine_chunks().take(pa.array(queries[query]))
    ids = group.column("vec_id").combine_chunks()
    scores = pa.array([int(s) for s in score] if score.dtype == object else score.astype(np.int64), pa.int64())
    return pa.table({"query_no": numbers, "query_id": ids.take(pa.array(queries[query])), "vec_id": ids.take(pa.array(rows[row])), "score": scores})


def _usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    vector = F.col(f"`{vector_column}`")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(vector.isNotNull() & finite).select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), vector.alias("vector"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): each query's ``k`` best rows of ``vectors``.

    The score is the inner product of the vectors' components, each taken as
    ``floor(SCALE * x)``; ranks go from 1, equal scores by ``vec_id``, null ids last. All rows
    are candidates (fewer than ``k``: all are returned) but those with the query's own id.

    Vectors that are null or hold a null or non-finite component take no part; a query meets
    only vectors of its length, and empty vectors score 0. Every row of ``queries`` is a query
    of its own, so repeated ones are answered each; repeated rows of ``vectors`` are found each.
    Scores beyond 64 bits raise an error. Other columns are not read. No rows or no queries: no
    result.

    Rows are dealt out by number, whatever their values: every task has one shard and one part
    of the queries, and sends on ``k`` rows for each of these.
    """
    prepare(vectors.sparkSession)
    kinds = [dict(df.dtypes)[vector_column] for df in (vectors, queries)]
    kind = kinds[0] if kinds[0] == kinds[1] else "array<double>"
    rows = _usable(vectors, id_column, vector_column).withColumn("query_no", F.lit(None).cast("long"))
    asked = _usable(queries, id_column, vector_column).withColumn("query_no", F.monotonically_increasing_id())
    both = rows.unionAll(asked).withColumn("vector", F.col("vector").cast(kind))
    both = both.withColumn("length", F.size("vector")).withColumn("row", F.monotonically_increasing_id())
    both = stored(both, "topk-rows")
    counts = both.agg(F.count("query_no").alias("queries"), F.count(F.lit(1)).alias("all")).first()
    shards = max(1, math.ceil((counts["all"] - counts["queries"]) / SHARD_ROWS))
    parts = max(1, math.ceil(counts["queries"] / QUERY_ROWS))
    every = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    place = F.xxhash64("row")
    is_query = F.col("query_no").isNotNull()
    cells = both.withColumn("shard", F.explode(F.when(is_query, every(shards)).otherwise(F.array(F.pmod(place, F.lit(shards)).cast("int")))))
    cells = cells.withColumn("part", F.explode(F.when(is_query, F.array(F.pmod(place, F.lit(parts)).cast("int"))).otherwise(every(parts))))
    found = (
        cells.select("length", "shard", "part", "query_no", "vec_id", "vector")
        .groupBy("length", "shard", "part")
        .applyInArrow(lambda g: _search(g, k), _RESULT)
    )
    best = Window.partitionBy("query_no").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = stored(found, "topk-found").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores) WHERE place <= 10
"""
