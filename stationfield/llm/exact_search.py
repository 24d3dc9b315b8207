"""Exact top-k by inner product: columnar branch and bound.

Components become whole numbers. Queries and candidates are dealt to parts of bounded size, and
each pair of parts is one group: no group grows with the table, and a group sends on a query's k best
only. In a group the candidates lie vertically, one row for each dimension, dimensions with much mass first.
Scores of a strip of candidates are accumulated block by block of dimensions. After a block, what
the others can still add is at most the product of the remaining lengths of query and candidate
(Cauchy-Schwarz). A candidate that cannot reach the k-th best score of its query so far is dropped: as long as
many survive, whole rows or columns that nobody needs go; once few do, the survivors are compacted to a list of
pairs, for which alone the next blocks are accumulated.

All sums are exact: in doubles while no sum can exceed 2^53, else in Python's whole numbers, without bounds.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationfield.llm.common import parts, stored

SCALE = 256
#: Rows of a part; a group holds one part of each.
QUERY_ROWS = 2048
CANDIDATE_ROWS = 16_384
#: Queries and candidates scored at a time, and dimensions accumulated between two prunings.
QUERIES_AT_ONCE = 256
STRIP = 2048
BLOCK = 16
#: Pairs are listed one by one when at most this part of a strip survives.
SPARSE = 0.1
#: Components of at least this size have no whole number as a long.
LARGEST = float(1 << 63) / SCALE
LONG = (-(1 << 63), (1 << 63) - 1)

FOUND = "query bigint, vec_id bigint, score bigint"


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x, the components as whole numbers, of the rows that take part.

    Left out are null ids and vectors, vectors with null or non-finite components or with one whose
    whole number is no long, and vectors of another length than most (of lengths equally frequent, the
    least stays); empty vectors too. Rows alike in id and vector count once.
    """
    v = F.col("v")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, fits))
    return rows.select("vec_id", F.transform(v, lambda c: F.floor(c * SCALE).cast("bigint")).alias("x")).distinct()


def _best(row: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the k best of their row: highest scores first, ties to the smaller id."""
    order = np.lexsort((vec_id, -score, row))
    ranked = row[order]
    start = np.searchsorted(ranked, ranked)
    return order[np.arange(len(order)) - start < k]


class _Top:
    """The k best of each query so far, and the score that a further candidate must reach."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.row, self.score, self.vec_id = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.reach = np.full(n_queries, -np.inf)

    def add(self, row: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        row, score, vec_id = np.concatenate([self.row, row]), np.concatenate([self.score, score]), np.concatenate([self.vec_id, vec_id])
        kept = _best(row, score, vec_id, self.k)
        self.row, self.score, self.vec_id = row[kept], score[kept], vec_id[kept]
        full = np.flatnonzero(np.bincount(self.row, minlength=len(self.reach)) == self.k)
        last = np.searchsorted(self.row, full, side="right") - 1
        self.reach[full] = self.score[last]


def _rest(x: np.ndarray, blocks: list[slice]) -> np.ndarray:
    """Length of each row of `x` from each block on, rounded up; one entry more, 0, after the last."""
    squares = np.stack([(x[:, b] ** 2).sum(axis=1) for b in blocks] + [np.zeros(len(x))])
    return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1]) * (1 + 1e-12)


def _first_reach(partial: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """The k-th best of whole scores in each row, but for the query's own; -inf with fewer."""
    if partial.shape[1] < k:
        return np.full(len(partial), -np.inf)
    free = np.where(own, -np.inf, partial)
    return np.partition(free, -k, axis=1)[:, -k]


def search(q: np.ndarray, q_id: np.ndarray, c: np.ndarray, c_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, score, id) of the k best candidates of each query, its own id left out. Doubles that hold whole numbers."""
    dim = q.shape[1]
    order = np.argsort(-(c**2).sum(axis=0) * (q**2).sum(axis=0), kind="stable")
    q, across = q[:, order], np.ascontiguousarray(c[:, order].T)
    blocks = [slice(a, min(a + BLOCK, dim)) for a in range(0, dim, BLOCK)]
    rest_q, rest_c = _rest(q, blocks), _rest(across.T, blocks)
    tops = []
    for a in range(0, len(q), QUERIES_AT_ONCE):
        some = np.arange(a, min(a + QUERIES_AT_ONCE, len(q)))
        top = _Top(len(some), k)
        for b in range(0, across.shape[1], STRIP):
            _strip(top, q, q_id, across, c_id, rest_q, rest_c, blocks, some, np.arange(b, min(b + STRIP, across.shape[1])))
        tops.append((some[top.row], top.score, top.vec_id))
    return tuple(np.concatenate(x) for x in zip(*tops, strict=True)) if tops else (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))


def _strip(top, q, q_id, across, c_id, rest_q, rest_c, blocks, rows, columns) -> None:
    """Score the candidates `columns` for the queries `rows` and put into `top` what can be among the best."""
    first = np.isneginf(top.reach).any()
    local = np.arange(len(rows))  # the queries of `partial`, in numbers of `top`
    partial = np.zeros((len(rows), len(columns)))
    pairs = None
    for n, block in enumerate(blocks):
        if pairs is None:
            partial += q[rows, block] @ across[block, columns]
            if first:  # nothing to be compared with yet: whole scores of one strip make a start
                continue
            alive = partial + rest_q[n + 1][rows][:, None] * rest_c[n + 1][columns] >= top.reach[local][:, None]
            if np.count_nonzero(alive) <= SPARSE * alive.size:
                i, j = np.nonzero(alive)
                pairs = local[i], rows[i], columns[j], partial[i, j]
            else:
                in_rows, in_columns = alive.any(axis=1), alive.any(axis=0)
                if not (in_rows.all() and in_columns.all()):
                    local, rows, columns = local[in_rows], rows[in_rows], columns[in_columns]
                    partial = partial[np.ix_(in_rows, in_columns)]
        else:
            at, row, column, score = pairs
            for d in range(block.start, block.stop):
                score = score + q[row, d] * across[d, column]
            on = score + rest_q[n + 1][row] * rest_c[n + 1][column] >= top.reach[at]
            pairs = at[on], row[on], column[on], score[on]
    if pairs is None:
        reach = top.reach[local]
        if first:
            reach = np.maximum(reach, _first_reach(partial, q_id[rows][:, None] == c_id[columns], top.k))
        i, j = np.nonzero(partial >= reach[:, None])
        pairs = local[i], rows[i], columns[j], partial[i, j]
    at, row, column, score = pairs
    other = q_id[row] != c_id[column]
    top.add(at[other], score[other], c_id[column[other]])


def _plainly(q: np.ndarray, q_id: np.ndarray, c: np.ndarray, c_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for numbers of any size; a score beyond a long counts as the nearest long."""
    out: list[list] = [[], [], []]
    whole = c.astype(object)
    for row, (one, own) in enumerate(zip(q.astype(object), q_id.tolist(), strict=True)):
        scored = sorted((-min(max(s, LONG[0]), LONG[1]), i) for s, i in zip((whole @ one).tolist(), c_id.tolist(), strict=True) if i != own)
        for s, i in scored[:k]:
            for column, value in zip(out, (row, -s, i), strict=True):
                column.append(value)
    return tuple(np.array(x, np.int64) for x in out)


def nearest(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """For each row for which `is_query(vec_id)` holds, the k candidates of highest inner product:
    query_id, rank, vec_id, score. Candidates are all rows with another id; ties go to the smaller id.

    Each distinct vector of an id is a query, and of a candidate's vectors the best counts
    with its others behind it. No rows or no queries give an empty table.
    """
    rows = stored(whole_vectors(vectors, vec_id, embedding), "search-vectors")
    sizes = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim = sizes["dim"]
    rows = rows.where(F.size("x") == dim)
    # A query's number is its place in the written table.
    queries = stored(rows.where(is_query(F.col("vec_id"))).withColumn("query", F.monotonically_increasing_id()), "search-queries")
    n_candidates = parts(sizes["count"], CANDIDATE_ROWS)
    n_queries = parts(queries.count(), QUERY_ROWS)

    def part(n: int) -> Column:
        return F.expr(f"cast(pmod(xxhash64(vec_id, x), {n}) AS int)")

    def each(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    asking = queries.select("query", "vec_id", "x", part(n_queries).alias("of_queries"), each(n_candidates, "of_candidates"))
    given = rows.select("vec_id", "x", part(n_candidates).alias("of_candidates"), each(n_queries, "of_queries"))
    key = ["of_queries", "of_candidates"]

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        flat = column.combine_chunks()
        return flat.flatten().to_numpy().reshape(-1, dim)

    def group(ask: pa.Table, have: pa.Table) -> pa.Table:
        ids = ask["query"].to_numpy()
        if not ask.num_rows or not have.num_rows:
            row, score, found = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        else:
            q, c, q_id, c_id = matrix(ask["x"]), matrix(have["x"]), ask["vec_id"].to_numpy(), have["vec_id"].to_numpy()
            largest = [max(abs(int(x.min())), abs(int(x.max()))) for x in (q, c)]
            # squared lengths of either side must be exact as well
            exact = dim * max(largest) ** 2 < 1 << 53
            row, score, found = search(q.astype(float), q_id, c.astype(float), c_id, k) if exact else _plainly(q, q_id, c, c_id, k)
        return pa.table({"query": pa.array(ids[row], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score.astype(np.int64), pa.int64())})

    found = asking.groupBy(*key).cogroup(given.groupBy(*key)).applyInArrow(group, FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = queries.select("query", F.col("vec_id").alias("query_id"))
    return ranked.join(named, "query").select("query_id", "rank", "vec_id", "score")
