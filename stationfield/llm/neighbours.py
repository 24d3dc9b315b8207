"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell of a grid: M Gaussian projections, each cut into steps of a
fixed width. A neighbour at distance r lies, in each projection, N(0, r) away from the query, so
the chance that it is in a given cell is a product of M normal probabilities. Each query visits the
cells of a table in falling order of that chance until the tables together reach `TARGET`. What the
visited cells hold is ranked by exact distance on the original vectors.

Fitted on a bounded sample: r only, from which the width follows. Every vector is indexed. Equal
vectors are indexed once. Cells are dealt to blocks of bounded size, a cell too large for one is
split over several, and a block returns a query's nearest only, so what leaves the blocks grows
with the queries and not with the pairs compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationfield.llm.common import hot_join, mixed, parts, stored

TABLES = 8
FOLDS = 8  # the same for any number of vectors: more would need more cells for the same success
TARGET = 0.97
WIDTH = 1.6  # in units of r
MOST_CELLS = 512  # of a table for a query
SAMPLE = 4000
SAMPLE_QUERIES = 200
#: Rows of the index in one block, and rows of a cell beyond which it is split.
BLOCK_ROWS = 20_000
CELL_ROWS = 5_000
#: Queries with too few neighbours found that are searched at a time, exactly.
EXACT_QUERIES = 512

_erf = np.frompyfunc(math.erf, 1, 1)


def _below(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(x / math.sqrt(2)).astype(float))


class Grids:
    """The projections of all tables: the same on every machine, as they follow from the sizes."""

    def __init__(self, dim: int, r: float) -> None:
        self.folds = FOLDS
        random = np.random.default_rng([dim, self.folds])
        self.axes = random.standard_normal((TABLES, self.folds, dim))
        self.r, self.width = r, WIDTH * r
        self.shift = random.random((TABLES, self.folds)) * self.width
        self.salt = random.integers(1, 2**63, (TABLES, self.folds)).astype(np.uint64) | np.uint64(1)

    def places(self, x: np.ndarray, table: int) -> np.ndarray:
        """Where vectors fall in the grid, in steps."""
        return (x @ self.axes[table].T + self.shift[table]) / self.width

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        hashed = (cells.astype(np.int64).view(np.uint64) * self.salt[table]).sum(axis=-1) + np.uint64(table)
        return mixed(hashed).view(np.int64)

    def probes(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, key) of the cells to visit, each query's in falling order of success."""
        place = self.places(x, table)
        home = np.floor(place)
        step = np.arange(-2, 3)
        edge = (home[:, :, None] + step - place[:, :, None]) * self.width / self.r
        chance = np.log(np.maximum(_below(edge + self.width / self.r) - _below(edge), 1e-300))
        total, cells = np.zeros((len(x), 1)), np.zeros((len(x), 1, 0), np.int8)
        for fold in range(self.folds):
            # the best whole cells begin with the best beginnings: no more of these need be kept
            both = (total[:, :, None] + chance[:, fold, None, :]).reshape(len(x), -1)
            best = np.argsort(-both, axis=1, kind="stable")[:, :MOST_CELLS]
            total = np.take_along_axis(both, best, 1)
            begun = np.take_along_axis(cells, (best // 5)[:, :, None], 1)
            cells = np.concatenate([begun, step[best % 5][:, :, None].astype(np.int8)], axis=2)
        each = 1 - (1 - TARGET) ** (1 / TABLES)
        before = np.cumsum(np.exp(total), axis=1) - np.exp(total)
        query, rank = np.nonzero(before < each)
        return query, self.keys(home[query].astype(np.int64) + cells[query, rank], table)


def _clean(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows that take part: no null, zero or non-finite vectors. Components may be of any number type."""
    v = F.col("v")
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~F.exists(v, wrong) & F.exists(v, lambda x: x != 0))
    return rows.withColumn("v", F.transform(v, lambda x: x + F.lit(0.0)))  # no negative zeros


def _matrix(values) -> np.ndarray:
    return np.array([np.frombuffer(x, np.float64) for x in values]) if len(values) else np.zeros((0, 1))


def _typical_distance(same: DataFrame, n_vectors: int, k: int) -> float:
    """A distance that most k-th neighbours stay within, from a bounded sample."""
    rows = same.orderBy(F.xxhash64("rep")).limit(SAMPLE).select("vector").collect()
    x = _matrix([r.vector for r in rows])
    q = x[:SAMPLE_QUERIES]
    d = np.sqrt(np.maximum((q**2).sum(1)[:, None] + (x**2).sum(1) - 2 * q @ x.T, 0))
    d.sort(axis=1)
    at = max(1, round(k * len(x) / max(1, n_vectors)))  # place 0 is the query itself
    near = d[:, min(at, d.shape[1] - 1)]
    return max(float(np.quantile(near, 0.9)), 1e-9)


def _index(same: DataFrame, grids: Grids) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector").to_pylist())
            for t in range(TABLES if len(x) else 0):
                keys = grids.keys(np.floor(grids.places(x, t)), t)
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("rep"), batch.column("vector")], ["cell", "rep", "vector"])

    return same.select("rep", "vector").mapInArrow(run, "cell bigint, rep bigint, vector binary")


def _probes(queries: DataFrame, grids: Grids) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                some = batch.slice(a, 64)
                x = _matrix(some.column("vector").to_pylist())
                for t in range(TABLES):
                    query, key = grids.probes(x, t)
                    yield pa.RecordBatch.from_arrays([pa.array(key), some.column("rep").take(pa.array(query))], ["cell", "query"])

    return queries.select("rep", "vector").mapInArrow(run, "cell bigint, query bigint")


def _nearest(q: np.ndarray, x: np.ndarray, reps: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of `x`, ties to the smaller rep, by exact distance."""
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    if len(d) > k:
        some = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        d, reps = d[some], reps[some]
    best = np.lexsort((reps, d))[:k]
    return reps[best], d[best]


FOUND = "query bigint, rep bigint, score double"


def _found(query: list[int], reps: list[np.ndarray], scores: list[np.ndarray]) -> pd.DataFrame:
    n = [len(r) for r in reps]
    return pd.DataFrame(
        {"query": np.repeat(np.array(query, np.int64), n), "rep": np.concatenate([*reps, np.empty(0, np.int64)]), "score": np.concatenate([*scores, np.empty(0)])}
    )


def _in_blocks(index: DataFrame, probes: DataFrame, queries: DataFrame, n_index: int, k: int) -> DataFrame:
    cells = stored(index.groupBy("cell").agg(F.count("*").alias("rows")).withColumn("cuts", F.ceil(F.col("rows") / CELL_ROWS)), "ann-cells")
    n_blocks = parts(n_index, BLOCK_ROWS)
    block = F.expr(f"cast(pmod(xxhash64(cell, cut), {n_blocks}) AS int)")
    large = cells.where("cuts > 1")
    placed = hot_join(index, large, "cell", "rows", n_index)
    placed = placed.withColumn("cut", F.expr("pmod(xxhash64(rep), coalesce(cuts, 1))")).select(block.alias("block"), "cell", "rep", "vector")
    asked = probes.join(cells, "cell").withColumn("cut", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1)))
    asked = asked.groupBy(block.alias("block"), "query").agg(F.collect_set("cell").alias("cells"))
    asked = asked.join(queries.select(F.col("rep").alias("query"), "vector"), "query")

    def rank(here: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(here) or not len(asking):
            return _found([], [], [])
        here = here.sort_values(["cell", "rep"], kind="stable")
        x, reps, cell = _matrix(here["vector"].tolist()), here["rep"].to_numpy(), here["cell"].to_numpy()
        out: tuple[list, list, list] = [], [], []
        for query, vector, wanted in zip(asking["query"], asking["vector"], asking["cells"], strict=True):
            wanted = np.sort(np.asarray(wanted))
            low, high = np.searchsorted(cell, wanted), np.searchsorted(cell, wanted, side="right")
            rows = np.concatenate([np.arange(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True)])
            _, first = np.unique(reps[rows], return_index=True)
            rows = rows[first]
            near, score = _nearest(np.frombuffer(vector, np.float64), x[rows], reps[rows], k)
            for column, value in zip(out, (query, near, score), strict=True):
                column.append(value)
        return _found(*out)

    return placed.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(rank, FOUND)


def _exactly(same: DataFrame, queries: list, k: int) -> DataFrame:
    """A bounded number of queries against all vectors, in blocks."""
    ids, x = [q.rep for q in queries], _matrix([q.vector for q in queries])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y, reps = _matrix(batch["vector"].tolist()), batch["rep"].to_numpy()
            near = [_nearest(q, y, reps, k) for q in x] if len(y) else []
            yield _found(ids if near else [], [n[0] for n in near], [n[1] for n in near])

    return same.select("rep", "vector").mapInPandas(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("score", "rep")
    return found.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def nearest(vectors: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """For each row for which `is_query(vec_id)` holds, its k nearest others: query_id, rank, vec_id, score.

    Score is the Euclidean distance in double precision; ties go to the smaller vec_id. Vectors that
    are null, zero, or have null or non-finite components take no part, as do ids that are null
    and vectors of another length than most. Rows alike in id and vector count once.
    """
    rows = _clean(vectors, vec_id, embedding)
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    empty = rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if sizes is None:
        return empty
    dim = sizes["dim"]
    rows = rows.where(F.size("v") == dim)
    # of equal vectors the k + 1 smallest ids are enough for any answer
    order = Window.partitionBy("v").orderBy("vec_id")
    few = rows.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    same = few.groupBy("v").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("ids"), pa.array([r.tobytes() for r in flat], pa.binary())], ["rep", "ids", "vector"])

    same = stored(same.select("rep", "ids", "v").mapInArrow(plain, "rep bigint, ids array<bigint>, vector binary"), "ann-vectors")
    asking = rows.where(is_query(F.col("vec_id"))).select("vec_id", "v").distinct()
    reps = few.groupBy("v").agg(F.min("vec_id").alias("rep"))
    n_rows = rows.count()
    n_asking = asking.groupBy("v").agg(F.count("*").alias("times"))
    named = stored(hot_join(asking, reps.join(n_asking, "v"), "v", "times", n_rows).select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query"), "times"), "ann-queries")
    wanted = named.groupBy("query").agg(F.count("*").alias("times"))
    queries = stored(same.join(wanted.select(F.col("query").alias("rep")), "rep"), "ann-query-vectors")

    n_vectors = same.count()
    grids = Grids(dim, _typical_distance(same, n_vectors, k))
    n_index = n_vectors * TABLES
    index = stored(_index(same, grids), "ann-index")
    found = stored(_best(_in_blocks(index, _probes(queries, grids), queries, n_index, k + 1), k + 1), "ann-found")
    counts = found.groupBy("query").agg(F.count("*").alias("n"))
    enough = min(k + 1, n_vectors)
    lacking = queries.join(counts.where(F.col("n") >= enough).select(F.col("query").alias("rep")), "rep", "left_anti").orderBy("rep")
    lacking = stored(lacking.select("rep", "vector"), "ann-lacking")
    while True:
        some = lacking.orderBy("rep").limit(EXACT_QUERIES).collect()
        if not some:
            break
        found = found.unionByName(_best(_exactly(same, some, k + 1), k + 1))
        lacking = lacking.where(F.col("rep") > some[-1].rep)
    found = stored(found.distinct(), "ann-all")
    spread = found.join(same.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    # k + 1 ids, the query's own among them, are enough for each query that shares the vector
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    spread = spread.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2 * (k + 1))
    lists = spread.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    answered = hot_join(named.drop("times"), stored(lists.join(wanted, "query"), "ann-lists"), "query", "times", n_rows)
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return answered.select("query_id", F.posexplode(others).alias("nth", "near")).select(
        "query_id", (F.col("nth") + 1).cast("int").alias("rank"), F.col("near.vec_id").alias("vec_id"), F.col("near.score").alias("score")
    )
