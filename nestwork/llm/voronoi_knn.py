"""Exact top-k search (operator 10): a Voronoi kNN join on pivots.

The largest inner product becomes the nearest neighbour in one more dimension: data vectors x
turn into (x, sqrt(M - |x|^2)) with M the largest squared norm, queries into (q, 0).  Data
and queries are grouped by their nearest of at most ``MAX_PIVOTS`` pivots (a documented,
hashed sample of rows; it steers work, not results).  Summaries of each group are its size,
radii and the k + 1 rows nearest to its pivot (of which one may be the query itself, and is
left out for it).  From them each query gets an upper bound
for its k-th distance and, by the triangle inequality and the bisecting planes, a lower bound
for each group; only groups that may hold an answer are searched.  Such groups are cut into
blocks, met by the queries that need them, and solved there by one matrix product; the best k
of all blocks are the answer.  Queries, not data, are copied to the groups: they are the
smaller side, and a group with a third of all rows is just more blocks.

Scores are exact integers: products use doubles only while every sum stays below 2^53, and
Python integers where a sum may leave a long (such scores are cut to the range of a long).

Defined cases: vectors that are null, or hold null or non-finite components, and rows with a
null vec_id take no part; vectors of unequal lengths are filled up with zeros; every row is
told apart by its place, so every row but the query's own is a candidate, repeated rows and
rows with the query's vec_id too, as often as they occur, and a vec_id that repeats is as many
queries, each with its own ranks; ties go to the smaller vec_id; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

K = 5
SCALE = 256
QUERY_STEP = 50
#: Bound of the pivot sample.
MAX_PIVOTS = 256
#: Rows of a block of data, and of queries that meet it.
BLOCK = 2048


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, integer vector ``v`` and number ``row`` of all rows that take part; write it before it is read twice."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        "vec_id", v.alias("v"), F.monotonically_increasing_id().alias("row"))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of an array column as an integer matrix, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` with all rows of ``b``."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2.0 ** 62:
        return a @ b.T
    limits = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, limits.min, limits.max).astype(np.int64)


def _assigner(pivots: np.ndarray, top: float, data: bool) -> Callable:
    """Distances to the pivots: for data the nearest and its distance, for queries all of them."""
    dims = pivots.shape[1]
    p = pivots.astype(np.float64)
    lift_p = np.sqrt(np.maximum(top - (p * p).sum(1), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dims).astype(np.float64)
            norm = (x * x).sum(1)
            if data:
                lift = np.sqrt(np.maximum(top - norm, 0))
                square = 2 * top - 2 * (x @ p.T + lift[:, None] * lift_p[None, :])
            else:
                square = norm[:, None] + top - 2 * (x @ p.T)
            dist = np.sqrt(np.maximum(square, 0))
            if data:
                near = dist.argmin(1)
                new = {"grp": pa.array(near.astype(np.int32)), "dist": pa.array(dist[np.arange(len(near)), near])}
            else:
                new = {"dists": pa.array(list(dist), pa.list_(pa.float64()))}
            kept = ["vec_id", "v", "row"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *new.values()], names=[*kept, *new])

    return run


def _router(pivots: np.ndarray, top: float, groups: dict[int, tuple], k: int) -> Callable:
    """For each query the groups that may hold one of its answers."""
    p = pivots.astype(np.float64)
    lift = np.sqrt(np.maximum(top - (p * p).sum(1), 0))
    between = np.sqrt(np.maximum(2 * top - 2 * (p @ p.T + lift[:, None] * lift[None, :]), 0))
    names = np.array(sorted(groups), np.int64)
    low = np.array([groups[g][0] for g in names])
    high = np.array([groups[g][1] for g in names])
    owner = np.concatenate([np.full(len(groups[g][2]), i) for i, g in enumerate(names)]) if len(names) else np.empty(0, int)
    small = np.concatenate([groups[g][2] for g in names]) if len(names) else np.empty(0)
    whose = np.concatenate([groups[g][4] for g in names]) if len(names) else np.empty(0, int)
    slack = 1e-6 * (1 + math.sqrt(top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, to = [], []
            length = np.sqrt((_matrix(batch.column("v"), p.shape[1]).astype(np.float64) ** 2).sum(1))
            vast = length * math.sqrt(top)  # no score of a query is larger
            for n, (query, dists) in enumerate(zip(batch.column("row").to_pylist(), batch.column("dists").to_pylist())):
                d = np.array(dists)
                near = int(d.argmin())
                bounds = (d[names[owner]] + small)[whose != query]
                limit = np.partition(bounds, k - 1)[k - 1] if len(bounds) >= k else math.inf
                if vast[n] >= 2.0 ** 60:  # scores may be cut to a long and then tie
                    limit = math.inf
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (d[names] ** 2 - d[near] ** 2) / (2 * between[near, names])
                plane = np.where(between[near, names] > slack, plane, 0)
                least = np.maximum(np.maximum(d[names] - high, low - d[names]), plane)
                hit = names[least <= limit + slack]
                rows.append(np.full(len(hit), n))
                to.append(hit)
            at = pa.array(np.concatenate(rows) if rows else np.empty(0, int))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(at), batch.column("v").take(at), batch.column("row").take(at),
                 pa.array((np.concatenate(to) if to else np.empty(0)).astype(np.int32))],
                names=["query_id", "v", "query_row", "grp"])

    return run


def _solver(dims: int, k: int) -> Callable:
    """The best k of one block for each query that meets it."""

    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        ids = data.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, row_of = ids[order], data.column("row").to_numpy()[order]
        asked, asking = queries.column("query_id").to_numpy(), queries.column("query_row").to_numpy()
        n, rows, who, cols, best = len(ids), [], [], [], []
        if n and len(asked):
            scores = _products(_matrix(queries.column("v"), dims), _matrix(data.column("v"), dims)[order])
            own = row_of[None, :] == asking[:, None]
            lowest = np.iinfo(np.int64).min
            scores[own] = lowest
            kth = np.partition(scores, max(n - k, 0), axis=1)[:, max(n - k, 0)]
            row, col = np.nonzero((scores >= kth[:, None]) & ~own)
            score = scores[row, col]
            by = np.lexsort((col, -score, row))
            row, col, score = row[by], col[by], score[by]
            starts = np.searchsorted(row, np.arange(len(asked)))
            keep = np.arange(len(row)) - starts[row] < k
            rows, who, cols, best = asked[row[keep]], asking[row[keep]], ids[col[keep]], score[keep]
        return pa.table({"query_id": pa.array(rows, pa.int64()), "query_row": pa.array(who, pa.int64()), "vec_id": pa.array(cols, pa.int64()),
                         "score": pa.array(best, pa.int64())})

    return run


def top_k(data: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``data`` for every row of ``queries``.

    Both have vec_id, ``v`` and ``row``, a number that tells rows apart and under which a query
    finds itself among the data (a negative one: it is not there); both are read more than once.
    """
    spark = data.sparkSession
    small_batches(spark, 1024)
    facts = data.select(F.size("v").alias("d"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x).alias("n2")).agg(
        F.count(F.lit(1)).alias("n"), F.max("d").alias("d"), F.max("n2").alias("top")).first()
    dims, top = max(1, facts["d"] or 1), facts["top"] or 0.0
    count = max(1, min(MAX_PIVOTS, int(math.sqrt(facts["n"]))))
    sample = data.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(count).select("v").toArrow()  # bounded by MAX_PIVOTS
    pivots = _matrix(sample.column("v"), dims) if sample.num_rows else np.zeros((1, dims), np.int64)
    placed = written(data.select("vec_id", "v", "row").mapInArrow(
        _assigner(pivots, top, True), "vec_id long, v array<long>, row long, grp int, dist double"), "knn-placed")
    # the rank is cut to k + 1 rows of each group in every task before the shuffle
    nearest = F.row_number().over(Window.partitionBy("grp").orderBy("dist", "row"))
    smallest = (placed.select("grp", "dist", "row").withColumn("r", nearest).where(F.col("r") <= k + 1)
                .groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("dist", "row"))).alias("small")))
    summary = (placed.groupBy("grp").agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.count(F.lit(1)).alias("n"))
               .join(smallest, "grp"))
    # a row for each pivot, with k + 1 distances at most
    groups = {r["grp"]: (r["low"], r["high"], np.array([x["dist"] for x in r["small"]]), r["n"],
                         np.array([x["row"] for x in r["small"]], np.int64)) for r in summary.collect()}
    routed = written(queries.select("vec_id", "v", "row").mapInArrow(
        _assigner(pivots, top, False), "vec_id long, v array<long>, row long, dists array<double>")
        .mapInArrow(_router(pivots, top, groups, k), "query_id long, v array<long>, query_row long, grp int"), "knn-routed")
    blocks = spark.createDataFrame([(g, max(1, -(-x[3] // BLOCK))) for g, x in groups.items()] or [(0, 1)], "grp int, blocks long")
    parts = routed.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    plan = written(blocks.join(parts, "grp"), "knn-plan")  # a row for each pivot
    number = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = (placed.join(plan, "grp")  # by row number: rows of one vec_id, or equal rows, are spread too
            .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))).withColumn("part", number("parts")))
    right = (routed.join(plan, "grp").withColumn("part", F.pmod(F.xxhash64("query_row", "query_id"), F.col("parts")))
             .withColumn("block", number("blocks")))
    unit = ["grp", "block", "part"]
    found = (left.select("vec_id", "v", "row", *unit).groupBy(*unit)
             .cogroup(right.select("query_id", "v", "query_row", *unit).groupBy(*unit))
             .applyInArrow(_solver(dims, k), "query_id long, query_row long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def knn_table(embeddings: DataFrame) -> DataFrame:
    """The contract's rows: queries are the rows whose vec_id is divisible by ``QUERY_STEP``."""
    data = written(quantised(embeddings), "knn-vectors")
    return top_k(data, data.where(F.col("vec_id") % QUERY_STEP == 0))


#: DuckDB's view of the same rows.
ORACLE = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q, row_number() OVER () AS place FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, a.place, b.vec_id,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.place <> b.place WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
