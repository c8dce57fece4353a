"""Exact top-k inner products by the threshold algorithm over sorted lists.

Vectors are scaled to integers. Candidates are dealt at random into blocks of a
bounded size and queries into chunks, and every (block, chunk) pair is one
group: the stated query set meets all rows in blocks. Inside a group each
dimension has a list of the block's rows sorted by value, read from the top for
a positive query component and from the bottom for a negative one. Rows met on
the lists are scored in full; the threshold is the inner product of the query
with the values at the present depth, which no unseen row can exceed. A query
stops once its threshold is below its k-th score (an equal one goes on, as an
unseen row may tie with a smaller id), or once it has met every row of the block,
which is as deep as lists go. A floor from a fixed number of rows, scored before
for every query, stops a query early in blocks that hold nothing for it. A window
over the blocks' answers, k rows each, gives the result.

Defined cases: vectors that are null or empty, or hold null or non-finite
components, and rows without an id take no part; a repeated id is one row, its
smallest vector; vectors are compared with those of their own length only; with
fewer than k candidates all are returned; ties go to the smaller id; an empty
table gives no rows. Components and scores that may not fit a 64-bit integer fail the job.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates in a block and queries in a chunk, about: bounds of one group.
BLOCK_ROWS = 8192
CHUNK_QUERIES = 1024
#: Depth of the first step into the lists; each next step is as deep as all before.
FIRST_DEPTH = 16
#: Rows, at most, whose scores give every query a floor.
SEEDS = 512

RESULT = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    scale: int = 64) -> DataFrame:
    """(vec_id, v array<bigint>, dim): valid vectors as floor(scale * component)."""
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"),
                     F.col(vector_col).cast("array<double>").alias("x"))
    sound = F.expr("vec_id IS NOT NULL AND x IS NOT NULL AND size(x) > 0 AND "
                   "forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('Infinity'))")
    return (rows.where(sound)
            .select("vec_id", F.transform("x", lambda e: F.when(F.abs(e * scale) < 2.0 ** 63, F.floor(e * F.lit(float(scale))))
                                          .otherwise(F.raise_error(F.lit("component beyond 64 bits")).cast("bigint"))).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v"))
            .withColumn("dim", F.size("v")))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def threshold_search(ids: np.ndarray, c: np.ndarray, query_ids: np.ndarray, q: np.ndarray,
                     k: int, floors: np.ndarray | None = None, first: int | None = None):
    """(query, id, score) arrays: each query's k best rows of this block, its own row left out.

    Rows below a query's floor may be missing: at least k others reach it elsewhere.
    """
    order = np.argsort(ids, kind="stable")
    ids, c = ids[order], c[order]
    n, d = c.shape
    # Doubles hold the sums exactly below 2^53; beyond that, 64-bit integers.
    largest = float((np.abs(c.astype(float)).max(axis=0, initial=0) * np.abs(q.astype(float)).max(axis=0, initial=0)).sum())
    if largest >= 2.0 ** 63:
        raise OverflowError("inner products may not fit 64 bits")
    kind = np.float64 if largest < 2.0 ** 53 else np.int64
    cf, qf = c.astype(kind), q.astype(kind)
    lists = np.argsort(cf, axis=0, kind="stable")
    dims, out = np.arange(d), []
    for i, x in enumerate(qf):
        seen = np.zeros(n, dtype=bool)
        met, scores = [], []
        least = -np.inf if floors is None else floors[i]
        begin, depth, unseen = 0, first or FIRST_DEPTH, n
        while unseen:
            rows = np.arange(begin, min(depth, n))[:, None]
            reach = lists[np.where(x >= 0, n - 1 - rows, rows), dims]
            new = np.zeros(n, dtype=bool)
            new[reach.ravel()] = True
            at = np.flatnonzero(new & ~seen)
            seen[at] = True
            unseen -= len(at)
            met.append(at)
            scores.append(cf[at] @ x)
            own = np.concatenate(scores)[ids[np.concatenate(met)] != query_ids[i]]
            if len(own) >= k:
                least = max(least, np.partition(own, len(own) - k)[len(own) - k])
            if cf[reach[-1], dims] @ x < least:
                break
            begin, depth = depth, 2 * depth
        if not met:
            continue
        at, score = np.concatenate(met), np.concatenate(scores)
        keep = ids[at] != query_ids[i]
        at, score = at[keep], score[keep]
        best = _best(score, ids[at], k)
        out.append((np.full(len(best), query_ids[i]), ids[at[best]], score[best].astype(np.int64)))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate([o[j] for o in out]) for j in range(3))


def seed_floors(seed_ids: np.ndarray, seeds: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th score among the seeds, a score that its k best rows reach."""
    floors = np.full(len(q), -np.inf)
    if seeds.shape[1:] != q.shape[1:]:
        return floors
    for i, x in enumerate(q):
        s = (seeds.astype(float) @ x.astype(float))[seed_ids != query_ids[i]]
        if len(s) >= k:
            # Rounding may only lower a floor.
            s = np.partition(s, len(s) - k)[len(s) - k]
            floors[i] = s - abs(s) * 1e-9 - 1
    return floors


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k largest inner products.

    Both tables are as from :func:`integer_vectors`.
    """
    n, m = vectors.count(), queries.count()
    blocks, chunks = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(m / CHUNK_QUERIES))

    def dealt(df, own, n_own, other, n_other):
        return (df.withColumn(own, F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    c = dealt(vectors, "block", blocks, "chunk", chunks)
    q = dealt(queries, "chunk", chunks, "block", blocks)

    # A fixed number of rows, of the commonest length, whatever the table's size.
    length = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    some = (vectors.where(F.col("dim") == length["dim"]).orderBy(F.xxhash64("vec_id", F.lit(9))).limit(SEEDS)
            .select("vec_id", "v").toArrow() if length else None)
    seed_ids = some["vec_id"].to_numpy() if length else np.zeros(0, np.int64)
    seeds = _matrix(some["v"]) if length else np.zeros((0, 0), np.int64)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            got = (np.zeros(0, np.int64),) * 3
        else:
            ids, q = right["vec_id"].to_numpy(), _matrix(right["v"])
            got = threshold_search(left["vec_id"].to_numpy(), _matrix(left["v"]), ids, q, k,
                                   seed_floors(seed_ids, seeds, ids, q, k))
        return pa.table([pa.array(x, pa.int64()) for x in got], names=["query_id", "vec_id", "score"])

    keys = ["dim", "block", "chunk"]
    found = (c.select(*keys, "vec_id", "v").groupBy(*keys)
             .cogroup(q.select(*keys, "vec_id", "v").groupBy(*keys)).applyInArrow(search, RESULT))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def oracle_sql(k: int, every: int, scale: int = 64) -> str:
    return f"""
WITH e AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0),
s AS (SELECT vec_id, [floor({scale} * y) FOR y IN x] AS v FROM e
      WHERE len([y FOR y IN x IF y IS NULL OR NOT isfinite(y)]) = 0),
u AS (SELECT vec_id, min(v) AS v FROM s GROUP BY vec_id),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM u q JOIN u c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
      FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
