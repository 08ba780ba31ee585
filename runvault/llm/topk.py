"""Exact top-k search with multi-resolution segment statistics.

Vectors are quantised to integers, and the score is their inner product.  With
the norms known, a bound on the score is a bound on the distance the other way
round (|x - y|^2 = |x|^2 + |y|^2 - 2 xy), so pruning below the k-th best score
is pruning by lower-bound distance.  A vector is cut into segments; per segment
its mean m and its deviation r (the length of what the mean leaves) are kept.  Of
two segments of w components the inner product is at most w m1 m2 + r1 r2, and
the sum over segments bounds the score.  Bounds go from coarse to fine (1, 4,
16 segments): each level tightens the k-th best exact score by the best
bounded candidates and drops every candidate whose bound is lower; survivors
get exact integer scores.  Bounds have a margin for rounding, so no result is
lost and none depends on it.

Queries meet all rows in blocks: rows are numbered, each slice of SLICE rows
meets each group of about TURN queries in one task, and such a cell returns k
rows a query at most; the best of all cells are ranked per query.  Rows are
dealt by number, so no vector, label or group of copies is a hot key.

Vectors that are null or hold a null or non-finite component take no part.
Vectors of different lengths do not meet.  A query's own row is no candidate;
repeated rows with its vec_id are.  Rows without vec_id are candidates, last
among ties.  Ties go to the smaller vec_id.  Where an inner product could leave
a long, the query fails with an error.  An empty table gives no rows.  Extra
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from runvault.llm.common import pick, with_row_number
from runvault.llm.registry import query, table

SCALE, TOP, EVERY = 256, 5, 50
LEVELS = (1, 4, 16)  # segments, coarse to fine
SLICE, TURN = 4096, 8192  # rows and queries that meet in one task
MOST_TASKS = 20_000
STEP = 256  # queries whose coarse bounds are held at once


def quantised(vectors: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components as floor(scale * x), for the vectors that take part."""
    rows = pick(vectors, id_column, vector_column).toDF("vec_id", "_e").withColumn("_e", F.col("_e").cast("array<double>"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.filter(F.col("_e").isNotNull() & F.forall("_e", finite))
    most = F.aggregate("_e", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))) * scale + 1
    fits = F.coalesce(F.size("_e") * most * most < 2.0 ** 62, F.lit(False))
    return rows.select("vec_id", F.when(fits, F.transform("_e", lambda x: F.floor(x * scale))).otherwise(
        F.raise_error(F.lit("inner products of these vectors could leave a long")).cast("array<bigint>")).alias("v"))


def segment_features(rows: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(w) * mean and deviation of each segment: their inner product bounds that of the rows."""
    width = rows.shape[1]
    edges = [width * s // segments for s in range(segments + 1)]
    out = []
    for lo, hi in zip(edges, edges[1:]):
        if lo < hi:
            part = rows[:, lo:hi].astype(np.float64)
            mean = part.mean(axis=1)
            out += [math.sqrt(hi - lo) * mean, np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.column_stack(out) if out else np.zeros((len(rows), 1))


def best_in_slice(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, places: np.ndarray, k: int,
                  levels: tuple[int, ...] = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(query position, row position, score) of every pair that can be among a query's k best of all
    rows but its own (``own`` and ``places`` are row numbers): the k best, and all that tie with the
    k-th.  Also the number of candidates left after each level."""
    found, left = [], [0] * len(levels)
    fine = [(segment_features(queries, s), segment_features(rows, s)) for s in levels]
    margin = 1 + 1e-9 * np.outer(np.linalg.norm(queries.astype(float), axis=1),
                                 [np.linalg.norm(rows.astype(float), axis=1).max(initial=0)])[:, 0]
    for start in range(0, len(queries), STEP):
        coarse = fine[0][0][start:start + STEP] @ fine[0][1].T
        for q, bounds in enumerate(coarse, start):
            alive = np.flatnonzero(places != own[q])
            bounds, floor, known = bounds[alive] + margin[q], None, {}
            for level in range(len(levels)):
                if level:
                    bounds = np.minimum(bounds, fine[level][1][alive] @ fine[level][0][q] + margin[q])
                if len(alive) >= k:
                    likely = alive[np.argpartition(-bounds, k - 1)[:k]]
                    known |= zip(likely.tolist(), (rows[likely] @ queries[q]).tolist())
                    floor = sorted(known.values(), reverse=True)[k - 1]
                    stay = bounds >= floor
                    alive, bounds = alive[stay], bounds[stay]
                left[level] += len(alive)
            scores = rows[alive] @ queries[q]
            if len(alive) > k:
                stay = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                alive, scores = alive[stay], scores[stay]
            found.append((np.full(len(alive), q), alive, scores))
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, left
    return *(np.concatenate(x) for x in zip(*found)), left


def _vectors(t: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row positions and matrix of each vector length."""
    column = t.column("v").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.int64()))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    out = {}
    for width in np.unique(sizes):
        at = np.flatnonzero(sizes == width)
        out[int(width)] = at, flat[starts[at][:, None] + np.arange(width)]
    return out


def _cell(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        number, vec_id = rows.column("number").to_numpy(), rows.column("vec_id")
        own, by_width = queries.column("number").to_numpy(), _vectors(rows)
        out = [], [], []
        for width, (at, matrix) in _vectors(queries).items():
            if width in by_width:
                place, candidates = by_width[width]
                q, r, score, _ = best_in_slice(matrix, own[at], candidates, number[place], k)
                # of equal scores the smaller ids: nulls last
                ids = vec_id.take(pa.array(place[r]))
                missing, value = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
                order = np.lexsort((number[place][r], value, missing, -score, q))
                rank = np.arange(len(order)) - np.searchsorted(q[order], q[order])
                keep = order[rank < k]
                for column, x in zip(out, (at[q[keep]], place[r[keep]], score[keep])):
                    column.append(x)
        q, r, score = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out)
        return pa.table({"query": pa.array(own[q], pa.int64()), "query_id": queries.column("vec_id").take(pa.array(q, pa.int64())),
                         "number": pa.array(number[r], pa.int64()), "vec_id": vec_id.take(pa.array(r, pa.int64())),
                         "score": pa.array(score, pa.int64())})
    return run


def top_k(vectors: DataFrame, is_query: str = f"vec_id % {EVERY} = 0", k: int = TOP, scale: int = SCALE,
          id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row with ``is_query``, itself excluded.

    ``is_query`` is a condition on vec_id; the id is taken as a long."""
    rows = quantised(vectors, id_column, vector_column, scale).select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    rows, n = with_row_number(rows, ["vec_id", "v"], "number")
    turns, slices = max(1, math.ceil(rows.filter(is_query).count() / TURN)), max(1, math.ceil(n / SLICE))
    queries = rows.filter(is_query).withColumn("turn", F.pmod(F.xxhash64("number"), F.lit(turns))).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>")))
    rows = rows.withColumn("slice", F.expr(f"number div {SLICE}")).withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)).cast("array<bigint>")))
    # a cell is heavy beside its bytes: one task each up to a bound, never merged by size; both sides come from one frame
    cells = min(turns * slices, MOST_TASKS)
    apart = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns]).repartition(cells, "turn", "slice")
    best = apart(queries).groupBy("turn", "slice").cogroup(apart(rows).groupBy("turn", "slice")).applyInArrow(
        _cell(k), "query long, query_id long, number long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "number")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


SQL = f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS other, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % {EVERY} = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM n WHERE rank <= {TOP}
"""


@query("op13_exact_topk", SQL)
def op13_exact_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))
