"""Exact nearest neighbours by a block matrix join.

Queries and candidates are dealt into blocks by hash; a tile is one block of each. In a tile
the vectors are quantised to int8, a scale a vector, and the tile's distances come from the
product of the int8 matrices. The error of a quantised vector is its distance from the
original, so the triangle inequality bounds the true distance on both sides. Pairs whose
lower bound is above the k-th smallest upper bound, or above what the query's heap holds
already, are dropped; the others are computed from the original vectors in double precision
and go through the heap. The heaps of all tiles are merged a query at a time.

Equal vectors are one candidate, a class, with the k + 1 smallest ids of its rows: as ties go
to the smaller id and a query leaves out its own id only, no other row of a class can be
among the k nearest. So a vector that a third of all rows share makes no more pairs than any
other. A tile gives at most k rows a query.

Defined cases: vectors null, empty, zero, or with a null or non-finite component take no
part, nor do rows without vec_id; vectors are compared only with those of as many components;
rows of one vec_id with equal vectors count once, with other vectors each is a query and a
candidate of its own; no query returns its own vec_id; ties go to the smaller vec_id; a query
has fewer rows if there are fewer candidates; other columns are not read; an empty table, or
one without queries, gives an empty result. A vector of any length is multiplied in slices.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import ready_python, table
from siltstone.sources.staging import stage

NEAREST = 10
BLOCK = 16_384  # rows of a block, on average
_QUERIES, _CANDIDATES = 256, 2_048  # rows of a step in a tile
_EXACT = 1_024  # components whose int8 products add up exactly in single precision
_PAIRS = 1 << 16
_SLACK = 1e-6  # of the norms, for rounding in double precision


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and how far each lies from the original."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1
    small = np.rint(x / scale[:, None]).clip(-127, 127).astype(np.int8)
    error = np.sqrt(((x - small * scale[:, None]) ** 2).sum(axis=1))
    return small, scale, error


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner products of int8 rows, exact: 127 * 127 * 1024 is below 2**24."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], _EXACT):
        out += a[:, at : at + _EXACT].astype(np.float32) @ b[:, at : at + _EXACT].astype(np.float32).T
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances row by row, components added from first to last."""
    total = np.zeros(len(a))
    for x, y in zip(a.T, b.T, strict=True):
        total += (x - y) * (x - y)
    return np.sqrt(total)


class _Side:
    """One side of a tile: original and quantised vectors."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.small, self.scale, self.error = quantised(x)
        self.square = (self.small.astype(np.float64) ** 2).sum(axis=1) * self.scale**2
        self.margin = self.error + _SLACK * (np.sqrt(self.square) + self.error)


def bounds(a: _Side, b: _Side, rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of some rows of both sides."""
    near = product(a.small[rows], b.small[columns])
    near *= -2 * a.scale[rows, None] * b.scale[columns]
    near += a.square[rows, None] + b.square[columns]
    near = np.sqrt(np.maximum(near, 0))
    margin = a.margin[rows, None] + b.margin[columns]
    return near - margin, near + margin


def tile(queries: np.ndarray, candidates: np.ndarray, first: np.ndarray, k: int) -> list[list[tuple[float, int, int]]]:
    """For each query its k nearest candidates as (distance, first, place), ties by first."""
    heaps: list[list[tuple[float, int, int]]] = [[] for _ in range(len(queries))]
    with np.errstate(all="ignore"):
        a, b = _Side(queries), _Side(candidates)
        for low in range(0, len(candidates), _CANDIDATES):
            columns = slice(low, min(low + _CANDIDATES, len(candidates)))
            for top in range(0, len(queries), _QUERIES):
                rows = slice(top, min(top + _QUERIES, len(queries)))
                lower, upper = bounds(a, b, rows, columns)
                limit = np.full(len(lower), np.inf)
                if upper.shape[1] >= k:
                    limit = np.partition(upper, k - 1, axis=1)[:, k - 1]
                held = [-h[0][0] if len(h) == k else np.inf for h in heaps[rows]]
                limit = np.fmin(limit, held)
                # Bounds that overflowed are no numbers and prune nothing.
                at, to = np.nonzero(~(lower > limit[:, None]))
                for start in range(0, len(at), _PAIRS):
                    i, j = at[start : start + _PAIRS] + top, to[start : start + _PAIRS] + low
                    _merge(heaps, i, j, distances(queries[i], candidates[j]), first[j], k)
    return [sorted((-d, -f, p) for d, f, p in heap) for heap in heaps]


def _merge(heaps: list, i: np.ndarray, j: np.ndarray, distance: np.ndarray, first: np.ndarray, k: int) -> None:
    """Put pairs into the heaps of their queries, which keep the k smallest by (distance, first)."""
    order = np.lexsort((first, distance, i))
    starts = np.flatnonzero(np.diff(i, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(i)], strict=True):
        heap = heaps[i[start]]
        best = order[start : min(end, start + k)]
        for d, f, p in zip(distance[best].tolist(), first[best].tolist(), j[best].tolist(), strict=True):
            if len(heap) < k:
                heapq.heappush(heap, (-d, -f, p))
            elif (-d, -f) > heap[0][:2]:
                heapq.heapreplace(heap, (-d, -f, p))
            else:
                break


def _matrix(rows: pa.Table, name: str) -> np.ndarray:
    flat = rows[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows.num_rows, -1).astype(np.float64)


def usable(vector: Column) -> Column:
    """Vectors that take part: some component, none null or not finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _classes(rows: DataFrame, ids: int) -> DataFrame:
    """Distinct vectors with the smallest ids of their rows."""
    place = F.row_number().over(Window.partitionBy("_vector").orderBy("vec_id"))
    few = rows.withColumn("_place", place).where(F.col("_place") <= ids)
    return few.groupBy("_vector").agg(F.array_sort(F.collect_list("vec_id")).alias("_ids"))


_FOUND = "query_id long, _same long, vec_id long, score double"


def nearest(vectors: DataFrame, queries: Column, k: int = NEAREST, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows of every row that is a query.

    vectors: vec_id and embedding. Every query meets every candidate, tile by tile; a row is
    sent once for each block of the other side.
    """
    ready_python(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("_vector"))
    if dict(rows.dtypes)["_vector"] != "array<float>":
        rows = rows.withColumn("_vector", F.col("_vector").cast("array<double>"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("_vector"))).distinct()
    rows = stage(rows.withColumn("_same", F.xxhash64("_vector")), "vectors").df
    asked = rows.where(queries)
    held = stage(_classes(rows, k + 1).withColumn("_size", F.size("_vector")), "classes")
    query_blocks = max(1, -(-asked.count() // block))
    held_blocks = max(1, -(-held.rows // block))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def part(n: int, *by: str) -> Column:
        return F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")

    left = asked.select(
        F.col("vec_id").alias("query_id"), "_same", "_vector", F.size("_vector").alias("_size"),
        part(query_blocks, "vec_id", "_same").alias("_q"), every(held_blocks).alias("_c"),
    )
    right = held.df.select("_ids", "_vector", "_size", part(held_blocks, "_vector").alias("_c"), every(query_blocks).alias("_q"))

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, float]] = []
        if asked.num_rows and held.num_rows:
            ids = held["_ids"].to_pylist()
            first = np.array([own[0] for own in ids], dtype=np.int64)
            found = tile(_matrix(asked, "_vector"), _matrix(held, "_vector"), first, k + 1)
            for query, same, classes in zip(asked["query_id"].to_pylist(), asked["_same"].to_pylist(), found, strict=True):
                pairs = ((d, i) for d, _, p in classes for i in ids[p] if i != query)
                out += [(query, same, i, d) for d, i in heapq.nsmallest(k, pairs)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        names = [c.split()[0] for c in _FOUND.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    tiles = ["_size", "_q", "_c"]
    met = left.groupBy(*tiles).cogroup(right.groupBy(*tiles)).applyInArrow(meet, _FOUND)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k smallest (score, vec_id) of every query; a heap for each query of the partition."""
        heaps: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for batch in batches:
            for query, same, i, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                heap = heaps.setdefault((query, same), [])
                if len(heap) < k:
                    heapq.heappush(heap, (-score, -i))
                elif (-score, -i) > heap[0]:
                    heapq.heapreplace(heap, (-score, -i))
        for (query, _), heap in heaps.items():
            best = sorted((-d, -i) for d, i in heap)
            n = len(best)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([query] * n, pa.int64()),
                    pa.array(range(1, n + 1), pa.int32()),
                    pa.array([i for _, i in best], pa.int64()),
                    pa.array([d for d, _ in best], pa.float64()),
                ],
                names=["query_id", "rank", "vec_id", "score"],
            )

    met = met.repartition("query_id", "_same")
    return met.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")


def op13_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 100, among all others."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


#: The squares are added from first to last, as `distances` does.
OP13_SQL = """
WITH usable AS (
    SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored AS (
    SELECT q.vec_id AS query_id, q.v AS asked, c.vec_id, sqrt(list_reduce(
            list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda a, b: a + b
        )) AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 100 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id, asked ORDER BY score, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""
