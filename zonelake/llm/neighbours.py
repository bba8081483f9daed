"""Nearest neighbours by collision counting over single-projection sorted arrays (query-aware hashing).

Each shard of the vectors is projected on an orthonormal basis turned at random, and every projection is a sorted
array.  Around a query's own projections windows are widened step by step (virtual rehashing); a vector collides once
for every window that holds it.  Vectors with enough collisions are verified with their true inner product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Vectors of a shard and queries of a block.
SHARD_ROWS, BLOCK_QUERIES = 8192, 512
#: First half-width of the windows in standard deviations of the projection, and its growth.
WIDTH, GROWTH, STEPS = 0.98, 1.06, 60
#: Share of the windows that must hold a vector, and share of a shard that has to pass before widening stops.
COLLISIONS, CANDIDATES = 0.64, 0.25


class ShardIndex:
    """Sorted projections of some vectors (rows of ``vectors``, float64).

    A window is widened in steps of a block, 1 / 256 of the sorted array, so a vector's place in it is one byte and
    collisions are counted by comparing bytes.
    """

    def __init__(self, vectors: np.ndarray, collisions: float, candidates: float, seed: int = 7):
        self.vectors, self.rough, self.candidates = vectors, vectors.astype(np.float32), candidates
        n, dims = vectors.shape[0], vectors.shape[1] + 1
        self.turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))[0]
        # One more coordinate gives all vectors the same length, so the nearest has the largest inner product.
        sizes = (vectors**2).sum(axis=1)
        self.length = float(np.sqrt(sizes.max()))
        points = np.column_stack([vectors, np.sqrt(np.maximum(sizes.max() - sizes, 0.0))]) @ self.turn
        order = np.argsort(points, axis=0, kind="stable").T
        self.sorted = np.ascontiguousarray(np.take_along_axis(points.T, order, 1))
        self.block = np.zeros((dims, n), np.uint8)
        np.put_along_axis(self.block, order, (np.arange(n) * 256 // n).astype(np.uint8)[None, :], 1)
        self.reach = float(np.abs(vectors).max())
        self.spread = np.maximum(points.std(axis=0), 1e-12)
        self.enough = max(1, int(np.ceil(collisions * dims)))

    def collided(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the rows that pass the threshold in the first windows in which enough of them do."""
        n, dims = len(self.vectors), len(self.sorted)
        found: list[np.ndarray] = [np.arange(n)] * len(queries)
        wanted = int(self.candidates * n) + 2 * k
        if wanted >= n:  # a small shard: all rows
            return found
        alike = queries * (self.length / np.sqrt((queries**2).sum(axis=1)))[:, None]
        own, active, width = alike @ self.turn[:-1], np.arange(len(queries)), WIDTH
        kind = np.uint8 if dims < 256 else np.uint16
        for _ in range(STEPS):
            low, high = np.empty((2, dims, len(active)), np.int64)
            for j in range(dims):
                low[j] = self.sorted[j].searchsorted(own[active, j] - width * self.spread[j])
                high[j] = self.sorted[j].searchsorted(own[active, j] + width * self.spread[j], "right")
            none = high <= low
            low = np.minimum(low, n - 1) * 256 // n
            span = np.maximum(high - 1, 0) * 256 // n - low
            low, span = low.astype(np.uint8), np.where(none, 0, span).astype(np.uint8)
            going = []
            for at, q in enumerate(active):
                inside = (self.block - low[:, at, None]) <= span[:, at, None]
                counts = inside.view(np.uint8).sum(axis=0, dtype=kind)
                rows = np.flatnonzero(counts >= self.enough)
                if len(rows) >= wanted:
                    found[q] = rows
                else:
                    going.append(q)
            active = np.array(going, np.int64)
            if not len(active):
                break
            width *= GROWTH
        return found

    def nearest(self, rows: np.ndarray, query: np.ndarray, own: int, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the k best of some rows other than ``own``; ties to the smaller id."""
        rows = rows[ids[rows] != own]
        if len(rows) > k:
            # In single precision first; whatever its rounding could hide is counted exactly.
            with np.errstate(over="ignore", invalid="ignore"):
                rough = self.rough[rows] @ query.astype(np.float32)
            slack = 1e-5 * self.reach * float(np.abs(query).sum())
            if np.isfinite(rough).all() and np.isfinite(slack):
                edge = np.partition(rough, len(rough) - k)[len(rough) - k]
                rows = rows[rough >= edge - slack]
        exact = (self.vectors[rows] * query).sum(axis=1)
        best = np.lexsort((ids[rows], -exact))[:k]
        return ids[rows[best]], exact[best]


def matrix(table: pa.Table) -> np.ndarray:
    values = table.column("v").combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """One row for each id: (id, v, dims).  Null, empty, zero vectors and those with a null or non-finite part are out."""
    values = F.col(vector).cast("array<double>")
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), values.alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.filter((F.size("v") > 0) & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("dims", F.size("v"))


def nearest_neighbours(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20,
    shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, collisions: float = COLLISIONS,
    candidates: float = CANDIDATES,
) -> DataFrame:
    """The k nearest found rows of every row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Nearest is the largest inner product of the original vectors in double precision; ties go to the smaller id.
    Vectors of another length than the query's are no candidates.  Of rows that repeat an id the smallest vector
    counts.  Unusable vectors (see ``usable``) take no part; fewer candidates than k give fewer rows, an empty table
    none.  Shards and blocks of queries have fixed sizes; each pair of them is one task's group.
    """
    rows = usable(df, key, vector)
    n, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("id") % every == 0, 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked // block_queries))
    mark = F.xxhash64("id")
    data = rows.withColumn("shard", F.pmod(mark, F.lit(shards)).cast("int"))
    data = data.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = rows.filter(F.col("id") % every == 0).withColumn("block", F.pmod(mark, F.lit(blocks)).cast("int"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    schema = "query_id long, vec_id long, score double"

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        made = {"query_id": [np.zeros(0, np.int64)], "vec_id": [np.zeros(0, np.int64)], "score": [np.zeros(0)]}
        if len(left) and len(right):
            ids, own = left.column("id").to_numpy(), right.column("id").to_numpy()
            index = ShardIndex(matrix(left), collisions, candidates)
            queries = matrix(right)
            for q, query, rows in zip(own, queries, index.collided(queries, k)):
                found, scores = index.nearest(rows, query, q, ids, k)
                made["query_id"].append(np.full(len(found), q))
                made["vec_id"].append(found)
                made["score"].append(scores)
        return pa.table({name: np.concatenate(v) for name, v in made.items()})

    keys = ["dims", "shard", "block"]
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(cell, schema)
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def brute_force(frame: pd.DataFrame, every: int = 20, k: int = 20) -> dict[int, list[int]]:
    """The true neighbours of a small table, to measure recall."""
    ids, vectors = frame["vec_id"].to_numpy(), np.stack([np.asarray(v, float) for v in frame["embedding"]])
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = (vectors * vectors[i]).sum(axis=1)
        best = [j for j in np.lexsort((ids, -scores)) if j != i][:k]
        out[int(ids[i])] = [int(ids[j]) for j in best]
    return out
