"""Operator 2: nearest vectors by cosine, by query-aware collision counting.

Unit vectors are dealt into shards. A shard keeps ``LINES`` sorted arrays, its
vectors' projections on random lines. A query starts with a narrow window
around its own projection on each line and widens all of them step by step
(virtual rehashing: a wider window is a coarser bucket); only what a step adds
is counted. Vectors that lie in the windows of at least ``COLLIDE`` of the
lines are verified on the original components, in double precision. A query
is done when its k-th best lies within the radius reached, or when ``SHARE``
of the shard has been verified. The shards' best are merged.

Queries meet shards in blocks of bounded size on both sides. Of equal vectors
the k + 1 smallest ids take part, more can't be among a query's k nearest.

Rows: an empty table gives no rows; other columns are not looked at. Vectors
that are null, empty, zero or hold null or non-finite components take no part;
only vectors of one length are compared. A query's own vec_id is left out. Rows that repeat a vec_id and vector are one; if the vectors differ,
each is a row. Null ids take no part. Ties go to the smaller vec_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import _tables as T

LINES, COLLIDE, SHARE = 64, 0.75, 0.12
FIRST, WIDER = 0.1, 1.35  # half-width of the first windows, and the factor of each step
REACH = 1.5  # vectors at distance d collide on a line by half-width 1.5 d with probability 0.87, well over COLLIDE
SHARD = 8192  # vectors in a shard
BLOCK_BYTES = 16 << 20  # of the vectors of a block of queries; a shard is indexed, and its vectors sent, once for each block
SEED = 20


class Shard:
    """Sorted projections of a shard's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.norms = np.sqrt((self.vectors**2).sum(1))
        self.lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1], LINES))
        p = (self.vectors / self.norms[:, None]) @ self.lines
        self.order = np.ascontiguousarray(np.argsort(p, axis=0).T).astype(np.int32)
        # all lines in one sorted array: line j takes the values around j * gap
        self.gap = 4 * (np.abs(p).max() + 1)
        self.sorted = (np.sort(p, axis=0).T + self.gap * np.arange(LINES)[:, None]).ravel()

    def _places(self, values: np.ndarray) -> list[int]:
        """How many projections on each line are below its value."""
        n = len(self.ids)
        lines = np.arange(LINES)
        at = np.searchsorted(self.sorted, np.clip(values, -self.gap / 2, self.gap / 2) + self.gap * lines) - n * lines
        return np.clip(at, 0, n).tolist()

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the k nearest found, best first."""
        n, norm = len(self.ids), np.sqrt((query**2).sum())
        centre = (query / norm) @ self.lines
        need, enough = int(np.ceil(COLLIDE * LINES)), int(np.ceil(SHARE * n)) + k
        counts, seen = np.zeros(n, np.int64), np.zeros(n, bool)
        found, cosines = np.zeros(0, np.int64), np.zeros(0)
        mid = self._places(centre)
        lo = hi = mid
        radius = FIRST
        while True:
            a, b = self._places(centre - radius), self._places(centre + radius)
            added = [x for j, o in enumerate(self.order) for x in (o[a[j] : lo[j]], o[hi[j] : b[j]])]
            counts += np.bincount(np.concatenate(added), minlength=n)
            lo, hi = a, b
            new = np.flatnonzero((counts >= need) & ~seen)
            seen[new] = True
            if len(new):
                found = np.concatenate([found, new])
                cosines = np.concatenate([cosines, (self.vectors[new] @ query) / (self.norms[new] * norm)])
                good = cosines[self.ids[found] != query_id]
                kth = np.partition(good, len(good) - k)[-k] if len(good) >= k else None
                near = kth is not None and np.sqrt(max(0.0, 2 - 2 * kth)) <= radius / REACH
                if near or len(found) >= enough or len(found) == n:
                    break
            radius *= WIDER
        best = np.lexsort((self.ids[found], -cosines))
        best = best[self.ids[found[best]] != query_id][:k]
        return self.ids[found[best]], cosines[best]


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _search(k: int):
    def run(key, rows, queries):
        if not rows.num_rows or not queries.num_rows:
            return pa.table([[]] * 4, schema=FOUND)
        dim = key[0].as_py()
        shard = Shard(rows.column("vec_id").to_numpy(), _vectors(rows.column("embedding"), dim))
        out = []
        for i, q, v in zip(queries.column("vec_id").to_pylist(), queries.column("query").to_pylist(), _vectors(queries.column("embedding"), dim)):
            out += [(i, q, int(x), float(c)) for x, c in zip(*shard.search(i, v, k))]
        return pa.table([list(x) for x in zip(*out)] or [[]] * 4, schema=FOUND)
    return run


FOUND = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) that take part, with their length."""
    e = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & e.isNotNull() & fine).withColumn("dim", F.size("embedding"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of ``vectors`` to each of ``queries``, both (vec_id, embedding)."""
    same = Window.partitionBy("embedding").orderBy("vec_id")
    rows = T.store(usable(vectors).dropDuplicates(["vec_id", "embedding"]).withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).select("dim", "vec_id", "embedding"), "vectors")
    asked = T.store(usable(queries).withColumn("query", F.xxhash64("vec_id", "embedding")).dropDuplicates(["vec_id", "query"]).select("dim", "vec_id", "query", "embedding"), "queries")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum("dim").alias("entries")).first()
    shards, blocks = -(-max(rows.count(), 1) // SHARD), -(-max((size.entries or 0) * 8, 1) // BLOCK_BYTES)
    left = (rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    right = (asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    found = left.groupBy("dim", "shard", "block").cogroup(right.groupBy("dim", "shard", "block")).applyInArrow(_search(k), "query_id long, query long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_collision_counting(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
