"""Operator 12: whitened vectors, with the covariance by polarisation of exact integers.

Entries c become integers x = floor(1024 c) + 100000. One pass gives n and the
sums S; a second one the exact squares of y = n x - S, summed over the rows,
for every dimension and for the sum of every two dimensions. As

    2 cov(i, j) = var(i + j) - var(i) - var(j),

their differences are all covariances, still as integers; only the finished
matrix is rounded, and goes to ``eigh`` on the driver: d (d + 1) / 2 numbers
for d dimensions, whatever the number of rows. Squares are summed by limbs of
24 bits, as many as the values seen need, so that no sum overflows: tasks emit
one row for each pair and two limbs, which Spark adds up.

Rows are then projected in one narrow pass, written, and the covariance of
what was written is taken from means and centred products.

Rows: a vector that is null, empty, or holds a null, a non-finite entry or one
beyond +-2**40 (no exact integer) takes no part. Vectors of other lengths than
the most common one (of ties the longest) take no part. Repeated rows and null
ids are rows like others. ``deviation`` is null where a long can't hold it;
``deviation_exact`` has it as a decimal (null beyond 38 digits). Components without variance (relative
to the trace, 1e-12) have no whitened values: null. An empty table, or one
without a usable vector, gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
import operator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import _tables as T

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)  # entries beyond can't be exact
LIMB = 24  # bits of a limb; 2**(62 - 2 * LIMB) products fit into a long
ROWS = 2048  # rows of a block
COMPONENTS = 8
FLAT = 1e-12  # share of the trace under which a component has no variance


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x: array of longs) of the vectors that take part, of any length."""
    e = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = (F.size(e) > 0) & F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    return rows.filter(F.coalesce(fine, F.lit(False))).select("vec_id", F.transform(e, lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _sums(dim: int):
    """Per task: rows, and each dimension's sum (split, so that no sum overflows), least and largest value."""
    def run(batches):
        n, low, high = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        least, most = np.full(dim, np.iinfo(np.int64).max), np.full(dim, np.iinfo(np.int64).min)
        for b in batches:
            x = _matrix(b, dim)
            if len(x):
                n += len(x)
                low += (x & 0xFFFFFF).sum(0)
                high += (x >> 24).sum(0)
                least, most = np.minimum(least, x.min(0)), np.maximum(most, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (np.arange(dim), np.full(dim, n), low, high, least, most)], ["i", "n", "low", "high", "least", "most"])
    return run


class Centre:
    """n and the sums: y = n x - S of integer rows, exact, without a large intermediate value."""

    def __init__(self, n: int, sums: list[int], least: list[int], most: list[int]):
        self.n, self.sums = n, sums
        self.whole, self.rest = (np.array(a, np.int64) for a in zip(*(divmod(s, n) for s in sums)))
        self.reach = max(max(abs(n * a - s), abs(n * b - s)) for s, a, b in zip(sums, least, most))
        self.wide = self.reach >= 1 << 61  # then y are Python's integers

    def of(self, x: np.ndarray) -> np.ndarray:
        if self.wide:
            return (x.astype(object) - self.whole.astype(object)) * self.n - self.rest.astype(object)
        return (x - self.whole) * self.n - self.rest


def limbs(reach: int) -> int:
    """Limbs for signed values up to ``reach``."""
    return max(1, -(-(int(reach).bit_length() + 1) // LIMB))


def split(z: np.ndarray, count: int) -> list[np.ndarray]:
    """Limbs of ``z``, the lowest first; the last one is signed."""
    out = []
    for _ in range(count - 1):
        out.append(z & ((1 << LIMB) - 1))
        z = z >> LIMB
    return [*out, z]


def _squares(dim: int, centre: Centre):
    """Per task: sums of products of limbs u <= v of y_i (j = i) and of y_i + y_j (j > i)."""
    count = limbs(2 * centre.reach)
    pairs = list(itertools.combinations_with_replacement(range(count), 2))
    mine, other = np.triu_indices(dim)

    def run(batches):
        total = None
        for b in batches:
            x = _matrix(b, dim)
            for at in range(0, len(x), ROWS):
                y = np.ascontiguousarray(centre.of(x[at : at + ROWS]).T)
                part = np.empty((len(pairs), len(mine)), np.int64)
                k = 0
                for i in range(dim):
                    z = y[i:] + y[i]
                    z[0] = y[i]
                    parts = split(z, count)
                    for p, (u, v) in enumerate(pairs):
                        part[p, k : k + dim - i] = np.einsum("ij,ij->i", parts[u], parts[v]).astype(np.int64)
                    k += dim - i
                # blocks of 2**11 rows of 48-bit products: 2**59; their high and low parts are summed apart, for 2**33 blocks
                high, low = part >> 30, part & ((1 << 30) - 1)
                total = (high, low) if total is None else (total[0] + high, total[1] + low)
        if total is not None:
            for p, (u, v) in enumerate(pairs):
                arrays = [mine, other, np.full(len(mine), u + v), np.full(len(mine), 1 if u == v else 2), total[0][p], total[1][p]]
                yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], ["i", "j", "limb", "times", "high", "low"])
    return run


def covariance(rows: DataFrame, dim: int, centre: Centre) -> np.ndarray:
    """Covariance of the integer ``rows(x)``, divisor n; exact until it is rounded to doubles."""
    found = (rows.select("x").mapInArrow(_squares(dim, centre), "i long, j long, limb long, times long, high long, low long")
             .groupBy("i", "j", "limb", "times").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])).collect()  # d * d rows for each pair of limbs
    q: dict[tuple[int, int], int] = {}
    for r in found:
        q[r.i, r.j] = q.get((r.i, r.j), 0) + r.times * (((int(r.high) << 30) + int(r.low)) << (LIMB * r.limb))
    cube = centre.n**3
    v = np.empty((dim, dim))
    for i in range(dim):
        v[i, i] = q[i, i] / cube  # Python divides integers of any size to the nearest double
        for j in range(i + 1, dim):
            v[i, j] = v[j, i] = (q[i, j] - q[i, i] - q[j, j]) / (2 * cube)
    return v


def _projected(dim: int, centre: Centre, directions: np.ndarray):
    """(vec_id, x) -> vec_id, deviation (as limbs), whitened values; ``directions`` holds a column for each component."""
    count = limbs(centre.reach)
    pairs = list(itertools.combinations_with_replacement(range(count), 2))
    factor = [(1 if u == v else 2) << (LIMB * (u + v)) for u, v in pairs]

    def run(batches):
        for b in batches:
            x = _matrix(b, dim)
            y = centre.of(x)
            parts = split(y, count)
            products = [np.einsum("ij,ij->i", parts[u], parts[v]).tolist() for u, v in pairs]
            deviation = [sum(map(operator.mul, p, factor)) for p in zip(*products)]
            w = (y / centre.n).astype(float) @ directions
            whitened = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(map(str, deviation), pa.string()), whitened], ["vec_id", "deviation", "w"])
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, deviation_exact, whitened, explained, identity_error of ``vectors(vec_id, embedding)``."""
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double"
    usable = integers(vectors)
    lengths = usable.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths["dim"]
    rows = usable.filter(F.size("x") == dim)
    stats = (rows.select("x").mapInArrow(_sums(dim), "i long, n long, low long, high long, least long, most long").groupBy("i")
             .agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")], F.min("least").alias("least"), F.max("most").alias("most"))
             .orderBy("i").collect())  # a row for each dimension
    centre = Centre(stats[0].n, [int(r.low) + (int(r.high) << 24) for r in stats], [r.least for r in stats], [r.most for r in stats])
    v = covariance(rows, dim, centre)
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1], directions[:, ::-1]
    trace, kept = float(np.trace(v)), min(components, dim)
    has = [trace > 0 and e > FLAT * trace for e in values[:kept]]
    scaled = np.stack([directions[:, k] / np.sqrt(values[k]) if has[k] else np.zeros(dim) for k in range(kept)], axis=1)
    written = T.store(rows.mapInArrow(_projected(dim, centre, scaled), "vec_id long, deviation string, w array<double>"), "whitened")
    live = [k for k in range(kept) if has[k]]
    error = identity_error(written, live) if live else None
    table = F.array(*[F.struct(F.lit(k + 1).alias("component"), (F.col("w")[k] if has[k] else F.lit(None).cast("double")).alias("whitened"),
                               F.lit(float(values[k] / trace) if trace > 0 else None).cast("double").alias("explained")) for k in range(kept)])
    exact = F.col("deviation").try_cast("decimal(38,0)")
    fits = (F.length("deviation") < 19) | ((F.length("deviation") == 19) & (F.col("deviation") <= str((1 << 63) - 1)))
    return (written.select("vec_id", F.when(fits, F.col("deviation").cast("long")).alias("deviation"), exact.alias("deviation_exact"), F.explode(table).alias("c"))
            .select("vec_id", "c.component", F.lit(centre.n).cast("long").alias("n"), "deviation", "deviation_exact", "c.whitened", "c.explained",
                    F.lit(error).cast("double").alias("identity_error")))


def identity_error(written: DataFrame, live: list[int]) -> float:
    """Largest absolute entry of the covariance of columns ``live`` of ``w``, minus the identity."""
    means = written.agg(*[F.avg(F.col("w")[k]).alias(f"m{k}") for k in live]).first()
    off = {k: F.col("w")[k] - F.lit(means[f"m{k}"]) for k in live}
    wrong = [F.abs(F.avg(off[a] * off[b]) - F.lit(1.0 if a == b else 0.0)) for a, b in itertools.combinations_with_replacement(live, 2)]
    return written.agg(reduce(F.greatest, wrong).alias("e") if len(wrong) > 1 else wrong[0].alias("e")).first()["e"]


def op12_polarised_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
