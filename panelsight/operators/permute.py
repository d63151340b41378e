"""True random permutations of a table's rows: a keyed bijection of their ranks.

Rows get the ranks 0 .. n - 1 of a hashed order: they are dealt by ranges of
the hash, sorted inside, and stored; a row's rank is its place in its range
plus the rows of the ranges before. No task sees more than a range, and no
window is used. ``permuted`` then maps ranks to ranks: a Feistel network over
pairs of numbers below the root of n, walked again while it leaves 0 .. n - 1.
Each key gives another permutation, and nothing about it is stored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelsight.sources.stored import ROWS_PER_FILE, materialize

FEISTEL_ROUNDS = 6
WALK = 64  # a walk leaves the range with probability 2 / sqrt(n) at most each time; under 1000 rows it can't be longer


def with_ranks(df: DataFrame, order: list[Column]) -> tuple[DataFrame, int, str]:
    """``df`` with ``rank`` (0 .. n - 1, by ``order``), n, and the folder of the stored copy, which the caller removes."""
    spark = df.sparkSession
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    stored, path = materialize(dealt, "ranked", rows_per_file=ROWS_PER_FILE)
    part = F.shiftright("_place", 33)
    sizes = sorted((r["p"], r["n"]) for r in stored.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row for each task
    before, n = [], 0
    for p, k in sizes:
        before.append((p, n))
        n += k
    offsets = F.broadcast(spark.createDataFrame(before, "_part bigint, _before bigint")) if before else spark.createDataFrame([], "_part bigint, _before bigint")
    ranked = stored.join(offsets, part == F.col("_part")).withColumn("rank", F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    return ranked.drop("_place", "_part", "_before"), n, path


def permuted(df: DataFrame, rank: str, n: int, key: list[str], out: str, seed: int = 0) -> DataFrame:
    """``df`` with ``out``, the image of ``rank`` (0 .. n - 1) in the permutation of the row's ``key`` columns.

    The network is a chain of projections of two numbers each. Only the few
    rows that leave the range go on, in one expression.
    """
    side = max(2, math.isqrt(max(n - 1, 0)) + 1)
    keys = [F.col(c) for c in key]

    def mixed(right: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(right, F.lit(i), F.lit(seed), *keys), F.lit(side))

    def once(x: Column) -> Column:
        left, right = x % side, F.floor(x / side)
        for i in range(FEISTEL_ROUNDS):
            left, right = right, (left + mixed(right, i)) % side
        return right * side + left

    x = F.col(rank).cast("bigint")
    df = df.withColumns({"_l0": x % side, "_r0": F.floor(x / side)})
    for i in range(FEISTEL_ROUNDS):
        left, right = F.col(f"_l{i}"), F.col(f"_r{i}")
        df = df.withColumns({f"_l{i + 1}": right, f"_r{i + 1}": (left + mixed(right, i)) % side}).drop(f"_l{i}", f"_r{i}")
    df = df.withColumn("_y", F.col(f"_r{FEISTEL_ROUNDS}") * side + F.col(f"_l{FEISTEL_ROUNDS}")).drop(f"_l{FEISTEL_ROUNDS}", f"_r{FEISTEL_ROUNDS}")
    y = F.col("_y")
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), y, lambda a, _: F.when(a >= n, once(a)).otherwise(a))
    df = df.withColumn("_y", F.when(y < n, y).otherwise(walked))
    return df.withColumn(out, F.when(y < n, y).otherwise(F.raise_error(F.lit("a permutation left its range")).cast("bigint"))).drop("_y")
