"""Exact quantiles in two scans, and running totals over sorted ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from panelsight.sources.stored import materialize


def running_total(df: DataFrame, group: list[str], order: list[str], count: str) -> tuple[DataFrame, str]:
    """``df`` with ``before`` (sum of ``count`` over the group's rows of lesser order) and ``total`` (of the group), and the
    folder of the copy that it reads, which the caller removes.

    Rows are dealt by ranges of (group, order) and numbered within each range;
    a range then adds what the ranges before it hold, one row for each.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt, path = materialize(df.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    ahead = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_range", *group).agg(F.sum(count).alias("_sum"))
    ranges = Window.partitionBy(*group).orderBy("_range")
    offsets = sums.select(
        "_range", *group, F.coalesce(F.sum("_sum").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(Window.partitionBy(*group)).alias("total"))
    inside = dealt.withColumn("_inside", F.coalesce(F.sum(count).over(ahead), F.lit(0)))
    return (inside.join(offsets, ["_range", *group]).withColumn("before", F.col("_offset") + F.col("_inside"))
            .drop("_range", "_offset", "_inside")), path


SKETCH = 10_000  # accuracy of the sketch: ranks are off by a share of 1 / SKETCH at most
FEW = 20_000  # values of a bracket that the driver sorts
MOST_NARROWED = 4  # times; each leaves a few ten thousandths of the rows


class _Bracket:
    """A value range that holds the order statistics on both sides of a quantile's place."""

    def __init__(self, column: int, point: float, n: int):
        self.column, self.point, self.n = column, point, n
        self.place = point * (n - 1)
        self.low, self.high, self.below, self.inside = float("-inf"), float("inf"), 0, n
        self.slack, self.narrowed = 1, 0

    def probes(self) -> list[float]:
        """Shares of the bracket's values between which the places lie, with room for the sketch's error."""
        room = self.slack * (2 / SKETCH + 2 / self.inside)
        at = (self.place - self.below) / self.inside
        return [min(max(at - room, 0.0), 1.0), min(max(at + room, 0.0), 1.0)]

    def holds(self, below: int, inside: int) -> bool:
        return below <= int(self.place) and -(-self.place // 1) < below + inside

    def found(self, values: list[tuple[float, int]]) -> float:
        """The quantile, from the bracket's (value, count) in order."""
        def at(k: int) -> float:
            seen = self.below
            for v, c in values:
                seen += c
                if k < seen:
                    return v
            raise ValueError("a bracket lacks its quantile")
        k = int(self.place // 1)
        share = self.place - k
        return at(k) if share == 0 else (1 - share) * at(k) + share * at(k + 1)


def exact_quantiles(df: DataFrame, cols: list[str], points: list[float], more: list[Column] = ()) -> tuple[list[list], Row]:
    """Per column its exact quantiles by linear interpolation (None without a value), and the row of the aggregates ``more``.

    The first scan sketches, for each column and point, two values with the
    quantile between them, and computes ``more``. The second counts what lies
    below them and collects the counted values between: a few ten thousandths
    of the rows. Where that is still more than FEW, the bracket is narrowed
    again by a sketch of its own. Nothing is written or shuffled but counts.
    NULL and NaN take no part.
    """
    # expressions as text: one call to the JVM for each instead of one for each part
    value = [f"nullif(CAST(`{c}` AS DOUBLE), {_double(float('nan'))})" for c in cols]
    x = [f"_x{i}" for i in range(len(cols))]
    whole, df = df, df.selectExpr(*[f"{v} AS {n}" for v, n in zip(value, x)])
    share = 2 / SKETCH
    shares = [s for p in points for s in (max(p - share, 0.0), min(p + share, 1.0))]
    probes = ", ".join(_double(p) for p in shares)
    sketched = [F.expr(f"struct(count({v}) AS n, percentile_approx({v}, array({probes}), {SKETCH}) AS q) AS _q{i}") for i, v in enumerate(value)]
    first = whole.agg(*sketched, *more).first()
    brackets = [_Bracket(i, p, first[f"_q{i}"]["n"]) for i in range(len(cols)) for p in points if first[f"_q{i}"]["n"]]
    for b in brackets:
        lo, hi = first[f"_q{b.column}"]["q"][2 * points.index(b.point) :][:2]
        # beside the sketch's values the places may be one value further
        if b.n > SKETCH:
            b.low, b.high = (lo if b.point > share else b.low), (hi if b.point < 1 - share else b.high)
    if any(b.n <= SKETCH for b in brackets):  # too few values for shares: brackets by rank
        _narrow(df, x, [b for b in brackets if 64 < b.n <= SKETCH])
    pending = brackets
    while pending:
        pending = _counted(df, x, pending)
    done = {(b.column, b.point): b.value for b in brackets}
    return [[done.get((i, p)) for p in points] for i in range(len(cols))], first


def _double(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def _narrow(df: DataFrame, x: list[str], brackets: list[_Bracket]) -> None:
    """New ends for the brackets, by a sketch of the values inside each."""
    if not brackets:
        return
    inside = [f"CASE WHEN {x[b.column]} BETWEEN {_double(b.low)} AND {_double(b.high)} THEN {x[b.column]} END" for b in brackets]
    row = df.agg(*[F.expr(f"percentile_approx({v}, array({', '.join(map(_double, b.probes()))}), {SKETCH}) AS _{k}") for k, (v, b) in enumerate(zip(inside, brackets))]).first()
    for k, b in enumerate(brackets):
        p, (lo, hi) = b.probes(), row[f"_{k}"]
        b.low, b.high = (lo if p[0] > 0 else b.low), (hi if p[1] < 1 else b.high)
        b.narrowed += 1


def _counted(df: DataFrame, x: list[str], brackets: list[_Bracket]) -> list[_Bracket]:
    """Count below and inside the brackets and sort the values of those that hold few; the others, narrowed.

    One scan: the brackets of a column, merged where they overlap, cut its
    values into numbered regions. Rows are counted by (column, region, value),
    the value only inside a bracket that holds few.
    """
    # a bracket that stays large holds few values, each of many rows
    few = [b for b in brackets if b.narrowed >= MOST_NARROWED or min(b.n, 6 * b.inside // SKETCH + 64) <= FEW]
    cells, places = [], {}
    for i in sorted({b.column for b in brackets}):
        merged: list[list] = []  # disjoint [low, high, brackets]
        for b in sorted((b for b in brackets if b.column == i), key=lambda b: (b.low, b.high)):
            if merged and b.low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b.high)
                merged[-1][2].append(b)
            else:
                merged.append([b.low, b.high, [b]])
        region, shown = "0", []
        for j, (low, high, held) in enumerate(merged):
            region += f" + CAST({x[i]} >= {_double(low)} AS INT) + CAST({x[i]} > {_double(high)} AS INT)"
            if any(b in few for b in held):
                shown.append(f"{x[i]} BETWEEN {_double(low)} AND {_double(high)}")
            for b in held:
                b.low, b.high = low, high
                places[id(b)] = (i, 2 * j + 1)
        cells.append(f"{i}, {region}, CASE WHEN {' OR '.join(shown) or 'false'} THEN {x[i]} END")
    # regions number the values in order: even ones lie between the brackets, odd ones in them
    found = df.selectExpr(f"stack({len(cells)}, {', '.join(cells)}) AS (k, r, v)")
    rows = found.where("r IS NOT NULL").groupBy("k", "r", "v").agg(F.count(F.lit(1)).alias("c")).collect()  # FEW values a bracket, about
    rest, of_column = [], {}
    for row in rows:
        of_column.setdefault(row["k"], []).append((row["r"], row["v"], row["c"]))
    for b in brackets:
        k, r = places[id(b)]
        below = sum(c for q, _, c in of_column[k] if q < r)
        own = [(v, c) for q, v, c in of_column[k] if q == r]
        inside = sum(c for _, c in own)
        if not b.holds(below, inside):  # the sketch was further off than it should: wider
            b.low, b.high, b.below, b.inside, b.slack = float("-inf"), float("inf"), 0, b.n, b.slack * 16
            rest.append(b)
            continue
        b.below, b.inside = below, inside
        if own[0][0] is not None:
            b.value = b.found(sorted(own))
        else:
            rest.append(b)
    _narrow(df, x, rest)
    return rest


def quantiles(df: DataFrame, cols: list[str], points: list[float]) -> DataFrame:
    """``exact_quantiles`` as a DataFrame (column_name, q0, q1, ...); columns without a value are left out."""
    found, _ = exact_quantiles(df, cols, points)
    rows = [(c, *q) for c, q in zip(cols, found) if q[0] is not None]
    return df.sparkSession.createDataFrame(rows, ", ".join(["column_name string", *[f"q{i} double" for i in range(len(points))]]))
