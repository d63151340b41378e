"""Insight aggregates A1-A14, J5 and the preview/shortlist operators W4-W6.

All of these reduce the panel with hash aggregates (partial + final), so the
shuffled volume is one row per group per map task whatever the key skew.
Exact quantiles (A6) take two scans (``operators.ranks``), the first of which
computes the other statistics too; ``approx=True`` takes one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelsight.functions.scalars import quarter_key, rnd
from panelsight.operators.joins import sized_broadcast
from panelsight.operators.ranks import exact_quantiles
from panelsight.schema import BAND_DISPLAY_ORDER, TARGET_COL

# FIXED VALUES: column groups used by the insight reports
HIST_FEATURES = ["training_hours", "attendance_rate", "goal_achievement_pct",
                 "manager_rating", "peer_score", "overtime_hours"]
CORR_FEATURES = ["training_hours", "attendance_rate", "goal_achievement_pct",
                 "manager_rating", "peer_score", "overtime_hours",
                 "experience_years", "salary", "projects_completed", "performance_score"]
BAND_MEAN_FEATURES = ["training_hours", "attendance_rate", "goal_achievement_pct",
                      "manager_rating", "peer_score", "overtime_hours", "experience_years"]
DESCRIBE_COLS = ["age", "experience_years", "salary", "review_year", "review_quarter",
                 "training_hours", "attendance_rate", "overtime_hours", "projects_completed",
                 "manager_rating", "peer_score", "goal_achievement_pct", "performance_score"]
HIST_BINS = 20

REPORT_DP = 6  # unrounded float aggregates are reported to 1e-6


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    """Keep the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def band_distribution(df: DataFrame, band_col: str = TARGET_COL) -> DataFrame:
    """A1: count and share of rows per band, High/Medium/Low order; absent band
    -> NULL count. One global aggregate, unpivoted with ``stack``."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.sum(F.when(F.col(band_col) == b, 1)).alias(f"_c{i}")
             for i, b in enumerate(BAND_DISPLAY_ORDER)]
    stack = ", ".join(f"'{b}', {i}, _c{i}" for i, b in enumerate(BAND_DISPLAY_ORDER))
    return (df.agg(*aggs)
            .selectExpr("_n", f"stack({len(BAND_DISPLAY_ORDER)}, {stack}) AS (band, band_order, n)")
            .select("band", F.col("band_order").cast("int").alias("band_order"),
                    F.col("n").cast("bigint").alias("n"),
                    rnd(F.col("n") * 100.0 / F.col("_n"), 1).alias("pct")))


def quarterly_trend(df: DataFrame) -> DataFrame:
    """A2: mean score per quarter, with the sortable quarter key."""
    return (df.where(F.col("quarter_label").isNotNull())
            .groupBy("quarter_label")
            .agg(rnd(F.avg("performance_score"), REPORT_DP).alias("mean_score"),
                 F.count("performance_score").alias("n"))
            .withColumn("quarter_key", quarter_key("quarter_label"))
            .orderBy("quarter_key"))


def dept_band_counts(df: DataFrame) -> DataFrame:
    """A3: rows per (department, band); NULL keys dropped as in pandas."""
    return (df.where(F.col("department").isNotNull() & F.col(TARGET_COL).isNotNull())
            .groupBy("department", TARGET_COL).agg(F.count(F.lit(1)).alias("n")))


def dept_band_pct(df: DataFrame) -> DataFrame:
    """A4: per department, % of rows in each band (columns High, Medium, Low).

    One grouped aggregate with a conditional count per band (a single
    shuffle; ``pivot`` would plan a second aggregation and shuffle).
    """
    b = F.col(TARGET_COL)
    counts = (df.where(F.col("department").isNotNull() & b.isNotNull())
              .groupBy("department")
              .agg(*[F.count_if(b == band).alias(band) for band in BAND_DISPLAY_ORDER]))
    tot = sum((F.col(x) for x in BAND_DISPLAY_ORDER), F.lit(0))
    return counts.select(
        "department",
        *[rnd(F.col(x) * 100.0 / tot, REPORT_DP).alias(f"{x.lower()}_pct") for x in BAND_DISPLAY_ORDER],
        tot.cast("bigint").alias("n"))


def band_feature_means(df: DataFrame, cols: list[str] = BAND_MEAN_FEATURES) -> DataFrame:
    """A5: mean of the listed features per band, 2 dp."""
    cols = _present(df, cols)
    return (df.where(F.col(TARGET_COL).isNotNull()).groupBy(TARGET_COL)
            .agg(*[rnd(F.avg(c), 2).alias(f"mean_{c}") for c in cols]))


def describe_numeric(df: DataFrame, cols: list[str] = DESCRIBE_COLS, approx: bool = False) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max
    per column, 2 dp. Quartiles are exact, in a second scan of what a
    sketch leaves open, or with ``approx`` from a sketch in the same pass as the rest."""
    cols = _present(df, cols)
    points = [0.25, 0.5, 0.75]

    def moments(i: int, more: str = "") -> Column:
        x = f"CAST(`{cols[i]}` AS DOUBLE)"
        return F.expr(f"struct(count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, min({x}) AS min, max({x}) AS max{more.format(x=x)}) AS _s{i}")

    if approx:
        row = df.agg(*[moments(i, ", percentile_approx({x}, array(0.25, 0.5, 0.75), 100000) AS q") for i in range(len(cols))]).first()
        q = [row[f"_s{i}"]["q"] or [None] * 3 for i in range(len(cols))]
    else:
        q, row = exact_quantiles(df, cols, points, [moments(i) for i in range(len(cols))])
    found = [(c, *[row[f"_s{i}"][k] for k in ("count", "mean", "std", "min")], *[float(v) if v is not None else None for v in q[i]], row[f"_s{i}"]["max"]) for i, c in enumerate(cols)]
    names = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    local = df.sparkSession.createDataFrame(found, "column_name string, count bigint, " + ", ".join(f"{n} double" for n in names))  # a row for each column
    return local.select("column_name", "count", *[rnd(n, 2).alias(n) for n in names])


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column (only columns with nulls) and its type."""
    types = dict(df.dtypes)
    cols = df.columns
    aggs = [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    stack = ", ".join(f"'{c}', '{types[c]}', _n{i}" for i, c in enumerate(cols))
    return (df.agg(*aggs)
            .selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, dtype, null_count)")
            .where(F.col("null_count") > 0))


def correlation_matrix(df: DataFrame, cols: list[str] = CORR_FEATURES) -> DataFrame:
    """Pairwise-complete Pearson correlation, full matrix in long form.

    One aggregate with a ``corr`` per unordered pair (and the diagonal);
    ``corr`` skips rows where either side is NULL, as pandas does per pair.
    """
    cols = _present(df, cols)
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            b = cols[j]
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{i}_{j}"))
            pairs.append((i, j))
    entries = []
    for i, j in pairs:
        entries.append(f"{i}, {j}, '{cols[i]}', '{cols[j]}', _r{i}_{j}")
        if i != j:
            entries.append(f"{j}, {i}, '{cols[j]}', '{cols[i]}', _r{i}_{j}")
    long = df.agg(*aggs).selectExpr(
        f"stack({len(entries)}, {', '.join(entries)}) AS (i, j, feature_x, feature_y, corr)")
    return long.select(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"),
                       "feature_x", "feature_y",
                       F.when(F.isnan("corr"), None).otherwise(rnd("corr", REPORT_DP)).alias("corr"))


def lower_triangle(corr: DataFrame) -> DataFrame:
    """Keep the strictly lower triangle of A8."""
    return corr.where(F.col("i") > F.col("j"))


def paired_nonnull(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows where both columns are present."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull())


def pair_correlation(df: DataFrame, x: str = "training_hours", y: str = "performance_score") -> DataFrame:
    """A10: Pearson correlation of one pair."""
    return df.agg(rnd(F.corr(F.col(x), F.col(y)), REPORT_DP).alias("corr"),
                  F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n_pairs"))


def trend_line(df: DataFrame, x: str = "training_hours", y: str = "performance_score",
               min_pairs: int = 10) -> DataFrame:
    """Least-squares line y = slope*x + intercept over complete pairs,
    reported only when there are more than ``min_pairs`` pairs."""
    g = df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
               F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
               F.regr_count(F.col(y), F.col(x)).alias("n_pairs"))
    ok = F.col("n_pairs") > min_pairs
    return g.select(F.when(ok, rnd("slope", REPORT_DP)).alias("slope"),
                    F.when(ok, rnd("intercept", REPORT_DP)).alias("intercept"),
                    F.col("n_pairs").cast("bigint").alias("n_pairs"))


def trend_line_points(df: DataFrame, x: str = "training_hours", y: str = "performance_score",
                      n_points: int = 100, min_pairs: int = 10) -> DataFrame:
    """The A11 line evaluated at ``n_points`` evenly spaced x in [min, max]
    (x range of the non-null x values)."""
    g = df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
               F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
               F.regr_count(F.col(y), F.col(x)).alias("n_pairs"),
               F.min(x).alias("lo"), F.max(x).alias("hi"))
    pts = (g.where(F.col("n_pairs") > min_pairs)
           .select("*", F.explode(F.sequence(F.lit(0), F.lit(n_points - 1))).alias("idx")))
    xv = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("idx") / (n_points - 1)
    return pts.select(F.col("idx").cast("int").alias("idx"),
                      rnd(xv, REPORT_DP).alias("x"),
                      rnd(F.col("slope") * xv + F.col("intercept"), REPORT_DP).alias("y"))


def feature_histogram(df: DataFrame, cols: list[str] = HIST_FEATURES, bins: int = HIST_BINS,
                      band_col: str = TARGET_COL) -> DataFrame:
    """Equal-width histogram (density) per (feature, band), NULLs dropped.

    Data are unpivoted to (feature, band, value) with ``stack``; the per-group
    min/max come from one aggregate and are joined back on the group key (one
    row per feature x band, broadcast after a size check). The last bin is closed on
    the right; a zero-width range becomes [v-0.5, v+0.5].
    """
    cols = _present(df, cols)
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = (df.where(F.col(band_col).isNotNull())
            .selectExpr(f"`{band_col}` AS band", f"stack({len(cols)}, {stack}) AS (feature, value)")
            .where(F.col("value").isNotNull()))
    rng = (long.groupBy("feature", "band")
           .agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"), F.count(F.lit(1)).alias("n_group"))
           .withColumn("lo", F.when(F.col("vmin") == F.col("vmax"), F.col("vmin") - 0.5).otherwise(F.col("vmin")))
           .withColumn("hi", F.when(F.col("vmin") == F.col("vmax"), F.col("vmax") + 0.5).otherwise(F.col("vmax")))
           .withColumn("width", (F.col("hi") - F.col("lo")) / bins))
    rng = df.sparkSession.createDataFrame(rng.collect(), rng.schema)  # one row per (feature, band)
    # one row per (feature, band): broadcast after a size check -- a shuffle
    # join on this key would send each group's values to a single task
    ranges = sized_broadcast(rng.select("feature", "band", "lo", "width"))
    binned = long.join(ranges, ["feature", "band"]).select(
        "feature", "band",
        F.least(F.floor((F.col("value") - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("int").alias("bin"))
    counts = binned.groupBy("feature", "band", "bin").agg(F.count(F.lit(1)).alias("n"))
    # every bin of every (feature, band) group, empty ones with n = 0
    grid = rng.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts, ["feature", "band", "bin"], "left")
            .select("feature", "band", F.col("bin").cast("int").alias("bin"),
                    rnd(F.col("lo") + F.col("bin") * F.col("width"), REPORT_DP).alias("bin_start"),
                    rnd(F.col("lo") + (F.col("bin") + 1) * F.col("width"), REPORT_DP).alias("bin_end"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
                    rnd(F.coalesce(F.col("n"), F.lit(0)) / (F.col("n_group") * F.col("width")), REPORT_DP)
                    .alias("density")))


def distinct_quarters(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Distinct quarter labels per split."""
    return df.select(split_col, "quarter_label").distinct()


def top_k(df: DataFrame, order_col: str, k: int, tie_col: str) -> DataFrame:
    """First k rows by ``order_col`` desc with a name tie-break."""
    return df.orderBy(F.col(order_col).desc(), F.col(tie_col).asc()).limit(k)


def performer_shortlists(scored: DataFrame, k: int = 10, score_col: str = "p_rank_score",
                         band_col: str = "predicted_band") -> DataFrame:
    """Up to ``k`` rows predicted High and ``k`` predicted Low, ranked by the
    score column (desc) then employee id; 5 report columns.

    ``row_number() <= k`` is planned with a map-side WindowGroupLimit, so each
    task forwards at most k rows per band to the shuffle; no task ever holds a
    whole band.
    """
    cols = ["employee_id", "department", "experience_years", "goal_achievement_pct", "manager_rating"]
    sel = scored.where(F.col(band_col).isin("High", "Low"))
    order = [F.col(score_col).desc(), F.col("employee_id").asc(),
             F.col("review_year").asc(), F.col("review_quarter").asc()]
    ranked = sel.withColumn("rank", F.row_number().over(Window.partitionBy(band_col).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select(
        F.col(band_col).alias("list_band"), "rank", *cols, rnd(F.col(score_col), REPORT_DP).alias("score"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First n rows."""
    return df.limit(n)
