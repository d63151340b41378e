"""Preparation: time split, median imputer, label encoder, population scaler,
feature assembly (C3-C11, P16, P19, A15, A18).

Fitting is a handful of aggregates over the *training* rows. A number per
column (median, mean, deviation) comes back to the driver once and is applied
as a literal. The encoder is a table; columns of up to ``MAP_VALUES`` values
are applied as a literal map, others joined by value, whatever their size.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelsight.functions.scalars import encode_target, quarter_key
from panelsight.operators.joins import sized_broadcast
from panelsight.operators.ranks import exact_quantiles, quantiles, running_total
from panelsight.schema import (
    CATEGORICAL_FEATURES, DEFAULT_CUTOFF, FEATURE_COLS, IMPUTE_COLS, NUMERIC_FEATURES,
    TARGET_COL,
)
from panelsight.session import remove
from panelsight.sources.stored import materialize


def _key_of(label: str) -> int:
    y, q = label.split("-Q")
    return int(y) * 10 + int(q)


def _split_key(df: DataFrame) -> Column:
    """The row's quarter; a row without one, or whose columns disagree, fails the query."""
    key = quarter_key("quarter_label")
    if {"review_year", "review_quarter"} <= set(df.columns):
        columns = F.col("review_year") * 10 + F.col("review_quarter")
        key = F.when(columns.isNull() | key.eqNullSafe(columns), key).otherwise(F.raise_error(F.concat(
            F.lit("quarter label and review columns disagree: "), F.col("quarter_label"))).cast("int"))
    return F.coalesce(key, F.raise_error(F.lit("row without a quarter label")).cast("int"))


def time_split(df: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> tuple[DataFrame, DataFrame]:
    """Quarter key < cutoff -> train, >= cutoff -> test; no row is lost.

    The further predicate on ``review_year`` lets a panel stored by year prune
    directories. It passes rows without a year, whose label decides.
    """
    k = _key_of(cutoff)
    train, test = _split_key(df) < k, _split_key(df) >= k
    if "review_year" in df.columns:
        year = F.col("review_year")
        return (df.where((year <= k // 10) | year.isNull()).where(train),
                df.where((year >= k // 10) | year.isNull()).where(test))
    return df.where(train), df.where(test)


def label_split(df: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """The two halves of ``time_split`` as one frame with a ``split`` column."""
    train, test = time_split(df, cutoff)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@dataclass
class PrepStats:
    """Fitted preparation state (C3, C5, C9): numbers by column as JSON, the encoder as a table."""
    medians: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    features: list = field(default_factory=lambda: list(FEATURE_COLS))
    encoder: DataFrame | None = None
    codes: dict = field(default_factory=dict)  # of the encoder's columns of few values: value -> code

    def __post_init__(self):
        if self.encoder is not None and not self.codes:
            self.codes = few_codes(self.encoder)

    def to_json(self) -> str:
        return json.dumps({k: getattr(self, k) for k in ("medians", "means", "stds", "features")}, sort_keys=True)

    @classmethod
    def from_json(cls, s: str, encoder: DataFrame) -> "PrepStats":
        return cls(**json.loads(s), encoder=encoder)


# --- C3 / C4: median imputer ---------------------------------------------------

def fit_median_imputer(train: DataFrame, cols: list[str] = IMPUTE_COLS, approx: bool = False) -> dict:
    """Exact median of each column on the training rows.

    ``approx=True`` uses a quantile sketch in one pass instead.
    """
    cols = [c for c in cols if c in train.columns]
    if not cols:
        return {}
    if approx:
        row = train.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 100_000).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    found, _ = exact_quantiles(train, cols, [0.5])
    return {c: q[0] for c, q in zip(cols, found)}


def median_table(train: DataFrame, cols: list[str] = IMPUTE_COLS) -> DataFrame:
    """C3 as a DataFrame (column_name, median)."""
    return quantiles(train, [c for c in cols if c in train.columns], [0.5]).select("column_name", F.col("q0").alias("median"))


def apply_median_imputer(df: DataFrame, medians: dict) -> DataFrame:
    """C4: fill NULLs with the fitted medians (a literal per column)."""
    exprs = {c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items()
             if c in df.columns and m is not None}
    return df.withColumns(exprs) if exprs else df


# --- C5 / C6 / C7: label encoder -------------------------------------------------

LOCAL_VALUES = 20_000  # distinct values of all columns together that the driver sorts
MAP_VALUES = 64  # values of a column that go into a literal map


def _cat(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit("nan"))


def fit_label_encoder(train: DataFrame, cols: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """(column_name, value, code), codes in the order of the values (NULL is the text ``nan``).

    Up to ``LOCAL_VALUES`` values come as a local table; more are ranked over
    sorted ranges into a stored one: any number of categories.
    """
    cols = [c for c in cols if c in train.columns]
    pairs = ", ".join(f"'{c}', coalesce(CAST(`{c}` AS STRING), 'nan')" for c in cols)
    values = train.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, value)").distinct()
    found = values.limit(LOCAL_VALUES + 1).collect()
    if len(found) <= LOCAL_VALUES:
        rows = []
        for c in cols:
            rows += [(c, v, k) for k, v in enumerate(sorted(r["value"] for r in found if r["column_name"] == c))]
        return train.sparkSession.createDataFrame(rows, "column_name string, value string, code int")
    ranked, path = running_total(values.withColumn("n", F.lit(1)), ["column_name"], ["value"], "n")
    encoder = materialize(ranked.select("column_name", "value", F.col("before").cast("int").alias("code")), "encoder")[0]
    remove(train.sparkSession, path)
    return encoder


def few_codes(encoder: DataFrame) -> dict[str, dict[str, int]]:
    """value -> code of the encoder's columns, those of at most MAP_VALUES values."""
    rows = encoder.where(F.col("code") <= MAP_VALUES).limit(LOCAL_VALUES + 1).collect()
    if len(rows) > LOCAL_VALUES:
        return {}
    found: dict[str, dict[str, int]] = {}
    for r in rows:
        found.setdefault(r["column_name"], {})[r["value"]] = r["code"]
    return {c: m for c, m in found.items() if len(m) <= MAP_VALUES}


def apply_label_encoder(df: DataFrame, encoder: DataFrame, unseen: str = "error",
                        cols: list[str] = CATEGORICAL_FEATURES, codes: dict | None = None) -> DataFrame:
    """Value -> code, by a literal map where ``codes`` (``few_codes`` if None) has the column, else by a join.

    ``unseen='error'`` fails the job on a value the encoder never saw (C6);
    ``unseen='zero'`` maps it to 0 (C7, scoring path).
    """
    codes = few_codes(encoder) if codes is None else codes
    for c in cols:
        if c not in df.columns:
            if unseen == "zero":
                df = df.withColumn(f"{c}_enc", F.lit(0))
                continue
            raise ValueError(f"column {c} missing for encoding")
        if c in codes:
            table = F.create_map(*[F.lit(x) for pair in codes[c].items() for x in pair])
            found = F.try_element_at(table, _cat(c))
        else:
            side = encoder.where(F.col("column_name") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
            df = df.join(sized_broadcast(side), _cat(c) == F.col("_value"), "left")
            found = F.col("_code")
        if unseen == "zero":
            code = F.coalesce(found, F.lit(0))
        else:
            code = F.when(found.isNull(), F.raise_error(
                F.concat(F.lit(f"unseen value in {c}: "), _cat(c)))).otherwise(found).cast("int")
        df = df.withColumn(f"{c}_enc", code).drop("_value", "_code")
    return df


# --- C9 / C10: population-std scaler ------------------------------------------------

def fit_standard_scaler(train: DataFrame, cols: list[str] = FEATURE_COLS) -> tuple[dict, dict]:
    """Mean and population std per column on train; zero std -> 1."""
    cols = [c for c in cols if c in train.columns]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = train.agg(*aggs).first()
    means = {c: row[f"m_{c}"] for c in cols}
    stds = {c: (row[f"s_{c}"] if row[f"s_{c}"] not in (None, 0.0) else 1.0) for c in cols}
    return means, stds


def scaler_table(train: DataFrame, cols: list[str] = FEATURE_COLS) -> DataFrame:
    """C9 as a DataFrame (column_name, mean, std)."""
    cols = [c for c in cols if c in train.columns]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")).alias(f"_s{i}"))
    stack = ", ".join(f"'{c}', _s{i}" for i, c in enumerate(cols))
    return (train.agg(*aggs).selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, s)")
            .select("column_name", F.col("s.mean").alias("mean"),
                    F.when(F.col("s.std") == 0, 1.0).otherwise(F.col("s.std")).alias("std")))


def apply_standard_scaler(df: DataFrame, means: dict, stds: dict, suffix: str = "_sc") -> DataFrame:
    """(x - mean) / std as literal arithmetic, new columns ``<c>_sc``."""
    return df.withColumns({f"{c}{suffix}": (F.col(c).cast("double") - F.lit(means[c])) / F.lit(stds[c])
                           for c in means if c in df.columns})


# --- P16 / P19: feature defaults and vector --------------------------------------

def missing_feature_defaults(df: DataFrame, cols: list[str] = NUMERIC_FEATURES,
                             fill: dict | None = None, default: float = 0.0) -> DataFrame:
    """Add absent feature columns and fill NULLs, by *name*.

    ``fill`` gives a per-column value (e.g. training medians); otherwise 0.
    """
    fill = fill or {}
    exprs = {}
    for c in cols:
        v = F.lit(fill.get(c, default))
        exprs[c] = F.coalesce(F.col(c).cast("double"), v) if c in df.columns else v.cast("double")
    return df.withColumns(exprs)


def assemble(df: DataFrame, stats: PrepStats, out: str = "features") -> DataFrame:
    """The scaled features, in the fixed order, as one vector column.

    ``handleInvalid='error'``: a NULL left in any feature (e.g. an un-imputed
    age) fails loudly instead of silently dropping the row.
    """
    cols = [f"{c}_sc" for c in stats.features]
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


# --- C11: full preparation ------------------------------------------------------------

def fit_prep(train_clean: DataFrame, approx_median: bool = False) -> PrepStats:
    """Fit imputer, encoder and scaler on the cleaned training rows only.
    ``approx_median=True`` uses a quantile sketch for the medians."""
    medians = fit_median_imputer(train_clean, approx=approx_median)
    encoder = fit_label_encoder(train_clean)
    codes = few_codes(encoder)
    encoded = apply_label_encoder(apply_median_imputer(train_clean, medians), encoder, codes=codes)
    features = [c for c in FEATURE_COLS if c in encoded.columns]
    means, stds = fit_standard_scaler(encoded, features)
    return PrepStats(medians=medians, means=means, stds=stds, features=features, encoder=encoder, codes=codes)


def transform_prep(df: DataFrame, stats: PrepStats, unseen: str = "error",
                   vector: bool = True) -> DataFrame:
    """Apply C4 -> C6 -> C10 (-> P19) and the target label (P10)."""
    out = apply_median_imputer(df, stats.medians)
    out = apply_label_encoder(out, stats.encoder, unseen=unseen, codes=stats.codes)
    out = apply_standard_scaler(out, stats.means, stats.stds)
    if TARGET_COL in out.columns:
        out = out.withColumn("label", encode_target(TARGET_COL).cast("double"))
    return assemble(out, stats) if vector else out


def prep_pipeline(clean: DataFrame, cutoff: str = DEFAULT_CUTOFF, approx_median: bool = False):
    """C11: split -> fit on train -> transform both. Returns (train, test, stats)."""
    train, test = time_split(clean, cutoff)
    stats = fit_prep(train, approx_median=approx_median)
    return transform_prep(train, stats), transform_prep(test, stats), stats


# --- A15 / A18 -------------------------------------------------------------------------

def class_balance(train: DataFrame) -> DataFrame:
    """Rows per target label in the training split, ordered."""
    return (train.where(F.col(TARGET_COL).isNotNull())
            .groupBy(encode_target(TARGET_COL).alias("target")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy("target"))


def balanced_class_weights(train: DataFrame, label_col: str = "label") -> DataFrame:
    """N / (k * count_c) over the classes present (k = classes present)."""
    counts = train.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_c"))
    return (counts.select(
        label_col, "n_c",
        (F.sum("n_c").over(_all()) / (F.count(F.lit(1)).over(_all()) * F.col("n_c"))).alias("weight")))


def _all():
    from pyspark.sql import Window
    # only ever applied to an aggregated frame (one row per class)
    return Window.partitionBy()
