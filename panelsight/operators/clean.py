"""Cleaning operators: P8-P10, C1, C2, C12, U1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelsight.functions.scalars import encode_target as _encode_target
from panelsight.schema import COERCE_COLS, KEY_COLS, TARGET_COL


def numeric_coerce(df: DataFrame, cols: list[str] = COERCE_COLS) -> DataFrame:
    """Coerce the listed columns to numbers; unparsable text and NaN -> NULL.

    Text columns go through ``try_cast`` (ANSI mode would make ``cast`` raise);
    numeric columns keep their type, doubles get NaN -> NULL.
    """
    types = dict(df.dtypes)
    exprs = {}
    for c in cols:
        if c not in types:
            continue
        t = types[c]
        if t == "string":
            v = F.expr(f"try_cast(trim(`{c}`) AS DOUBLE)")
            exprs[c] = F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)
        elif t in ("double", "float"):
            exprs[c] = F.when(F.isnan(F.col(c)), F.lit(None).cast(t)).otherwise(F.col(c))
    return df.withColumns(exprs) if exprs else df


def drop_missing_target(df: DataFrame, target: str = TARGET_COL) -> DataFrame:
    """Remove rows whose target is NULL."""
    return df.where(F.col(target).isNotNull())


def encode_target(df: DataFrame, target: str = TARGET_COL, out: str = "target") -> DataFrame:
    """P10: Low/Medium/High -> 0/1/2 (unknown -> NULL)."""
    return df.withColumn(out, _encode_target(target))


def dedup_reviews(df: DataFrame, keys: list[str] = KEY_COLS, order_col: str | None = None) -> DataFrame:
    """Keep the first row per key.

    With ``order_col`` the first row is the one with the smallest order value,
    picked by ``min_by`` -- an aggregate with a map-side partial step, so a key
    holding a large share of the rows is collapsed before the shuffle (no window
    over one huge partition). Without it, rows of a key must be identical copies
    and ``dropDuplicates`` (also a partial aggregate) keeps one of them.
    """
    if order_col is None:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest]).alias("_row")
    return (df.groupBy(*keys)
            .agg(F.min_by(packed, F.col(order_col)).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
            .select(*df.columns))


def clean_panel(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """Dedup -> drop missing target -> coerce numerics (in that order)."""
    return numeric_coerce(drop_missing_target(dedup_reviews(df, order_col=order_col)))


def clean_counts(raw: DataFrame, order_col: str | None = None) -> DataFrame:
    """Row counts before/after dedup and target drop, from one keyed aggregate."""
    tgt = (F.min_by(F.col(TARGET_COL), F.col(order_col)) if order_col
           else F.first(F.col(TARGET_COL)))
    g = raw.groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("k"), tgt.alias("t"))
    return g.agg(F.sum("k").cast("bigint").alias("rows_raw"),
                 F.count(F.lit(1)).alias("rows_dedup"),
                 F.count("t").alias("rows_clean"))


def quality_profile(df: DataFrame, cols: list[str], keys: list[str] = KEY_COLS) -> DataFrame:
    """Null count / rate per column plus the repeated-key count.

    Rows are first combined per key (partial aggregate, so a hot key is
    collapsed map-side), then a single global aggregate yields the row count,
    the number of repeated rows and each column's null count; ``stack``
    unpivots to (column_name, null_count, null_rate, repeated_keys).
    """
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_k"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)])
    wide = per_key.agg(
        F.sum("_k").alias("_n"),
        F.sum(F.col("_k") - 1).cast("bigint").alias("repeated_keys"),
        *[F.sum(f"_null_{i}").alias(f"_null_{i}") for i in range(len(cols))])
    stack = ", ".join(f"'{c}', _null_{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("_n", "repeated_keys",
                           f"stack({len(cols)}, {stack}) AS (column_name, null_count)")
    return long.select("column_name",
                       F.col("null_count").cast("bigint").alias("null_count"),
                       (F.col("null_count") / F.col("_n")).alias("null_rate"),
                       "repeated_keys")


def append_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Concatenate by column name."""
    return df.unionByName(extra)


def string_typed(df: DataFrame) -> DataFrame:
    """All columns as text (what an untyped CSV read would give)."""
    return df.select(*[F.col(c).cast(T.StringType()).alias(c) for c in df.columns])
