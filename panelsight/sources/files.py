"""File sources and sinks (S1-S5, S8) and id resolution.

CSV inputs are read as text with a header and converted with ``try_cast``, so
an unparsable cell becomes NULL instead of failing the job (ANSI mode would
make a plain cast raise). All paths go through ``DataFrameReader/Writer`` and
therefore work on any Hadoop-compatible shared file system.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelsight.operators.clean import numeric_coerce
from panelsight.schema import (
    BATCH_REQUIRED, CATEGORICAL_FEATURES, NUMERIC_FEATURES, PANEL_SCHEMA,
)

ID_ALIASES = ["employee_id", "Employee ID", "id"]


def _typed(df: DataFrame, schema) -> DataFrame:
    """Text columns -> the schema's types via try_cast (bad cell -> NULL)."""
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        t = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        v = c if t == "string" else F.expr(f"try_cast(trim(`{f.name}`) AS {t})")
        if t in ("double", "float"):
            v = F.when(~F.isnan(v), v)  # a NaN cell is a missing one
        cols.append(v.alias(f.name))
    return df.select(*cols)


CSV = {"header": True, "nullValue": "\\N"}  # an empty text is a quoted nothing, a NULL is \\N


def read_panel_csv(spark: SparkSession, path: str) -> DataFrame:
    """Panel CSV with header; typed by the panel schema."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return _typed(raw, PANEL_SCHEMA)


@dataclass
class Scan:
    """A CSV scan with its quarantine: typed rows, the raw text of rejected ones, and counts that add up."""
    rows: DataFrame
    rejects: DataFrame
    n_in: int
    n_out: int
    n_rejected: int
    n_bad_cells: int


def scan_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType, out_dir: str, required: list[str] = ()) -> Scan:
    """S1 / S2 with rejects: CSV with a header read once, good rows to ``out_dir/rows``, others to ``out_dir/rejects``.

    A record is rejected if it is ragged (more or fewer cells than the header)
    or if a required column is empty; its whole text is kept, with the reason. A
    cell that its type can't hold is NULL, as elsewhere, and counted. Records
    may hold quoted line breaks, quotes (doubled) and separators. The columns of
    the file are taken by the header's names; absent ones are NULL.
    """
    options = {"header": True, "multiLine": True, "escape": '"', "quote": '"', "mode": "PERMISSIVE"}
    names = spark.read.options(**options, inferSchema=False).csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_corrupt", T.StringType())])
    raw = spark.read.options(**options, enforceSchema=True, columnNameOfCorruptRecord="_corrupt").schema(text).csv(path)
    typed, bad = [], F.lit(0)
    for f in schema.fields:
        if f.name not in names:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        kind, cell = f.dataType.simpleString(), F.col(f"`{f.name}`")
        v = cell if kind == "string" else F.expr(f"try_cast(trim(`{f.name}`) AS {kind})")
        if kind in ("double", "float"):
            v = F.when(~F.isnan(v), v)
        bad = bad + F.when(cell.isNotNull() & (F.trim(cell) != "") & v.isNull(), 1).otherwise(0)
        typed.append(v.alias(f.name))
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(f"`{c}`").isNull() | (F.trim(F.col(f"`{c}`")) == "")
    reason = F.when(F.col("_corrupt").isNotNull(), "ragged").when(missing, "required")
    whole = F.coalesce(F.col("_corrupt"), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names])))
    seen = Observation()
    judged = raw.select(F.struct(*typed).alias("row"), reason.alias("reason"), F.when(reason.isNotNull(), whole).alias("record"), F.when(reason.isNull(), bad).alias("bad"))
    # both sinks are partitions of one write, so that the file is read once and the counts are of that reading
    observed = judged.observe(seen, F.count(F.lit(1)).alias("n_in"), F.count_if(F.col("reason").isNull()).alias("n_out"),
                              F.count("reason").alias("n_rejected"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad_cells"))
    folder = f"{out_dir.rstrip('/')}/scan"
    observed.select("row", "reason", "record", F.col("reason").isNotNull().alias("rejected")).write.mode("overwrite").partitionBy("rejected").parquet(folder)
    kept = T.StructType([T.StructField("row", schema), T.StructField("reason", T.StringType()), T.StructField("record", T.StringType()), T.StructField("rejected", T.BooleanType())])
    written = spark.read.schema(kept).parquet(folder)
    counts = seen.get
    return Scan(written.where("not rejected").select("row.*"), written.where("rejected").select("reason", "record"),
                counts["n_in"], counts["n_out"], counts["n_rejected"], counts["n_bad_cells"])


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = "review_year") -> None:
    """S3: write the panel (CSV with header, or parquet partitioned by year)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        if partition_by:  # a few files for each value, not one from every task
            w = df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by)
        w.parquet(path)


def write_report(df: DataFrame, name: str, out_dir: str) -> str:
    """One report table as CSV with header under ``out_dir/name``."""
    path = f"{out_dir.rstrip('/')}/{name}"
    df.write.mode("overwrite").options(**CSV).csv(path)
    return path


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a saved report back with an explicit schema."""
    return spark.read.options(**CSV).schema(schema).csv(path)


def write_scored(df: DataFrame, path: str) -> None:
    """Scored batch export (CSV with header)."""
    df.write.mode("overwrite").options(**CSV).csv(path)


def resolve_id(df: DataFrame) -> DataFrame:
    """Accept ``employee_id``, ``Employee ID`` or ``id``; otherwise derive a
    row identifier. The id is always text."""
    for a in ID_ALIASES:
        if a in df.columns:
            out = df.withColumnRenamed(a, "employee_id") if a != "employee_id" else df
            return out.withColumn("employee_id", F.col("employee_id").cast("string"))
    return df.withColumn("employee_id", F.concat(F.lit("ROW"), F.monotonically_increasing_id().cast("string")))


def missing_batch_columns(df: DataFrame) -> list[str]:
    """Required scoring columns that are absent (the id may be any alias)."""
    have = set(df.columns)
    miss = [c for c in BATCH_REQUIRED if c != "employee_id" and c not in have]
    if not any(a in have for a in ID_ALIASES):
        miss.insert(0, "employee_id")
    return miss


def read_batch_csv(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Scoring CSV; numeric features coerced, id resolved. With
    ``strict=True`` a missing required column raises; otherwise scoring fills
    absent features by name (P16)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    miss = missing_batch_columns(raw)
    if strict and miss:
        raise ValueError(f"missing required columns: {miss}")
    out = numeric_coerce(resolve_id(raw), NUMERIC_FEATURES)
    return out.select("employee_id", *[c for c in out.columns if c != "employee_id"])


BATCH_COLUMNS = ["employee_id"] + NUMERIC_FEATURES + CATEGORICAL_FEATURES
