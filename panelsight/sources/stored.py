"""Write-once intermediate tables in the shared checkpoint folder.

The review panel is the only expensive derivation (a full aggregate of the
line items). Queries that need it read a parquet copy written once per
session and input folder, partitioned by ``review_year``: this cuts the
lineage (a lost executor re-reads files instead of re-aggregating the line
items), lets the time split prune year directories, and keeps one query from
rebuilding the panel in several branches of its plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelsight.session import input_stamp, remove, work_dir

_STORE: dict = {}


INPUTS = ("lineitem", "supplier", "nation", "region")
ROWS_PER_FILE = 16_384  # what reads a copy does far more work on a row than reading it: a year's rows are many tasks


def materialize(df: DataFrame, name: str, partition_by: str | None = None, rows_per_file: int = 0) -> tuple[DataFrame, str]:
    """Write ``df`` as parquet under the shared checkpoint folder; the copy and its path.

    With ``partition_by`` rows are first rebalanced by that column. Files have
    up to ``rows_per_file`` rows (0: as many as a task has).
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.parquet(path).select(*df.columns), path


def inputs_stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """What the panel is built from, as it is now."""
    return tuple(input_stamp(spark, f"{sf_dir.rstrip('/')}/{n}.parquet") for n in INPUTS)


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """``build(spark, sf_dir)``, written once for each session, input folder and state of its files."""
    key, stamp = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name), inputs_stamp(spark, sf_dir)
    if key in _STORE and _STORE[key][0] != stamp:
        refresh(spark, sf_dir)
    if key not in _STORE:
        _STORE[key] = (stamp, *materialize(build(spark, sf_dir), name, partition_by="review_year", rows_per_file=ROWS_PER_FILE))
    return _STORE[key][1]


def refresh(spark: SparkSession, sf_dir: str) -> None:
    """Forget and remove what is stored of an input folder."""
    for key in [k for k in _STORE if k[:2] == (spark.sparkContext.applicationId, sf_dir.rstrip("/"))]:
        remove(spark, _STORE.pop(key)[2])


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with planted defects, which the registered queries and their SQL share."""
    from panelsight.sources.panel import load_panel
    return stored(spark, sf_dir, "panel", lambda s, d: load_panel(s, d, with_defects=True))


def stored_clean_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelsight.operators.clean import clean_panel
    return stored(spark, sf_dir, "clean-panel", lambda s, d: clean_panel(stored_panel(s, d)))


def stored_bucketed(spark: SparkSession, sf_dir: str, name: str, build, keys: list[str], buckets: int | None = None) -> DataFrame:
    """``build(spark, sf_dir)`` as a table bucketed and sorted by ``keys``, written once like ``stored``.

    Aggregates and joins on these keys then need no exchange of it. A bucket
    counts as one task: ``buckets`` (the session's shuffle partitions if None)
    has to grow with the table.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key, stamp = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), f"{name}-{buckets}"), inputs_stamp(spark, sf_dir)
    if key in _STORE and _STORE[key][0] != stamp:
        refresh(spark, sf_dir)
    if key not in _STORE:
        path = work_dir(spark, name)
        table = path.rsplit("/", 1)[1].replace("-", "_")
        dealt = build(spark, sf_dir).repartition(buckets, *keys)
        dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)
        _STORE[key] = (stamp, spark.table(table), path)
    return _STORE[key][1]
