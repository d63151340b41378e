"""The batch scorer applied to a landing folder with Structured Streaming.

Scoring is stateless (encode -> fill -> scale -> ``model.transform`` -> rule
columns), so the same plan runs on ``readStream``: every CSV that lands in
the folder is scored exactly once; the checkpoint under the shared folder
records which files were processed, so a restarted job resumes without
re-scoring. ``availableNow`` processes the current backlog and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelsight.operators import scoring as SC
from panelsight.operators.clean import numeric_coerce
from panelsight.operators.models import FittedModel
from panelsight.operators.prep import PrepStats
from panelsight.schema import NUMERIC_FEATURES
from panelsight.sources.files import BATCH_COLUMNS

BATCH_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in BATCH_COLUMNS])


def scored_stream(spark: SparkSession, landing_dir: str, fm: FittedModel, stats: PrepStats) -> DataFrame:
    """Streaming DataFrame of scored rows (export shape, S5)."""
    src = (spark.readStream.schema(BATCH_TEXT_SCHEMA).option("header", True)
           .option("maxFilesPerTrigger", 100).csv(landing_dir))
    # a deterministic row key (monotonically_increasing_id is batch-only)
    src = src.withColumn("row_key", F.xxhash64(F.input_file_name(), *[F.col(c) for c in BATCH_COLUMNS]))
    scored = SC.score_batch(numeric_coerce(src, NUMERIC_FEATURES), fm, stats)
    return SC.scored_report(scored, BATCH_COLUMNS).drop("row_key")


def score_landing_folder(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_dir: str,
                         fm: FittedModel, stats: PrepStats) -> None:
    """Score the backlog of ``landing_dir`` into parquet at ``out_dir`` and stop."""
    q = (scored_stream(spark, landing_dir, fm, stats).writeStream.format("parquet")
         .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
