"""Batch and single scoring.

Scoring a file is one lazy plan: read -> encode (unseen -> 0) -> fill absent
features by name -> scale -> ``model.transform`` -> band/confidence -> rule
columns. Everything after the read is narrow (no shuffle); decisions are
computed on the scored rows themselves, so no join is needed there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsight.operators import decisions as D
from panelsight.operators import explain as X
from panelsight.operators.models import FittedModel, predict
from panelsight.operators.prep import (
    PrepStats, apply_label_encoder, apply_standard_scaler, assemble, missing_feature_defaults,
)
from panelsight.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from panelsight.sources.files import resolve_id

SCORED_COLS = ["predicted_band", "confidence_pct", "training_needed", "promotion_ready", "retention_risk", "priority"]


def prepare_batch(df: DataFrame, stats: PrepStats, null_policy: str = "median") -> DataFrame:
    """C7 + P16 + C10 + P19 for a scoring input.

    ``null_policy='median'`` fills NULL/absent numeric features with the
    training medians where fitted (0 otherwise); ``'zero'`` uses 0 throughout.
    """
    out = resolve_id(df)
    if "row_key" not in out.columns:
        out = out.withColumn("row_key", F.monotonically_increasing_id())
    for c in CATEGORICAL_FEATURES:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    out = apply_label_encoder(out, stats.encoder, unseen="zero", codes=stats.codes)
    fill = stats.medians if null_policy == "median" else {}
    # keep the raw values for the rules; fill a copy for the model
    raw = {c: F.col(c) for c in NUMERIC_FEATURES if c in out.columns}
    out = out.withColumns({f"_raw_{c}": v for c, v in raw.items()})
    out = missing_feature_defaults(out, NUMERIC_FEATURES, fill=fill, default=0.0)
    out = apply_standard_scaler(out, stats.means, stats.stds)
    out = assemble(out, stats)
    # rules read the input values, not the filled ones
    return out.withColumns({c: F.col(f"_raw_{c}") for c in raw}).drop(*[f"_raw_{c}" for c in raw])


def score_batch(df: DataFrame, fm: FittedModel, stats: PrepStats, null_policy: str = "median") -> DataFrame:
    """Predictions, confidence and the decision columns for every input row."""
    scored = predict(fm, prepare_batch(df, stats, null_policy))
    decided = D.decide(scored)
    return decided


def scored_report(scored: DataFrame, inputs: list[str]) -> DataFrame:
    """The export shape of a scored batch (S5): the row key, every input column, then the results."""
    first = ["row_key", "employee_id"]
    return scored.select(*first, *[c for c in inputs if c not in first + SCORED_COLS], *SCORED_COLS)


def attach_decisions(scored: DataFrame, decisions: DataFrame, key: str = "row_key") -> DataFrame:
    """Left equi-join of scored rows with (training needed, promotion ready)
    on a row key (not the employee id, which may repeat)."""
    dec = decisions.select(key, "training_needed", "promotion_ready")
    return scored.drop("training_needed", "promotion_ready").join(dec, key, "left")


def scored_summary(scored: DataFrame) -> DataFrame:
    """How many rows are predicted High / Medium / Low (one aggregate)."""
    b = F.col("predicted_band")
    return scored.agg(F.count_if(b == "High").alias("n_high"), F.count_if(b == "Medium").alias("n_medium"),
                      F.count_if(b == "Low").alias("n_low"))


def score_records(df: DataFrame, fm: FittedModel, stats: PrepStats) -> DataFrame:
    """Each record with its score, decision and explanation by the fitted model."""
    scored = score_batch(df, fm, stats).withColumn("contrib", X.model_contributions(fm, F.col("prediction")))
    raw = [c.removesuffix("_enc") for c in stats.features]
    return X.explain_rows(scored, stats.features, "contrib", raw)


def score_one(spark, record: dict, fm: FittedModel, stats: PrepStats) -> DataFrame:
    """``score_records`` on a single record."""
    cols = list(record)
    return score_records(spark.createDataFrame([tuple(record[c] for c in cols)], cols), fm, stats)
