"""Group-fairness audit.

Each audit is one grouped aggregate (partial + final, so a dominant group is
collapsed map-side). The best-group rate and the reference-group rate are
computed over the *aggregated* rows -- one row per group -- so the keyless
window / broadcast involved only ever sees a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelsight.functions.scalars import experience_tier, rnd
from panelsight.schema import ADVERSE_IMPACT_MIN, EXPERIENCE_TIERS, PARITY_MAX_ABS, TARGET_COL

POSITIVE = 2  # label of the High band


def _flags(df: DataFrame, pred_col: str, actual_col: str | None) -> DataFrame:
    out = df.withColumn("_pred_high", (F.col(pred_col) == POSITIVE).cast("int"))
    if actual_col and actual_col in df.columns:
        out = out.withColumn("_actual_high", F.when(F.col(actual_col).isNull(), None)
                             .otherwise((F.col(actual_col) == "High").cast("int")))
    else:
        out = out.withColumn("_actual_high", F.lit(None).cast("int"))  # D21
    return out


def _pct(c: str):
    return rnd(F.col(c) * 100.0, 1)


def selection_rate(df: DataFrame, pred_col: str = "prediction", positive: int = POSITIVE) -> DataFrame:
    """share of rows predicted as the positive class."""
    return df.agg(F.avg((F.col(pred_col) == positive).cast("double")).alias("selection_rate"))


def audit_by_group(df: DataFrame, group_col: str = "department", pred_col: str = "prediction",
                   actual_col: str = TARGET_COL) -> DataFrame:
    """F2 + F3: per group n, predicted-High %, actual-High %, gap, adverse
    impact ratio against the best group (ratio of the 1-dp percentages, 3 dp;
    NULL when the best rate is 0) and the flag."""
    g = (_flags(df, pred_col, actual_col).where(F.col(group_col).isNotNull())
         .groupBy(group_col)
         .agg(F.count(F.lit(1)).alias("n_employees"),
              F.avg("_pred_high").alias("_p"), F.avg("_actual_high").alias("_a")))
    g = g.select(F.col(group_col).alias("group_name"), "n_employees",
                 _pct("_p").alias("predicted_high_pct"), _pct("_a").alias("actual_high_pct"),
                 rnd((F.col("_p") - F.col("_a")) * 100.0, 1).alias("gap_pts"))
    return _assessed(g)


def _assessed(g: DataFrame) -> DataFrame:
    """Aggregated groups with their ratio to the best one and the flag."""
    best = F.max("predicted_high_pct").over(Window.partitionBy())  # over the aggregated groups only
    ratio = rnd(F.try_divide(F.col("predicted_high_pct"), best), 3)
    return (g.withColumn("adverse_impact_ratio", F.when(best > 0, ratio))
            .withColumn("bias_flag", F.when(F.col("adverse_impact_ratio").isNull(), "NOT_ASSESSABLE")
                        .when(F.col("adverse_impact_ratio") < ADVERSE_IMPACT_MIN, "INVESTIGATE")
                        .otherwise("OK")))


def audit_by_experience(df: DataFrame, pred_col: str = "prediction", actual_col: str = TARGET_COL,
                        years_col: str = "experience_years") -> DataFrame:
    """F2 without gap/ratio over experience tiers; empty tiers omitted,
    out-of-range years dropped; ``tier_order`` gives Junior -> Senior."""
    t = _flags(df, pred_col, actual_col).withColumn("experience_tier", experience_tier(years_col))
    return (t.where(F.col("experience_tier").isNotNull()).groupBy("experience_tier")
            .agg(F.count(F.lit(1)).alias("n_employees"),
                 _pct_avg("_pred_high").alias("predicted_high_pct"),
                 _pct_avg("_actual_high").alias("actual_high_pct"))
            .withColumn("tier_order", _tier_order()))


def _tier_order():
    order = F.create_map(*[x for i, (lab, _, _) in enumerate(EXPERIENCE_TIERS) for x in (F.lit(lab), F.lit(i))])
    return F.element_at(order, F.col("experience_tier"))


def _pct_avg(c: str):
    return rnd(F.avg(c) * 100.0, 1)


def statistical_parity(df: DataFrame, group_col: str = "department", reference: str = "EUROPE",
                       pred_col: str = "prediction") -> DataFrame:
    """High-rate(group) - High-rate(reference), 3 dp; flag on the unrounded
    |spd| > 0.10. A missing group column yields an empty result."""
    if group_col not in df.columns:
        return df.sparkSession.createDataFrame(
            [], "group_name string, high_rate_pct double, spd double, fairness_flag string")
    g = (_flags(df, pred_col, None).where(F.col(group_col).isNotNull())
         .groupBy(F.col(group_col).alias("group_name")).agg(F.avg("_pred_high").alias("_r")))
    return _parity(g, reference)


def _parity(g: DataFrame, reference: str) -> DataFrame:
    """Aggregated groups (group_name, _r) against the reference group."""
    ref = F.max(F.when(F.col("group_name") == reference, F.col("_r"))).over(Window.partitionBy())
    spd = F.col("_r") - ref
    return g.select("group_name", _pct("_r").alias("high_rate_pct"), rnd(spd, 3).alias("spd"),
                    F.when(spd.isNull(), "NOT_ASSESSABLE")
                    .when(F.abs(spd) > PARITY_MAX_ABS, "REVIEW").otherwise("OK").alias("fairness_flag"))


def bias_detected(audit: DataFrame, flag_col: str = "bias_flag", bad: str = "INVESTIGATE") -> DataFrame:
    """Any group flagged."""
    return audit.agg(F.coalesce(F.bool_or(F.col(flag_col) == bad), F.lit(False)).alias("bias_detected"))


def group_counts(df: DataFrame, pred_col: str = "prediction", actual_col: str = TARGET_COL, group_col: str = "department",
                 years_col: str = "experience_years") -> DataFrame:
    """(group_name, experience_tier, n, n_high, n_actual, n_actual_high) of every group and every tier, by grouping sets:
    one scan and one exchange of a row for each group and task."""
    flagged = _flags(df, pred_col, actual_col).select(
        (F.col(group_col) if group_col in df.columns else F.lit(None).cast("string")).alias("group_name"),
        experience_tier(years_col).alias("experience_tier"), "_pred_high", "_actual_high")
    sums = flagged.groupingSets([[F.col("group_name")], [F.col("experience_tier")]], "group_name", "experience_tier").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_pred_high").alias("n_high"), F.count("_actual_high").alias("n_actual"), F.sum("_actual_high").alias("n_actual_high"))
    return sums.where(F.col("group_name").isNotNull() | F.col("experience_tier").isNotNull())


def fairness_report(df: DataFrame, pred_col: str = "prediction", reference: str = "EUROPE") -> dict:
    """the three audit tables plus the overall flags, all from the rows of one aggregate (a row for each group)."""
    counts = group_counts(df, pred_col)
    local = df.sparkSession.createDataFrame(counts.collect(), counts.schema)
    high, actual = F.col("n_high") / F.col("n"), F.try_divide(F.col("n_actual_high"), F.col("n_actual"))
    groups = local.where(F.col("group_name").isNotNull())
    audited = _assessed(groups.select("group_name", F.col("n").alias("n_employees"), rnd(high * 100.0, 1).alias("predicted_high_pct"),
                                      rnd(actual * 100.0, 1).alias("actual_high_pct"), rnd((high - actual) * 100.0, 1).alias("gap_pts")))
    tiers = local.where(F.col("experience_tier").isNotNull()).select(
        "experience_tier", F.col("n").alias("n_employees"), rnd(high * 100.0, 1).alias("predicted_high_pct"), rnd(actual * 100.0, 1).alias("actual_high_pct"),
        _tier_order().alias("tier_order"))
    spd = _parity(groups.select("group_name", high.alias("_r")), reference)
    return {"department": audited.orderBy(F.col("predicted_high_pct").desc(), "group_name"),
            "experience": tiers.orderBy("tier_order"),
            "parity": spd.orderBy("spd", "group_name"),
            "bias_detected": bias_detected(audited),
            "parity_flagged": bias_detected(spd, "fairness_flag", "REVIEW")}


def fairness_chart_data(dept_audit: DataFrame) -> DataFrame:
    """F8: predicted vs actual High % per department."""
    return dept_audit.select("group_name", "predicted_high_pct", "actual_high_pct")
