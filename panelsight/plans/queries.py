"""Registered queries: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Every query reads the warehouse tables under ``sf_dir`` (through the review
panel) so that its work grows with them. Model-dependent operators train on
the panel's training period; rule/metric/fairness operators that have a SQL
oracle use the deterministic pseudo-prediction of ``pseudo_predict``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelsight import functions as S
from panelsight.operators import clean as C
from panelsight.operators import decisions as D
from panelsight.operators import explain as X
from panelsight.operators import fairness as FA
from panelsight.operators import insights as I
from panelsight.operators import metrics as M
from panelsight.operators import models as MD
from panelsight.operators import prep as P
from panelsight.operators import scoring as SC
from panelsight.plans import fixed_models as FX
from panelsight.schema import FEATURE_COLS, IMPUTE_COLS, KEY_COLS, RULE_DEFAULTS
from panelsight.sources import files as FS
from panelsight.sources import model_store as MS
from panelsight.sources.panel import load_panel, read_table
from panelsight.sources.stored import inputs_stamp, stored_bucketed, stored_clean_panel, stored_panel

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review panel, built from the line items once per session and read
    back from the shared checkpoint folder (see ``sources.stored``)."""
    return stored_panel(spark, sf_dir)


def clean_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_clean_panel(spark, sf_dir)


# --- panel and cleaning ------------------------------------------------------

@register("review_panel")
def q_review_panel(spark, sf_dir):
    """The panel build itself, straight from the warehouse tables."""
    return load_panel(spark, sf_dir, with_defects=True)


@register("clean_panel")
def q_clean_panel(spark, sf_dir):
    """Cleaning over the freshly built panel (dedup -> drop -> coerce)."""
    return C.clean_panel(load_panel(spark, sf_dir, with_defects=True))


def review_feed(spark, sf_dir):
    """The panel as a feed with an ingest order: every fifth review comes three
    times, later copies have other hours, and of every second employee's the
    first copy lacks the target. Which rows these are follows from the keys."""
    number, quarter = F.substring("employee_id", 4, 20).cast("long"), F.col("review_year") * 4 + F.col("review_quarter")
    again = (7 * number + quarter) % 5 == 0
    once = C.dedup_reviews(raw_panel(spark, sf_dir))
    feed = once.select("*", again.alias("_again"), F.explode(F.sequence(F.lit(1), F.when(again, 3).otherwise(1))).alias("ingest"))
    lacks = F.col("_again") & (number % 2 == 0) & (F.col("ingest") == 1)
    return feed.withColumns({
        "training_hours": F.col("training_hours") + F.col("ingest") - 1,
        "performance_band": F.when(~lacks, F.col("performance_band"))}).drop("_again")


@register("clean_counts")
def q_clean_counts(spark, sf_dir):
    """C2 counts: rows before cleaning, after dedup, after dropping a missing target."""
    return C.clean_counts(review_feed(spark, sf_dir), "ingest")


@register("dedup_reviews")
def q_dedup(spark, sf_dir):
    """Of copies that differ the first by ingest order stays."""
    return C.dedup_reviews(review_feed(spark, sf_dir), order_col="ingest")


@register("clean_feed")
def q_clean_feed(spark, sf_dir):
    """C2 on the feed: a review whose first copy lacks the target goes, though later copies have it."""
    return C.clean_panel(review_feed(spark, sf_dir), order_col="ingest")


# --- insights ------------------------------------------------------------------

@register("dept_band_pct")
def q_dept_band_pct(spark, sf_dir):
    return I.dept_band_pct(raw_panel(spark, sf_dir))


# --- shared building blocks ------------------------------------------------------


CUTOFF = "2000-Q1"          # split point for the warehouse-derived panel
PARITY_REFERENCE = "EUROPE"


def pseudo_predict(df, goal_col: str = "goal_achievement_pct"):
    """Deterministic stand-in for a model (for SQL-oracled rule/metric/fairness
    checks): High if goal >= 85, Low if goal < 50, else (and NULL) Medium."""
    g = F.col(goal_col)
    pred = F.when(g >= 85, 2).when(g < 50, 0).otherwise(1)
    return df.withColumns({
        "prediction": pred,
        "predicted_band": S.decode_band(pred),
        "label": S.encode_target("performance_band"),
        "confidence": F.lit(1.0),
    })


def split_frames(spark, sf_dir):
    return P.time_split(clean_panel(spark, sf_dir), CUTOFF)


def prepared(spark, sf_dir):
    """(train, test, stats) with the model-ready ``features`` vector."""
    return P.prep_pipeline(clean_panel(spark, sf_dir), CUTOFF)


# --- scalar expressions ------------------------------------------------------------

@register("kpi_score")
def q_kpi(spark, sf_dir):
    p = clean_panel(spark, sf_dir)
    return p.select("employee_id", "quarter_label", S.kpi_score(
        "goal_achievement_pct", "manager_rating", "peer_score", "attendance_rate",
        "training_hours", "projects_completed", "overtime_hours").alias("kpi"))


@register("performance_band")
def q_band(spark, sf_dir):
    p = clean_panel(spark, sf_dir)
    return p.select("employee_id", "quarter_label", "performance_score",
                    S.performance_band("performance_score").alias("band"))


@register("quarter_start")
def q_quarter_start(spark, sf_dir):
    return (raw_panel(spark, sf_dir).select("review_year", "review_quarter").distinct()
            .select("review_year", "review_quarter",
                    S.quarter_start("review_year", "review_quarter").alias("quarter_start")))


@register("quarter_label")
def q_quarter_label(spark, sf_dir):
    return (raw_panel(spark, sf_dir).select("review_year", "review_quarter").distinct()
            .select("review_year", "review_quarter",
                    S.quarter_label("review_year", "review_quarter").alias("label")))


@register("quarter_key")
def q_quarter_key(spark, sf_dir):
    return (raw_panel(spark, sf_dir).select("quarter_label").distinct()
            .select("quarter_label", S.quarter_key("quarter_label").alias("quarter_key")))


@register("employee_code")
def q_employee_code(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey"), S.employee_code("s_suppkey").alias("employee_id"))


@register("tenure_offset_date")
def q_tenure(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", S.tenure_offset_date("1995-01-01", F.pmod("s_suppkey", F.lit(36)))
                    .alias("join_date"),
                    F.date_format(S.tenure_offset_date("1995-01-01", F.pmod("s_suppkey", F.lit(36))),
                                  "yyyy-MM-dd").alias("join_date_text"))


@register("numeric_coerce")
def q_numeric_coerce(spark, sf_dir):
    p = C.string_typed(raw_panel(spark, sf_dir))
    hours = F.col("training_hours")  # cells of a CSV that are no numbers, or padded
    p = p.withColumn("training_hours", F.when(F.col("employee_id").endswith("3"), F.lit("n/a"))
                     .when(F.col("employee_id").endswith("4"), F.concat(F.lit(" "), hours, F.lit(" ")))
                     .when(F.col("employee_id").endswith("5"), F.lit("NaN")).otherwise(hours))
    return C.numeric_coerce(p).select("employee_id", "quarter_label", *[c for c in C.COERCE_COLS])


@register("drop_missing_target")
def q_drop_missing(spark, sf_dir):
    return C.drop_missing_target(review_feed(spark, sf_dir))


@register("encode_target")
def q_encode_target(spark, sf_dir):
    return C.encode_target(raw_panel(spark, sf_dir)).select("employee_id", "quarter_label",
                                                            "performance_band", "target")


@register("decode_band")
def q_decode_band(spark, sf_dir):
    p = pseudo_predict(clean_panel(spark, sf_dir))
    return p.select("employee_id", "quarter_label", "prediction",
                    S.decode_band("prediction").alias("band"))


@register("experience_tier")
def q_experience_tier(spark, sf_dir):
    return clean_panel(spark, sf_dir).select("employee_id", "quarter_label", "experience_years",
                                             S.experience_tier("experience_years").alias("experience_tier"))


@register("quality_profile")
def q_quality(spark, sf_dir):
    return C.quality_profile(raw_panel(spark, sf_dir), IMPUTE_COLS)


@register("append_rows")
def q_append(spark, sf_dir):
    once = C.dedup_reviews(raw_panel(spark, sf_dir))
    dup_keys = (raw_panel(spark, sf_dir).groupBy("employee_id", "review_year", "review_quarter")
                .agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k"))
    repeats = once.join(dup_keys, ["employee_id", "review_year", "review_quarter"], "left_semi")
    return C.append_rows(once, repeats)


# --- preparation -------------------------------------------------------------------

@register("time_split")
def q_time_split(spark, sf_dir):
    return (P.label_split(clean_panel(spark, sf_dir), CUTOFF)
            .select("employee_id", "quarter_label", "split"))


@register("distinct_quarters")
def q_distinct_quarters(spark, sf_dir):
    return I.distinct_quarters(P.label_split(clean_panel(spark, sf_dir), CUTOFF))


@register("fit_median_imputer")
def q_fit_median(spark, sf_dir):
    train, _ = split_frames(spark, sf_dir)
    return P.median_table(train)


@register("apply_median_imputer")
def q_apply_median(spark, sf_dir):
    train, test = split_frames(spark, sf_dir)
    med = P.fit_median_imputer(train)
    both = train.unionByName(test)
    return P.apply_median_imputer(both, med).select("employee_id", "quarter_label", *IMPUTE_COLS)


@register("fit_label_encoder")
def q_fit_encoder(spark, sf_dir):
    train, _ = split_frames(spark, sf_dir)
    return P.fit_label_encoder(train)


@register("apply_label_encoder")
def q_apply_encoder(spark, sf_dir):
    train, test = split_frames(spark, sf_dir)
    labels = P.fit_label_encoder(train)
    return P.apply_label_encoder(test, labels).select(
        "employee_id", "quarter_label", "department_enc", "education_enc", "role_enc")


@register("encode_or_zero")
def q_encode_or_zero(spark, sf_dir):
    p = clean_panel(spark, sf_dir)
    labels = P.fit_label_encoder(p.where(F.col("experience_years") < 10))
    return P.apply_label_encoder(p, labels, unseen="zero").select(
        "employee_id", "quarter_label", "department_enc", "education_enc", "role_enc")


def _encoded_train_test(spark, sf_dir):
    train, test = split_frames(spark, sf_dir)
    med = P.fit_median_imputer(train)
    train, test = P.apply_median_imputer(train, med), P.apply_median_imputer(test, med)
    labels = P.fit_label_encoder(train)
    return P.apply_label_encoder(train, labels), P.apply_label_encoder(test, labels)


@register("fit_standard_scaler")
def q_fit_scaler(spark, sf_dir):
    train, _ = _encoded_train_test(spark, sf_dir)
    return P.scaler_table(train, FEATURE_COLS).select(
        "column_name", S.rnd("mean", 6).alias("mean"), S.rnd("std", 6).alias("std"))


@register("apply_standard_scaler")
def q_apply_scaler(spark, sf_dir):
    train, test = _encoded_train_test(spark, sf_dir)
    means, stds = P.fit_standard_scaler(train, FEATURE_COLS)
    sc = P.apply_standard_scaler(test, means, stds)
    return sc.select("employee_id", "quarter_label", *[S.rnd(f"{c}_sc", 6).alias(c) for c in FEATURE_COLS])


@register("prep_pipeline")
def q_prep_pipeline(spark, sf_dir):
    train, test, _ = prepared(spark, sf_dir)
    from pyspark.ml.functions import vector_to_array
    out = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    arr = vector_to_array("features")
    return out.select("employee_id", "quarter_label", "split", F.col("label").cast("int").alias("label"),
                      *[S.rnd(arr[i], 6).alias(c) for i, c in enumerate(FEATURE_COLS)])


@register("class_balance")
def q_class_balance(spark, sf_dir):
    train, _ = split_frames(spark, sf_dir)
    return P.class_balance(train)


@register("balanced_class_weights")
def q_class_weights(spark, sf_dir):
    train, _ = split_frames(spark, sf_dir)
    t = C.encode_target(train, out="label")
    return P.balanced_class_weights(t).select(F.col("label").cast("int").alias("label"), "n_c",
                                              S.rnd("weight", 6).alias("weight"))


# --- insights ----------------------------------------------------------------------

@register("band_distribution")
def q_band_distribution(spark, sf_dir):
    return I.band_distribution(raw_panel(spark, sf_dir))


@register("quarterly_trend")
def q_quarterly_trend(spark, sf_dir):
    return I.quarterly_trend(raw_panel(spark, sf_dir))


@register("dept_band_counts")
def q_dept_band_counts(spark, sf_dir):
    return I.dept_band_counts(raw_panel(spark, sf_dir))


@register("band_feature_means")
def q_band_feature_means(spark, sf_dir):
    return I.band_feature_means(raw_panel(spark, sf_dir))


@register("describe_numeric")
def q_describe(spark, sf_dir):
    return I.describe_numeric(raw_panel(spark, sf_dir))


@register("null_counts")
def q_null_counts(spark, sf_dir):
    return I.null_counts(raw_panel(spark, sf_dir))


@register("correlation_matrix")
def q_corr(spark, sf_dir):
    return I.correlation_matrix(raw_panel(spark, sf_dir))


@register("lower_triangle")
def q_lower(spark, sf_dir):
    return I.lower_triangle(I.correlation_matrix(raw_panel(spark, sf_dir)))


@register("pair_correlation")
def q_pair_corr(spark, sf_dir):
    return I.pair_correlation(raw_panel(spark, sf_dir))


@register("paired_nonnull")
def q_paired(spark, sf_dir):
    return I.paired_nonnull(raw_panel(spark, sf_dir), "training_hours", "performance_score").select(
        "employee_id", "quarter_label", "training_hours", "performance_score")


@register("trend_line")
def q_trend_line(spark, sf_dir):
    return I.trend_line(raw_panel(spark, sf_dir))


@register("trend_line_points")
def q_trend_points(spark, sf_dir):
    return I.trend_line_points(raw_panel(spark, sf_dir))


@register("feature_histogram")
def q_histogram(spark, sf_dir):
    return I.feature_histogram(raw_panel(spark, sf_dir))


@register("performer_shortlists")
def q_shortlists(spark, sf_dir):
    p = pseudo_predict(clean_panel(spark, sf_dir)).withColumn("p_rank_score", F.col("performance_score"))
    return I.performer_shortlists(p)


@register("preview")
def q_preview(spark, sf_dir):
    return I.preview(raw_panel(spark, sf_dir).orderBy("employee_id", "review_year", "review_quarter"), 5)


# --- decisions (actual band as the prediction, fixed confidence) -------------------

def _decided(spark, sf_dir):
    p = clean_panel(spark, sf_dir).withColumns({"predicted_band": F.col("performance_band"),
                                                "confidence": F.lit(1.0)})
    return D.decide(p)


@register("training_needs")
def q_training_needs(spark, sf_dir):
    return _decided(spark, sf_dir).select("employee_id", "quarter_label", "training_needed",
                                          F.array_join("training_topics_arr", "; ").alias("training_topics"))


@register("promotion_ready")
def q_promotion(spark, sf_dir):
    return _decided(spark, sf_dir).select("employee_id", "quarter_label", "promotion_ready")


@register("pip_plan")
def q_pip(spark, sf_dir):
    return _decided(spark, sf_dir).select("employee_id", "quarter_label", "pip_required",
                                          F.array_join("pip_goals_arr", "; ").alias("pip_goals"),
                                          F.size("pip_goals_arr").alias("n_goals"))


@register("retention_risk")
def q_retention(spark, sf_dir):
    return _decided(spark, sf_dir).select("employee_id", "quarter_label", "retention_points", "retention_risk")


@register("wellbeing_flag")
def q_wellbeing(spark, sf_dir):
    return _decided(spark, sf_dir).select("employee_id", "quarter_label", "wellbeing_flag")


@register("medium_quick_win")
def q_quick_win(spark, sf_dir):
    d = _decided(spark, sf_dir)
    return d.where(F.col("predicted_band") == "Medium").select(
        "employee_id", "quarter_label", F.element_at("actions_arr", -1).alias("quick_win"))


@register("priority")
def q_priority(spark, sf_dir):
    return _decided(spark, sf_dir).select("employee_id", "quarter_label", "priority")


@register("decision_summary")
def q_summary(spark, sf_dir):
    return _decided(spark, sf_dir).select("employee_id", "quarter_label", "hr_summary")


@register("action_list")
def q_actions(spark, sf_dir):
    return _decided(spark, sf_dir).select("employee_id", "quarter_label",
                                          F.array_join("actions_arr", "; ").alias("recommended_actions"),
                                          F.size("actions_arr").alias("n_actions"))


@register("cap_list")
def q_cap_list(spark, sf_dir):
    d = _decided(spark, sf_dir)
    return d.select("employee_id", "quarter_label",
                    F.array_join(F.slice("training_topics_arr", 1, 2), "; ").alias("first_topics"),
                    F.size(F.slice("actions_arr", 1, 6)).alias("n_actions"))


@register("decision_report")
def q_decision_report(spark, sf_dir):
    p = clean_panel(spark, sf_dir).withColumns({"predicted_band": F.col("performance_band"),
                                                "confidence": F.lit(1.0)})
    return D.decision_report(p)


@register("rule_feature_defaults")
def q_rule_defaults(spark, sf_dir):
    p = (clean_panel(spark, sf_dir).drop("salary", "overtime_hours")
         .withColumns({"predicted_band": F.col("performance_band"), "confidence": F.lit(1.0)}))
    return D.decide(p).select("employee_id", "quarter_label", "retention_points", "wellbeing_flag")


@register("rule_defaults_all")
def q_rule_defaults_all(spark, sf_dir):
    """A frame with none of the nine rule features."""
    p = (clean_panel(spark, sf_dir).drop(*RULE_DEFAULTS)
         .withColumns({"predicted_band": F.col("performance_band"), "confidence": F.lit(1.0)}))
    d = D.decide(p)
    return d.select("employee_id", "quarter_label", "training_needed", "promotion_ready", F.array_join("pip_goals_arr", "; ").alias("pip_goals"),
                    "retention_points", "wellbeing_flag", F.array_join("actions_arr", "; ").alias("actions"), "priority")


@register("priority_counts")
def q_priority_counts(spark, sf_dir):
    return D.priority_counts(q_decision_report(spark, sf_dir))


# --- metrics on the pseudo-prediction -----------------------------------------------

def _pseudo_scored(spark, sf_dir):
    return pseudo_predict(clean_panel(spark, sf_dir))


@register("accuracy")
def q_accuracy(spark, sf_dir):
    return M.summary_metrics(_pseudo_scored(spark, sf_dir)).select("accuracy")


@register("f1_macro")
def q_f1_macro(spark, sf_dir):
    return M.summary_metrics(_pseudo_scored(spark, sf_dir)).select("f1_macro")


@register("f1_weighted")
def q_f1_weighted(spark, sf_dir):
    return M.summary_metrics(_pseudo_scored(spark, sf_dir)).select("f1_weighted")


@register("confusion_matrix")
def q_confusion(spark, sf_dir):
    return M.confusion_matrix(_pseudo_scored(spark, sf_dir))


@register("classification_report")
def q_class_report(spark, sf_dir):
    return M.classification_report(_pseudo_scored(spark, sf_dir))


PSEUDO_MODELS = [("goal_85_50", 85, 50), ("goal_80_45", 80, 45), ("goal_90_55", 90, 55)]


def _pseudo_comparison(spark, sf_dir):
    """Metrics of three threshold rules, stacked per row with ``explode`` and
    reduced by one grouped aggregate (one scan of the panel)."""
    p = clean_panel(spark, sf_dir).withColumn("label", S.encode_target("performance_band"))
    g = F.col("goal_achievement_pct")
    variants = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(i).alias("model_order"),
                                  F.when(g >= hi, 2).when(g < lo, 0).otherwise(1).alias("prediction"))
                         for i, (name, hi, lo) in enumerate(PSEUDO_MODELS)])
    stacked = p.select("label", F.inline(variants))
    return M.summary_metrics_by(stacked, ["model", "model_order"])


@register("select_best")
def q_select_best(spark, sf_dir):
    return M.select_best(_pseudo_comparison(spark, sf_dir))


# --- fairness on the pseudo-prediction ----------------------------------------------

@register("selection_rate")
def q_selection_rate(spark, sf_dir):
    return FA.selection_rate(_pseudo_scored(spark, sf_dir)).select(S.rnd("selection_rate", 6).alias("selection_rate"))


@register("audit_by_group")
def q_audit_group(spark, sf_dir):
    return FA.audit_by_group(_pseudo_scored(spark, sf_dir)).select(
        "group_name", "n_employees", "predicted_high_pct", "actual_high_pct", "gap_pts")


@register("adverse_impact")
def q_adverse(spark, sf_dir):
    return FA.audit_by_group(_pseudo_scored(spark, sf_dir)).select(
        "group_name", "adverse_impact_ratio", "bias_flag")


@register("audit_by_experience")
def q_audit_exp(spark, sf_dir):
    return FA.audit_by_experience(_pseudo_scored(spark, sf_dir))


@register("statistical_parity")
def q_parity(spark, sf_dir):
    return FA.statistical_parity(_pseudo_scored(spark, sf_dir), "department", PARITY_REFERENCE)


@register("bias_detected")
def q_bias(spark, sf_dir):
    return FA.bias_detected(FA.audit_by_group(_pseudo_scored(spark, sf_dir)))


@register("fairness_chart_data")
def q_fair_chart(spark, sf_dir):
    return FA.fairness_chart_data(FA.audit_by_group(_pseudo_scored(spark, sf_dir)))


@register("sort_reports")
def q_sort_reports(spark, sf_dir):
    """The orders of the reports (selection rate falling, parity difference
    rising, importance falling; names break ties) as a position column. The
    keyless windows run over aggregated groups only."""
    from pyspark.sql import Window

    def ordered(report, df, name, value, order):
        pos = F.row_number().over(Window.orderBy(order, name)).alias("pos")
        return df.select(F.lit(report).alias("report"), pos, F.col(name).alias("name"), F.col(value).alias("value"))

    return (ordered("departments", FA.audit_by_group(_pseudo_scored(spark, sf_dir)), "group_name", "predicted_high_pct", F.desc("predicted_high_pct"))
            .unionByName(ordered("parity", REGISTRY["statistical_parity"](spark, sf_dir), "group_name", "spd", F.asc("spd")))
            .unionByName(ordered("importance", REGISTRY["linear_importance"](spark, sf_dir), "feature", "in_data", F.desc("in_data"))))


# --- joins ----------------------------------------------------------------------------

@register("lookup_constants")
def q_lookup(spark, sf_dir):
    from panelsight.sources.panel import employee_dim
    return employee_dim(read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "nation"),
                        read_table(spark, sf_dir, "region")).drop("sk")


def employees(spark, sf_dir):
    from panelsight.sources.panel import employee_dim
    return employee_dim(read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))


@register("densify_panel")
def q_densify(spark, sf_dir):
    from panelsight.sources.panel import densify_panel
    # of every employee each third review is missing
    quarter = F.col("review_year") * 4 + F.col("review_quarter")
    gaps = (F.substring("employee_id", 4, 20).cast("long") + quarter) % 3 == 0
    return densify_panel(clean_panel(spark, sf_dir).where(~gaps), employees(spark, sf_dir))


@register("attach_decisions")
def q_attach(spark, sf_dir):
    """J1 on a row key: an employee has a row for each quarter."""
    p = clean_panel(spark, sf_dir).withColumns({
        "row_key": F.concat_ws("|", "employee_id", "quarter_label"),
        "predicted_band": F.col("performance_band"), "confidence": F.lit(1.0)})
    scored = p.select("row_key", "employee_id", "quarter_label", "predicted_band")
    return SC.attach_decisions(scored, D.decide(p)).drop("row_key")


def bucketed_panel(spark, sf_dir):
    return stored_bucketed(spark, sf_dir, "panel-bucketed", raw_panel, KEY_COLS)


@register("dedup_bucketed")
def q_dedup_bucketed(spark, sf_dir):
    """C1 on the bucketed panel: no exchange."""
    return C.dedup_reviews(bucketed_panel(spark, sf_dir))


@register("attach_bucketed")
def q_attach_bucketed(spark, sf_dir):
    """J1 by the panel's keys between two bucketed readings: no exchange on either side."""
    p = C.dedup_reviews(bucketed_panel(spark, sf_dir)).where(F.col("performance_band").isNotNull())
    scored = p.select(*KEY_COLS, "quarter_label", F.col("performance_band").alias("predicted_band"))
    decided = D.decide(p.withColumns({"predicted_band": F.col("performance_band"), "confidence": F.lit(1.0)}))
    return scored.join(decided.select(*KEY_COLS, "training_needed", "promotion_ready"), KEY_COLS, "left").drop("review_year", "review_quarter")


@register("densify_bucketed")
def q_densify_bucketed(spark, sf_dir):
    """J2 with the facts bucketed by the join's keys: only the calendar is dealt."""
    from panelsight.sources.panel import densify_panel
    quarter = F.col("review_year") * 4 + F.col("review_quarter")
    gaps = (F.substring("employee_id", 4, 20).cast("long") + quarter) % 3 == 0
    facts = bucketed_panel(spark, sf_dir).where(F.col("performance_band").isNotNull() & ~gaps)
    return densify_panel(facts, employees(spark, sf_dir))


def flagship(spark, sf_dir):
    """Panel -> prep -> logistic regression -> decisions -> department audit."""
    from panelsight.plans.pipeline import flagship_slice
    return flagship_slice(spark, sf_dir)


# --- models, scoring, explanation (model-dependent: rows-only checks) -----------------


REGISTRY_PARAMS = MD.TrainParams()
_FITTED: dict = {}


def fitted(spark, sf_dir, name: str = "logistic_regression"):
    """(model, stats, train, test) fitted on the panel's training period; one
    fit for each session, data folder and state of its files."""
    key, stamp = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name), inputs_stamp(spark, sf_dir)
    if key not in _FITTED or _FITTED[key][0] != stamp:
        train, test, stats = prepared(spark, sf_dir)
        _FITTED[key] = stamp, (MD.TRAINERS[name](train, REGISTRY_PARAMS), stats, train, test)
    return _FITTED[key][1]


_FIXED: dict = {}


def fixed(spark, sf_dir, kind: str = "linear"):
    """(model, stats, train, test): a model of given numbers in the library's model classes, for queries whose results
    SQL can compute as well; prepared once for each session, data folder and state of its files."""
    key, stamp = (spark.sparkContext.applicationId, sf_dir.rstrip("/")), inputs_stamp(spark, sf_dir)
    if key not in _FIXED or _FIXED[key][0] != stamp:
        _FIXED[key] = stamp, prepared(spark, sf_dir), {}
    _, (train, test, stats), models = _FIXED[key]
    if kind not in models:
        models[kind] = getattr(FX, kind)(spark, len(stats.features))
    return models[kind], stats, train, test


def _pred_rows(spark, sf_dir, name):
    fm, _, _, test = fitted(spark, sf_dir, name)
    return MD.predict(fm, test).select("employee_id", "quarter_label", "prediction", "predicted_band",
                                       "probs", "confidence_pct")


@register("train_logreg")
def q_train_logreg(spark, sf_dir):
    return _pred_rows(spark, sf_dir, "logistic_regression")


@register("train_random_forest")
def q_train_rf(spark, sf_dir):
    return _pred_rows(spark, sf_dir, "random_forest")


@register("train_boosted_trees")
def q_train_gbt(spark, sf_dir):
    return _pred_rows(spark, sf_dir, "boosted_trees")


def _fixed_rows(spark, sf_dir):
    fm, _, _, test = fixed(spark, sf_dir)
    return MD.predict(fm, test)


@register("predict")
def q_predict(spark, sf_dir):
    return _fixed_rows(spark, sf_dir).select(
        "employee_id", "quarter_label", "prediction", "predicted_band",
        *[S.rnd(F.col("probs")[i], 6).alias(f"p_{b.lower()}") for i, b in enumerate(MD.BANDS)])


@register("confidence_pct")
def q_confidence(spark, sf_dir):
    return _fixed_rows(spark, sf_dir).select("employee_id", "quarter_label", "confidence_pct")


@register("argmax_class")
def q_argmax(spark, sf_dir):
    return _fixed_rows(spark, sf_dir).select("employee_id", "quarter_label", S.argmax_class("probs").alias("argmax_class"))


@register("probability_breakdown")
def q_prob_breakdown(spark, sf_dir):
    rows = MD.probability_breakdown(_fixed_rows(spark, sf_dir), ["employee_id", "quarter_label"])
    return rows.withColumn("probability", S.rnd("probability", 6))


@register("compare_models")
def q_compare(spark, sf_dir):
    """M10 over the three model classes with given numbers."""
    return MD.compare_models([fixed(spark, sf_dir, k)[0] for k in ("linear", "forest", "boosted")], fixed(spark, sf_dir)[3])


@register("compare_fitted_models")
def q_compare_fitted(spark, sf_dir):
    fms = [fitted(spark, sf_dir, n)[0] for n in MD.MODEL_ORDER]
    test = fitted(spark, sf_dir, "logistic_regression")[3]
    return MD.compare_models(fms, test)


@register("feature_vector")
def q_feature_vector(spark, sf_dir):
    _, test, stats = prepared(spark, sf_dir)
    vector = vector_to_array("features")
    return test.select("employee_id", "quarter_label", *[S.rnd(vector[i], 6).alias(c) for i, c in enumerate(stats.features)])


@register("tree_importance")
def q_tree_importance(spark, sf_dir):
    fm, stats, _, _ = fitted(spark, sf_dir, "random_forest")
    return X.importance_table(spark, fm, stats.features)


@register("linear_importance")
def q_linear_importance(spark, sf_dir):
    """X2 weighted by the spread of the feature in the test period, so that it depends on the data."""
    fm, stats, _, test = fixed(spark, sf_dir)
    spread = test.agg(*[F.stddev_pop(vector_to_array("features")[i]).alias(f) for i, f in enumerate(stats.features)])
    pairs = ", ".join(f"'{f}', `{f}`" for f in stats.features)
    spread = spread.selectExpr(f"stack({len(stats.features)}, {pairs}) AS (feature, spread)")
    return X.importance_table(spark, fm, stats.features).join(spread, "feature").select(
        "feature", S.rnd("importance", 6).alias("importance"), S.rnd(F.col("importance") * F.col("spread"), 6).alias("in_data"))


@register("boosted_importance")
def q_boosted_importance(spark, sf_dir):
    """X1 of the boosted model: mean gain of a split on each feature."""
    fm, stats, _, _ = fitted(spark, sf_dir, "boosted_trees")
    return X.importance_table(spark, fm, stats.features)


@register("top_k_importance")
def q_top_k(spark, sf_dir):
    """W1 of the forest of given numbers, with the features' spread in the test period."""
    fm, stats, _, test = fixed(spark, sf_dir, "forest")
    top = X.top_k_importance(X.importance_table(spark, fm, stats.features), 8)
    spread = test.agg(*[F.stddev_pop(vector_to_array("features")[i]).alias(f) for i, f in enumerate(stats.features)])
    pairs = ", ".join(f"'{f}', `{f}`" for f in stats.features)
    return top.join(spread.selectExpr(f"stack({len(stats.features)}, {pairs}) AS (feature, spread)"), "feature").select(
        "feature", S.rnd("importance", 6).alias("importance"), S.rnd("spread", 6).alias("spread"))


@register("top_k_fitted_importance")
def q_top_k_fitted(spark, sf_dir):
    fm, stats, _, _ = fitted(spark, sf_dir, "random_forest")
    return X.top_k_importance(X.importance_table(spark, fm, stats.features), 12)


@register("permutation_importance")
def q_permutation(spark, sf_dir):
    fm, stats, _, test = fitted(spark, sf_dir, "logistic_regression")
    return X.permutation_importance(fm, test, stats.features)


def _shapley(spark, sf_dir):
    fm, stats, train, test = fitted(spark, sf_dir, "logistic_regression")
    bg = X.background_sample(train, 100)
    return X.shapley_contributions(fm, test, bg, len(stats.features)), stats


@register("shapley_contributions")
def q_shapley(spark, sf_dir):
    return _shapley(spark, sf_dir)[0]


@register("shapley_forest")
def q_shapley_forest(spark, sf_dir):
    """X4 exact for the fitted forest: probabilities of all test rows, features and classes."""
    fm, stats, _, test = fitted(spark, sf_dir, "random_forest")
    return X.tree_contributions(fm, test, len(stats.features))


@register("shapley_boosted")
def q_shapley_boosted(spark, sf_dir):
    """X4 exact for the fitted boosted trees: margins of all test rows, features and classes."""
    fm, stats, _, test = fitted(spark, sf_dir, "boosted_trees")
    return X.tree_contributions(fm, test, len(stats.features))


@register("shapley_kernel")
def q_shapley_kernel(spark, sf_dir):
    """X4 by least squares over coalitions, for a model used as a black box."""
    fm, stats, train, test = fitted(spark, sf_dir, "logistic_regression")
    return X.kernel_contributions(fm, test, X.background_sample(train, 10), len(stats.features), n_coalitions=128)


def _linear_shapley(spark, sf_dir):
    """Exact contributions to the margins; the scaled training features have mean 0."""
    fm, stats, _, test = fixed(spark, sf_dir)
    return X.linear_contributions(fm, test, [0.0] * len(stats.features)), stats


@register("shapley_linear")
def q_shapley_linear(spark, sf_dir):
    c, _ = _linear_shapley(spark, sf_dir)
    return c.select("employee_id", "quarter_label", "feature_index", *[S.rnd(x, 6).alias(x) for x in X.CONTRIBUTIONS])


@register("shapley_global")
def q_shapley_global(spark, sf_dir):
    """X5 over the exact contributions of the linear margins."""
    c, stats = _linear_shapley(spark, sf_dir)
    return X.shapley_global(c, stats.features).withColumn("mean_abs", S.rnd("mean_abs", 6))


@register("shapley_global_sampled")
def q_shapley_global_sampled(spark, sf_dir):
    c, stats = _shapley(spark, sf_dir)
    return X.shapley_global(c, stats.features)


_BATCHES: dict = {}


def _batch_file(spark, sf_dir):
    """The test period as a scoring CSV (14 columns), written once for each session and state of the tables, and read back."""
    from panelsight.session import work_dir
    key, stamp = (spark.sparkContext.applicationId, sf_dir.rstrip("/")), inputs_stamp(spark, sf_dir)
    if key not in _BATCHES or _BATCHES[key][0] != stamp:
        _, test = split_frames(spark, sf_dir)
        path = work_dir(spark, "batch-input")
        test.select(*FS.BATCH_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
        _BATCHES[key] = stamp, path
    return FS.read_batch_csv(spark, _BATCHES[key][1], strict=True)


@register("scan_batch_csv")
def q_scan_batch(spark, sf_dir):
    return _batch_file(spark, sf_dir)


@register("id_column_resolution")
def q_id_resolution(spark, sf_dir):
    _, test = split_frames(spark, sf_dir)
    renamed = test.select(F.col("employee_id").alias("Employee ID"), "quarter_label")
    return FS.resolve_id(renamed).select("employee_id", "quarter_label")


@register("missing_feature_defaults")
def q_missing_defaults(spark, sf_dir):
    train, test = split_frames(spark, sf_dir)
    med = P.fit_median_imputer(train)
    return P.missing_feature_defaults(test.drop("salary"), fill=med).select(
        "employee_id", "quarter_label", "salary", "training_hours", "overtime_hours", "peer_score",
        "goal_achievement_pct")


def _scored_batch(spark, sf_dir):
    """The batch file scored, as it is exported."""
    fm, stats, _, _ = fixed(spark, sf_dir)
    batch = _batch_file(spark, sf_dir)
    return SC.scored_report(SC.score_batch(batch, fm, stats), batch.columns)


@register("score_batch")
def q_score_batch(spark, sf_dir):
    return _scored_batch(spark, sf_dir).drop("row_key")


@register("score_batch_zero")
def q_score_batch_zero(spark, sf_dir):
    """M12 with fill-with-0: an absent feature and empty cells count as 0."""
    fm, stats, _, _ = fixed(spark, sf_dir)
    _, test = split_frames(spark, sf_dir)
    scored = SC.score_batch(test.select("quarter_label", *FS.BATCH_COLUMNS).drop("salary"), fm, stats, null_policy="zero")
    return scored.select("employee_id", "quarter_label", "predicted_band", "confidence_pct")


@register("scored_summary")
def q_scored_summary(spark, sf_dir):
    fm, stats, _, _ = fixed(spark, sf_dir)
    return SC.scored_summary(SC.score_batch(_batch_file(spark, sf_dir), fm, stats))


@register("score_one")
def q_score_one(spark, sf_dir):
    """The records of the test period, each with its score, decision and explanation."""
    fm, stats, _, _ = fixed(spark, sf_dir)
    _, test = split_frames(spark, sf_dir)
    out = SC.score_records(test.select("quarter_label", *FS.BATCH_COLUMNS), fm, stats)
    return out.select("employee_id", "quarter_label", "predicted_band", "confidence_pct", "priority",
                      F.array_join("strengths_arr", " | ").alias("strengths"), F.array_join("concerns_arr", " | ").alias("concerns"))


@register("model_store")
def q_model_store(spark, sf_dir):
    from panelsight.session import work_dir
    fm, stats, _, test = fixed(spark, sf_dir)
    path = MS.save_bundle(spark, fm, stats, work_dir(spark, "bundle"))
    fm2, _ = MS.load_bundle(spark, path)
    a = MD.predict(fm, test).select("employee_id", "quarter_label", F.col("prediction").alias("p1"))
    b = MD.predict(fm2, test).select("employee_id", "quarter_label", F.col("prediction").alias("p2"))
    return a.join(b, ["employee_id", "quarter_label"]).select(
        "employee_id", "quarter_label", (F.col("p1") == F.col("p2")).alias("same"))


@register("feature_manifest")
def q_manifest(spark, sf_dir):
    """The bundle's features in order, with the rows of the test period that have each."""
    from panelsight.session import work_dir
    fm, stats, _, test = fixed(spark, sf_dir)
    path = MS.save_bundle(spark, fm, stats, work_dir(spark, "bundle"))
    names = MS.feature_manifest(spark, path)
    counts = test.agg(*[F.count(F.col(n)).alias(n) for n in names])
    pairs = ", ".join(f"{i}, '{n}', `{n}`" for i, n in enumerate(names))
    return counts.selectExpr(f"stack({len(names)}, {pairs}) AS (position, feature, n)")


@register("sink_scored_csv")
def q_sink_scored(spark, sf_dir):
    from panelsight.session import work_dir
    path = work_dir(spark, "scored")
    scored = _scored_batch(spark, sf_dir)
    FS.write_scored(scored, path)
    return FS.read_report(spark, path, scored.schema).drop("row_key")


# --- file round trips with SQL oracles ----------------------------------------------------

@register("scan_panel_csv")
def q_scan_panel_csv(spark, sf_dir):
    from panelsight.session import work_dir
    path = work_dir(spark, "panel-csv")
    FS.write_panel(raw_panel(spark, sf_dir), path, fmt="csv")
    return FS.read_panel_csv(spark, path)


@register("sink_panel_csv")
def q_sink_panel(spark, sf_dir):
    from panelsight.schema import PANEL_COLS
    from panelsight.session import work_dir
    path = work_dir(spark, "panel-parquet")
    FS.write_panel(raw_panel(spark, sf_dir), path, fmt="parquet", partition_by="review_year")
    return spark.read.parquet(path).select(*PANEL_COLS)


FEED_COLUMNS = ["employee_id", "quarter_label", "role", "salary", "goal_achievement_pct"]


def _faulty_feed(spark, sf_dir) -> str:
    """The panel as CSV text with faults by a rule: short and long records, records without an id, cells that are no
    numbers, and good cells with line breaks, quotes and commas."""
    from panelsight.session import work_dir
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    kind = (F.substring("employee_id", 4, 20).cast("long") + F.col("review_year") * 4 + F.col("review_quarter")) % 20
    role = F.when(kind == 4, F.concat("role", F.lit('\nsaid "yes", twice'))).otherwise(F.col("role"))
    cells = [quoted(F.when(kind == 2, "").otherwise(F.col("employee_id"))), F.col("quarter_label"), quoted(role), F.col("salary").cast("string"),
             F.when(kind == 3, "n/a").otherwise(F.coalesce(F.col("goal_achievement_pct").cast("string"), F.lit("")))]
    line = F.when(kind == 0, F.concat_ws(",", *cells[:-1])).when(kind == 1, F.concat_ws(",", *cells, F.lit("more"))).otherwise(F.concat_ws(",", *cells))
    header = ",".join(FEED_COLUMNS)

    def with_header(batches):
        import pyarrow as pa
        schema = None
        for batch in batches:
            if schema is None:  # every part file starts with the header
                schema = batch.schema
                yield pa.RecordBatch.from_arrays([pa.array([header], schema.field(0).type)], schema=schema)
            yield batch

    path = work_dir(spark, "feed")
    raw_panel(spark, sf_dir).select(line.alias("value")).mapInArrow(with_header, "value string").write.text(path)
    return path


def _scan(spark, sf_dir):
    from pyspark.sql.types import StructType
    from panelsight.schema import PANEL_SCHEMA
    from panelsight.session import work_dir
    schema = StructType([f for f in PANEL_SCHEMA.fields if f.name in FEED_COLUMNS])
    return FS.scan_csv_with_rejects(spark, _faulty_feed(spark, sf_dir), schema, work_dir(spark, "scan"), required=["employee_id", "quarter_label"])


@register("scan_rejects")
def q_scan_rejects(spark, sf_dir):
    """What a scan keeps of a faulty feed."""
    return _scan(spark, sf_dir).rows.select(*FEED_COLUMNS)


@register("scan_reject_counts")
def q_scan_reject_counts(spark, sf_dir):
    """The scan's counts, and its quarantine by reason."""
    scan = _scan(spark, sf_dir)
    return scan.rejects.agg(F.count_if(F.col("reason") == "ragged").alias("n_ragged"), F.count_if(F.col("reason") == "required").alias("n_required")).select(
        *[F.lit(getattr(scan, c)).cast("bigint").alias(c) for c in ("n_in", "n_out", "n_rejected", "n_bad_cells")], "n_ragged", "n_required")


REPORT_SCHEMA = ("employee_id string, quarter_label string, predicted_band string, confidence_pct double, "
                 "training_needed boolean, training_topics string, promotion_ready boolean, "
                 "pip_required boolean, pip_goals string, retention_risk string, wellbeing_flag boolean, "
                 "recommended_actions string, priority string, hr_summary string")
AUDIT_SCHEMA = ("group_name string, n_employees bigint, predicted_high_pct double, actual_high_pct double, "
                "gap_pts double, adverse_impact_ratio double, bias_flag string")


@register("sink_reports")
def q_sink_reports(spark, sf_dir):
    from panelsight.session import work_dir
    out = work_dir(spark, "reports")
    path = FS.write_report(q_decision_report(spark, sf_dir), "decisions", out)
    return FS.read_report(spark, path, REPORT_SCHEMA)


@register("load_report")
def q_load_report(spark, sf_dir):
    from panelsight.session import work_dir
    out = work_dir(spark, "reports")
    path = FS.write_report(FA.audit_by_group(_pseudo_scored(spark, sf_dir)), "fairness_department", out)
    return FS.read_report(spark, path, AUDIT_SCHEMA)


# --- explanation with fixed KPI weights (SQL-oracled) -----------------------------------------

# FIXED VALUES: the KPI roll-up weights used as a linear attribution vector
KPI_WEIGHTS = {"goal_achievement_pct": 0.30, "manager_rating": 0.20, "peer_score": 0.15,
               "attendance_rate": 0.15, "training_hours": 0.10, "projects_completed": 0.05,
               "overtime_hours": -0.05}


def _kpi_contrib(spark, sf_dir):
    train, test, stats = prepared(spark, sf_dir)
    w = [KPI_WEIGHTS.get(f, 0.0) for f in stats.features]
    x = vector_to_array("features")
    return test.withColumn("contrib", X.local_contributions(x, w)), stats


@register("local_contributions")
def q_local_contrib(spark, sf_dir):
    df, stats = _kpi_contrib(spark, sf_dir)
    return df.select("employee_id", "quarter_label", F.posexplode("contrib").alias("feature_index", "c")).select(
        "employee_id", "quarter_label", F.col("feature_index").cast("int").alias("feature_index"),
        S.rnd("c", 6).alias("contribution"))


def _names(features):
    return F.array(*[F.lit(f) for f in features])


@register("top_positive_drivers")
def q_top_pos(spark, sf_dir):
    df, stats = _kpi_contrib(spark, sf_dir)
    names = _names(stats.features)
    return df.select("employee_id", "quarter_label", F.array_join(
        F.transform(X.top_positive(F.col("contrib")), lambda i: F.element_at(names, i + 1)), "; ").alias("drivers"))


@register("top_negative_drivers")
def q_top_neg(spark, sf_dir):
    df, stats = _kpi_contrib(spark, sf_dir)
    names = _names(stats.features)
    return df.select("employee_id", "quarter_label", F.array_join(
        F.transform(X.top_negative(F.col("contrib")), lambda i: F.element_at(names, i + 1)), "; ").alias("drivers"))


RAW_FOR_FEATURES = ["age", "experience_years", "salary", "training_hours", "attendance_rate", "overtime_hours",
                    "projects_completed", "manager_rating", "peer_score", "goal_achievement_pct",
                    "department", "education", "role"]


@register("explain_rows")
def q_explain_rows(spark, sf_dir):
    df, stats = _kpi_contrib(spark, sf_dir)
    df = pseudo_predict(df)
    e = X.explain_rows(df, stats.features, "contrib", RAW_FOR_FEATURES, probs_col=None)
    return e.select("employee_id", "quarter_label", "predicted_band",
                    F.array_join("strengths_arr", " | ").alias("strengths"),
                    F.array_join("concerns_arr", " | ").alias("concerns"), "summary")


def _model_contrib(spark, sf_dir):
    fm, stats, _, test = fixed(spark, sf_dir)
    return MD.predict(fm, test).withColumn("contrib", X.model_contributions(fm, F.col("prediction"))), stats


@register("model_contributions")
def q_model_contributions(spark, sf_dir):
    """X6 by the coefficients of the class predicted for the row."""
    df, _ = _model_contrib(spark, sf_dir)
    return df.select("employee_id", "quarter_label", F.posexplode("contrib").alias("feature_index", "c")).select(
        "employee_id", "quarter_label", F.col("feature_index").cast("int").alias("feature_index"), S.rnd("c", 6).alias("contribution"))


@register("explain_model_rows")
def q_explain_model_rows(spark, sf_dir):
    """X7 by the model: its probabilities, and drivers by the predicted class."""
    df, stats = _model_contrib(spark, sf_dir)
    e = X.explain_rows(df, stats.features, "contrib", RAW_FOR_FEATURES)
    return e.select("employee_id", "quarter_label", "predicted_band", *[F.col("probabilities")[b].alias(f"p_{b.lower()}") for b in MD.BANDS],
                    F.array_join("strengths_arr", " | ").alias("strengths"), F.array_join("concerns_arr", " | ").alias("concerns"), "summary")


@register("model_shortlists")
def q_model_shortlists(spark, sf_dir):
    """W4 on the model's bands, ranked by the probability of the band."""
    return I.performer_shortlists(_fixed_rows(spark, sf_dir), score_col="confidence")


@register("feature_messages")
def q_feature_messages(spark, sf_dir):
    """The code pair of every feature that carries a contribution in the
    test rows (the whole test period is scanned)."""
    df, stats = _kpi_contrib(spark, sf_dir)
    names = _names(stats.features)
    used = (df.select(F.posexplode("contrib").alias("i", "c")).where(F.col("c") != 0)
            .select(F.element_at(names, F.col("i") + 1).alias("feature")).distinct())
    return used.select("feature", X.feature_message(F.col("feature"), True).alias("positive"),
                       X.feature_message(F.col("feature"), False).alias("negative"))


# --- remaining helpers of the inventory -------------------------------------------------------

@register("numeric_profile_cols")
def q_numeric_profile_cols(spark, sf_dir):
    """The wanted numeric columns that exist in the panel, in order (an
    absent name in the wanted list is skipped)."""
    wanted = ["age", "experience_years", "salary", "tenure_months", "training_hours", "attendance_rate",
              "overtime_hours", "projects_completed", "manager_rating", "peer_score", "goal_achievement_pct"]
    p = raw_panel(spark, sf_dir)
    return p.select("employee_id", "quarter_label", *I._present(p, wanted))


@register("align_predictions")
def q_align(spark, sf_dir):
    """``model.transform`` keeps every input column on its row -- the
    prediction is aligned with the row by construction, no positional join."""
    return _fixed_rows(spark, sf_dir).select("employee_id", "quarter_label", "department", "performance_band", "predicted_band")


@register("fairness_report")
def q_fairness_report(spark, sf_dir):
    """the three audit tables written as reports (S4) plus the flags, read
    back and summarised in one row."""
    from panelsight.session import work_dir
    rep = FA.fairness_report(_pseudo_scored(spark, sf_dir), "prediction", PARITY_REFERENCE)
    out = work_dir(spark, "fairness")
    paths = {k: FS.write_report(rep[k], f"fairness_{k}", out) for k in ("department", "experience", "parity")}
    dept = FS.read_report(spark, paths["department"], AUDIT_SCHEMA)
    par = FS.read_report(spark, paths["parity"], "group_name string, high_rate_pct double, spd double, "
                                                 "fairness_flag string")
    tiers = spark.read.options(**FS.CSV).csv(paths["experience"])
    nb, nl = F.lit(None).cast("boolean"), F.lit(None).cast("bigint")
    d = dept.agg(F.count(F.lit(1)).alias("n_groups"),
                 F.coalesce(F.bool_or(F.col("bias_flag") == "INVESTIGATE"), F.lit(False)).alias("bias_detected"),
                 nb.alias("parity_flagged"), nl.alias("n_tiers"))
    p = par.agg(nl.alias("n_groups"), nb.alias("bias_detected"),
                F.coalesce(F.bool_or(F.col("fairness_flag") == "REVIEW"), F.lit(False)).alias("parity_flagged"),
                nl.alias("n_tiers"))
    t = tiers.agg(nl.alias("n_groups"), nb.alias("bias_detected"), nb.alias("parity_flagged"),
                  F.count(F.lit(1)).alias("n_tiers"))
    # three one-row summaries stacked, then folded into one row
    return d.unionByName(p).unionByName(t).agg(
        F.max("n_groups").alias("n_groups"), F.bool_or("bias_detected").alias("bias_detected"),
        F.bool_or("parity_flagged").alias("parity_flagged"), F.max("n_tiers").alias("n_tiers"))


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """The batch file of the test period scored through Structured Streaming."""
    from panelsight.session import work_dir
    from panelsight.streaming import score_landing_folder
    fm, stats, _, _ = fitted(spark, sf_dir, "logistic_regression")
    _, test = split_frames(spark, sf_dir)
    landing, out, ckpt = (work_dir(spark, n) for n in ("landing", "stream-out", "stream-ckpt"))
    test.select(*FS.BATCH_COLUMNS).write.mode("overwrite").option("header", True).csv(landing)
    score_landing_folder(spark, landing, out, ckpt, fm, stats)
    return spark.read.parquet(out)
