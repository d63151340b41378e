"""Properties of preparation, models, explanation and plans (sf0.001 / sf0.01)."""


import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelsight.operators import explain as X
from panelsight.operators import models as MD
from panelsight.operators import prep as P
from panelsight.operators import scoring as SC
from panelsight.plans import queries as Q
from panelsight.schema import FEATURE_COLS
from tests.conftest import MEDIUM, SMALL

FAST = MD.TrainParams(rf_trees=20, gbt_rounds=5, lr_max_iter=200)


@pytest.fixture(scope="module")
def prepared(spark):
    train, test, stats = Q.prepared(spark, MEDIUM)
    return train.cache(), test.cache(), stats


@pytest.fixture(scope="module")
def lr(prepared):
    return MD.train_logreg(prepared[0], FAST)


def test_split_no_overlap_and_order(spark):
    clean = Q.clean_panel(spark, SMALL)
    train, test = P.time_split(clean, Q.CUTOFF)
    keys = ["employee_id", "review_year", "review_quarter"]
    assert train.join(test, keys).count() == 0
    assert train.count() + test.count() == clean.count()
    assert train.agg(F.max(F.col("review_year") * 10 + F.col("review_quarter"))).first()[0] < 20001
    assert test.agg(F.min(F.col("review_year") * 10 + F.col("review_quarter"))).first()[0] >= 20001


def test_fit_uses_train_only(spark):
    """Fitted statistics do not move when the test-period rows change."""
    clean = Q.clean_panel(spark, SMALL)
    train, _ = P.time_split(clean, Q.CUTOFF)
    a = P.fit_prep(train)
    altered = clean.withColumn("goal_achievement_pct", F.when(
        F.col("review_year") >= 2000, F.lit(1.0)).otherwise(F.col("goal_achievement_pct")))
    b = P.fit_prep(P.time_split(altered, Q.CUTOFF)[0])
    assert a.to_json() == b.to_json()


def test_class_counts_match_fixture(spark):
    clean = Q.clean_panel(spark, MEDIUM)
    train, test = P.time_split(clean, Q.CUTOFF)
    def counts(df):
        return {r.performance_band: r["count"] for r in df.groupBy("performance_band").count().collect()}
    assert counts(train) == {"Low": 17, "Medium": 1591, "High": 392}
    assert counts(test) == {"Low": 53, "Medium": 609, "High": 138}


def test_scaled_train_is_standardised(prepared):
    train, _, stats = prepared
    arr = vector_to_array("features")
    agg = train.agg(*[F.avg(arr[i]).alias(f"m{i}") for i in range(len(FEATURE_COLS))],
                    *[F.stddev_pop(arr[i]).alias(f"s{i}") for i in range(len(FEATURE_COLS))]).first()
    for i in range(len(FEATURE_COLS)):
        assert abs(agg[f"m{i}"]) < 1e-9
        assert abs(agg[f"s{i}"] - 1.0) < 1e-9 or agg[f"s{i}"] == 0.0


@pytest.mark.parametrize("name", MD.MODEL_ORDER)
def test_probabilities_sum_to_one_and_beat_majority(prepared, name):
    train, test, _ = prepared
    fm = MD.TRAINERS[name](train, FAST)
    s = MD.predict(fm, test)
    bad = s.where(F.abs(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x) - 1.0) > 1e-9).count()
    assert bad == 0
    assert s.where(F.size("probs") != 3).count() == 0
    acc = s.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    assert acc >= majority - 0.02


def test_absent_class_gets_zero_probability(prepared):
    train, test, _ = prepared
    no_low = train.where(F.col("label") != 0)
    fm = MD.train_logreg(no_low, FAST)
    assert fm.classes == [1, 2]
    s = MD.predict(fm, test)
    assert s.where(F.col("probs")[0] != 0.0).count() == 0
    assert s.where(F.col("prediction") == 0).count() == 0


def test_confusion_sums_to_n(spark):
    from panelsight.operators import metrics as M
    p = Q.pseudo_predict(Q.clean_panel(spark, SMALL))
    assert M.confusion_matrix(p).agg(F.sum("n")).first()[0] == p.count()


def test_model_store_roundtrip(spark, prepared, lr):
    from panelsight.session import work_dir
    from panelsight.sources import model_store as MS
    _, test, stats = prepared
    path = MS.save_bundle(spark, lr, stats, work_dir(spark, "t-bundle"))
    fm2, stats2 = MS.load_bundle(spark, path)
    assert stats2.to_json() == stats.to_json()
    assert MS.feature_manifest(spark, path) == FEATURE_COLS
    a = MD.predict(lr, test).select("employee_id", "quarter_label", F.col("prediction").alias("a"))
    b = MD.predict(fm2, test).select("employee_id", "quarter_label", F.col("prediction").alias("b"))
    assert a.join(b, ["employee_id", "quarter_label"]).where("a != b").count() == 0


def test_shapley_additivity(spark, prepared, lr):
    """With one background row every permutation telescopes to f(x) - f(bg),
    so the averaged contributions add up to it exactly, for every class."""
    train, test, stats = prepared
    rows = test.limit(25)
    bg = X.background_sample(train, 1)
    c = X.shapley_contributions(lr, rows, bg, len(stats.features), n_permutations=3)
    sums = c.groupBy("employee_id", "quarter_label").agg(
        F.sum("contrib_low").alias("s0"), F.sum("contrib_medium").alias("s1"), F.sum("contrib_high").alias("s2"))
    fx = MD.predict(lr, rows).select("employee_id", "quarter_label", "probs")
    from pyspark.ml.functions import array_to_vector
    bg_vec = bg.select(array_to_vector("bg").alias("features"))
    fb = MD.predict(lr, bg_vec).first()["probs"]
    got = sums.join(fx, ["employee_id", "quarter_label"]).collect()
    assert len(got) == 25
    for r in got:
        for k in range(3):
            assert abs(r[f"s{k}"] - (r.probs[k] - fb[k])) < 1e-9


def test_shapley_of_repeated_keys(prepared, lr):
    train, test, stats = prepared
    rows = test.limit(3).withColumns({"employee_id": F.lit("E"), "quarter_label": F.lit("2000-Q1")})
    bg = X.background_sample(train, 5)
    c = X.shapley_contributions(lr, rows, bg, len(stats.features), n_permutations=2)
    assert c.count() == len(stats.features)
    assert "lead(" not in c._jdf.queryExecution().executedPlan().toString()


def test_permutation_of_constant_feature_is_zero(spark, prepared):
    train, test, stats = prepared
    panel = Q.clean_panel(spark, MEDIUM).withColumn("age", F.lit(40))
    const = P.transform_prep(P.time_split(panel, Q.CUTOFF)[1], stats)
    fm = MD.train_logreg(train, FAST)
    imp = {r.feature: r for r in X.permutation_importance(fm, const, stats.features, n_repeats=2).collect()}
    assert set(imp) == set(stats.features)
    assert abs(imp["age"].importance) < 1e-9 and imp["age"].std < 1e-9
    assert any(r.importance > 0 for r in imp.values())


def test_batch_scoring_variants(spark, prepared, lr):
    _, _, stats = prepared
    rows = [("EMP0042", 30.0, 3.0, 35000.0, 8.0, 0.75, 35.0, 1.0, 2.1, 2.8, 42.0, "EUROPE", "PhD", "FRANCE"),
            ("EMP0173", 40.0, 12.0, 95000.0, 28.0, 0.97, 8.0, 6.0, 4.6, 4.5, 92.0, "NOWHERE", "PhD", "X")]
    cols = ["Employee ID", "age", "experience_years", "salary", "training_hours", "attendance_rate",
            "overtime_hours", "projects_completed", "manager_rating", "peer_score", "goal_achievement_pct",
            "department", "education", "role"]
    df = spark.createDataFrame(rows, cols)
    out = SC.score_batch(df, lr, stats).collect()
    assert [r.employee_id for r in out] == ["EMP0042", "EMP0173"]   # id alias resolved, unseen -> 0
    no_id = SC.score_batch(df.drop("Employee ID").drop("salary"), lr, stats).collect()
    assert len(no_id) == 2 and all(r.employee_id.startswith("ROW") for r in no_id)


def test_no_python_udf_in_plans(spark):
    import __spark_entry__ as E
    for name in ["decision_report", "feature_histogram", "audit_by_group", "prep_pipeline", "explain_rows"]:
        plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_time_split_prunes_year_partitions(spark):
    clean = Q.clean_panel(spark, SMALL)
    train, _ = P.time_split(clean, Q.CUTOFF)
    plan = train._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert "review_year" in filters and "<= 2000" in filters


def test_batch_id_alias_nulls_and_unseen_error(spark, prepared, lr):
    import pytest as _pt
    _, _, stats = prepared
    df = spark.createDataFrame(
        [("7", 30.0, None, 35000.0, None, 0.75, 35.0, 1.0, 2.1, None, 42.0, "EUROPE", None, "FRANCE")],
        "id string, age double, experience_years double, salary double, training_hours double, "
        "attendance_rate double, overtime_hours double, projects_completed double, manager_rating double, "
        "peer_score double, goal_achievement_pct double, department string, education string, role string")
    r = SC.score_batch(df, lr, stats).first()
    assert r.employee_id == "7" and r.predicted_band in ("Low", "Medium", "High")
    assert abs(sum(r.probs) - 1.0) < 1e-9
    with _pt.raises(Exception):
        P.apply_label_encoder(df, stats.encoder, unseen="error").collect()


def test_panel_scan_prunes_and_pushes(spark):
    from panelsight.sources.panel import load_panel
    plan = load_panel(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_suppkey), IsNotNull(l_shipdate)]" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_discount:double,l_tax:double," in plan
    assert "l_extendedprice" not in plan and "l_orderkey" not in plan


def test_stream_scorer_scores_each_file_once(spark, prepared, lr):
    """A restarted stream over the same landing folder and checkpoint only
    scores files that arrived since the previous run."""
    from panelsight.session import work_dir
    from panelsight.sources.files import BATCH_COLUMNS
    from panelsight.streaming import score_landing_folder
    _, _, stats = prepared
    _, test = P.time_split(Q.clean_panel(spark, SMALL), Q.CUTOFF)
    rows = test.select(*BATCH_COLUMNS).orderBy("employee_id")
    landing, out, ckpt = (work_dir(spark, n) for n in ("t-landing", "t-out", "t-ckpt"))
    rows.limit(10).write.option("header", True).csv(f"{landing}/batch-1")
    score_landing_folder(spark, f"{landing}/*", out, ckpt, lr, stats)
    assert spark.read.parquet(out).count() == 10
    rows.limit(7).write.option("header", True).csv(f"{landing}/batch-2")
    score_landing_folder(spark, f"{landing}/*", out, ckpt, lr, stats)
    assert spark.read.parquet(out).count() == 17


def test_forest_does_not_depend_on_input_partitions(prepared, monkeypatch):
    train, test, _ = prepared
    params = MD.TrainParams(rf_trees=8)
    probs = []
    for k, rows in ((1, 5000), (5, 400)):
        monkeypatch.setattr(MD.TR, "ROWS_PER_TASK", rows)
        fm = MD.train_random_forest(train.repartition(k), params)
        probs.append([list(r.probs) for r in MD.predict(fm, test).orderBy("employee_id", "quarter_label").collect()])
    assert probs[0] == probs[1]


def test_logistic_regression_is_at_its_optimum(prepared):
    """The gradient of C * sum(w * loss) + |b|^2 / 2 vanishes at the fitted coefficients."""
    import numpy as np
    train, _, _ = prepared
    fm = MD.train_logreg(train)
    rows = train.select(F.col("label").cast("int"), "features").collect()
    y, x = np.array([r[0] for r in rows]), np.array([r[1].toArray() for r in rows])
    counts = np.bincount(y, minlength=3)
    weights = (len(y) / ((counts > 0).sum() * np.maximum(counts, 1)))[y]
    b, a = fm.model.coefficientMatrix.toArray(), fm.model.interceptVector.toArray()
    z = x @ b.T + a
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    error = (p - np.eye(3)[y]) * weights[:, None]
    assert np.abs(error.T @ x + b).max() < 0.02 * len(y) ** 0.5
    assert np.abs(error.sum(0)).max() < 0.02 * len(y) ** 0.5


def test_score_one_explains_the_model(spark, prepared, lr):
    from panelsight.operators import scoring as SC
    _, _, stats = prepared
    record = {"employee_id": "E1", "age": 30, "experience_years": 4, "salary": 50000, "training_hours": 12.0, "attendance_rate": 0.9,
              "overtime_hours": 5.0, "projects_completed": 3, "manager_rating": 3.0, "peer_score": 3.0, "goal_achievement_pct": 40.0,
              "department": "ASIA", "education": "Bachelors", "role": "CHINA"}
    r = SC.score_one(spark, record, lr, stats).first()
    assert abs(sum(r.probabilities.values()) - 1) < 0.01 and r.predicted_band in r.probabilities
    assert r.summary.startswith(f"band={r.predicted_band}; confidence={r.confidence_pct}")
    k = int(r.prediction)
    x, w = r.features.toArray(), lr.model.coefficientMatrix.toArray()[k]
    best = max(range(len(x)), key=lambda j: x[j] * w[j])
    assert r.strengths_arr[0].startswith(f"raises:{stats.features[best]}=")
    report = SC.scored_report(SC.score_batch(spark.createDataFrame([record]), lr, stats), list(record))
    assert set(record) <= set(report.columns)


def test_outputs_and_command_line(spark, tmp_path, monkeypatch, capsys):
    import json
    from panelsight.plans import pipeline
    monkeypatch.setattr(pipeline.MD, "TrainParams", lambda: FAST)
    pipeline.main(["--sf-dir", SMALL, "--out", str(tmp_path), "--models", "logistic_regression"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["best"] == "logistic_regression"
    for name in ("decisions", "model_comparison", "feature_importance", "fairness_department", "permutation_importance"):
        assert spark.read.option("header", True).csv(out["outputs"][name]).count() > 0, name
    from panelsight.sources import model_store as MS
    fm, stats = MS.load_bundle(spark, out["outputs"]["model:best"])
    assert stats.encoder.count() > 0 and fm.classes
