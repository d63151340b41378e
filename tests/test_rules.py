"""Hand-checked decision rules on written rows (boundaries, NULLs, defaults)."""

from pyspark.sql import functions as F

from panelsight.operators import decisions as D
from panelsight.operators.fairness import audit_by_experience
from panelsight.functions.scalars import experience_tier, performance_band, kpi_score

COLS = ("employee_id string, predicted_band string, confidence double, training_hours double, "
        "attendance_rate double, overtime_hours double, goal_achievement_pct double, manager_rating double, "
        "peer_score double, projects_completed int, experience_years int, salary int")


def _one(spark, row):
    return D.decide(spark.createDataFrame([row], COLS)).first()


def test_low_performer_example(spark):
    # band Low, conf .72; training 8, attendance .75, overtime 35, goal 42, manager 2.1,
    # peer 2.8, projects 1, experience 3, salary 35000
    r = _one(spark, ("EMP0042", "Low", 0.72, 8.0, 0.75, 35.0, 42.0, 2.1, 2.8, 1, 3, 35000))
    assert r["training_topics_arr"] == [D.LEARN_TRAINING, D.LEARN_GOALS, D.LEARN_LEAD]
    assert r["pip_required"] and len(r["pip_goals_arr"]) == 3
    assert r["pip_goals_arr"] == ["PLAN.goal_achievement_pct:42>=70", "PLAN.manager_rating:2.1>=3.0", "PLAN.projects_completed:1>=3"]
    assert r["retention_points"] == 9 and r["retention_risk"] == "High"
    assert r["wellbeing_flag"]
    assert len(r["actions_arr"]) == 6
    assert r["priority"] == "Urgent"
    assert not r["promotion_ready"]
    assert r["confidence_pct"] == 72.0
    assert r["hr_summary"].startswith("priority=Urgent; band=Low; confidence=72.0; training=")


def test_generic_pip_goal(spark):
    r = _one(spark, ("E1", "Low", 0.6, 20.0, 0.95, 5.0, 70.0, 3.5, 3.5, 4, 6, 60000))
    assert r["pip_goals_arr"] == [D.PLAN_GENERAL]
    assert r["retention_risk"] == "Medium"  # 3 points for Low only


def test_promotion_boundaries(spark):
    ok = _one(spark, ("E2", "High", 0.9, 15.0, 0.9, 30.0, 85.0, 4.0, 3.0, 4, 5, 40000))
    assert ok["promotion_ready"] and not ok["wellbeing_flag"] and ok["priority"] == "Normal"
    no = _one(spark, ("E3", "High", 0.9, 15.0, 0.9, 30.0, 84.9, 4.0, 3.0, 4, 5, 40000))
    assert not no["promotion_ready"]


def test_medium_quick_win_and_priority(spark):
    s = _one(spark, ("E4", "Medium", 0.8, 15.0, 0.9, 10.0, 70.0, 3.0, 3.0, 3, 5, 50000))
    assert s["actions_arr"][-1] == D.GROW_STRETCH and s["priority"] == "Normal"
    k = _one(spark, ("E5", "Medium", 0.8, 14.9, 0.9, 10.0, 70.0, 3.0, 3.0, 3, 5, 50000))
    assert k["actions_arr"][-1] == D.GROW_SKILLS and k["priority"] == "Medium"


def test_nulls_make_rules_false(spark):
    r = _one(spark, ("E6", "Medium", 0.8, None, None, None, None, None, None, None, None, None))
    assert not r["training_needed"] and r["retention_points"] == 0 and not r["wellbeing_flag"]
    assert r["actions_arr"] == [D.GROW_SKILLS]


def test_absent_columns_use_rule_defaults(spark):
    df = spark.createDataFrame([("E7", "Low", 0.5)], "employee_id string, predicted_band string, confidence double")
    r = D.decide(df).first()
    # defaults: training 20, attendance .9, overtime 10, goal 60, manager 3, peer 3 -> only Low adds points
    assert r["retention_points"] == 3 and not r["training_needed"] and r["pip_goals_arr"] == [D.PLAN_GENERAL]


def test_band_and_tiers(spark):
    df = spark.createDataFrame([(75.0, 3), (74.99, 4), (50.0, 8), (49.99, 9), (None, -1)], "s double, y int")
    got = df.select(performance_band("s").alias("b"), experience_tier("y").alias("t")).collect()
    assert [r.b for r in got] == ["High", "Medium", "Medium", "Low", None]
    assert [r.t for r in got] == ["Junior (0–3 yrs)", "Mid (4–8 yrs)", "Mid (4–8 yrs)", "Senior (9+ yrs)", None]


def test_kpi_clip_and_null(spark):
    df = spark.createDataFrame([(100.0, 5.0, 5.0, 1.0, 60.0, 12, 0.0), (10.0, 1.0, 1.0, 0.6, None, 0, 50.0)],
                               "g double, m double, p double, a double, t double, pr int, o double")
    got = df.select(kpi_score("g", "m", "p", "a", "t", "pr", "o").alias("k")).collect()
    assert got[0].k == 100.0 and got[1].k is None


def test_experience_audit_omits_empty_tiers(spark):
    df = spark.createDataFrame([(1, 2, "High"), (2, 0, "Low")],
                               "experience_years int, prediction int, performance_band string")
    rows = {r.experience_tier: r for r in audit_by_experience(df).collect()}
    assert set(rows) == {"Junior (0–3 yrs)"} and rows["Junior (0–3 yrs)"].predicted_high_pct == 50.0


def test_rule_counts_match_fixture_sf001(spark):
    """Counts per rule on the sf0.01 panel (actual band as the prediction)."""
    from panelsight.plans.queries import clean_panel
    from tests.conftest import MEDIUM
    p = clean_panel(spark, MEDIUM).withColumns({"predicted_band": F.col("performance_band"),
                                                "confidence": F.lit(1.0)})
    d = D.decide(p)
    c = d.agg(F.count_if("pip_required").alias("pip"), F.count_if("promotion_ready").alias("promo"),
              F.count_if(F.col("retention_risk") == "High").alias("rh"),
              F.count_if(F.col("retention_risk") == "Medium").alias("rm"),
              F.count_if(F.col("overtime_hours") > 30).alias("ot"),
              F.count_if(F.col("attendance_rate") < 0.8).alias("att")).first()
    assert (c.pip, c.promo, c.rh, c.rm, c.ot, c.att) == (70, 78, 66, 192, 68, 122)
