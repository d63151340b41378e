"""Physical-plan properties behind the scale design."""

import __spark_entry__ as E
from panelsight.sources.panel import load_panel
from tests.conftest import SMALL


def _plan(df) -> str:
    df.collect()  # AQE: final plan after execution
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_panel_scans_lineitem_once_and_aggregates_map_side(spark):
    plan = _plan(load_panel(spark, SMALL))
    assert plan.count("lineitem.parquet") == 1
    assert "partial_count" in plan and "partial_sum" in plan


def test_decisions_are_narrow(spark):
    plan = _plan(E.queries()["decision_report"](spark, SMALL))
    assert "Exchange" not in plan


def test_group_reports_combine_map_side(spark):
    for name in ["dept_band_pct", "audit_by_group", "quality_profile", "classification_report"]:
        plan = _plan(E.queries()[name](spark, SMALL))
        assert "partial_" in plan, name


def test_shortlist_limits_before_shuffle(spark):
    plan = _plan(E.queries()["performer_shortlists"](spark, SMALL))
    assert "WindowGroupLimit" in plan


def test_metrics_single_pass(spark):
    plan = _plan(E.queries()["confusion_matrix"](spark, SMALL))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_model_comparison_is_one_shuffle(spark):
    plan = _plan(E.queries()["compare_models"](spark, SMALL))
    assert len([ln for ln in plan.splitlines() if "Exchange" in ln and "Broadcast" not in ln]) <= 1


def test_model_comparison_by_fitted_models_is_one_shuffle(spark):
    plan = _plan(E.queries()["compare_fitted_models"](spark, SMALL))
    assert len([ln for ln in plan.splitlines() if "Exchange" in ln and "Broadcast" not in ln]) <= 1


def test_exact_shapley_is_narrow(spark):
    for name in ("shapley_linear", "shapley_forest", "shapley_boosted"):
        assert "Exchange" not in _plan(E.queries()[name](spark, SMALL)), name
