"""Fits and explanations whose work stays in the tasks: what reaches the driver or a shuffle doesn't grow with the rows."""

import pickle

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelsight.operators import explain as X
from panelsight.operators import metrics as M
from panelsight.operators import models as MD
from panelsight.operators import tree_shap as TS
from panelsight.operators import trees as TR
from panelsight.plans import fixed_models as FX
from panelsight.session import remove
from panelsight.sources import stored as ST


@pytest.fixture(scope="module")
def points(spark):
    """300 rows with 13 features, keys and labels."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 13))
    rows = [(f"e{i}", f"q{i % 4}", x[i].tolist(), float(i % 3)) for i in range(len(x))]
    df = spark.createDataFrame(rows, "employee_id string, quarter_label string, x array<double>, label double")
    return df.select("employee_id", "quarter_label", array_to_vector("x").alias("features"), "label").cache(), x


@pytest.fixture(scope="module")
def background(spark):
    rng = np.random.default_rng(6)
    return spark.createDataFrame([(i, rng.normal(size=13).tolist()) for i in range(4)], "_bi int, bg array<double>")


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_splits_are_judged_where_histograms_are_added(spark):
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 9, (50, 2, 40)) for _ in range(7)]
    best = lambda h: (h.sum((1, 2)), h[:, 0].argmax(1))
    for tasks in (1, 3, 7):
        found = TR._best(spark.sparkContext.parallelize(blocks, tasks), lambda b: b.copy(), 50, TR.RANGE_BYTES // 10, best)
        assert all((a == b).all() for a, b in zip(found, best(sum(blocks)))) and [a.shape for a in found] == [(50,), (50,)]


def test_rows_are_dealt_evenly_whatever_their_blocks(spark):
    size = TR.ROWS_PER_TASK
    blocks = [(np.full((n, 2), i, np.uint8), np.zeros(n, np.uint8), np.arange(n)) for i, n in enumerate([1000] * 200)]
    base = spark.sparkContext.parallelize(blocks, 2)
    parts = TR.dealt(base, 3 * size, 4000).glom().collect()
    held = [sum(len(b[1]) for b in part) for part in parts]
    assert len(parts) == min(3, spark.sparkContext.defaultParallelism) and sum(held) == 200_000 and max(held) - min(held) <= 12_000
    assert all(b[0].shape == (2, len(b[1])) and len(b[1]) <= 4000 for part in parts for b in part)


def test_scorer_is_predict(spark, points):
    df, x = points
    for kind in ("linear", "forest", "boosted"):
        fm = getattr(FX, kind)(spark, 13)
        for classes in ([0, 1, 2], [0, 2]) if kind != "boosted" else ([0, 1, 2],):
            fm.classes = classes
            got = {r.employee_id: r.probs for r in MD.predict(fm, df).collect()}
            assert np.abs(MD.scorer(fm)(x) - np.array([got[f"e{i}"] for i in range(len(x))])).max() < 1e-12


def test_kernel_variants_are_not_shuffled(spark, points, background):
    plan = _plan(X.kernel_contributions(FX.linear(spark, 13), points[0], background, 13, n_coalitions=20))
    assert "Exchange" not in plan and "Generate" not in plan


def test_kernel_works_for_trees(spark, points, background):
    df = points[0].limit(5)
    fm = FX.boosted(spark, 13)
    found = X.kernel_contributions(fm, df, background, 13, n_coalitions=40).groupBy("employee_id").agg(F.sum("contrib_high").alias("s")).collect()
    own = {r.employee_id: r.probs[2] for r in MD.predict(fm, df).collect()}
    back = background.select(array_to_vector("bg").alias("features"))
    mean = np.mean([r.probs[2] for r in MD.predict(fm, back).collect()])
    assert all(abs(r.s - (own[r.employee_id] - mean)) < 1e-9 for r in found) and len(found) == 5


def test_sampled_contributions_shuffle_one_row_for_each_row(spark, points, background):
    c = X.shapley_contributions(FX.linear(spark, 13), points[0], background, 13, n_permutations=3)
    plan = _plan(c)
    below = plan[plan.index("Exchange"):]
    assert "Generate" not in below and "MapInArrow" in below  # neither permutations nor their vectors are rows


def test_repeated_keys_share_one_average(spark, points, background):
    fm, df = FX.linear(spark, 13), points[0].limit(1).cache()
    once = X.shapley_contributions(fm, df, background, 13, n_permutations=3).collect()
    twice = X.shapley_contributions(fm, df.unionByName(df), background, 13, n_permutations=3).collect()
    by = lambda rows: sorted((r.feature_index, round(r.contrib_high, 12)) for r in rows)
    assert len(once) == 13 and by(once) == by(twice)


def test_counted_variants_are_those_of_predict(spark, points):
    df, _ = points
    fm = FX.linear(spark, 13)
    rows, _, path = X.donated(df, 13, 2)
    mixed = F.transform("x", lambda v, i: F.when(i == F.col("k") % 13, F.col("value")).otherwise(v))
    perm = rows.select("label", "x", F.inline("got")).select("k", "label", array_to_vector(mixed).alias("features"))
    want = {(r.k % 13, r.k // 13, int(r.label), int(r.prediction)): r["count"] for r in MD.predict(fm, perm).groupBy("k", "label", "prediction").count().collect()}
    counted = X._counted_variants(fm, rows, 13, 2)
    got: dict = {}
    for r in counted.collect():
        at = (r.f, r.r, r.label, r.prediction)
        got[at] = got.get(at, 0) + r.n
    assert got == want
    f1 = {r.f: r.f1_macro for r in M.macro_f1_by(counted, ["f"], count_col="n").collect()}
    expanded = counted.select("f", "label", "prediction", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    assert f1 == {r.f: r.f1_macro for r in M.macro_f1_by(expanded, ["f"]).collect()}
    remove(spark, path)


def _tree(depth: int, rng) -> dict:
    nodes: dict = {k: [] for k in ("feature", "threshold", "left", "right", "value", "cover")}

    def grow(k, cover):
        i = len(nodes["feature"])
        for name, v in zip(nodes, (-1, 0.0, -1, -1, rng.random(2), cover)):
            nodes[name].append(v)
        if k:
            share = rng.uniform(0.2, 0.8)
            nodes["feature"][i], nodes["threshold"][i] = int(rng.integers(0, 13)), float(rng.normal())
            nodes["left"][i] = grow(k - 1, cover * share)
            nodes["right"][i] = grow(k - 1, cover * (1 - share))
        return i

    grow(depth, 100.0)
    return {**{k: np.array(v) for k, v in nodes.items()}, "weight": 1.0}


def test_tables_give_what_single_rows_give(monkeypatch):
    rng = np.random.default_rng(2)
    ensemble, x = TS.Ensemble([[_tree(d, rng) for d in (0, 1, 5, 8)]], 13), rng.normal(size=(50, 13))
    with_tables = ensemble.values(x)
    monkeypatch.setattr(TS, "TABLES", 0)
    assert np.abs(ensemble.values(x) - with_tables).max() < 1e-12


def test_an_ensemble_is_sent_as_its_leaves():
    tree = _tree(8, np.random.default_rng(3))
    assert len(pickle.dumps(TS.Ensemble([[tree]], 13))) < 300 * 256  # 256 leaves; the products' matrix had 13 * 2 numbers for each place of a path


def test_a_stored_year_is_many_files(spark):
    df = spark.range(40_000).selectExpr("id", "1994 AS review_year")
    copy, path = ST.materialize(df, "t-files", "review_year", rows_per_file=ST.ROWS_PER_FILE)
    assert len(copy.inputFiles()) >= 3 and copy.count() == 40_000
    remove(spark, path)
