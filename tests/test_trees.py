"""Histogram learners, Spark's models of them, exact and estimated Shapley values, permutations."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from panelsight.operators import explain as X
from panelsight.operators import models as MD
from panelsight.operators import permute as PM
from panelsight.operators import trees as TR
from panelsight.plans import fixed_models as FX
from panelsight.plans import queries as Q
from tests.conftest import MEDIUM

KEYS = ["employee_id", "quarter_label"]


@pytest.fixture(scope="module")
def prepared(spark):
    train, test, stats = Q.prepared(spark, MEDIUM)
    return train.cache(), test.cache(), stats


@pytest.fixture(scope="module")
def small(spark):
    """500 rows with few and many values, and a key."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=500).round(3), rng.integers(0, 4, 500), rng.normal(size=500), rng.integers(0, 300, 500) / 7])
    y = np.where(x[:, 0] + x[:, 1] > 2.2, 2, np.where(x[:, 2] * x[:, 3] > 4, 0, 1))
    rows = [(f"e{i}", "2000-Q1", x[i].tolist(), float(y[i])) for i in range(500)]
    df = spark.createDataFrame(rows, "employee_id string, quarter_label string, x array<double>, label double")
    keys = {r.employee_id: r.k for r in df.select("employee_id", F.xxhash64(*KEYS).alias("k")).collect()}
    return df.select(*KEYS, array_to_vector("x").alias("features"), "label"), x, y, np.array([keys[f"e{i}"] for i in range(500)])


def _leaf(tree, row):
    n = 0
    while tree.feature[n] >= 0:
        n = tree.left[n] if row[tree.feature[n]] < tree.threshold[n] else tree.right[n]
    return n


def _plain_boost(x, y, keys, p):
    """Second-order boosting, node by node over sorted values, with the same draws."""
    n, d = x.shape
    edges = []
    for f in range(d):
        v, c = np.unique(x[:, f], return_counts=True)
        bins = (np.concatenate([[0], np.cumsum(c)[:-1]]) * p.bins) // n
        edges.append([v[bins == b].min() for b in np.unique(bins)][1:])
    margins = np.zeros((n, 3))
    unit = float(1 << min(TR.FIXED_POINT, 62 - math.ceil(math.log2(n))))
    for r in range(p.rounds):
        prob = np.exp(margins - margins.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        used = TR._uniform(keys, p.seed, 2, r) < p.rows
        trees = []
        for c in range(3):
            g = np.rint((prob[:, c] - (y == c)) * used * unit) / unit
            h = np.rint(np.maximum(2 * prob[:, c] * (1 - prob[:, c]), 1e-16) * used * unit) / unit
            columns = TR.drawn(max(1, int(p.columns * d)), d, p.seed, 1, r, c)

            def grow(at, depth):
                gt, ht = g[at].sum(), h[at].sum()
                best = (1e-6, None)
                if depth < p.depth:
                    for f in columns:
                        for e in edges[f]:
                            left = at[x[at, f] < e]
                            gl, hl = g[left].sum(), h[left].sum()
                            gr, hr = gt - gl, ht - hl
                            if hl >= p.least_hessian and hr >= p.least_hessian:
                                gain = gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - gt * gt / (ht + p.l2)
                                if gain > best[0] * (1 + 1e-12):
                                    best = (gain, (f, e))
                if best[1] is None:
                    return {"value": -gt / (ht + p.l2), "rows": at}
                f, e = best[1]
                return {"f": f, "e": e, "two": (grow(at[x[at, f] < e], depth + 1), grow(at[x[at, f] >= e], depth + 1))}

            trees.append(grow(np.arange(n), 0))

        def add(node, at, c):
            if "value" in node:
                margins[at, c] += p.step * node["value"]
            else:
                left = x[at, node["f"]] < node["e"]
                add(node["two"][0], at[left], c)
                add(node["two"][1], at[~left], c)
        for c, tree in enumerate(trees):
            add(tree, np.arange(n), c)
    return margins


def _margins(rounds, x, step):
    return np.array([[sum(step * r[c].value[_leaf(r[c], row)] for r in rounds) for c in range(len(rounds[0]))] for row in x])


def test_boosting_equals_a_plain_one(small):
    df, x, y, keys = small
    p = TR.BoostParams(rounds=6, depth=4, step=0.3, bins=64)
    rounds = TR.boost(df, 4, [0, 1, 2], p)
    assert np.abs(_margins(rounds, x, p.step) - _plain_boost(x, y, keys, p)).max() < 1e-9


@pytest.mark.parametrize("learner", ["boost", "forest"])
def test_trees_do_not_depend_on_partitions(small, monkeypatch, learner):
    df, *_ = small
    monkeypatch.setattr(TR, "BLOCK", 90)
    monkeypatch.setattr(TR, "CHECKPOINT_EVERY", 2)
    made = []
    for k, per_task in ((1, 500), (7, 100), (50, 33)):
        monkeypatch.setattr(TR, "ROWS_PER_TASK", per_task)
        if learner == "boost":
            trees = [t for r in TR.boost(df.repartition(k), 4, [0, 1, 2], TR.BoostParams(rounds=5, depth=3)) for t in r]
        else:
            trees = TR.forest(df.repartition(k), 4, 3, {0: 1.5, 1: 0.5, 2: 1.0}, TR.ForestParams(trees=6, depth=4))
        made.append([(t.feature, t.threshold, t.value, t.cover) for t in trees])
    assert made[0] == made[1] == made[2]


def test_forest_nodes(small):
    """Leaf classes are the Poisson counts that reach the leaf; splits leave the rows they must."""
    df, x, y, keys = small
    weights = np.array([2.0, 1.0, 0.5])
    p = TR.ForestParams(trees=3, depth=5, least_rows=8)
    for t, tree in enumerate(TR.forest(df, 4, 3, dict(enumerate(weights)), p)):
        count = TR.poisson(keys, p.seed, 4, t)
        leaf = np.array([_leaf(tree, r) for r in x])
        assert len(set(leaf)) > 4
        for n in set(leaf):
            at = leaf == n
            assert np.allclose(tree.value[n], [(count * at * (y == c)).sum() * weights[c] for c in range(3)])
            assert tree.rows[n] == (at & (count > 0)).sum() >= 8
        for n, f in enumerate(tree.feature):
            if f >= 0:
                assert f in TR.drawn(2, 4, p.seed, 3, t, n) and tree.gain[n] > 0
    u = TR.poisson(np.arange(200_000), 1, 2)
    assert abs(u.mean() - 1) < 0.01 and abs(u.var() - 1) < 0.02


def test_spark_models_score_like_the_trees(spark, small):
    df, x, y, _ = small
    forest = TR.forest(df, 4, 3, {0: 1.0, 1: 1.0, 2: 1.0}, TR.ForestParams(trees=5, depth=4))
    fm = MD.FittedModel("random_forest", TR.as_spark_model(spark, forest, 4, 3), [0, 1, 2])
    got = {r.employee_id: list(r.probs) for r in MD.predict(fm, df).collect()}
    want = np.array([np.mean([np.array(t.value[_leaf(t, r)]) / sum(t.value[_leaf(t, r)]) for t in forest], axis=0) for r in x])
    assert np.abs(np.array([got[f"e{i}"] for i in range(500)]) - want).max() < 1e-12
    total = np.zeros(4)
    for t in forest:
        own = np.zeros(4)
        for f, g in zip(t.feature, t.gain):
            if f >= 0:
                own[f] += g
        total += own / (own.sum() or 1)
    assert np.allclose(X.model_importance(fm, ["a"] * 4), total / total.sum())
    rounds = TR.boost(df, 4, [0, 1, 2], TR.BoostParams(rounds=4, depth=3))
    margins = [TR.as_spark_model(spark, [r[k] for r in rounds], 4, step=0.05) for k in range(3)]
    fb = MD.FittedModel("boosted_trees", MD.BoostedTreesModel(margins, 4), [0, 1, 2])
    got = {r.employee_id: list(r.probs) for r in MD.predict(fb, df).collect()}
    assert np.abs(np.array([got[f"e{i}"] for i in range(500)]) - TR.softmax(_margins(rounds, x, 0.05))).max() < 1e-12
    imp = X.model_importance(fb, ["a"] * 4)
    assert abs(sum(imp) - 1) < 1e-12 and min(imp) >= 0


def test_boosting_with_one_or_two_classes(small):
    df, x, *_ = small
    fm = MD.train_boosted_trees(df.where("label <> 0"), MD.TrainParams(gbt_rounds=3))
    probs = np.array([r.probs for r in MD.predict(fm, df).collect()])
    assert fm.classes == [1, 2] and (probs[:, 0] == 0).all() and np.abs(probs.sum(1) - 1).max() < 1e-12
    one = MD.train_boosted_trees(df.where("label = 1"), MD.TrainParams(gbt_rounds=2))
    assert [list(r.probs) for r in MD.predict(one, df).limit(3).collect()] == [[0.0, 1.0, 0.0]] * 3


# --- Shapley values ------------------------------------------------------------------


def _subset_value(tree, row, known):
    """A tree's output with the features not in ``known`` averaged by cover."""
    def at(n):
        f = tree["feature"][n]
        if f < 0:
            return tree["value"][n]
        left, right = tree["left"][n], tree["right"][n]
        if f in known:
            return at(left if row[f] <= tree["threshold"][n] else right)
        a, b = tree["cover"][left], tree["cover"][right]
        return (a * at(left) + b * at(right)) / (a + b)
    return tree["weight"] * at(0)


def _by_subsets(value, d):
    """Shapley values from a game's values of all 2**d coalitions."""
    phi = [0.0] * d
    for size in range(d):
        for s in itertools.combinations(range(d), size):
            w = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
            for i in set(range(d)) - set(s):
                phi[i] = phi[i] + w * (value(frozenset(s) | {i}) - value(frozenset(s)))
    return phi


def test_tree_shapley_equals_all_subsets(spark, prepared):
    """20 rows, 13 features: forest and boosted trees against the 2**13 coalitions."""
    _, test, stats = prepared
    rows = test.orderBy(*KEYS).limit(20)
    x = np.array([r.x for r in rows.select(vector_to_array("features").alias("x")).collect()])
    for fm in (FX.forest(spark, 13, 2), FX.boosted(spark, 13, 2)):
        ensemble = X.tree_ensemble(fm, 13)
        got = ensemble.values(x)
        lists = [TR.node_table(spark, m) for m in fm.model.margins] if fm.name == "boosted_trees" else [TR.node_table(spark, fm.model)]
        for r in range(0, 20, 7):
            memo: dict = {}

            def value(s, r=r, memo=memo):
                used = frozenset(f for f in s if any(f in t["feature"] for trees in lists for t in trees))
                if used not in memo:
                    memo[used] = ensemble.scale * np.concatenate([sum(_subset_value(t, x[r], used) for t in trees) for trees in lists])
                return memo[used]
            assert np.abs(np.array(_by_subsets(value, 13)) - got[r]).max() < 1e-9


@pytest.mark.parametrize("name", ["random_forest", "boosted_trees"])
def test_tree_shapley_sums_to_the_output(spark, prepared, name):
    train, test, stats = prepared
    fm = MD.TRAINERS[name](train, MD.TrainParams(rf_trees=12, gbt_rounds=6))
    c = X.tree_contributions(fm, test, 13)
    assert c.count() == 13 * test.count()
    sums = {(r.employee_id, r.quarter_label): (r.a, r.b, r.c) for r in c.groupBy(*KEYS).agg(F.sum("contrib_low").alias("a"), F.sum("contrib_medium").alias("b"), F.sum("contrib_high").alias("c")).collect()}
    mean = X.tree_ensemble(fm, 13).expected()
    if name == "random_forest":
        out = {(r.employee_id, r.quarter_label): r.probs for r in MD.predict(fm, test).collect()}
    else:
        scored = test
        for k, m in enumerate(fm.model.margins):
            scored = m.copy().setPredictionCol(f"m{k}").transform(scored)
        out = {(r.employee_id, r.quarter_label): (r.m0, r.m1, r.m2) for r in scored.collect()}
    assert max(np.abs(np.array(sums[k]) - (np.array(out[k]) - mean)).max() for k in out) < 1e-9


@pytest.fixture(scope="module")
def linear_game(spark, prepared):
    """Two rows, three background rows and the exact values of the fixed linear model's probabilities."""
    train, test, _ = prepared
    fm = FX.linear(spark, 13)
    rows, bg = test.orderBy(*KEYS).limit(2), X.background_sample(train, 3).cache()
    b, a = fm.model.coefficientMatrix.toArray(), fm.model.interceptVector.toArray()
    back = np.array([r.bg for r in bg.orderBy("_bi").collect()])
    exact = {}
    for r in rows.select(*KEYS, vector_to_array("features").alias("x")).collect():
        x, memo = np.array(r.x), {}
        members = np.array([[c >> j & 1 for j in range(13)] for c in range(1 << 13)], bool)
        p = np.mean([TR.softmax(np.where(members, x, z) @ b.T + a) for z in back], axis=0)
        size = members.sum(1)
        weight = np.array([math.factorial(s) * math.factorial(12 - s) / math.factorial(13) if s < 13 else 0.0 for s in size])
        phi = np.zeros((13, 3))
        for j in range(13):
            without = np.flatnonzero(~members[:, j])
            phi[j] = (weight[without, None] * (p[without | (1 << j)] - p[without])).sum(0)
        exact[r.employee_id, r.quarter_label] = phi
    return fm, rows, bg, exact


def _error(found, exact):
    return max(abs(r[c] - exact[r.employee_id, r.quarter_label][r.feature_index, k]) for r in found.collect() for k, c in enumerate(X.CONTRIBUTIONS))


def test_kernel_estimator(linear_game):
    """Exact with all coalitions; better with more of them; always adding up."""
    fm, rows, bg, exact = linear_game
    assert _error(X.kernel_contributions(fm, rows, bg, 13, n_coalitions=1 << 13), exact) < 1e-9
    errors = [_error(X.kernel_contributions(fm, rows, bg, 13, n_coalitions=n), exact) for n in (40, 200, 1500)]
    assert errors[2] < errors[1] < errors[0] and errors[2] < 0.01
    sums = {(r.employee_id, r.quarter_label): r.s for r in X.kernel_contributions(fm, rows, bg, 13, n_coalitions=40).groupBy(*KEYS).agg(F.sum("contrib_high").alias("s")).collect()}
    assert all(abs(sums[k] - phi[:, 2].sum()) < 1e-9 for k, phi in exact.items())


def test_coalitions():
    z, w = X.coalitions(5, 1 << 5)
    assert len(z) == 30 and abs(w[z.sum(1) == 1] - 4 / (5 * 4)).max() < 1e-12
    z, w = X.coalitions(13, 100)
    assert len(np.unique(z, axis=0)) == len(z) >= 100 and 0 < z.sum(1).min() and z.sum(1).max() < 13
    assert {tuple(r) for r in z} == {tuple(~r) for r in z} and X.coalitions(1, 10)[0].shape == (0, 1)


def test_sampled_shapley_is_near_the_exact_one(linear_game):
    fm, rows, bg, exact = linear_game
    assert _error(X.shapley_contributions(fm, rows, bg, 13, n_permutations=400), exact) < 0.03


def test_linear_margins(spark, prepared):
    train, test, _ = prepared
    fm = FX.linear(spark, 13)
    rows = test.limit(5)
    mean = [0.1 * j for j in range(13)]
    got = X.linear_contributions(fm, rows, mean).collect()
    x = {(r.employee_id, r.quarter_label): r.x for r in rows.select(*KEYS, vector_to_array("features").alias("x")).collect()}
    w = fm.model.coefficientMatrix.toArray()
    assert len(got) == 65
    assert all(abs(r[c] - w[k][r.feature_index] * (x[r.employee_id, r.quarter_label][r.feature_index] - mean[r.feature_index])) < 1e-12 for r in got for k, c in enumerate(X.CONTRIBUTIONS))


# --- permutations --------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997, 5000])
def test_permutations_are_bijections(spark, n):
    df = spark.range(n)
    for k in range(3):
        df = PM.permuted(df.withColumn("k", F.lit(k)), "id", n, ["k"], f"p{k}", seed=7)
    rows = df.collect()
    for k in range(3):
        assert sorted(r[f"p{k}"] for r in rows) == list(range(n))
    if n >= 997:
        fixed = [sum(r.id == r[f"p{k}"] for r in rows) for k in range(3)]
        assert max(fixed) < 12 and len({tuple(r[f"p{k}"] for r in rows) for k in range(3)}) == 3
        c = np.corrcoef([[r.id, r.p0, r.p1, r.p2] for r in rows], rowvar=False)
        assert np.abs(c - np.eye(4)).max() < 0.12


def test_permutations_are_uniform(spark):
    """Of five rows over 6000 keys, every row goes everywhere alike, and all 120 orders occur; of 40 rows every pair does."""
    def of(rows: int, keys: int, some) -> object:
        df = spark.range(keys).withColumnRenamed("id", "key")
        for i in some:
            df = PM.permuted(df.withColumn("i", F.lit(i)), "i", rows, ["key"], f"p{i}")
        return df
    df = of(5, 6000, range(5)).select(F.array(*[f"p{i}" for i in range(5)]).alias("p"))
    orders = {tuple(r.p): r["count"] for r in df.groupBy("p").count().collect()}
    assert len(orders) == 120 and sum(orders.values()) == 6000
    assert min(orders.values()) > 15 and max(orders.values()) < 120
    places = np.zeros((5, 5))
    for p, n in orders.items():
        for i, j in enumerate(p):
            places[i, j] += n
    assert np.abs(places - 1200).max() < 150
    pairs = np.zeros((40, 40))
    for r in of(40, 16_000, (3, 31)).collect():
        pairs[r.p3, r.p31] += 1
    off = pairs[~np.eye(40, dtype=bool)]
    assert np.diag(pairs).sum() == 0 and abs(((off - off.mean()) ** 2 / off.mean()).sum() / len(off) - 1) < 0.2


def test_donated_values_are_permutations(spark, prepared):
    _, test, _ = prepared
    rows, n, _ = X.donated(test, 13, n_repeats=2)
    got = rows.collect()
    assert n == test.count() == len(got) and sorted(r["rank"] for r in got) == list(range(n))
    assert all(sorted(v.k for v in r.got) == list(range(26)) for r in got)
    for k in (0, 9, 22):
        own, other = [r.x[k % 13] for r in got], [next(v.value for v in r.got if v.k == k) for r in got]
        assert sorted(own) == sorted(other) and own != other
    again = {r["rank"]: r.got for r in X.donated(test.repartition(9), 13, n_repeats=2)[0].collect()}
    assert all(sorted(again[r["rank"]]) == sorted(r.got) for r in got)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
