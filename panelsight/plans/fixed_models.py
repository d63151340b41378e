"""Models of given numbers in the library's own model classes, so that SQL can compute what the queries compute.

They are checks of scoring, comparison, explanation and export, not models of
anything; training never uses them.
"""

from __future__ import annotations

from panelsight.operators.models import N_CLASSES, BoostedTreesModel, FittedModel, linear_model
from panelsight.operators.trees import Tree, as_spark_model


def coefficients(n_features: int) -> tuple[list[list[float]], list[float]]:
    """Coefficients and intercepts of the linear model, by a rule."""
    return ([[((13 * k + 7 * j) % 11 - 5) / 10 for j in range(n_features)] for k in range(N_CLASSES)],
            [(k - 1) / 10 for k in range(N_CLASSES)])


def stumps(n_features: int, trees: int, salt: int) -> list[list[dict]]:
    """Trees of two levels by a rule: inner nodes (feature, threshold, cover, gain) in level order and four leaves."""
    out = []
    for t in range(trees):
        nodes = []
        for i in range(3):
            nodes.append({"feature": (5 * t + 3 * i + salt) % n_features, "threshold": ((7 * t + 4 * i + salt) % 13 - 6) / 8,
                          "cover": [64.0, 40.0, 24.0][i], "gain": float(1 + (t + 2 * i + salt) % 5)})
        leaves = []
        for q in range(4):  # three numbers that add up to 16: shares are exact doubles, ties are ties everywhere
            a, b = 1 + (3 * t + 5 * q + salt) % 9, 1 + (5 * t + 2 * q + salt) % 6
            three = [float(a), float(b), float(16 - a - b)]
            leaves.append(three[q % 3 :] + three[: q % 3])
        out.append({"nodes": nodes, "leaves": leaves, "covers": [25.0, 15.0, 16.0, 8.0]})
    return out


def _tree(spec: dict, value) -> Tree:
    tree = Tree.root()
    for i, node in enumerate(spec["nodes"]):
        tree.cover[i] = node["cover"]
        tree.split(i, node["feature"], 0, node["threshold"], node["gain"])
    for i in range(3):
        tree.value[i] = value([sum(x) for x in zip(*spec["leaves"])])
        tree.cover[i] = spec["nodes"][i]["cover"]
    for q, leaf in enumerate(spec["leaves"]):
        tree.value[3 + q], tree.cover[3 + q], tree.rows[3 + q] = value(leaf), spec["covers"][q], int(spec["covers"][q])
    return tree


def linear(spark, n_features: int) -> FittedModel:
    return linear_model(spark, *coefficients(n_features))


def forest(spark, n_features: int, trees: int = 5) -> FittedModel:
    """A forest whose leaves vote with the shares of their values."""
    made = []
    for spec in stumps(n_features, trees, 1):
        tree = _tree(spec, lambda v: v)
        for q, cover in enumerate(spec["covers"]):  # class weights that add up to the cover, in inner nodes too
            tree.value[3 + q] = [x * cover / sum(spec["leaves"][q]) for x in spec["leaves"][q]]
        for i in (2, 1, 0):
            tree.value[i] = [a + b for a, b in zip(tree.value[tree.left[i]], tree.value[tree.right[i]])]
        made.append(tree)
    return FittedModel("random_forest", as_spark_model(spark, made, n_features, N_CLASSES), list(range(N_CLASSES)))


def boosted(spark, n_features: int, trees: int = 4, step: float = 0.25) -> FittedModel:
    """Boosted trees: class k takes the k-th of each leaf's values, less 5."""
    specs = stumps(n_features, trees, 2)
    margins = [as_spark_model(spark, [_tree(s, lambda v, k=k: v[k] - 5.0) for s in specs], n_features, step=step) for k in range(N_CLASSES)]
    return FittedModel("boosted_trees", BoostedTreesModel(margins, n_features), list(range(N_CLASSES)))
