"""Exact Shapley values of tree ensembles (X4 for M2 and M3), weighted by node cover.

A leaf is a game on the features of its path: a feature of the row either
passes its interval (1) or not (0), and is passed by the share z of the
training cover when it is unknown. The Shapley value of feature i for a leaf
of value v is

    v (o_i - z_i) * integral over t in [0, 1] of prod_{j != i} (z_j (1 - t) + o_j t),

because the integral of t^a (1 - t)^b gives a coalition's weight. The
integrand is a polynomial of a degree below the number of features on the
path, so a Gauss-Legendre rule of half as many points is exact.

A leaf knows of a row only which features pass, a number of as many bits as
its path has features. The parts of all these numbers are computed once for a
tree and task; a row looks its own up. Scoring is one narrow pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 4096  # of a block
TASK_ROWS = 32_768  # that share a tree's tables
TABLES = 1 << 21  # numbers in a tree's tables; beyond, rows are computed one by one


def parts(share: np.ndarray, passes: np.ndarray) -> np.ndarray:
    """(..., features, rows) parts of a leaf of value 1, for shares (..., features) and what passes (features, rows)."""
    points, weights = np.polynomial.legendre.leggauss(max(1, -(-passes.shape[-2] // 2)))
    z, o = share[..., None], passes.astype(np.float64)
    total = 0.0
    for t, w in zip((points + 1) / 2, weights / 2):
        factor = z * (1 - t) + o * t  # never 0: shares are positive and t < 1
        total = total + w * factor.prod(-2, keepdims=True) / factor
    return (o - z) * total


def bits(numbers: np.ndarray, width: int) -> np.ndarray:
    """(width, numbers): which bits are set."""
    return (numbers[None, :] >> np.arange(width)[:, None]) & 1


class Leaves:
    """The leaves of one tree: features of their paths, each with the share of the training cover that passes."""

    def __init__(self, tree: dict, n_features: int):
        self.steps = []  # node, feature, cut, and for both children: node, bit of the feature, whether it is new on the path
        self.leaves, self.features, self.shares = [], [], []
        stack = [(0, {})]
        while stack:
            node, path = stack.pop()
            f = int(tree["feature"][node])
            if f < 0:
                self.leaves.append(node)
                self.features.append(np.array(list(path), np.int64))
                self.shares.append(np.array(list(path.values()), np.float64))
                continue
            cover, two = tree["cover"][node], (int(tree["left"][node]), int(tree["right"][node]))
            self.steps.append((node, f, float(tree["threshold"][node]), two, list(path).index(f) if f in path else len(path), f not in path))
            for child in two:
                part = tree["cover"][child] / cover if cover > 0 else 0.5
                stack.append((child, {**path, f: path.get(f, 1.0) * max(part, 1e-12)}))
        self.width = max(len(f) for f in self.features)
        self.value = tree["weight"] * np.array([tree["value"][node] for node in self.leaves])  # leaves x outputs
        self.expected = np.array([s.prod() for s in self.shares]) @ self.value

    def passed(self, x: np.ndarray) -> list[np.ndarray]:
        """For each leaf the numbers of the rows of ``x`` (features, rows): bit j is set if the j-th feature of its path passes."""
        code = {0: np.zeros(x.shape[1], np.min_scalar_type((1 << self.width) - 1))}
        kind = code[0].dtype
        for node, f, cut, two, bit, new in self.steps:
            before = code.pop(node)
            for child, goes in zip(two, (x[f] <= cut, x[f] > cut)):
                at = goes.astype(kind) << kind.type(bit)
                code[child] = before | at if new else before & (at | kind.type(((1 << self.width) - 1) ^ (1 << bit)))
        return [code[leaf].astype(np.intp) for leaf in self.leaves]

    def tables(self) -> list[np.ndarray] | None:
        """For each leaf (features, numbers) parts of all numbers; none if they are too many."""
        widths = [len(s) for s in self.shares]
        if sum(w << w for w in widths) > TABLES:
            return None
        found: list = [None] * len(widths)
        for w in set(widths):
            mine = [i for i, k in enumerate(widths) if k == w]
            if w:
                for i, t in zip(mine, parts(np.stack([self.shares[i] for i in mine]), bits(np.arange(1 << w), w))):
                    found[i] = t
        return found

    def add(self, x: np.ndarray, tables: list[np.ndarray] | None, out: np.ndarray) -> None:
        """Add the Shapley values of the rows of ``x`` (features, rows) to ``out`` (features, outputs, rows)."""
        passed = self.passed(x)
        if tables is None:
            for value, features, share, p in zip(self.value, self.features, self.shares, passed):
                for f, part in zip(features, parts(share, bits(p, len(share)))):
                    out[f] += value[:, None] * part
            return
        by: dict[int, list] = {}
        for i, features in enumerate(self.features):
            for j, f in enumerate(features):
                by.setdefault(int(f), []).append((i, j))
        for f, pairs in by.items():
            looked = np.empty((len(pairs), x.shape[1]))
            for at, (i, j) in enumerate(pairs):
                tables[i][j].take(passed[i], out=looked[at], mode="clip")
            out[f] += self.value[[i for i, _ in pairs]].T @ looked


class Ensemble:
    """Tree lists (one for all outputs together, or one for each output) as leaves."""

    def __init__(self, per_output: list[list[dict]], n_features: int, mean: bool = False):
        self.n_features = n_features
        self.trees = [[Leaves(t, n_features) for t in trees] for trees in per_output]
        self.scale = 1.0 / sum(t["weight"] for t in per_output[0]) if mean else 1.0

    def expected(self) -> np.ndarray:
        """The ensemble's mean output over the training cover."""
        return self.scale * np.concatenate([sum(t.expected for t in trees) for trees in self.trees])

    def values(self, x: np.ndarray) -> np.ndarray:
        """(rows, features, outputs) Shapley values."""
        x, found = np.ascontiguousarray(x.T), []
        for trees in self.trees:
            out = np.zeros((self.n_features, trees[0].value.shape[1], x.shape[1]))
            for tree in trees:
                tables = tree.tables()
                for i in range(0, x.shape[1], ROWS):
                    tree.add(x[:, i : i + ROWS], tables, out[:, :, i : i + ROWS])
            found.append(out)
        return self.scale * np.concatenate(found, 1).transpose(2, 0, 1)


def explained(rows: DataFrame, values, n_features: int, outputs: list[str], keys: list[str]) -> DataFrame:
    """keys, feature_index and a contribution for each of ``outputs``, for all features of all ``rows(keys, features)``.

    ``values`` gives of (rows, features) the contributions (rows, features, outputs); it takes the rows of a task in large pieces.
    """
    d = n_features

    def run(batches):
        for b in _joined(batches, TASK_ROWS):
            x = b.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            v = values(x)
            index = pa.array(np.tile(np.arange(d, dtype=np.int32), len(x)))
            own = b.select(keys).take(pa.array(np.repeat(np.arange(len(x)), d)))
            full = pa.Table.from_arrays([*own.columns, index, *[pa.array(v[:, :, o].ravel()) for o in range(len(outputs))]], [*keys, "feature_index", *outputs])
            yield from full.combine_chunks().to_batches(TASK_ROWS)

    frame = rows.select(*keys, vector_to_array("features").alias("x"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "x"] + ["feature_index int"] + [f"{o} double" for o in outputs])
    return frame.mapInArrow(run, schema)


def _joined(batches, most: int):
    """Arrow batches as tables of about ``most`` rows."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def contributions(ensemble: Ensemble, rows: DataFrame, outputs: list[str], keys: list[str]) -> DataFrame:
    """``explained`` by the exact Shapley values of the ensemble."""
    shared = rows.sparkSession.sparkContext.broadcast(ensemble)  # as large as the model
    return explained(rows, lambda x: shared.value.values(x), ensemble.n_features, outputs, keys)
