"""Importance and explanation.

* X1/X2 read the fitted model (a vector of 13 numbers per class).
* X3 permutation importance permutes each feature by a keyed bijection of row
  ranks: an equi-join on rank, no window.
* X4 has an exact form for each kind of model (tree ensembles: ``tree_shap``;
  linear margins: coefficient times difference) and two estimators for any
  model: sampled permutations and weighted least squares over coalitions. The
  variants of a row are arrays, scored by ``models.scorer`` and summed up
  inside the task.
* X6/X7 and W2/W3 are array expressions per row (no shuffle).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelsight.functions.scalars import decode_band, rnd
from panelsight.operators import metrics as M
from panelsight.operators import models as MD
from panelsight.operators import permute as PM
from panelsight.operators import tree_shap as TS
from panelsight.operators import trees as TR
from panelsight.operators.models import BoostedTreesModel, FittedModel, predict
from panelsight.session import remove

CONTRIBUTIONS = ["contrib_low", "contrib_medium", "contrib_high"]
TOP_DRIVERS = 3
TOP_GLOBAL = 12
VARIANTS = 16_384  # vectors that are scored at once


# --- X1 / X2 / W1 ---------------------------------------------------------------

def model_importance(fm: FittedModel, features: list[str]) -> list[float]:
    """X1/X2 as a Python list: impurity importance (forest), mean gain of a split as a share of all features' (boosted
    trees), or the mean |coefficient| over classes (linear)."""
    m = fm.model
    if isinstance(m, LogisticRegressionModel):
        cm = m.coefficientMatrix.toArray()
        return [float(sum(abs(cm[k][j]) for k in range(cm.shape[0])) / cm.shape[0]) for j in range(len(features))]
    if isinstance(m, BoostedTreesModel):
        total, count = [0.0] * len(features), [0] * len(features)
        for margin in m.margins:
            for tree in TR.node_table(_session(), margin):
                for f, gain, cover in zip(tree["feature"], tree["gain"], tree["cover"]):
                    if f >= 0:
                        total[f] += gain * cover
                        count[f] += 1
        means = [t / c if c else 0.0 for t, c in zip(total, count)]
        return [x / (sum(means) or 1.0) for x in means]
    return [float(x) for x in m.featureImportances.toArray()]


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def importance_table(spark, fm: FittedModel, features: list[str]) -> DataFrame:
    """X1/X2 as a DataFrame (feature, importance), descending, name tie-break."""
    imp = model_importance(fm, features)
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature")


def top_k_importance(imp: DataFrame, k: int = TOP_GLOBAL) -> DataFrame:
    """First k features by importance."""
    return imp.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


# --- X3 permutation importance ------------------------------------------------------

def permutation_importance(fm: FittedModel, test: DataFrame, features: list[str],
                           n_repeats: int = 10, seed: int = 42) -> DataFrame:
    """Drop in macro F1 when one feature's values are permuted across rows, by an own permutation for each
    (repeat, feature).

    Every row sends its value of each feature to the row of its image, once a
    repeat; a row collects what it gets and is joined with itself by rank. Its
    variants are built, scored and counted without another exchange of rows;
    those of a linear model as arrays.
    """
    rows, _, path = donated(test, len(features), n_repeats, seed)
    d, spark = len(features), test.sparkSession
    if isinstance(fm.model, LogisticRegressionModel):
        scored = _counted_variants(fm, rows, d, n_repeats)
    else:  # the JVM walks trees faster than arrays do
        mixed = F.transform("x", lambda v, i: F.when(i == F.col("f"), F.col("value")).otherwise(v))
        perm = (rows.select("label", "x", F.inline("got"))
                .select((F.col("k") % d).cast("int").alias("f"), F.floor(F.col("k") / d).cast("int").alias("r"), "label", "x", "value")
                .select("f", "r", "label", array_to_vector(mixed).alias("features")))
        scored = predict(fm, perm).withColumn("n", F.lit(1))
    f1 = M.macro_f1_by(scored, ["f", "r"], count_col="n")
    # baseline macro F1 of the unshuffled rows: one number, computed by Spark
    base_f1 = M.summary_metrics(predict(fm, test), digits=12).first()["f1_macro"]
    names = F.element_at(F.array(*[F.lit(x) for x in features]), F.col("f") + 1)
    found = (f1.withColumn("drop", F.lit(base_f1) - F.col("f1_macro"))
             .groupBy("f").agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"))
             .select(names.alias("feature"), "importance", "std").collect())  # a row for each feature
    remove(spark, path)
    return spark.createDataFrame(found, "feature string, importance double, std double").orderBy(F.col("importance").desc(), "feature")


def _counted_variants(fm: FittedModel, rows: DataFrame, d: int, n_repeats: int) -> DataFrame:
    """Of the variants of ``donated`` rows, how many have each (f, r, label, prediction), counted by task."""
    score, k, classes = MD.scorer(fm), d * n_repeats, MD.N_CLASSES

    def run(batches):
        counts = np.zeros(k * (classes + 1) * classes, np.int64)
        for b in batches:
            x, got = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d), b.column("got").flatten()
            label = b.column("label").to_numpy(zero_copy_only=False)
            value = np.empty((len(x), k))
            value[np.repeat(np.arange(len(x)), k), got.field("k").to_numpy()] = got.field("value").to_numpy(zero_copy_only=False)
            few = max(1, VARIANTS // k)
            for i in range(0, len(x), few):
                s = slice(i, i + few)
                variants = np.repeat(x[s, None, :], k, axis=1)
                variants[:, np.arange(k), np.arange(k) % d] = value[s]
                found = score(variants.reshape(-1, d)).argmax(1).reshape(-1, k)
                at = (np.arange(k) * (classes + 1) + label[s, None]) * classes + found
                counts += np.bincount(at.ravel(), minlength=len(counts))
        at = np.flatnonzero(counts)
        of, prediction = np.divmod(at, classes)
        number, own = np.divmod(of, classes + 1)
        yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int32)) for v in (number % d, number // d, own, prediction)] + [pa.array(counts[at])],
                                         ["f", "r", "label", "prediction", "n"])

    # a label outside the classes is none of them, as in the metrics
    label = F.when(F.col("label").cast("int").between(0, classes - 1), F.col("label").cast("int")).otherwise(classes).alias("label")
    return rows.select(label, "x", "got").mapInArrow(run, "f int, r int, label int, prediction int, n bigint")


def donated(test: DataFrame, n_features: int, n_repeats: int = 10, seed: int = 42) -> tuple[DataFrame, int, str]:
    """Rows as (rank, label, x, got: array of (k, value)), k = repeat * features + feature and ``value`` that feature of
    another row by the permutation of k; the number of rows; the folder of the ranked copy.

    The hashed order is of the rows' contents, so that it doesn't depend on
    their partitions; equal rows are interchangeable.
    """
    base = test.select(F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x"))
    ranked, n, path = PM.with_ranks(base, [F.xxhash64("x", "label", F.lit(seed)), F.col("label"), F.col("x")])
    every = F.explode(F.sequence(F.lit(0), F.lit(n_repeats * n_features - 1)))
    own = ranked.select("rank", "x", every.alias("k")).select("rank", "k", F.element_at("x", (F.col("k") % n_features + 1).cast("int")).alias("value"))
    sent = PM.permuted(own, "rank", n, ["k"], "to", seed).select("k", "to", "value")
    got = sent.groupBy("to").agg(F.collect_list(F.struct("k", "value")).alias("got"))
    return ranked.join(got, F.col("rank") == F.col("to")).drop("to"), n, path


# --- X4 / X5 sampling Shapley ---------------------------------------------------------

def background_sample(train: DataFrame, n_background: int = 100, seed: int = 42,
                      keys: list[str] = ("employee_id", "quarter_label")) -> DataFrame:
    """The ``n_background`` training rows with the smallest key hash (a
    bounded top-k: TakeOrderedAndProject keeps k rows per task)."""
    keys = list(keys)
    return (train.select(vector_to_array("features").alias("bg"), F.xxhash64(*keys, F.lit(seed)).alias("_h"))
            .orderBy("_h").limit(n_background)
            .select(F.row_number().over(Window.orderBy("_h")).alias("_bi"), "bg")
            .select((F.col("_bi") - 1).alias("_bi"), "bg"))


def shapley_contributions(fm: FittedModel, rows: DataFrame, background: DataFrame, n_features: int,
                          keys: list[str] = ("employee_id", "quarter_label"),
                          n_permutations: int = 10, seed: int = 42) -> DataFrame:
    """Monte-Carlo Shapley values (permutation sampling, Strumbelj &
    Kononenko) for every row and every class.

    For each row and permutation p a background row is drawn; along the
    permutation the features switch one at a time from background to row
    values. The d + 1 vectors on the way are scored once each, inside the task
    that has the row; only a row's sums over its permutations are shuffled, by
    key. Per permutation the contributions telescope to f(x) - f(background),
    so the average is additive. Rows that repeat a key draw their permutations
    by their contents and share one average.
    """
    keys, d = list(keys), n_features
    points = _background(background)
    score = MD.scorer(fm)
    base = rows.select(*keys, vector_to_array("features").alias("x")).withColumn("_rid", F.xxhash64(*keys, "x"))
    every = F.sequence(F.lit(0), F.lit(n_permutations * d - 1))
    # a permutation's features by their hashes, permutation after permutation
    base = (base.withColumn("h", F.transform(every, lambda i: F.xxhash64("_rid", F.floor(i / d).cast("int"), i % d, F.lit(seed))))
            .withColumn("b", F.transform(F.sequence(F.lit(0), F.lit(n_permutations - 1)),
                                         lambda p: F.pmod(F.xxhash64("_rid", p, F.lit(seed + 1)), F.lit(len(points))))).drop("_rid"))
    sums = [f"s{j}_{c}" for j in range(d) for c in range(len(CONTRIBUTIONS))]

    def run(batches):
        for b in batches:
            x, h, drawn = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("x", "h", "b"))
            x, h, drawn = x.reshape(-1, d), h.reshape(-1, n_permutations, d), drawn.reshape(-1, n_permutations)
            found = np.empty((len(x), d, len(CONTRIBUTIONS)))
            few = max(1, VARIANTS // (n_permutations * (d + 1)))
            for i in range(0, len(x), few):
                s = slice(i, i + few)
                place = np.argsort(np.argsort(h[s], axis=-1, kind="stable"), axis=-1, kind="stable")  # of a feature in the permutation
                from_row = place[:, :, None, :] < np.arange(d + 1)[:, None]
                hybrid = np.where(from_row, x[s][:, None, None, :], points[drawn[s]][:, :, None, :])
                step = np.diff(score(hybrid.reshape(-1, d)).reshape(*hybrid.shape[:3], -1), axis=2)
                found[s] = np.take_along_axis(step, place[..., None], axis=2).sum(1)
            flat = found.reshape(len(x), -1)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keys], *[pa.array(flat[:, i]) for i in range(len(sums))]], [*keys, *sums])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name in keys] + [f"{c} double" for c in sums])
    per_row = base.select(*keys, "x", "h", "b").mapInArrow(run, schema)
    total = F.count(F.lit(1)) * n_permutations
    means = per_row.groupBy(*keys).agg(*[(F.sum(c) / total).alias(c) for c in sums])
    per_feature = F.array(*[F.struct(F.lit(j).alias("feature_index"), *[F.col(f"s{j}_{c}").alias(name) for c, name in enumerate(CONTRIBUTIONS)]) for j in range(d)])
    return means.select(*keys, F.inline(per_feature))


def _background(background: DataFrame) -> np.ndarray:
    """The rows of a ``background_sample`` by their numbers."""
    rows = background.select("_bi", "bg").collect()  # as many as were asked for
    return np.array([r["bg"] for r in sorted(rows, key=lambda r: r["_bi"])], np.float64)


def linear_contributions(fm: FittedModel, rows: DataFrame, background: list[float], keys: list[str] = ("employee_id", "quarter_label")) -> DataFrame:
    """X4 of a linear model's margins, exact: coefficient times the difference to the background's mean."""
    w = fm.model.coefficientMatrix.toArray()
    x, mean = vector_to_array("features"), F.array(*[F.lit(float(v)) for v in background])
    off = F.zip_with(x, mean, lambda a, b: a - b)
    per = [F.zip_with(off, F.array(*[F.lit(float(v)) for v in row]), lambda a, b: a * b) for row in w]
    both = F.arrays_zip(*[p.alias(c) for p, c in zip(per, CONTRIBUTIONS)])
    return rows.select(*list(keys), F.posexplode(both).alias("feature_index", "c")).select(
        *list(keys), F.col("feature_index").cast("int").alias("feature_index"), *[F.col("c")[c].alias(c) for c in CONTRIBUTIONS])


def coalitions(n_features: int, count: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(members, weights) of coalitions other than the empty and the full one: all of them if ``count`` allows, else
    drawn by the kernel's weight of their size, each with its complement."""
    d = n_features
    if d < 2:
        return np.zeros((0, d), bool), np.zeros(0)
    if count >= (1 << d) - 2:
        z = np.array([[c >> j & 1 for j in range(d)] for c in range(1, (1 << d) - 1)], bool)
        size = z.sum(1)
        return z, np.array([(d - 1) / (math.comb(d, s) * s * (d - s)) for s in size])
    rng = np.random.default_rng(seed)
    sizes = np.arange(1, d)
    p = 1.0 / (sizes * (d - sizes))
    found: dict[bytes, float] = {}
    while len(found) < count:
        z = np.zeros(d, bool)
        z[rng.permutation(d)[: rng.choice(sizes, p=p / p.sum())]] = True
        for one in (z, ~z):
            found[one.tobytes()] = found.get(one.tobytes(), 0.0) + 1.0
    return np.array([np.frombuffer(b, bool) for b in found]), np.array(list(found.values()))


def kernel_operator(z: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted least squares with the sum fixed, solved once for all rows: contributions are ``per @ v + full * v_full +
    empty * v_empty`` for the values v of the coalitions."""
    d = z.shape[1]
    x = z.astype(float)
    inverse = np.linalg.pinv(x.T @ (w[:, None] * x))
    u = inverse.sum(1) / inverse.sum()
    per = (np.eye(d) - np.outer(u, np.ones(d))) @ inverse @ (x * w[:, None]).T
    return per, u, -u - per.sum(1)


def kernel_contributions(fm: FittedModel, rows: DataFrame, background: DataFrame, n_features: int, keys: list[str] = ("employee_id", "quarter_label"),
                         n_coalitions: int = 256, seed: int = 42) -> DataFrame:
    """X4 by weighted least squares over coalitions, for any model.

    A coalition's value is the mean prediction over ``background`` with the
    coalition's features taken from the row. All rows share the coalitions, so
    the normal equations are solved once, and a row's contributions are sums of
    its predictions times given numbers. A row's variants are made and scored
    in the task that has the row, a piece at a time; nothing is shuffled.
    """
    d, points, score = n_features, _background(background), MD.scorer(fm)
    z, w = coalitions(d, n_coalitions, seed)
    per, full, empty = kernel_operator(z, w)
    member = np.concatenate([z, np.ones((1, d), bool), np.zeros((1, d), bool)])
    k = np.concatenate([per, full[:, None], empty[:, None]], axis=1)

    def values(x):
        found = np.empty((len(x), d, len(CONTRIBUTIONS)))
        few = max(1, VARIANTS // (len(member) * len(points)))
        for i in range(0, len(x), few):
            hybrid = np.where(member[:, None, :], x[i : i + few, None, None, :], points)
            value = score(hybrid.reshape(-1, d)).reshape(*hybrid.shape[:3], -1).mean(2)
            found[i : i + few] = k @ value
        return found

    return TS.explained(rows, values, d, CONTRIBUTIONS, list(keys))


def shapley_global(contribs: DataFrame, features: list[str], class_col: str = "contrib_high",
                   k: int = TOP_GLOBAL) -> DataFrame:
    """Mean |contribution| per feature for one class, top k."""
    names = F.element_at(F.array(*[F.lit(x) for x in features]), F.col("feature_index") + 1)
    return (contribs.groupBy("feature_index").agg(F.avg(F.abs(class_col)).alias("mean_abs"))
            .select(names.alias("feature"), "mean_abs")
            .orderBy(F.col("mean_abs").desc(), "feature").limit(k))


# --- X6 / X7 / X8 / W2 / W3 ---------------------------------------------------------------

def local_contributions(x: Column, weights: list, class_index: Column | None = None) -> Column:
    """Per-feature contribution array. ``weights`` is either one vector
    (importance x value, class independent) or one vector per class
    (coefficient[class] x value)."""
    if weights and isinstance(weights[0], (list, tuple)):
        mat = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in weights])
        w = F.element_at(mat, class_index + 1)
    else:
        w = F.array(*[F.lit(float(v)) for v in weights])
    return F.zip_with(w, x, lambda a, b: a * b)


def model_contributions(fm: FittedModel, class_index: Column, features_col: str = "features") -> Column:
    """X6 by the fitted model: coefficients of the predicted class (linear) or importances (trees) times the values."""
    x = vector_to_array(features_col)
    if isinstance(fm.model, LogisticRegressionModel):
        return local_contributions(x, fm.model.coefficientMatrix.toArray().tolist(), class_index)
    return local_contributions(x, model_importance(fm, [""] * fm.model.numFeatures))


def tree_contributions(fm: FittedModel, rows: DataFrame, n_features: int, keys: list[str] = ("employee_id", "quarter_label")) -> DataFrame:
    """X4, exact: Shapley values of a forest's probabilities or of boosted trees' margins, for all rows, features and classes.

    They sum to the model's output less ``tree_expected``. A class that is absent from training has 0.
    """
    ensemble = tree_ensemble(fm, n_features)
    names = CONTRIBUTIONS
    keys = list(keys)
    if not isinstance(fm.model, BoostedTreesModel):
        return TS.contributions(ensemble, rows, names, keys)
    found = TS.contributions(ensemble, rows, [names[c] for c in fm.classes], keys)
    return found.select(*keys, "feature_index", *[F.col(c) if i in fm.classes else F.lit(0.0).alias(c) for i, c in enumerate(names)])


def tree_ensemble(fm: FittedModel, n_features: int) -> TS.Ensemble:
    spark = _session()
    if isinstance(fm.model, BoostedTreesModel):
        return TS.Ensemble([TR.node_table(spark, m) for m in fm.model.margins], n_features)
    return TS.Ensemble([TR.node_table(spark, fm.model)], n_features, mean=True)


def _ranked(contrib: Column) -> Column:
    """Contributions as (neg value, index) structs sorted => descending value,
    lower feature index first on ties."""
    idx = F.sequence(F.lit(0), F.size(contrib) - 1)
    return F.array_sort(F.zip_with(contrib, idx, lambda c, i: F.struct((-c).alias("nc"), i.alias("i"))))


def top_positive(contrib: Column, k: int = TOP_DRIVERS) -> Column:
    """Indices of the k largest positive contributions, descending."""
    pos = F.filter(_ranked(contrib), lambda s: s["nc"] < 0)
    return F.transform(F.slice(pos, 1, k), lambda s: s["i"])


def top_negative(contrib: Column, k: int = TOP_DRIVERS) -> Column:
    """The last k of the negative contributions in descending order
    (i.e. the k most negative, most negative last)."""
    neg = F.filter(_ranked(contrib), lambda s: s["nc"] > 0)
    start = F.greatest(F.lit(1), F.size(neg) - (k - 1))
    return F.transform(F.slice(neg, start, k), lambda s: s["i"])


def feature_message(feature: Column, positive: bool) -> Column:
    """Code of a driver: the direction and the feature. Any feature has one."""
    return F.concat(F.lit("raises:" if positive else "lowers:"), feature)


def explain_rows(df: DataFrame, features: list[str], contrib_col: str, raw_cols: list[str],
                 probs_col: str | None = "probs", pred_col: str = "prediction") -> DataFrame:
    """Per row the predicted band, the probability map, the top-3 strength
    and concern codes (with the raw value) and a one-line summary."""
    names = F.array(*[F.lit(f) for f in features])
    raw = F.array(*[F.col(c).cast("string") for c in raw_cols])

    def msgs(idx: Column, positive: bool) -> Column:
        return F.transform(idx, lambda i: F.concat(
            feature_message(F.element_at(names, i + 1), positive), F.lit("="),
            F.coalesce(F.element_at(raw, i + 1), F.lit("?"))))

    out = df.withColumns({
        "strengths_arr": msgs(top_positive(F.col(contrib_col)), True),
        "concerns_arr": msgs(top_negative(F.col(contrib_col)), False),
        "predicted_band": decode_band(pred_col),
    })
    if probs_col:
        out = out.withColumn("probabilities", F.map_from_arrays(
            F.array(F.lit("Low"), F.lit("Medium"), F.lit("High")),
            F.transform(probs_col, lambda p: rnd(p, 3))))
        conf = F.format_string("confidence=%.1f", F.bround(F.array_max(probs_col) * 100, 1))
    else:
        conf = F.lit(None).cast("string")
    some = lambda c: F.when(F.size(c) > 0, F.array_join(c, ", "))
    summary = F.concat_ws("; ", F.concat(F.lit("band="), F.col("predicted_band")), conf, some("strengths_arr"), some("concerns_arr"))
    return out.withColumn("summary", summary)
