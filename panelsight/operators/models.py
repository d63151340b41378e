"""Model training, scoring and comparison.

The linear model is fitted by Spark ML; forest and boosted trees by the
histogram learners of ``operators.trees``, which give Spark's own model
classes, so that scoring is Spark's for all three.

Labels are fixed 0/1/2. A class absent from the training period has
probability 0; the rest is renormalised.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelsight.functions.scalars import argmax_class, confidence_pct, decode_band
from panelsight.operators import metrics as M
from panelsight.operators import trees as TR
from panelsight.schema import BANDS

N_CLASSES = len(BANDS)
LABEL_META = {"ml_attr": {"type": "nominal", "name": "label",
                          "vals": [str(i) for i in range(N_CLASSES)]}}
MODEL_ORDER = ["logistic_regression", "random_forest", "boosted_trees"]


@dataclass
class TrainParams:
    """Hyper-parameters (defaults mirror the reproduced models)."""
    lr_c: float = 1.0
    lr_max_iter: int = 1000
    lr_tol: float = 1e-4          # same tolerance default as the original solver
    rf_trees: int = 300
    rf_depth: int = 8
    rf_min_leaf: int = 10
    rf_bins: int = 64
    gbt_rounds: int = 300
    gbt_depth: int = 6
    gbt_step: float = 0.05
    gbt_subsample: float = 0.8
    gbt_columns: float = 0.8
    gbt_bins: int = 256
    gbt_weighted: bool = False
    seed: int = 42


@dataclass
class FittedModel:
    name: str
    model: object
    classes: list = field(default_factory=list)   # classes present in training

    def transform(self, df: DataFrame) -> DataFrame:
        return predict(self, df)


def with_label_meta(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.withColumn(label_col, F.col(label_col).cast("double").alias(label_col, metadata=LABEL_META))


ROWS_PER_PARTITION = 50_000


def training_partitions(n: int) -> int:
    """Partitions of the linear fit over ``n`` rows; they bear on the rounding of its sums alone."""
    return max(1, -(-n // ROWS_PER_PARTITION))


def class_counts(train: DataFrame) -> dict[int, int]:
    """Rows of each class that occurs, at most N_CLASSES."""
    return {int(r["label"]): r["count"] for r in train.groupBy("label").count().orderBy("label").collect()}


def balanced(counts: dict[int, int]) -> dict[int, float]:
    """A18 as numbers: n / (classes * rows of the class)."""
    n = sum(counts.values())
    return {c: n / (len(counts) * k) for c, k in counts.items()}


def training_frame(train: DataFrame, weights: dict[int, float], n: int) -> DataFrame:
    """The columns the linear fit reads, in a compact cached frame that the caller releases.

    Rows are dealt by a hash of their contents and sorted within partitions:
    equal inputs give equal sums on any number of cores.
    """
    weight = F.lit(None).cast("double")
    for c, w in weights.items():
        weight = F.when(F.col("label") == c, w).otherwise(weight)
    contents = vector_to_array("features")
    t = train.select("features", "label", weight.alias("weight"))
    t = t.repartition(training_partitions(n), F.xxhash64(contents, "label")).sortWithinPartitions(contents, "label")
    return with_label_meta(t).cache()


def train_logreg(train: DataFrame, p: TrainParams = TrainParams()) -> FittedModel:
    """M1: multinomial LR with balanced class weights.

    The weighted log-loss objective C*sum(w*loss) + ||b||^2/2 equals Spark's
    sum(w*loss)/sum(w) + regParam*||b||^2/2 with regParam = 1/(C*sum(w)); the
    balanced weights sum to n.
    """
    counts = class_counts(train)
    n = sum(counts.values())
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", family="multinomial",
                            maxIter=p.lr_max_iter, regParam=1.0 / (p.lr_c * n), elasticNetParam=0.0, standardization=False, tol=p.lr_tol)
    t = training_frame(train, balanced(counts), n)
    try:
        return FittedModel("logistic_regression", lr.fit(t), sorted(counts))
    finally:
        t.unpersist()


def _n_features(train: DataFrame) -> int:
    """From the vector's metadata, where the assembler leaves it."""
    attributes = train.schema["features"].metadata.get("ml_attr", {})
    return attributes.get("num_attrs") or train.select(F.size(vector_to_array("features"))).first()[0]


def train_random_forest(train: DataFrame, p: TrainParams = TrainParams()) -> FittedModel:
    """M2: random forest, balanced class weights, root of the features per node."""
    counts, d = class_counts(train), _n_features(train)
    params = TR.ForestParams(trees=p.rf_trees, depth=p.rf_depth, least_rows=p.rf_min_leaf, bins=p.rf_bins, seed=p.seed)
    trees = TR.forest(train, d, N_CLASSES, balanced(counts), params)
    return FittedModel("random_forest", TR.as_spark_model(train.sparkSession, trees, d, N_CLASSES), sorted(counts))


class BoostedTreesModel:
    """Margins by class, each one of Spark's tree ensembles; probabilities are their softmax."""

    def __init__(self, margins: list, n_features: int):
        self.margins, self.numFeatures = margins, n_features

    def transform(self, df: DataFrame, classes: list[int], out: str) -> DataFrame:
        """``df`` with ``out``: probabilities of all N_CLASSES, 0 for those not in ``classes``."""
        scored = df
        for c, m in zip(classes, self.margins):
            scored = m.copy().setPredictionCol(f"_m{c}").transform(scored)
        # a projection of its own between margins and softmax: each ensemble is walked once
        scored = scored.withColumn("_top", F.greatest(*[F.col(f"_m{c}") for c in classes]) if len(classes) > 1 else F.col(f"_m{classes[0]}"))
        e = [F.exp(F.col(f"_m{c}") - F.col("_top")) if c in classes else F.lit(0.0) for c in range(N_CLASSES)]
        scored = scored.withColumn("_e", F.array(*e))
        total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
        scored = scored.withColumn(out, F.transform("_e", lambda x: x / total))
        return scored.drop("_top", "_e", *[f"_m{c}" for c in classes])

    def save(self, path: str) -> None:
        for i, m in enumerate(self.margins):
            m.write().overwrite().save(f"{path}/margin-{i}")

    @classmethod
    def load(cls, path: str, count: int) -> "BoostedTreesModel":
        from pyspark.ml.regression import GBTRegressionModel
        margins = [GBTRegressionModel.load(f"{path}/margin-{i}") for i in range(count)]
        return cls(margins, margins[0].numFeatures)


def train_boosted_trees(train: DataFrame, p: TrainParams = TrainParams()) -> FittedModel:
    """M3: multi-class boosting with second-order steps, rows drawn per round and columns per tree."""
    counts, d = class_counts(train), _n_features(train)
    classes = sorted(counts)
    params = TR.BoostParams(rounds=p.gbt_rounds, depth=p.gbt_depth, step=p.gbt_step, rows=p.gbt_subsample, columns=p.gbt_columns, bins=p.gbt_bins, seed=p.seed)
    rounds = TR.boost(train, d, classes, params, balanced(counts) if p.gbt_weighted else None)
    margins = [TR.as_spark_model(train.sparkSession, [r[k] for r in rounds], d, step=p.gbt_step) for k in range(len(classes))]
    return FittedModel("boosted_trees", BoostedTreesModel(margins, d), classes)


def linear_model(spark, coefficients: list[list[float]], intercepts: list[float]) -> FittedModel:
    """A multinomial linear model of given coefficients (a row for each class) as Spark's own model."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway

    def doubles(values):
        out = gateway.new_array(jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    rows, cols = len(coefficients), len(coefficients[0])
    linalg = jvm.org.apache.spark.ml.linalg
    matrix = linalg.DenseMatrix(rows, cols, doubles([coefficients[k][j] for j in range(cols) for k in range(rows)]))
    made = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "given", matrix, linalg.DenseVector(doubles(intercepts)), rows, True)
    model = LogisticRegressionModel(made)
    model._resetUid("given")
    model.setFeaturesCol("features")
    return FittedModel("logistic_regression", model, list(range(rows)))


TRAINERS = {"logistic_regression": train_logreg, "random_forest": train_random_forest,
            "boosted_trees": train_boosted_trees}


def _raw_probs(fm: FittedModel, df: DataFrame) -> DataFrame:
    """Adds ``_probs`` (ARRAY<DOUBLE>, one entry per class) before masking."""
    if isinstance(fm.model, BoostedTreesModel):
        return fm.model.transform(df, fm.classes, "_probs")
    mm = fm.model.copy()
    mm.setProbabilityCol("_prob_vec").setRawPredictionCol("_raw_vec").setPredictionCol("_pred_raw")
    out = mm.transform(df)
    return out.withColumn("_probs", vector_to_array("_prob_vec")).drop("_prob_vec", "_raw_vec", "_pred_raw")


def predict(fm: FittedModel, df: DataFrame) -> DataFrame:
    """M4 + P11-P13: ``probs`` (3 entries, absent classes 0, sums to 1),
    ``prediction`` (argmax, first wins), ``predicted_band``, ``confidence``,
    ``confidence_pct``. One narrow projection after ``model.transform``."""
    out = _raw_probs(fm, df)
    present = set(fm.classes)
    mask = F.array(*[F.lit(1.0 if i in present else 0.0) for i in range(N_CLASSES)])
    masked = F.zip_with(F.col("_probs"), mask, lambda a, b: a * b)
    out = out.withColumn("_masked", masked)
    total = F.aggregate("_masked", F.lit(0.0), lambda acc, x: acc + x)
    out = out.withColumn("probs", F.transform("_masked", lambda x: F.when(total > 0, x / total).otherwise(x)))
    return (out.drop("_probs", "_masked")
            .withColumn("prediction", argmax_class("probs"))
            .withColumn("predicted_band", decode_band("prediction"))
            .withColumn("confidence", F.array_max("probs"))
            .withColumn("confidence_pct", confidence_pct("probs")))


def scorer(fm: FittedModel):
    """``probs`` of ``predict`` as a function of arrays, (rows, features) -> (rows, N_CLASSES), for estimators that ask for
    many variants of a row inside a task."""
    m, spark = fm.model, SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    present = np.array([1.0 if i in fm.classes else 0.0 for i in range(N_CLASSES)])[:, None]
    if isinstance(m, BoostedTreesModel):
        trees, classes = [TR.node_table(spark, one) for one in m.margins], list(fm.classes)

        def raw(x):
            margins = np.full((N_CLASSES, len(x)), -np.inf)
            for c, ensemble in zip(classes, trees):
                margins[c] = TR.walked(ensemble, x)[0]
            return _softmax(margins)
    elif isinstance(m, LogisticRegressionModel):
        if m.coefficientMatrix.numRows != N_CLASSES:
            raise ValueError(f"a linear model of {N_CLASSES} classes is expected")
        w, b = m.coefficientMatrix.toArray(), m.interceptVector.toArray()

        def raw(x):
            return _softmax(w @ x.T + b[:, None])
    else:
        votes = TR.node_table(spark, m)

        def raw(x):
            found = TR.walked(votes, x)
            return found / found.sum(0)

    def probs(x):
        p = raw(x) * present
        total = p.sum(0)
        return (p / np.where(total > 0, total, 1.0)).T
    return probs


def _softmax(margins: np.ndarray) -> np.ndarray:
    """Of (classes, rows)."""
    e = np.exp(margins - margins.max(0))
    return e / e.sum(0)


def probability_breakdown(scored: DataFrame, keys: list[str]) -> DataFrame:
    """P20: one row per (row, class) with its probability (classes the model
    lacks are already 0 in ``probs``)."""
    return scored.select(*keys, F.posexplode("probs").alias("class_index", "probability")).select(
        *keys, F.col("class_index").cast("int").alias("class_index"),
        decode_band("class_index").alias("band"), "probability")


def compare_models(models: list[FittedModel], test: DataFrame) -> DataFrame:
    """One row per model with accuracy / macro F1 / weighted F1 (4 dp).

    The models' predictions are stacked (label, prediction, model) and reduced
    by one grouped aggregate of conditional counts -- one shuffle for all models.
    """
    stacked = None
    for fm in models:
        order = MODEL_ORDER.index(fm.name) if fm.name in MODEL_ORDER else 99
        s = predict(fm, test).select(F.lit(fm.name).alias("model"), F.lit(order).alias("model_order"),
                                     "label", "prediction")
        stacked = s if stacked is None else stacked.unionByName(s)
    return M.summary_metrics_by(stacked, ["model", "model_order"])


def train_and_compare(train: DataFrame, test: DataFrame, p: TrainParams = TrainParams(),
                      names: list[str] = MODEL_ORDER, parallelism: int = 3) -> tuple[dict, DataFrame, str]:
    """Train each model, compare on test, pick the best by macro F1.

    The fits are independent Spark jobs; like ``CrossValidator(parallelism=)``
    they are submitted from ``parallelism`` driver threads so that one model's
    small per-iteration jobs do not leave the cluster idle.
    """
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(names)))) as pool:
        futures = {n: pool.submit(TRAINERS[n], train, p) for n in names}
        models = {n: futures[n].result() for n in names}
    rows = compare_models(list(models.values()), test).collect()  # one row for each model
    cmp = test.sparkSession.createDataFrame(rows)
    best = M.select_best(cmp).first()["model"]
    return models, cmp, best
