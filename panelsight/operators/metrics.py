"""Classification metrics from a confusion aggregate.

The only pass over the scored rows is ``groupBy(label, prediction).count()``
(partial aggregate: at most 9 groups per task); every metric is then derived
from those <= 9 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelsight.functions.scalars import rnd
from panelsight.schema import BANDS

N_CLASSES = len(BANDS)


def _class_counts(df: DataFrame, label_col: str, pred_col: str, group_cols=(), count_col: str | None = None) -> DataFrame:
    """One aggregate (per group) with, for every class k, the number of rows
    with label k (support), prediction k and both (tp) -- 9 conditional
    counts, map-side combined. A row of ``df`` stands for ``count_col`` rows, if given."""
    count_if = (lambda c: F.sum(F.when(c, F.col(count_col)).otherwise(0))) if count_col else F.count_if
    lab, pred = F.col(label_col).cast("int"), F.col(pred_col).cast("int")
    aggs = []
    for k in range(N_CLASSES):
        aggs += [count_if(lab == k).alias(f"s{k}"), count_if(pred == k).alias(f"p{k}"),
                 count_if((lab == k) & (pred == k)).alias(f"t{k}")]
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    return g.agg(*aggs)


def confusion_counts(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """M8 (sparse): counts per observed (label, prediction)."""
    return (df.groupBy(F.col(label_col).cast("int").alias("label"),
                       F.col(pred_col).cast("int").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """M8: dense 3x3 counts (labels fixed 0, 1, 2): one aggregate with a
    conditional count per cell, unpivoted with ``stack``."""
    lab, pred = F.col(label_col).cast("int"), F.col(pred_col).cast("int")
    cells = [(i, j) for i in range(N_CLASSES) for j in range(N_CLASSES)]
    wide = df.agg(*[F.count_if((lab == i) & (pred == j)).alias(f"c{i}_{j}") for i, j in cells])
    stack = ", ".join(f"{i}, {j}, c{i}_{j}" for i, j in cells)
    return (wide.selectExpr(f"stack({len(cells)}, {stack}) AS (label, prediction, n)")
            .select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
                    F.col("n").cast("bigint").alias("n")))


def _per_class_from_counts(wide: DataFrame, group_cols=()) -> DataFrame:
    """Long form (per group, per class seen in truth or prediction) with
    precision, recall and F1 (0 when undefined)."""
    stack = ", ".join(f"{k}, s{k}, p{k}, t{k}" for k in range(N_CLASSES))
    long = wide.selectExpr(*group_cols, f"stack({N_CLASSES}, {stack}) AS (cls, support, predicted, tp)")
    long = long.where((F.col("support") > 0) | (F.col("predicted") > 0))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    return (long.withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                        .otherwise(0.0)))


def per_class(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Per class: support, tp, predicted count, precision, recall, F1 (0 when undefined)."""
    return _per_class_from_counts(_class_counts(df, label_col, pred_col))


def summary_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                    digits: int = 4) -> DataFrame:
    """M5 + M6 + M7 in one row: accuracy, macro F1 (over classes seen in truth
    or prediction), support-weighted F1."""
    pc = per_class(df, label_col, pred_col)
    g = pc.agg(F.sum("support").alias("n"), F.sum("tp").alias("correct"),
               F.avg("f1").alias("f1_macro"),
               (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"))
    return g.select(rnd(F.col("correct") / F.col("n"), digits).alias("accuracy"),
                    rnd("f1_macro", digits).alias("f1_macro"),
                    rnd("f1_weighted", digits).alias("f1_weighted"),
                    F.col("n").cast("bigint").alias("n"))


def classification_report(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                          digits: int = 4) -> DataFrame:
    """M9: precision / recall / F1 / support per class seen in truth or
    prediction, plus accuracy, macro avg and weighted avg rows.

    One pass: the 9 conditional counts come from a single aggregate; the six
    report rows are built from that one row with array functions and
    ``inline`` (no second scan of the scored rows).
    """
    wide = _class_counts(df, label_col, pred_col)
    cls = []
    for k in range(N_CLASSES):
        s_, p_, t_ = F.col(f"s{k}"), F.col(f"p{k}"), F.col(f"t{k}")
        prec = F.when(p_ > 0, t_ / p_).otherwise(0.0)
        rec = F.when(s_ > 0, t_ / s_).otherwise(0.0)
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
        cls.append(F.struct(F.lit(BANDS[k]).alias("row_name"), F.lit(k).alias("row_order"),
                            prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                            s_.alias("support"), t_.alias("tp"), ((s_ > 0) | (p_ > 0)).alias("seen")))
    seen = F.filter(F.array(*cls), lambda c: c["seen"])
    n = F.aggregate(seen, F.lit(0).cast("bigint"), lambda a, c: a + c["support"])
    k = F.size(seen)

    def total(field, weighted=False):
        return F.aggregate(seen, F.lit(0.0), lambda a, c: a + (c[field] * c["support"] if weighted else c[field]))

    def row(name, order, prec, rec, f1, support):
        return F.struct(F.lit(name).alias("row_name"), F.lit(order).alias("row_order"),
                        prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), support.alias("support"))

    per_class = F.transform(seen, lambda c: row(None, None, rnd(c["precision"], digits), rnd(c["recall"], digits),
                                                rnd(c["f1"], digits), c["support"]).withField(
        "row_name", c["row_name"]).withField("row_order", c["row_order"]))
    tp = F.aggregate(seen, F.lit(0).cast("bigint"), lambda a, c: a + c["tp"])
    extra = F.array(
        row("accuracy", 10, F.lit(None).cast("double"), F.lit(None).cast("double"), rnd(tp / n, digits), n),
        row("macro avg", 11, rnd(total("precision") / k, digits), rnd(total("recall") / k, digits),
            rnd(total("f1") / k, digits), n),
        row("weighted avg", 12, rnd(total("precision", True) / n, digits), rnd(total("recall", True) / n, digits),
            rnd(total("f1", True) / n, digits), n))
    return (wide.select(F.inline(F.concat(per_class, extra)))
            .select(F.col("row_name").cast("string").alias("row_name"),
                    F.col("row_order").cast("int").alias("row_order"),
                    "precision", "recall", "f1", F.col("support").cast("bigint").alias("support")))


def select_best(comparison: DataFrame, metric: str = "f1_macro", order_col: str = "model_order") -> DataFrame:
    """Highest metric; the earlier model wins ties."""
    w = Window.partitionBy().orderBy(F.col(metric).desc(), F.col(order_col).asc())
    return comparison.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def macro_f1_by(scored: DataFrame, group_cols: list[str], label_col: str = "label",
                pred_col: str = "prediction", count_col: str | None = None) -> DataFrame:
    """Macro F1 per group (e.g. per (feature, repeat) of a permutation test),
    from one grouped aggregate of conditional counts (of rows that stand for
    ``count_col`` rows, if given)."""
    g = list(group_cols)
    pc = _per_class_from_counts(_class_counts(scored, label_col, pred_col, g, count_col), g)
    return pc.groupBy(*g).agg(F.avg("f1").alias("f1_macro"))


def summary_metrics_by(scored: DataFrame, group_cols: list[str], label_col: str = "label",
                       pred_col: str = "prediction", digits: int = 4) -> DataFrame:
    """M5-M7 per group (e.g. per model) from one grouped aggregate."""
    g = list(group_cols)
    pc = _per_class_from_counts(_class_counts(scored, label_col, pred_col, g), g)
    agg = pc.groupBy(*g).agg(F.sum("support").alias("n"), F.sum("tp").alias("correct"),
                             F.avg("f1").alias("f1_macro"),
                             (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"))
    return agg.select(*g, rnd(F.col("correct") / F.col("n"), digits).alias("accuracy"),
                      rnd("f1_macro", digits).alias("f1_macro"), rnd("f1_weighted", digits).alias("f1_weighted"))
