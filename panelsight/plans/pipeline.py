"""End-to-end compositions: the full pipeline and its flagship slice.

The cleaned panel is the output of the only heavy step (the line-item
aggregate); it is written once as parquet partitioned by ``review_year``
under the shared checkpoint folder, which cuts the lineage (a lost executor
re-reads files instead of re-aggregating the line items) and lets the time
split prune year directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelsight.operators import decisions as D
from panelsight.operators import fairness as FA
from panelsight.operators import models as MD
from panelsight.operators import prep as P
from panelsight.sources.stored import materialize
from panelsight.sources.stored import stored_clean_panel as _stored_clean


def stored_clean_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_clean(spark, sf_dir)


def run_pipeline(spark: SparkSession, sf_dir: str, cutoff: str = "2000-Q1",
                 params: MD.TrainParams = MD.TrainParams(),
                 models: list[str] = MD.MODEL_ORDER, reference: str = "EUROPE") -> dict:
    """panel -> clean -> split -> prep -> train/compare -> score best ->
    decisions -> fairness. Returns a dict of DataFrames / fitted objects."""
    clean = stored_clean_panel(spark, sf_dir)
    train, test = P.time_split(clean, cutoff)
    stats = P.fit_prep(train)
    tr = materialize(P.transform_prep(train, stats), "train")[0]
    te = materialize(P.transform_prep(test, stats), "test")[0]
    fitted, comparison, best = MD.train_and_compare(tr, te, params, models)
    scored = materialize(MD.predict(fitted[best], te), "scored")[0]  # scored once: decisions and audits read it
    report = D.decision_report(scored)
    fair = FA.fairness_report(scored, "prediction", reference)
    return {"clean": clean, "stats": stats, "train": tr, "test": te, "models": fitted,
            "comparison": comparison, "best": best, "scored": scored, "decisions": report,
            "fairness": fair}


def flagship_slice(spark: SparkSession, sf_dir: str, cutoff: str = "2000-Q1",
                   reference: str = "EUROPE") -> DataFrame:
    """Panel -> prep -> logistic regression -> decisions -> department audit."""
    clean = _stored_clean(spark, sf_dir)
    train, test = P.time_split(clean, cutoff)
    stats = P.fit_prep(train)
    tr = P.transform_prep(train, stats)
    te = P.transform_prep(test, stats)
    lr = MD.train_logreg(tr)
    scored = MD.predict(lr, te)
    decided = D.decide(scored)
    audit = FA.audit_by_group(decided, "department", "prediction")
    urgent = decided.groupBy(F.col("department").alias("group_name")).agg(
        F.count_if(F.col("priority") == "Urgent").alias("urgent_decisions"))
    return audit.join(urgent, "group_name", "left")


def save_outputs(spark: SparkSession, out: dict, out_dir: str, permutation: bool = True) -> dict:
    """S4 + S6: write the report tables and the fitted model bundles.

    Reports: decisions, model comparison, feature importance of the best
    model, permutation importance, the three fairness tables. Bundles: one per
    model plus ``best``, another name of the best model's version.
    """
    from panelsight.operators import explain as X
    from panelsight.sources import files as FS
    from panelsight.sources import model_store as MS
    out_dir = out_dir.rstrip("/")
    best = out["models"][out["best"]]
    feats = out["stats"].features
    reports = {
        "decisions": out["decisions"],
        "model_comparison": out["comparison"],
        "feature_importance": X.importance_table(spark, best, feats),
        "fairness_department": out["fairness"]["department"],
        "fairness_experience": out["fairness"]["experience"],
        "fairness_parity": out["fairness"]["parity"],
    }
    if permutation:
        reports["permutation_importance"] = X.permutation_importance(best, out["test"], feats)
    paths = {name: FS.write_report(df, name, f"{out_dir}/reports") for name, df in reports.items()}
    for name, fm in out["models"].items():
        paths[f"model:{name}"] = MS.save_bundle(spark, fm, out["stats"], f"{out_dir}/models/{name}")
    paths["model:best"] = MS.point(spark, f"{out_dir}/models/best", MS.current(spark, paths[f"model:{out['best']}"]))
    return paths


def main(argv: list[str] | None = None) -> None:
    """Command line: run the pipeline over a folder of warehouse tables."""
    import argparse
    import json

    from panelsight.session import get_spark
    ap = argparse.ArgumentParser(description="panel -> models -> decisions -> fairness")
    ap.add_argument("--sf-dir", required=True, help="folder with lineitem/supplier/nation/region parquet")
    ap.add_argument("--out", required=True, help="output folder (reports/ and models/)")
    ap.add_argument("--cutoff", default="2000-Q1")
    ap.add_argument("--reference", default="EUROPE")
    ap.add_argument("--models", default=",".join(MD.MODEL_ORDER))
    a = ap.parse_args(argv)
    spark = get_spark()
    res = run_pipeline(spark, a.sf_dir, a.cutoff, models=a.models.split(","), reference=a.reference)
    paths = save_outputs(spark, res, a.out)
    print(json.dumps({"best": res["best"], "outputs": paths}))


if __name__ == "__main__":
    main()
