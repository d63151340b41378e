"""Quantiles in two scans, scans with rejects, committed model versions, bucketed tables, one-scan audits."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelsight.operators import fairness as FA
from panelsight.operators import prep as P
from panelsight.operators import ranks as R
from panelsight.plans import fixed_models as FX
from panelsight.plans import queries as Q
from panelsight.session import work_dir
from panelsight.sources import files as FS
from panelsight.sources import model_store as MS
from tests.conftest import SMALL

POINTS = [0, 0.1, 0.25, 0.5, 0.75, 0.999, 1]


def _columns(n: int):
    rng = np.random.default_rng(n)
    draws = zip(rng.normal(size=n), rng.integers(0, 3, n), rng.normal(size=n), rng.normal(size=n))
    return [(float(a), float(b), None if c < 0 else float(c), float("nan") if d > 1 else float(d)) for a, b, c, d in draws]


@pytest.mark.parametrize("n, sketch, few", [(1, 10_000, 20_000), (2, 10_000, 20_000), (70, 10_000, 20_000), (12_000, 10_000, 20_000), (4000, 50, 20), (4000, 200, 3000)])
def test_quantiles(spark, monkeypatch, n, sketch, few):
    """Doubles, few values, NULLs and NaN; brackets that are narrowed once, several times or not at all."""
    monkeypatch.setattr(R, "SKETCH", sketch)
    monkeypatch.setattr(R, "FEW", few)
    rows = _columns(n)
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    found, more = R.exact_quantiles(df, ["a", "b", "c", "d"], POINTS, [F.count(F.lit(1)).alias("rows")])
    assert more["rows"] == n
    for q, column in zip(found, zip(*rows)):
        v = [x for x in column if x is not None and x == x]
        assert q == [None] * 7 if not v else np.allclose(q, np.quantile(v, POINTS), atol=1e-12, rtol=0)


def test_quantiles_of_heavy_values(spark, monkeypatch):
    """Two values share all rows, and the median lies between them."""
    monkeypatch.setattr(R, "SKETCH", 100)
    monkeypatch.setattr(R, "FEW", 2)
    df = spark.range(4000).select((F.col("id") % 2).cast("double").alias("x"), F.lit(7.0).alias("y"))
    assert R.exact_quantiles(df, ["x", "y"], [0.5, 0.9])[0] == [[0.5, 1.0], [7.0, 7.0]]
    assert [tuple(r) for r in R.quantiles(df, ["x"], [0.25]).collect()] == [("x", 0.0)]


def test_preparation_leaves_nothing_behind(spark):
    import os
    from panelsight.session import ensure_checkpoint_dir
    clean = Q.clean_panel(spark, SMALL)
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = None
    for _ in range(3):
        P.prep_pipeline(clean, Q.CUTOFF)
        now = sorted(os.listdir(base))
        assert before in (None, now)
        before = now


def test_encoders_of_few_and_many_values_are_alike(spark, monkeypatch):
    train, test = Q.split_frames(spark, SMALL)
    few = P.fit_label_encoder(train)
    monkeypatch.setattr(P, "LOCAL_VALUES", 3)
    many = P.fit_label_encoder(train)
    assert sorted(few.collect()) == sorted(many.collect()) and P.few_codes(many) == {}
    cols = ["employee_id", "quarter_label", "department_enc", "education_enc", "role_enc"]
    joined = P.apply_label_encoder(test, many, unseen="zero").select(*cols)
    monkeypatch.setattr(P, "LOCAL_VALUES", 1000)
    mapped = P.apply_label_encoder(test, few, unseen="zero").select(*cols)
    assert sorted(joined.collect()) == sorted(mapped.collect())
    assert "Join" not in mapped._jdf.queryExecution().executedPlan().toString().split("Scan")[0]
    with pytest.raises(Exception, match="unseen value in role"):
        P.apply_label_encoder(test.withColumn("role", F.lit("nowhere")), few).collect()


FEED = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("absent", T.DateType())])


def test_scan_with_rejects(spark, tmp_path):
    text = ('id,n,x\n"a",1,1.5\n"b\nc, ""d""",2,\nshort,1\nlong,1,2,3\n,5,1.0\n"  ",5,1.0\ne,x7,NaN\n"f",3,2.5\n')
    (tmp_path / "one.csv").write_text(text)
    (tmp_path / "two.csv").write_text("id,n,x\nz,9,0.5\n")
    scan = FS.scan_csv_with_rejects(spark, str(tmp_path), FEED, work_dir(spark, "t-scan"), required=["id"])
    rows = {r.id: (r.n, r.x, r.absent) for r in scan.rows.collect()}
    assert rows == {"a": (1, 1.5, None), 'b\nc, "d"': (2, None, None), "e": (None, None, None), "f": (3, 2.5, None), "z": (9, 0.5, None)}
    rejects = sorted((r.reason, r.record) for r in scan.rejects.collect())
    assert [r for r, _ in rejects] == ["ragged", "ragged", "required", "required"]
    assert rejects[0][1].startswith("long,1,2,3") and rejects[1][1].startswith("short,1")
    assert (scan.n_in, scan.n_out, scan.n_rejected, scan.n_bad_cells) == (9, 5, 4, 2) and scan.n_in == scan.n_out + scan.n_rejected
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("id,n,x\n")
    none = FS.scan_csv_with_rejects(spark, str(tmp_path / "empty"), FEED, work_dir(spark, "t-scan"), required=["id"])
    assert (none.n_in, none.rows.count(), none.rejects.count()) == (0, 0, 0)


def test_a_nan_cell_is_null(spark, tmp_path):
    (tmp_path / "p.csv").write_text("employee_id,attendance_rate\nE1,NaN\nE2,0.5\n")
    assert sorted((r.employee_id, r.attendance_rate) for r in FS.read_panel_csv(spark, str(tmp_path / "p.csv")).collect()) == [("E1", None), ("E2", 0.5)]


@pytest.fixture(scope="module")
def bundle(spark):
    _, _, stats = Q.prepared(spark, SMALL)
    return FX.linear(spark, 13), FX.forest(spark, 13, 2), stats


def test_a_save_that_dies_leaves_the_old_version(spark, bundle, monkeypatch):
    linear, forest, stats = bundle
    path = work_dir(spark, "t-versions")
    with pytest.raises(FileNotFoundError, match="no committed"):
        MS.load_bundle(spark, path)
    real = MS._write_text

    def dies(spark, p, text):
        if p.endswith("manifest.json"):
            raise OSError("no space")
        real(spark, p, text)
    monkeypatch.setattr(MS, "_write_text", dies)
    with pytest.raises(OSError):
        MS.save_bundle(spark, linear, stats, path)
    with pytest.raises(FileNotFoundError):
        MS.load_bundle(spark, path)
    monkeypatch.setattr(MS, "_write_text", real)
    MS.save_bundle(spark, linear, stats, path)
    monkeypatch.setattr(MS, "_write_text", dies)
    with pytest.raises(OSError):
        MS.save_bundle(spark, forest, stats, path)
    monkeypatch.setattr(MS, "_write_text", real)
    assert MS.load_bundle(spark, path)[0].name == "logistic_regression"
    MS.save_bundle(spark, forest, stats, path)
    assert MS.load_bundle(spark, path)[0].name == "random_forest"


def test_readers_during_saves_see_whole_bundles(spark, bundle):
    linear, forest, stats = bundle
    path = MS.save_bundle(spark, linear, stats, work_dir(spark, "t-race"))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            fm, st = MS.load_bundle(spark, path)
            kind = type(fm.model).__name__
            seen.append((fm.name, kind) in {("logistic_regression", "LogisticRegressionModel"), ("random_forest", "RandomForestClassificationModel")} and st.encoder.count() > 0)
    reader = threading.Thread(target=read)
    reader.start()
    for k in range(4):
        MS.save_bundle(spark, (forest, linear)[k % 2], stats, path)
    stop.set()
    reader.join()
    assert len(seen) > 1 and all(seen)
    fs, p = MS._fs(spark, f"{path}/versions")
    assert len(fs.listStatus(p)) == MS.KEEP


def test_an_alias_is_another_name_of_a_version(spark, bundle):
    linear, forest, stats = bundle
    path = MS.save_bundle(spark, FX.boosted(spark, 13, 2), stats, work_dir(spark, "t-model"))
    alias = MS.point(spark, work_dir(spark, "t-alias"), MS.current(spark, path))
    fm, _ = MS.load_bundle(spark, alias)
    assert fm.name == "boosted_trees" and len(fm.model.margins) == 3 and MS.feature_manifest(spark, alias) == MS.feature_manifest(spark, path)


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bucketed_panel_needs_no_exchange(spark):
    assert "Exchange" not in _plan(Q.q_dedup_bucketed(spark, SMALL))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        attached, dense = _plan(Q.q_attach_bucketed(spark, SMALL)), _plan(Q.q_densify_bucketed(spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange" not in attached and "SortMergeJoin" in attached
    by_keys = [ln for ln in dense.splitlines() if "Exchange hashpartitioning(employee_id" in ln and "review_quarter" in ln]
    assert "SortMergeJoin [employee_id" in dense and len(by_keys) == 1  # the calendar's; the facts come by buckets
    assert dense.index(by_keys[0]) < dense.rindex("SortAggregate(key=[employee_id")


def test_fairness_report_scans_once(spark, monkeypatch):
    scored = Q._pseudo_scored(spark, SMALL)
    plan = FA.group_counts(scored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan
    rep = FA.fairness_report(scored, "prediction", Q.PARITY_REFERENCE)
    for k in ("department", "experience", "parity", "bias_detected", "parity_flagged"):
        assert "FileScan" not in rep[k]._jdf.queryExecution().executedPlan().toString()
    same = lambda a, b, c: sorted(map(tuple, a.select(*c).collect())) == sorted(map(tuple, b.select(*c).collect()))
    assert same(rep["department"], FA.audit_by_group(scored), FA.audit_by_group(scored).columns)
    assert same(rep["experience"], FA.audit_by_experience(scored), rep["experience"].columns)
    assert same(rep["parity"], FA.statistical_parity(scored, reference=Q.PARITY_REFERENCE), rep["parity"].columns)
    assert FA.fairness_report(scored.limit(0))["bias_detected"].first()[0] is False
