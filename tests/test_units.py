"""Unit checks on written rows for operators whose oracle data has no gaps."""

from pyspark.sql import functions as F

import pytest

from panelsight.functions.scalars import quarter_key
from panelsight.operators.joins import sized_broadcast
from panelsight.operators import insights as I
from panelsight.operators import prep as P
from panelsight.operators.ranks import quantiles
from panelsight.schema import PANEL_SCHEMA
from panelsight.sources.panel import densify_panel


def _panel_rows(spark, rows):
    base = {f.name: None for f in PANEL_SCHEMA.fields}
    data = []
    for r in rows:
        d = dict(base)
        d.update(r)
        data.append(tuple(d[f.name] for f in PANEL_SCHEMA.fields))
    return spark.createDataFrame(data, PANEL_SCHEMA)


def test_densify_fills_missing_quarters_with_nulls(spark):
    p = _panel_rows(spark, [
        {"employee_id": "EMP0001", "department": "ASIA", "age": 30, "review_year": 2000, "review_quarter": 1,
         "quarter_label": "2000-Q1", "training_hours": 12.0, "performance_band": "Low"},
        {"employee_id": "EMP0001", "department": "ASIA", "age": 30, "review_year": 2000, "review_quarter": 3,
         "quarter_label": "2000-Q3", "training_hours": 20.0, "performance_band": "High"},
    ])
    d = densify_panel(p, p.limit(1)).orderBy("review_quarter").collect()
    assert [r.quarter_label for r in d] == ["2000-Q1", "2000-Q2", "2000-Q3"]
    assert [r.training_hours for r in d] == [12.0, None, 20.0]
    assert all(r.department == "ASIA" and r.age == 30 for r in d)
    assert str(d[1].review_date) == "2000-04-01"


def test_quarter_key_rejects_malformed_labels(spark):
    df = spark.createDataFrame([("2022-Q3",), (None,)], "l string")
    assert [r.k for r in df.select(quarter_key("l").alias("k")).collect()] == [20223, None]
    for bad in ("2022-Q5", "22-Q1", "x", ""):
        with pytest.raises(Exception, match="malformed quarter label"):
            spark.createDataFrame([(bad,)], "l string").select(quarter_key("l")).collect()


def test_time_split_loses_no_row(spark):
    rows = [("1999-Q4", 1999, 4), ("2000-Q1", 2000, 1), ("1999-Q4", None, None), ("2000-Q2", None, None)]
    df = spark.createDataFrame(rows, "quarter_label string, review_year int, review_quarter int")
    train, test = P.time_split(df, "2000-Q1")
    assert train.count() == 2 and test.count() == 2
    for bad in [("1999-Q4", 2000, 4), (None, None, None), ("1999Q4", 1999, 4)]:
        with pytest.raises(Exception, match="disagree|without a quarter|malformed"):
            [t.collect() for t in P.time_split(spark.createDataFrame([bad], df.schema), "2000-Q1")]


def test_sized_broadcast_checks_size(spark):
    small = spark.range(10)
    hinted = sized_broadcast(small, max_bytes=80)
    plain = sized_broadcast(small, max_bytes=79)
    big = spark.range(1000)
    j1 = big.join(hinted, "id")._jdf.queryExecution().optimizedPlan().toString()
    j2 = big.join(plain, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in j1.lower() and "broadcast" not in j2.lower()


def test_describe_exact_and_approx(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "age double")
    exact = I.describe_numeric(df, ["age"]).first()
    assert (exact["count"], exact.mean, exact.p25, exact.p50, exact.p75) == (4, 2.5, 1.75, 2.5, 3.25)
    approx = I.describe_numeric(df, ["age"], approx=True).first()
    assert approx.p50 in (2.0, 3.0) and approx.min == 1.0 and approx.max == 4.0


def test_prep_with_approximate_medians(spark):
    from panelsight.operators import prep as P
    from panelsight.plans import queries as Q
    from tests.conftest import SMALL
    clean = Q.clean_panel(spark, SMALL)
    train, _ = P.time_split(clean, Q.CUTOFF)
    exact = P.fit_prep(train)
    approx = P.fit_prep(train, approx_median=True)
    assert set(approx.medians) == set(exact.medians)
    # a sketch median is one of the observed values, next to the exact one
    for c, m in exact.medians.items():
        lo, hi = train.agg(F.min(c), F.max(c)).first()
        assert lo <= approx.medians[c] <= hi
        assert abs(approx.medians[c] - m) <= (hi - lo) * 0.1


def test_encoder_of_many_categories(spark):
    """200 000 categories: codes follow the sorted values, and no task holds them all."""
    df = spark.range(400_000).selectExpr("concat('v', lpad(id % 200000, 7, '0')) AS role", "IF(id = 0, NULL, 'x') AS department", "'e' AS education")
    encoder = P.fit_label_encoder(df)
    r = encoder.where("column_name = 'role'").agg(F.count("*"), F.min("code"), F.max("code"), F.count_if(F.expr("code <> cast(substr(value, 2) AS int)"))).first()
    assert tuple(r) == (200_000, 0, 199_999, 0)
    assert {(x.value, x.code) for x in encoder.where("column_name = 'department'").collect()} == {("nan", 0), ("x", 1)}
    out = P.apply_label_encoder(df.limit(100), encoder)
    assert out.where("role_enc <> cast(substr(role, 2) AS int)").count() == 0


def test_quantiles_over_ranges(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=5000), 2)
    df = spark.createDataFrame([(float(v), None if i % 3 else float(i)) for i, v in enumerate(x)], "a double, b double")
    got = {r.column_name: r for r in quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for c, v in (("a", x), ("b", np.arange(0, 5000, 3.0))):
        assert np.allclose([got[c][f"q{i}"] for i in range(5)], np.quantile(v, [0, 0.25, 0.5, 0.9, 1]), rtol=1e-12)
    assert quantiles(df.limit(0), ["a"], [0.5]).count() == 0


def test_session_without_a_configured_folder(tmp_path):
    """An empty Spark conf folder: a local session has a folder of its own; on a cluster that is an error."""
    import os
    import subprocess
    import sys
    code = ("from panelsight.session import get_spark, ensure_checkpoint_dir, work_dir\n"
            "from panelsight.plans.queries import REGISTRY\n"
            "s = get_spark('local[2]', 2)\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "print('rows', REGISTRY['time_split'](s, '/root/testdata/sf0.001').count(), work_dir(s, 'x'))\n"
            "class Cluster:\n"
            "    conf = s.conf\n"
            "    class sparkContext: master = 'spark://host:7077'\n"
            "try: ensure_checkpoint_dir(Cluster)\n"
            "except RuntimeError as e: print('refused', e)\n")
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "rows 280" in out.stdout and "refused" in out.stdout, out.stderr[-2000:]
