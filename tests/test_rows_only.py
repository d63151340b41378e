"""Registered queries without a SQL oracle run over the whole sf0.001 tables
and return the expected shape."""

import pytest

import __spark_entry__ as E
from panelsight.plans.queries import REGISTRY
from tests.conftest import SMALL

ROWS_ONLY = sorted(set(REGISTRY) - set(E.oracle_sql()))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = E.queries()[name](spark, SMALL)
    rows = df.collect()
    assert len(df.columns) > 0
    assert len(rows) > 0, name


def test_model_queries_cover_the_test_period(spark):
    from pyspark.sql import functions as F
    from panelsight.plans import queries as Q
    _, test = Q.split_frames(spark, SMALL)
    n = test.count()
    for name in ["train_logreg", "train_random_forest", "train_boosted_trees", "score_batch", "stream_score"]:
        assert E.queries()[name](spark, SMALL).count() == n, name
    s = E.queries()["scored_summary"](spark, SMALL).first()
    assert s.n_high + s.n_medium + s.n_low == n
    same = E.queries()["model_store"](spark, SMALL).agg(F.min(F.col("same").cast("int"))).first()[0]
    assert same == 1
