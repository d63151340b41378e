"""Every registered query with a SQL oracle matches DuckDB (sf0.001)."""

import pytest

import __spark_entry__ as E
from panelsight.plans.queries import REGISTRY
from tests.conftest import SMALL
from tests.oracle_harness import compare

ORACLED = sorted(set(REGISTRY) & set(E.oracle_sql()))


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ORACLED)
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(spark, name, SMALL, duck_small, verbose=True)
    assert r["cols_match"], r
    assert r["rows_match"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5  # one row for each department
    assert sum(r.n_employees for r in rows) > 0
    assert "predicted_high_pct" in df.columns
