"""Every query with a SQL statement gives exactly its result; the others give rows."""

import pytest

import __spark_entry__ as entry
from oracle import difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# empty at the smallest scale or slow models, covered by their own tests
MODELS = {"forecast_gbt", "feature_importance", "kmeans_profiles"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(spark, QUERIES[name], SQL[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - MODELS))
def test_query_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
