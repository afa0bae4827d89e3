"""The registered corpus queries and the pipeline over the small test tables."""

import re
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from oracle import difference
from pulsegrid.llm import registered

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_one_query_for_each_operator():
    numbers = [re.match(r"op(\d+)_", name)[1] for name in registered.QUERIES]
    assert sorted(map(int, numbers)) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(spark, QUERIES[name], SQL[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(registered.QUERIES) - set(registered.ORACLES)))
def test_query_covers_its_table(spark, sf_dir, name):
    table = "pages" if "html" in name else "documents"
    assert QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).persist()
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and len(now) > 0.5 * len(ids), name
        ids = now
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert Counter(r.doc_id for r in encoded) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.round_trip for r in encoded)


def test_the_rest_does_not_need_the_corpus_operators():
    root = Path(entry.__file__).parent
    users = [p for p in (root / "pulsegrid").rglob("*.py") if "llm" not in p.parts and "llm" in p.read_text()]
    assert users == []
