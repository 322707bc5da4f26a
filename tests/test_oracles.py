"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as spark_entry

QUERIES = spark_entry._statistics()
SQL = spark_entry._statistics_sql()


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, tables, name):
    assert compare(QUERIES[name](spark, sf_dir), tables, SQL[name]) > 0


def test_entry(spark, sf_dir):
    result = spark_entry.entry(spark)
    assert result.columns == ["doc_id", "term", "tfidf"]
    assert result.count() > 0
