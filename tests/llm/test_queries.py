"""The operators' queries against SQL, and the pipeline."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import corpus_pipeline
from termloom.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(queries.queries()[name](spark, sf_dir), connect(sf_dir), SQL[name]) > 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, sf_dir))
        assert docs.columns == columns, name
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before and len(after) > 0.8 * len(before), name
        before = after
    assert docs.where("text LIKE '%@mail%.example.com%'").count() == 0
    result = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in result.select("doc_id").collect()} == before
