"""Hot keys: exact results, and no task that gets a hot key's rows alone."""

from __future__ import annotations

import pytest
from brute_force import assert_scores
from pyspark.sql import functions as F

from termloom import explode_postings, postings, score, term_counts
from termloom.operators.counts import sizes_of_counts
from termloom.operators.lookup import attach_by_doc, attach_by_term
from termloom.operators.tokens import terms_per_row
from termloom.operators.totals import heavy_groups, with_group_total

ROWS = 6_000


@pytest.fixture
def rows(spark):
    """``(doc, term, word_count)``: a third has term ``hot``, a third has document ``hot``."""
    n = spark.range(ROWS)
    hot_term, hot_doc = F.col("id") % 3 == 0, F.col("id") % 3 == 1
    return n.select(
        F.when(hot_doc, "hot").otherwise(F.concat(F.lit("d"), "id")).alias("doc"),
        F.when(hot_term, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("term"),
        F.lit(1).cast("bigint").alias("word_count"),
    )


def largest_task(frame) -> int:
    return frame.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_hot_term_spreads_in_lookup(static_plans, rows):
    table = rows.groupBy("term").agg(F.count("*").alias("n"))
    joined = attach_by_term(rows, table, "n", hot_keys=10)
    assert largest_task(joined) < ROWS / 5
    assert joined.count() == ROWS
    assert joined.where("n <> CASE WHEN term = 'hot' THEN 2000 ELSE 1 END").count() == 0


def test_long_hot_term_spreads(static_plans, rows):
    long = F.when(F.col("term") == "hot", F.repeat(F.lit("x"), 5_000)).otherwise(F.col("term"))
    rows = rows.withColumn("term", long)
    table = rows.groupBy("term").agg(F.count("*").alias("n"))
    joined = attach_by_term(rows, table, "n", hot_keys=10)
    assert largest_task(joined) < ROWS / 5
    assert joined.where("n <> CASE WHEN length(term) = 5000 THEN 2000 ELSE 1 END").count() == 0
    assert joined.count() == ROWS


def test_plain_join_would_not_spread(static_plans, rows):
    table = rows.groupBy("term").agg(F.count("*").alias("n"))
    assert largest_task(rows.join(table.hint("shuffle_hash"), "term")) > ROWS / 3


def test_hot_document_spreads_in_lookup(static_plans, rows):
    joined = attach_by_doc(rows, sizes_of_counts(rows), "doc_size", hot_keys=10)
    assert largest_task(joined) < ROWS / 5
    assert joined.count() == ROWS
    assert joined.where("doc_size <> CASE WHEN doc = 'hot' THEN 2000 ELSE 1 END").count() == 0


@pytest.mark.parametrize("group, spread", [("term", "doc"), ("doc", "term")])
def test_group_total_spreads(static_plans, rows, group, spread):
    heavy = heavy_groups(rows, group, partitions=16)
    assert heavy == {"=hot": 16}
    total = with_group_total(rows, group, spread, F.col("word_count"), "n", heavy)
    assert largest_task(total) < ROWS / 5
    assert total.count() == ROWS
    assert total.where(f"n <> CASE WHEN {group} = 'hot' THEN 2000 ELSE 1 END").count() == 0


def test_hot_keys_are_few_whatever_the_data(spark):
    """Uniform keys: none is over its share, and the lookup still finds all."""
    rows = spark.range(1_000).select(
        F.col("id").alias("doc"), (F.col("id") % 50).cast("string").alias("term")
    )
    table = rows.groupBy("term").agg(F.count("*").alias("n"))
    for hot_keys in (1, 10, 49, 51, 100_000):
        joined = attach_by_term(rows, table, "n", hot_keys=hot_keys)
        assert joined.where("n = 20").count() == 1_000


def test_over_long_hot_key_is_looked_up(spark):
    long_term = "x" * 5_000
    rows = spark.range(300).select(
        F.col("id").alias("doc"), F.when(F.col("id") % 3 == 0, long_term).otherwise("y").alias("term")
    )
    table = rows.groupBy("term").agg(F.count("*").alias("n"))
    joined = attach_by_term(rows, table, "n")
    assert {(r.term, r.n) for r in joined.distinct().collect()} == {(long_term, 100), ("y", 200)}


def test_rows_without_a_key_in_the_table_are_dropped(spark):
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "doc string, term string")
    table = spark.createDataFrame([("a", 5)], "term string, n bigint")
    for hint in ("shuffle_hash", "merge", "broadcast"):
        assert [tuple(r) for r in attach_by_term(rows, table, "n", join_hint=hint).collect()] == [
            ("1", "a", 5)
        ]


def test_document_names_that_look_like_markers(corpus):
    rows = [("=a", "x y"), ("#a", "x"), ("", "x z"), (" ", "y"), ("=", "z z")]
    for strategy in ("lookup", "window"):
        assert_scores(score(corpus(rows), "line", strategy), rows)


def test_postings_blocks(corpus):
    documents = {f"d{i:03}": "every " + ("some " if i % 10 == 0 else "") + f"own{i}" for i in range(200)}
    table = corpus(documents)
    lists = postings(terms_per_row(table), block_size=16).collect()
    blocks = [r for r in lists if r.term == "every"]
    assert len(blocks) == 13 and {r.block for r in blocks} == set(range(13))
    assert {r.num_docs_with_word for r in blocks} == {200}
    assert [len(r.docs) for r in sorted(blocks, key=lambda r: r.block)] == [16] * 12 + [8]
    assert [d for r in sorted(blocks, key=lambda r: r.block) for d in r.docs] == sorted(documents)
    assert all(r.docs == sorted(r.docs) for r in lists)
    assert [(r.block, r.num_docs_with_word) for r in lists if r.term == "own7"] == [(0, 1)]
    assert len({(r.term, r.block) for r in lists}) == len(lists)


def test_postings_open_to_the_same_pairs(corpus):
    table = corpus({f"d{i}": f"a b{i % 3} c{i}" for i in range(50)})
    lists = postings(terms_per_row(table), block_size=5)
    pairs = {(r.doc, r.term) for r in term_counts(table).collect()}
    opened = explode_postings(lists).collect()
    assert {(r.doc, r.term) for r in opened} == pairs and len(opened) == len(pairs)


def test_heavy_postings_are_in_order(spark, rows):
    from termloom.operators.postings import doc_bounds, from_gaps, spanning, with_gaps
    from termloom.operators.totals import heavy_groups

    pairs = rows.select(F.xxhash64("doc").alias("doc"), "term").distinct()
    heavy, bounds = heavy_groups(pairs, "term", 16), doc_bounds(pairs)
    assert heavy == {"=hot": 16} and len(bounds) > 30
    lists = postings(pairs, 16, heavy, bounds).collect()
    expected = sorted(r.doc for r in pairs.where("term = 'hot'").collect())
    blocks = sorted((r for r in lists if r.term == "hot"), key=lambda r: r.block)
    assert [r.block for r in blocks] == list(range(len(blocks))) and max(len(r.docs) for r in blocks) <= 16
    assert [d for r in blocks for d in r.docs] == expected
    assert {r.num_docs_with_word for r in blocks} == {len(expected)}
    # Gaps give the lists back, and blocks that cannot hold a document are left out.
    gaps = with_gaps(postings(pairs, 16, heavy, bounds))
    again = {(r.term, r.block): r.docs for r in from_gaps(gaps).collect()}
    assert again == {(r.term, r.block): r.docs for r in lists}
    low, high = expected[100], expected[130]
    some = spanning(gaps, low, high).where("term = 'hot'").collect()
    assert 0 < len(some) < len(blocks) / 4
    assert {r.block for r in blocks if any(low <= d <= high for d in r.docs)} <= {r.block for r in some}


def test_heavy_group_total_in_few_tasks(static_plans, rows):
    """A list of heavy groups that is wrong changes no total."""
    for heavy in ({}, {"=hot": 7, "=t5": 3, "=nothing": 9}, {"=d1": 2}):
        total = with_group_total(rows, "term", "doc", F.lit(1), "n", heavy)
        assert total.count() == ROWS
        assert total.where("n <> CASE WHEN term = 'hot' THEN 2000 ELSE 1 END").count() == 0


def test_sample_finds_heavy_terms(spark):
    from termloom.operators.totals import brief, heavy_terms

    long = "x" * 2_000
    texts = spark.range(4_000, numPartitions=50).select(
        F.col("id").alias("doc"), F.concat(F.lit(f"every\t{long} own"), F.col("id").cast("string")).alias("text")
    )
    heavy = heavy_terms(texts, 64)
    key = spark.range(1).select(brief(F.lit(long)).alias("k")).first().k
    assert heavy == {"=every": 64, key: 64}
    assert heavy_terms(texts.where("false"), 64) == {}
    assert heavy_terms(texts.withColumn("text", F.lit(None).cast("string")), 64) == {}
