"""What a task has must not grow with the corpus."""

from __future__ import annotations

import pytest
from brute_force import assert_scores
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from termloom import score, term_counts_with_size
from termloom.plans.scoring import least_broadcast
from termloom.sinks.report import key_bounds
from termloom.sources import tables

ROWS = [(f"d{i}", f"every {'some ' * (i % 3)}own{i} own{i} x{i % 7}") for i in range(60)]


@pytest.mark.parametrize("room", [60, 1_000])
def test_broadcast_takes_what_there_is_room_for(corpus, room):
    """the most frequent terms are broadcast, the others looked up."""
    table = corpus(ROWS)
    assert_scores(score(table, strategy="broadcast", max_broadcast_bytes=room, overflow="shuffle"), ROWS)
    assert_scores(score(table, "line", "broadcast", max_broadcast_bytes=room, overflow="shuffle"), ROWS)


def test_room_for_terms(spark):
    rows = [("a", 9), ("b", 8), ("c", 7), ("d", 1), ("e", 1)]
    frequency = spark.createDataFrame(rows, "term string, num_docs_with_word bigint")
    # Each takes 65 bytes.
    assert [least_broadcast(frequency, most) for most in (64, 129, 130, 195, 324, 325)] == [16, 16, 8, 2, 2, 0]
    assert least_broadcast(frequency.where("false"), 0) == 0


def test_overflow_is_known(corpus):
    with pytest.raises(ValueError, match="overflow"):
        score(corpus(ROWS), strategy="broadcast", overflow="other")


@pytest.fixture
def small_parts(monkeypatch):
    """Partitions of 2 KB of text."""
    monkeypatch.setattr(tables.partitions_for, "__defaults__", (2_048,))


def test_partitions_follow_the_bytes(corpus):
    table = corpus([("a", "x" * 1_000), ("b", None), (None, "y" * 500)])
    assert [tables.partitions_for(table, 3, size) for size in (10, 499, 1_000)] == [150, 4, 3]
    assert tables.partitions_for(table.where("false"), 3) == 3


@pytest.mark.parametrize("name", ["term_counts_chunked", "term_counts_with_size_chunked", "tfidf_chunked"])
def test_chunked_counts_are_dealt_by_bytes(static_plans, sf_dir, small_parts, name):
    """as many tasks as the texts need, and no lookup of sizes."""
    plan = spark_entry.queries()[name](static_plans, sf_dir)._jdf.queryExecution().executedPlan().toString()
    texts = static_plans.read.parquet(f"{sf_dir}/documents.parquet")
    parts = tables.partitions_for(texts, 1)
    assert parts > 3 * static_plans.sparkContext.defaultParallelism
    assert f"{parts}), REPARTITION_BY_NUM" in plan and "probe" not in plan


@pytest.mark.parametrize("by_frequency", [False, True])
def test_buckets_follow_the_bytes(static_plans, sf_dir, small_parts, monkeypatch, by_frequency):
    """a bucket is sorted by one task."""
    asked = []
    save = spark_entry.stages.save_counts
    monkeypatch.setattr(spark_entry.stages, "save_counts", lambda *a: (asked.append(a[2]), save(*a)))
    monkeypatch.setattr(spark_entry, "_cores", lambda spark: 1)
    raw = static_plans.read.parquet(f"{sf_dir}/documents.parquet").limit(12)
    monkeypatch.setattr(spark_entry, "_raw_documents", lambda *a: raw.select(F.col("doc_id").alias("doc"), "text"))
    spark_entry._score_buckets(by_frequency)(static_plans, sf_dir)
    size = raw.agg(F.sum(F.octet_length("text"))).first()[0]
    assert asked == [-(-size // 2_048)] and asked[0] > 1


def test_bounds_come_from_all_documents(spark):
    """documents of one long partition, of which the first ones only tell little."""
    docs = spark.range(20_000, numPartitions=1).select(
        (F.col("id") + 10_000).alias("doc"), F.concat(F.lit("a b "), F.col("id").cast("string")).alias("text")
    )
    bounds = key_bounds(docs, 10)
    assert len(bounds) == 9
    ranges = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("doc").cast("string")))
    sizes = [r["count"] for r in docs.groupBy(ranges).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 20_000 / 10


def test_chunked_sizes_of_repeated_documents(spark):
    """Long rows of one document count as one."""
    rows = [("a", "x y x " * 20), ("a", "x z " * 20), ("b", "y"), ("n", None), (None, "x " * 50)]
    table = spark.createDataFrame(rows, "doc string, text string")
    found = {tuple(r) for r in term_counts_with_size(table, 10).collect()}
    assert found == {("a", "x", 60, 100), ("a", "y", 20, 100), ("a", "z", 20, 100), ("b", "y", 1, 1)}


def test_texts_in_enough_splits_are_not_shuffled_for_a_join(static_plans, sf_dir, tmp_path):
    """F8."""
    path = str(tmp_path / "documents.parquet")
    static_plans.read.parquet(f"{sf_dir}/documents.parquet").repartition(40).write.parquet(path)
    static_plans.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        joined = spark_entry.queries()["tf_idf_join"](static_plans, str(tmp_path))
        assert "REPARTITION_BY_NUM" not in joined._jdf.queryExecution().executedPlan().toString()
        pairs = spark_entry.queries()["tfidf"](static_plans, str(tmp_path))
        assert joined.count() == pairs.count()
    finally:
        static_plans.conf.unset("spark.sql.files.openCostInBytes")
