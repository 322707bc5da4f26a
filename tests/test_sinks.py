"""Outputs in order, replaced without a gap, and documents dealt by bytes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from termloom import report, score, write_report
from termloom.sinks.report import key_bounds
from termloom.sinks.versions import current_version, drop_others, load_current, publish
from termloom.sources.stages import stage_path
from termloom.sources.tables import deal_by_bytes


@pytest.mark.parametrize("ranges", [2, 7, 300])
def test_total_order_by_bounds(spark, corpus, tmp_path, ranges):
    rng = random.Random(ranges)
    documents = {f"doc{i}": " ".join(rng.choice(["B", "a", "z", "é", "@", "日", "\U0001f600"]) for _ in range(9)) for i in range(120)}
    table = corpus(documents)
    bounds = key_bounds(table, ranges)
    assert 0 < len(bounds) < ranges and bounds == sorted(set(bounds), key=str.encode)
    lines = report(score(table), bounds=bounds)
    assert lines.rdd.getNumPartitions() == len(bounds) + 1
    target = str(tmp_path / "out")
    write_report(lines, target)
    files = sorted((tmp_path / "out").glob("part-*"), key=lambda f: f.name)
    found = [line for f in files for line in f.read_text().splitlines()]
    expected = [f"{r.key}\t{r.value_text}" for r in report(score(table)).collect()]
    assert found == expected and len(files) > 1
    # A range shuffle would run what is below it once more, for its sample.
    assert "rangepartitioning" not in lines._jdf.queryExecution().executedPlan().toString()


def test_report_of_nothing(corpus):
    table = corpus([("d", None), ("e", "")])
    assert key_bounds(table) == []
    assert report(score(table), bounds=[]).count() == 0


def test_failed_run_leaves_the_old_version(spark):
    path = stage_path(spark)
    with pytest.raises(FileNotFoundError):
        load_current(spark, path)
    first = publish(spark.range(10), path)
    assert current_version(spark, path) == first and load_current(spark, path).count() == 10
    old = load_current(spark, path)
    broken = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("in mid-write"))).alias("id")
    )
    with pytest.raises(Exception, match="in mid-write"):
        publish(broken, path)
    assert current_version(spark, path) == first and load_current(spark, path).count() == 10
    second = publish(spark.range(20), path)
    assert second != first and load_current(spark, path).count() == 20
    # Who had begun to read goes on with the old one, until it is dropped.
    assert old.count() == 10
    assert drop_others(spark, path) >= 1 and load_current(spark, path).count() == 20
    publish(spark.range(0), path)
    assert load_current(spark, path).count() == 0


@pytest.mark.parametrize("partitions", [3, 8])
def test_documents_are_dealt_by_bytes(spark, partitions):
    rng = random.Random(partitions)
    rows = [(f"d{i}", "word " * int(20_000 ** rng.random())) for i in range(1_500)] + [("null", None), (None, "x"), (None, None)]
    table = spark.createDataFrame(rows, "doc string, text string")
    dealt = deal_by_bytes(table, partitions)
    assert dealt.columns == table.columns and dealt.count() == len(rows)
    assert dealt.exceptAll(table).count() == 0
    sizes = dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("text")).alias("n")).collect()
    mean = sum(r.n for r in sizes) / partitions
    assert len(sizes) == partitions and max(r.n for r in sizes) <= 1.2 * mean
    assert deal_by_bytes(table.where("false"), partitions).count() == 0
