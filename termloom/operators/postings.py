"""Posting lists: for each term, the documents that hold it, in order.

The list of a very common term would be an array as long as the corpus. Lists are
therefore cut into blocks of up to ``block_size`` documents, numbered in the order of
their documents: read block after block, a list is sorted. A term with no more documents
than that, which is nearly every term, has one block with number 0.

Pairs are shuffled once, by term, and counted, ranked and listed where they then are.
Heavy terms are cut into slices by ranges of documents; in each slice a new block begins.
"""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.totals import (
    SAMPLED_PARTITIONS,
    Heavy,
    brief,
    keys_of,
    slice_sums,
    total_of_slices,
)

BLOCK_SIZE = 65_536
# Slices of a heavy term at most.
RANGES = 64
_SAMPLED_DOCS = 1_024


def doc_bounds(pairs: DataFrame, ranges: int = RANGES) -> list:
    """Documents that cut the corpus into about ``ranges`` parts, out of a bounded sample; runs a job."""
    docs = pairs.select("doc").where("doc IS NOT NULL").rdd
    count = docs.getNumPartitions()
    chosen = sorted({k * count // SAMPLED_PARTITIONS for k in range(SAMPLED_PARTITIONS)}) if count else []
    most = _SAMPLED_DOCS
    found = docs.context.runJob(docs, lambda part: [r[0] for r in islice(part, most)], chosen)
    found = sorted(set(found))
    step = max(1, len(found) // ranges)
    return found[step::step][: ranges - 1]


def _ranged(pairs: DataFrame, heavy: Heavy, bounds: list) -> DataFrame:
    """Pairs with ``slice`` and ``slices``, shuffled by them: heavy terms by ranges of documents."""
    keys = [(k,) for k in heavy]
    table = F.broadcast(pairs.sparkSession.createDataFrame(keys, "heavy_key string"))
    joined = pairs.join(table, brief(F.col("term")) == F.col("heavy_key"), "left")
    # How many of the bounds are not after the document; only looked for in heavy terms.
    place = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound <= F.col("doc")))
    is_heavy = F.col("heavy_key").isNotNull()
    return joined.select(
        "doc",
        "term",
        F.when(is_heavy & F.col("doc").isNotNull(), place).otherwise(0).alias("slice"),
        F.when(is_heavy, len(bounds) + 1).otherwise(1).alias("slices"),
    ).repartition("term", "slice")


def postings(
    pairs: DataFrame,
    block_size: int = BLOCK_SIZE,
    heavy: Heavy | None = None,
    bounds: list | None = None,
) -> DataFrame:
    """``(term, block, num_docs_with_word, docs)``, ``docs`` in order within and over blocks.

    ``pairs`` has one row per distinct ``(doc, term)``; ``num_docs_with_word`` counts the
    whole list, not the block. ``heavy`` are its ``heavy_groups``, ``bounds`` its
    ``doc_bounds``; without them each list is made by one task, in blocks.
    """
    pairs = pairs.select("doc", "term")
    total = "num_docs_with_word"
    dealt = _ranged(pairs, heavy, bounds) if heavy and bounds else pairs
    keys = keys_of(dealt, "term")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("doc")) - 1
    counted = total_of_slices(dealt.withColumn("block", F.floor(rank / F.lit(block_size))), "term", F.lit(1), total)
    lists = counted.groupBy(*keys, "block").agg(
        F.first(total).alias(total), F.sort_array(F.collect_list("doc")).alias("docs")
    )
    if len(keys) > 1:
        lists = _numbered(lists, dealt, block_size)
    return lists.select("term", "block", total, "docs")


def _numbered(lists: DataFrame, dealt: DataFrame, block_size: int) -> DataFrame:
    """``lists`` with blocks counted over a term's slices, by a small table of the slices of heavy terms."""
    sums = slice_sums(dealt, "term", F.count("*"))
    earlier = Window.partitionBy("term").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    blocks = F.ceil(F.col("slice_total") / F.lit(block_size))
    before = sums.select(
        F.col("term").alias("_term"), F.col("slice").alias("_slice"), F.sum(blocks).over(earlier).alias("_before")
    )
    # Fewer rows than RANGES for each heavy term. Nulls are compared to put no filter below the shared shuffle.
    same = F.col("term").eqNullSafe(F.col("_term")) & F.col("slice").eqNullSafe(F.col("_slice"))
    joined = lists.join(F.broadcast(before), same, "left")
    return joined.withColumn("block", F.col("block") + F.coalesce("_before", F.lit(0)))


def explode_postings(lists: DataFrame) -> DataFrame:
    """Back to ``(term, doc, num_docs_with_word)``, one row per document in a list."""
    return lists.select("term", F.explode("docs").alias("doc"), "num_docs_with_word")


def with_gaps(lists: DataFrame) -> DataFrame:
    """Lists of whole numbers as ``first_doc, last_doc, gaps`` in place of ``docs``.

    ``gaps`` are the differences from each document to the next. Saved in this form, a
    block says what it spans: a search for some documents reads no others.
    """
    docs = F.col("docs")
    gaps = F.zip_with(F.slice(docs, F.lit(2), F.size(docs)), docs, lambda after, doc: after - doc)
    return lists.select(
        *(c for c in lists.columns if c != "docs"),
        F.element_at(docs, 1).alias("first_doc"),
        F.element_at(docs, -1).alias("last_doc"),
        F.slice(gaps, F.lit(1), F.size(docs) - 1).alias("gaps"),
    )


def from_gaps(lists: DataFrame) -> DataFrame:
    """``docs`` again, in place of ``first_doc, last_doc, gaps``: a running sum, by rows."""
    names = [c for c in lists.columns if c not in ("first_doc", "last_doc", "gaps")]
    steps = lists.select(*names, F.posexplode(F.concat(F.array("first_doc"), "gaps")).alias("at", "step"))
    run = Window.partitionBy("term", "block").orderBy("at")
    docs = steps.select(*names, F.sum("step").over(run).alias("doc"))
    return docs.groupBy(*names).agg(F.sort_array(F.collect_list("doc")).alias("docs"))


def spanning(lists: DataFrame, low, high) -> DataFrame:
    """The blocks of ``with_gaps`` that may hold documents from ``low`` to ``high``; a filter that files can skip by."""
    return lists.where((F.col("last_doc") >= F.lit(low)) & (F.col("first_doc") <= F.lit(high)))
