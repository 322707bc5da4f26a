"""A corpus out of any table that Spark can read."""

from __future__ import annotations

import heapq
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lanes that documents are dealt to for each partition.
LANES = 64
# Bytes of text that a partition should hold; its terms and their counts take many times that.
PART_BYTES = 16 << 20


def corpus_from(table: DataFrame, doc: str, text: str) -> DataFrame:
    """``(doc, text)`` of a table; only these two columns are read.

    At document grain ``doc`` must be unique; at line grain a document may be
    spread over any number of rows.
    """
    return table.select(F.col(doc).alias("doc"), F.col(text).alias("text"))


def partitions_for(corpus: DataFrame, least: int, part_bytes: int = PART_BYTES) -> int:
    """Partitions of about ``part_bytes`` of text each, but ``least`` at least.

    Runs a job that adds up the texts' lengths: what a task has of a corpus must not
    grow with the corpus.
    """
    size = corpus.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, ceil(size / part_bytes))


def widen(corpus: DataFrame, partitions: int, *by: str) -> DataFrame:
    """Spread a corpus that comes in too few splits over ``partitions``.

    Cutting texts into terms is the costly step, and one small file (or one big
    Parquet row group) would run it in one task. This shuffles the texts, so call
    it for such inputs only. ``by`` names a column without hot values (the
    document at document grain); without it rows are dealt out evenly.
    """
    return corpus.repartition(partitions, *by)


def deal_by_bytes(corpus: DataFrame, partitions: int) -> DataFrame:
    """Spread a corpus over ``partitions`` of about the same number of bytes of text.

    Documents go to lanes by a hash, many for each partition; the lanes' sizes, a row
    each, are added up by a job, and the lanes packed into partitions, the largest
    first. Texts are shuffled once. Only a document that is larger than a partition's
    share makes a larger one.
    """
    lanes = LANES * partitions
    lane = F.pmod(F.xxhash64(F.coalesce(F.col("doc").cast("string"), F.col("text"))), F.lit(lanes)).cast("int")
    sizes = corpus.groupBy(lane.alias("lane")).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"))
    place = [k % partitions for k in range(lanes)]
    loads = [(0, k) for k in range(partitions)]
    for row in sorted(sizes.collect(), key=lambda r: (-r["size"], r.lane)):
        load, part = heapq.heappop(loads)
        place[row.lane] = part
        heapq.heappush(loads, (load + row["size"], part))
    table = corpus.sparkSession.createDataFrame(list(enumerate(place)), "_lane int, _part int")
    dealt = corpus.withColumn("_lane", F.coalesce(lane, F.lit(0))).join(F.broadcast(table), "_lane")
    return dealt.repartitionById(partitions, F.col("_part")).select(*corpus.columns)
