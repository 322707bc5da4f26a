"""A corpus of random words for load tests, generated inside Spark.

Every word is a hash of its seed, document, row and column: any task can make
its words without the others, a retried task makes the same ones, and another
engine can check them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The shape of a generated document.
ROWS_PER_DOCUMENT = 50
WORD_LENGTHS = (5, 6, 7, 8, 5)


def document_ids(spark: SparkSession, count: int) -> DataFrame:
    """``doc`` from 1 to ``count``."""
    return spark.range(1, count + 1).select(F.col("id").alias("doc"))


def synthetic_words(ids: DataFrame, seed: int = 42) -> DataFrame:
    """``(doc, row, col, word)``: 50 rows of 5 words for each document in ``ids``."""
    rows = F.sequence(F.lit(0), F.lit(ROWS_PER_DOCUMENT - 1))
    cols = F.sequence(F.lit(0), F.lit(len(WORD_LENGTHS) - 1))
    lengths = F.array(*map(F.lit, WORD_LENGTHS))
    digest = F.md5(F.concat_ws("-", F.lit(seed), "doc", "row", "col"))
    return (
        ids.select("doc", F.explode(rows).alias("row"))
        .select("doc", "row", F.explode(cols).alias("col"))
        .select("doc", "row", "col", F.substring(digest, F.lit(1), F.get(lengths, F.col("col"))).alias("word"))
    )


def synthetic_corpus(ids: DataFrame, seed: int = 42) -> DataFrame:
    """The same words as ``(doc, text)``, one row per document, without a shuffle."""

    def word(row, col):
        digest = F.md5(F.concat_ws("-", F.lit(seed), "doc", row, F.lit(col)))
        return F.substring(digest, 1, WORD_LENGTHS[col])

    def line(row):
        return F.concat_ws(" ", *(word(row, col) for col in range(len(WORD_LENGTHS))))

    rows = F.sequence(F.lit(0), F.lit(ROWS_PER_DOCUMENT - 1))
    text = F.concat(F.array_join(F.transform(rows, line), "\n"), F.lit("\n"))
    return ids.select("doc", text.alias("text"))
