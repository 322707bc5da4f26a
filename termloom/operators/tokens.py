"""Text to terms.

The arrays are exploded with ``explode_outer`` and NULL terms dropped after:
for a plain ``explode`` Catalyst adds a filter on the array's size below it,
which cuts every text into terms once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import terms_of


def tokenize(corpus: DataFrame) -> DataFrame:
    """``(doc, term)``: one row per occurrence."""
    return corpus.select("doc", F.explode_outer(terms_of("text")).alias("term")).where(
        "term IS NOT NULL"
    )


def tokens_with_size(corpus: DataFrame) -> DataFrame:
    """``(doc, term, doc_size)``: one row per occurrence; document grain only."""
    return (
        corpus.select("doc", terms_of("text").alias("terms"))
        .select("doc", F.size("terms").cast("bigint").alias("doc_size"), "terms")
        .select("doc", F.explode_outer("terms").alias("term"), "doc_size")
        .where("term IS NOT NULL")
    )


def terms_per_row(corpus: DataFrame) -> DataFrame:
    """``(doc, term)``: one row per distinct term of each input row."""
    return corpus.select(
        "doc", F.explode_outer(F.array_distinct(terms_of("text"))).alias("term")
    ).where("term IS NOT NULL")
