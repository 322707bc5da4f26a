"""The three formulas. Counts are BIGINT, so ``/`` divides in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tf(word_count: Column, doc_size: Column) -> Column:
    """Share of the document's terms that are this term."""
    return word_count / doc_size


def idf(num_docs: Column, num_docs_with_word: Column) -> Column:
    """Natural log, unsmoothed: 0 for a term that is in every document."""
    return F.ln(num_docs / num_docs_with_word)


def tfidf(
    word_count: Column, doc_size: Column, num_docs: Column, num_docs_with_word: Column
) -> Column:
    return tf(word_count, doc_size) * idf(num_docs, num_docs_with_word)
