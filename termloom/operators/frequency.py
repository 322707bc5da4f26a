"""How many documents hold a term.

All of these count on the map side first: a shuffle carries at most one row per
term and task, however common the term is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.counts import check_grain, term_counts
from termloom.operators.tokens import terms_per_row


def doc_freq(corpus: DataFrame, grain: str = "document") -> DataFrame:
    """``(term, num_docs_with_word)``."""
    check_grain(grain)
    pairs = terms_per_row(corpus) if grain == "document" else term_counts(corpus, grain)
    return pairs.groupBy("term").agg(F.count("*").alias("num_docs_with_word"))


def doc_freq_of_counts(counts: DataFrame) -> DataFrame:
    """``(term, num_docs_with_word)`` out of ``(doc, term, word_count)``.

    The filter is true for every term, whatever its counts are, since a hash is
    never NULL. It keeps ``word_count`` in use, so that this branch and the one
    that joins it have the same shuffle of ``counts`` below them and Spark runs
    that shuffle once.
    """
    return (
        counts.groupBy("term")
        .agg(F.count("*").alias("num_docs_with_word"), F.max(F.xxhash64("word_count")).alias("used"))
        .where("used IS NOT NULL")
        .drop("used")
    )


def partial_doc_freq(corpus: DataFrame, part: Column) -> DataFrame:
    """``(part, term, num_docs_with_word)``: frequencies of each part of a corpus.

    Document grain; ``part`` is an expression on the document, for example the
    worker, day or source that it belongs to.
    """
    return (
        terms_per_row(corpus)
        .groupBy(part.alias("part"), "term")
        .agg(F.count("*").alias("num_docs_with_word"))
    )


def merge_doc_freq(*tables: DataFrame) -> DataFrame:
    """Add up frequency tables of corpora that share no document.

    Each table has ``term`` and ``num_docs_with_word``; a term may come more
    than once in it, as in the result of ``partial_doc_freq``.
    """
    columns = ("term", "num_docs_with_word")
    stacked = reduce(DataFrame.unionByName, (t.select(*columns) for t in tables))
    return stacked.groupBy("term").agg(F.sum("num_docs_with_word").alias("num_docs_with_word"))


def doc_freq_changes(
    added: DataFrame | None = None, removed: DataFrame | None = None, grain: str = "document"
) -> DataFrame:
    """``(term, change)``: what documents that come and go do to the frequencies, zeros left out.

    A document that is replaced is removed with its old text and added with its new
    one. At document grain a document must not come twice on a side.
    """
    check_grain(grain)
    sides = []
    for corpus, sign in ((added, 1), (removed, -1)):
        if corpus is not None:
            held = doc_freq(corpus.where("doc IS NOT NULL"), grain)
            sides.append(held.select("term", (F.col("num_docs_with_word") * F.lit(sign)).alias("change")))
    if not sides:
        raise ValueError("give the documents that are added, removed, or both")
    stacked = reduce(DataFrame.unionByName, sides)
    return stacked.groupBy("term").agg(F.sum("change").alias("change")).where("change <> 0")


def updated_doc_freq(frequency: DataFrame, *changes: DataFrame) -> DataFrame:
    """``frequency`` after some ``doc_freq_changes``, terms that no document holds left out.

    Costs the vocabulary and the changes, not the corpus. A frequency below zero, which
    a removal of documents that were never there makes, is an error.
    """
    columns = F.col("term"), F.col("num_docs_with_word")
    rows = [frequency.select(*columns)]
    rows += [c.select("term", F.col("change").alias("num_docs_with_word")) for c in changes]
    summed = reduce(DataFrame.unionByName, rows).groupBy("term").agg(F.sum("num_docs_with_word").alias("n"))
    checked = F.when(F.col("n") >= 0, F.col("n")).otherwise(
        F.raise_error(F.concat(F.lit("fewer documents than none hold the term "), F.col("term")))
    )
    return summed.where("n <> 0").select("term", checked.alias("num_docs_with_word"))


def doc_freq_differences(frequency: DataFrame, corpus: DataFrame, grain: str = "document") -> DataFrame:
    """``(term, kept, counted)`` where ``frequency`` is not what a new count of the corpus gives; empty if it is."""
    counted = doc_freq(corpus.where("doc IS NOT NULL"), grain).select("term", F.col("num_docs_with_word").alias("counted"))
    kept = frequency.select("term", F.col("num_docs_with_word").alias("kept"))
    return kept.join(counted, "term", "full_outer").where("NOT kept <=> counted")
