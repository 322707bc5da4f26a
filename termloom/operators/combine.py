"""TF and IDF as tables of their own, and ways to bring them together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.weights import idf, tf


def tf_table(counts: DataFrame) -> DataFrame:
    """``(doc, term, tf)`` out of ``(doc, term, word_count, doc_size)``."""
    return counts.select("doc", "term", tf(F.col("word_count"), F.col("doc_size")).alias("tf"))


def idf_table(frequency: DataFrame, docs: Column) -> DataFrame:
    """``frequency``'s rows with ``idf`` in place of the count."""
    return frequency.select(
        *(c for c in frequency.columns if c != "num_docs_with_word"),
        idf(docs, F.col("num_docs_with_word")).alias("idf"),
    )


def union_values(tf_rows: DataFrame, idf_rows: DataFrame) -> DataFrame:
    """``(doc, term, value)``: both tables stacked, two rows per pair."""
    return tf_rows.select("doc", "term", F.col("tf").alias("value")).unionByName(
        idf_rows.select("doc", "term", F.col("idf").alias("value"))
    )


def stacked_values(matched: DataFrame, docs: Column) -> DataFrame:
    """``union_values`` of both tables of ``matched``, in one pass over it.

    ``matched`` has ``doc, term, word_count, doc_size, num_docs_with_word``. Two tables
    made from one would be computed one by one; here each row gives both its values.
    """
    both = F.array(
        tf(F.col("word_count"), F.col("doc_size")), idf(docs, F.col("num_docs_with_word"))
    )
    return matched.select("doc", "term", F.explode(both).alias("value"))


def product_of_values(stacked: DataFrame) -> DataFrame:
    """``(doc, term, tfidf)``: the values of each pair multiplied."""
    return stacked.groupBy("doc", "term").agg(F.product("value").alias("tfidf"))


def join_values(tf_rows: DataFrame, idf_rows: DataFrame) -> DataFrame:
    """``(doc, term, tfidf)`` by a join on the pair, which is unique on both sides."""
    return tf_rows.join(idf_rows, ["doc", "term"]).select(
        "doc", "term", (F.col("tf") * F.col("idf")).alias("tfidf")
    )
