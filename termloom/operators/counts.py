"""Counts per document.

``grain="document"`` says that a document is one row of the corpus. Its terms
are then counted inside the row, and nothing is shuffled. ``grain="line"`` says
that a document may be any number of rows; counts then meet in a shuffle on
(document, term), after a map-side count, which neither a huge document nor a
very common term can unbalance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import has_terms, terms_of
from termloom.operators.chunks import bounded_lines, is_long
from termloom.operators.tokens import terms_per_row, tokenize

GRAINS = ("document", "line")

# A term with the blank after it, and the same again any number of times.
_RUN = r"([^ ]+ )\1*"


def check_grain(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def num_docs(corpus: DataFrame, grain: str = "document") -> DataFrame:
    """One row, ``num_docs``: documents of the corpus, those without terms too.

    Counts the corpus and not the terms, so only the ``doc`` column is read. Rows
    without a document are not counted.
    """
    check_grain(grain)
    docs = F.count("doc") if grain == "document" else F.count_distinct("doc")
    return corpus.agg(docs.alias("num_docs"))


def _runs(rows: DataFrame) -> DataFrame:
    """``(doc, term, word_count, doc_size)``: the distinct terms of each row of ``(doc, text)``, and its number of terms.

    Terms hold no blank, so a text's terms can be sorted and written as one
    string, each followed by a blank. Equal terms are then neighbours, one
    regular expression cuts the string into runs of them, and the length of a
    run tells how many there are. All of it compiles into one stage.
    """
    sorted_terms = (
        rows.select("doc", F.sort_array(terms_of("text")).alias("terms"))
        .select(
            "doc",
            F.size("terms").cast("bigint").alias("doc_size"),
            F.concat(F.array_join("terms", " "), F.lit(" ")).alias("line"),
        )
    )
    runs = sorted_terms.select(
        "doc",
        "doc_size",
        F.explode_outer(F.regexp_extract_all("line", F.lit(_RUN), F.lit(0))).alias("run"),
    ).where("run IS NOT NULL")
    term = F.substring_index("run", " ", 1)
    count = F.octet_length("run") / (F.octet_length(term) + F.lit(1))
    return runs.select(
        "doc", term.alias("term"), count.cast("bigint").alias("word_count"), "doc_size"
    )


def line_counts(corpus: DataFrame, chunk_bytes: int | None = None) -> DataFrame:
    """``(doc, term, word_count)`` of each line, or of each chunk of a long one; nothing is shuffled."""
    lines = corpus.where("doc IS NOT NULL")
    return _runs(lines if chunk_bytes is None else bounded_lines(lines, chunk_bytes)).drop("doc_size")


def chunk_counts_with_size(corpus: DataFrame, chunk_bytes: int) -> DataFrame:
    """``(doc, term, word_count, doc_size)`` at document grain, all texts counted in chunks.

    Counts meet by document; where the corpus lies by ``doc`` (``widen``) nothing is
    shuffled. Sizes are totals over the counts, which may spill, where these then are.
    """
    merged = line_counts(corpus, chunk_bytes).groupBy("doc", "term").agg(F.sum("word_count").alias("word_count"))
    return merged.withColumn("doc_size", F.sum("word_count").over(Window.partitionBy("doc")))


def term_counts_with_size(corpus: DataFrame, chunk_bytes: int | None = None) -> DataFrame:
    """``(doc, term, word_count, doc_size)`` at document grain, without a shuffle.

    With ``chunk_bytes``, texts beyond that many bytes are counted in chunks, and only
    their counts meet (``chunk_counts_with_size``); the corpus is then scanned once for
    the short texts and once for the long ones.
    """
    if chunk_bytes is None:
        return _runs(corpus)
    long = is_long(F.col("text"), chunk_bytes)
    return _runs(corpus.where(~long)).unionByName(chunk_counts_with_size(corpus.where(long), chunk_bytes))


def term_counts(corpus: DataFrame, grain: str = "document", chunk_bytes: int | None = None) -> DataFrame:
    """``(doc, term, word_count)``: one row per distinct pair.

    ``chunk_bytes`` bounds what a task has of one row of the corpus at a time.
    """
    check_grain(grain)
    if grain == "document" and chunk_bytes is None:
        return _runs(corpus).drop("doc_size")
    if grain == "document":
        long = is_long(F.col("text"), chunk_bytes)
        merged = line_counts(corpus.where(long), chunk_bytes).groupBy("doc", "term")
        counted = merged.agg(F.sum("word_count").alias("word_count"))
        return _runs(corpus.where(~long)).drop("doc_size").unionByName(counted)
    # A line without a document belongs to none. The filter stands here, in every
    # use of the counts, because joins on the document would add it to some.
    lines = corpus.where("doc IS NOT NULL")
    if chunk_bytes is not None:
        lines = bounded_lines(lines, chunk_bytes)
    return tokenize(lines).groupBy("doc", "term").agg(F.count("*").alias("word_count"))


def doc_sizes(corpus: DataFrame, grain: str = "document") -> DataFrame:
    """``(doc, doc_size)`` of the documents that have terms."""
    check_grain(grain)
    rows = corpus.where(has_terms("text")).select(
        "doc", F.size(terms_of("text")).cast("bigint").alias("doc_size")
    )
    if grain == "document":
        return rows
    return rows.where("doc IS NOT NULL").groupBy("doc").agg(F.sum("doc_size").alias("doc_size"))


def sizes_of_counts(counts: DataFrame) -> DataFrame:
    """``(doc, doc_size)`` out of ``(doc, term, word_count)``."""
    return counts.groupBy("doc").agg(F.sum("word_count").alias("doc_size"))


def vocabulary(corpus: DataFrame) -> DataFrame:
    """``term``: the distinct terms of the corpus, at either grain."""
    return terms_per_row(corpus).select("term").distinct()
