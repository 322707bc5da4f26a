"""The composed query: tfidf of every (document, term) pair of a corpus.

    tfidf = word_count / doc_size * ln(num_docs / num_docs_with_word)

They differ in how ``num_docs_with_word`` finds its way to the pairs:

``window`` (default)
    Texts are read and cut into terms once, and the pairs shuffled once, by term and
    slice; frequencies are totals over what lies together then. Terms that would
    unbalance this shuffle are found in a bounded sample first, by a small job that
    runs when this is called, and cut into slices.
``lookup``
    A frequency table, and a shuffled lookup with the hot terms broadcast. Texts are
    read twice; hot terms come from exact counts.
``broadcast``
    The whole vocabulary broadcast; no shuffle of the pairs. Its size is measured
    first, by a job that runs when this is called. A vocabulary that is too large is
    refused, or, with ``overflow="shuffle"``, its most frequent terms are broadcast as
    far as there is room and the others looked up as by ``lookup``.
``join``
    TF and IDF tables joined on (document, term).
``product``
    TF and IDF tables stacked and multiplied per (document, term).

On a corpus in which documents are as the grain says, all give the same rows.
``window``, ``lookup`` and ``broadcast`` return all columns of the record; the
other two return ``doc``, ``term`` and ``tfidf``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.weights import tfidf
from termloom.operators.combine import (
    idf_table,
    join_values,
    product_of_values,
    stacked_values,
    tf_table,
)
from termloom.operators.chunks import bounded_lines
from termloom.operators.counts import (
    check_grain,
    chunk_counts_with_size,
    doc_sizes,
    line_counts,
    num_docs,
    sizes_of_counts,
    term_counts,
    term_counts_with_size,
)
from termloom.operators.frequency import doc_freq, doc_freq_of_counts
from termloom.operators.lookup import attach_by_doc, attach_by_term
from termloom.operators.tokens import terms_per_row
from termloom.operators.totals import Heavy, heavy_groups, heavy_terms, keys_of, sliced, total_of_slices, with_group_total

STRATEGIES = ("window", "lookup", "broadcast", "join", "product")

# What becomes of a vocabulary that is too large for a broadcast.
OVERFLOWS = ("refuse", "shuffle")

# A broadcast is held by every executor and built by the driver.
BROADCAST_BYTES = 64 * 1024 * 1024
# Room that a row takes in a broadcast table beside its term.
_ROW_BYTES = 64


def check_unique(corpus: DataFrame) -> None:
    """Refuse a corpus in which a document has more than one row. Runs a job."""
    twice = corpus.groupBy("doc").count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"document {twice.doc!r} has {twice['count']} rows; use grain='line'")


def counts_and_frequency(
    corpus: DataFrame, grain: str, join_hint: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(doc, term, word_count, doc_size)`` and ``(term, num_docs_with_word)``."""
    if grain == "document":
        return term_counts_with_size(corpus), doc_freq(corpus)
    counts = term_counts(corpus, grain)
    sized = attach_by_doc(counts, sizes_of_counts(counts), "doc_size", join_hint=join_hint)
    return sized, doc_freq_of_counts(counts)


def merged_line_counts(corpus: DataFrame, heavy: Heavy | None = None, chunk_bytes: int | None = None) -> DataFrame:
    """``(doc, term, word_count)`` lying by term and slice; texts are read once, rows shuffled once.

    Lines are counted where they are read, and their counts added up behind the shuffle.
    """
    parts = line_counts(corpus, chunk_bytes)
    dealt = sliced(parts, "term", "doc", heavy) if heavy else parts.repartition("term")
    return dealt.groupBy(*keys_of(dealt, "term"), "doc").agg(F.sum("word_count").alias("word_count"))


def counts_with_totals(
    corpus: DataFrame, grain: str, heavy: Heavy | None = None, chunk_bytes: int | None = None
) -> DataFrame:
    """``(doc, term, word_count, doc_size, num_docs_with_word)`` by group totals.

    At document grain texts are read once and pairs shuffled once; for chunks once more,
    by document, unless the corpus lies so. At line grain the sizes of documents come from
    a second reading, which counts terms and shuffles a row for each document and task;
    they are looked up by a second shuffle of the pairs.
    """
    total = "num_docs_with_word"
    if grain == "document":
        if chunk_bytes is None:
            sized = term_counts_with_size(corpus)
        else:
            sized = chunk_counts_with_size(corpus, chunk_bytes)
        return with_group_total(sized, "term", "doc", F.lit(1), total, heavy)
    held = total_of_slices(merged_line_counts(corpus, heavy, chunk_bytes), "term", F.lit(1), total)
    lines = corpus if chunk_bytes is None else bounded_lines(corpus, chunk_bytes)
    return attach_by_doc(held.select("doc", "term", "word_count", total), doc_sizes(lines, "line"), "doc_size")


def least_broadcast(frequency: DataFrame, max_bytes: int = BROADCAST_BYTES) -> int:
    """The least frequency of the terms that fit a broadcast, most frequent ones first; 0 if all do.

    Runs a job. Frequencies are told apart by their powers of two, so at most 64 rows
    come back to the driver.
    """
    power = F.length(F.bin("num_docs_with_word"))
    size = F.sum(F.octet_length("term") + F.lit(_ROW_BYTES)).alias("size")
    taken = 0
    for row in sorted(frequency.groupBy(power.alias("power")).agg(size).collect(), key=lambda r: -r.power):
        taken += row["size"]
        if taken > max_bytes:
            return 1 << row.power
    return 0


def _counts_with_lookup(
    corpus: DataFrame, grain: str, strategy: str, max_bytes: int, join_hint: str | None, overflow: str
) -> DataFrame:
    """The columns of ``counts_with_totals``, by a lookup of the frequencies."""
    counts, frequency = counts_and_frequency(corpus, grain, join_hint)
    if strategy == "broadcast":
        least = least_broadcast(frequency, max_bytes)
        if least == 0:
            return counts.join(F.broadcast(frequency), "term")
        if overflow == "refuse":
            raise ValueError(f"the vocabulary takes more than {max_bytes} bytes; use 'lookup' or overflow='shuffle'")
        hot = F.col("num_docs_with_word") >= least
        return attach_by_term(counts, frequency, "num_docs_with_word", join_hint=join_hint, hot=hot)
    return attach_by_term(counts, frequency, "num_docs_with_word", join_hint=join_hint)


def idf_of_pairs(pairs: DataFrame, docs: Column, heavy: Heavy | None = None) -> DataFrame:
    """``(doc, term, idf)`` for every distinct pair; frequencies are totals over the pairs."""
    total = "num_docs_with_word"
    held = with_group_total(pairs.select("doc", "term"), "term", "doc", F.lit(1), total, heavy)
    return idf_table(held, docs)


def score(
    corpus: DataFrame,
    grain: str = "document",
    strategy: str = "window",
    documents: DataFrame | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    join_hint: str | None = None,
    check: bool = False,
    heavy: Heavy | None = None,
    chunk_bytes: int | None = None,
    overflow: str = "refuse",
) -> DataFrame:
    """Score a corpus of ``(doc, text)``; see the module's text for strategies.

    Rows without a document belong to none and are left out. At document grain
    ``doc`` must be unique: strategies differ on rows that share one. ``check``
    runs a job that makes sure of it; send tables that are not to line grain.

    ``documents`` is a table with one row per document, if there is one that is
    cheaper to count than the corpus (``list_documents`` for files).
    ``join_hint`` is a Spark join hint for the shuffled lookups; see
    ``termloom.operators.lookup`` for when ``"shuffle_hash"`` fits. ``heavy`` are the
    ``heavy_terms`` of the corpus, found here unless given.

    ``chunk_bytes`` is for the strategies ``window`` and ``product``: rows with longer
    texts are counted in chunks, so that a task never has the terms of a whole one.

    ``overflow`` is for the strategy ``broadcast``: ``"refuse"`` or ``"shuffle"``.

    Columns: ``doc, term, word_count, doc_size, num_docs, num_docs_with_word,
    tfidf``. Terms that are in every document score 0 and are kept.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if overflow not in OVERFLOWS:
        raise ValueError(f"overflow must be one of {OVERFLOWS}, not {overflow!r}")
    check_grain(grain)
    corpus = corpus.where("doc IS NOT NULL")
    if check and grain == "document":
        check_unique(corpus)
    counted = num_docs(corpus, grain) if documents is None else num_docs(documents)
    docs = counted.scalar()

    if strategy in ("lookup", "broadcast", "join"):
        if chunk_bytes is not None:
            raise ValueError("chunk_bytes needs strategy 'window' or 'product'")
    if strategy in ("window", "join", "product") and heavy is None:
        heavy = heavy_terms(corpus)

    if strategy == "join":
        counts, _ = counts_and_frequency(corpus, grain)
        pairs = terms_per_row(corpus) if grain == "document" else counts
        return join_values(tf_table(counts), idf_of_pairs(pairs, docs, heavy))

    if strategy == "product":
        return product_of_values(stacked_values(counts_with_totals(corpus, grain, heavy, chunk_bytes), docs))

    if strategy == "window":
        matched = counts_with_totals(corpus, grain, heavy, chunk_bytes)
    else:
        matched = _counts_with_lookup(
            corpus, grain, strategy, max_broadcast_bytes, join_hint, overflow
        )
    return _scored(matched, docs)


def score_counts(counts: DataFrame, documents: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Score saved counts: ``(doc, term, word_count, doc_size)``, as ``score`` does.

    For jobs that write ``term_counts_with_size`` once and read it again, so that
    texts are cut into terms once only. ``documents`` has one row per document,
    those without terms too. Counts of ``save_counts`` lie by term already and are not
    shuffled (``heavy={}`` says that no look for heavy terms is needed); others are, once.
    """
    if "slice" in counts.columns:
        matched = total_of_slices(counts, "term", F.lit(1), "num_docs_with_word")
    else:
        heavy = heavy_groups(counts, "term") if heavy is None else heavy
        matched = with_group_total(counts, "term", "doc", F.lit(1), "num_docs_with_word", heavy)
    return _scored(matched, num_docs(documents).scalar())


def score_with_frequency(counts: DataFrame, frequency: DataFrame, documents: DataFrame) -> DataFrame:
    """Score saved counts by a saved frequency table, for example one that is kept up to date.

    Tables of ``save_counts`` (without heavy terms) and ``save_frequency`` with as many
    buckets are joined where they lie.
    """
    matched = counts.join(frequency.select("term", "num_docs_with_word"), "term")
    return _scored(matched, num_docs(documents).scalar())


def _scored(matched: DataFrame, docs: Column) -> DataFrame:
    weight = tfidf(
        F.col("word_count"), F.col("doc_size"), F.col("num_docs"), F.col("num_docs_with_word")
    )
    return matched.withColumn("num_docs", docs).select(
        "doc",
        "term",
        "word_count",
        "doc_size",
        "num_docs",
        "num_docs_with_word",
        weight.alias("tfidf"),
    )
