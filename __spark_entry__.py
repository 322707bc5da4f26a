"""

Doubles are rounded to 10 places on both sides, since the last bits of a
logarithm differ between math libraries.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from termloom.functions import keys  # noqa: E402
from termloom.operators import combine, counts, frequency, totals  # noqa: E402
from termloom.operators import postings as lists  # noqa: E402
from termloom.operators import tokens as tk  # noqa: E402
from termloom.operators.lookup import attach_by_doc  # noqa: E402
from termloom.plans import scoring  # noqa: E402
from termloom.sinks.report import key_bounds, report  # noqa: E402
from termloom.sinks.versions import load_current, publish  # noqa: E402
from termloom.sources import stages  # noqa: E402
from termloom.sources.files import names_from_paths  # noqa: E402
from termloom.sources.tables import corpus_from, deal_by_bytes, partitions_for, widen  # noqa: E402

try:
    import corpus_pipeline
    from termloom.llm import queries as llm
except ModuleNotFoundError as missing:
    # The subpackage is an option; something else that it needs is not.
    if missing.name not in ("corpus_pipeline", "termloom.llm"):
        raise
    corpus_pipeline = llm = None

SMALL_BLOCK = 100
SMALL_CHUNK = 1_024
WORKERS = 4


def _raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document grain: one row per document."""
    return corpus_from(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")


def _raw_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line grain: one row per turn, the document is the conversation."""
    return corpus_from(spark.read.parquet(f"{sf_dir}/conversations.parquet"), "conv_id", "text")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_documents(spark, sf_dir)
    return widen(raw, partitions_for(raw, _cores(spark)), "doc")


def _spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for steps that hold one row at a time: texts are shuffled only where too few tasks would read them."""
    raw = _raw_documents(spark, sf_dir)
    return raw if raw.rdd.getNumPartitions() >= _cores(spark) else widen(raw, _cores(spark), "doc")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_conversations(spark, sf_dir)
    return widen(raw, partitions_for(raw, _cores(spark)))


def _cores(spark: SparkSession) -> int:
    """The given tables are single small files, which would be cut into terms by one task."""
    return spark.sparkContext.defaultParallelism


def _num_docs(name: str, doc: str, grain: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return counts.num_docs(corpus_from(table, doc, "text"), grain)

    return query


def _round(table: DataFrame) -> DataFrame:
    """Round every DOUBLE column."""
    return table.select(
        *(F.round(c, 10).alias(c) if t == "double" else F.col(c) for c, t in table.dtypes)
    )


def _on_documents(operator: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = _round(operator(_documents(spark, sf_dir)))
        return result.withColumnRenamed("doc", "doc_id")

    return query


def _on_conversations(operator: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = _round(operator(_conversations(spark, sf_dir)))
        return result.withColumnRenamed("doc", "conv_id")

    return query


def _with_heavy_terms(operator: Callable, documents: Callable = _documents):
    """``operator`` gets the documents, and the terms to cut into slices, found before the table is spread."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        heavy = totals.heavy_terms(_raw_documents(spark, sf_dir))
        result = _round(operator(documents(spark, sf_dir), heavy))
        return result.withColumnRenamed("doc", "doc_id")

    return query


def _scores(strategy: str, documents: Callable = _documents, **options):
    def operator(corpus: DataFrame, heavy) -> DataFrame:
        scored = scoring.score(corpus, "document", strategy, heavy=heavy, **options)
        return scored.select("doc", "term", "tfidf")

    return _with_heavy_terms(operator, documents)


def _line_scores(strategy: str, **options):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        heavy = totals.heavy_terms(_raw_conversations(spark, sf_dir))
        scored = scoring.score(_conversations(spark, sf_dir), "line", strategy, heavy=heavy, **options)
        return _round(scored.select(F.col("doc").alias("conv_id"), "term", "tfidf"))

    return query


def _score_counts(corpus: DataFrame, heavy) -> DataFrame:
    """Scores of counts that were written and read again."""
    pairs = counts.term_counts_with_size(corpus)
    saved = stages.save_and_load(pairs)
    return scoring.score_counts(saved, corpus, heavy).select("doc", "term", "tfidf")


def _score_buckets(by_frequency: bool):
    """Scores of counts that were saved by term; by a saved frequency table, or by totals over the counts."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = _raw_documents(spark, sf_dir)
        # As many buckets as partitions of texts: a bucket is sorted by one task, and must not grow with the corpus.
        buckets = partitions_for(raw, _cores(spark))
        corpus = widen(raw, buckets, "doc")
        path = stages.stage_path(spark)
        name = f"termloom_{path.rsplit('-', 1)[-1]}"
        heavy = None if by_frequency else totals.heavy_terms(raw, buckets)
        stages.save_counts(counts.term_counts_with_size(corpus), f"{name}_counts", buckets, heavy, f"{path}/counts")
        saved = spark.table(f"{name}_counts")
        if by_frequency:
            stages.save_frequency(frequency.doc_freq_of_counts(saved), f"{name}_frequency", buckets, f"{path}/frequency")
            scored = scoring.score_with_frequency(saved, spark.table(f"{name}_frequency"), raw)
        else:
            scored = scoring.score_counts(saved, raw, {})
        return _round(scored.select(F.col("doc").alias("doc_id"), "term", "tfidf"))

    return query


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_documents(spark, sf_dir)
    scores = scoring.score(_documents(spark, sf_dir), heavy=totals.heavy_terms(raw))
    return report(scores, bounds=key_bounds(raw))


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term counts by documents of like bytes, published over an older version, and read again."""
    path = stages.stage_path(spark)
    corpus = deal_by_bytes(_raw_documents(spark, sf_dir), _cores(spark))
    publish(counts.doc_sizes(corpus), path)
    publish(counts.term_counts(corpus), path)
    return load_current(spark, path).withColumnRenamed("doc", "doc_id")


def _doc_freq_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies of documents and conversations, from which the conversations are taken again."""
    documents, lines = _documents(spark, sf_dir), _conversations(spark, sf_dir)
    both = frequency.merge_doc_freq(frequency.doc_freq(documents), frequency.doc_freq(lines, "line"))
    return frequency.updated_doc_freq(both, frequency.doc_freq_changes(removed=lines, grain="line"))


def _idf(corpus: DataFrame) -> DataFrame:
    return combine.idf_table(frequency.doc_freq(corpus), counts.num_docs(corpus).scalar())


def _tf(corpus: DataFrame) -> DataFrame:
    return combine.tf_table(counts.term_counts_with_size(corpus))


def _tf_idf_union(corpus: DataFrame, heavy) -> DataFrame:
    docs = counts.num_docs(corpus).scalar()
    return combine.stacked_values(scoring.counts_with_totals(corpus, "document", heavy), docs)


def _doc_freq_merge(corpus: DataFrame) -> DataFrame:
    worker = F.pmod(F.col("doc"), F.lit(WORKERS))
    return frequency.merge_doc_freq(frequency.partial_doc_freq(corpus, worker))


def _doc_freq_by_worker(corpus: DataFrame) -> DataFrame:
    worker = F.pmod(F.col("doc"), F.lit(WORKERS))
    return frequency.partial_doc_freq(corpus, worker).withColumnRenamed("part", "worker")


def _postings(block_size: int, form: Callable[[DataFrame], DataFrame] = lambda made: made):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = _raw_documents(spark, sf_dir)
        heavy = totals.heavy_terms(raw)
        bounds = lists.doc_bounds(raw) if heavy else None
        pairs = tk.terms_per_row(_documents(spark, sf_dir))
        made = lists.postings(pairs, block_size, heavy, bounds)
        return form(made).withColumnRenamed("doc", "doc_id")

    return query


def _packed(made: DataFrame) -> DataFrame:
    packed = keys.pack_postings(F.col("num_docs_with_word"), F.col("docs"))
    return made.select("term", "block", packed.alias("packed"))


def _unpacked(made: DataFrame) -> DataFrame:
    """Rows out of packed posting lists."""
    listed = _packed(made).select("term", F.explode(keys.postings_docs(F.col("packed"))).alias("doc"))
    return listed.select("term", F.col("doc").try_cast("bigint").alias("doc"))


def _exploded(made: DataFrame) -> DataFrame:
    return lists.explode_postings(made).select("term", "doc")


def _doc_freq_merge_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency tables of two corpora, each made in one pass, stacked and added up."""
    documents, lines = _documents(spark, sf_dir), _conversations(spark, sf_dir)
    return frequency.merge_doc_freq(
        frequency.doc_freq(documents), frequency.doc_freq(lines, "line")
    )


def _window_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    heavy = totals.heavy_groups(_raw_documents(spark, sf_dir), "doc", weight=F.octet_length("text"))
    pairs = counts.term_counts(_documents(spark, sf_dir))
    sized = totals.with_group_total(pairs, "doc", "term", F.col("word_count"), "doc_size", heavy)
    return sized.withColumnRenamed("doc", "doc_id")


def _line_sizes(corpus: DataFrame) -> DataFrame:
    pairs = counts.term_counts(corpus, "line")
    return attach_by_doc(pairs, counts.sizes_of_counts(pairs), "doc_size")


def _packed_keys(corpus: DataFrame) -> DataFrame:
    packed = counts.term_counts_with_size(corpus).select(
        keys.pack_key(F.col("term"), F.col("doc")).alias("key"),
        keys.pack_fraction(F.col("word_count"), F.col("doc_size")).alias("fraction"),
    )
    return packed.select(
        "key",
        "fraction",
        keys.key_head(F.col("key")).alias("term"),
        keys.key_tail(F.col("key")).try_cast("bigint").alias("doc"),
        keys.numerator(F.col("fraction")).alias("word_count"),
        keys.denominator(F.col("fraction")).alias("doc_size"),
    )


def _doc_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return names_from_paths(pages, "url").select("page_id", "doc_name")


def entry(spark: SparkSession) -> DataFrame:
    """tfidf of every (document, term) pair of the documents table."""
    return queries()["tfidf"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _statistics() | ({"pipeline": corpus_pipeline.run} | llm.queries() if llm else {})


def _statistics() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources and projections
        "num_docs": _num_docs("documents", "doc_id", "document"),
        "num_docs_lines": _num_docs("conversations", "conv_id", "line"),
        "doc_name": _doc_name,
        "tokenize": _on_documents(tk.tokenize),
        "tokens_with_size": _on_documents(tk.tokens_with_size),
        # aggregates and group totals
        "term_counts": _on_documents(counts.term_counts),
        "term_counts_published": _published,
        "term_counts_lines": _on_conversations(lambda c: counts.term_counts(c, "line")),
        "doc_sizes": _on_documents(counts.doc_sizes),
        "doc_sizes_lines": _on_conversations(lambda c: counts.doc_sizes(c, "line")),
        "term_counts_with_size": _on_documents(counts.term_counts_with_size),
        "term_counts_with_size_window": _window_sizes,
        "term_counts_chunked": _on_documents(lambda c: counts.term_counts(c, chunk_bytes=SMALL_CHUNK)),
        "term_counts_with_size_chunked": _on_documents(lambda c: counts.term_counts_with_size(c, SMALL_CHUNK)),
        "term_counts_with_size_lines": _on_conversations(_line_sizes),
        "vocabulary": _on_documents(counts.vocabulary),
        "doc_freq": _on_documents(frequency.doc_freq),
        "doc_freq_lines": _on_conversations(lambda c: frequency.doc_freq(c, "line")),
        "doc_freq_by_worker": _on_documents(_doc_freq_by_worker),
        "doc_freq_merge": _on_documents(_doc_freq_merge),
        "doc_freq_merge_corpora": _doc_freq_merge_corpora,
        "doc_freq_updated": _doc_freq_updated,
        "postings": _postings(lists.BLOCK_SIZE),
        "postings_blocks": _postings(SMALL_BLOCK),
        "postings_gaps": _postings(SMALL_BLOCK, lists.with_gaps),
        "postings_from_gaps": _postings(SMALL_BLOCK, lambda made: lists.from_gaps(lists.with_gaps(made))),
        "postings_packed": _postings(lists.BLOCK_SIZE, _packed),
        "postings_explode": _postings(lists.BLOCK_SIZE, _exploded),
        "postings_unpack": _postings(lists.BLOCK_SIZE, _unpacked),
        # weights
        "tf": _on_documents(_tf),
        "idf": _on_documents(_idf),
        "tf_idf_union": _with_heavy_terms(_tf_idf_union),
        # the composed query, by each strategy and grain
        "tfidf": _scores("window"),
        "tfidf_record": _with_heavy_terms(lambda corpus, heavy: scoring.score(corpus, heavy=heavy)),
        "tfidf_window": _scores("window"),
        "tfidf_lookup": _scores("lookup"),
        "tfidf_broadcast": _scores("broadcast", overflow="shuffle"),
        "tf_idf_join": _scores("join", _spread_documents),
        "tfidf_product": _scores("product"),
        "tfidf_chunked": _scores("window", chunk_bytes=SMALL_CHUNK),
        "tfidf_counts": _with_heavy_terms(_score_counts),
        "tfidf_counts_bucketed": _score_buckets(by_frequency=False),
        "tfidf_frequency_bucketed": _score_buckets(by_frequency=True),
        "tfidf_lines": _line_scores("window"),
        "tfidf_lines_window": _line_scores("window"),
        "tfidf_lines_lookup": _line_scores("lookup"),
        "tfidf_lines_chunked": _line_scores("window", chunk_bytes=SMALL_CHUNK),
        # text forms
        "tfidf_report": _report,
        "packed_keys": _on_documents(_packed_keys),
    }


# The steps that the oracle statements share, for a table of documents or lines.
def _steps(table: str, doc: str) -> str:
    return rf"""WITH tk AS (
  SELECT {doc}, unnest(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) AS term FROM {table}),
tc AS (SELECT {doc}, term, count(*) AS word_count FROM tk GROUP BY ALL),
ds AS (SELECT {doc}, count(*) AS doc_size FROM tk GROUP BY {doc}),
df AS (SELECT term, count(*) AS num_docs_with_word FROM tc GROUP BY term),
n AS (SELECT count(DISTINCT {doc}) AS num_docs FROM {table})
"""


_TFIDF = "(word_count::DOUBLE / doc_size) * ln(num_docs::DOUBLE / num_docs_with_word)"


def _blocks(block_size: int) -> str:
    rank = "row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1"
    return f"SELECT term, num_docs_with_word, doc_id, ({rank}) // {block_size} AS block FROM tc JOIN df USING (term)"


def _postings_sql(block_size: int, docs: str) -> str:
    return (
        _steps("documents", "doc_id")
        + f"SELECT term, block, {docs} FROM ({_blocks(block_size)}) GROUP BY term, block"
    )


def oracle_sql() -> dict[str, str]:
    return _statistics_sql() | (llm.oracle_sql() if llm else {})


def _statistics_sql() -> dict[str, str]:
    d = _steps("documents", "doc_id")
    c = _steps("conversations", "conv_id")
    scores = f"SELECT doc_id, term, round({_TFIDF}, 10) AS tfidf FROM tc JOIN ds USING (doc_id) JOIN df USING (term), n"
    line_scores = scores.replace("doc_id", "conv_id")
    count_and_docs = "any_value(num_docs_with_word) AS num_docs_with_word, list(doc_id ORDER BY doc_id) AS docs"
    gaps = """any_value(num_docs_with_word) AS num_docs_with_word, min(doc_id) AS first_doc, max(doc_id) AS last_doc,
  list_transform(list_zip(list_sort(list(doc_id))[2:], list_sort(list(doc_id))[:-2]), lambda p: p[1] - p[2]) AS gaps"""
    packed = "any_value(num_docs_with_word) || '/' || string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS packed"
    return {
        "num_docs": "SELECT count(*) AS num_docs FROM documents",
        "num_docs_lines": "SELECT count(DISTINCT conv_id) AS num_docs FROM conversations",
        "doc_name": "SELECT page_id, list_extract(string_split(url, '/'), -1) AS doc_name FROM pages",
        "tokenize": d + "SELECT doc_id, term FROM tk",
        "tokens_with_size": d + "SELECT doc_id, term, doc_size FROM tk JOIN ds USING (doc_id)",
        "term_counts": d + "SELECT doc_id, term, word_count FROM tc",
        "term_counts_published": d + "SELECT doc_id, term, word_count FROM tc",
        "term_counts_lines": c + "SELECT conv_id, term, word_count FROM tc",
        "doc_sizes": d + "SELECT doc_id, doc_size FROM ds",
        "doc_sizes_lines": c + "SELECT conv_id, doc_size FROM ds",
        "term_counts_with_size": d
        + "SELECT doc_id, term, word_count, doc_size FROM tc JOIN ds USING (doc_id)",
        "term_counts_with_size_window": d
        + "SELECT doc_id, term, word_count, CAST(sum(word_count) OVER (PARTITION BY doc_id) AS BIGINT) AS doc_size FROM tc",
        "term_counts_with_size_lines": c
        + "SELECT conv_id, term, word_count, CAST(sum(word_count) OVER (PARTITION BY conv_id) AS BIGINT) AS doc_size FROM tc",
        "vocabulary": d + "SELECT DISTINCT term FROM tk",
        "doc_freq": d + "SELECT term, num_docs_with_word FROM df",
        "doc_freq_lines": c + "SELECT term, num_docs_with_word FROM df",
        "doc_freq_by_worker": d
        + f"SELECT doc_id % {WORKERS} AS worker, term, count(*) AS num_docs_with_word FROM tc GROUP BY ALL",
        "doc_freq_merge": d + "SELECT term, num_docs_with_word FROM df",
        "postings": _postings_sql(lists.BLOCK_SIZE, count_and_docs),
        "postings_blocks": _postings_sql(SMALL_BLOCK, count_and_docs),
        "postings_gaps": _postings_sql(SMALL_BLOCK, gaps),
        "postings_from_gaps": _postings_sql(SMALL_BLOCK, count_and_docs),
        "postings_packed": _postings_sql(lists.BLOCK_SIZE, packed),
        "postings_explode": d + "SELECT term, doc_id FROM tc",
        "postings_unpack": d + "SELECT term, doc_id FROM tc",
        "doc_freq_merge_corpora": "SELECT term, CAST(sum(n) AS BIGINT) AS num_docs_with_word FROM ("
        + f"({d} SELECT term, num_docs_with_word AS n FROM df) UNION ALL ({c} SELECT term, num_docs_with_word FROM df)"
        + ") GROUP BY term",
        "tf": d
        + "SELECT doc_id, term, round(word_count::DOUBLE / doc_size, 10) AS tf FROM tc JOIN ds USING (doc_id)",
        "idf": d
        + "SELECT term, round(ln(num_docs::DOUBLE / num_docs_with_word), 10) AS idf FROM df, n",
        "tf_idf_union": d
        + """SELECT doc_id, term, round(word_count::DOUBLE / doc_size, 10) AS value FROM tc JOIN ds USING (doc_id)
UNION ALL
SELECT doc_id, term, round(ln(num_docs::DOUBLE / num_docs_with_word), 10) AS value FROM tc JOIN df USING (term), n""",
        "tfidf": d + scores,
        "tfidf_record": d
        + f"""SELECT doc_id, term, word_count, doc_size, num_docs, num_docs_with_word, round({_TFIDF}, 10) AS tfidf
FROM tc JOIN ds USING (doc_id) JOIN df USING (term), n""",
        "tfidf_lookup": d + scores,
        "tfidf_chunked": d + scores,
        "tfidf_lines_lookup": c + line_scores,
        "tfidf_lines_chunked": c + line_scores,
        "term_counts_chunked": d + "SELECT doc_id, term, word_count FROM tc",
        "term_counts_with_size_chunked": d + "SELECT doc_id, term, word_count, doc_size FROM tc JOIN ds USING (doc_id)",
        "tfidf_broadcast": d + scores,
        "tfidf_window": d + scores,
        "tfidf_counts": d + scores,
        "tfidf_counts_bucketed": d + scores,
        "tfidf_frequency_bucketed": d + scores,
        "doc_freq_updated": d + "SELECT term, num_docs_with_word FROM df",
        "tf_idf_join": d + scores,
        "tfidf_product": d + scores,
        "tfidf_lines": c + line_scores,
        "tfidf_lines_window": c + line_scores,
        "tfidf_report": d
        + f"""SELECT doc_id || '@' || term AS key, printf('%.10f', {_TFIDF}) AS value_text
FROM tc JOIN ds USING (doc_id) JOIN df USING (term), n""",
        "packed_keys": d
        + """SELECT term || '@' || doc_id AS key, word_count || '/' || doc_size AS fraction,
  term, doc_id, word_count, doc_size FROM tc JOIN ds USING (doc_id)""",
    }
