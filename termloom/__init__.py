"""Corpus statistics and term weighting on Spark DataFrames."""

from termloom.operators.chunks import bounded_lines
from termloom.operators.counts import (
    doc_sizes,
    num_docs,
    term_counts,
    term_counts_with_size,
    vocabulary,
)
from termloom.operators.frequency import doc_freq, merge_doc_freq, partial_doc_freq
from termloom.operators.postings import explode_postings, postings
from termloom.operators.tokens import tokenize, tokens_with_size
from termloom.plans.scoring import score, score_counts
from termloom.session import build_session
from termloom.sinks.report import report, write_report
from termloom.sources.files import list_documents, read_documents, read_lines
from termloom.sources.stages import load_stage, save_stage
from termloom.sources.tables import corpus_from, widen

__all__ = [
    "bounded_lines",
    "build_session",
    "corpus_from",
    "doc_freq",
    "doc_sizes",
    "explode_postings",
    "list_documents",
    "load_stage",
    "merge_doc_freq",
    "num_docs",
    "partial_doc_freq",
    "postings",
    "read_documents",
    "read_lines",
    "report",
    "save_stage",
    "score",
    "score_counts",
    "term_counts",
    "term_counts_with_size",
    "tokenize",
    "tokens_with_size",
    "vocabulary",
    "widen",
    "write_report",
]
