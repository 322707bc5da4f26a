"""From raw documents to token ids: five stages, each written and read again.

Every stage takes ``(spark, docs, sf_dir)``, where ``docs`` has the columns of the
``documents`` table, and works on all of them. All but the last give these columns
back. ``run`` applies them to the table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from termloom.llm import bpe, near_dedup, pii, toxicity
from termloom.llm.common import read, saved
from termloom.llm.decontaminate import clean_documents


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity model rejects. It is trained on the labels of ``docs``."""
    labels = toxicity.training_labels(read(spark, sf_dir, "labels"), 3, 1)
    return toxicity.harmless(docs, toxicity.train(docs, labels))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: five words, similarity 0.8."""
    return near_dedup.keep_one_of_each(docs, size=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that are contaminated by benchmark items."""
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind."""
    return pii.redact(docs, pii.train(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts and decode the ids: ``doc_id, lang, source, ids, n_tokens, decoded_sha256``."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_ids(docs, ranks, public_tokenizers.PATTERN)
    return encoded.selectExpr("doc_id", "lang", "source", "ids", "CAST(size(ids) AS BIGINT) AS n_tokens", "decoded_sha256")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

# No SQL statement can express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return saved(STAGES[-1][1](spark, docs, sf_dir))
