"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import public_tokenizers
import pytest

from termloom.llm import (
    bpe,
    decontaminate,
    fingerprints,
    licenses,
    near_dedup,
    pii,
    quality,
    token_files,
    toxicity,
    warc,
)
from termloom.llm.common import shared_folder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, Score double, n_hit string, license string, ids string, spans string, kept int, set_digest string"
LONG = "word " * 60_000 + "x" * 50_000
ROWS = [
    (1, "one two three four five six seven", 0.5, "a", "b", "c", "d", 1, "e"),
    (1, "one two three four five six seven", 0.5, "a", "b", "c", "d", 1, "e"),
    (2, "", None, None, None, None, None, None, None),
    (3, None, None, None, None, None, None, None, None),
    (None, "one two three four five six seven", None, None, None, None, None, None, None),
    (None, None, None, None, None, None, None, None, None),
    (4, LONG, None, None, None, None, None, None, None),
    (5, "mail a@b.org, idiot", None, None, None, None, None, None, None),
]
BENCHMARK = [(7, "three four five"), (8, ""), (None, None), (None, "six seven"), (7, "three four five")]


def _operators(spark, labels):
    items = spark.createDataFrame(BENCHMARK, "item_id bigint, text string")

    def token_ids(d):
        path = shared_folder(spark)
        token_files.write_ids(d, path, public_tokenizers.path("byte_bpe_50k.json"), 2)
        return token_files.read_ids(spark, path)

    return {
        "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels)),
        "decontaminate": lambda d: decontaminate.decontaminate(d, items),
        "token_files": token_ids,
        "licenses": licenses.scan,
        "bpe": lambda d: bpe.encode_documents(d, RANKS, public_tokenizers.PATTERN),
        "pii": lambda d: pii.find(d, pii.train(d)),
        "fingerprints": fingerprints.document_fingerprints,
        "quality": lambda d: quality.score(d, quality.train(d, labels)),
        "near_dedup": near_dedup.near_duplicates,
    }


NAMES = ["toxicity", "decontaminate", "token_files", "licenses", "bpe", "pii", "fingerprints", "quality", "near_dedup"]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (5, 0, 1), (None, 1, 1), (9, None, None), (2, None, 0), (5, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result(spark, labels, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    result = _operators(spark, labels)[name](docs).collect()
    assert sorted(str(r.doc_id) for r in result) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, labels, name):
    docs = spark.createDataFrame([], SCHEMA)
    assert _operators(spark, labels.where("false"))[name](docs).count() == 0


def test_filters_keep_columns_that_clash(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    items = spark.createDataFrame(BENCHMARK, "item_id bigint, text string")
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["2", "3", "4", "5", "None"]
    once = near_dedup.keep_one_of_each(docs)
    assert once.columns == docs.columns and once.where("Score = 0.5").count() == 2
    redacted = pii.redact(docs, {})
    assert redacted.columns == docs.columns
    assert [r.text for r in redacted.where("doc_id = 5").collect()] == ["mail [EMAIL], idiot"]
    kept = toxicity.harmless(docs, ([], toxicity._PRIOR))
    assert kept.columns == docs.columns and kept.count() == len(ROWS)


def test_archive(spark):
    rows = [(3, "u", "x"), (2, None, "x"), (2, None, "x"), (4, "u\r\nv", None), (5, "u", ""), (None, "u", "y"), (None, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = shared_folder(spark)
    warc.write_archive(pages, path)
    found = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_records(spark, path).collect())
    assert found == [
        ("2", 1, "response", None), ("2", 1, "response", None), ("3", 1, "revisit", 2), ("4", 0, "response", None),
        ("5", 0, "revisit", 4), ("None", 1, "response", None), ("None", 1, "revisit", 2),
    ]
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    empty = shared_folder(spark)
    warc.write_archive(pages.where("false"), empty)
    assert warc.read_records(spark, empty).count() == 0
