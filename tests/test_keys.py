"""Packed text forms, synthetic corpus, merged frequencies."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from termloom import doc_freq, merge_doc_freq, partial_doc_freq, score
from termloom.functions import keys
from termloom.sources.synthetic import document_ids, synthetic_corpus, synthetic_words

WORDS = ["a", "me@x.org", "@", "@@", "a=1", "n/m", "\u00e9@\U0001f600"]


def test_keys_are_cut_at_the_last_at(spark):
    table = spark.createDataFrame([(w, "doc,1=/ x") for w in WORDS], "term string, doc string")
    packed = table.select("*", keys.pack_key(F.col("term"), F.col("doc")).alias("key"))
    back = packed.select(
        "term", "doc", keys.key_head(F.col("key")).alias("t"), keys.key_tail(F.col("key")).alias("d")
    )
    assert back.where("term = t AND doc = d").count() == len(WORDS)


def test_fractions(spark):
    table = spark.createDataFrame([("3/12",), ("x/y",), ("5",)], "f string")
    got = table.select(keys.numerator(F.col("f")), keys.denominator(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [(3, 12), (None, None), (5, 5)]


def test_packed_postings(spark):
    table = spark.createDataFrame([(2, ["d/1", "d2"])], "n bigint, docs array<string>")
    packed = table.select(keys.pack_postings(F.col("n"), F.col("docs")).alias("p"))
    assert packed.first().p == "2/d/1,d2"
    back = packed.select(keys.postings_count(F.col("p")), keys.postings_docs(F.col("p"))).first()
    assert tuple(back) == (2, ["d/1", "d2"])


def test_fixed_point(spark):
    row = spark.range(1).select(keys.fixed_point(F.lit(1 / 3)), keys.fixed_point(F.lit(6.9e-4), 16))
    assert tuple(row.first()) == ("0.3333333333", "0.0006900000000000")


def test_synthetic_words(spark):
    rows = synthetic_words(document_ids(spark, 3)).collect()
    assert len(rows) == 3 * 250
    for r in rows:
        digest = hashlib.md5(f"42-{r.doc}-{r.row}-{r.col}".encode()).hexdigest()
        assert r.word == digest[: (5, 6, 7, 8, 5)[r.col]]


def test_synthetic_corpus_is_the_same_words(spark):
    ids = document_ids(spark, 3)
    texts = {r.doc: r.text for r in synthetic_corpus(ids, seed=7).collect()}
    words = {d: [[""] * 5 for _ in range(50)] for d in texts}
    for r in synthetic_words(ids, seed=7).collect():
        words[r.doc][r.row][r.col] = r.word
    assert texts == {d: "".join(" ".join(row) + "\n" for row in w) for d, w in words.items()}


def test_published_corpus_sizes(spark):
    for count, words in ((48, 12_000), (110, 27_500)):
        scored = score(synthetic_corpus(document_ids(spark, count)))
        assert scored.agg(F.sum("word_count")).first()[0] == words


def test_merged_frequencies(corpus):
    first, second = corpus({"d1": "a b a", "d2": "b"}), corpus({"d3": "b c"})
    merged = merge_doc_freq(doc_freq(first), doc_freq(second))
    assert {tuple(r) for r in merged.collect()} == {("a", 1), ("b", 3), ("c", 1)}
    assert merged.dtypes == [("term", "string"), ("num_docs_with_word", "bigint")]


@pytest.mark.parametrize("parts", [1, 3])
def test_parts_add_up_to_the_whole(corpus, parts):
    table = corpus({f"d{i}": f"a b{i % 4} c{i}" for i in range(40)})
    part = F.pmod(F.xxhash64("doc"), F.lit(parts))
    merged = merge_doc_freq(partial_doc_freq(table, part))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, doc_freq(table).collect()))
