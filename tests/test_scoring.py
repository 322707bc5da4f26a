"""The composed query on hand-computed and random corpora, by every strategy."""

from __future__ import annotations

import random

import pytest
from brute_force import assert_scores
from pyspark.sql import functions as F

from termloom.operators import combine
from termloom.operators.frequency import doc_freq_of_counts
from termloom import doc_sizes, num_docs, score, term_counts, tokenize
from termloom.plans.scoring import STRATEGIES, counts_with_totals

TINY = {"doc1": "a b a\n", "doc2": "b c\n"}
EDGE = {"d1": "  a b\n", "d2": "me@x.org a", "d3": "", "d4": " \t\n", "d5": "x\x0by a=1"}
GRAINS = ("document", "line")


def rounded(scored) -> dict[tuple, float]:
    return {(r.doc, r.term): round(r.tfidf, 10) for r in scored.collect()}


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("grain", GRAINS)
def test_tiny(corpus, grain, strategy):
    assert rounded(score(corpus(TINY), grain, strategy)) == {
        ("doc1", "a"): 0.4620981204,
        ("doc1", "b"): 0.0,
        ("doc2", "b"): 0.0,
        ("doc2", "c"): 0.3465735903,
    }


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("grain", GRAINS)
def test_edge(corpus, grain, strategy):
    assert rounded(score(corpus(EDGE), grain, strategy)) == {
        ("d1", "a"): 0.4581453659,
        ("d1", "b"): 0.8047189562,
        ("d2", "me@x.org"): 0.8047189562,
        ("d2", "a"): 0.4581453659,
        ("d5", "x"): 0.5364793041,
        ("d5", "y"): 0.5364793041,
        ("d5", "a=1"): 0.5364793041,
    }


def test_record_columns(corpus):
    row = score(corpus(EDGE)).where("term = 'a' AND doc = 'd1'").first()
    assert row.asDict().keys() == {
        "doc", "term", "word_count", "doc_size", "num_docs", "num_docs_with_word", "tfidf"
    }
    assert (row.word_count, row.doc_size, row.num_docs, row.num_docs_with_word) == (1, 2, 5, 2)


def test_case_and_punctuation_are_kept(corpus):
    terms = {r.term for r in tokenize(corpus({"d": "The the THE,"})).collect()}
    assert terms == {"The", "the", "THE,"}


def test_no_break_space_does_not_separate(corpus):
    assert [r.term for r in tokenize(corpus({"d": "a\u00a0b"})).collect()] == ["a\u00a0b"]


def test_null_text_is_an_empty_document(corpus):
    rows = [("d1", None), ("d2", "a")]
    table = corpus(rows)
    assert num_docs(table).first().num_docs == 2
    for grain in GRAINS:
        assert_scores(score(table, grain), rows)
        assert [r.doc for r in doc_sizes(table, grain).collect()] == ["d2"]


def test_lines_and_documents_score_alike(corpus):
    lines = [(doc, line) for doc, text in TINY.items() for line in (text.split(" ") + [""])]
    assert rounded(score(corpus(lines), "line")) == rounded(score(corpus(TINY)))


def test_lines_without_document_are_left_out(corpus):
    rows = [("d1", "a b"), ("d2", "a")]
    assert_scores(score(corpus(rows + [(None, "a z")]), "line"), rows)


def test_empty_corpus(corpus):
    for grain in GRAINS:
        for strategy in STRATEGIES:
            assert score(corpus([]), grain, strategy).count() == 0


def test_documents_may_be_counted_elsewhere(corpus, spark):
    documents = spark.range(10).select(F.col("id").cast("string").alias("doc"))
    row = score(corpus(TINY), documents=documents).where("term = 'c'").first()
    assert row.num_docs == 10


def test_unknown_arguments_are_refused(corpus):
    with pytest.raises(ValueError):
        score(corpus(TINY), "page")
    with pytest.raises(ValueError):
        score(corpus(TINY), strategy="guess")


def random_corpus(seed: int) -> list[tuple[str, str]]:
    """Texts of odd characters, with very common, rare, prefix-sharing and long terms."""
    draw = random.Random(seed)
    words = ["a", "ab", "abc", "A", "@", "a@b", "a=1", "n/m", ",", "\u00e9", "e\u0301", "\U0001f600"]
    words += ["\x01", "\x1c", "$1", "\\1", "\\", "(", "[^ ]+", '"', "'", "\u2028", "x" * 3000]
    gaps = [" ", "  ", "\t", "\n", "\x0b", "\f", "\r\n", " \n\t "]
    rows = []
    for i in range(60):
        drawn = draw.choices(words, k=draw.choice([0, 1, 5, 40])) + [f"only{i}"] * (i % 3)
        text = "".join(draw.choice(gaps) + w for w in drawn) + draw.choice(["", "\n"])
        rows.append((f"doc {i}", text))
    return rows


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("grain", GRAINS)
def test_random_corpus(corpus, grain, strategy):
    rows = random_corpus(7)
    assert_scores(score(corpus(rows), grain, strategy), rows)


def test_random_lines(corpus):
    rows = [(f"doc {i % 7}", text) for i, (_, text) in enumerate(random_corpus(11))]
    for strategy in STRATEGIES:
        assert_scores(score(corpus(rows), "line", strategy), rows)


@pytest.mark.parametrize("hint", ["shuffle_hash", "merge"])
def test_join_hints(corpus, hint):
    rows = random_corpus(17)
    for grain in GRAINS:
        assert_scores(score(corpus(rows), grain, join_hint=hint), rows)


def test_large_broadcast_is_refused(corpus):
    with pytest.raises(ValueError, match="lookup"):
        score(corpus(TINY), strategy="broadcast", max_broadcast_bytes=10)


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("grain", GRAINS)
def test_rows_without_document_are_left_out(corpus, grain, strategy):
    rows = [("d1", "a b"), ("d2", "a")]
    assert_scores(score(corpus(rows + [(None, "a z")]), grain, strategy), rows)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_repeated_documents(corpus, strategy):
    rows = [("d1", "a b"), ("d1", "a c"), ("d2", "z")]
    with pytest.raises(ValueError, match="d1"):
        score(corpus(rows), strategy=strategy, check=True)
    assert_scores(score(corpus(rows), "line", strategy, check=True), rows)


def test_stacking_is_the_union_of_both_tables(spark):
    corpus = spark.createDataFrame([(1, "a b a"), (2, "a c"), (3, ""), (4, None)], "doc int, text string")
    matched = counts_with_totals(corpus, "document")
    docs = F.lit(4)
    idf_rows = combine.idf_table(matched.select("doc", "term", "num_docs_with_word"), docs)
    union = combine.union_values(combine.tf_table(matched), idf_rows)
    stacked = combine.stacked_values(matched, docs)
    assert stacked.columns == union.columns
    assert sorted(stacked.collect()) == sorted(union.collect())
    assert stacked.count() == 8


def test_sums_hold(spark, sf_dir):
    import __spark_entry__ as spark_entry

    scored = score(spark_entry._documents(spark, sf_dir))
    documents = scored.groupBy("doc").agg(
        F.sum("word_count").alias("words"),
        F.first("doc_size").alias("size"),
        F.sum(F.col("word_count") / F.col("doc_size")).alias("tf"),
        F.count("*").alias("rows"),
        F.count_distinct("term").alias("terms"),
    )
    assert documents.where("words <> size OR abs(tf - 1) > 1e-9 OR rows <> terms").count() == 0
    out_of_range = "num_docs_with_word < 1 OR num_docs_with_word > num_docs OR tfidf < 0"
    assert scored.where(out_of_range).count() == 0
    counts = term_counts(spark_entry._documents(spark, sf_dir))
    assert scored.count() == counts.count()


def test_frequency_of_saved_counts_keeps_terms_without_occurrences(spark):
    saved = spark.createDataFrame(
        [("d1", "a", 0), ("d2", "a", None), ("d1", "b", 2)], "doc string, term string, word_count bigint"
    )
    rows = {r.term: r.num_docs_with_word for r in doc_freq_of_counts(saved).collect()}
    assert rows == {"a": 2, "b": 1}
