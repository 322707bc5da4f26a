"""What the planner makes of the queries."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as spark_entry


@pytest.fixture
def plan(static_plans, sf_dir):
    def text(name: str) -> str:
        frame = spark_entry.queries()[name](static_plans, sf_dir)
        return frame._jdf.queryExecution().executedPlan().toString()

    return text


def tokenisations(plan: str) -> int:
    return plan.count("regexp_extract_all(text")


@pytest.mark.parametrize("name", ["term_counts", "term_counts_with_size", "doc_sizes", "tf"])
def test_counts_of_a_document_are_not_shuffled(plan, name):
    text = plan(name)
    # The only exchange is the one that spreads a small file over the cores.
    assert re.findall(r"Exchange (\w+)", text) == ["hashpartitioning"]
    assert "REPARTITION_BY_NUM" in text and "ENSURE_REQUIREMENTS" not in text
    assert tokenisations(text) == 1


@pytest.mark.parametrize(
    "name, times",
    [
        ("tokenize", 1),
        ("tokens_with_size", 1),
        ("doc_freq", 1),
        ("vocabulary", 1),
        ("tfidf", 1),
        ("tfidf_record", 1),
        ("tfidf_lookup", 2),
        ("tfidf_window", 1),
        ("tfidf_product", 1),
        ("tf_idf_union", 1),
        ("tf_idf_join", 2),
        ("term_counts_with_size_window", 1),
        ("tfidf_report", 1),
        ("postings", 1),
        ("tfidf_lines", 2),
        ("tfidf_lines_lookup", 1),
        ("term_counts_with_size_lines", 1),
    ],
)
def test_texts_are_cut_into_terms_no_more_than_needed(plan, name, times):
    text = plan(name)
    assert tokenisations(text) == times
    # Reading is shared too: one scan of the texts, at most one more of the ids.
    # At line grain the sizes of documents are read for themselves.
    assert len(re.findall(r"FileScan.*ReadSchema: struct<.*text:string>", text)) == (2 if name == "tfidf_lines" else 1)


def test_lookup_shuffles_the_pairs_once(plan):
    text = plan("tfidf_lookup")
    assert len(re.findall(r" BroadcastExchange", text)) == 1
    assert len(re.findall(r"- Exchange hashpartitioning\(probe", text)) == 1
    assert text.count("SortMergeJoin") == 1
    # Both sides of the join are already where it needs them.
    frequency = text[text.index("Exchange hashpartitioning(probe") :]
    assert "ReusedExchange" in frequency


@pytest.mark.parametrize("name", sorted(spark_entry._statistics()))
def test_no_python_and_no_cross_join(plan, name):
    text = plan(name)
    for word in ("Python", "Arrow", "CartesianProduct", "NestedLoop", "CollectLimit"):
        assert word not in text


def test_scan_reads_two_columns(plan):
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan("tfidf")))
    assert schemas == {"struct<doc_id:bigint,text:string>", "struct<doc_id:bigint>"}


SPLITS = 16
HEAVY = {"=the": 5, "=and": 3}


@pytest.fixture(scope="module")
def split_corpus(spark, sf_dir, tmp_path_factory):
    """The documents in many files, read as they are: no shuffle of texts hides a second reading."""
    from termloom import corpus_from

    path = str(tmp_path_factory.mktemp("splits") / "documents")
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(SPLITS).write.parquet(path)
    return corpus_from(spark.read.parquet(path), "doc_id", "text")


def _made(corpus):
    from termloom import postings, score, score_counts, term_counts_with_size
    from termloom.operators.tokens import terms_per_row
    from termloom.sources.stages import save_and_load

    pairs = terms_per_row(corpus)
    saved = save_and_load(term_counts_with_size(corpus))
    for heavy in ({}, HEAVY):
        yield "tfidf", heavy, (1, 1), 1, score(corpus, heavy=heavy)
        yield "product", heavy, (1, 1), None, score(corpus, strategy="product", heavy=heavy)
        yield "postings", heavy, (1, 1), 1, postings(pairs, 100, heavy, [10, 50, 100])
        # The pairs by term, and then by document; texts are read again for the documents' sizes.
        yield "lines", heavy, (2, 2), 2, score(corpus, "line", heavy=heavy)
        yield "counts", heavy, (0, 0), 1, score_counts(saved, corpus, heavy)
    yield "lookup", {}, (2, 2), 1, score(corpus, strategy="lookup")


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("adaptive", ["false", "true"])
def test_texts_are_read_and_pairs_shuffled_as_often_as_stated(spark, split_corpus, adaptive):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for name, heavy, (scans, cuts), shuffles, frame in _made(split_corpus):
            if adaptive == "true":
                # Exchanges are shared as the stages run: the plan is final then.
                frame.write.format("noop").mode("overwrite").save()
                continue
            text = _plan(frame)
            found = len(re.findall(r"FileScan.*ReadSchema: struct<.*text:string>", text))
            assert (found, tokenisations(text)) == (scans, cuts), (name, heavy, text)
            if shuffles is not None:
                # What carries the documents of the pairs is a shuffle of pairs.
                moved = re.findall(r"- Exchange hashpartitioning\((?:term|probe)", text)
                wide = [m for m in re.findall(r"- (Exchange hashpartitioning\((?:term|probe)[^\n]*)\n[^\n]*", text)]
                assert len(wide) == len(moved) and len(moved) - _small(text) == shuffles, (name, heavy, text)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _small(text: str) -> int:
    """Exchanges of sums, which aggregates have made."""
    lines, small = text.splitlines(), 0
    for at, line in enumerate(lines):
        if re.search(r"- Exchange hashpartitioning\((?:term|probe)", line):
            if any("HashAggregate" in x for x in lines[at + 1 : at + 4]):
                small += 1
    return small


def test_sums_of_slices_are_few(spark, split_corpus):
    """Only heavy terms are cut: slice sums are hardly more than the terms."""
    from termloom.operators.counts import term_counts_with_size
    from termloom.operators.totals import heavy_groups, sliced

    pairs = term_counts_with_size(split_corpus)
    heavy = heavy_groups(pairs, "term", partitions=2_000)
    assert heavy and all(1 < n <= 2_000 for n in heavy.values())
    dealt = sliced(pairs, "term", "doc", heavy)
    groups = dealt.select("term").distinct().count()
    assert dealt.select("term", "slice").distinct().count() <= 1.1 * groups


def test_counting_compiles_into_one_stage(plan):
    text = plan("term_counts")
    assert "lambdafunction" not in text
    above_exchange = text[: text.index("Exchange")]
    assert set(re.findall(r"\*\((\d+)\)", above_exchange)) == {"2"}


def test_widen_deals_out_as_asked(static_plans, sf_dir):
    from termloom import corpus_from, widen

    table = corpus_from(static_plans.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    assert widen(table, 13, "doc").rdd.getNumPartitions() == 13


def test_count_reads_ids_only(plan):
    text = plan("num_docs")
    assert "REPARTITION" not in text and "text:string" not in text
