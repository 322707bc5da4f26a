"""Frequencies kept up to date, and counts saved by buckets."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from brute_force import assert_scores, terms

from termloom import doc_freq, score_counts, term_counts_with_size
from termloom.operators import frequency
from termloom.plans.scoring import score_with_frequency
from termloom.sources.stages import save_and_load, save_counts, save_frequency, stage_path

SCHEMA = "doc string, text string"


def test_ten_random_updates(spark):
    rng = random.Random(4)

    def text():
        return " ".join(rng.choice("abcdefghij") * rng.randrange(1, 3) for _ in range(rng.randrange(6)))

    held = {f"d{i}": text() for i in range(30)}
    kept = save_and_load(doc_freq(spark.createDataFrame(list(held.items()), SCHEMA)))
    for step in range(10):
        gone = rng.sample(sorted(held), rng.randrange(4))
        replaced = rng.sample(sorted(set(held) - set(gone)), 2)
        removed = [(d, held.pop(d)) for d in gone + replaced]
        added = [(d, text()) for d in replaced] + [(f"n{step}-{k}", text()) for k in range(rng.randrange(3))]
        held.update(added)
        changes = frequency.doc_freq_changes(
            spark.createDataFrame(added, SCHEMA), spark.createDataFrame(removed, SCHEMA)
        )
        kept = save_and_load(frequency.updated_doc_freq(kept, changes))
        expected = Counter(t for x in held.values() for t in set(terms(x)))
        assert {r.term: r.num_docs_with_word for r in kept.collect()} == expected
        now = spark.createDataFrame(list(held.items()), SCHEMA)
        assert frequency.doc_freq_differences(kept, now).count() == 0
    other = spark.createDataFrame([("x", "only here")], SCHEMA)
    assert {(r.term, r.kept, r.counted) for r in frequency.doc_freq_differences(kept, other).collect()} >= {
        ("only", None, 1), ("here", None, 1)
    }


def test_updates_that_cannot_be(spark, corpus):
    kept = doc_freq(corpus({"d": "a b"}))
    changes = frequency.doc_freq_changes(removed=corpus({"e": "z"}))
    with pytest.raises(Exception, match="fewer documents than none"):
        frequency.updated_doc_freq(kept, changes).collect()
    with pytest.raises(ValueError):
        frequency.doc_freq_changes()
    lines = corpus([("d", "a"), ("d", "a b"), (None, "a")])
    changed = frequency.doc_freq_changes(added=lines, grain="line").collect()
    assert {(r.term, r.change) for r in changed} == {("a", 1), ("b", 1)}


@pytest.mark.parametrize("heavy", [None, {"=a": 3, "=x": 2}])
def test_saved_counts_are_not_shuffled(static_plans, corpus, heavy):
    spark = static_plans
    rng = random.Random(1)
    rows = [(f"d{i}", " ".join(rng.choice("abcxyz") for _ in range(9))) for i in range(60)] + [("none", "")]
    table = corpus(rows)
    path = stage_path(spark)
    save_counts(term_counts_with_size(table), "saved_counts", 4, heavy, f"{path}/counts")
    save_frequency(doc_freq(table), "saved_frequency", 4, f"{path}/frequency")
    saved = spark.table("saved_counts")
    scored = [score_counts(saved, table, {})]
    if heavy is None:
        scored.append(score_with_frequency(saved, spark.table("saved_frequency"), table))
    for frame in scored:
        assert_scores(frame, rows)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in re.findall(r"Exchange hashpartitioning\((\w+)", plan)]
        # Only the sums of heavy terms' slices move.
        assert len(moved) == (1 if heavy else 0), plan
    spark.sql("DROP TABLE saved_counts")
    spark.sql("DROP TABLE saved_frequency")
