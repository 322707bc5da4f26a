"""How texts are cut into words, and which terms are learned."""

from __future__ import annotations

import random

import pytest

from termloom.llm import toxicity

TERMS = [("idiot", 5.0), ("pathetic", 5.0)]


@pytest.mark.parametrize(
    "text",
    ["you idiot,pathetic one", "idiot/pathetic", "an idiot—really", "i-d-i-o-t", "i.d.i.o.t!", "idiot-like", "idi*t", "idjot;", "(idiot)"],
)
def test_joined_and_spelled_words_are_found(text):
    assert any(toxicity.Scorer(TERMS).features(text))


@pytest.mark.parametrize("text", ["", " ", "—", "-", "a-b-c", "well-known, and/or", "i-d-i", "* * *", "patients"])
def test_other_words_are_not(text):
    assert not any(toxicity.Scorer(TERMS).features(text))


def test_parted_words_are_two_hits():
    assert toxicity.Scorer(TERMS).features("idiot,pathetic") == toxicity.Scorer(TERMS).features("idiot pathetic")


def test_a_term_inside_a_joined_word_has_the_fewest_edits():
    scorer = toxicity.Scorer(TERMS)
    scorer.features("idjot-pathetic")
    assert scorer.known["idjot-pathetic"] == (1, 0)


def test_near_copies_of_a_long_toxic_text_hide_no_rare_term(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioubdgklmnprst") for _ in range(7))
    common = [word() for _ in range(300)]
    long = [word() for _ in range(2_000)]
    rows = []
    for _ in range(300):
        own = list(long)
        for _ in range(8):
            own[rng.randrange(len(own))] = word()
        rows.append((" ".join(own), 1))
    for _ in range(12):
        own = rng.choices(common, k=60)
        own[rng.randrange(60)] = "blorgface"
        rows.append((" ".join(own), 1))
    rows += [(" ".join(rng.choices(common, k=60)), 0) for _ in range(600)]
    # Labels of equal texts that differ: toxic, in whatever order they come.
    rows += [(rows[305][0], 0), ("", 0), (" ", 1)]
    learned = toxicity.learn_terms(spark.createDataFrame(rows, "text string, toxic int"))
    assert [w for w, _ in learned] == ["blorgface"]
    again = toxicity.learn_terms(spark.createDataFrame(rows[::-1], "text string, toxic int"))
    assert again == learned


def test_without_both_labels_nothing_is_learned(spark):
    for rows in ([], [("a b c", 1)], [("a b c", 0)]):
        assert toxicity.learn_terms(spark.createDataFrame(rows, "text string, toxic int")) == []
