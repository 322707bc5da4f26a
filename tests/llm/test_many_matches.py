"""Personal data where matches are very many, and columns with names like those used inside."""

from __future__ import annotations

import time

from termloom.llm import pii


def test_a_megabyte_of_numbers(spark):
    unit = "ab 12 cd 4111 1111 1111 1111 x\n"
    times = 1_000_000 // len(unit)
    docs = spark.createDataFrame([(1, unit * times), (2, unit)], "doc_id bigint, text string")
    before = time.time()
    rows = {r.doc_id: r for r in pii.find(docs, {}).collect()}
    assert time.time() - before < 60
    # Each line is one match, as it ends in a letter.
    assert len(rows[2].base_spans) == 1
    card = rows[2].base_spans[0]
    starts = [s.start for s in rows[1].base_spans]
    assert starts == [k * len(unit) + card.start for k in range(times)]
    assert all(s.end - s.start == card.end - card.start for s in rows[1].base_spans)


def test_redaction_over_blocks(spark):
    text = "".join(f"a{k}@example.org, " for k in range(1_000)) + "end"
    (row,) = pii.redact(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), {}).collect()
    assert row.text == "[EMAIL], " * 1_000 + "end"


def test_names_that_are_used_inside(spark):
    names = ["_base", "_email", "_ip", "_card", "_phone", "_maybe", "_loose", "own0"]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(1, "write to a@b.org", *names)], schema)
    (row,) = pii.find(docs, {}).collect()
    assert [row[n] for n in names] == names and [s.value for s in row.base_spans] == ["a@b.org"]
    redacted = pii.redact(docs, {})
    assert redacted.columns == docs.columns and redacted.first().text == "write to [EMAIL]"
