"""Secrets are taken whole."""

from __future__ import annotations

from termloom.llm import pii


def test_long_secret(spark):
    value = ("aB3dE5gH" * 38)[:300]
    texts = {
        1: f'x token = "{value}" y',
        2: f"x token={value} y",
        3: f"x token={value}&to=a@b.cd y",
        **{k: f"login key {k} password = ab12cd34ef{k} z" for k in range(10, 60)},
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    weights = pii.train(docs)
    # Sure of each secret, whatever was learned.
    weights["secret:"] = 99.0
    found = {r.doc_id: [s.value for s in r.spans if s.kind == 4] for r in pii.find(docs, weights).collect()}
    assert found[1] == [f'token = "{value}"']
    assert found[2] == [f"token={value}"]
    assert found[3] == [f"token={value}&to=a@b.cd"]
    redacted = {r.doc_id: r.text for r in pii.redact(docs, weights).collect()}
    assert [redacted[k] for k in (1, 2, 3)] == ["x [SECRET] y"] * 3
