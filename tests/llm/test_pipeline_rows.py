"""The rows of the pipeline against plain versions of its stages."""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
import tiktoken
from test_brute_force import RANKS, _components

import corpus_pipeline
from termloom.llm import pii

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _windows(words, size):
    return [tuple(words[p : p + size]) for p in range(len(words) - size + 1)]


def _contaminated(text, items):
    words = WORD.findall(text.translate(LOWER))
    hit = set()
    for size in {len(w) for w in items}:
        for p, window in enumerate(_windows(words, size)):
            if window in items:
                hit.update(range(p, p + size))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_pipeline_rows(spark, sf_dir):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    docs, texts = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.saved(stage(spark, docs, sf_dir))
        texts[name] = {r.doc_id: r.text for r in docs.collect()}
    clean = texts["toxicity"]
    kept = {root for _, root in _components(clean, 5, 80).values()}
    assert set(texts["near_dedup"]) == kept
    items = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = WORD.findall(r.text.translate(LOWER))
        items.update(_windows(words, min(13, len(words))) if words else [])
    kept = {d for d in kept if not _contaminated(clean[d], items)}
    assert set(texts["decontamination"]) == kept
    expected = {}
    for r in pii.find(before, pii.train(before)).collect():
        out, at = "", 0
        for s in r.spans:
            if s.start >= at:
                out += r.text[at : s.start] + f"[{pii.KINDS[s.kind].upper()}]"
            at = max(at, s.end)
        text = out + r.text[at:]
        ids = library.encode_ordinary(text)
        expected[r.doc_id] = (r.lang, r.source, ids, len(ids), hashlib.sha256(text.encode()).hexdigest())
    assert set(expected) == kept
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected and len(rows) == len(expected)
