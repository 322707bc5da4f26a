"""The formulas in plain Python, for small corpora."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

SEPARATORS = re.compile("[ \t\n\x0b\f\r]+")


def terms(text: str | None) -> list[str]:
    return [t for t in SEPARATORS.split(text or "") if t]


def record(rows) -> dict[tuple, tuple]:
    """``(doc, term) -> (word_count, doc_size, num_docs, num_docs_with_word, tfidf)``."""
    counts: dict = defaultdict(Counter)
    for doc, text in rows:
        counts[doc].update(terms(text))
    held = Counter(term for counter in counts.values() for term in counter)
    result = {}
    for doc, counter in counts.items():
        size = sum(counter.values())
        for term, n in counter.items():
            value = n / size * math.log(len(counts) / held[term])
            result[doc, term] = (n, size, len(counts), held[term], value)
    return result


def assert_scores(scored, rows) -> None:
    expected = record(rows)
    got = scored.collect()
    assert len(got) == len(expected)
    for row in got:
        *counts, value = expected[row.doc, row.term]
        assert math.isclose(row.tfidf, value, rel_tol=1e-12, abs_tol=1e-15), (row, value)
        if "word_count" in row:
            assert [row.word_count, row.doc_size, row.num_docs, row.num_docs_with_word] == counts
