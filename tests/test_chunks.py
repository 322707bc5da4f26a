"""Long texts in chunks: the same terms, within bounded memory."""

from __future__ import annotations

import os
import random
import re
import subprocess
import sys

import pytest
from brute_force import assert_scores, record

from termloom import score, term_counts, term_counts_with_size
from termloom.operators import chunks

TERM = re.compile("[^ \t\n\x0b\f\r]+")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _texts(seed: int) -> list[tuple[str, str | None]]:
    rng = random.Random(seed)
    alphabet = ["a", "é", "日", "\U0001f600", " ", "\t", "\n", "\x0b", "\f", "\r", "  ", "b"]
    rows = [(f"d{i}", "".join(rng.choice(alphabet) for _ in range(rng.randrange(150)))) for i in range(150)]
    return rows + [("long", "x" * 700), ("blank", " " * 300), ("null", None), ("empty", ""), ("last", "y " * 200 + "z" * 90)]


@pytest.mark.parametrize("size", [1, 2, 7, 64, 100_000])
def test_lines_have_the_same_terms(spark, size):
    rows = _texts(size)
    found: dict = {}
    for r in chunks.bounded_lines(spark.createDataFrame(rows, "doc string, text string"), size).collect():
        found.setdefault(r.doc, []).extend(TERM.findall(r.text or ""))
        longest = max(map(len, TERM.findall(r.text or "")), default=0)
        assert len(r.text or "") <= 2 * size + longest + 2
    assert {d: sorted(t) for d, t in found.items()} == {d: sorted(TERM.findall(t or "")) for d, t in rows}


@pytest.mark.parametrize("size", [3, 40])
def test_counts_and_scores_are_the_same(corpus, size):
    rows = _texts(size)
    expected = record(rows)
    table = corpus(rows)
    counted = {(r.doc, r.term): (r.word_count, r.doc_size) for r in term_counts_with_size(table, size).collect()}
    assert counted == {pair: values[:2] for pair, values in expected.items()}
    for grain in ("document", "line"):
        assert {(r.doc, r.term): r.word_count for r in term_counts(table, grain, size).collect()} == {
            pair: values[0] for pair, values in expected.items()
        }
        for strategy in ("window", "product"):
            assert_scores(score(table, grain, strategy, chunk_bytes=size, heavy={}), rows)
            assert_scores(score(table, grain, strategy, chunk_bytes=size, heavy={"=a": 3, "=b": 2}), rows)


def test_wrong_use_is_refused(corpus):
    table = corpus({"d": "a"})
    with pytest.raises(ValueError, match="positive"):
        chunks.bounded_lines(table, 0)
    with pytest.raises(ValueError, match="chunk_bytes"):
        score(table, strategy="lookup", chunk_bytes=10)


_LONG = """
import sys
sys.path.insert(0, {root!r})
import pyarrow as pa, pyarrow.parquet as pq
from pyspark.sql import functions as F
from termloom import build_session, term_counts
spark = build_session("long", "local[1]", **{{
    "spark.driver.memory": "700m", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}})
words = " ".join("w%d" % (k * k % 99991) for k in range(100000))
times = {size} // len(words)
pq.write_table(pa.table({{"doc": [1], "text": [(words + "\\n") * times]}}), {folder!r} + "/one.parquet")
pq.write_table(pa.table({{"doc": [1] * times, "text": [words] * times}}), {folder!r} + "/lines.parquet")
def told(frame):
    return tuple(frame.agg(F.count("*"), F.sum("word_count"), F.bit_xor(F.xxhash64("doc", "term", "word_count"))).first())
one = term_counts(spark.read.parquet({folder!r} + "/one.parquet"), chunk_bytes=1 << 20)
assert told(one) == told(term_counts(spark.read.parquet({folder!r} + "/lines.parquet"), "line"))
print("same counts")
"""


def test_a_text_that_is_a_large_part_of_the_heap(tmp_path):
    """40 MB of text, whose terms would fill the heap of 700 MB several times over."""
    script = _LONG.format(root=ROOT, size=40_000_000, folder=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "same counts" in done.stdout, done.stderr[-2000:]
