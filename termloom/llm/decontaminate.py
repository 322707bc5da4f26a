"""Benchmark decontamination: a prefix-filtered join of windows with documents.

A window is WINDOW consecutive words of a benchmark item; a shorter item is one
window. A window holds the shingles of up to SHINGLE words inside it. A document
with the whole window holds all of its shingles, so the rarest one is a prefix
that suffices: shingles are ordered by the number of documents that hold them,
and documents are joined on each window's rarest shingle only. The place of the
shingle gives the window's place in the document, which must lie inside it; then
all words are compared.

The benchmark is taken in blocks of bounded size, each of which is broadcast, so
documents are never shuffled. Each block costs two passes over the texts.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import (
    LETTERS_AND_DIGITS,
    add_columns,
    byte_groups,
    combine,
    kept_by,
    map_arrow,
    rows_where,
    words,
)

WINDOW = 13
SHINGLE = 5
# Benchmark text that is broadcast at once.
BLOCK_BYTES = 4 << 20
# Share of hit words that makes a document contaminated: one in so many.
ONE_IN = 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SIEVE = np.uint64((1 << 22) - 1)


class Windows:
    """The distinct windows of some items ``(item_id, text)``."""

    def __init__(self, items: list[tuple]):
        self.items = defaultdict(set)
        for item, text in items:
            for window in item_windows(text):
                self.items[window].add(item)
        self.windows = sorted(self.items)
        self.shingles = [window_shingles(w) for w in self.windows]
        self.sizes = sorted({min(SHINGLE, len(w)) for w in self.windows})
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.shingles]))


def item_windows(text: str | None) -> list[tuple[bytes, ...]]:
    own = list(word_bytes((text or "").encode()))
    if not own:
        return []
    size = min(WINDOW, len(own))
    return [tuple(own[i : i + size]) for i in range(len(own) - size + 1)]


def word_bytes(text: bytes) -> list[bytes]:
    data = np.frombuffer(text, np.uint8)
    _, first, end = words(data, np.array([0, len(data)]), LETTERS_AND_DIGITS)
    lower = text.translate(_LOWER)
    return [lower[a:b] for a, b in zip(first.tolist(), end.tolist())]


def window_shingles(window: tuple[bytes, ...]) -> np.ndarray:
    joined = b" ".join(window)
    hashes, *_ = words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), LETTERS_AND_DIGITS)
    size = min(SHINGLE, len(hashes))
    return combine([hashes[j : len(hashes) - size + 1 + j] for j in range(size)])


_BUILT: dict[str, Windows] = {}


def _built(key: str, held: Broadcast) -> Windows:
    """The block's windows, made once by each Python worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Windows(held.value)
    return _BUILT[key]


kept_by(__name__, _BUILT.clear)


def _sieve(known: np.ndarray) -> np.ndarray:
    out = np.zeros(int(_SIEVE) + 1, bool)
    out[(known & _SIEVE).astype(np.int64)] = True
    return out


def _found(hashes, first, ends, sizes, known, sieve):
    """Numbers of the words at which a known shingle begins, and its place in ``known``."""
    rows = np.searchsorted(ends, first, side="right")
    for size in sizes:
        n = len(hashes) - size + 1
        if n <= 0 or not len(known):
            continue
        runs = combine([hashes[j : n + j] for j in range(size)])
        at = np.flatnonzero(sieve[(runs & _SIEVE).astype(np.int64)] & (rows[:n] == rows[size - 1 :]))
        place = np.minimum(np.searchsorted(known, runs[at]), len(known) - 1)
        same = known[place] == runs[at]
        yield at[same], place[same], rows


def shingle_counts(docs: DataFrame, key: str, held: Broadcast) -> dict[int, int]:
    """Number of documents with each shingle of a block; no more than the block has."""

    def run(batches):
        index = _built(key, held)
        sieve = _sieve(index.known)
        counts = np.zeros(len(index.known), np.int64)
        for batch in batches:
            for _, data, ends in byte_groups(batch["text"]):
                hashes, first, _ = words(data, ends, LETTERS_AND_DIGITS)
                for at, place, rows in _found(hashes, first, ends, index.sizes, index.known, sieve):
                    once = np.unique(np.stack([rows[at], place]), axis=1)[1]
                    counts += np.bincount(once, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(index.known[some].view(np.int64)), pa.array(counts[some])],
            names=["shingle", "n"],
        )

    counts = map_arrow(docs.select("text"), run, "shingle bigint, n bigint")
    rows = counts.groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    return {r.shingle & 0xFFFFFFFFFFFFFFFF: r.n for r in rows}


def _hits(
    docs: DataFrame, key: str, held: Broadcast, counted: Broadcast, block: int
) -> DataFrame:
    """Add ``n_words``, the ranges of hit words and the items met in one block."""

    def start():
        index = _built(key, held)
        counts = counted.value
        prefix = defaultdict(list)
        for number, own in enumerate(index.shingles):
            where = min(range(len(own)), key=lambda k: (counts.get(int(own[k]), 0), int(own[k])))
            prefix[int(own[where])].append((where, number))
        known = np.array(sorted(prefix), np.uint64)
        sieve = _sieve(known)

        def compute(texts: pa.Array):
            n_words, ranges, items = [], [], []
            for _, data, ends in byte_groups(texts):
                hashes, first, end = words(data, ends, LETTERS_AND_DIGITS)
                begin = np.searchsorted(first, ends)
                n_words.extend(np.diff(begin).tolist())
                got = defaultdict(list)
                for at, place, rows in _found(hashes, first, ends, index.sizes, known, sieve):
                    for p, k in zip(at.tolist(), place.tolist()):
                        row = int(rows[p]) - 1
                        for where, number in prefix[int(known[k])]:
                            window = index.windows[number]
                            lo, hi = p - where, p - where + len(window)
                            if lo < begin[row] or hi > begin[row + 1]:
                                continue
                            if all(
                                data[first[i] : end[i]].tobytes().translate(_LOWER) == w
                                for i, w in zip(range(lo, hi), window)
                            ):
                                got[row].append((lo - int(begin[row]), hi - int(begin[row]), number))
                for row in range(len(ends) - 1):
                    flat, names = [], set()
                    for lo, hi, number in sorted(got.get(row, ())):
                        names |= index.items[index.windows[number]]
                        if flat and lo <= flat[-1]:
                            flat[-1] = max(flat[-1], hi)
                        else:
                            flat += [lo, hi]
                    ranges.append(flat)
                    items.append(sorted(n for n in names if n is not None))
            return n_words, ranges, items

        return compute

    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField(f"_ranges_{block}", T.ArrayType(T.LongType())),
        T.StructField(f"_items_{block}", T.ArrayType(T.StringType())),
    ]
    return add_columns(docs, ["text"], added, start)


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, item_ids, contaminated``, row by row.

    ``benchmark`` has ``item_id`` and ``text``. Words are runs of letters, digits
    and characters beyond ASCII, with A-Z in lower case. A word is hit if it lies
    in an occurrence of a window; a document is contaminated if one word in ONE_IN
    is hit. Null and empty texts have no words and are clean; items without words
    match nothing; the windows of an item without item_id hit words, but name no
    item. Items of one item_id count once. Counts the benchmark's shingles in all
    texts when called.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    texts = docs
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = [tuple(r) for r in items.where(part == block).collect()]
        key, held = uuid.uuid4().hex, spark.sparkContext.broadcast(rows)
        counted = spark.sparkContext.broadcast(shingle_counts(texts, key, held))
        docs = _hits(docs, key, held, counted, block)
    temporary = [f"_{kind}_{b}" for b in range(blocks) for kind in ("ranges", "items")]

    def start():
        def compute(*columns):
            n_hit, names = [], []
            ranges = [c.to_pylist() for c in columns[:blocks]]
            items = [c.to_pylist() for c in columns[blocks:]]
            for row in range(len(ranges[0])):
                spans = sorted(
                    (a, b) for r in ranges for a, b in zip(r[row][::2], r[row][1::2])
                )
                total = reach = 0
                for a, b in spans:
                    total += max(0, b - max(a, reach))
                    reach = max(reach, b)
                n_hit.append(total)
                names.append(sorted({x for i in items for x in i[row]}))
            return n_hit, [len(n) for n in names], names

        return compute

    added = [
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
    ]
    inputs = temporary[::2] + temporary[1::2]
    hit = F.col("n_hit")
    return (
        add_columns(docs, inputs, added, start)
        .drop(*temporary)
        .withColumn("contaminated", (hit > 0) & (ONE_IN * hit >= F.col("n_words")))
    )



def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged."""
    return rows_where(docs, ["text"], lambda d: decontaminate(d, benchmark), "NOT contaminated")
