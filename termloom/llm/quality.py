"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is described by the shapes of its characters (runs of three character
classes), of which junk, tables, shouting and repetition have their own mixture,
and by how often a word repeats the one before it. Weighted by rarity and reduced
to DIMENSIONS by a singular value decomposition fitted to labelled documents, two
texts are compared by the cosine of their vectors. The labelled vectors are
broadcast; every document is compared with all of them, in blocks, and the labels
of the NEIGHBOURS nearest are weighed by a power of their similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import NOT_BLANK, add_columns, byte_groups, saved, words

# Labelled documents whose vectors are broadcast, at most: those with the smallest hashes.
SAMPLE = 4_000
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8
THRESHOLD = 0.3
# Documents that are compared at once.
BLOCK = 512

# Classes of a byte: small and capital letters, digits, white space, marks, others.
_KINDS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    if _b >= 128 or _c.islower():
        _KINDS[_b] = 1
    elif _c.isupper():
        _KINDS[_b] = 2
    elif _c.isdigit():
        _KINDS[_b] = 3
    elif _c == "\n":
        _KINDS[_b] = 5
    elif _c.isspace():
        _KINDS[_b] = 4
    elif _c in ".,;:":
        _KINDS[_b] = 6
    elif _c in "!?":
        _KINDS[_b] = 7
    elif _c in "'\"()-":
        _KINDS[_b] = 8
    elif _c in "|\\/<>{}[]=_":
        _KINDS[_b] = 9
    elif _b >= 32:
        _KINDS[_b] = 10
_BASE = 11
SHAPES = _BASE**3
# Beside the shapes: words that repeat the one before, words that stood before, lengths.
EXTRA = 16
FEATURES = SHAPES + EXTRA


def describe(texts: pa.Array) -> np.ndarray:
    """A row of relative frequencies for each text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for row, data, ends in byte_groups(texts):
        n = len(ends) - 1
        if len(data) > 2:
            kinds = _KINDS[data]
            codes = (kinds[:-2] * _BASE + kinds[1:-1]) * _BASE + kinds[2:]
            own = np.repeat(np.arange(n), np.diff(ends))
            inside = own[:-2] == own[2:]
            # Sizes of runs of one class say little: three alike count once in a while only.
            places = own[:-2][inside] * SHAPES + codes[inside]
            counts = np.bincount(places, minlength=n * SHAPES).reshape(n, SHAPES)
            out[row : row + n, :SHAPES] = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        hashes, first, _ = words(data, ends, NOT_BLANK)
        begin = np.searchsorted(first, ends)
        for k in range(n):
            own = hashes[begin[k] : begin[k + 1]]
            if len(own) > 1:
                again = float((own[1:] == own[:-1]).mean())
                distinct = len(np.unique(own)) / len(own)
                out[row + k, SHAPES + min(7, int(again * 16))] = 1.0
                out[row + k, SHAPES + 8 + min(7, int(distinct * 8))] = 0.3
            elif len(own) == 1:
                out[row + k, SHAPES + 15] = 0.3
    return out


class Space:
    """Rarity weights and the directions of the labelled documents' largest variance."""

    def __init__(self, frequencies: np.ndarray):
        held = (frequencies > 0).sum(axis=0)
        self.weights = np.log((1 + len(frequencies)) / (1 + held)) + 0.2
        weighted = self._weighted(frequencies)
        _, _, directions = np.linalg.svd(weighted.T @ weighted, hermitian=True)
        self.directions = directions[:DIMENSIONS].T.astype(np.float32)

    def _weighted(self, frequencies: np.ndarray) -> np.ndarray:
        x = np.sqrt(frequencies) * self.weights.astype(np.float32)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def vectors(self, frequencies: np.ndarray) -> np.ndarray:
        """Of length one, or zero for texts that share nothing with the space."""
        x = self._weighted(frequencies) @ self.directions
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Voter:
    def __init__(self, texts: pa.Array, labels: np.ndarray):
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if len(labels):
            frequencies = describe(texts)
            self.space = Space(frequencies)
            self.held = self.space.vectors(frequencies)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        out = []
        for at in range(0, len(texts), BLOCK):
            vectors = self.space.vectors(describe(texts.slice(at, BLOCK)))
            near = vectors @ self.held.T
            k = min(NEIGHBOURS, near.shape[1])
            places = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weights = np.maximum(np.take_along_axis(near, places, axis=1), 0) ** SHARPNESS
            # One vote of the prior: a text that is like none gets it.
            votes = (weights * self.labels[places]).sum(axis=1) + 0.1 * self.prior
            out.append(votes / (weights.sum(axis=1) + 0.1))
        return np.concatenate(out) if out else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame) -> Voter:
    """A voter from ``docs(doc_id, text)`` and ``labels(doc_id, quality)``.

    Runs jobs. Takes SAMPLE labelled documents at most; labels that are null or
    without a document are left out. Without any, all texts score 0.5.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE)
    )
    # No more than SAMPLE rows of two numbers are broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")

    def start():
        def compute(texts: pa.Array):
            return ([row.astype("<f4").tobytes() for row in describe(texts)],)

        return compute

    described = add_columns(sample, ["text"], [T.StructField("shape", T.BinaryType())], start)
    rows = saved(described.drop("text")).orderBy("doc_id", "quality", "shape").limit(SAMPLE).collect()
    voter = Voter(pa.array([], pa.string()), np.zeros(0))
    if rows:
        frequencies = np.stack([np.frombuffer(r["shape"], "<f4") for r in rows])
        voter.labels = np.array([r.quality for r in rows], np.float32)
        voter.prior = float(voter.labels.mean())
        voter.space = Space(frequencies)
        voter.held = voter.space.vectors(frequencies)
    return voter


def score(docs: DataFrame, voter: Voter) -> DataFrame:
    """``docs`` with ``score``, the neighbours' share of good labels, and ``predicted`` (0 or 1).

    Null and empty texts get the share of good labels among all. Rows stay where
    they are.
    """
    held = docs.sparkSession.sparkContext.broadcast(voter)

    def start():
        own = held.value

        def compute(texts: pa.Array):
            scores = own.scores(texts).clip(0, 1)
            return scores.astype(float).tolist(), (scores >= THRESHOLD).astype(int).tolist()

        return compute

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(docs, ["text"], added, start)
