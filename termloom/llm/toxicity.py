"""Toxicity by a lexicon that forgives misspelling, and the context of its hits.

The lexicon is learned: the words whose documents are labelled toxic far more
often than others, near copies counting as one document. Its trie is intersected with Levenshtein automata, one for each
allowed number of edits; the product is determinised as it is walked, so a word
costs one step for each of its characters, and most end after a few.

Words are what stands between blanks and the marks that part words. One that has
further marks inside is looked at as it stands, then by its parts, then, if these
are single letters, as the word that they spell.

A hit's context is the words about it: whether it stands in quotation marks, and
whether further hits are near. A quoted lone hit is likely talked about; several
bare hits are likely abuse. A document's hits by distance and context are counted
and weighed by a logistic regression fitted to the labelled documents.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import add_columns, map_arrow, rows_where, saved, strings
from termloom.llm.near_dedup import BAND, hashes_for, sketches

# Labelled documents that are learned from, at most: those with the smallest hashes.
SAMPLE = 20_000
# Gain of a word's association (twice the log likelihood ratio) from which it is no
# chance, for one test; more words tested raise it by twice the log of their number.
GAIN = 10.83
# What a document that is not toxic counts against a word.
OTHER = 4
# Labelled toxic documents that must hold a word of the lexicon.
SUPPORT = 5
# How many times likelier a word must be in toxic documents.
RATIO = 8.0
# Similarity of signatures from which a labelled text is a near copy, and the chance to miss one.
ALIKE, MISS = 0.8, 1e-6
# Length from which a term may be misspelled by so many edits.
EDITS = ((8, 2), (5, 1), (0, 0))
# Words on each side that are a hit's context.
CONTEXT = 12
THRESHOLD = 0.7
REMEMBERED = 500_000

QUOTES = "\"'“”„‟‘’‚«»‹›"
_EDGE = QUOTES + ".,;:!?()[]{}<>|*_~`#&%$-–—…/\\"


# Marks that part words and that nobody writes in place of a letter.
_PARTING = ",;:/\\—–…·&+="
_INNER = re.compile(r"[\W_]+")


def cut(text: str) -> list[str]:
    """The words of a text in lower case, with the marks at their ends."""
    text = text.lower()
    for mark in _PARTING:
        if mark in text:
            text = text.replace(mark, " ")
    return text.split()


class Matcher:
    """The lexicon term nearest to a word, within the term's number of edits."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[int | None] = [None]
        self.budget: list[int] = [0]
        for number, term in enumerate(terms):
            edits, node = self.edits_of(term), 0
            self.budget[0] = max(self.budget[0], edits)
            for c in term:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(None)
                    self.budget.append(0)
                node = self.next[node][c]
                self.budget[node] = max(self.budget[node], edits)
            self.ends[node] = number
        self.reset()

    @staticmethod
    def edits_of(term: str) -> int:
        return next(e for length, e in EDITS if len(term) >= length)

    def reset(self) -> None:
        self.states = [self._closed({0: 0})]
        self.numbers = {self.states[0]: 0}
        self.steps: list[dict[str, int]] = [{}]
        self.results: list[tuple[int, int] | None] = [self._result(self.states[0])]

    def _closed(self, nodes: dict[int, int]) -> tuple:
        """Add what is reached by skipping characters of terms."""
        queue = list(nodes.items())
        while queue:
            node, edits = queue.pop()
            for child in self.next[node].values():
                if edits + 1 <= self.budget[child] and nodes.get(child, 9) > edits + 1:
                    nodes[child] = edits + 1
                    queue.append((child, edits + 1))
        return tuple(sorted(nodes.items()))

    def _result(self, state: tuple) -> tuple[int, int] | None:
        found = [(e, self.ends[n]) for n, e in state if self.ends[n] is not None and e <= self.edits_of(self.terms[self.ends[n]])]
        return (min(found)[1], min(found)[0]) if found else None

    def _step(self, state: tuple, c: str) -> int:
        nodes: dict[int, int] = {}

        def reach(node, edits):
            if edits <= self.budget[node] and nodes.get(node, 9) > edits:
                nodes[node] = edits

        for node, edits in state:
            reach(node, edits + 1)
            for char, child in self.next[node].items():
                reach(child, edits + (char != c))
        closed = self._closed(nodes)
        if closed not in self.numbers:
            self.numbers[closed] = len(self.states)
            self.states.append(closed)
            self.steps.append({})
            self.results.append(self._result(closed))
        return self.numbers[closed]

    def match(self, word: str) -> tuple[int, int] | None:
        """``(term number, edits)``"""
        if len(self.states) > 50_000:
            self.reset()
        state = 0
        for c in word:
            following = self.steps[state].get(c)
            if following is None:
                following = self.steps[state][c] = self._step(self.states[state], c)
            state = following
            if not self.states[state]:
                return None
        return self.results[state]


# A document's features: bare and quoted hits by edits, near hits, and the terms' weight.
FEATURES = 8
# What the weights are before any document is seen: the constant first.
_PRIOR = np.array([-3.0, 2.5, 1.5, 0.7, 0.3, 0.1, 0.0, 0.5, 0.3])
_NO_HITS = (0,) * FEATURES


class Scorer:
    def __init__(self, terms: list[tuple[str, float]]):
        self.matcher = Matcher([t for t, _ in terms])
        self.strength = [s for _, s in terms]
        self.known: dict[str, tuple[int, int] | bool] = {}

    def _match(self, word: str):
        bare = word.strip(_EDGE)
        found = (len(bare) <= 64 and bare and self.matcher.match(bare)) or False
        if not found and not bare.isalnum():
            parts = [x for x in _INNER.split(bare) if x]
            if len(parts) > 1:
                if all(len(x) == 1 for x in parts):
                    parts = ["".join(parts)]
                hits = [m for x in parts if len(x) <= 64 and (m := self.matcher.match(x))]
                # The hit with the fewest edits stands for all.
                found = min(hits, key=lambda m: (m[1], m[0]), default=False)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = found
        return found

    def features(self, text: str) -> tuple[int, ...]:
        """Small whole numbers, so that documents fall into few groups."""
        words = cut(text)
        found = list(map(self.known.get, words))
        if None in found:
            found = [self._match(w) if x is None else x for w, x in zip(words, found)]
        if not any(found):
            return _NO_HITS
        hits = [(i, x) for i, x in enumerate(found) if x]
        counts = [0] * FEATURES
        seen: dict[int, int] = {}
        last = None
        for i, (term, edits) in hits:
            quoted = _quoted(words, i)
            counts[edits + 3 * quoted] += 1
            if last is not None and i - last <= CONTEXT and not quoted:
                counts[6] += 1
            last = i
            if not quoted:
                seen[term] = min(seen.get(term, 9), edits)
        strength = sum(self.strength[t] / (1 + e) for t, e in seen.items())
        counts[7] = round(strength)
        return (*(min(c, 4) for c in counts[:7]), min(counts[7], 12))


def _quoted(words: list[str], at: int) -> bool:
    """Whether an open quotation mark stands before a word and a closing one after it."""
    def opens(w):
        return w[0] in QUOTES and w[0] != "'"

    def closes(w):
        return w.rstrip(".,;:!?")[-1:] in tuple(QUOTES.replace("'", ""))

    before = False
    for k in range(at, max(-1, at - CONTEXT), -1):
        if opens(words[k]):
            before = True
            break
        if k < at and closes(words[k]):
            break
    if not before:
        return False
    return any(closes(words[k]) for k in range(at, min(len(words), at + CONTEXT)))


def _near_copies(signatures: np.ndarray) -> np.ndarray:
    """Which rows are like an earlier row that shares a band with them: the first of its bucket."""
    copies = np.zeros(len(signatures), bool)
    for at in range(0, signatures.shape[1], BAND):
        keys = np.ascontiguousarray(signatures[:, at : at + BAND]).view(f"V{4 * BAND}").ravel()
        _, first, bucket = np.unique(keys, return_index=True, return_inverse=True)
        hub = first[bucket]
        alike = (signatures == signatures[hub]).mean(axis=1) >= ALIKE
        copies |= alike & (hub != np.arange(len(hub)))
    return copies


def learn_terms(sample: DataFrame) -> list[tuple[str, float]]:
    """``(word, log ratio)`` of the words that mark toxic documents.

    Equal texts, and near copies by the signatures of their five-word shingles (ALIKE),
    count once, as toxic if any of them is marked so. The sample's signatures, SAMPLE
    at most, are compared by the driver. Candidates are the words in SUPPORT toxic
    texts or more whose association is strong (RATIO) and no chance (GAIN); there is
    no limit to their number. The lexicon is chosen by weighted covering: each choice
    makes its documents count less for the next, so that the words that only some
    variants of one toxic text share do not follow on each other.
    """
    texts = sample.groupBy("text").agg(F.max("toxic").alias("toxic"))
    # Toxic copies first, so that these stay.
    number = F.shiftright(F.xxhash64("text"), 1) + F.when(F.col("toxic") == 0, 2**62).otherwise(-(2**62))
    texts = saved(sketches(texts.withColumn("doc_id", number), 5, hashes_for(ALIKE, MISS)))
    signed = texts.where("signature IS NOT NULL").select("doc_id", "signature").orderBy("doc_id").collect()
    dropped = []
    if signed:
        copies = _near_copies(np.stack([np.frombuffer(r.signature, np.uint32) for r in signed]))
        dropped = [(r.doc_id,) for r, copy in zip(signed, copies) if copy]
    # No more rows than the sample has, of one number each.
    away = sample.sparkSession.createDataFrame(dropped, "doc_id bigint")
    sample = texts.select("doc_id", "text", "toxic").join(F.broadcast(away), "doc_id", "left_anti")
    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    n, p = totals.n, totals.p
    if not p or p == n:
        return []
    own = F.filter(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")), lambda w: F.length(w).between(3, 40))
    words = sample.select("doc_id", "toxic", F.explode(own).alias("word"))
    counts = words.groupBy("word").agg(F.sum("toxic").alias("a"), F.count("*").alias("m")).where(F.col("a") >= SUPPORT)
    a, m = F.col("a"), F.col("m")
    b = m - a
    ratio = F.log((a + 0.5) / (p + 1)) - F.log((b + 0.5) / (n - p + 1))
    gain = 2 * (a * F.log(a * n / (m * p)) + b * F.log(F.greatest(b, F.lit(0.5)) * n / (m * (n - p))))
    tested = saved(counts.select("word", ratio.alias("ratio"), gain.alias("gain")))
    least = GAIN + 2 * math.log(max(1, tested.count()))
    best = tested.where((F.col("ratio") >= math.log(RATIO)) & (F.col("gain") >= least))
    held = words.join(best.select("word", "ratio"), "word")
    # A candidate's documents, as numbers; toxic ones, and how many others. Bounded by the sample.
    rows = held.groupBy("word").agg(
        F.first("ratio").alias("ratio"),
        F.array_sort(F.collect_list(F.when(F.col("toxic") == 1, F.col("doc_id")))).alias("toxic"),
        F.sum(1 - F.col("toxic")).alias("other"),
    )
    found = {r.word: r for r in rows.collect()}
    weights: dict[int, float] = defaultdict(lambda: 1.0)

    def value(word: str) -> float:
        return sum(weights[d] for d in found[word].toxic) - OTHER * found[word].other

    # Values only fall, so the best of old values that is still the best anew is the best of all.
    chosen, queue = [], [(-value(w), w) for w in found]
    heapq.heapify(queue)
    while queue:
        _, word = heapq.heappop(queue)
        now = -value(word)
        if queue and (now, word) > queue[0]:
            heapq.heappush(queue, (now, word))
            continue
        if -now < SUPPORT:
            break
        chosen.append((word, float(found[word].ratio)))
        for d in found[word].toxic:
            weights[d] = 1 / (1 / weights[d] + 1)
    return chosen


def fit(groups: list[tuple[tuple[int, ...], int, int]], rounds: int = 30, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression over groups ``(features, documents, toxic)``, drawn to ``_PRIOR``."""
    weights = _PRIOR.copy()
    if not groups:
        return weights
    x = np.array([[1.0, *g[0]] for g in groups])
    n, y = (np.array([g[k] for g in groups], float) for k in (1, 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (y - n * p) - ridge * (weights - _PRIOR)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, gradient)
        weights = weights + step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[str, float]], np.ndarray]:
    """Lexicon and weights from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    Runs jobs. Takes SAMPLE labelled documents at most; labels that are null or
    without a document are left out. Without toxic or without other documents the
    lexicon is empty.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE)
    )
    # No more than SAMPLE rows of two numbers are broadcast.
    sample = saved(
        docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    )
    terms = learn_terms(sample)
    if not terms:
        return [], _PRIOR.copy()

    def run(batches):
        scorer = Scorer(terms)
        counts: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, toxic in zip(strings(batch["text"]), batch["toxic"].to_pylist()):
                group = counts[scorer.features(text)]
                group[0] += 1
                group[1] += toxic
        keys = [",".join(map(str, k)) for k in counts]
        n, y = ([v[i] for v in counts.values()] for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(n, pa.int64()), pa.array(y, pa.int64())], names=["key", "n", "y"]
        )

    groups = map_arrow(sample, run, "key string, n bigint, y bigint").groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("y").alias("y")
    )
    # No more groups than documents in the sample.
    found = [(tuple(map(int, r.key.split(","))), r.n, r.y) for r in groups.orderBy("key").collect()]
    return terms, fit(found)


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """``docs`` with ``score``, the chance that ``text`` is toxic, and ``predicted`` (0 or 1).

    Null and empty texts score as texts without hits. Rows stay where they are.
    """
    terms, weights = model

    def start():
        scorer = Scorer(terms)

        def compute(texts: pa.Array):
            x = np.array([scorer.features(t) for t in strings(texts)], float).reshape(-1, FEATURES)
            scores = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            return scores.tolist(), (scores >= THRESHOLD).astype(int).tolist()

        return compute

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(docs, ["text"], added, start)


def training_labels(labels: DataFrame, folds: int, held_out: int) -> DataFrame:
    """Labels of the documents that may be learned from."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % folds != held_out)


def harmless(docs: DataFrame, model: tuple) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, columns unchanged."""
    return rows_where(docs, ["text"], lambda d: score(d, model), "predicted = 0")
