"""Document fingerprints: one-permutation MinHash with optimal densification.

All shingles of a text are hashed once. The hash's high bits choose one of BINS
bins, which keeps its smallest hash. An empty bin takes the value of the first
filled bin in an order of its own, the same for all texts. BITS low-order bits of
each bin are kept, one hexadecimal digit. Two unequal values agree in these bits
with probability 2**-BITS, which the likeness is corrected for.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import NOT_BLANK, map_arrow, mix, shingles, word_rows

SHINGLE = 5
BINS = 256
BITS = 4

_SHIFT = np.uint64(56)
_STARTS = np.arange(BINS, dtype=np.uint64) << _SHIFT
_ORDERS = np.argsort(
    mix(np.arange(1, BINS * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BINS, BINS),
    axis=1,
)
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def fingerprint(elements: np.ndarray) -> str:
    """Of a set of hashes; the empty set's is empty."""
    if not len(elements):
        return ""
    values = np.sort(mix(elements))
    at = np.minimum(np.searchsorted(values, _STARTS), len(values) - 1)
    least = values[at]
    filled = least >> _SHIFT == np.arange(BINS, dtype=np.uint64)
    empty = np.flatnonzero(~filled)
    if len(empty):
        orders = _ORDERS[empty]
        first = filled[orders].argmax(axis=1)
        least[empty] = least[orders[np.arange(len(empty)), first]]
    return _DIGITS[(mix(least) & np.uint64((1 << BITS) - 1)).astype(np.int64)].tobytes().decode()


def fingerprints(texts: list[str]) -> list[str]:
    array = pa.array(texts, pa.string())
    return [fingerprint(shingles(h, SHINGLE)) for h, *_ in word_rows(array, NOT_BLANK)]


def likeness(one: str, two: str) -> float:
    """Estimated Jaccard similarity of the sets behind two fingerprints.

    Two empty sets are alike, an empty set is unlike any other.
    """
    if not one or not two:
        return float(one == two)
    a, b = (np.frombuffer(x.encode(), np.uint8) for x in (one, two))
    chance = 2.0**-BITS
    return max(0.0, (float((a == b).mean()) - chance) / (1 - chance))


def with_next(docs: DataFrame, compute, schema: str) -> DataFrame:
    """``compute(doc_ids, texts, next_texts)`` over all documents in order of doc_id.

    The next document of the last one is the first one. Rows without doc_id stand
    first, rows of one doc_id in order of their texts. Documents are dealt out by
    ranges of doc_id; the first of each range stands once more at the end of the
    range before, so that neighbours meet in one task.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * parts
    bounds = sorted(
        set(docs.select("doc_id").approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.1 / ranges))
    )
    if bounds:
        below = F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("doc_id"))
        part = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(below))
    else:
        part = F.lit(0)
    dealt = docs.withColumn("part", part)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    # One row for each range.
    firsts = dealt.groupBy("part").agg(F.min(order).alias("o")).orderBy("part").collect()
    before = {r.part: firsts[k - 1].part for k, r in enumerate(firsts)}
    heads = docs.sparkSession.createDataFrame(
        [(r.part, before[r.part], r.o.doc_id) for r in firsts], "own int, part int, head bigint"
    )
    same = docs["doc_id"].eqNullSafe(heads["head"])
    heads = docs.join(F.broadcast(heads), same).groupBy("own", "part", "doc_id").agg(F.min("text").alias("text"))
    rows = dealt.select("part", F.lit(0).alias("tail"), "doc_id", "text").union(
        heads.select("part", F.lit(1), "doc_id", "text")
    )
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "tail", "doc_id", "text")

    def run(batches):
        held = None
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                columns = [some[c].to_pylist() for c in ("part", "tail", "doc_id", "text")]
                lines = list(zip(*columns)) if held is None else [held, *zip(*columns)]
                held = lines[-1]
                ready = [(a[2], a[3], b[3]) for a, b in zip(lines, lines[1:]) if not a[1]]
                if ready:
                    yield compute(*zip(*ready))

    return map_arrow(rows, run, schema)


def edited(text: str, following: str) -> str:
    """The last half of ``text``, rounded down, replaced by as much of ``following``'s start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's, and their likeness.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Shingles are SHINGLE words between blanks, A-Z in
    lower case; a shorter text is one shingle. A null text counts as an empty one.
    See ``with_next`` for the order of documents. Further columns are not read.
    Runs jobs when called.
    """

    def compute(ids, texts, following):
        changed = [edited(a, b) for a, b in zip(texts, following)]
        own, new = fingerprints(texts), fingerprints(changed)
        # Mostly, what follows is the next row.
        known = dict(zip(texts, own))
        rest = [t for t in following if t not in known]
        known.update(zip(rest, fingerprints(rest)))
        then = [known[t] for t in following]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array(own),
                pa.array(new),
                pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, then)], pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return with_next(
        docs,
        compute,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
