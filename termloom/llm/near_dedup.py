"""Near-duplicate groups by MinHash, with sequential Bayesian verification.

1. A document's set is its distinct word shingles, as 64-bit hashes. Documents of
   equal sets form a class at once, so copies never meet in pairs.
2. A class has a MinHash signature. Its bands put classes into buckets.
3. In each bucket all members are compared with the smallest one. This joins most
   near copies by as many pairs as there are members. What then still lies in
   different components of one bucket is compared in blocks of bounded size, in
   which pairs are neither written out nor compared once links have joined them.
4. A pair's signatures are compared batch by batch. After each batch the pair is
   dropped if, given the matches so far, the posterior probability of a similarity
   at the threshold is below ``miss``.
5. The pairs left are confirmed on the full sets of both texts. Confirmed links are
   joined to components.

There are as many bands as make a pair of the threshold's similarity t share no
bucket with probability ``miss`` at most: (1 - t**BAND)**bands. ``miss`` counts once
more for each batch of signature values. Rows that share a doc_id count as one
document in the links.

A bucket's smallest member meets all others, so its rows are dealt to SALTS tasks,
each with one copy of what the smallest member brings.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import (
    NOT_BLANK,
    add_columns,
    map_arrow,
    mix,
    saved,
    shingles,
    word_rows,
)
from termloom.llm.components import components

BAND = 5
# Signature values are compared in batches of so many.
BATCH = 25
MISS = 1e-6
# Largest block of a bucket that is compared within one task.
SLICE = 512
# Parts that the rows of one bucket, or the pairs of one hub, are dealt to.
SALTS = 64


def hashes_for(threshold: float, miss: float) -> int:
    """Signature values that the bands of a threshold need, in whole batches."""
    bands = math.ceil(math.log(miss) / math.log1p(-(threshold**BAND))) if threshold < 1 else 1
    return BATCH * math.ceil(max(1, bands) * BAND / BATCH)


@functools.cache
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return random[:count] | np.uint64(1), random[count:]


def signature(elements: np.ndarray, count: int) -> bytes:
    """``count`` minima of 32 bits, for a set that is not empty."""
    a, b = _functions(count)
    out = np.empty(count, np.uint32)
    step = max(1, (1 << 15) // len(elements))
    for k in range(0, count, step):
        values = elements[None, :] * a[k : k + step, None] + b[k : k + step, None]
        out[k : k + step] = (values >> np.uint64(32)).min(axis=1)
    return out.tobytes()


def set_of(hashes: np.ndarray, size: int) -> np.ndarray:
    return np.unique(shingles(hashes, size))


def digest(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, size: int, count: int) -> DataFrame:
    """``docs`` with ``n_shingles``, ``set_digest`` and ``signature`` (null for empty sets)."""

    def start():
        def compute(texts: pa.Array):
            n, digests, signatures = [], [], []
            for hashes, *_ in word_rows(texts, NOT_BLANK):
                elements = set_of(hashes, size)
                n.append(len(elements))
                digests.append(digest(elements) if len(elements) else None)
                signatures.append(signature(elements, count) if len(elements) else None)
            return n, digests, signatures

        return compute

    added = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_digest", T.BinaryType()),
        T.StructField("signature", T.BinaryType()),
    ]
    return add_columns(docs, ["text"], added, start)


@functools.cache
def needed_matches(threshold: float, miss: float) -> tuple[int, ...]:
    """Fewest matches after each batch of ``hashes_for`` values that keep a pair alive.

    The similarity has a uniform prior, so after m matches of n its posterior is
    Beta(m + 1, n - m + 1), and the chance that it reaches t is that of at most m
    hits in n + 1 trials of probability t.
    """
    bounds = []
    for n in range(BATCH, hashes_for(threshold, miss) + 1, BATCH):
        tail, m = 0.0, -1
        while m < n and tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        bounds.append(m)
    return tuple(bounds)


def plausible(left: np.ndarray, right: np.ndarray, bounds: tuple[int, ...]) -> np.ndarray:
    """Places of the rows of two signature matrices that no batch rules out."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, bound in enumerate(bounds):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, cut] == right[alive, cut]).sum(axis=1)
        alive = alive[matches[alive] >= bound]
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _salt(name: str):
    return F.pmod(F.xxhash64(name), F.lit(SALTS))


def _both(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """``(a, b, x, y)``: ``pairs(a, b)`` with ``value`` of both sides.

    A hub may be the ``a`` of any share of the pairs: its value goes to those of its
    SALTS parts that have pairs, once to each.
    """
    salted = pairs.withColumn("salt", _salt("b"))
    one = table.select(F.col("rep").alias("a"), F.col(value).alias("x"))
    two = table.select(F.col("rep").alias("b"), F.col(value).alias("y"))
    hubs = salted.select("a", "salt").dropDuplicates().join(one, "a")
    return salted.join(two, "b").join(hubs, ["a", "salt"]).select("a", "b", "x", "y")


def _plausible_pairs(pairs: DataFrame, classes: DataFrame, bounds) -> DataFrame:
    """``pairs(a, b)`` less those that the signatures rule out."""
    joined = _both(pairs, classes, "signature")

    def run(batches):
        for batch in batches:
            if len(batch):
                keep = plausible(_matrix(batch["x"]), _matrix(batch["y"]), bounds)
                yield batch.select(["a", "b"]).take(pa.array(keep))

    return map_arrow(joined, run, "a bigint, b bigint")


def _linked(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``pairs(a, b)`` whose full sets overlap by ``percent`` of their union at least."""
    joined = _both(pairs, texts, "text")

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            keep, last, left = [], None, None
            a = batch["a"].to_pylist()
            pairs = zip(word_rows(batch["x"], NOT_BLANK), word_rows(batch["y"], NOT_BLANK))
            for row, ((x, *_), (y, *_)) in enumerate(pairs):
                if a[row] != last:
                    last, left = a[row], set_of(x, size)
                right = set_of(y, size)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= percent * (len(left) + len(right) - both):
                    keep.append(row)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return map_arrow(joined, run, "a bigint, b bigint")


def _buckets(classes: DataFrame, bands: int) -> DataFrame:
    """``(bucket, band, rep)`` of the buckets with two members or more."""
    width = 4 * BAND
    keys = [
        F.xxhash64(F.lit(k), F.substring("signature", k * width + 1, width)) for k in range(bands)
    ]
    rows = classes.select("rep", F.posexplode(F.array(*keys)).alias("band", "bucket"))
    full = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return saved(rows.join(full, "bucket").select("bucket", "band", "rep"))


def _labelled(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that lie in two components or more, with ``component``."""
    found = components(links).withColumnRenamed("node", "rep")
    rows = buckets.join(found, "rep", "left").select(
        "bucket", "band", "rep", F.coalesce("component", "rep").alias("component")
    )
    open_ = rows.groupBy("bucket").agg(
        F.min("component").alias("first"), F.max("component").alias("last")
    ).where("first <> last")
    return saved(rows.join(open_.select("bucket", "first"), "bucket"))


def _star(members: DataFrame) -> DataFrame:
    """Each bucket's members paired with its smallest one."""
    salted = members.select("bucket", F.col("rep").alias("b"), _salt("rep").alias("salt"))
    parts = salted.groupBy("bucket", "salt").agg(F.min("b").alias("least"))
    hubs = parts.groupBy("bucket").agg(F.min("least").alias("a"))
    pairs = salted.join(parts.join(hubs, "bucket").drop("least"), ["bucket", "salt"])
    return pairs.where("a <> b").select("a", "b").dropDuplicates()


class _Sets:
    """Members of a block: sets are made when first asked for, links found are joined."""

    def __init__(self, block: pa.Table, size: int):
        self.texts, self.size = block["text"].combine_chunks(), size
        self.sets: dict[int, np.ndarray] = {}
        self.nodes = block["component"].to_pylist()
        self.above: dict[int, int] = {}

    def root(self, node):
        while (up := self.above.get(node, node)) != node:
            self.above[node] = self.above.get(up, up)
            node = up
        return node

    def of(self, i: int) -> np.ndarray:
        if i not in self.sets:
            (hashes, *_), = word_rows(self.texts.slice(i, 1), NOT_BLANK)
            self.sets[i] = set_of(hashes, self.size)
        return self.sets[i]

    def link(self, i: int, k: int, percent: int) -> bool:
        """Whether a new link joins two components that the block has not joined yet."""
        a, b = self.root(self.nodes[i]), self.root(self.nodes[k])
        if a == b:
            return False
        left, right = self.of(i), self.of(k)
        both = len(np.intersect1d(left, right, assume_unique=True))
        if 100 * both < percent * (len(left) + len(right) - both):
            return False
        self.above[a] = b
        return True


def _blocks(members: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int, bounds) -> DataFrame:
    """Links between members of a bucket that lie in different components.

    ``members`` has ``first``, the bucket's first component. Those outside of it
    are compared with all: cut into slices, each slice of them with each slice of
    the bucket. A pair is compared in the first band that it shares. Pairs are
    confirmed where they are found, and left out where a link found before has
    joined their components already, so that no more links come out than members
    go in.
    """
    outside = F.when(F.col("component") != F.col("first"), 1)
    sizes = members.groupBy("bucket").agg(
        F.ceil(F.count("*") / SLICE).alias("all_slices"),
        F.ceil(F.count(outside) / SLICE).alias("out_slices"),
    )
    rows = members.join(sizes, "bucket").withColumn("hash", F.xxhash64("rep"))
    left = rows.where("component <> first").select(
        "bucket", "band", "rep", "component", F.lit(True).alias("out"),
        F.pmod("hash", "out_slices").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("all_slices") - 1)).alias("j"),
    )
    right = rows.select(
        "bucket", "band", "rep", "component", F.lit(False).alias("out"),
        F.explode(F.sequence(F.lit(0), F.col("out_slices") - 1)).alias("i"),
        F.pmod("hash", "all_slices").alias("j"),
    )
    dealt = left.union(right).select(
        F.xxhash64("bucket", "i", "j").alias("block"), "band", "rep", "component", "out"
    )
    blocks = (
        dealt.join(classes.select("rep", "signature"), "rep").join(texts, "rep")
        .repartition("block")
        .sortWithinPartitions("block", "out", "rep")
        .select("block", "band", "rep", "component", "out", "signature", "text")
    )

    def compare(block: pa.Table):
        reps, comps = block["rep"].to_numpy(), block["component"].to_numpy()
        out = block["out"].to_numpy(zero_copy_only=False)
        signs, band = _matrix(block["signature"]), block["band"][0].as_py()
        mine, theirs = np.flatnonzero(out), np.flatnonzero(~out)
        sets = _Sets(block, size)
        for i in mine:
            other = theirs[comps[theirs] != comps[i]]
            if not len(other):
                continue
            keep = plausible(np.broadcast_to(signs[i], (len(other), signs.shape[1])), signs[other], bounds)
            other = other[keep]
            shared = (signs[other] == signs[i]).reshape(-1, signs.shape[1] // BAND, BAND).all(axis=2)
            for k in other[shared.argmax(axis=1) == band].tolist():
                if sets.link(int(i), k, percent):
                    yield int(reps[i]), int(reps[k])

    def found(table, ends):
        at = 0
        for end in ends:
            links = list(compare(table.slice(at, end - at)))
            at = end
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = table["block"].to_numpy()
            ends = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            yield from found(table, ends)
            rest = table.slice(ends[-1] if len(ends) else 0)
        if rest is not None and len(rest):
            yield from found(rest, [len(rest)])

    return map_arrow(blocks, run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, miss: float = MISS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for each row of ``docs``.

    Two documents are linked if their sets of ``size``-word shingles overlap by
    ``percent`` of their union or more. Words are what stands between blanks, with
    A-Z in lower case. A text of fewer words is one shingle; a null, empty or
    blank one has no set and no links. ``component_id`` is the smallest doc_id
    that links lead to. A row without doc_id has no links, no component and is
    kept. Further columns of ``docs`` are not read. Writes tables to the shared
    folder and runs jobs when called.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be over 0 and at most 100")
    bounds = needed_matches(percent / 100, miss)
    count = hashes_for(percent / 100, miss)
    rows = saved(sketches(docs.select("doc_id", "text"), size, count).drop("text"))
    groups = rows.where("doc_id IS NOT NULL AND set_digest IS NOT NULL")
    classes = saved(
        groups.groupBy("set_digest").agg(
            F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature")
        )
    )
    buckets = _buckets(classes, count // BAND)
    wanted = buckets.select(F.col("rep").alias("doc_id")).dropDuplicates()
    met = classes.join(wanted.withColumnRenamed("doc_id", "rep"), "rep", "left_semi")
    met = saved(met)
    texts = _texts(docs, wanted, met, size)

    tested = _star(buckets)
    links = saved(_linked(_plausible_pairs(tested, met, bounds), texts, size, percent))
    members = _labelled(buckets, links)
    # Two members were compared already.
    some = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 2")
    members = members.join(some.select("bucket"), "bucket", "left_semi")
    links = saved(links.union(_blocks(members, met, texts, size, percent, bounds)))

    # A document with several texts stands in several classes.
    found = components(links).select(F.col("node").alias("rep"), "component")
    named = classes.join(found, "rep", "left").select(
        "set_digest", F.coalesce("component", "rep").alias("component")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", "set_digest").join(named, "set_digest", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _texts(docs: DataFrame, wanted: DataFrame, met: DataFrame, size: int) -> DataFrame:
    """``(rep, text)``: one text of each class that shares a bucket with another."""
    some = sketch_digests(
        docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), size
    )
    named = met.select(F.col("rep").alias("doc_id"), "set_digest")
    texts = some.join(named, ["doc_id", "set_digest"]).groupBy("doc_id", "set_digest")
    return saved(texts.agg(F.any_value("text").alias("text")).select(F.col("doc_id").alias("rep"), "text"))


def sketch_digests(docs: DataFrame, size: int) -> DataFrame:
    def start():
        def compute(texts: pa.Array):
            sets = (set_of(h, size) for h, *_ in word_rows(texts, NOT_BLANK))
            return ([digest(s) if len(s) else None for s in sets],)

        return compute

    added = [T.StructField("set_digest", T.BinaryType())]
    return add_columns(docs, ["text"], added, start)


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its group, columns unchanged.

    Rows without doc_id stay. Rows that repeat a kept doc_id stay with it.
    """
    dropped = near_duplicates(docs, size, percent).where("NOT kept").select("doc_id")
    return docs.join(dropped.dropDuplicates(), "doc_id", "left_anti").select(docs.columns)
