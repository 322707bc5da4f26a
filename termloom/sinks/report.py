"""The sorted report, ``document@word<TAB>value`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.keys import KEY_DELIMITER, fixed_point, pack_key
from termloom.functions.text import terms_of
from termloom.operators.totals import SAMPLED_CHARACTERS

# Bounds that are compared with a key at once.
_STEP = 64
# About so many rows are sampled for bounds, and of each every so manieth key.
_SAMPLED_ROWS = 4_096
_KEY_STEP = 32
ORDERS = ("total", "file", "none")


def key_bounds(corpus: DataFrame, ranges: int | None = None) -> list[str]:
    """Keys that cut a corpus's report into about ``ranges`` parts of like size, as many as shuffle partitions.

    Out of a bounded sample of all rows, wherever they lie: rows that lie together have
    keys that lie together, so the first ones of a few partitions would leave all others
    to a few ranges. Runs a job that counts and one that samples; wrong bounds cost
    balance, never order.
    """
    ranges = ranges or int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = corpus.where("doc IS NOT NULL")
    count = rows.count()
    sample = rows.sample(min(1.0, _SAMPLED_ROWS / count), seed=0) if count else rows
    terms = F.array_distinct(terms_of(F.substring("text", 1, SAMPLED_CHARACTERS)))
    some = F.filter(terms, lambda _, at: at % _KEY_STEP == 0)
    keys = sample.select("doc", F.explode(some).alias("term")).select(pack_key(F.col("doc"), F.col("term")).alias("key"))
    # In the order of their bytes, as Spark compares strings.
    found = sorted((r.key for r in keys.collect()), key=str.encode)
    places = sorted({k * len(found) // ranges for k in range(1, ranges)}) if found else []
    return list(dict.fromkeys(found[k] for k in places))


def _range_of(key: Column, bounds: list[str]) -> Column:
    """How many of the bounds are not after ``key``: among every _STEP-th one first, and then between two of these."""
    groups = [bounds[k : k + _STEP] for k in range(0, len(bounds), _STEP)]

    def count(array: Column) -> Column:
        return F.size(F.filter(array, lambda bound: bound <= key))

    firsts = F.array(*(F.lit(g[0]) for g in groups))
    group = F.greatest(count(firsts) - 1, F.lit(0))
    inside = F.get(F.array(*(F.array(*map(F.lit, g)) for g in groups)), group)
    return group * F.lit(_STEP) + count(inside)


def report(
    scores: DataFrame, places: int = 10, order: str = "total", bounds: list[str] | None = None
) -> DataFrame:
    """``(key, value_text)`` in byte order of the packed key.

    ``order="total"`` sorts over all output files by a range shuffle, for which Spark
    runs the last stage of ``scores`` twice; with ``bounds`` (``key_bounds``) it is dealt
    out by them and runs once. ``"file"`` sorts within each file only, without a
    shuffle. The packed key decides, so ``doc10@a`` comes before ``doc1@a``.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}, not {order!r}")
    lines = scores.select(
        pack_key(F.col("doc"), F.col("term")).alias("key"),
        fixed_point(F.col("tfidf"), places).alias("value_text"),
    )
    if order == "total" and bounds:
        dealt = lines.repartitionById(len(bounds) + 1, _range_of(F.col("key"), bounds))
        return dealt.sortWithinPartitions("key")
    if order == "total":
        return lines.orderBy("key")
    return lines.sortWithinPartitions("key") if order == "file" else lines


def write_report(lines: DataFrame, path: str) -> None:
    """Write report lines as text files, replacing what is there.

    With a total order, reading the files by name gives all lines in order.
    """
    lines.select(F.concat_ws("\t", "key", "value_text").alias("value")).write.mode(
        "overwrite"
    ).text(path)
