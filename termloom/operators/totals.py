"""Each row with a total over its group: a window total without a heavy group in one task.

Word statistics are skewed: a few groups hold a notable share of all rows. Those are
found first, by counts or in a bounded sample of the texts, and cut into slices by a hash of
another column; every other group is one slice. The rows are shuffled once, by group and slice,
and summed where they then are. For a group of one slice that is its total. The sums of
the slices of heavy groups, a small table, are added up and broadcast.

Totals are exact whatever groups are cut; that decides only how rows are spread.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import islice
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import TERM_PATTERN

# A sample takes so many partitions, spread evenly, so many texts of each, and of these so much.
SAMPLED_PARTITIONS = 32
SAMPLED_DOCS = 64
SAMPLED_CHARACTERS = 1 << 16
# A group is heavy if it holds more than 1/SHARES of what a shuffle partition should hold.
SHARES = 2
# Keys beyond so many bytes are compared by their digest, which bounds the broadcast.
KEY_BYTES = 1_024

# Group (as ``brief`` writes it) and its number of slices.
Heavy = dict[str, int]


def brief(key: Column) -> Column:
    """A key as marked text, a long one as its digest after a blank, which no term begins with.

    It is never NULL, so a join on it puts no filter below it.
    """
    text = key.cast("string")
    long = F.concat(F.lit(" "), F.sha2(text, 256))
    short = F.coalesce(F.octet_length(text), F.lit(0)) <= F.lit(KEY_BYTES)
    return F.concat_ws("=", F.lit(""), F.when(short, text).otherwise(long))


def _shares(counts: dict[str, int], total: int, partitions: int) -> Heavy:
    return {k: min(partitions, ceil(2 * SHARES * n * partitions / total)) for k, n in counts.items()}


def shuffle_partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_groups(
    rows: DataFrame, group: str, partitions: int | None = None, weight: Column | None = None
) -> Heavy:
    """Groups of ``rows`` that would unbalance a shuffle, with the slices to cut each into.

    A group is heavy if its share is more than 1/SHARES of a shuffle partition's, so
    there are fewer than SHARES times as many as partitions. Runs a job that counts
    rows, or adds up ``weight``, on the map side; for tables that are cheap to read.
    """
    partitions = partitions or shuffle_partitions(rows)
    one = F.lit(1) if weight is None else weight
    sums = rows.groupBy(brief(F.col(group)).alias("key")).agg(F.sum(one).alias("n"))
    total = rows.agg(F.sum(one)).first()[0] or 0
    found = sums.where(F.col("n") > F.lit(total / (SHARES * partitions))).collect()
    return _shares({r.key: int(r.n) for r in found}, total, partitions)


def heavy_terms(corpus: DataFrame, partitions: int | None = None) -> Heavy:
    """The same for the terms of a corpus, out of a bounded sample of its texts.

    Takes the first SAMPLED_DOCS rows of SAMPLED_PARTITIONS partitions, spread evenly,
    and the beginnings of their texts. A term that the sample does not show stays
    whole: that may cost balance, never a result.
    """
    partitions = partitions or shuffle_partitions(corpus)
    texts = corpus.select(F.substring("text", 1, SAMPLED_CHARACTERS)).rdd
    parts = texts.getNumPartitions()
    chosen = sorted({k * parts // SAMPLED_PARTITIONS for k in range(SAMPLED_PARTITIONS)}) if parts else []
    most, pattern = SAMPLED_DOCS, TERM_PATTERN

    def count(rows) -> list[Counter]:
        """How many of the sampled rows hold each term."""
        cut = re.compile(pattern).findall
        return [Counter(t for (text,) in islice(rows, most) for t in set(cut(text or "")))]

    found = texts.context.runJob(texts, count, chosen)
    counts = sum(found, Counter())
    total = counts.total()
    # Once or twice shows nothing.
    least = max(2, total / (SHARES * partitions))
    return _shares({_brief(t): n for t, n in counts.items() if n > least}, total, partitions)


def _brief(term: str) -> str:
    """As ``brief`` writes a term."""
    data = term.encode()
    return "=" + (term if len(data) <= KEY_BYTES else " " + hashlib.sha256(data).hexdigest())


def sliced(rows: DataFrame, group: str, spread: str, heavy: Heavy | None) -> DataFrame:
    """``rows`` with ``slice`` and ``slices``, of the group, shuffled by group and slice.

    Later steps on (group, slice) need no other shuffle. Without heavy groups nothing
    is done here: each group is one slice, and the next step on it shuffles.
    """
    if not heavy:
        return rows
    table = rows.sparkSession.createDataFrame(list(heavy.items()), "heavy_key string, cut int")
    joined = rows.join(F.broadcast(table), brief(F.col(group)) == F.col("heavy_key"), "left")
    slices = F.coalesce("cut", F.lit(1))
    slice_of = F.coalesce(F.pmod(F.xxhash64(spread), slices).cast("int"), F.lit(0))
    dealt = joined.select(*rows.columns, slice_of.alias("slice"), slices.alias("slices"))
    return dealt.repartition(group, "slice")


def keys_of(dealt: DataFrame, group: str) -> list[str]:
    """The columns that ``sliced`` rows lie by."""
    return [group, "slice", "slices"] if "slice" in dealt.columns else [group]


def slice_sums(dealt: DataFrame, group: str, total: Column) -> DataFrame:
    """``(group, slice, slices, slice_total)`` of the slices of heavy groups, out of ``sliced`` rows.

    Rows are counted too, by all of their columns, only to have them in use: else Spark
    would leave some out below the shuffle, and run a second one for this branch.
    """
    names = ", ".join(f"`{c}`" for c in dealt.columns)
    sums = dealt.groupBy(*keys_of(dealt, group)).agg(total.alias("slice_total"), F.expr(f"count({names})").alias("used"))
    # A condition on a sum stays above it.
    return sums.where(F.when(F.col("used") >= 0, F.col("slices")) > 1).drop("used")


def total_of_slices(dealt: DataFrame, group: str, value: Column, name: str) -> DataFrame:
    """``sliced`` rows with ``name``, the total of ``value`` over their groups; they are not shuffled again."""
    keys = keys_of(dealt, group)
    summed = dealt.withColumn(name, F.sum(value).over(Window.partitionBy(*keys)))
    if len(keys) == 1:
        return summed
    whole = (
        slice_sums(dealt, group, F.sum(value))
        .groupBy(F.col(group).alias("_group"))
        .agg(F.sum("slice_total").alias("_total"))
    )
    # Fewer groups than SHARES times the shuffle partitions.
    same = F.col(group).eqNullSafe(F.col("_group"))  # puts no filter below the shuffle, which both branches share
    joined = summed.join(F.broadcast(whole), same, "left")
    return joined.withColumn(name, F.coalesce("_total", name)).drop("_group", "_total")


def with_group_total(
    rows: DataFrame, group: str, spread: str, value: Column, name: str, heavy: Heavy | None = None
) -> DataFrame:
    """Add ``name``: ``value`` summed over all rows with the same ``group``.

    ``heavy`` are the groups to be cut into slices by a hash of ``spread``, as
    ``heavy_groups`` gives them. Rows are shuffled once.
    """
    dealt = sliced(rows, group, spread, heavy)
    return total_of_slices(dealt, group, value, name).select(*rows.columns, name)
