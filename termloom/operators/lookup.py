"""Attach per-key values to many rows per key, whatever the keys' shares.

Word statistics are skewed by nature: a few terms are in almost every document.
A plain shuffled join, or a window, puts all rows of such a term into one task.
Here the keys that hold a notable share of the rows are found by their counts,
which the lookup table has anyway, and take another way:

* A key whose count is over 1/HOT_KEYS of the total is hot. Counts add up to
  the total, so there are fewer than HOT_KEYS hot keys, at any data size; a hot
  key beyond KEY_BYTES stands there as its digest, so the hot part of the
  table is bounded in bytes too. It is broadcast.
* All other keys are looked up by a shuffled join.
  Rows already served by the broadcast pass through it under keys that match
  nothing and differ from row to row, so they spread evenly over the tasks.

Each row is read once, and each key is looked up whole on one of the two ways.

Spark chooses how to run the second join: a sort-merge join, which can spill,
unless the table turns out to be under its broadcast threshold. With
``join_hint="shuffle_hash"`` the rows need no sort; each task then holds its
share of the table in memory, which is small as long as the partition count
fits the rows, since keys of the table are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.totals import brief

HOT_KEYS = 10_000
# Number of different keys that rows already served are spread over.
SPREAD = 1_000_000


def _hot_part(
    table: DataFrame, key: str, weight: str, values: list[str], hot_keys: int, hot: Column | None = None
) -> DataFrame:
    """The hot keys of ``table``, fewer than ``hot_keys`` or those of ``hot``, with values named ``hot_*``."""
    if hot is None:
        hot = F.col(weight) > table.agg((F.sum(weight) / F.lit(hot_keys)).alias("share")).scalar()
    return table.where(hot).select(
        brief(F.col(key)).alias("hot_key"), *(F.col(v).alias(f"hot_{v}") for v in values)
    )


def _with_hot(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    return rows.join(F.broadcast(hot), brief(F.col(key)) == F.col("hot_key"), "left").drop("hot_key")


def _hinted(table: DataFrame, join_hint: str | None) -> DataFrame:
    return table.hint(join_hint) if join_hint else table


def _lane(spread: str) -> Column:
    return F.pmod(F.xxhash64(spread), F.lit(SPREAD)).cast("string")


def attach_by_term(
    rows: DataFrame,
    table: DataFrame,
    weight: str,
    hot_keys: int = HOT_KEYS,
    join_hint: str | None = None,
    hot: Column | None = None,
) -> DataFrame:
    """Inner join of ``rows`` (``doc``, ``term``, ...) with ``table`` on ``term``.

    ``table`` has one row per term and no NULLs; ``weight`` is its column that
    bounds the number of ``rows`` of a term. ``hot`` is a condition on ``table`` for the
    keys to broadcast, in place of ``hot_keys``, for callers that know their size.
    """
    values = [c for c in table.columns if c != "term"]
    served = F.col(f"hot_{values[0]}").isNotNull()
    # No term holds a blank, so a key that starts with one matches nothing. A cold
    # row's term is its key and needs no second copy in the shuffle.
    lane = F.concat(F.lit(" "), _lane("doc"))
    keyed = (
        _with_hot(rows, _hot_part(table, "term", weight, values, hot_keys, hot), "term")
        .withColumn("probe", F.when(served, lane).otherwise(F.col("term")))
        .withColumn("term", F.when(served, F.col("term")))
    )
    cold = table.select(
        F.col("term").alias("probe"), *(F.col(v).alias(f"cold_{v}") for v in values)
    )
    joined = keyed.join(_hinted(cold, join_hint), "probe", "left").withColumn(
        "term", F.coalesce("term", "probe")
    )
    return _found(joined, rows.columns, values)


def attach_by_doc(
    rows: DataFrame,
    table: DataFrame,
    weight: str,
    hot_keys: int = HOT_KEYS,
    join_hint: str | None = None,
) -> DataFrame:
    """The same on ``doc``, for documents that may hold any share of the rows.

    A document may have any name or number, so keys are compared in a marked
    text form: ``=`` and the document, or ``#`` and a number for served rows.
    """
    values = [c for c in table.columns if c != "doc"]
    # concat_ws is never NULL, so the join puts no filter on it below the count.
    key = F.concat_ws("=", F.lit(""), F.col("doc").cast("string"))
    lane = F.concat_ws("#", F.lit(""), _lane("term"))
    served = F.col(f"hot_{values[0]}").isNotNull()
    keyed = _with_hot(
        rows, _hot_part(table, "doc", weight, values, hot_keys), "doc"
    ).withColumn("probe", F.when(served, lane).otherwise(key))
    cold = table.select(key.alias("probe"), *(F.col(v).alias(f"cold_{v}") for v in values))
    joined = keyed.join(_hinted(cold, join_hint), "probe", "left")
    return _found(joined, rows.columns, values)


def _found(joined: DataFrame, columns: list[str], values: list[str]) -> DataFrame:
    found = [F.coalesce(f"hot_{v}", f"cold_{v}").alias(v) for v in values]
    return joined.select(*columns, *found).where(F.col(values[0]).isNotNull())
