"""Intermediate tables on disk: written once, read again by a later job.

Parquet keeps types and is the form to use. Tab-separated text is for exchange
with other tools; terms never hold a tab or a line break, so it needs no
quoting, and quoting is off because terms may hold quotes.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from termloom.operators.totals import Heavy, sliced

_TEXT = {
    "sep": "\t",
    "quote": "",
    "escape": "",
    "header": False,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}


def save_stage(table: DataFrame, path: str, text: bool = False) -> None:
    """Write a stage, replacing what is there."""
    writer = table.write.mode("overwrite")
    if text:
        writer.options(**_TEXT).csv(path)
    else:
        writer.parquet(path)


def load_stage(spark: SparkSession, path: str, text_schema: str | StructType | None = None) -> DataFrame:
    """Read a stage back; tab-separated text needs its schema."""
    if text_schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(text_schema).options(**_TEXT, mode="FAILFAST").csv(path)


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="termloom-stages-")


def stage_path(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``, which driver and executors share.

    A local session without that setting gets a temporary folder; anywhere else its
    absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"


def save_and_load(table: DataFrame) -> DataFrame:
    """``table`` written once as a stage of its own, and read from there."""
    path = stage_path(table.sparkSession)
    save_stage(table, path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def save_counts(counts: DataFrame, table: str, buckets: int, heavy: Heavy | None = None, path: str | None = None) -> None:
    """Save ``(doc, term, ...)`` as a table bucketed and sorted by term, replacing what is there.

    ``score_counts`` needs no shuffle of it, however often it is run. ``heavy`` terms
    are cut into slices, which the table keeps as columns, so no bucket holds the whole
    of one. ``path`` puts the files there in place of the warehouse.
    """
    dealt = sliced(counts, "term", "doc", heavy)
    by = ["term", "slice"] if heavy else ["term"]
    writer = dealt.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def save_frequency(frequency: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Save ``(term, num_docs_with_word)`` by buckets, as ``save_counts`` does: a join of both moves neither."""
    writer = frequency.repartition(buckets, "term").write.mode("overwrite").bucketBy(buckets, "term").sortBy("term")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
