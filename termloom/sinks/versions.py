"""Outputs that are replaced without a gap.

A folder holds versions of a table and a small file, ``_current``, that names one. A new
version is written beside the others and checked; only then is the name replaced, by one
rename. Whoever reads meanwhile gets the old version or the new one, and a run that
fails, at whatever moment, leaves the old one as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_POINTER = "_current"


def _files(spark: SparkSession, path: str):
    """Hadoop's file access for ``path``, and its path class."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that ``path`` shows, or None before there is one."""
    files, place = _files(spark, path)
    pointer = place(f"{path}/{_POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        name = stream.readUTF()
    finally:
        stream.close()
    return f"{path}/{name}"


def publish(table: DataFrame, path: str) -> str:
    """Write ``table`` as the new version of ``path``, show it, and return its folder.

    The rows that arrive in the files must be as many as went into them.
    """
    spark = table.sparkSession
    name = f"v-{uuid.uuid4().hex}"
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{name}")
    arrived = spark.read.schema(table.schema).parquet(f"{path}/{name}").count()
    if arrived != seen.get["rows"]:
        raise RuntimeError(f"{seen.get['rows']} rows were written to {path}/{name}, but {arrived} are there")
    _show(spark, path, name)
    return f"{path}/{name}"


def _show(spark: SparkSession, path: str, name: str) -> None:
    files, place = _files(spark, path)
    draft = place(f"{path}/_draft-{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.writeUTF(name)
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("OVERWRITE")
    context.rename(files.makeQualified(draft), files.makeQualified(place(f"{path}/{_POINTER}")), options)


def load_current(spark: SparkSession, path: str) -> DataFrame:
    """The version that ``path`` shows now."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing has been published to {path}")
    return spark.read.parquet(version)


def drop_others(spark: SparkSession, path: str) -> int:
    """Delete all versions but the current one; how many. For when nobody reads them any more."""
    version = current_version(spark, path)
    files, place = _files(spark, path)
    dropped = 0
    for entry in files.listStatus(place(path)):
        name = entry.getPath().getName()
        if entry.isDirectory() and name.startswith("v-") and version is not None and not version.endswith(f"/{name}"):
            files.delete(entry.getPath(), True)
            dropped += 1
    return dropped
