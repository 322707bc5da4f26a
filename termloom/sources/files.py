"""Directories of text files, one document per file.

Spark's file sources leave out zero-byte files, but a document without words still
counts in the number of documents. Directories are therefore listed as a table, by
tasks on the executors: names and sizes, zero-byte files among them. No name comes to
the driver's Python; whether two files have one name is a question to that table.
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator
from itertools import islice
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import doc_name


def _decoded(path: Column) -> Column:
    # A plus sign in a file name is not escaped, and is not a blank.
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _name(path: str, doc_key: str) -> str:
    if doc_key == "name":
        return unquote(path.rsplit("/", 1)[-1])
    head, _, tail = unquote(path).partition(":")
    return f"file:/{tail.lstrip('/')}" if head == "file" else unquote(path)


def _doc_column(doc_key: str) -> Column:
    if doc_key == "name":
        return _decoded(F.col("_metadata.file_name"))
    return F.regexp_replace(_decoded(F.col("_metadata.file_path")), "^file:/+", "file:/")


def _options(glob: str | None) -> dict[str, str]:
    return {"pathGlobFilter": glob} if glob else {}


# Files that a listing task gives back at once.
_LISTED_ROWS = 10_000
_LISTED = "path string, name string, size bigint"


def _lister(glob: str | None):
    """What lists directories in a task. It carries all it needs: executors need not have this package."""
    most = _LISTED_ROWS

    def entries(place: str) -> Iterator[tuple[str, str, int]]:
        """Path, name and size of a directory's files, or of a file. Mounted folders are read as a stream."""
        parts = urlsplit(place)
        if parts.scheme in ("", "file"):
            folder = os.path.abspath(unquote(parts.path) if parts.scheme else place)
            if os.path.isfile(folder):
                yield f"file:{folder}", os.path.basename(folder), os.path.getsize(folder)
                return
            with os.scandir(folder) as found:
                for entry in found:
                    if entry.is_file():
                        yield f"file:{entry.path}", entry.name, entry.stat().st_size
            return
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(place)
        info = system.get_file_info(folder)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(folder))
        for entry in found:
            if entry.is_file:
                yield f"{parts.scheme}://{parts.netloc}/{entry.path.split('/', 1)[-1]}", entry.base_name, entry.size

    def is_document(name: str) -> bool:
        """Spark's file sources leave out hidden names, and so does this."""
        hidden = name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")
        return not hidden and (glob is None or fnmatch.fnmatchcase(name, glob))

    def listed(batches):
        for batch in batches:
            for place in batch["place"].to_pylist():
                found = (e for e in entries(place) if is_document(e[1]))
                while rows := list(islice(found, most)):
                    columns = [pa.array(c) for c in zip(*rows)]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "name", "size"])

    return listed


def _is_plain(places: list[str], glob: str | None) -> bool:
    """Whether tasks can list this themselves: stores that Arrow knows, and no patterns but simple ones for names."""
    schemes = {urlsplit(p).scheme for p in places}
    simple = glob is None or not set(glob) & set("{}[]\\")
    return schemes <= {"", "file", "hdfs", "s3", "gs"} and simple and not any(set(p) & set("*?[]{}") for p in places)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``(path, name, size)`` of every file of some directories, zero-byte ones included.

    Directories are dealt to tasks, which list them; hidden files and sub-directories
    are left out, ``glob`` keeps matching names only. No file is opened.
    """
    places = [path] if isinstance(path, str) else list(path)

    table = spark.createDataFrame([(p,) for p in places], "place string")
    return table.repartition(len(places), "place").mapInArrow(_lister(glob), _LISTED)


def list_documents(
    spark: SparkSession, path: str | list[str], doc_key: str = "name", glob: str | None = None
) -> DataFrame:
    """``doc`` of every file, zero-byte ones included; no file is opened.

    ``doc_key="name"`` calls a document by its file name and refuses two files
    of one name, by a job over the names; ``doc_key="path"`` calls it by its whole
    path. Hidden files and sub-directories are not documents. ``glob`` keeps
    matching names only.

    Patterns in paths, and stores that only Spark can read, are listed by Spark's
    driver.
    """
    return _listed_documents(spark, path, doc_key, glob).select("doc")


def _listed_documents(spark, path, doc_key: str, glob: str | None) -> DataFrame:
    """``(doc, size)``; the size is null where Spark's driver made the list."""
    if doc_key not in ("name", "path"):
        raise ValueError(f"doc_key must be 'name' or 'path', not {doc_key!r}")
    places = [path] if isinstance(path, str) else list(path)
    if _is_plain(places, glob):
        files = list_files(spark, places, glob)
        clean = F.regexp_replace("path", "^file:/+", "file:/")
        listed = files.select((F.col("name") if doc_key == "name" else clean).alias("doc"), "size")
    else:
        names = [_name(p, doc_key) for p in spark.read.text(path, wholetext=True, **_options(glob)).inputFiles()]
        listed = spark.createDataFrame([(n, None) for n in names], "doc string, size bigint")
    _refuse_twice(listed)
    return listed


def _refuse_twice(listed: DataFrame) -> None:
    twice = listed.groupBy("doc").count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"two files are called {twice.doc!r}; use doc_key='path'")


def _with_empty_documents(
    read: DataFrame,
    path: str | list[str],
    doc_key: str,
    glob: str | None,
    manifest: DataFrame | None,
    listed: DataFrame | None = None,
) -> DataFrame:
    spark = read.sparkSession
    if manifest is None:
        listed = _listed_documents(spark, path, doc_key, glob) if listed is None else listed
        if _is_plain([path] if isinstance(path, str) else list(path), glob):
            empty = listed.where("size = 0").select("doc", F.lit("").alias("text"))
            return read.unionByName(empty)
        every = listed.select("doc")
    else:
        every = manifest.select("doc").distinct()
    # Without its content column this source looks at file names only.
    filled = (
        spark.read.format("binaryFile")
        .options(**_options(glob))
        .load(path)
        .select(_doc_column(doc_key).alias("doc"))
    )
    if manifest is not None:
        if doc_key == "name":
            _refuse_twice(filled)
        read = read.join(every, "doc", "left_semi")
    empty = every.join(filled, "doc", "left_anti").select("doc", F.lit("").alias("text"))
    return read.unionByName(empty)


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    doc_key: str = "name",
    glob: str | None = None,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Document grain: one row per file, ``(doc, text)``.

    ``manifest`` is a table with a ``doc`` column that names all documents; it
    replaces the listing. Files that it
    does not name are left out; two files of one name are refused, by a job over
    the names.
    """
    read = spark.read.text(path, wholetext=True, **_options(glob)).select(
        _doc_column(doc_key).alias("doc"), F.col("value").alias("text")
    )
    return _with_empty_documents(read, path, doc_key, glob, manifest)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    doc_key: str = "name",
    glob: str | None = None,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Line grain: one row per line, ``(doc, text)``; files may be split."""
    read = spark.read.text(path, **_options(glob)).select(
        _doc_column(doc_key).alias("doc"), F.col("value").alias("text")
    )
    return _with_empty_documents(read, path, doc_key, glob, manifest)


def names_from_paths(table: DataFrame, path: str) -> DataFrame:
    """Add ``doc_name``, the last component of a path or URL column."""
    return table.withColumn("doc_name", doc_name(path))
