"""Score a directory of text files and write the sorted report.

    spark-submit termloom/__main__.py INPUT OUTPUT
    python -m termloom INPUT OUTPUT --grain line
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from termloom.plans.scoring import STRATEGIES, score
from termloom.session import build_session
from termloom.sinks.report import ORDERS, key_bounds, report, write_report
from termloom.sources.files import list_documents, read_documents, read_lines


def score_files(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    grain: str = "document",
    strategy: str = "window",
    doc_key: str = "name",
    glob: str | None = None,
    order: str = "total",
    places: int = 10,
    manifest: str | None = None,
    chunk_bytes: int | None = None,
) -> None:
    """Read a directory of text files, score it, write the report.

    ``manifest`` is a Parquet table, or else a text file of a name a line, that names all documents.
    """
    read = read_documents if grain == "document" else read_lines
    names = None
    if manifest is not None:
        parquet = manifest.rstrip("/").endswith(".parquet")
        names = spark.read.parquet(manifest) if parquet else spark.read.text(manifest).toDF("doc")
    corpus = read(spark, source, doc_key, glob, names)
    documents = list_documents(spark, source, doc_key, glob) if names is None else names.select("doc").distinct()
    scores = score(corpus, grain, strategy, documents, chunk_bytes=chunk_bytes)
    bounds = key_bounds(corpus) if order == "total" else None
    write_report(report(scores, places, order, bounds), target)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="termloom", description="tfidf of a directory of text files")
    parser.add_argument("input", nargs="+", help="directories or files")
    parser.add_argument("output", help="directory of the report, replaced if it exists")
    parser.add_argument("--grain", choices=("document", "line"), default="document")
    parser.add_argument("--strategy", choices=STRATEGIES, default="window")
    parser.add_argument("--doc-key", choices=("name", "path"), default="name")
    parser.add_argument("--glob", help="keep only matching file names, e.g. 'doc*'")
    parser.add_argument("--order", choices=ORDERS, default="total")
    parser.add_argument("--places", type=int, default=10)
    parser.add_argument("--manifest", help="a table or file that names all documents, in place of a listing")
    parser.add_argument("--chunk-bytes", type=int, help="count texts beyond so many bytes in chunks")
    options = parser.parse_args(arguments)

    score_files(
        build_session(),
        options.input,
        options.output,
        options.grain,
        options.strategy,
        options.doc_key,
        options.glob,
        options.order,
        options.places,
        options.manifest,
        options.chunk_bytes,
    )


if __name__ == "__main__":
    main()
