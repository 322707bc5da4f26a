"""A content-addressed WARC archive.

Two Parquet tables in one folder:

    payloads   sha256, payload, records: the bytes of each distinct payload, once,
               and how many records have it
    headers    the exact header bytes of each record, its id and type, and its
               payload's sha256

A payload's address is its SHA-256. Before it is stored, all rows of an address
must agree in length and in SHA-1 too; when it is read, its bytes must have their
address. A record's own bytes come back by a join of the two tables. Payloads meet
the headers of responses only, mostly one for each address; what revisits need of
a payload is looked up by ``attach_by_term``, which takes addresses that hold a
notable share of the records another way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import saved
from termloom.operators.lookup import attach_by_term

# Fixed values of the format: WARC 1.1, base32 of RFC 4648.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"
# Equal rows that are numbered in one stretch.
COPIES = 10_000


def base32_of_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits are four of base 32."""
    digits = F.sha1(payload)
    letters = []
    for group in range(8):
        value = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _record_id(page: Column, url_key: Column, address: Column, copy: Column) -> Column:
    h = F.md5(F.concat_ws(" ", F.coalesce(page.cast("string"), F.lit("")), url_key, address, copy))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``, which tells equal rows apart: 0, 1, 2 and so on.

    Equal rows are counted and then made again from their count, in stretches that
    any task may take.
    """
    counted = rows.groupBy(rows.columns).agg(F.count("*").alias("n"))
    last = F.floor((F.col("n") - 1) / COPIES)
    dealt = counted.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    first = F.col("stretch") * COPIES
    copies = F.sequence(first, F.least(first + COPIES, F.col("n")) - 1)
    return dealt.repartition("sha256", "page_id", "stretch").select(*rows.columns, F.explode(copies).alias("copy"))


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", least: int = 0) -> None:
    """Write a record for each row of ``pages(page_id, url, html)`` to ``path``.

    The payload is ``html`` in UTF-8, null counting as empty. Of the records whose
    payloads are equal and have ``least`` bytes or more, that with the smallest
    page_id is a response and the others revisit it. Rows that repeat this
    smallest page_id are responses too. Rows without page_id come last; if a
    payload has no others, all of them are responses. ``date`` is the WARC-Date.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha256", F.sha2("payload", 256))
    second = F.concat_ws(" ", F.octet_length("payload"), F.sha1("payload"))
    stored = rows.withColumn("second", second).groupBy("sha256").agg(
        F.first("payload").alias("payload"),
        F.count("*").alias("records"),
        F.min("second").alias("least"),
        F.max("second").alias("most"),
    )
    verified = F.when(F.col("least") == F.col("most"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads have the address "), F.col("sha256")))
    )
    stored.select("sha256", verified.alias("payload"), "records").write.parquet(f"{path}/payloads")

    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    facts = saved(
        rows.select(
            "page_id", url.alias("url"), F.md5(url).alias("url_key"), "sha256",
            F.octet_length("payload").cast("bigint").alias("bytes"),
            base32_of_sha1(F.col("payload")).alias("sha1"),
        )
    )
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url_key")))
    firsts = facts.groupBy(F.col("sha256").alias("term")).agg(F.count("*").alias("n"), first.alias("first"))
    records = _numbered(facts).withColumnRenamed("sha256", "term").withColumn(
        "doc", F.xxhash64("page_id", "url_key", "copy")
    )
    joined = attach_by_term(records, firsts, "n")
    address, page = F.col("term"), F.col("page_id")
    own = _record_id(page, F.col("url_key"), address, F.col("copy"))
    response = (F.col("bytes") < least) | page.eqNullSafe(F.col("first.page_id"))
    kind = F.when(response, "response").otherwise("revisit")
    referred = _record_id(F.col("first.page_id"), F.col("first.url_key"), address, F.lit(0))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), own),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(~response, F.concat(F.lit("WARC-Refers-To: "), referred)),
        F.when(~response, F.concat(F.lit("X-Refers-To-Page: "), F.col("first.page_id").cast("string"))),
        F.when(~response, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("X-Page: "), page.cast("string")),
        F.concat(F.lit("Content-Length: "), F.when(response, F.col("bytes")).otherwise(0).cast("string")),
    ]
    header = F.concat(F.concat_ws(END, *lines), F.lit(END + END))
    joined.select(
        address.alias("sha256"), own.alias("record_id"), kind.alias("record_type"), F.encode(header, "UTF-8").alias("header")
    ).write.parquet(f"{path}/headers")


def _field(name: str) -> Column:
    text = F.decode("header", "UTF-8")
    found = F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``(sha256, record_id, record_type, header, record)``: each record as it stands in a WARC file.

    A payload that has not its address is an error.
    """
    address = F.col("sha256")
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "sha256",
        F.when(F.sha2("payload", 256) == address, F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload "), address))
        ).alias("body"),
    )
    headers = spark.read.parquet(f"{path}/headers")
    response = F.col("record_type") == "response"
    bodies = headers.where(response).join(payloads, "sha256")
    empty = headers.where(~response).withColumn("body", F.encode(F.lit(""), "UTF-8"))
    end = F.encode(F.lit(END + END), "UTF-8")
    return bodies.unionByName(empty).select(
        "sha256", "record_id", "record_type", "header", F.concat("header", "body", end).alias("record")
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of the records.

    Every record is rebuilt; type, page and reference are read from its header,
    length and digest from its body, or from that of the response it refers to. A
    body that has not the header's length, or a payload that has not its digest, is
    an error. Runs a job.
    """
    size = F.octet_length("record") - F.octet_length("header") - 2 * len(END)
    body = F.expr(f"substring(record, octet_length(header) + 1, octet_length(record) - octet_length(header) - {2 * len(END)})")
    read = saved(
        read_bytes(spark, path).select(
            "sha256", "record_id",
            _field("X-Page").cast("bigint").alias("page_id"),
            _field("WARC-Type").alias("record_type"),
            _field("X-Refers-To-Page").cast("bigint").alias("refers_to"),
            _field("WARC-Payload-Digest").alias("digest"),
            F.when(_field("Content-Length").cast("bigint") == size, size.cast("bigint")).otherwise(
                F.raise_error(F.concat(F.lit("damaged record "), F.col("record_id")))
            ).alias("body_bytes"),
            F.when(_field("WARC-Type") == "response", base32_of_sha1(body)).alias("body_digest"),
        )
    )
    response = F.col("record_type") == "response"
    own = read.where(response).withColumns({"payload_bytes": F.col("body_bytes"), "payload_digest": F.col("body_digest")})
    found = own.groupBy(F.col("sha256").alias("term")).agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")
    )
    weights = spark.read.parquet(f"{path}/payloads").select(F.col("sha256").alias("term"), "records")
    others = read.where(~response).withColumnsRenamed({"sha256": "term", "record_id": "doc"})
    # A revisit without a response finds no digest, which is an error below.
    table = weights.join(found, "term", "left").select(
        "term", "records", "payload_bytes", "payload_digest"
    )
    revisits = attach_by_term(others, table, "records").drop("records", "doc").withColumnRenamed("term", "sha256")
    columns = ["sha256", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest"]
    sound = F.col("digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    digest = F.when(sound, F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256")))
    )
    return own.select(columns).union(revisits.select(columns)).select(
        "page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to"
    )
