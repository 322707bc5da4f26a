"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import (
    bpe,
    decontaminate,
    fingerprints,
    licenses,
    near_dedup,
    pii,
    prefix_trie,
    quality,
    repair,
    sharding,
    token_files,
    toxicity,
    warc,
)
from termloom.llm.common import read, shared_folder

END_ID = 2
SHARDS = 16


def _held_out(folds: int, fold: int) -> Column:
    """A row without doc_id is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = toxicity.training_labels(read(spark, sf_dir, "labels"), 3, 1)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", _held_out(3, 1).alias("held_out"), "score", "predicted")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_documents(spark, sf_dir), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_ids(_documents(spark, sf_dir), path, tokenizer, END_ID)
    return token_files.read_ids(spark, path, digest=True)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir)).drop("text")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(_documents(spark, sf_dir)).drop("text")


def _encoded(docs: DataFrame) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_digests(docs, ranks, public_tokenizers.PATTERN)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = pii.find(docs, pii.train(docs))
    base = F.col("base_spans")
    return found.select(
        "doc_id",
        *(pii.count_of(base, k).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(_documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = toxicity.training_labels(read(spark, sf_dir, "labels"), 5, 0)
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir), size=3, percent=85)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))
    return nodes.drop("ref_conv", "ref_at")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_documents(spark, sf_dir), sharding.balanced(SHARDS))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(repair.damaged(read(spark, sf_dir, "conversations")))


def queries() -> dict:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_decontamination": op2_decontamination,
        "op3_token_files": op3_token_files,
        "op4_licenses": op4_licenses,
        "op5_bpe": op5_bpe,
        "op6_pii": op6_pii,
        "op7_warc": op7_warc,
        "op8_fingerprints": op8_fingerprints,
        "op9_quality": op9_quality,
        "op10_near_dedup": op10_near_dedup,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_sharding": op12_sharding,
        "op13_repair": op13_repair,
    }


# A-Z only, as the contracts say.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_WINDOWS = rf"""WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, {_WORD}) AS words FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS n, list_slice(words, p, p + least(len(words), 13) - 1) AS win
  FROM i, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS t(p) WHERE len(words) > 0),
s AS (SELECT DISTINCT n FROM w),
p AS (
  SELECT doc_id, n, p, list_slice(words, p, p + n - 1) AS win
  FROM d, s, unnest(range(1, len(words) - n + 2)) AS t(p) WHERE len(words) >= n),
h AS (SELECT doc_id, p, n, item_id FROM p JOIN w USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM h, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
m AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id),
r AS (
  SELECT doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(ids, '') AS ids
  FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id))
SELECT doc_id, n_words, n_hit, n_items, sha256(ids) AS items_sha256, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated
FROM r"""

_DIGEST = " || ".join(
    f"substr('{warc.BASE32}', 1 + ((CAST('0x' || substr(h, {5 * g + 1}, 5) AS BIGINT) >> {s}) & 31)::INTEGER, 1)"
    for g in range(8)
    for s in (15, 10, 5, 0)
)
_ARCHIVE = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, {_DIGEST} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""

# Sets by distinct words in order; the pairs are those that share a shingle.
_COMPONENTS = rf"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(words, p, p + least(len(words), 3) - 1) AS shingle
  FROM d, unnest(range(1, len(words) - least(len(words), 3) + 2)) AS t(p) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)"""


# CRC-32 of an id's decimal digits: each byte, and within it each bit, is a step.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

# Nodes are whole sequences of turns; a node's subtree are those that begin with it.
_TRIE = f"""WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, c - c % 5 AS b, {_CRC} % 9 AS h FROM ids),
t AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
r AS (
  SELECT c, i AS d, said FROM k JOIN t ON t.conv_id = b AND i <= h
  UNION ALL
  SELECT c, i - h + least(h, coalesce(n, 0)) AS d, said FROM k JOIN t ON t.conv_id = c AND i > h LEFT JOIN n ON n.conv_id = b),
l AS (SELECT c, coalesce(max(d), 0) AS len FROM k LEFT JOIN r USING (c) GROUP BY c),
m AS (
  SELECT c, d, list(said) OVER (PARTITION BY c ORDER BY d) AS seq FROM r
  UNION ALL SELECT c, 0 AS d, [] AS seq FROM k),
x AS (
  SELECT d, seq, min(c) AS conv_id, count(*) AS n_convs,
    CASE WHEN d > 0 THEN strlen(any_value(seq)[-1].text) ELSE 0 END AS bytes,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '') AS ends
  FROM m JOIN l USING (c) GROUP BY d, seq),
p AS (
  SELECT a.*, b.conv_id AS parent_conv_id, count(e.d) AS n_children
  FROM x a LEFT JOIN x b ON b.d = a.d - 1 AND b.seq = a.seq[1:a.d - 1] LEFT JOIN x e ON e.d = a.d + 1 AND e.seq[1:a.d] = a.seq
  GROUP BY ALL),
s AS (
  SELECT a.d, a.seq, count(*) FILTER (e.n_children = 0) AS n_leaves, sum((e.n_convs - 1) * e.bytes) AS saved
  FROM p a JOIN p e ON e.d >= a.d AND e.seq[1:a.d] = a.seq GROUP BY a.d, a.seq)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM p JOIN s USING (d, seq)"""


def oracle_sql() -> dict[str, str]:
    """Statements for the operators that SQL can express."""
    return {
        "op2_decontamination": _WINDOWS,
        "op7_warc": _ARCHIVE,
        "op10_near_dedup": _COMPONENTS,
        "op11_prefix_trie": _TRIE,
    }
