"""Shards against plain Python, and the laws of the hash tree."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
import xxhash

from termloom.llm import queries, sharding
from termloom.llm.common import shared_folder


def _hash(doc_id, name):
    seed = 42 if doc_id is None else xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42)
    return xxhash.xxh64_intdigest(name.encode(), seed)


def _weight(node):
    return sum(map(_weight, node.values())) if isinstance(node, dict) else node


def plain_shard(doc_id, tree):
    """The winner of weighted draws at each level."""
    node = tree
    for level in ("region", "rack", "shard"):
        draws = []
        for k, (name, child) in enumerate(node.items()):
            share = ((_hash(doc_id, f"{level}:{name}") >> 11) + 0.5) / 2.0**53
            draws.append((-math.log(share) / _weight(child), k, name))
        _, _, name = min(draws)
        if level == "shard":
            return name
        node = node[name]


def _check_slots(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op12_sharding(spark, sf_dir).collect()
    tree = sharding.balanced(16)
    larger = sharding.grown(tree)
    expected = sorted(
        (d.doc_id, len(d.text.encode()) + 1, zlib.crc32(d.text.encode()), "key",
         plain_shard(d.doc_id, tree), plain_shard(d.doc_id, larger)) for d in docs
    )
    assert sorted((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in rows) == expected
    assert all(r.grown_shard in (r.shard, 16) for r in rows) and any(r.grown_shard == 16 for r in rows)
    _check_slots(rows)


def test_edges(spark):
    rows = [(1, "a", "x", 1), (1, "a", "x", 1), (1, "b", "x", 2), (2, "", None, 3), (3, None, None, 4),
            (None, "n", None, 5), (None, None, None, 6), (4, "é" * 100_000, None, 7)]
    rows += [(9, "same", "x", 1)] * 3000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, Shard string, slot int")
    out = sharding.shard_rows(docs, sharding.balanced(16)).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in rows
    )
    _check_slots(out)
    assert all(len({r.shard for r in out if r.doc_id == d}) == 1 for d in (1, 9, None))
    assert sharding.shard_rows(docs.where("false"), sharding.balanced(16)).count() == 0
    kept = sharding.placed(docs, sharding.balanced(3))
    assert kept.columns == ["doc_id", "text", "slot", "shard", "region", "rack"]
    assert {r.shard for r in kept.collect()} <= {0, 1, 2}


def _placed(spark, tree, n=20_000):
    ids = spark.range(n).withColumnRenamed("id", "doc_id")
    return {r.doc_id: r for r in sharding.placed(ids, tree).collect()}


def test_shares_follow_the_weights(spark):
    tree = {"a": {"r": {0: 1.0, 1: 3.0}}, "b": {"s": {2: 2.0}, "t": {3: 2.0}}}
    counts = Counter(r.shard for r in _placed(spark, tree).values())
    for shard, weight in ((0, 1), (1, 3), (2, 2), (3, 2)):
        expected = 20_000 * weight / 8
        assert abs(counts[shard] - expected) < 5 * math.sqrt(expected)


def test_a_changed_weight_moves_rows_on_its_way_only(spark):
    tree = sharding.balanced(16)
    before, after = _placed(spark, tree), _placed(spark, sharding.reweighted(tree, 5, 3.0))
    moved = [(before[d], after[d]) for d in before if before[d].shard != after[d].shard]
    assert moved
    for old, new in moved:
        # Shard 5 is in rack1 of region0: what moves comes into that region, that rack or that shard.
        if old.region != new.region:
            assert new.region == "region0"
        elif old.rack != new.rack:
            assert new.rack == "rack1"
        else:
            assert new.shard == 5
    lighter = _placed(spark, sharding.reweighted(tree, 5, 0.2))
    for d, old in before.items():
        new = lighter[d]
        if old.region == new.region == "region1":
            assert old.shard == new.shard
        if old.shard != new.shard and old.rack == new.rack:
            assert old.shard == 5


def test_trees_that_are_none():
    for tree in ({}, {"a": {}}, {"a": {"r": {}}}, {"a": {"r": {0: 0.0}}}, {"a": {"r": {0: 1.0}, "s": {0: 1.0}}}):
        with pytest.raises(ValueError):
            sharding._check(tree)


def test_files(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = shared_folder(spark)
    tree = sharding.balanced(5, 2, 1)
    sharding.write_shards(docs, path, tree, files=3)
    back = spark.read.parquet(path)
    assert back.count() == docs.count() and back.exceptAll(sharding.placed(docs, tree).select(back.columns)).count() == 0
    assert {f.rsplit("/", 2)[1] for f in back.inputFiles()} == {f"shard={k}" for k in range(5)}
    assert 5 < len(back.inputFiles()) <= 15
