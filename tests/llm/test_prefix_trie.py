"""The trie of rebuilt conversations against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from termloom.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(said):
    role, text = said
    return hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).digest()


def plain(rows):
    """The contract in plain Python."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, (role or "", text or "")))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(t[1])))
    said = {c: [s for _, s in turns] for c, turns in own.items()}
    rebuilt = {}
    for c in said:
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        lost = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(said.get(base, [])[:lost] + said[c][lost:])
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = {}
    for seq in nodes:
        if seq:
            children.setdefault(seq[:-1], []).append(seq)
    sums = {}
    for seq in sorted(nodes, key=len, reverse=True):
        below = [sums[k] for k in children.get(seq, [])]
        bytes_ = len(seq[-1][1].encode()) if seq else 0
        sums[seq] = (
            sum(b[0] for b in below) if below else 1,
            (len(nodes[seq]) - 1) * bytes_ + sum(b[1] for b in below),
        )
    out = []
    for seq, convs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(seq)))
        parent = min(nodes[seq[:-1]]) if seq else None
        out.append((
            min(convs), len(seq), parent, len(convs), len(children.get(seq, [])), *sums[seq],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str), {(min(convs), len(seq)): seq[-1] for seq, convs in nodes.items() if seq}


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def _rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(-12, 60):
        start = rng.choice(["system prompt", "hello", "é"])
        for turn in range(rng.randrange(0, 12)):
            text = start if turn == 0 else rng.choice(["yes", "no", "", None])
            rows.append((conv, turn, rng.choice(["user", "user", "assistant", None]), text))
    # Copies, snapshots that grow, one long conversation, turns without number or of one number.
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1100, 5) for t in range(4)]
    rows += [(c, t, "user", f"log {t}") for c in range(2000, 2100, 5) for t in range((c - 2000) // 5)]
    rows += [(3000, t, "user", f"long {t % 7}") for t in range(700)] + [(3005, t, "user", f"long {t % 7}") for t in range(650)]
    rows += [(4000, None, "user", x) for x in "abcab"] + [(4001, 3, "user", x) for x in "xxyyz"]
    rows += [(None, 1, "user", "of none"), (None, None, None, None), (5001, 0, "user", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits, hot", [(12, 10_000), (3, 10_000), (2, 3), (5, 40)])
def test_against_plain_python(spark, monkeypatch, bits, hot):
    monkeypatch.setattr(pt, "BLOCK_BITS", bits)
    monkeypatch.setattr(pt, "HOT_NODES", hot)
    rows = _rows(bits)
    expected, _ = plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(pt.prefix_trie(frame)) == expected


def test_batches_and_tasks_may_cut_conversations(spark):
    rows = _rows(8)
    expected, _ = plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "9")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert found(pt.prefix_trie(frame)) == expected
    finally:
        spark.conf.set(key, before)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_edges(spark):
    rows = [(1, 0, "user", "x" * 300_000, "a", 1), (1, 0, "user", "x" * 300_000, "b", None), (None, None, None, None, None, 2)]
    frame = spark.createDataFrame(rows, SCHEMA + ", Depth string, digest int")
    expected, _ = plain(rows)
    assert found(pt.prefix_trie(frame)) == expected
    assert pt.prefix_trie(frame.where("false")).count() == 0
    # Conversation 5001 lost all its turns and its base is absent: it ends at the root.
    alone = spark.createDataFrame([(5001, 0, "user", "lost")], SCHEMA)
    (root,) = found(pt.prefix_trie(alone))
    assert root[:7] == (5001, 0, None, 1, 0, 1, 0)


def test_references_lead_to_the_last_turns(spark):
    rows = _rows(2)
    _, last = plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    nodes = pt.last_turns(pt.prefix_trie(frame).drop("n_convs"), frame)
    told = {(r.conv_id, r.depth): (r.role, r.text) for r in nodes.collect() if r.depth}
    assert told == last


def test_equal_fingerprints_of_other_turns_fail(spark):
    row = {c: 0 for c in pt._names(pt._MEMBER)}
    rows = [{**row, "conv_id": 1, "depth": 1}, {**row, "conv_id": 2, "depth": 1, "a1": 5}]
    frame = spark.createDataFrame(rows, pt._MEMBER)
    with pytest.raises(Exception, match="share a fingerprint"):
        pt._nodes(frame).collect()


def test_powers():
    exponents = np.array([0, 1, 2, 5, 63, 1000, 12345])
    expected = [pow(pt._BASE, int(e), 1 << 64) for e in exponents]
    assert pt._power_of(exponents).tolist() == expected
