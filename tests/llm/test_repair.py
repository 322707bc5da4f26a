"""Conversation repair against an exhaustive search, and its query against plain Python."""

from __future__ import annotations

import functools
import hashlib
import random
import zlib

import pytest

from termloom.llm import queries, repair

_GRAMMAR = {("start", "s"): "system", ("start", "u"): "assistant", ("system", "u"): "assistant",
            ("user", "u"): "assistant", ("assistant", "a"): "user"}


def search(turns):
    """Cheapest and ASCII-least edits of ``(initial, fault)`` turns, by states of the grammar."""

    @functools.cache
    def rest(i, state, inserts=0):
        expected = "a" if state == "assistant" else "u"
        found = []
        if i == len(turns) and state in ("start", "user"):
            found.append((0, ""))
        # Three insertions in a row are never needed.
        if inserts < 3:
            cost, audit = rest(i, _GRAMMAR[state, expected], inserts + 1)
            found.append((cost + 3, "I" + audit))
        if i < len(turns):
            initial, fault = turns[i]
            cost, audit = rest(i + 1, state)
            found.append((cost + 4, "D" + audit))
            if fault not in ("blank", "duplicate"):
                cut = 3 if fault == "truncated" else 0
                if (state, initial) in _GRAMMAR:
                    cost, audit = rest(i + 1, _GRAMMAR[state, initial])
                    found.append((cost + cut, "K" + audit))
                if initial != expected:
                    cost, audit = rest(i + 1, _GRAMMAR[state, expected])
                    found.append((cost + cut + 3, "R" + audit))
        return min(found, default=(1 << 30, ""))

    return rest(0, "start")


_FAULTS = ("", "blank", "duplicate", "truncated")


def code(turns) -> bytes:
    return bytes(4 * "sua?".index(i if i in "sua" and i else "?") + _FAULTS.index(f) for i, f in turns)


def some_turns(rng, n):
    out, expected = [], "u"
    for k in range(n):
        initial = expected if rng.random() < 0.7 else rng.choice("suax")
        if k == 0 and rng.random() < 0.3:
            initial = "s"
        else:
            expected = "a" if expected == "u" else "u"
        out.append((initial, rng.choices(_FAULTS, (6, 1, 1, 2))[0]))
    return tuple(out)


def test_alignment_is_the_exhaustive_search():
    rng = random.Random(5)
    for trial in range(1500):
        turns = some_turns(rng, rng.randrange(0, 12))
        *_, cost, audit = repair.repair(code(turns))
        assert (cost, audit) == search(turns), turns


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_blocks_give_the_same(block, monkeypatch):
    rng = random.Random(block)
    for trial in range(150):
        turns = tuple(t for t in some_turns(rng, rng.randrange(0, 40)) if t[1] not in ("blank", "duplicate"))
        assert repair.align(code(turns), block) == search(turns), turns


def test_hard_cases():
    cases = [
        (),
        (("s", ""),),
        (("s", "truncated"),),
        (("s", ""), ("s", "")),
        (("x", "truncated"),) * 9,
        (("u", "truncated"), ("a", "truncated")),
        (("a", ""), ("u", "")),
        (("u", ""),) * 8,
        (("s", ""), ("u", "blank"), ("a", "")),
        (("u", "duplicate"), ("a", "blank")),
    ]
    for turns in cases:
        assert repair.repair(code(turns))[4:] == search(turns), turns


def test_a_long_conversation_takes_linear_time():
    rng = random.Random(1)
    turns = code(some_turns(rng, 20_000))
    *_, cost, audit = repair.repair(turns)
    assert sum(c != "I" for c in audit) == 20_000 and cost > 0


def plain_report(rows):
    """The contract in plain Python, over ``(conv_id, turn, role, text)``."""
    kept, convs = {}, []
    for conv, turn, role, text in rows:
        if conv is None:
            continue
        convs.append(conv)
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        kept.setdefault(conv, []).extend([(turn, role, text)] * (2 if fault == 3 else 1))
    out = {}
    for conv in set(convs):
        turns = kept.get(conv, [])
        address = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}:{t}".encode()).hexdigest()
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), address(t[1], t[2])))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, faults = set(), []
        for _, role, text in turns:
            body = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = search(tuple(zip(initials, faults)))
        lines, at, expected = [], 0, "u"
        for step in audit:
            role, text = (turns[at][1:] if step != "I" else ("", ""))
            at += step != "I"
            if step == "D":
                continue
            if step != "K":
                role = {"u": "user", "a": "assistant"}[expected]
            if not (step == "K" and role[:1] == "s"):
                expected = "a" if expected == "u" else "u"
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def found_of(frame):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


def test_query_is_the_contract(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    expected = plain_report([tuple(r) for r in rows.collect()])
    assert found_of(queries.op13_repair(spark, sf_dir)) == expected


def _edge_rows():
    rng = random.Random(3)
    rows = [(1, None, None, None), (1, None, "user", "a."), (None, 1, "user", "x."), (None, None, None, None)]
    rows += [(2, 5, "system", "s."), (2, 5, "system", "s."), (2, 9, "", "no role."), (2, 9, "tool", "?"), (3, 0, "user", "")]
    rows += [(-7, t, rng.choice(["user", "assistant"]), "t" * rng.randrange(1, 9) + ".") for t in range(60)]
    rows += [(8, t, "user" if t % 2 else "assistant", "word " * rng.randrange(1, 4000)) for t in range(200)]
    rows += [(9, 3, "user", "same.")] * 50 + [(10, -(2**62), "user", "é."), (10, 2**62, "assistant", "ü!  \n")]
    rows += [(c, c % 3, "user", "only.") for c in range(100, 160)]
    return rows


def test_edges(spark):
    rows = _edge_rows()
    frame = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, gone string, Audit int"
    )
    expected = plain_report(rows)
    damaged = repair.damaged(frame)
    assert found_of(repair.repair_report(damaged)) == expected
    # Conversations whose rows are all dropped are there too.
    assert any(v[6] == "" for v in expected.values()) and set(expected) == {r[0] for r in rows} - {None}
    assert repair.repair_report(repair.damaged(frame.where("false"))).count() == 0


def test_repaired_turns_have_the_digest(spark, sf_dir):
    rows = repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = repair.audits(rows)
    lines = {}
    for r in sorted(repair.repaired(rows, found).collect(), key=lambda r: (r.conv_id, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    digests = {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in lines.items()}
    empty = hashlib.sha256(b"").hexdigest()
    for r in repair.digests(rows, found).collect():
        assert r.repaired_sha256 == digests.get(r.conv_id, empty)


def test_batches_may_cut_a_conversation(spark):
    frame = spark.createDataFrame(_edge_rows(), "conv_id bigint, turn bigint, role string, text string")
    damaged = repair.damaged(frame)
    whole = found_of(repair.repair_report(damaged))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        assert found_of(repair.repair_report(damaged)) == whole
    finally:
        spark.conf.set(key, before)
