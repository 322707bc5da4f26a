"""Repair of conversation structure by Wagner-Fischer alignment to the grammar.

The roles of a sound conversation read ``(s?(ua)+)?``: nothing, or user and assistant
by turns, with a system turn before them or without. Each turn is kept (cost 0), given
the role user or assistant (3) or deleted (4, required for blank and repeated turns),
and empty turns of user or assistant are inserted (3). A truncated turn that stays adds
3. The repair is the cheapest such edit, and of several the one whose audit, the edits'
initials K, R, D and I in order, comes first in ASCII.

Method. Turns that must be deleted are set aside; they cost what they cost. The others
are aligned to the target ``uaua...`` of every feasible length, with and without an
``s`` before it. Read from their ends, all targets that end alike are beginnings of one
string, so one Wagner-Fischer table holds the costs of all their lengths. Only cells
that an alignment within the incumbent cost can reach are computed (Ukkonen's band);
the incumbent is small at first and doubled until an alignment fits in. Every target
of least cost is traced back, always by the first possible letter, and the audits are
compared.

A long conversation is aligned block by block, from its last block to its first, for
each state in which a block may be entered: the costs behind a block are those of the
state that it leaves. A block's alignment never ends with an insertion (that belongs to
the next block), so no audit of a block is the beginning of another one, and blocks can
be compared one by one. So time and tables are linear in the turns.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import kept_by, map_arrow

# The edits' costs, and the roles that edits can give.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
# Turns that are aligned at once.
BLOCK = 64
# Conversations of one block whose repair a Python worker remembers.
REMEMBERED = 20_000

_NEVER = 1 << 40
# A turn as one byte: four times its role's place in _INITIALS, and its fault.
_INITIALS = "sua?"
SOUND, BLANK, DUPLICATE, TRUNCATED, GONE = 0, 1, 2, 3, 255
# States before a turn: nothing yet, system only, user expected, assistant expected.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)


def _tables(turns: bytes, last: str, limit: int, final: bool) -> list[dict[int, int]]:
    """Costs of aligning ``turns[i:]`` with the last ``j`` symbols of a target that ends with ``last``.

    Row ``i`` holds the columns that an alignment of cost ``limit`` can pass. ``final``
    allows insertions behind the last turn.
    """
    n = len(turns)
    above, below = limit // INSERT, limit // DELETE
    other = "u" if last == "a" else "a"
    rows: list[dict[int, int]] = [{} for _ in range(n + 1)]
    rows[n][0] = 0
    if final:
        for j in range(1, above + 1):
            rows[n][j] = INSERT * j
    for i in range(n - 1, -1, -1):
        initial, fault = _INITIALS[turns[i] >> 2], turns[i] & 3
        cut = CUT if fault == TRUNCATED else 0
        under, row, left = rows[i + 1], rows[i], n - i
        for j in range(max(0, left - below), left + above + 1):
            cost = under.get(j, _NEVER) + DELETE
            if j:
                symbol = last if j % 2 else other
                kept = under.get(j - 1, _NEVER) + cut + (0 if initial == symbol else REROLE)
                cost = min(cost, kept, row.get(j - 1, _NEVER) + INSERT)
            if cost <= limit:
                row[j] = cost
    return rows


def _trace(turns: bytes, rows: list[dict[int, int]], last: str, i: int, j: int) -> str:
    """The audit of ``turns[i:]`` against ``j`` symbols that comes first in ASCII: D before I before K before R."""
    other = "u" if last == "a" else "a"
    n, audit = len(turns), []
    while i < n or j:
        cost = rows[i][j]
        if i < n and rows[i + 1].get(j, _NEVER) + DELETE == cost:
            audit.append("D")
            i += 1
        elif j and rows[i].get(j - 1, _NEVER) + INSERT == cost:
            audit.append("I")
            j -= 1
        else:
            symbol = last if j % 2 else other
            audit.append("K" if _INITIALS[turns[i] >> 2] == symbol else "R")
            i += 1
            j -= 1
    return "".join(audit)


def _entries(turns: bytes, behind: list[int], final: bool, states) -> dict[int, tuple[int, str, int]]:
    """For each of the states before ``turns``: least cost to the conversation's end, audit here, state behind.

    ``behind`` are the costs of the states behind ``turns``.
    """
    n = len(turns)
    # The states that a target of one symbol or more leaves, by its last symbol.
    exits = [(last, state) for last, state in (("a", _USER), ("u", _ASSISTANT)) if behind[state] < _NEVER]
    ends = [behind[s] for _, s in exits]
    # Costs behind that all alignments have are no part of the incumbent.
    floor = min(ends, default=0)
    limit = 8
    while True:
        tables = [(last, state, _tables(turns, last, limit, final)) for last, state in exits]
        found = {}
        for entry in states:
            best = (_NEVER, "", entry)
            # Nothing is emitted.
            if behind[entry] < _NEVER:
                best = (DELETE * n + behind[entry], "D" * n, entry)
            first = "a" if entry == _ASSISTANT else "u"
            for last, state, rows in tables:
                # The number of symbols is odd if the first and the last are the same.
                for j, cost in rows[0].items():
                    if j and (j % 2 == 1) == (first == last):
                        best = _better(best, cost + behind[state], state, lambda: _trace(turns, rows, last, 0, j))
            if entry == _START:
                best = _with_system(turns, behind, tables, best)
            found[entry] = best
        # What costs more than the limit within the block was not looked at.
        if max(cost for cost, *_ in found.values()) <= limit + floor:
            return found
        limit *= 2


def _better(best, cost: int, state: int, audit):
    if cost > best[0]:
        return best
    found = audit()
    return (cost, found, state) if (cost, found) < best[:2] else best


def _with_system(turns, behind, tables, best):
    """``best`` or a cheaper repair that keeps a system turn as the first one."""
    n = len(turns)
    for r, turn in enumerate(turns):
        kept = DELETE * r + (CUT if turn & 3 == TRUNCATED else 0)
        if _INITIALS[turn >> 2] != "s" or kept > best[0]:
            continue
        head = "D" * r + "K"
        if behind[_SYSTEM] < _NEVER:
            alone = kept + DELETE * (n - r - 1) + behind[_SYSTEM]
            best = _better(best, alone, _SYSTEM, lambda: head + "D" * (n - r - 1))
        for last, state, rows in tables:
            for j, cost in rows[r + 1].items():
                if j and (j % 2 == 1) == (last == "u"):
                    best = _better(
                        best, kept + cost + behind[state], state,
                        lambda: head + _trace(turns, rows, last, r + 1, j),
                    )
    return best


def align(turns: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of the turns that need not be deleted."""
    cuts = list(range(0, len(turns), block))
    behind = [0, _NEVER, 0, _NEVER]
    plans = []
    for at in reversed(cuts):
        final = at == cuts[-1]
        states = range(4) if at else (_START,)
        plans.append(_entries(turns[at : at + block], behind, final, states))
        behind = [cost for cost, *_ in plans[-1].values()]
    state, audits = _START, []
    for plan in reversed(plans):
        _, audit, state = plan[state]
        audits.append(audit)
    return behind[_START], "".join(audits)


def repair(turns: bytes) -> tuple[int, int, int, int, int, str]:
    """Blank, duplicate, truncated and illegal turns, cost and audit of a conversation."""
    faults = [t & 3 for t in turns]
    roles = [_INITIALS[t >> 2] for t in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairwise(roles))
    required = [f in (BLANK, DUPLICATE) for f in faults]
    cost, audit = align(bytes(t for t, gone in zip(turns, required) if not gone))
    if any(required):
        # Deletions that are required come as early as they can.
        steps, whole = iter(audit), []
        for gone in required:
            if gone:
                whole.append("D")
                continue
            for step in steps:
                whole.append(step)
                if step != "I":
                    break
        # An insertion before a turn comes after the deletions that are before that turn, as here.
        audit = "".join(whole) + "".join(steps)
        cost += DELETE * sum(required)
    return faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, cost, audit


@functools.lru_cache(maxsize=REMEMBERED)
def _known(turns: bytes):
    return repair(turns)


kept_by(__name__, _known.cache_clear)


def repaired_roles(audit: str, roles: list[str]) -> list[tuple[int | None, str]]:
    """The repaired conversation as (place of the turn, role); no place for an insertion."""
    out, expected, at = [], "u", 0
    for step in audit:
        if step == "I":
            out.append((None, ROLES[expected]))
        elif step == "D":
            at += 1
            continue
        else:
            role = roles[at] if step == "K" else ROLES[expected]
            out.append((at, role))
            at += 1
            if role[:1] == "s":
                continue
        expected = "a" if expected == "u" else "u"
    return out


# The same on Spark.

_BLANK = r"[^\x20\x09-\x0D]"


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, gone)``: the rows with the contract's faults put in.

    By ``crc32("conv_id:turn") % 20``: 0 drops a row (it stays, marked ``gone``, so that
    its conversation does), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    makes it the user's. A null role or text, and a null turn in the checksum, is one
    blank. Rows without conv_id belong to no conversation and are left out.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    ).where("conv_id IS NOT NULL")
    name = F.concat_ws(":", F.col("conv_id").cast("string"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(name.cast("binary")) % 20
    text = (
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _address(role: str = "role", text: str = "text") -> Column:
    """Digest of what a turn says; different turns have different ones."""
    return F.md5(F.concat_ws(":", F.octet_length(role), role, text).cast("binary"))


def _codes(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, address, code)``, each conversation's rows in one partition.

    One shuffle, of rows without their texts, serves both the look for earlier turns
    of the same words and the order of the turns.
    """
    short = rows.select(
        "conv_id", "turn", "role", "gone",
        _address().alias("address"),
        (~F.rlike("text", F.lit(_BLANK))).alias("blank"),
        # The last character that is not blank ends the sentence.
        (~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))).alias("open"),
    ).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "address", "gone").orderBy("turn")
    place = F.coalesce(F.array_position(F.array(*map(F.lit, "sua")), F.substring("role", 1, 1)), F.lit(0))
    initial = F.when(place > 0, place - 1).otherwise(len(_INITIALS) - 1)
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.row_number().over(earlier) > 1, DUPLICATE)
        .when(F.col("open"), TRUNCATED)
        .otherwise(SOUND)
    )
    code = F.when(F.col("gone"), GONE).otherwise(4 * initial + fault)
    return short.select("conv_id", "turn", "role", "address", code.cast("int").alias("code"))


# Nulls come first.
_ORDER = ["turn", "role", "address"]
_AUDITS = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string"
)


def _cuts(keys: np.ndarray) -> list[int]:
    """Where the rows of another conversation begin, with both ends."""
    return [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]


class _Turns:
    """Turns and gaps of the conversation that is being read: a byte for a turn, three numbers for the gaps."""

    def __init__(self, conv: int):
        self.conv, self.codes = conv, []
        self.least = self.most = None
        self.distinct = 0

    def add(self, codes: np.ndarray, turns: np.ndarray) -> None:
        self.codes.append(codes.tobytes())
        if len(turns):
            first = int(turns[0])
            self.distinct += int((turns[1:] != turns[:-1]).sum()) + (first != self.most)
            self.least = first if self.least is None else self.least
            self.most = int(turns[-1])

    def row(self) -> tuple:
        codes = b"".join(self.codes)
        gaps = self.most - self.least + 1 - self.distinct if self.distinct else 0
        return (self.conv, gaps, *(_known(codes) if len(codes) <= BLOCK else repair(codes)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation out of sorted rows; a conversation may span batches."""
    kinds = [pa.int64()] * 7 + [pa.string()]
    names = [c.split()[0] for c in _AUDITS.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    current = None
    for batch in batches:
        if not len(batch):
            continue
        convs = batch["conv_id"].to_numpy()
        codes = batch["code"].to_numpy().astype(np.uint8)
        turns = batch["turn"].fill_null(0).to_numpy()
        there = batch["turn"].is_valid().to_numpy(zero_copy_only=False) & (codes != GONE)
        done = []
        for a, b in pairwise(_cuts(convs)):
            if current is None or current.conv != convs[a]:
                if current is not None:
                    done.append(current.row())
                current = _Turns(int(convs[a]))
            current.add(codes[a:b][codes[a:b] != GONE], turns[a:b][there[a:b]])
        if done:
            yield batch_of(done)
    if current is not None:
        yield batch_of([current.row()])


def audits(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of each conversation.

    ``rows`` has ``conv_id, turn, role, text`` and ``gone`` (rows that are not there, but
    whose conversation is). Rows are taken by turn, nulls first, then by role and a
    digest of role and text. A conversation passes through one task in that order,
    since its audit is one string; a turn takes a byte of memory there, and texts stay
    behind. ``gaps`` are the numbers between the least and the largest turn that none
    has, 0 without turns.
    """
    ordered = _codes(rows).sortWithinPartitions("conv_id", *_ORDER).select("conv_id", "turn", "code")
    return map_arrow(ordered, _read, _AUDITS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each repaired conversation; its audit comes before its turns."""

    class State:
        def __init__(self, conv: int, audit: str):
            self.conv, self.audit, self.at = conv, audit, 0
            self.expected, self.first, self.hash = "u", True, hashlib.sha256()

        def emit(self, role: bytes, text: bytes) -> None:
            self.hash.update((b"" if self.first else b"\n") + role + b":" + text)
            self.first = False

        def turn_over(self) -> str:
            role = ROLES[self.expected]
            self.expected = "a" if self.expected == "u" else "u"
            return role

        def inserted(self) -> None:
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.emit(self.turn_over().encode(), b"")
                self.at += 1

        def turn(self, role: bytes, text: bytes) -> None:
            self.inserted()
            step = self.audit[self.at]
            self.at += 1
            if step == "K" and role[:1] == b"s":
                self.emit(role, text)
            elif step != "D":
                given = self.turn_over()
                self.emit(role if step == "K" else given.encode(), text)

        def row(self) -> tuple[int, str]:
            self.inserted()
            return self.conv, self.hash.hexdigest()

    def batch_of(rows):
        convs, digests = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(convs, pa.int64()), pa.array(digests)], names=["conv_id", "repaired_sha256"]
        )

    current = None
    for batch in batches:
        done = []
        columns = (batch[c].to_pylist() for c in ("conv_id", "audit", "role", "text"))
        for conv, audit, role, text in zip(*columns):
            if audit is not None:
                if current is not None:
                    done.append(current.row())
                current = State(conv, audit)
            else:
                current.turn(role, text)
        if done:
            yield batch_of(done)
    if current is not None:
        yield batch_of([current.row()])


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: of the lines ``role:text`` of each repaired conversation.

    ``found`` are the ``audits`` of ``rows``. Texts are shuffled once and hashed as
    they come, in batches, whatever a conversation's length.
    """
    none = F.lit(None)
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), none.cast("bigint").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("address"), none.cast("binary").alias("text"), "audit",
    )
    turns = rows.where("NOT gone").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", _address().alias("address"),
        F.col("text").cast("binary").alias("text"), none.cast("string").alias("audit"),
    )
    ordered = heads.union(turns).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER)
    told = ordered.select("conv_id", "audit", F.col("role").cast("binary").alias("role"), "text")
    return map_arrow(told, _digests, "conv_id bigint, repaired_sha256 string")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv_id, place, turn, role, text)``: the turns of the repaired conversations.

    ``found`` are the ``audits`` of ``rows``. Each conversation's edits are dealt out as
    rows of their own and joined to the turns by place.
    """
    chars = found.select("conv_id", F.posexplode(F.split("audit", "")).alias("step_at", "step")).where("step <> ''")
    window = Window.partitionBy("conv_id").orderBy("step_at")
    consumed = F.sum(F.when(F.col("step") == "I", 0).otherwise(1)).over(window)
    emitted = F.sum(F.when(F.col("step") == "D", 0).otherwise(1)).over(window)
    steps = chars.select(
        "conv_id", "step",
        F.when(F.col("step") != "I", consumed).alias("at"),
        F.when(F.col("step") != "D", emitted).alias("place"),
    ).where("step <> 'D'")
    numbered = rows.where("NOT gone").withColumn("address", _address())
    order = Window.partitionBy("conv_id").orderBy(*_ORDER)
    numbered = numbered.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("at"))
    joined = steps.join(numbered, ["conv_id", "at"], "left")
    # A system turn in front shifts the places of users and assistants by one.
    first = F.first(F.when((F.col("place") == 1) & (F.col("step") == "K"), F.substring("role", 1, 1)), True)
    system = F.coalesce(first.over(Window.partitionBy("conv_id")) == "s", F.lit(False))
    user = F.when(system, F.col("place") % 2 == 0).otherwise(F.col("place") % 2 == 1)
    given = F.when(user, ROLES["u"]).otherwise(ROLES["a"])
    return joined.select(
        "conv_id", F.col("place").cast("bigint").alias("place"), "turn",
        F.when(F.col("step") == "K", F.col("role")).otherwise(given).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def repair_report(rows: DataFrame) -> DataFrame:
    """``audits`` of the conversations with ``repaired_sha256``, one row each."""
    found = audits(rows)
    return found.join(digests(rows, found), "conv_id")
