"""Trie of conversation prefixes, by fingerprints that compose.

A sequence of turns has a fingerprint: the sum of its turns' digests, each times a
power of an odd base that tells its distance from the end, modulo 2**64, twice. The
fingerprints with the sequences' lengths are a monoid: that of a joined sequence is
the left one times a power of the base, plus the right one. So

* prefixes of all conversations come out of sorted stretches of turns that know nothing
  of each other, and a conversation may be cut anywhere;
* a rebuilt conversation, the head of one and the rest of another, has its prefixes'
  fingerprints from those of its parts: ``whole = P[i] + (base - P[h]) * B**(i - h)``
  for its turn ``i`` behind the ``h`` turns that it lost. No rebuilt text is ever made;
  a member of a node is a few numbers, among them a reference to its last turn.

Members that share depth and fingerprint are a node. That they are equal is verified
through the turns that they refer to: in every node all parents must be one, and all
last turns must agree in their lengths and in 128 further bits of their SHA-256, which
no fingerprint has used; otherwise the job fails.

Sums over subtrees. Every node belongs to its longest member (of several, the one of
the smallest id), so a conversation owns a path that ends in a leaf, and the paths hang
on each other by their top nodes. Totals are pushed from path to path, once for each
level of paths, which are few as each hangs on a longer one; within a path they are
running sums over blocks of depths.

Skew: turns are sorted by ranges of (conv_id, turn, digest), so one conversation may
fill many tasks; prefixes are joined with what a conversation has lost by blocks of
BLOCK turns; nodes are counted on the map side first; a node with very many children
is looked up by a broadcast of fewer than HOT_NODES rows. Only the digest of a node's
ends, being one hash, is made by one task, from pieces that hold up to 4,096 ids.

Defined results: a null role or text is empty; rows of one turn follow in order of their
digests; rows without conv_id belong to no conversation and are left out; further
columns are not read; no conversations, no nodes. Results are of what the table holds
when this is called: it writes tables to the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import map_arrow, saved

# A conversation's head comes from the one whose id is the next lower multiple of FAMILY.
FAMILY, HEADS = 5, 9
# Turns, or depths, of a conversation that meet in one group at most, as a power of two.
BLOCK_BITS = 12
# Nodes with more than 1/HOT_NODES of all nodes as children are looked up by a broadcast.
HOT_NODES = 10_000
# Levels of paths that hang on each other; each path is shorter than the one it hangs on.
ROUNDS = 100_000

# The base of the fingerprints, and what undoes it.
_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(max(size, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _power_of(exponents: np.ndarray) -> np.ndarray:
    """``_BASE`` to each of some exponents, by repeated squaring."""
    out = np.ones(len(exponents), np.uint64)
    left, square = exponents.astype(np.uint64), _BASE
    while left.any():
        out = np.where(left & np.uint64(1), out * np.uint64(square), out)
        left, square = left >> np.uint64(1), square * square & _MASK
    return out


def lost_turns(conv_id: Column) -> Column:
    """How many turns of its own a conversation lost: ``crc32(decimal conv_id) % 9``."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % FAMILY


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat_ws(":", F.octet_length(role), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.sha2(said.cast("binary"), 256)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch[name].to_numpy().view(np.uint64)


_STRETCH = "part bigint, conv_id bigint, at bigint, x1 bigint, x2 bigint, a1 bigint, a2 bigint, bytes bigint, f1 bigint, f2 bigint"
_PREFIX = (
    "conv_id bigint, at bigint, a1 bigint, a2 bigint, bytes bigint, f1 bigint, f2 bigint, p1 bigint, p2 bigint"
)
_MEMBER = (
    "conv_id bigint, depth bigint, length bigint, f1 bigint, f2 bigint, p1 bigint, p2 bigint, a1 bigint, a2 bigint, "
    "bytes bigint, ref_conv bigint, ref_at bigint"
)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and fingerprints of sorted turns, counted from where this task's part of a conversation begins."""
    part = TaskContext.get().partitionId()
    last, count, sums = None, 0, [0, 0]
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        convs = batch["conv_id"].to_numpy()
        words = np.frombuffer(b"".join(batch["digest"].to_pylist()), "<u8").reshape(n, 4)
        first = np.flatnonzero(np.append(True, convs[1:] != convs[:-1]))
        start = np.repeat(first, np.diff(np.append(first, n)))
        at = np.arange(n) - start + 1
        up, down = _powers(_BASE, n), _powers(_UNDO, n)
        # What the conversation that goes on from the batch before has already.
        ongoing = np.arange(n) < (first[1] if len(first) > 1 else n)
        ongoing &= convs[0] == last
        scale = _power_of(np.where(ongoing, at, 0))
        found = []
        for lane in (0, 1):
            total = np.append(np.uint64(0), np.cumsum(words[:, lane] * down, dtype=np.uint64))
            own = (total[1:] - total[start]) * up
            found.append(np.where(ongoing, own + scale * np.uint64(sums[lane]), own))
        at = at + np.where(ongoing, count, 0)
        last, count, sums = convs[-1], int(at[-1]), [int(f[-1]) for f in found]
        yield pa.RecordBatch.from_arrays(
            [_ints(np.full(n, part)), batch["conv_id"], _ints(at)]
            + [_ints(np.ascontiguousarray(words[:, k])) for k in range(4)]
            + [batch["bytes"], *map(_ints, found)],
            names=_names(_STRETCH),
        )


def _carried(stretches: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """For each part that begins within a conversation: its id, and count and fingerprint of its turns before.

    The products of the parts' last conversations, one row for each task of the sort,
    are joined in order on the driver.
    """
    ends = stretches.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "at", "f1", "f2")).alias("last")
    )
    carried, current = {}, None
    for row in sorted(ends.collect(), key=lambda r: r.part):
        before = current if current is not None and current[0] == row.first else None
        if before is not None:
            carried[row.part] = before
        conv, at, *f = row.last
        count, sums = 0, (0, 0)
        if before is not None and conv == before[0]:
            count, sums = before[1], before[2:]
        scale = pow(_BASE, at, 1 << 64)
        current = (conv, count + at, *((s * scale + own) & _MASK for s, own in zip(sums, f)))
    return carried


def _finished(carried: dict) -> Callable:
    """Places and fingerprints counted from each conversation's beginning, with those of the turn before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            parts, convs = batch["part"].to_numpy(), batch["conv_id"].to_numpy()
            at = batch["at"].to_numpy().copy()
            sums = [_longs(batch, f).copy() for f in ("f1", "f2")]
            for part in np.unique(parts).tolist():
                if part in carried:
                    conv, count, *before = carried[part]
                    rows = np.flatnonzero((parts == part) & (convs == conv))
                    scale = _power_of(at[rows])
                    for f, s in zip(sums, before):
                        f[rows] += scale * np.uint64(s)
                    at[rows] += count
            prior = [(f - _longs(batch, x)) * np.uint64(_UNDO) for f, x in zip(sums, ("x1", "x2"))]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], _ints(at), batch["a1"], batch["a2"], batch["bytes"], *map(_ints, sums + prior)],
                names=_names(_PREFIX),
            )

    return run


def prefixes(conversations: DataFrame) -> DataFrame:
    """``(conv_id, at, a1, a2, bytes, f1, f2, p1, p2)`` for each turn, ``at`` from 1.

    ``f1, f2`` are the fingerprint of the turns up to it, ``p1, p2`` of those before it,
    ``a1, a2`` further bits of the turn's digest.
    """
    turns = _turns(conversations)
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "digest"]
    ordered = turns.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stretches = saved(map_arrow(ordered.select("conv_id", "digest", "bytes"), _stretches, _STRETCH))
    return map_arrow(stretches, _finished(_carried(stretches)), _PREFIX)


def _conversations(turns: DataFrame) -> DataFrame:
    """A row for each conversation: what it lost, what it has instead, its rebuilt ``length``.

    ``head`` are the prefixes that it takes from its base, eight at most.
    """
    conv = F.col("conv_id")
    lost = lost_turns(conv)
    own = turns.groupBy("conv_id").agg(
        F.max("at").alias("n"),
        *(F.max(F.when(F.col("at") == lost, F.col(f))).alias(f"cut{f[1]}") for f in ("f1", "f2")),
    )
    heads = (
        turns.where((conv % FAMILY == 0) & (F.col("at") < HEADS))
        .groupBy(conv.alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "f1", "f2", "p1", "p2", "a1", "a2", "bytes"))).alias("head"))
    )
    joined = own.withColumn("base", base_of(conv)).join(heads, "base", "left")
    none = F.slice(F.col("head"), 1, 0)
    head = F.when(F.col("head").isNull(), none).otherwise(F.slice("head", F.lit(1), F.col("lost").cast("int")))
    cut = (
        joined.withColumn("lost", lost)
        .withColumn("head", head)
        .withColumn("taken", F.greatest(F.size("head"), F.lit(0)).cast("bigint"))
    )
    last = F.get(F.col("head"), F.col("taken").cast("int") - 1)
    return cut.select(
        "conv_id", "base", "n", "lost", "taken", "head",
        (F.col("taken") + F.greatest(F.col("n") - F.col("lost"), F.lit(0))).alias("length"),
        *(F.coalesce(last[f], F.lit(0)).alias(f"base{f[1]}") for f in ("f1", "f2")),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("cut1", "cut2")),
    )


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the nodes that a conversation's own turns lead to."""
    for batch in batches:
        at, lost = batch["at"].to_numpy(), batch["lost"].to_numpy()
        scale = _power_of(at - lost - 1)
        whole, parent = [], []
        for k in (1, 2):
            shift = (_longs(batch, f"base{k}") - _longs(batch, f"cut{k}")) * scale
            whole.append(_longs(batch, f"f{k}") + shift * np.uint64(_BASE))
            parent.append(_longs(batch, f"p{k}") + shift)
        depth = batch["taken"].to_numpy() + at - lost
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], _ints(depth), batch["length"], *map(_ints, whole + parent)]
            + [batch["a1"], batch["a2"], batch["bytes"], batch["conv_id"], batch["at"]],
            names=_names(_MEMBER),
        )


def members(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each rebuilt conversation and depth, 0 included; see the module's text.

    ``turns`` are ``prefixes``, ``convs`` what ``_conversations`` makes of them.
    ``ref_conv, ref_at`` refer to the turn that is the last one of the prefix.
    """
    names = _names(_MEMBER)
    zero = [F.lit(0).cast("bigint").alias(c) for c in names[3:10]]
    none = F.lit(None).cast("bigint")
    roots = convs.select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), "length", *zero,
        none.alias("ref_conv"), none.alias("ref_at"),
    )
    heads = convs.select("conv_id", "length", "base", F.explode("head").alias("h")).select(
        "conv_id", F.col("h.at").alias("depth"), "length",
        *(F.col(f"h.{c}").alias(c) for c in names[3:10]), F.col("base").alias("ref_conv"), F.col("h.at").alias("ref_at"),
    )
    blocks = convs.where("n > lost").select(
        "conv_id", "length", "lost", "taken", "base1", "base2", "cut1", "cut2",
        F.explode(F.sequence(F.lit(0), F.shiftright(F.col("n") - 1, BLOCK_BITS))).alias("block"),
    )
    rest = turns.where(F.col("at") > lost_turns(F.col("conv_id"))).withColumn(
        "block", F.shiftright(F.col("at") - 1, BLOCK_BITS)
    )
    own = map_arrow(rest.join(blocks, ["conv_id", "block"]).drop("block"), _composed, _MEMBER)
    return roots.select(names).union(heads.select(names)).union(own)


def _same(name: str) -> Column:
    return F.min(name) == F.max(name)


def _nodes(rows: DataFrame) -> DataFrame:
    """Nodes with their smallest member, owner, number of members and the turn that they end with."""
    checked = ["p1", "p2", "a1", "a2", "bytes"]
    same = _same(checked[0])
    for name in checked[1:]:
        same &= _same(name)
    grouped = rows.groupBy("depth", "f1", "f2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min(F.struct((-F.col("length")).alias("length"), "conv_id")).alias("owner"),
        same.alias("same"),
        *(F.min(c).alias(c) for c in ("p1", "p2", "bytes")),
        # Any of the members' references, as they are to equal turns.
        F.first(F.struct("ref_conv", "ref_at")).alias("ref"),
    )
    checked = F.when(F.col("same"), F.col("n_convs")).otherwise(
        F.raise_error(F.concat(F.lit("different prefixes share a fingerprint at depth "), F.col("depth")))
    )
    return grouped.select(
        "depth", "f1", "f2", "p1", "p2", "conv_id", checked.alias("n_convs"), "bytes",
        F.col("owner.conv_id").alias("owner"), "ref.ref_conv", "ref.ref_at",
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node out of sorted pieces."""
    names = ["depth", "f1", "f2", "ends_sha256"]

    def batch_of(rows):
        columns = [pa.array(c) for c in zip(*rows)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    key, state = None, None
    for batch in batches:
        done = []
        for *own, piece in zip(*(batch[c].to_pylist() for c in ("depth", "f1", "f2", "piece"))):
            if own != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if done:
            yield batch_of(done)
    if key is not None:
        yield batch_of([(*key, state.hexdigest())])


def _ends(rows: DataFrame) -> DataFrame:
    """``(depth, f1, f2, ends_sha256)`` of the nodes at which conversations end.

    A conversation ends once, so a piece holds no more ids than there are numbers in it.
    """
    key = ["depth", "f1", "f2"]
    pieces = (
        rows.where("depth = length")
        .groupBy(*key, F.shiftright("conv_id", 12).alias("piece_at"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("piece"))
    )
    ordered = pieces.repartition(*key).sortWithinPartitions(*key, "piece_at").select(*key, "piece")
    return map_arrow(ordered, _hashed, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``n_children, parent_conv_id, parent_owner``, the last two null for the root."""
    key = ["depth", "f1", "f2"]
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")]
    kids = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    known = saved(nodes.join(kids, key, "left").fillna(0, ["n_children"]))
    share = known.agg((F.count("*") / F.lit(HOT_NODES)).alias("share")).scalar()
    parents = known.where("n_children > 0").select(
        F.col("depth").alias("up_depth"), F.col("f1").alias("up1"), F.col("f2").alias("up2"), "n_children",
        F.col("conv_id").alias("parent_conv_id"), F.col("owner").alias("parent_owner"),
    )
    # A node has one parent, so fewer than HOT_NODES of them have so many children.
    hot = F.broadcast(parents.where(F.col("n_children") > share).drop("n_children"))
    cold = parents.where(F.col("n_children") <= share).drop("n_children")
    on = (F.col("depth") - 1 == F.col("up_depth")) & (F.col("p1") == F.col("up1")) & (F.col("p2") == F.col("up2"))
    below = known.where("depth > 0")
    found = below.join(hot, on).unionByName(below.join(hot, on, "left_anti").join(cold, on))
    none = F.lit(None).cast("bigint")
    root = known.where("depth = 0").withColumns({"parent_conv_id": none, "parent_owner": none})
    return root.unionByName(found.drop("up_depth", "up1", "up2"))


def _path_totals(nodes: DataFrame) -> DataFrame:
    """``(owner, up, at, saved, leaves)``: sums over all that hangs on each path's top node.

    ``up`` and ``at`` tell the path and the depth that it hangs on, null for the root's.
    """
    paths = saved(
        nodes.groupBy("owner").agg(
            F.max(F.when(F.col("parent_owner") != F.col("owner"), F.col("parent_owner"))).alias("up"),
            (F.min("depth") - 1).alias("at"),
            F.sum("value").alias("saved"),
            F.lit(1).cast("bigint").alias("leaves"),
        )
    )
    links = paths.where("up IS NOT NULL").select("owner", "up")
    total, message = paths, paths.select("owner", "saved", "leaves")
    for _ in range(ROUNDS):
        # Summed for each path before they are sent on, so a path is one row here.
        message = saved(
            message.join(links, "owner")
            .groupBy(F.col("up").alias("owner"))
            .agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        )
        if message.isEmpty():
            return total
        more = message.select("owner", F.col("saved").alias("more_saved"), F.col("leaves").alias("more_leaves"))
        total = saved(
            total.join(more, "owner", "left").select(
                "owner", "up", "at",
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            )
        )
    raise RuntimeError(f"more than {ROUNDS} levels of paths")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``saved_tokens`` and ``n_leaves``, sums from each node down."""
    totals = _path_totals(nodes)
    hung = (
        totals.where("up IS NOT NULL")
        .groupBy(F.col("up").alias("owner"), F.col("at").alias("depth"))
        .agg(F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    )
    rows = nodes.join(hung, ["owner", "depth"], "left").withColumns({
        "saved": F.col("value") + F.coalesce("hung_saved", F.lit(0)),
        # A path ends in a leaf.
        "leaves": F.when(F.col("n_children") == 0, 1).otherwise(0) + F.coalesce("hung_leaves", F.lit(0)),
        "block": F.shiftright("depth", BLOCK_BITS),
    }).drop("hung_saved", "hung_leaves")
    deeper = Window.partitionBy("owner", "block").orderBy(F.desc("depth"))
    rows = rows.withColumns({c: F.sum(c).over(deeper) for c in ("saved", "leaves")})
    # Sums of the blocks below, for paths of several blocks only: a block's top has its whole sum.
    tops = rows.groupBy("owner", "block").agg(F.max("saved").alias("saved"), F.max("leaves").alias("leaves"))
    below = Window.partitionBy("owner").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    under = tops.select(
        "owner", "block", F.sum("saved").over(below).alias("under_saved"), F.sum("leaves").over(below).alias("under_leaves")
    ).where("under_leaves IS NOT NULL")
    return rows.join(under, ["owner", "block"], "left").withColumns({
        "saved_tokens": F.col("saved") + F.coalesce("under_saved", F.lit(0)),
        "n_leaves": F.col("leaves") + F.coalesce("under_leaves", F.lit(0)),
    })


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt ``conversations(conv_id, turn, role, text)``.

    Each conversation is rebuilt from the first turns of the one whose id is the next
    lower multiple of FAMILY, as many as it lost, and its own turns behind those it
    lost. Columns: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``, and ``ref_conv, ref_at``, the
    conversation and place of an original turn that the prefix ends with (null for the
    root).
    """
    turns = prefixes(conversations)
    convs = saved(_conversations(turns))
    rows = saved(members(turns, convs))
    value = (F.col("n_convs") - 1) * F.col("bytes")
    nodes = saved(_with_parents(_nodes(rows)).withColumn("value", value))
    empty = hashlib.sha256(b"").hexdigest()
    summed = _subtree_sums(nodes).join(_ends(rows), ["depth", "f1", "f2"], "left")
    return summed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "ref_conv", "ref_at",
    )


def last_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with ``role`` and ``text`` of the turn that each prefix ends with, through its reference."""
    order = Window.partitionBy("conv_id").orderBy("turn", "digest")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat_ws(":", F.octet_length(role), role, text)
    places = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), F.unhex(F.sha2(said.cast("binary"), 256)).alias("digest"),
    )
    told = places.select(
        F.col("conv_id").alias("ref_conv"), F.row_number().over(order).cast("bigint").alias("ref_at"), "role", "text"
    )
    return nodes.join(told, ["ref_conv", "ref_at"], "left")
